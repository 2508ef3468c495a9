"""Small functions whose meaning must not depend on an engine's collation, booleans or time zone."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Letters that differ in case, marks or width are equal under it, however they are composed.
COLLATION = "UNICODE_CI_AI"
# Classes of the soundex code, 0 for letters without one.
SOUNDEX = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230120022455012623010202", strict=True))


def name_key(c: Column) -> Column:
    """Key for joining and grouping names: white space collapsed, compared by COLLATION; null stays null."""
    return F.collate(F.trim(F.regexp_replace(c, r"[\s\x{A0}]+", " ")), COLLATION)


@pandas_udf(StringType())
def _unmarked(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""
    return texts.map(lambda x: "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch)), na_action="ignore")


def norm_key(c: Column) -> Column:
    """c in lower case, decomposed, without marks and with single spaces, for texts and files that know no collation; null stays null."""
    return F.trim(F.regexp_replace(F.lower(_unmarked(c)), r"[\s\x{A0}]+", " "))


def number_text(c: Column, places: int = 0) -> Column:
    """A number with grouped thousands and so many places, as "12,345.60"."""
    return F.format_number(c, places)


def day_of_week(c: Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(c)


# Patterns of a JavaScript date library and the ones that stand for them here, longest first.
_DATE_PARTS = {"YYYY": "yyyy", "YY": "yy", "MMMM": "MMMM", "MMM": "MMM", "MM": "MM", "M": "M", "DD": "dd", "D": "d", "dddd": "EEEE", "ddd": "EEE", "HH": "HH", "H": "H", "hh": "hh", "h": "h", "mm": "mm", "ss": "ss", "SSS": "SSS", "A": "a"}


def date_text(c: Column, pattern: str) -> Column:
    """A timestamp by a pattern such as "YYYY-MM-DD hh:mm A"; what stands in square brackets, and marks, are taken as they are."""
    out, i = "", 0
    while i < len(pattern):
        if pattern[i] == "[" and "]" in pattern[i:]:
            end = pattern.index("]", i)
            out, i = out + "'" + pattern[i + 1 : end].replace("'", "''") + "'", end + 1
            continue
        part = next((p for p in _DATE_PARTS if pattern.startswith(p, i)), None)
        out += _DATE_PARTS[part] if part else ("'" + pattern[i].replace("'", "''") + "'" if pattern[i].isalpha() or pattern[i] == "'" else pattern[i])
        i += len(part or " ")
    return F.date_format(c, out)


def b2i(condition: Column) -> Column:
    """1 or 0; a null condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def last_of(c: Column, sep: str, n: int = 1) -> Column:
    """The last n parts of c around sep, or all of c if it has fewer."""
    return F.substring_index(c, sep, -n)


def query_param(url: Column, name: str) -> Column:
    """A parameter of a URL's query as text; null if it is not there."""
    found = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(found != "", found)


def mountain(ts: Column) -> Column:
    """UTC to the clock of Denver, by the zone's own rules."""
    return F.from_utc_timestamp(ts, "America/Denver")


def us_date(c: Column) -> Column:
    """M/D/YYYY as a date; null for anything else, days that no month has included."""
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "M/d/yyyy"))


def date_range(text: Column) -> tuple[Column, Column]:
    """Start and end of "12/05/2025", "12/05 - 12/06/2025", "12/05/25 - 12/06/25" and "12/05-07/2025".

    A start without a year borrows the end's, also across New Year; two-digit years are of this century.
    Other text gives nulls.
    """
    t = F.trim(text)
    day, year = r"\d{1,2}/\d{1,2}", r"\d{2,4}"
    known = rf"^(?:{day}/{year}|{day}/{year}\s*-\s*{day}/{year}|{day}\s*-\s*{day}/{year}|{day}\s*-\s*\d{{1,2}}/{year})$"
    numbers = F.when(t.rlike(known), F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)))

    def ends(found: Column) -> Column:
        def at(month: int, day: int, year: int) -> Column:
            part = lambda i: F.get(found, F.lit(i))
            return F.try_to_date(F.concat_ws("/", part(month), part(day), F.when(F.length(part(year)) == 2, F.concat(F.lit("20"), part(year))).otherwise(part(year))), "M/d/yyyy")

        n = F.size(found)  # it tells the forms apart
        start = F.when(n.isin(3, 6), at(0, 1, 2)).when(n == 5, at(0, 1, 4)).when(n == 4, at(0, 1, 3))
        end = F.when(n == 3, at(0, 1, 2)).when(n == 6, at(3, 4, 5)).when(n == 5, at(2, 3, 4)).when(n == 4, at(0, 2, 3))
        return F.struct(start.alias("start"), end.alias("end"))

    # Numbers are an element of an array, so that they are found once and not for each part of a date.
    both = F.get(F.transform(F.array(numbers), ends), F.lit(0))
    return both["start"], both["end"]


def soundex_full(name: Column | str) -> Column:
    """Soundex without a limit on its length: vowels dropped, then equal neighbours once, three digits at least.

    Only letters A to Z count, whatever their case; a name without any gives an empty code, null stays null.
    """
    letters = F.regexp_replace(F.upper(F.col(name) if isinstance(name, str) else name), "[^A-Z]", "")
    codes = F.translate(letters, "".join(SOUNDEX), "".join(SOUNDEX.values()))
    digits = F.regexp_replace(F.regexp_replace(codes, "0", ""), r"(\d)\1+", "$1")
    rest = F.when(codes.startswith("0"), digits).otherwise(F.substr(digits, F.lit(2)))
    code = F.concat(F.substring(letters, 1, 1), rest)
    return F.when(letters == "", "").otherwise(F.rpad(code, F.greatest(F.lit(4), F.length(code)), F.lit("0")))
