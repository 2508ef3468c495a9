"""Free-text bout lines into round, result, sides, outcome and names.

A line reads like "Varsity - Final - Ann Lee (North) over Bo Ray (South) (Dec 5-2)". Patterns have the
meaning that a reader would give them: \\b is a word's edge and \\s white space. Loose tokens (" bye",
" tie", " draw", " for.") match anywhere, surnames included; ``strict`` asks for whole words instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i, last_of

# Labels of a level, never of a round.
LEVELS = ("varsity", "jv", "junior varsity", "exhibition", "scrimmage")
# Particles that belong to a last name.
PARTICLES_2 = ("de la", "van der", "von der")
PARTICLES_1 = ("de", "da", "del", "der", "di", "du", "van", "von", "la", "le", r"st\.?", "san")
# Signs of a win without a bout.
FORFEIT_PLAIN = (" forfeit", " for.", " fft", "injury default")
FORFEIT_WORDS = r"\bmff\b|\bmed(?:ical)?\s*for(?:feit)?\b|\binj\.?\s*def\.?(?:\b|\s|\)|$)|\b(?:dq|disqualification)\b"
FORFEIT_STRICT = r"\b(?:for\.|fft|forfeit)\b|\b(?:mff|med(?:ical)?\s*for(?:feit)?)\b|\b(?:inj\.?\s*def\.?|injury\s*default)\b|\b(?:dq|disqualification)\b"
SUFFIX = r"\s*,?\s*(?:Jr\.?|Sr\.?|II|III|IV|V|VI)\s*$"
OVER = " over "


def one_line(raw: Column) -> Column:
    return F.trim(F.translate(raw, "\r\n", "  "))


def round_of(line: Column) -> Column:
    """The first segment, or the second after a level; null where that is missing or looks like a name."""
    parts = F.split(line, " - ")
    first, second = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    leveled = F.lower(first).isin(*LEVELS) & ~second.contains("(")
    return F.when(F.size(parts) < 2, None).when(leveled, second).when(~first.contains("("), first)


def result_of(line: Column) -> Column:
    low = F.lower(line)
    return F.when(low.rlike(r"\breceived a bye\b"), "bye").when(low.contains(OVER), "over")


def score_of(line: Column) -> Column:
    """What the last bracket holds, or what stands in for it."""
    low = F.lower(line)
    return (
        F.when(low.contains(" vs. "), "vs. no winner info").when(low.contains("received a bye"), "Bye")
        .when(line.contains("("), F.regexp_replace(last_of(line, "("), r"\)+$", ""))
    )


def _half(line: Column, after: bool) -> Column:
    """The lower-case text before or after the first " over "; null without it."""
    low = F.lower(line)
    at = F.instr(low, OVER)
    part = F.substr(low, at + len(OVER)) if after else F.substr(low, F.lit(1), at - 1)
    return F.when(at > 0, part)


def mentions(half: Column, name: Column, team: Column) -> Column:
    """Whether a half names this athlete: by full name, by last name with the team if known, or by team; no name, no side."""
    who, club = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.trim(F.substring_index(F.coalesce(team, F.lit("")), ",", 1)))
    last = last_of(F.trim(who), " ")
    at_club = (club != "") & half.contains(club)
    full = (who != "") & half.contains(who)
    by_last = (last != "") & half.contains(last) & ((club == "") | at_club)
    return F.coalesce((who != "") & (full | by_last | at_club), F.lit(False))


def with_bout(df: DataFrame, strict: bool = False) -> DataFrame:
    """df (raw_details, wrestler_name, wrestler_team) with round, result, score, sides, flags and outcome.

    Precedence: bye, exhibition (U), tie, forfeit by an unknown opponent (W), then the side on which the
    athlete alone is named; all else is U. Every row but byes and exhibitions counts in the record. strict
    takes whole words for signs, full names for sides around " over " or " def.", and varsity only where a
    line's first segment begins with it.
    """
    df = df.withColumn("line", one_line(F.col("raw_details")))
    line, low = F.col("line"), F.lower("line")
    if strict:
        bye, tie, exhibition, varsity = (low.rlike(p) for p in (r"\bbye\b", r"\b(?:tie|draw)\b", r"\bexhibition\b", r"^varsity\b.* - "))
        forfeit = low.rlike(FORFEIT_STRICT)
        who = F.lower(F.coalesce("wrestler_name", F.lit("")))
        at = F.when(F.instr(low, OVER) > 0, F.instr(low, OVER)).otherwise(F.instr(low, " def."))
        sides = [F.coalesce((at > 0) & part.contains(who), F.lit(False)) for part in (F.substr(low, F.lit(1), at - 1), F.substr(low, at))]
    else:
        bye = low.rlike(r"\breceived a bye\b") | low.contains(" bye")
        tie = low.contains(" tie") | low.contains(" draw")
        exhibition, varsity, forfeit = low.contains("exhibition"), low.contains("varsity"), low.rlike(FORFEIT_WORDS)
        for plain in FORFEIT_PLAIN:
            forfeit = forfeit | low.contains(plain)
        sides = [mentions(_half(line, after), F.col("wrestler_name"), F.col("wrestler_team")) for after in (False, True)]
    no = lambda c: b2i(F.coalesce(c, F.lit(False)))
    df = df.withColumns({
        "round": round_of(line), "result": result_of(line), "score_details": score_of(line), "me_before": b2i(sides[0]), "me_after": b2i(sides[1]),
        "is_bye": no(bye), "is_exhibition": no(exhibition), "is_tie": no(tie),
        "is_unknown_forfeit": no(low.rlike(r"\bover\s+unknown\s*\(\s*for\.\s*\)")), "is_forfeit": no(forfeit), "is_varsity": no(varsity),
    })
    side = F.when(F.col("me_before") > F.col("me_after"), "W").when(F.col("me_before") < F.col("me_after"), "L").otherwise("U")
    outcome = (
        F.when(F.col("is_bye") == 1, "bye").when(F.col("is_exhibition") == 1, "U").when(F.col("is_tie") == 1, "T")
        .when(F.col("is_unknown_forfeit") == 1, "W").otherwise(side)
    )
    return df.withColumns({"outcome": outcome, "counts_in_record": 1 - F.greatest("is_bye", "is_exhibition")})


def clean_name(name: Column) -> Column:
    """Without a trailing bracket and suffix."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\s*\([^)]*\)\s*$", ""), SUFFIX, ""))


def last_name(name: Column) -> Column:
    """The last word of a clean name, with the particles before it."""
    three, two = last_of(name, " ", 3), last_of(name, " ", 2)
    return (
        F.when(three.rlike(rf"(?i)^(?:{'|'.join(PARTICLES_2)})\s+\S+$"), three)
        .when(two.rlike(rf"(?i)^(?:{'|'.join(PARTICLES_1)})\s+\S+$"), two).otherwise(last_of(name, " "))
    )


def first_name(name: Column) -> Column:
    """What stands before the last name, or nothing."""
    return F.trim(F.substr(name, F.lit(1), F.length(name) - F.length(last_name(name))))


def opponent_from_line(line: Column, name: Column) -> Column:
    """The name on the side of " over " that does not hold this athlete's; null if neither holds it."""
    at = F.instr(line, OVER)
    before, after = F.substr(line, F.lit(1), at - 1), F.substr(line, at + len(OVER))
    of = lambda part: F.trim(last_of(F.substring_index(part, " (", 1), " - "))
    return F.when(at == 0, None).when(F.lower(before).contains(F.lower(name)), of(after)).when(F.lower(after).contains(F.lower(name)), of(before))


def team_after(line: Column, name: Column) -> Column:
    """The first bracket after a name in the line; null for three characters or fewer."""
    at = F.instr(line, name)
    team = F.trim(F.regexp_extract(F.substr(line, at + F.length(name)), r"\(([^)]*)\)", 1))
    return F.when((at > 0) & (F.length(team) > 3), team)


def event_type(event: Column) -> Column:
    return F.when(F.lower(event).contains("vs"), "dual").when(event.isNotNull(), "tournament").otherwise("other")


def parse_list_name(name: Column) -> tuple[Column, Column]:
    """First and last name of "Last, First" or "First Last"; one word is a last name."""
    n = clean_name(name)
    comma = n.contains(",")
    first = F.when(comma, F.trim(F.substring_index(n, ",", -1))).otherwise(first_name(n))
    last = F.when(comma, F.trim(F.substring_index(n, ",", 1))).otherwise(last_name(n))
    return F.when(first != "", first), F.when(last != "", last)


def parse_record(text: Column) -> tuple[Column, Column, Column]:
    """Wins, losses and win share (3 places) of "12-3"; nulls for other text."""
    p = r"^\s*(\d{1,4})-(\d{1,4})\s*$"
    wins, losses = (F.when(text.rlike(p), F.regexp_extract(text, p, i).try_cast("int")) for i in (1, 2))
    return wins, losses, F.when(wins + losses > 0, F.round(wins / (wins + losses), 3))


def bout_index(line: Column) -> Column:
    """A number for a bout whatever its score: brackets that hold digits are left out, then h = 31 h + code, modulo 2 ** 32."""
    text = F.lower(F.trim(F.regexp_replace(one_line(line), r"\s*\([^)]*\d[^)]*\)", "")))
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: (h * 31 + c) % (1 << 32))
