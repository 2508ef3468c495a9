"""Markup into events for an HTMLParser, and tables through Arrow into the rows that Python finds in a column of them."""

from __future__ import annotations

import html.parser
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows that a task holds as Python values before they leave it.
ROWS_AT_ONCE = 4096

# Tags whose content is markup like any other, in text without comments, declarations or a "<" on its own: there each
# match is an event that HTMLParser would give too. Everything else goes through HTMLParser itself.
_SPACE = r"[ \t\n\r\f]"
_NAMES = "t(?:[dhr]|able|body|foot|head)|[abipu]|[ou]l|li|[bh]r|em|h[1-6]|div|s(?:mall|pan|trong|u[bp])|center|font|img"
_ATTRIBUTE = rf"""{_SPACE}+[a-z][a-z0-9_:-]*+(?:=(?:"[^"<>]*+"|'[^'<>]*+'|[a-z0-9_.%-]++(?!/)))?"""
_EVENT = re.compile(rf"<({_NAMES})((?:{_ATTRIBUTE})*+)({_SPACE}*+/)?{_SPACE}*+>|</({_NAMES}){_SPACE}*+>|([^<]++)", re.I | re.A)
_PLAIN = re.compile(rf"(?:<(?:{_NAMES})(?:{_ATTRIBUTE})*+(?:{_SPACE}*+/)?{_SPACE}*+>|</(?:{_NAMES}){_SPACE}*+>|[^<]++)*+", re.I | re.A)
_PARTS = re.compile(r"""([a-z][a-z0-9_:-]*+)(?:(=)(?:"([^"]*)"|'([^']*)'|([a-z0-9_.%-]++)))?""", re.I | re.A)
# Any tag of plain markup; one that opens a link, and what follows before the next that opens or ends one.
_TAG = re.compile(r"<[^>]*+>")
_LINK = re.compile(rf"<a(?={_SPACE}|[/>])([^>]*+)>([^<]*+(?:<(?!/?a(?:{_SPACE}|[/>]))[^>]*+>[^<]*+)*+)", re.I | re.A)
# Character references of attributes have rules of their own in later versions of Python.
_unescape_value = getattr(html.parser, "_unescape_attrvalue", html.unescape)


@lru_cache(maxsize=4096)  # most are those of other rows or pages again
def _attributes(text: str) -> list[tuple[str, str | None]]:
    found = []
    for name, given, double, single, bare in _PARTS.findall(text):
        value = double or single or bare
        found.append((name.lower(), (_unescape_value(value) if "&" in value else value) if given else None))
    return found


def plain_links(markup: str | None) -> Iterator[tuple[dict[str, str | None], str]] | None:
    """Attributes and text of each link of plain markup, as its events would give them; None for other markup."""
    return _plain_links(markup or "") if _PLAIN.fullmatch(markup or "") else None


def _plain_links(markup: str) -> Iterator[tuple[dict[str, str | None], str]]:
    for attributes, text in _LINK.findall(markup):
        if attributes.rstrip(" \t\n\r\f").endswith("/"):  # closed at once
            text = ""
        elif "<" in text:
            text = "".join(map(html.unescape, _TAG.split(text)))
        elif "&" in text:
            text = html.unescape(text)
        yield dict(_attributes(attributes)), text


def feed(parser: html.parser.HTMLParser, markup: str | None) -> None:
    """The events of a whole markup, as parser.feed and parser.close give them; plain markup without their cost."""
    for _ in feeding(parser, markup):
        pass


def feeding(parser: html.parser.HTMLParser, markup: str | None) -> Iterator[None]:
    """feed, stopping before each row of a table in plain markup, so that the caller may take what the parser has found."""
    if not markup:
        return
    if not _PLAIN.fullmatch(markup):
        parser.feed(markup)
        parser.close()
        return
    start, end, data = parser.handle_starttag, parser.handle_endtag, parser.handle_data
    for m in _EVENT.finditer(markup):
        opened, attributes, closed, ended, text = m.groups()
        if text is not None:
            data(html.unescape(text) if "&" in text else text)
        elif opened is not None:
            opened = opened.lower()
            if opened == "tr":
                yield
            start(opened, _attributes(attributes) if attributes else [])
            if closed is not None:
                end(opened)
        else:
            end(ended.lower())


def _made(batch: pa.RecordBatch, at: list[int], rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with the other columns of the batch's rows that they come from, in batches."""
    n = len(batch.schema) - 1
    for i in range(0, len(rows), ROWS_AT_ONCE):
        index = pa.array(at[i : i + ROWS_AT_ONCE], pa.int64())
        made = [pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + ROWS_AT_ONCE], strict=True), list(schema)[n:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(k).take(index) for k in range(n)] + made, schema.names)


def rows_of(df: DataFrame, column: str, found: Callable[..., Iterator[tuple]], kind: str, with_column: str | None = None) -> DataFrame:
    """df without column, its rows once for each tuple (of the columns of kind) that found gives for the value of column.

    with_column: another one, whose value found takes too. A task holds ROWS_AT_ONCE tuples at a time, however many
    found gives for a value or values come in a batch.
    """
    kept = [f for f in df.schema if f.name != column]
    names, schema = [f.name for f in kept], StructType([*kept, *StructType.fromDDL(kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)
        for batch in batches:
            at, rows = [], []
            inputs = [batch.column(len(names)), *([batch.column(names.index(with_column))] if with_column else [])]
            for i, values in enumerate(zip(*inputs, strict=True)):
                for row in found(*(v.as_py() for v in values)):
                    rows.append(row)
                    at.append(i)
                    if len(rows) >= ROWS_AT_ONCE:
                        yield from _made(batch, at, rows, types)
                        at, rows = [], []
            yield from _made(batch, at, rows, types)

    return df.select(*names, column).mapInArrow(run, schema)
