"""Readers of CSV lists, HTML pages and ranking documents."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urlsplit
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlake.operators.rankings import ranking_entries, week_of
from boutlake.sources.markup import feeding, rows_of
from boutlake.sources.pages import lateral, row_source

# Links in which nothing is encoded, whose parameters are what they look like.
_PLAIN_LINK = re.compile(r"[\w./:-]*\?([\w=.-]+(?:&[\w=.-]+)*)", re.A)


def scan(spark: SparkSession, path: str, *predicates: Column) -> DataFrame:
    """A Parquet table under all predicates given; each reaches the scan."""
    df = spark.read.parquet(path)
    for p in predicates:
        df = df.where(p)
    return df


def page(df: DataFrame, order: list[str], start: int, size: int) -> DataFrame:
    """Rows start to start + size in a total order."""
    return df.orderBy(*order).offset(start).limit(size)


def read_links(spark: SparkSession, path: str, column: str = "name_link", start_at: int = 0, limit: int | None = None) -> DataFrame:
    """A column of a CSV file with header, by name without regard to case; blank values are left out.

    start_at and limit count the values that are left, in the file's order.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    df = df.select(F.trim(F.col(column)).alias(column)).where(F.col(column) != "")
    df = df.offset(start_at) if start_at else df
    return df if limit is None else df.limit(limit)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of CSV files with header; a quoted line break does not end a row."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').count()


def list_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Table, place, name and type of every column of a database's tables."""
    rows = [(t.name, i, c.name, c.dataType) for t in spark.catalog.listTables(database) for i, c in enumerate(spark.catalog.listColumns(t.name if t.isTemporary else f"{t.database}.{t.name}"), 1)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


class _Rows(HTMLParser):
    """Cells of table rows, with the links in each row."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[list[str], list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.rows.append(([], []))
        elif tag in ("td", "th") and self.rows:
            self.cell = []
        elif tag == "a" and self.rows:
            self.rows[-1][1].append(dict(attrs).get("href") or "")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1][0].append(" ".join("".join(self.cell).replace("\xa0", " ").split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_rows(markup: str | None) -> Iterator[tuple[list[str], list[str]]]:
    """Cells and links of each row that has any; those of plain markup one after another, other markup is read whole before."""
    parser = _Rows()
    for _ in feeding(parser, markup):
        yield from (r for r in parser.rows if r[0] or r[1])
        parser.rows.clear()
    yield from (r for r in parser.rows if r[0] or r[1])


def _grid(markup: str | None) -> Iterator[tuple]:
    for i, (cells, links) in enumerate(html_rows(markup), 1):
        yield i, cells, links


def grid_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """pages (key, html) → key, row_index (from 1), cells, links of every table row."""
    return rows_of(pages.select(key, "html"), "html", _grid, "row_index long, cells array<string>, links array<string>")


def link_id(links: list[str], name: str, other_than: int | None = None) -> int | None:
    """The first number given for a parameter in the links, other than one known."""
    for link in links:
        text = html.unescape(link)
        plain = _PLAIN_LINK.fullmatch(text)
        values = [v for k, _, v in (x.partition("=") for x in plain[1].split("&")) if k == name] if plain else parse_qs(urlsplit(text).query).get(name, [])
        for value in values:
            if value.isdigit() and int(value) != other_than:
                return int(value)
    return None


def _bouts(markup: str | None, who: int | None) -> Iterator[tuple]:
    lines = [(c, a) for c, a in html_rows(markup) if len(c) == 4 and c[0].lower() != "date"]
    for i, (c, a) in enumerate(lines, 1):
        yield i, c[0], c[1], c[2], c[3], link_id(a, "wrestlerId", who)


def bout_rows(pages: DataFrame) -> DataFrame:
    """pages (wrestler_id, html; cells date, event, weight, details) → bout lines in page order.

    The opponent is the first athlete linked in a row other than the page's own; rows of other widths
    are headings.
    """
    kind = "match_order int, date_raw string, event string, weight_category string, raw_details string, opponent_id long"
    return rows_of(pages.select(F.col("wrestler_id").cast("long"), "html"), "html", _bouts, kind, with_column="wrestler_id")


def document_lines(data: bytes) -> list[str]:
    """Paragraphs of a DOCX file; tabs in runs stay."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    space = root.tag.partition("}")[0] + "}"
    text = lambda e: {f"{space}t": e.text or "", f"{space}tab": "\t"}.get(e.tag, "")
    return ["".join(text(e) for r in p.iter(f"{space}r") for e in r).strip() for p in root.iter(f"{space}p")]


@row_source("line_no int, line string")
def docx_lines(content: bytes | None) -> Iterator[tuple]:
    """Paragraphs of a DOCX file's bytes, numbered."""
    yield from enumerate(document_lines(content) if content is not None else [], 1)


def read_rankings(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all DOCX files under path whose names hold a week; see ranking_entries."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select(F.substring_index("path", "/", -1).alias("source_file"), "content")
    files = files.withColumn("week", week_of(F.col("source_file"))).where("week IS NOT NULL")
    return ranking_entries(lateral(files, docx_lines, "content"))
