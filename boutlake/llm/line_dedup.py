"""Removal of repeated passages of three lines.

Each three consecutive lines of a document hash to 128 bits. Of windows that occur more than once in
the corpus the first, by doc_id and then line, stays as it is; all lines that later ones cover go.
Covered positions are merged into intervals before the text is cut. Windows are judged on the input.

Everything is a DataFrame operation: counts combine before they are shuffled, and the joins on hash and
on document leave oversized partitions to adaptive skew handling.

Lines end at each newline and compare exactly; windows without a word in them do not count. Texts of
fewer than three lines, null texts and rows without doc_id stay as they are. Rows of one doc_id and text
are one document. A passage that repeats inside one document loses its later copies as well. Very long
texts are read whole. doc_id may be of any type that has an order. Extra columns stay as they are, whatever
their names. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 3
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _windows(lines: Column, size: int) -> Column:
    """Position and two hashes of each window of size lines."""
    of = lambda i: F.slice(lines, i + 1, size)
    return F.when(F.size(lines) >= size, F.filter(
        F.transform(F.sequence(F.lit(0), F.size(lines) - size), lambda i: F.struct(
            i.alias("at"), F.xxhash64(of(i)).alias("h1"), F.xxhash64(F.lit(1), of(i)).alias("h2"), F.exists(of(i), lambda x: x.rlike(_HAS_WORD)).alias("full"))),
        lambda w: w["full"]))


def repeated_line_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, text_key, spans: merged ranges (begin, end) of lines that later copies of a window cover."""
    w = (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_key"), F.split("text", "\n", -1).alias("lines"))
        .select("doc_id", "text_key", F.explode(_windows(F.col("lines"), size)).alias("w"))
        .select("doc_id", "text_key", "w.at", "w.h1", "w.h2")
    )
    place = F.struct("doc_id", "text_key", "at")
    first = w.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    later = w.join(first, ["h1", "h2"]).where(place > F.col("first")).select("doc_id", "text_key", "at").distinct()
    by_doc = Window.partitionBy("doc_id", "text_key").orderBy("at")
    island = F.sum(F.when(F.col("at") - F.lag("at").over(by_doc) > size, 1).otherwise(0)).over(by_doc)
    merged = later.withColumn("island", island).groupBy("doc_id", "text_key", "island").agg(F.min("at").alias("begin"), (F.max("at") + size).alias("end"))
    return merged.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def dedup_lines(docs: DataFrame, size: int = SIZE, counts: bool = True) -> DataFrame:
    """docs with text cut and, if asked for, n_lines and n_removed (long) after or in place of columns so named."""
    spans = repeated_line_spans(docs, size).select(F.col("doc_id").alias("of"), F.col("text_key").alias("key"), "spans")
    # The caller's columns travel as one struct, so that none of them meets the names used here.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.join(spans, (F.col("row.doc_id") == F.col("of")) & (F.xxhash64("row.text") == F.col("key")), "left")
    # A column of its own: inside the functions below an expression would be split again for each interval.
    rows, lines = rows.withColumn("lines", F.split("row.text", "\n", -1)), F.col("lines")
    # What stays lies before the first interval, between one and the next, and after the last.
    n = F.size("spans")
    gaps = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("spans"), i - 1)["end"]).alias("a"),
        F.when(i == n, F.size(lines)).otherwise(F.get(F.col("spans"), i)["begin"]).alias("b")))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"])))
    gone = F.aggregate("spans", F.lit(0), lambda s, x: s + x["end"] - x["begin"])
    hit = F.col("spans").isNotNull()
    cut = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("row.text")).alias("text")
    added = {}
    if counts:
        added = {
            "n_lines": F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_removed": F.when(hit, gone).otherwise(0).cast("long"),
        }
    own = [cut if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in added]
    return rows.select(*own, *(added[c].alias(c) for c in added))


def op8_line_dedup(documents: DataFrame) -> DataFrame:
    """Lines, lines removed and the hash of what stays of every document; nulls, short texts and repeats as in the module."""
    return dedup_lines(documents.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, text, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM d WHERE doc_id IS NOT NULL AND text IS NOT NULL),
w AS (SELECT doc_id, text, i, line AS a, lead(line) OVER p AS b, lead(line, 2) OVER p AS c FROM l WINDOW p AS (PARTITION BY doc_id, text ORDER BY i)),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(i) OVER o AS fi FROM w
      WHERE c IS NOT NULL AND regexp_matches(a || ' ' || b || ' ' || c, '[^\\x20\\x09-\\x0D]')
      WINDOW o AS (PARTITION BY a, b, c ORDER BY doc_id, i)),
x AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM f WHERE doc_id > fd OR i > fi),
k AS (SELECT l.doc_id, count(*) AS n, count(x.i) AS gone, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE x.i IS NULL), '') AS kept
      FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
