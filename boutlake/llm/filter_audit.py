"""How five filters overlap, in every order of applying them.

A document's failures are one mask of five bits. Documents are counted by part, mask and labels first, so that at
most 32 rows a part are left; each contributes to the 80 edges of the subset lattice, an edge being a set of filters
already applied and the filter that comes next. The 600 steps of all 120 orders are paths along those edges and are
joined to their sums, so no document is counted once for each order. An order's share of a filter's removals is
the edge's removals times the orders that pass through that edge.

A text that stands under a smaller doc_id is found by its SHA-256 digest: digests are grouped with their least
doc_id, and rows meet that by digest and doc_id together, so copies of one text are spread over tasks. Counts come
before joins, so neither a frequent source nor rows repeated many times make one task large.

Null texts are empty and null sources the part of the empty string. A row without doc_id has no smaller copy, no label
and is no copy of a later one. Repeated rows are counted each; rows of one doc_id and text are not copies of each
other. Labels without doc_id are left out, and a document with several has the greatest of each. Very long
texts are read whole. Extra columns are left out, whatever their names. No rows give no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.llm.common import GAP

FILTERS = "ABCDE"
COPY = FILTERS.index("E")


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: few words, few distinct words, many capitals, symbols."""
    words = F.array_remove(F.split(text, GAP), "")
    # Inside a one-element transform, so that a text is split once.
    few = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) < 200, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(w)).cast("long") < 50 * F.size(w).cast("long"), 2).otherwise(0)), 0)
    capitals = 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text).cast("long")
    return few + F.when(capitals, 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters that they fail."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"))
    rows = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first")).where(F.col("doc_id").isNotNull())
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    copy = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << COPY).otherwise(0)
    return rows.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def edge_sums(counts: DataFrame) -> DataFrame:
    """part, applied (mask of filters), next (number of a filter) and the sums of that edge: 80 rows a part, zeros included."""
    n = len(FILTERS)
    edges = F.array(*(F.struct(F.lit(s).alias("applied"), F.lit(f).alias("next")) for f in range(n) for s in range(1 << n) if not s >> f & 1))
    rows = counts.select("*", F.explode(edges).alias("edge")).select("*", "edge.*")
    bit = F.expr("shiftleft(1, next)")
    passed, fails = F.col("mask").bitwiseAND(F.col("applied")) == 0, F.col("mask").bitwiseAND(bit) != 0

    def total(where: Column, of: str = "n") -> Column:
        return F.sum(F.when(where, F.col(of)).otherwise(0))

    return rows.groupBy("part", "applied", "next").agg(
        total(passed & ~fails).alias("kept"), total(passed & fails).alias("removed"), total(~passed & fails).alias("redundant"), total(F.col("mask") == bit).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"), total(passed & fails, "toxic").alias("toxic_lost"))


def audit_orders(edges: DataFrame) -> DataFrame:
    """One row for each part, order and step, from the sums of edges."""
    n = len(FILTERS)
    spark = edges.sparkSession
    paths = []
    for order in itertools.permutations(range(n)):
        applied = 0
        for step, f in enumerate(order, 1):
            paths.append(("".join(FILTERS[k] for k in order), step, applied, f))
            applied |= 1 << f
    # 600 rows, whatever the corpus.
    paths = spark.createDataFrame(paths, "filter_order string, step int, applied int, next int")
    through = F.col("removed") * F.element_at(F.array(*(F.lit(_orders_through(k)) for k in range(n))), F.bit_count("applied") + 1)
    # A filter has 16 edges in a part.
    shares = edges.withColumn("shapley", F.sum(through).over(Window.partitionBy("part", "next")))
    steps = shares.join(F.broadcast(paths), ["applied", "next"])
    return steps.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _orders_through(before: int) -> int:
    """Orders that apply a given set of so many filters and then a given one."""
    return math.factorial(before) * math.factorial(len(FILTERS) - 1 - before)


def op13_filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Kept, removed, redundant, unique failures, labels lost and Shapley sums of all orders of the five filters."""
    return audit_orders(edge_sums(failure_counts(documents, labels)))


OP13_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first_id < doc.doc_id THEN 'E' ELSE '' END AS fails
  FROM doc LEFT JOIN known ON doc.doc_id = known.doc_id GROUP BY ALL
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
step AS (
  SELECT o.filter_order, s.step, substr(o.filter_order, s.step, 1) AS f, substr(o.filter_order, 1, s.step - 1) AS before
  FROM (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5) o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step) s
), judged AS (
  SELECT part, filter_order, step, f, fails, n, good, toxic, contains(fails, f) AS bad, translate(before, fails, '') = before AS here
  FROM failed, step
), total AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN here AND NOT bad THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND bad THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN NOT here AND bad THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN here AND bad THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND bad THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM total
"""
