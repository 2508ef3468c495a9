"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the key -ln(u) / w, with u a hash of its id and text and w its quality weight, and documents
of a source are taken in key order until their sizes reach the source's budget of words. A budget beyond
the source's size takes complete epochs first and then a fraction in key order; the last document of the
fraction is taken for as many words as are left.

A source's running sum has two levels: buckets in key order, whose sums are added up first, then documents
within a bucket. Buckets are equal steps of the key's logarithm, as many to a factor of two as the source has
``BUCKET`` documents. The logarithm of an exponential key has a density of at most ln 2 / e = 0.26 to a factor
of two, and a weight only shifts it; so whatever the weights, a bucket is expected to hold at most about a
quarter of ``BUCKET`` documents. A source that holds most documents is spread over tasks, and text is read
once and never shuffled. Rows that repeat a source, id and text are one group with a count until the end, so
they do not crowd a bucket.

A null text has size 0, like one without words, and a very long one is read whole; null sources are one
source, last in order; a null id counts as the word null beside the text; ids keep their type. Repeated rows are documents
of their own. Ties in the key go by doc_id and the text's hash. A weight that is null or not above zero
counts as the least positive one, so its documents come last. One row a source passes through one task, which
places them and levels their targets; repeats are put in order among themselves by a window. Extra columns, whatever their names, are left
out of mix_sources and kept by mixed_documents. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.llm.common import GAP, WORD, materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
BUCKET = 10_000
LEAST_WEIGHT = 1e-9


def letter_share(text: Column) -> Column:
    """The default quality weight: the share of letters in the text, from 0.05 to 1.05."""
    t = F.coalesce(text, F.lit(""))
    return F.lit(0.05) + F.length(F.regexp_replace(t, r"[^\p{L}]+", "")) / F.greatest(F.length(t), F.lit(1))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes (source, source_size, n_docs) → with place and target, the words to take of each source.

    One row a source; weights repeat over the sources in order of code points. Sources whose share lies
    above ``most`` times their size stop there, and the others share what is left by weight: with sources
    sorted by cap over weight, one is capped if the level that is left before it reaches its cap.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("place", F.row_number().over(ordered).cast("long"))
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))).withColumn("cap", most * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("budget", share * F.sum("source_size").over(every))
        .withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("capped", F.col("cap") * F.col("heavy") <= (F.col("budget") - F.col("before")) * F.col("weight"))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0)))
        .withColumn("sharing", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every))
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("left") / F.col("sharing"))
    return rows.select("source", "source_size", "n_docs", "place", target.alias("target"))


def _mixed_groups(docs: DataFrame, weights: tuple[int, ...], share: float, most: int, quality: Column | None, seed: str) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, repeats, copies (complete, of each) and extra (words of further ones, of all repeats together)."""
    # Drawn by id and text, so that many texts under one id, or none, do not draw alike.
    drawn = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    drawn = F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double")
    u = (drawn + 1.0) / float(1 << 52)
    weight = letter_share(F.col("text")) if quality is None else F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(LEAST_WEIGHT))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", size.alias("size"), (-F.log(u) / weight).alias("key"))
    rows = materialize(rows.groupBy("source", "doc_id", "text_key").agg(F.first("size").alias("size"), F.min("key").alias("key"), F.count("*").alias("repeats")), "keys")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "of")
    goal = F.floor(F.col("target") + 0.5)
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.expr("CAST(floor(target + 0.5) AS BIGINT) div source_size"))).otherwise(0)
    targets = targets.withColumn("copies", copies.cast("long")).withColumn("rest", goal - F.col("copies") * F.col("source_size"))
    # Equal steps of the key's logarithm, finer where a source has more documents; keys of zero come first.
    bucket = F.floor(F.log2(F.greatest("key", F.lit(1e-300))) * F.ceil(F.col("n_docs") / BUCKET)).cast("long")
    rows = materialize(rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("bucket", bucket), "placed")
    words = F.col("size") * F.col("repeats")
    sums = rows.groupBy("place", "bucket").agg(F.sum(words).alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("place", "bucket", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("place", "bucket").orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(sums, ["place", "bucket"]).withColumn("before", F.col("ahead") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
    extra = F.greatest(F.lit(0), F.least(words, F.col("rest") - F.col("before")))
    return rows.select("doc_id", "text_key", "source", "size", "source_size", "target", "repeats", "copies", extra.cast("long").alias("extra"))


def _of_repeat(nth: Column) -> Column:
    """Of a group's extra words, those that its nth row (from 0) takes."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - nth * F.col("size"))).cast("long")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, quality: Column | None = None, seed: str = SEED) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies (complete) and extra (words of one more) for each row."""
    groups = _mixed_groups(docs, weights, share, most, quality, seed)
    # A group of very many repeats is dealt out in pieces, so that no task writes all of its rows.
    pieces = groups.withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"(repeats - 1) div {BUCKET}"))))
    many = pieces.where("repeats > " + str(BUCKET)).repartition(F.xxhash64("doc_id", "text_key", "source", "piece"))
    rows = pieces.where("repeats <= " + str(BUCKET)).unionByName(many)
    first = F.col("piece") * BUCKET
    rows = rows.withColumn("nth", F.explode(F.sequence(first, F.least(first + BUCKET, F.col("repeats")) - 1)))
    return rows.select("doc_id", "text_key", "source", "size", "source_size", "target", "copies", _of_repeat(F.col("nth")).alias("extra"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, quality: Column | None = None, seed: str = SEED) -> DataFrame:
    """The rows of the mix, with the columns of docs: complete copies, then the cut one.

    A cut text is its first words joined by single spaces. Documents without words are left out.
    """
    picks = _mixed_groups(docs, weights, share, most, quality, seed).where("size > 0 AND (copies > 0 OR extra > 0)")
    picks = picks.select(F.col("doc_id").alias("id"), "text_key", F.col("source").alias("of"), "size", "repeats", "copies", "extra")
    # The caller's columns travel as one struct, so that none of them meets the names used here.
    rows = docs.where(F.col("text").isNotNull()).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.join(picks, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("text_key")) & F.col("row.source").eqNullSafe(F.col("of")))
    # Only rows that repeat a source, id and text need an order among themselves.
    nth = F.row_number().over(Window.partitionBy("of", "id", "text_key").orderBy(F.xxhash64(F.to_json("row")))) - 1
    names = rows.columns
    rows = rows.where("repeats = 1").withColumn("nth", F.lit(0)).unionByName(rows.where("repeats > 1").withColumn("nth", nth).select(*names, "nth"))
    extra = _of_repeat(F.col("nth"))
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("copies").cast("int"))
    rows = rows.withColumn("take", F.explode(F.concat(whole, F.when(extra > 0, F.array(extra)).otherwise(F.array().cast("array<bigint>")))))
    words = F.filter(F.split("row.text", GAP), lambda w: w != "")
    text = F.when((F.col("take") < 0) | (F.col("take") == F.col("size")), F.col("row.text")).otherwise(F.array_join(F.slice(words, 1, F.col("take").cast("int")), " "))
    return rows.select(*(text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op4_source_mixing(documents: DataFrame) -> DataFrame:
    """Words taken of every document, all its copies together; nulls, texts without words and repeats as in the module."""
    return mix_sources(documents).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("extra")).alias("taken"))


OP4_SQL = """
WITH d AS (SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
  -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 1.0::DOUBLE) / 4503599627370496.0::DOUBLE)
  / (0.05::DOUBLE + length(regexp_replace(coalesce(text, ''), '[^\\p{L}]+', '', 'g'))::DOUBLE / greatest(length(coalesce(text, '')), 1)) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM s),
b AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS budget,
  coalesce(CAST(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before,
  CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS heavy FROM w
  WINDOW o AS (ORDER BY cap::DOUBLE / weight, place)),
c AS (SELECT *, cap * heavy <= (budget - before) * weight AS capped FROM b),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE weight *
  (budget - coalesce(CAST(sum(CASE WHEN capped THEN cap END) OVER () AS BIGINT), 0)) / CAST(sum(CASE WHEN NOT capped THEN weight END) OVER () AS BIGINT) END AS target FROM c),
g AS (SELECT *, CASE WHEN source_size > 0 THEN least(2, CAST(floor(target + 0.5) AS BIGINT) // source_size) ELSE 0 END AS copies FROM t),
r AS (SELECT d.doc_id, size, source_size, target, copies, CAST(floor(target + 0.5) AS BIGINT) - copies * source_size
  - coalesce(CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS rest
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(copies * size + greatest(0, least(size, rest)) AS BIGINT) AS taken FROM r
"""
