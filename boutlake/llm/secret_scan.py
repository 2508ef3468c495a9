"""Secrets in texts, weighed by how many repositories and owners share them.

Patterns give spans: assignments, access keys, hex runs, and mixed tokens that only count if they are
rare. The hash of each value is aggregated over the whole corpus: in how many distinct repositories
(documents, unless a column is named) and by how many distinct owners (sources) it occurs. A value of few
owners and few repositories looks live; one that many owners hold, or that one owner repeats in many
repositories, is an example that people copy. Base spans stay either way, with the verdict beside them; a
token becomes a span only if it looks live and overlaps no base span.

DataFrame functions throughout. One pass reads the texts and keeps, of each match, its kind, its value and
the lengths before and of it, written once. Places are running sums over the matches of a document, so a
text costs in proportion to its matches. Counts of distinct owners combine before each shuffle, and the
join with them leaves a value that very many documents share to adaptive skew handling.

A null text is empty, and so is a text without matches: no spans. Null owners and repositories count as
one each; doc_id may be null and of any type; repeated rows each get their result; very long texts are
read whole; extra columns are left out, whatever their names. No rows give no rows. Spans are in code
points, end exclusive, of whole matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.llm.common import materialize

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: A run of the class that is long enough starts where the run does, so lengths may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
TOKEN = "[A-Za-z0-9+/_=-]{24,}"
#: Kinds in order: name, pattern, group of the value, least length of the value.
KINDS = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16), ("token", TOKEN, 0, 24))
#: Most owners and most repositories of a value that looks live.
OWNERS = 2
REPOSITORIES = 8


def _matches(text: Column, rank: int) -> Column:
    """Matches of a kind in order: code points since the match before, code points of the match, its value."""
    _, pattern, group, _ = KINDS[rank]
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    rows = F.transform(F.arrays_zip(between.alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("size"), value.alias("value")), lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("nth"), x["gap"].alias("gap"), x["size"].alias("size"), x["value"].alias("value")))
    rows = F.filter(rows, lambda x: x["size"].isNotNull())
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<rank:int,nth:int,gap:int,size:int,value:string>>"))


def _placed(found: DataFrame) -> DataFrame:
    """row, owner, repository, rank, start, end, hash of each span: matches whose value is long enough, tokens that no base span touches."""
    each = found.select("row", "owner", "repository", F.explode("matches").alias("m")).select("row", "owner", "repository", "m.*")
    ahead = Window.partitionBy("row", "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(ahead).cast("int")).withColumn("start", F.col("end") - F.col("size"))
    least = F.element_at(F.array(*(F.lit(k[3]) for k in KINDS)), F.col("rank") + 1)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    each = each.where((F.length("value") >= least) & ((F.col("rank") < 3) | mixed))
    base = F.col("rank") < 3
    # Both frames run from one end, so each is a single pass over a document's spans.
    before = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.col("start").desc(), "rank").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumns({"upto": F.max(F.when(base, F.col("end"))).over(before), "next": F.min(F.when(base, F.col("start"))).over(after)})
    apart = (F.coalesce("upto", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return each.where(base | apart).select("row", "owner", "repository", "rank", "start", "end", F.md5("value").alias("hash"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str | None = None, most_owners: int = OWNERS, most_repositories: int = REPOSITORIES) -> DataFrame:
    """doc_id, spans for each row of docs; spans: start, rank (of the kind), end, value hash, n_owners, n_repositories, live."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        "doc_id", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce((F.col(repository) if repository else F.col("doc_id")).cast("string"), F.lit("")).alias("repository"), F.concat(*(_matches(text, i) for i in range(4))).alias("matches"),
    )
    # Written before the ids of rows are used, so that they are the same wherever they are read.
    found = materialize(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", "matches"), "candidates")
    each = _placed(found.where(F.size("matches") > 0))
    shared = each.groupBy("hash").agg(F.countDistinct("owner").alias("n_owners"), F.countDistinct("repository").alias("n_repositories"))
    live = (F.col("n_owners") <= most_owners) & (F.col("n_repositories") <= most_repositories)
    judged = each.drop("owner", "repository").join(shared, "hash").withColumn("live", live)
    judged = judged.where((F.col("rank") < 3) | F.col("live")).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "hash", "n_owners", "n_repositories", "live"))).alias("spans"))
    rest = found.select("row", "doc_id").join(judged, "row", "left")
    return rest.select("doc_id", F.coalesce("spans", F.array().cast(judged.schema["spans"].dataType)).alias("spans"))


def op3_secret_scan(documents: DataFrame) -> DataFrame:
    """Spans of every document as text, and how many of them look live or shared; nulls, empty texts and repeats as in the module."""
    spans = scan_secrets(documents)
    base = F.filter("spans", lambda x: x["rank"] < 3)
    name = lambda x: F.element_at(F.array(*(F.lit(k[0]) for k in KINDS)), x["rank"] + 1)
    text = lambda rows: F.array_join(F.transform(rows, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("spans", lambda x: x["rank"] == i)).cast("long")
    return spans.select(
        "doc_id", *(count(i).alias(f"n_{KINDS[i][0]}") for i in range(3)), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"), F.size(F.filter("spans", lambda x: ~x["live"])).cast("long").alias("n_shared"),
    )


def _kind_sql(rank: int) -> str:
    name, pattern, group, least = KINDS[rank]
    pattern = pattern.replace("'", "''")
    mixed = " AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')" if rank == 3 else ""
    return f"""k{rank} AS (SELECT row, doc_id, owner, {rank} AS rank, '{name}' AS kind, s AS start, s + length(w) AS "end", v FROM (
  SELECT row, doc_id, owner, v, w, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ws[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM (
    SELECT row, doc_id, owner, ws, regexp_split_to_array(text, '{pattern}') AS gaps, unnest(ws) AS w, unnest(regexp_extract_all(text, '{pattern}', {group})) AS v, generate_subscripts(ws, 1) AS i
    FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS ws FROM d)))
  WHERE length(v) >= {least}{mixed})"""


OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
{", ".join(_kind_sql(i) for i in range(4))},
b AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2),
c AS (SELECT * FROM b UNION ALL SELECT * FROM k3 WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.row = k3.row AND b.start < k3."end" AND k3.start < b."end")),
o AS (SELECT v, count(DISTINCT owner) <= {OWNERS} AND count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) <= {REPOSITORIES} AS live FROM c GROUP BY v),
j AS (SELECT c.*, live, kind || ':' || start || ':' || "end" AS t FROM c JOIN o USING (v) WHERE rank < 3 OR live),
a AS (SELECT row, count(*) FILTER (WHERE rank = 0) AS n0, count(*) FILTER (WHERE rank = 1) AS n1, count(*) FILTER (WHERE rank = 2) AS n2,
  string_agg(t, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base, string_agg(t, ',' ORDER BY start, rank) AS spans,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_shared FROM j GROUP BY row)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared FROM d LEFT JOIN a USING (row)
"""
