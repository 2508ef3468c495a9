"""Very long texts and clashing names through the operators and the pipeline's stages."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boutlake.llm import line_dedup, mixing, quality_rules, secret_scan, simhash, substring_dedup
from boutlake.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long(spark):
    r = random.Random(17)
    words = [f"v{i}" for i in range(3000)]
    passage = " ".join(r.choices(words, k=70))
    texts = [" ".join(r.choices(words, k=60_000)) + " " + passage, passage + " short", "same " * 20_000, "\n".join(f"line {i % 700} of it" for i in range(9000)), "x" * 300_000,
             " ".join(f"token={i:016x}" if i % 2 else f"AKIA{i:016X}" for i in range(3000)), "", None]
    return spark.createDataFrame([(10 - i, t, "s", "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string").repartition(3).cache()


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_substring_dedup(long):
    got = sorted(tuple(r) for r in substring_dedup.op2_substring_dedup(long).collect())
    assert got == sorted(brute.substring_dedup(pairs(long))) and {i: n for i, _, n, _ in got}[10] == 70


def test_secret_scan(long):
    got = {r.doc_id: r for r in secret_scan.op3_secret_scan(long).collect()}
    for i, t in pairs(long):
        spans = brute.secrets(t or "")
        counts = [sum(k == kind for k, *_ in spans) for kind in ("assign", "access", "hex")]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == counts
        assert got[i].base_sha256 == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode())
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(got[i].spans.split(","))


def test_quality_counts(long):
    assert sorted(tuple(r)[:7] for r in quality_rules.op5_quality_rules(long).collect()) == sorted(brute.quality_base(pairs(long)))


def test_simhash(long):
    assert sorted(tuple(r) for r in simhash.op9_simhash_near_dedup(long).collect()) == sorted(brute.simhash(pairs(long)))


def test_lines(long):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(long).collect()}
    assert (got[7].n_lines, got[7].n_removed, got[7].text) == (9000, 8300, "\n".join(f"line {i} of it" for i in range(700)))


def test_mixing(long):
    got = {r.doc_id: r for r in mixing.op4_source_mixing(long).collect()}
    assert {i: r.size for i, r in got.items()} == {i: len(brute.words(t)) for i, t in pairs(long)}
    assert abs(sum(r.taken for r in got.values()) - got[10].target) <= 0.5 and all(r.taken <= 2 * r.size for r in got.values())


def test_stages_keep_odd_rows_and_clashing_columns(spark):
    names = "row key __key __doc __spans doc h y place shard score bucket fp line window spans n t w text_key size taken target source_size __row component_id bin".split()
    docs = table(spark, SF, "documents").withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    odd = docs.limit(1).withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in docs.columns})
    odd = odd.unionByName(odd.withColumn("doc_id", F.lit(-1).cast("long"))).unionByName(odd.withColumns({"doc_id": F.lit(-2).cast("long"), "text": F.lit("")}))
    docs = materialize(docs.unionByName(odd).unionByName(docs.limit(3)), "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), "odd-stage")
        assert out.columns == docs.columns, name
        assert out.where(" OR ".join(f"`{n}` IS DISTINCT FROM concat('{n}', doc_id)" for n in names)).where("doc_id >= 0").count() == 0, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 0


def test_stages_of_empty_tables(spark):
    docs = materialize(table(spark, SF, "documents").limit(0), "none")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "none-stage")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
