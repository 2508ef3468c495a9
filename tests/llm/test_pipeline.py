"""The pipeline's stages on the smallest tables, each judged on its own input."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline
from boutlake.llm.common import materialize, table
from boutlake.llm.line_dedup import op8_line_dedup
from boutlake.llm.mixing import op4_source_mixing
from boutlake.llm.quality_classifier import op10_quality_classifier

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "stage")
        kept.append((name, docs, out))
        if stage is not corpus_pipeline.best_fit_packing:
            assert out.columns == docs.columns, name
        docs = out
    (_, raw, good), (_, _, lines), (_, before, near), (_, _, mixed), (_, _, packed) = kept
    wanted = {r.doc_id for r in op10_quality_classifier(raw, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.select("doc_id").collect()} == wanted and 0 < len(wanted) < raw.count()
    digests = {r.doc_id: r.kept_sha256 for r in op8_line_dedup(good).collect()}
    assert {r.doc_id: r.s for r in lines.select("doc_id", F.sha2("text", 256).alias("s")).collect()} == digests
    groups = {c for _, _, c in brute.simhash([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in near.select("doc_id").collect()) == sorted(groups)
    taken = {r.doc_id: r.taken for r in op4_source_mixing(near).where("taken > 0").collect()}
    held = {}
    for r in mixed.collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert held == taken
    rows = packed.collect()
    n = brute.sequences([(r.length, r.sequence_id, r.offset) for r in rows])
    assert n == -(-sum(r.length for r in rows) // 2048)
    assert sum(1 for r in rows if r.piece == 0) == mixed.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
