"""Both classifiers against plain FTRL over features that are not hashed, and the quality classifier's own contract."""

import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from boutlake.llm import quality_classifier, toxicity
from boutlake.llm.common import materialize
from boutlake.llm.ftrl import MARKS, STEMS, Model


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = [f"word{k}" for k in range(60)] + ["Vile,", "scummy!", "a", "it's", "12", "3-4", "naïve", "$9", "longerword", "longerwords"]
    return [" ".join(r.choices(vocabulary, k=r.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("model", [Model(kind="skip", bits=26, alpha=0.5, epochs=3, positive=3.0, l1=0.3), Model(kind="shape", bits=26, alpha=0.5, l1=0.05, l2=0.1)])
def test_ftrl_against_a_plain_version(model):
    rows, labels = texts(1, 300), [int("Vile" in t or "$9" in t) for t in texts(1, 300)]
    rows, labels = [*rows, "", " "], [*labels, 0, 1]
    def features(t):
        return brute.skip_features(t, MARKS, STEMS) if model.kind == "skip" else brute.shape_features(t)

    want, bias = brute.ftrl([(features(t), y) for t, y in zip(rows, labels, strict=True)], model.l1, model.l2, model.alpha, model.beta, model.epochs, model.positive)
    at, w, b = model.train([t.encode() for t in rows], labels)
    assert len(at) == len(want) and np.allclose(sorted(w), sorted(want.values()), atol=1e-5) and abs(b - bias) < 1e-5
    dense = np.zeros(1 << model.bits)
    dense[at] = w
    held = [*texts(2, 50), ""]
    got = Model(kind=model.kind, bits=model.bits, at=at, weight=w, bias=b).scores(dense, [t.encode() for t in held])
    plain = [1 / (1 + np.exp(-bias - sum(want.get(f, 0) * v for f, v in features(t).items()))) for t in held]
    assert np.allclose(got, plain, atol=1e-5) and max(plain) - min(plain) > 0.2


def test_a_fit_takes_rows_in_hash_order(spark):
    data = [(i, t, int("Vile" in t)) for i, t in enumerate(texts(3, 200))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    model = Model(kind="skip", l1=0.3)
    order = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(model.seed), "doc_id", F.xxhash64("text"))).collect()}
    data.sort(key=lambda x: order[x[0]])
    at, w, b = model.train([t.encode() for _, t, _ in data], [y for *_, y in data])
    fitted = model.fitted(docs, labels, "toxic")
    assert fitted.at.tolist() == at[np.abs(w) > 1e-6].tolist() and np.allclose(fitted.weight, w[np.abs(w) > 1e-6]) and abs(fitted.bias - b) < 1e-12


def counted(path):
    """A model whose tasks leave files with the number of rows that they train on."""

    class Counted(Model):
        def learned(self, rows):
            with open(f"{path}/{os.getpid()}-{random.getrandbits(60)}", "w") as f:
                f.write(str(len(rows)))
            return Model.learned(self, rows)

    return Counted


@pytest.mark.parametrize("ids", ["id", "7L"])
def test_a_fit_stays_within_its_bound_of_rows(spark, tmp_path, ids):
    """Whether each row has an id of its own or one labelled id holds them all; equal rows of an id are one."""
    docs = spark.range(5000).selectExpr(f"{ids} AS doc_id", "concat('a b', id) AS text")
    docs = docs.unionAll(docs).unionAll(spark.sql("SELECT 7L AS doc_id, 'the same' AS text FROM range(3000)"))
    known = spark.range(5000).selectExpr("id AS doc_id", "1 AS toxic")
    fitted = counted(str(tmp_path))(kind="skip", max_train_rows=900, shard_bytes=900).fitted(docs, known, "toxic")
    rows = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert 500 < sum(rows) <= 900 and len(rows) > 4 and max(rows) < 400
    assert 0.5 < fitted.scored(docs.limit(1)).first().score <= 1


def test_weights_are_the_mean_over_shards(spark):
    data = [(i, t, int("Vile" in t)) for i, t in enumerate(texts(6, 300))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    model = Model(kind="skip", l1=0.3, shard_bytes=6000)
    n = -(-sum(len(t.encode()) for _, t, _ in data) // model.shard_bytes)
    place = {r[0]: (r[2], r[1]) for r in docs.select("doc_id", F.xxhash64(F.lit(7), "doc_id", F.xxhash64("text")).alias("p"), F.pmod(F.shiftrightunsigned("p", 30), F.lit(n))).collect()}
    dense, bias = np.zeros(1 << model.bits), 0.0
    for shard in range(n):
        rows = sorted((x for x in data if place[x[0]][0] == shard), key=lambda x: place[x[0]][1])
        at, w, b = model.train([t.encode() for _, t, _ in rows], [y for *_, y in rows])
        dense[at] += w / n
        bias += b / n
    fitted = model.fitted(docs, labels, "toxic")
    assert n > 2 and fitted.at.tolist() == np.flatnonzero(np.abs(dense) > 1e-6).tolist()
    assert np.allclose(fitted.weight, dense[fitted.at], atol=1e-9) and abs(fitted.bias - bias) < 1e-9


def test_quality_classifier(spark):
    r = random.Random(12)
    def text(y):
        words = r.choices([f"w{k}" for k in range(80)], k=40)
        return " ".join(words if y else [w if r.random() < 0.8 else "$$%9" for w in words])

    data = [(i, text(i % 3 > 0), int(i % 3 > 0)) for i in range(3000)]
    docs = spark.createDataFrame([(i, t, "s", 0.0, "p") for i, t, _ in data] + [(9000, None, None, None, None), (9001, "", None, None, None), (5, data[5][1], None, None, None), (None, "w1 w2", None, None, None)], "doc_id long, text string, y string, score double, place string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = quality_classifier.op10_quality_classifier(docs, labels).collect()
    assert len(rows) == 3004 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    got = {x.doc_id: x for x in rows}
    assert got[9000].score == got[9001].score and not got[None].held_out
    right = [got[i].predicted == y for i, _, y in data if got[i].held_out]
    assert len(right) > 800 and sum(right) / len(right) > 0.97
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {x.doc_id: x.score for x in quality_classifier.op10_quality_classifier(docs, flipped).collect()}
    assert again == {i: x.score for i, x in got.items()}
    model = quality_classifier.fit_quality(docs, labels.where("NOT coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, false)"))
    kept = model.accepted(docs, 0.5)
    assert kept.columns == docs.columns and kept.count() == sum(x.predicted for x in rows)
    none = spark.createDataFrame([], docs.schema)
    assert quality_classifier.op10_quality_classifier(none, labels).count() == 0 and quality_classifier.op10_quality_classifier(docs, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5


def test_very_long_texts_are_scored_whole(spark):
    """The word that decides stands at the end of a long text."""
    data = [(i, t + (" scummy" if i % 3 == 0 else ""), int(i % 3 == 0)) for i, t in enumerate(texts(4, 900))]
    data = [(i, t.replace("scummy!", "fine"), y) if not y else (i, t, y) for i, t, y in data]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    long = " ".join(f"x{i}" for i in range(400_000))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(materialize(spark.createDataFrame([(1, long), (2, long + " scummy")], "doc_id long, text string"), "long"), model).collect()}
    assert got[2] > got[1]
