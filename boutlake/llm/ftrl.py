"""Logistic regression over hashed word n-grams, fitted with FTRL-proximal updates.

The fit reads a bounded sample of labelled rows (``Model.max_train_rows``): those whose hash of id and text lies
under a threshold, so each task picks its own. They are written once, equal rows of one id once, and dealt
into shards of about ``shard_bytes`` of text by the hash. Each shard runs its own pass of updates in hash order and
the weights are averaged in Spark, so neither the driver nor a task holds more than that, however long texts are.
The L1 term leaves few weights other than zero; only those travel to the scoring tasks, which read every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutlake.llm.common import BYTE_VALUES, SLICE_BYTES, Words, binary_texts, materialize, mixed, slices

#: Left out of words for the "skip" kind, so that "word," is "word".
MARKS = b".,;:!?\"'()[]{}*#$%&|<>-_"
#: Bytes of the stems of longer words that the "skip" kind takes.
STEMS = (4, 5, 6)
#: For shapes: a number for each byte that is not a letter, the same for all digits; 0 for letters and beyond ASCII.
SHAPES = np.where([chr(i).isalpha() or i >= 128 for i in range(256)], np.uint64(0), BYTE_VALUES)
SHAPES[48:58] = SHAPES[48]
#: Multipliers that tell the kinds of features apart.
KINDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)

#: Weights are averaged as multiples of one part of this.
_FIXED = float(1 << 36)


@dataclass(frozen=True)
class Model:
    """Parameters of a fit and, once fitted, its weights other than zero."""

    kind: str  # "skip": words, stems, bigrams and skip-grams; "shape": words, shapes, bigrams, repeats
    bits: int = 20
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    positive: float = 1.0  # weight of label 1
    shard_bytes: int = 40 << 20  # texts of one shard of the sample
    max_train_rows: int = 30_000
    seed: int = 7
    at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document number and feature number of every feature in these texts, and words per document."""
        skip = self.kind == "skip"
        words = Words([x.lower().translate(None, MARKS) if skip else x.lower() for x in texts])
        h, doc = words.hashes(), words.doc
        low = np.uint64(64 - self.bits)
        found = [(doc, mixed(h * KINDS[0]) >> low)]
        near = doc[1:] == doc[:-1]
        a, b = h[:-1][near], h[1:][near]
        found.append((doc[1:][near], mixed(a * KINDS[2] + b) >> low))
        if skip:
            for most in STEMS:
                longer = words.ends - words.starts > most
                found.append((doc[longer], mixed(words.hashes(most)[longer] * KINDS[1]) >> low))
            far = doc[2:] == doc[:-2]
            found.append((doc[2:][far], mixed(h[:-2][far] * KINDS[3] + h[2:][far]) >> low))
        else:
            form = words.bags(SHAPES)
            found.append((doc, mixed(form * KINDS[1] + KINDS[4]) >> low))
            found.append((doc[1:][near], mixed(form[:-1][near] * KINDS[3] + mixed(form[1:][near])) >> low))
            found.append((doc[1:][near], mixed((a == b).astype(np.uint64) + KINDS[2]) >> low))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]).astype(np.int64), words.counts

    def value(self, count: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.ones(len(count)) if self.kind == "skip" else np.sqrt(count / n)

    def prepared(self, texts: list[bytes], labels: list[int]) -> list[tuple[np.ndarray, np.ndarray | float, int]]:
        """Feature numbers, their values and the label of each text."""
        rows = []
        for i, j in slices(texts):
            doc, at, n = self.features(texts[i:j])
            keys, counts = np.unique(doc << self.bits | at, return_counts=True)
            ends = np.searchsorted(keys, np.arange(j - i + 1) << self.bits)
            for k in range(j - i):
                s = slice(ends[k], ends[k + 1])
                x = 1.0 if self.kind == "skip" else self.value(counts[s], max(1, n[k])).astype(np.float32)
                rows.append(((keys[s] & ((1 << self.bits) - 1)).astype(np.int32), x, labels[i + k]))
        return rows

    def train(self, texts: list[bytes], labels: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        """Feature numbers and weights other than zero, and the bias, after all epochs over these rows in turn."""
        return self.learned(self.prepared(texts, labels))

    def learned(self, rows: list[tuple[np.ndarray, np.ndarray | float, int]]) -> tuple[np.ndarray, np.ndarray, float]:
        """As train, from prepared rows."""
        size = 1 << self.bits
        z, sq, bias_z, bias_sq = np.zeros(size + 1), np.zeros(size + 1), 0.0, 0.0

        def weights(z_at, sq_at):
            return np.where(np.abs(z_at) <= self.l1, 0.0, -(z_at - np.sign(z_at) * self.l1) / ((self.beta + np.sqrt(sq_at)) / self.alpha + self.l2))

        def bias_of():
            return -bias_z / ((self.beta + bias_sq**0.5) / self.alpha + self.l2)

        for _ in range(self.epochs):
            for at, x, y in rows:
                z_at, sq_at = z[at], sq[at]
                w, b = weights(z_at, sq_at), bias_of()
                g = (1 / (1 + np.exp(-np.clip((w * x).sum() + b, -35, 35))) - y) * (self.positive if y else 1.0)
                gx = g * x
                more = sq_at + gx * gx
                z[at] = z_at + gx - (np.sqrt(more) - np.sqrt(sq_at)) / self.alpha * w
                sq[at] = more
                bias_z, bias_sq = bias_z + g - ((bias_sq + g * g) ** 0.5 - bias_sq**0.5) / self.alpha * b, bias_sq + g * g
        w = weights(z[:size], sq[:size])
        at = np.flatnonzero(w)
        return at, w[at], float(bias_of())

    def fitted(self, docs: DataFrame, labels: DataFrame, label: str) -> Model:
        """This model fitted on at most max_train_rows labelled texts; equal rows of one id count once.

        docs: doc_id, text. labels: doc_id and the 0/1 column named by label; null ids and labels
        are left out, repeated ids take the larger label. An empty sample gives a model that scores 0.5.
        """
        known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").withColumn("hash", F.xxhash64("text"))
        # Rows are drawn, not ids: an id may have any number of texts, and a text any number of equal rows.
        keys = texts.select("doc_id", "hash").groupBy("doc_id", "hash").count().join(known, "doc_id")
        keys = materialize(keys.select("doc_id", "hash", "y", F.xxhash64(F.lit(self.seed), "doc_id", "hash").alias("place")), "labels")
        n = keys.count()
        # A share of the hashes that more than max_train_rows rows will not fall into, four deviations off.
        most = max(1.0, self.max_train_rows - 4 * self.max_train_rows**0.5)
        share = min(1.0, most / n) if n > self.max_train_rows else 1.0
        sample = keys.where(F.pmod("place", F.lit(1 << 30)) < int(share * (1 << 30)))
        # At most max_train_rows rows of four numbers, so this broadcast has a fixed bound.
        rows = texts.join(F.broadcast(sample), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])
        rows = materialize(rows.drop("hash"), "training")
        held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        rows = rows.withColumn("shard", F.pmod(F.shiftrightunsigned("place", 30), F.lit(max(1, -(-held // self.shard_bytes)))))
        bias = 1 << self.bits  # the coordinate after the features'

        def fit(t: pa.Table) -> pa.Table:
            # Texts are copied a slice at a time.
            order = pa.compute.sort_indices(t, [("place", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
            bytes_each = pa.compute.binary_length(t["text"].cast(pa.binary())).to_numpy()[order.to_numpy()]
            slice_of = np.cumsum(bytes_each) // SLICE_BYTES
            rows = []
            for k in np.unique(slice_of):
                part = t.select(["text", "y"]).take(order.filter(pa.array(slice_of == k)))
                rows += self.prepared(binary_texts(part["text"].combine_chunks()), part["y"].to_pylist())
            at, w, b = self.learned(rows)
            return pa.table({"at": np.append(at, [bias, bias + 1]), "weight": np.append(w, [b, 1.0])})

        # Sums of whole numbers are the same in any order. At most 2 ** bits rows, few of them other than zero.
        fixed = F.sum(F.round(F.col("weight") * _FIXED).cast("long")).alias("sum")
        sums = rows.groupBy("shard").applyInArrow(fit, "at long, weight double").groupBy("at").agg(fixed).where("sum <> 0").toArrow()
        total = np.zeros(bias + 2)
        total[sums["at"].to_numpy()] = sums["sum"].to_numpy() / _FIXED
        total /= max(1.0, total[-1])
        at = np.flatnonzero(np.abs(total[:bias]) > 1e-6)
        state = {k: getattr(self, k) for k in self.__dataclass_fields__}
        return Model(**state | {"at": at, "weight": total[at], "bias": float(total[bias])})

    def scores(self, dense: np.ndarray, texts: list[bytes]) -> np.ndarray:
        doc, at, n = self.features(texts)
        keep = dense[at] != 0
        keys, counts = np.unique(doc[keep] << self.bits | at[keep], return_counts=True)
        doc, at = keys >> self.bits, keys & ((1 << self.bits) - 1)
        total = np.bincount(doc, dense[at] * self.value(counts, n[doc]), minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -35, 35)))

    def scored(self, docs: DataFrame) -> DataFrame:
        """docs (doc_id, text) → doc_id, score: one row for each row; a null text scores as an empty one."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dense = np.zeros(1 << model.bits)
            dense[model.at] = model.weight
            for batch in batches:
                texts = binary_texts(batch["text"])
                score = np.concatenate([model.scores(dense, texts[i:j]) for i, j in slices(texts)] or [np.zeros(0)])
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score, pa.float64())], ["doc_id", "score"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")

    def accepted(self, docs: DataFrame, threshold: float) -> DataFrame:
        """The rows of docs, with all columns, whose text scores at least threshold."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dense = np.zeros(1 << model.bits)
            dense[model.at] = model.weight
            for batch in batches:
                texts = binary_texts(batch["text"])
                score = np.concatenate([model.scores(dense, texts[i:j]) for i, j in slices(texts)] or [np.zeros(0)])
                yield batch.filter(pa.array(score >= threshold))

        return docs.mapInArrow(run, docs.schema)
