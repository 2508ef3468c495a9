"""Removal of long word sequences that an earlier document also holds.

Every window of ``size`` consecutive words gets a Rabin-Karp hash. Windows are dealt to buckets by the
least hash of a shorter gram inside them, so that equal windows meet and neighbours mostly travel
together; a bucket counts its hashes and flags each window whose sequence also starts in a document with
a smaller id. Runs of flagged windows become intervals, which are merged per document.

Before anything is shuffled a task resolves the windows that repeat among its own documents and sends
only those of the least id. So a passage that a third of all documents share reaches its bucket once a
task, not once a document. What is shuffled is about ten bytes a window, and the compressed texts once
for the join with their intervals.

Rows of one doc_id and text are one document; a null text has no words; a row without doc_id is neither
smaller nor larger than any other, keeps all words and removes none. Whole numbers are ids as they are; ids of
any other type with an order, texts too, are numbered in that order first and come back as they were. Very
long texts are taken whole, and an empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from boutlake.llm.common import Words, binary_texts, materialize, mixed, planned_parts, slices, spans_hashed
from boutlake.operators.ordered import with_ids

SIZE = 50
#: Windows that a task holds before it resolves and sends them.
HELD = 2_000_000
#: Input bytes for one bucket; its windows take about three times as much.
BUCKET_BYTES = 4 << 20

_SENT = "bucket int, doc binary, key binary, begin binary, length binary, anchor binary, hashes binary"
_FOUND = "doc_id long, text_key long, begin int, end int"


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def later(hashes: np.ndarray, anchors: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a smaller document has the same hash and anchor."""
    order = np.argsort(hashes)
    h, a = hashes[order], anchors[order]
    same = h[1:] == h[:-1]
    if np.any(same & (a[1:] != a[:-1])):
        order = np.lexsort((anchors, hashes))
        h, a = hashes[order], anchors[order]
        same = (h[1:] == h[:-1]) & (a[1:] == a[:-1])
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    first = np.minimum.reduceat(docs[order], heads)
    out = np.empty(len(hashes), bool)
    out[order] = docs[order] > np.repeat(first, np.diff(np.append(heads, len(hashes))))
    return out


def runs(*breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs between places where any of the breaks (for all but the first row) is true."""
    n = len(breaks[0]) + 1
    starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce(breaks)]))
    return starts, np.diff(np.append(starts, n))


class _Held:
    """Windows of a task's documents until they are sent."""

    def __init__(self, size: int, buckets: int):
        self.size, self.gram, self.buckets = size, max(1, size // 2), buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, ids: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> None:
        words = Words(texts)
        n = len(words.doc) - self.size + 1
        if n <= 0:
            return
        h = words.hashes()
        at = np.flatnonzero(words.doc[:n] == words.doc[self.size - 1 :])
        every = np.arange(len(h) - self.gram + 1)
        grams = mixed(spans_hashed(h, every, every + self.gram))
        anchors = least_of(grams, self.size - self.gram + 1)[at]
        firsts = np.cumsum(words.counts) - words.counts
        doc = words.doc[at]
        windows = mixed(spans_hashed(h, at, at + self.size))
        self.parts.append((windows, anchors, ids[doc], keys[doc], (at - firsts[doc]).astype(np.int32)))
        self.count += len(at)

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        hashes, anchors, doc, key, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.count = [], 0
        local = later(hashes, anchors, doc)
        rows: list[tuple] = []
        if local.any():
            d, k, p = doc[local], key[local], pos[local]
            starts, lengths = runs(d[1:] != d[:-1], k[1:] != k[:-1], p[1:] != p[:-1] + 1)
            # Resolved already: they pass a bucket only to join the other intervals.
            for i in range(0, len(starts), 20_000):
                s = starts[i : i + 20_000]
                rows.append((int(s[0] * 7919 % self.buckets), d[s].tobytes(), k[s].tobytes(), p[s].tobytes(), lengths[i : i + 20_000].astype(np.int32).tobytes(), None, None))
            hashes, anchors, doc, key, pos = (x[~local] for x in (hashes, anchors, doc, key, pos))
        starts, lengths = runs(doc[1:] != doc[:-1], key[1:] != key[:-1], pos[1:] != pos[:-1] + 1, anchors[1:] != anchors[:-1])
        bucket = (mixed(anchors[starts]) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts, lengths, bucket = starts[order], lengths[order], bucket[order]
        ends = np.cumsum(lengths)
        hashes = hashes[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]
        heads, many = runs(bucket[1:] != bucket[:-1])
        for head, n in zip(heads, many, strict=True):
            s = starts[head : head + n]
            part = hashes[ends[head] - lengths[head] : ends[head + n - 1]]
            rows.append((int(bucket[head]), doc[s].tobytes(), key[s].tobytes(), pos[s].tobytes(), lengths[head : head + n].astype(np.int32).tobytes(), (anchors[s] >> np.uint64(32)).astype(np.uint32).tobytes(), part.tobytes()))
        names = [x.split()[0] for x in _SENT.split(", ")]
        for i in range(0, len(rows), 200):
            columns = list(zip(*rows[i : i + 200], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names)


def _decide(size: int):
    def decide(t: pa.Table) -> pa.Table:
        def joined(name: str, kind: type, rows: pa.Table) -> np.ndarray:
            return np.frombuffer(b"".join(x or b"" for x in rows[name].to_pylist()), kind)

        found: list[list[np.ndarray]] = []
        done = t.filter(t["hashes"].is_null())
        if done.num_rows:
            begin = joined("begin", np.int32, done)
            found.append([joined("doc", np.int64, done), joined("key", np.int64, done), begin, begin + joined("length", np.int32, done) + (size - 1)])
        t = t.filter(t["hashes"].is_valid())
        if t.num_rows:
            length = joined("length", np.int32, t)
            run = np.repeat(np.arange(len(length)), length)
            doc, key, begin = joined("doc", np.int64, t), joined("key", np.int64, t), joined("begin", np.int32, t)
            flagged = np.flatnonzero(later(joined("hashes", np.uint64, t), joined("anchor", np.uint32, t)[run], doc[run]))
            if len(flagged):
                firsts = np.cumsum(length) - length
                r = run[flagged]
                pos = begin[r] + (flagged - firsts[r]).astype(np.int32)
                starts, many = runs(r[1:] != r[:-1], pos[1:] != pos[:-1] + 1)
                found.append([doc[r[starts]], key[r[starts]], pos[starts], pos[starts] + many.astype(np.int32) + (size - 1)])
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)] * 2
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("doc_id", "text_key", "begin", "end"), columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)})

    return decide


def repeated_spans(docs: DataFrame, size: int = SIZE, buckets: int | None = None) -> DataFrame:
    """doc_id (long), text_key, begin, end: word ranges that windows of smaller documents also hold.

    Ranges of a document may touch or overlap; text_key is xxhash64 of the text.
    """
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    buckets = buckets or max(planned_parts(rows, BUCKET_BYTES), 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(size, buckets)
        for batch in batches:
            ids, keys, texts = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy(), binary_texts(batch["text"])
            for i, j in slices(texts):
                held.add(ids[i:j], keys[i:j], texts[i:j])
                if held.count >= HELD:
                    yield from held.sent()
        yield from held.sent()

    return rows.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(_decide(size), _FOUND)


def kept_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without these word ranges, joined by single spaces; its words and those removed."""
    words = text.split()
    if not spans:
        return b" ".join(words), len(words), 0
    kept: list[bytes] = []
    at = 0
    for begin, end in sorted(spans):
        if begin > at:
            kept += words[at:begin]
        at = max(at, end)
    kept += words[at:]
    return b" ".join(kept), len(words), len(words) - len(kept)


def dedup_substrings(docs: DataFrame, size: int = SIZE, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text of the words kept) for each row of docs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = pa.array([squeeze.compress(x) for x in binary_texts(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["number"], batch["text_key"], texts], ["doc_id", "number", "text_key", "packed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expand = zstandard.ZstdDecompressor()
            spans = batch["spans"].to_pylist()
            rows = [kept_words(expand.decompress(x), [(s["begin"], s["end"]) for s in y or ()]) for x, y in zip(batch["packed"].to_pylist(), spans, strict=True)]
            kept, n, gone = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    numbered = _numbered(docs)
    spans = repeated_spans(numbered, size, buckets).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    own = "own_id" if "own_id" in numbered.columns else "doc_id"
    kind = numbered.schema[own].dataType.simpleString()
    rows = numbered.select(F.col("doc_id").alias("number"), F.xxhash64("text").alias("text_key"), F.col(own).alias("doc_id"), "text").mapInArrow(pack, f"doc_id {kind}, number long, text_key long, packed binary")
    spans = spans.withColumnRenamed("doc_id", "number")
    return rows.join(spans, ["number", "text_key"], "left").mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id as a long, and text; ids of another type are numbered in their order and stay as own_id."""
    rows = docs.select("doc_id", "text")
    if isinstance(docs.schema["doc_id"].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    ids = with_ids(materialize(rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("own_id")).distinct(), "ids"), ["own_id"])
    ids = materialize(ids, "numbers")
    rows = rows.withColumnRenamed("doc_id", "own_id").join(ids.withColumnRenamed("own_id", "of"), F.col("own_id") == F.col("of"), "left")
    return rows.select(F.col("id").cast("long").alias("doc_id"), "own_id", "text")


def op2_substring_dedup(documents: DataFrame) -> DataFrame:
    """Words, words removed and digest of what is left of every document; nulls, ties and repeats as in the module."""
    return dedup_substrings(documents).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT row, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) >= 50)),
m AS (SELECT row, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM x),
g AS (SELECT DISTINCT row, i + unnest(range(50)) AS i FROM m WHERE doc_id > least),
k AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
r AS (SELECT k.row, count(*) AS n, count(g.i) AS gone, string_agg(word, ' ' ORDER BY k.i) FILTER (WHERE g.i IS NULL) AS kept FROM k LEFT JOIN g ON g.row = k.row AND g.i = k.i GROUP BY k.row)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r ON r.row = d.row
"""
