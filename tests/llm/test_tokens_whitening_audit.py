"""Token files, whitening and the filter audit against plain versions, on rows with nulls, ties, repeats and clashing columns."""

import itertools
import json
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from boutlake.llm import filter_audit, simple8b, token_files, whitening

WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, source string, hash long, place long, ids binary, digest string, mask int, n long, first string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=3000))
def test_simple8b_round_trip(numbers):
    x = np.array(numbers, np.uint64)
    words, first, full = simple8b.encode(x)
    assert simple8b.decode(words, first, full, len(x)).tolist() == numbers
    for b, i in enumerate(range(0, len(x), simple8b.BLOCK)):  # each block alone
        a, c = first[b], first[b + 1] if b + 1 < len(first) else len(words)
        alone = simple8b.decode(words[a:c], first[b : b + 1] - a, full[b : b + 1] - a, min(simple8b.BLOCK, len(x) - i))
        assert alone.tolist() == numbers[i : i + simple8b.BLOCK]


def greedy(numbers):
    """Selectors of a block, one word at a time."""
    at, out = 0, []
    while at < len(numbers):
        for s, (n, bits) in enumerate(simple8b.PACKED, 1):
            if all(x < 1 << bits for x in numbers[at : at + n]):
                out.append(s)
                at += n
                break
        else:
            out.append(simple8b.ESCAPE)
            at += 1
    return out


def test_simple8b_takes_the_most_numbers_that_fit():
    r = random.Random(3)
    numbers = [r.choice([0, 1, 5, r.randrange(50_000), r.randrange(1 << 59), (1 << 60) + r.randrange(9)]) if r.random() < 0.3 else r.randrange(2) for _ in range(2500)]
    words, first, full = simple8b.encode(np.array(numbers, np.uint64))
    for b in range(3):
        assert (words[first[b] : full[b]] >> np.uint64(60)).tolist() == greedy(numbers[b * 1024 : (b + 1) * 1024])
    assert len(simple8b.encode(np.zeros(1024, np.uint64))[0]) == 18


def test_simple8b_refuses_an_unused_selector():
    with pytest.raises(ValueError):
        simple8b.decode(np.array([15 << 60], np.uint64), np.array([0]), np.array([1]), 1)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_words_encoded_alone_give_the_ids_of_whole_texts(library):
    r = random.Random(5)
    odd = "abcXYZ éÉİıßſΣς'’sStTrRe \t\n\r\x0b\x0c  ̧́̈ 123½²٣中文한글ᄀ가ᅡ🏅<|endoftext|>#$\xa0\x85​﻿'ll'd're"
    western = "abcXYZ éÉÀßŸſŉ'’sStTrRe .,;:!?\"-_()#$ \t\n012'll'd're"
    signs = "J̌ǰT̈ẗKÅΩẞİ"
    texts = ["".join(r.choices(x, k=r.randint(0, 60))) for x in (odd, western, western + signs) for _ in range(2000)]
    texts += ["".join(chr(r.choice([32, r.randrange(1, 0x250), r.randrange(0x250, 0xD800), r.randrange(0xE000, 0x30000)])) for _ in range(30)) for _ in range(2000)]
    texts += ["a" * 5000, " " * 5000, "<|endoftext|>", ""]
    encoder = token_files.Encoder(WORDS)
    assert encoder.by_piece
    assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == [library(t) for t in texts]


def test_a_forgetful_encoder_and_one_for_other_files(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_PIECES", 3)
    encoder = token_files.Encoder(WORDS)
    for t in ("one two three four", "five one", "", "two six seven"):
        assert encoder.encode([t.encode()])[0].tolist() == library(t)
    other = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_piece and other.encode([b" two  words"])[0].tolist() == plain.encode(" two  words", add_special_tokens=False).ids


def test_very_long_texts_are_cut_at_gaps(library, monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 50)
    text = " ".join(["word", "longer" * 20, "x,y!"] * 30) + " end  "
    assert token_files.Encoder(WORDS).encode([text.encode(), b"next one"])[0].tolist() == library(text)
    assert b"".join(token_files.parts_at_gaps(text.encode(), 50)) == text.encode()


def plain_tokens(docs, encode):
    out, start = [], 0
    for i, t in docs:
        ids = np.array([*encode(t or ""), 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def documents(n=60, seed=1):
    r = random.Random(seed)
    texts = [" ".join(f"W{r.randrange(900)}" for _ in range(r.randint(0, 400))) for _ in range(n)]
    data = [(i * 7 % n, t, "en", r.choice(["b", "a", None]), 1, 2, b"x", "d", 3, 4, "f") for i, t in enumerate(texts)]
    extra = [(n, None), (n + 1, ""), (n + 2, texts[3]), (n + 3, texts[3]), (n + 3, texts[3]), (n + 4, "é" * 7000 + " x"), (n + 5, "ABC #")]
    return data + [(i, t, None, None, 1, 2, b"x", "d", 3, 4, "f") for i, t in extra]


def test_token_files(spark, library):
    data = documents()
    got = token_files.op11_token_files(spark.createDataFrame(data, CLASH).repartition(5))
    assert sorted(tuple(r) for r in got.collect()) == plain_tokens(sorted(((d[0], d[1]) for d in data), key=lambda d: d[0]), library)


def test_token_files_ties_null_ids_text_ids_and_no_rows(spark, library, tmp_path):
    df = spark.createDataFrame([("b", "same"), ("b", "same"), ("a", "first"), (None, "no id"), ("b", "other words")], "doc_id string, text string")
    rows = sorted((tuple(r) for r in token_files.op11_token_files(df).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, "a", "b", "b", "b"]
    assert [r[1] for r in rows] == [0, *np.cumsum([r[2] for r in rows[:-1]]).tolist()]
    assert Counter((r[0], *r[2:]) for r in rows) == Counter((i, *x[2:]) for (i, _), x in zip([(r.doc_id, r.text) for r in df.collect()], plain_tokens([(r.doc_id, r.text) for r in df.collect()], library), strict=True))
    assert token_files.op11_token_files(df.where("doc_id = 'none'")).collect() == []
    # One id for most rows is spread over several files.
    token_files.write_token_files(spark.range(400).selectExpr("1L AS doc_id", "concat('t', id) AS text"), WORDS, f"file://{tmp_path}/hot", parts=4)
    manifest = json.load(open(f"{tmp_path}/hot/manifest.json"))
    assert [x["docs"] > 20 for x in manifest["files"]] == [True] * 4


def test_token_files_written_again_and_read_in_part(spark, library, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/tokens"
    df = spark.createDataFrame([(i, " ".join(str(k) for k in range(i * 40))) for i in range(50)], "doc_id long, text string")
    token_files.write_token_files(df.where("doc_id < 3"), WORDS, path)
    token_files.write_token_files(df, WORDS, path, parts=3)
    names = {x["name"] for x in json.load(open(f"{tmp_path}/tokens/manifest.json"))["files"]}
    assert {x for x in os.listdir(tmp_path / "tokens") if x.endswith(".s8b")} == names and len(names) == 3
    rows = token_files.read_token_files(spark, path).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [[*library(r.text), 2] for r in df.orderBy("doc_id").collect()]
    monkeypatch.setattr(token_files, "READ_BLOCKS", 1)  # a document may run over many reads
    import pyarrow as pa

    found = [b for x in names for b in token_files.documents_of(pa.OSFile(f"{tmp_path}/tokens/{x}"), 0)]
    assert sorted((i, d) for b in found for i, d in zip(b["doc_id"].to_pylist(), b["ids"].to_pylist(), strict=True)) == [(r.doc_id, r.ids) for r in rows]


def test_a_failed_write_leaves_the_earlier_files_readable(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    token_files.write_token_files(df, WORDS, path)
    before = sorted(tuple(r) for r in token_files.read_token_files(spark, path).collect())
    broken = df.selectExpr("doc_id", "CASE WHEN doc_id = 13 THEN raise_error('lost') ELSE text END AS text")
    with pytest.raises(Exception, match="lost"):
        token_files.write_token_files(broken, WORDS, path)
    assert sorted(tuple(r) for r in token_files.read_token_files(spark, path).collect()) == before


def plain_whitening(rows, most=32):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for _, v in good], object)
    n, s = len(x), x.sum(0)
    far = x * n - s
    centred = np.array(far / n, np.float64)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    y = centred @ axes[:, :most] / np.sqrt(values[:most])
    return good, n, [int(d) for d in (far * far).sum(1)], y, values[:most] / values.sum()


def test_whitening(spark):
    r = np.random.default_rng(4)
    data = [(int(i), [float(c) for c in v]) for i, v in enumerate(r.normal(size=(700, 40)) * np.geomspace(3, 0.2, 40))]
    data += [(5, data[9][1]), (None, data[8][1]), (900, None), (901, [None] + data[1][1][1:]), (902, [float("nan")] * 40), (903, [float("inf")] + data[2][1][1:]), (904, []), (905, [1.0, 2.0]), (906, data[0][1]), (906, data[0][1])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in data], "vec_id long, embedding array<float>, n int, component string").repartition(7)
    rows = whitening.op12_embedding_whitening(df).collect()
    good, n, deviation, y, share = plain_whitening([(i, v) for i, v in data if v is None or len(v) != 2])
    assert len(rows) == len(good) * 32 and {x.n for x in rows} == {n}
    assert len({x.identity_error for x in rows}) == 1 and rows[0].identity_error < 1e-9
    first = {}
    for (i, _), d, z in zip(good, deviation, y, strict=True):
        first.setdefault((i, d), z)
    sign = {}
    for x in rows:
        wanted = first[x.vec_id, x.deviation][x.component - 1]
        assert abs(x.explained - share[x.component - 1]) < 1e-10
        if abs(wanted) > 1e-3:
            assert sign.setdefault(x.component, np.sign(wanted * x.whitened)) == np.sign(wanted * x.whitened)
        assert abs(abs(x.whitened) - abs(wanted)) < 1e-7


def test_whitening_few_rows_equal_rows_and_none(spark):
    kind = "vec_id string, embedding array<double>"
    few = whitening.op12_embedding_whitening(spark.createDataFrame([("a", [0.0, 0.0, 1.0]), ("b", [1.0, 0.0, 1.0]), (None, [2.0, 0.0, 1.0])], kind)).collect()
    assert [(x.vec_id, x.component, x.deviation, x.explained) for x in sorted(few, key=lambda x: -x.deviation if x.vec_id else 1)] [:2] == [("a", 1, 36864, 1.0), ("b", 1, 0, 1.0)]
    assert sorted(round(abs(x.whitened), 9) for x in few) == [0.0, round(1.5**0.5, 9), round(1.5**0.5, 9)]
    assert whitening.op12_embedding_whitening(spark.createDataFrame([("a", [1.0, 2.0])] * 5, kind)).collect() == []
    assert whitening.op12_embedding_whitening(spark.createDataFrame([("a", [None, 2.0]), ("b", None), ("c", [])], kind)).collect() == []
    assert whitening.op12_embedding_whitening(spark.createDataFrame([], kind)).collect() == []
    huge = whitening.op12_embedding_whitening(spark.createDataFrame([("a", [1e300, 0.0]), ("b", [-1e300, 0.25]), ("c", [0.0, 0.5])], kind)).collect()
    assert {x.deviation for x in huge if x.vec_id != "c"} == {None}


def test_moments_merge_exactly_and_keep_their_digits():
    r = np.random.default_rng(2)
    x = r.integers(-40, 40, (5000, 6)) + (1 << 50)
    cuts = [x[:1], x[1:7], x[7:4000], x[4000:]]
    whole = x.astype(object)
    for order in itertools.permutations(range(4)):
        found = whitening.Moments(0, np.zeros(0), np.zeros((0, 0)))
        for k in order:
            found = found.merged(whitening.Moments.of(cuts[k]))
        assert found.n == 5000 and list(found.sums) == list(whole.sum(0))
        far = whole * 5000 - whole.sum(0)
        assert np.allclose(found.scatter, (far.T @ far / 25_000_000).astype(float), rtol=1e-12, atol=1e-6)


def plain_audit(docs, labels):
    """docs: doc_id, text, source."""
    good, toxic, first = {}, {}, {}
    for i, q, t in labels:
        if i is not None:
            good[i], toxic[i] = good.get(i, 0) or q == 1, toxic.get(i, 0) or t == 1
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    rows = []
    for i, t, s in docs:
        t, w = t or "", (t or "").encode().split()
        fails = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        fails += "D" * bool(re.search("[#$%&*|]", t)) + "E" * (i is not None and first[t] < i)
        rows.append((s or "", fails, bool(good.get(i)), bool(toxic.get(i))))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = [r for r in mine if f in r[0]]
                shapley[part, f] += len(gone)
                out.append((part, order, step, len(left), len(gone), len(failing) - len(gone), sum(r[0] == f for r in mine), sum(r[1] for r in gone), sum(r[2] for r in gone)))
    return [(*x, shapley[x[0], x[1][x[2] - 1]]) for x in out]


def test_filter_audit(spark):
    r = random.Random(8)
    data = documents()
    data += [(200 + k, " ".join(["same"] * r.randint(150, 260)) + r.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3]), "en", r.choice(["a", "c"]), 1, 2, b"x", "d", 3, 4, "f") for k in range(40)]
    data += [(None, "no id here", None, "c", 1, 2, b"x", "d", 3, 4, "f"), (300, "no id here", None, "", 1, 2, b"x", "d", 3, 4, "f"), (301, "no id here", None, "c", 1, 2, b"x", "d", 3, 4, "f")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(0, 260, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    known = spark.createDataFrame([(*x, 9) for x in labels], "doc_id long, quality int, toxic int, mask int")
    got = filter_audit.op13_filter_audit(spark.createDataFrame(data, CLASH).repartition(4), known)
    rows = sorted(tuple(x) for x in got.collect())
    assert rows == sorted(plain_audit([(d[0], d[1], d[3]) for d in data], labels))
    assert len(rows) == 600 * 4 and all(sum(x[c] for x in rows) for c in (3, 4, 5, 6, 7, 8, 9))


def test_filter_audit_of_no_rows_and_by_sql(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.op13_filter_audit(df, labels).collect() == []
    one = df.union(spark.createDataFrame([(None, None, None)], df.schema))
    assert {(x.kept + x.removed + x.redundant) for x in filter_audit.op13_filter_audit(one, labels).collect()} == {0, 1}
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = filter_audit.op13_filter_audit(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    assert sorted(tuple(x) for x in got.collect()) == sorted(con.execute(filter_audit.OP13_SQL).fetchall())


def test_edges_are_eighty_a_part(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 31, 2, 0, 1)], "part string, mask int, n long, good long, toxic long")
    edges = filter_audit.edge_sums(counts).collect()
    assert len(edges) == 80 and {(x.kept, x.removed, x.redundant) for x in edges} == {(5, 2, 0), (5, 0, 2)}
