"""Packing token sequences by bin completion on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens in one pass over the texts. Only the number of
pieces of each length, at most ``capacity`` numbers whatever the corpus, reaches the driver. There the
longest remaining length is completed again and again: undominated fillings of the room beside it are
enumerated and tried depth first, sequence after sequence. Best-fit-decreasing is the first incumbent; a
branch whose waste adds up to more than a better solution may have is cut, and so is one that comes back
to pieces already seen. The search ends at a lower bound, which proves the result, or after ``NODES``
nodes without a better solution, ``FILLING_NODES`` for each list of fillings, of which ``KEPT`` are tried. Sequences with
waste are then searched again by themselves with higher limits, and the best solution so far stands, never
worse than best fit. These limits bound the driver's time whatever the corpus.

The plan, a bounded table of lengths, ranks and places, is joined to the pieces by rank within length.
Ranks have two levels, so a length that most pieces share is spread over tasks.

A null text is empty and gives the one piece of its end token. Repeated rows are documents of their
own; a null doc_id stays null. Extra columns are left out. No rows give no rows.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boutlake.llm.common import binary_texts, materialize

CAPACITY = 2048
END = 0
#: Nodes of the search over all sequences without a better solution, nodes of each search for fillings, and fillings kept of each.
NODES = 3_000
FILLING_NODES = 60
KEPT = 3
#: The same for the searches over sequences with waste, and how many of these follow one another.
REST_NODES = 1_000
REST_FILLING_NODES = 200
REST_KEPT = 4
RESTS = 6
RANKED = 50_000
#: How byte-level files split a text before they merge.
SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


Pattern = tuple[tuple[int, int], ...]  # (length, how often) from the longest
Plan = list[tuple[Pattern, int]]  # patterns and how many sequences follow each


class Encoder:
    """Token ids of texts by a file of the tokenizers library.

    A plain byte-level BPE whose ids follow its merges is read from the file and encoded by tiktoken, which
    gives the same ids in a quarter of the time; any other file is left to tokenizers. Strings of special
    tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = merge_ranks(path)
        if ranks is not None:
            self.fast = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.fast, self.slow = None, Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True

    def encode(self, text: bytes) -> np.ndarray:
        """Ids (uint32) of a UTF-8 text."""
        if self.fast is not None:
            return self.fast.encode_to_numpy(text.decode(), disallowed_special=())
        return np.array(self.slow.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of each token and its id, if the file is a byte-level BPE in which a lower id is merged first; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    # Byte-level files write printable bytes as themselves and the others as letters from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in spec.get("added_tokens", ())}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1), -1) for m in model["merges"]]
    in_order = all(x < y for x, y in itertools.pairwise([max(vocab.get(c, 1 << 40) for c in byte_of), *merged]))
    if not in_order or len(vocab) != len(merged) + 256:
        return None
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()}


_ENCODERS: dict[str, Encoder] = {}


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of docs (doc_id, text).

    tokenizer: path of a tokenizers file on every executor. A document longer than capacity has its
    shorter piece first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        tail = np.array([end], np.uint32)
        for batch in batches:
            texts = binary_texts(batch["text"])
            rows: list[tuple[int, int, int, int, int]] = []
            for k, text in enumerate(texts):
                data = np.concatenate([encoder.encode(text), tail]).astype("<u4").tobytes()
                n = len(data) // 4
                starts = [0, *range((n - 1) % capacity + 1, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    rows.append((k, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
            at, piece, start, length, crc = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit-decreasing, whole groups of equal sequences at a time."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = min((r for r in rooms if r >= length), default=None)
            if fits is None:
                rooms.setdefault(capacity - length, []).append(((length,), left))
                break
            items, many = rooms[fits].pop()
            if many > left:
                rooms[fits].append((items, many - left))
            if not rooms[fits]:
                del rooms[fits]
            used = min(many, left)
            rooms.setdefault(fits - length, []).append(((*items, length), used))
            left -= used
    return [(tuple((x, items.count(x)) for x in dict.fromkeys(items)), many) for groups in rooms.values() for items, many in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by all tokens, and by long pieces that leave each other too little room."""
    n, size = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for length, many in counts.items():
        n[length], size[length] = many, many * length
    n_up, size_up = np.cumsum(n[::-1])[::-1], np.cumsum(size[::-1])[::-1]  # of this length or longer
    half = capacity // 2 + 1
    best = -(-int(size_up[0]) // capacity)
    for least in range(1, half):
        alone, wide = int(n_up[capacity - least + 1]), int(n_up[half] - n_up[capacity - least + 1])
        room = wide * capacity - int(size_up[half] - size_up[capacity - least + 1])
        best = max(best, alone + wide + max(0, -(-(int(size_up[least] - size_up[half]) - room) // capacity)))
    return best


def fillings(room: int, left: np.ndarray, most_waste: int, free: int = 0, nodes: int = FILLING_NODES, kept: int = KEPT) -> list[tuple[int, Pattern]]:
    """Undominated fillings of room as (waste, pattern): least waste beyond what is free, then the longest pieces.

    left: pieces left of each length. All pieces of a length are one step of the search. A filling is
    dominated if a piece left could be added, or could stand in for one or two of its pieces that are
    together no longer; the shorter ones are then free for later. A branch ends where the pieces it may
    still take leave more waste than most_waste, or room for a piece it has passed over.
    """
    lengths = np.flatnonzero(left[: room + 1])[::-1].tolist()
    if not lengths:
        return [(room, ())] if room <= most_waste else []
    have = [int(left[x]) for x in lengths]
    held = [0] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        held[i] = held[i + 1] + lengths[i] * have[i]
    upto = np.concatenate([[0], np.cumsum(left[: room + 1] > 0)]).tolist()  # lengths present below each

    def dominated(waste: int, items: Pattern) -> bool:
        gone = {x for x, k in items if k == left[x]}
        sizes = [x for x, _ in items]
        for i, x in enumerate(sizes):
            sums = [(x + 1, x + waste)] + [(x + y, x + y + waste) for y in sizes[i + 1 :]] + ([(2 * x, 2 * x + waste)] if items[i][1] > 1 else [])
            for low, high in sums:
                high = min(high, room)
                if low <= high and upto[high + 1] - upto[low] > sum(low <= g <= high for g in gone):
                    return True
        return False

    found: list[tuple[int, list[tuple[int, int]], int, Pattern]] = []
    stack: list[tuple[int, int, int, int, Pattern]] = [(room, 0, min(have[0], room // lengths[0]), most_waste, ())]
    while stack and nodes:
        nodes -= 1
        space, at, times, limit, items = stack.pop()
        x = lengths[at]
        here = min(limit, x - 1) if times < min(have[at], space // x) else limit
        after = space - times * x
        # Fewer of this length leave more to fill: no sibling can do better once this one cannot.
        if after - held[at + 1] <= here:
            if times:
                stack.append((space, at, times - 1, limit, items))
            if times:
                items = (*items, (x, times))
            at += 1
            while at < len(lengths) and lengths[at] > after:
                at += 1
            if at < len(lengths) and after:
                stack.append((after, at, min(have[at], after // lengths[at]), here, items))
            elif after <= here:
                key = (max(0, after - free), [(-x, -k) for x, k in items], after, items)
                if (len(found) < kept or key < found[-1]) and not dominated(after, items):
                    bisect.insort(found, key)
                    del found[kept:]
    return [(after, items) for _, _, after, items in found]


def complete_bins(counts: dict[int, int], capacity: int, best: Plan, bound: int, nodes: int, filling_nodes: int = FILLING_NODES, kept: int = KEPT) -> Plan:
    """The best plan of a depth-first search over sequences that starts with best as incumbent.

    Each node fills the longest piece left, by its undominated fillings in turn, each as often as the
    counts and the waste allow, then each once. A branch ends where its waste so far, or the pieces
    longer than half a sequence, rule out fewer sequences than the incumbent's, or where the same pieces
    were left after no more sequences. The search ends at the bound, or after so many nodes without a better plan.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    total, fewest = sum(x * n for x, n in counts.items()), sum(n for _, n in best)
    seen: dict[int, int] = {}
    path: Plan = []
    used = waste = 0

    def choices() -> list[tuple[Pattern, int, int]]:
        spare = (fewest - 1) * capacity - total - waste
        longest = int(np.flatnonzero(left)[-1])
        if spare < 0 or used + int(left[capacity // 2 + 1 :].sum()) >= fewest:
            return []
        state = hash(left.tobytes())
        if seen.get(state, used + 1) <= used:
            return []
        seen[state] = used
        left[longest] -= 1
        ways = fillings(capacity - longest, left, spare, spare // max(1, fewest - 1 - used), filling_nodes, kept)
        left[longest] += 1
        out = []
        for lost, items in ways:
            pattern = tuple(sorted((Counter({longest: 1}) + Counter(dict(items))).items(), reverse=True))
            many = min(int(left[x]) // k for x, k in pattern)
            out.append((pattern, min(many, spare // lost) if lost else many, lost))
        return [*out, *((p, 1, lost) for p, n, lost in out if n > 1)]

    frames = [iter(choices())] if total else []
    since = 0
    while frames and since < nodes and fewest > bound:
        step = next(frames[-1], None)
        # The incumbent may have improved since these choices were listed.
        if step is not None and waste + step[1] * step[2] > (fewest - 1) * capacity - total:
            continue
        if step is None:
            frames.pop()
            if path:
                pattern, n = path.pop()
                used -= n
                waste -= n * (capacity - sum(x * k for x, k in pattern))
                for x, k in pattern:
                    left[x] += n * k
            continue
        since += 1
        pattern, n, lost = step
        for x, k in pattern:
            left[x] -= n * k
        path.append((pattern, n))
        used, waste = used + n, waste + n * lost
        if left.any():
            frames.append(iter(choices()))
        else:
            best, fewest, since = list(path), used, 0
            frames.append(iter(()))
    return best


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, rest_nodes: int = REST_NODES) -> Plan:
    """How to fill as few sequences as found: patterns of lengths, and how many sequences follow each.

    A quick search completes all sequences; those that it fills without waste are then kept, and slower ones go
    over the others, beside as many full ones with the shortest pieces, as long as that saves a sequence.
    """
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    if sum(n for _, n in best) > bound:
        best = complete_bins(counts, capacity, best, bound, nodes)
    for _ in range(RESTS):
        fewest = sum(n for _, n in best)
        if fewest == bound:
            break
        full = [(p, n) for p, n in best if sum(x * k for x, k in p) == capacity]
        rest = [(p, n) for p, n in best if sum(x * k for x, k in p) < capacity]
        some = sum(n for _, n in rest)
        for p, n in sorted(full, key=lambda s: (s[0][-1][0], s)):
            if some:
                full.remove((p, n))
                full += [(p, n - some)] if n > some else []
                rest.append((p, min(n, some)))
                some -= min(n, some)
        left: Counter[int] = Counter()
        for p, n in rest:
            left.update({x: k * n for x, k in p})
        found = complete_bins(left, capacity, rest, lower_bound(left, capacity), rest_nodes, REST_FILLING_NODES, REST_KEPT)
        if sum(n for _, n in full) + sum(n for _, n in found) == fewest:
            break
        best = full + found
    return best


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset; pieces needs doc_id, piece, start, length, ids_crc32 and cheap rereading."""
    spark = pieces.sparkSession
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, used, first = [], dict.fromkeys(counts, 0), 0
    for pattern, many in pack_lengths(counts, capacity):
        offset = 0
        for length, times in pattern:
            rows.append((length, used[length], used[length] + many * times, times, first, offset))
            used[length] += many * times
            offset += length * times
        first += many
    slots = spark.createDataFrame(rows, "length long, low long, high long, times long, first long, at long")
    parts = spark.createDataFrame([(x, -(-n // RANKED)) for x, n in counts.items()], "length long, parts long")
    split = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.col("parts"))
    # Both tables have rows by length and pattern alone, bounded by the capacity.
    rows = pieces.join(F.broadcast(parts), "length").withColumn("split", split)
    ahead = F.sum("n").over(Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    sums = rows.groupBy("length", "split").agg(F.count("*").alias("n")).select("length", "split", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("length", "split").orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = rows.join(sums, ["length", "split"]).withColumn("rank", F.col("ahead") + F.row_number().over(inside) - 1)
    rows = rows.join(F.broadcast(slots), (rows["length"] == slots["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(slots["length"])
    place = F.col("rank") - F.col("low")
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.expr("(rank - low) div times")).alias("sequence_id"), (F.col("at") + place % F.col("times") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack_pieces(materialize(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)


def op6_best_fit_packing(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))
