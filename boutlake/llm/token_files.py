"""Token ids of documents in binary files of Simple-8b words.

Documents are dealt into ranges of doc_id, each sorted in its task, encoded there and written as one file
by a data source of its own (``TokenFiles``). A task streams: it holds one slice of text, one unfinished block
and the lengths of its documents. Every attempt writes a file of its own name; the commit lists the
files of the attempts that succeeded, with the ids that stand before each, in ``manifest.json``, and removes the
others, so a lost executor or a second attempt leaves no trace. A reader takes one file a task.

A file is: ``MAGIC``; the words of all blocks; where each block's words and full numbers begin (two tables
of unsigned 64-bit numbers); an Arrow stream of doc_id and n_tokens; six unsigned 64-bit numbers (ids, words,
blocks, ids of a block, bytes of the Arrow stream, documents); ``MAGIC``. Numbers are little-endian. Blocks
do not end with documents: a document's ids are found by its start and the tables, without reading the rest.

Null and empty texts have the end id alone. Very long texts are encoded in slices. Repeated rows are
documents of their own; equal doc_ids stand in the order of their texts' hashes, null ones first. doc_id may be
of any type that has an order. Extra columns are left out. An empty table gives files without documents.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from boutlake.llm import simple8b
from boutlake.llm.common import SLICE_BYTES, binary_texts, planned_parts, shared_dir, slices

MAGIC = b"S8BTOK01"
END = 2
#: Text of a file, by the planner's estimate.
FILE_BYTES = 64 << 20
#: Blocks that a reader decodes at a time.
READ_BLOCKS = 1024
#: Distinct pieces, and ids of them, whose encoding a task remembers.
CACHED_PIECES, CACHED_IDS = 1 << 18, 1 << 21
_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
#: Fixed value: how the word-end vocabulary's file splits a text. No match holds white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Lower-case letters of ASCII and the western alphabets, of which each piece that SPLIT finds is one match of _PIECE; other characters.
_LETTERS = "a-zß-öø-ÿĀ-ſ"
_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^ \t-\r0-9{_LETTERS}]+")
_OTHER = re.compile(rf"[^\t-\r -~{_LETTERS}]")
_WORD = re.compile(r"[^ \t-\r]+")


def splits_at_gaps(spec: dict) -> bool:
    """Whether the ids of a text are those of its words between ASCII white space, one after the other, by this tokenizers file."""
    normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    normal = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    before = spec.get("pre_tokenizer") or {}
    first = before["pretokenizers"][0] if before.get("type") == "Sequence" and before["pretokenizers"] else before
    space = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    return (
        all(n["type"] in ("NFC", "Lowercase") or n == space for n in normal) and not spec["model"].get("dropout")
        and first.get("type") == "Split" and first["pattern"].get("Regex") == SPLIT and first["behavior"] == "Removed" and first["invert"]
    )


class _Numbers(dict):
    """A number for each key, given out when it is first asked for; new holds the keys since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class Encoder:
    """Ids of texts by a file of the tokenizers library; strings of special tokens are ordinary text.

    Where white space only separates, the library encodes each distinct piece once and the ids are put together from
    these: pieces of a western alphabet are what it splits a lower-case text into, and it takes many in one call,
    for each ends with a token of a word's end. A word with any other character is encoded as it stands.
    Files that keep white space are given whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_piece = splits_at_gaps(spec)
        if self.by_piece:
            vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            # Pieces are in lower case and split already, so the same model takes them between spaces.
            self.plain = Tokenizer.from_file(path)
            self.plain.encode_special_tokens = True
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Adds the ids of pieces, and of words after a line feed."""
        alone = [x for x in new if x[0] == "\n"]
        plain = [x for x in new if x[0] != "\n"]
        ids = np.array(self.plain.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        parts = self._encoded(alone) if alone else []
        size = np.concatenate([np.diff(ends, prepend=0), np.array([len(x) for x in parts], np.int64)])
        if alone:  # back in the order of new
            is_alone = np.array([x[0] == "\n" for x in new])
            order = np.argsort(np.concatenate([np.flatnonzero(~is_alone), np.flatnonzero(is_alone)]))
            flat = np.concatenate([ids, *parts])
            first = (np.cumsum(size) - size)[order]
            size = size[order]
            ids = flat[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, size])
        self.first = np.cumsum(self.size) - self.size

    def _looked_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and how many each has."""
        if len(self.number) > CACHED_PIECES or len(self.flat) > CACHED_IDS:
            self._forget()
        which = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        if new := self.number.new:
            self._learn(new)
            self.number.new = []
        size = self.size[which]
        skip = self.first[which] - (np.cumsum(size) - size)
        return self.flat[np.repeat(skip, size) + np.arange(size.sum())], size

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        if not self.by_piece:
            return self._encoded([x.decode("utf-8", "replace") for x in texts])
        out = []
        for i, j in slices(texts):
            if j - i == 1 and len(texts[i]) > SLICE_BYTES:
                parts = [pieces_of(part.decode("utf-8", "replace")) for part in parts_at_gaps(texts[i])]
                out.append(np.concatenate([np.zeros(0, np.uint32), *(self._looked_up(x)[0] for x in parts if x)]))
                continue
            pieces = [pieces_of(x.decode("utf-8", "replace")) for x in texts[i:j]]
            joined = [x for some in pieces for x in some]
            if not joined:
                out += [np.zeros(0, np.uint32)] * (j - i)
                continue
            ids, size = self._looked_up(joined)
            ends = np.append(0, np.cumsum(size))[np.cumsum([len(x) for x in pieces])]
            out += np.split(ids, ends[:-1])
        return out


def pieces_of(text: str) -> list[str]:
    """What SPLIT makes of a text, in lower case; words with characters other than _LETTERS and ASCII whole, as they stand, after a line feed."""
    low = text.lower()
    if _OTHER.search(low) is None:
        return _PIECE.findall(low)
    out = []
    for word, small in zip(_WORD.findall(text), _WORD.findall(low), strict=True):
        out += ["\n" + word] if _OTHER.search(small) else _PIECE.findall(small)
    return out


def parts_at_gaps(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """text cut at white space into parts of about limit bytes."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, min(start + limit, len(text)))
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


_ENCODERS: dict[str, Encoder] = {}


def token_ids(docs: DataFrame, tokenizer: str, end: int | None = END) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of each row of docs (doc_id, text), in the order of docs' partitions.

    tokenizer: path of a tokenizers file on every executor. end: an id put after every document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for batch in batches:
            texts = binary_texts(batch["text"])
            for i, j in slices(texts):
                ids = [x.astype("<u4", copy=False).tobytes() + tail for x in _ENCODERS[tokenizer].encode(texts[i:j])]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][i:j], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text in parts consecutive ranges of doc_id, each sorted. Rows of one id spread over ranges too."""
    # Equal rows are told apart by their place in the input, so that no copy fills a range alone.
    rows = docs.select("doc_id", "text").withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    return rows.repartitionByRange(parts, "doc_id", "hash", "place").sortWithinPartitions("doc_id", "hash", "place").select("doc_id", "text")


def _opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path.rstrip("/")))


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    docs: int
    ids: int


@dataclass
class File(InputPartition):
    name: str
    base: int


def _numbers(ids: pa.Array) -> np.ndarray:
    """All ids of a column of little-endian unsigned 32-bit ids, one row after the other."""
    offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    if ids.buffers()[2] is None:
        return np.zeros(0, "<u4")
    return np.frombuffer(ids.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u4")


class TokenWriter(DataSourceArrowWriter):
    """One file for each task, from rows of doc_id and ids."""

    def __init__(self, path: str, kind: str):
        self.path, self.kind = path, kind

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        fs, root = _opened(self.path)
        name = f"part-{part:06}-{uuid.uuid4().hex}.s8b"
        docs, first, full = [], [], []
        n_ids = n_words = 0
        rest = np.zeros(0, "<u4")
        with fs.open_output_stream(f"{root}/{name}", compression=None) as f:

            def put(numbers: np.ndarray) -> None:
                nonlocal n_words
                words, a, b = simple8b.encode(numbers)
                f.write(words.astype("<u8").tobytes())
                first.append(a + n_words)
                full.append(b + n_words)
                n_words += len(words)

            f.write(MAGIC)
            for batch in iterator:
                ids = batch["ids"].cast(pa.binary()).fill_null(b"")
                docs.append(pa.RecordBatch.from_arrays([batch["doc_id"], pa.compute.divide(pa.compute.binary_length(ids), 4).cast(pa.int64())], ["doc_id", "n_tokens"]))
                rest = np.concatenate([rest, _numbers(ids)])
                n_ids += len(_numbers(ids))
                whole = len(rest) // simple8b.BLOCK * simple8b.BLOCK
                for i in range(0, whole, READ_BLOCKS * simple8b.BLOCK):
                    put(rest[i : min(whole, i + READ_BLOCKS * simple8b.BLOCK)])
                rest = rest[whole:].copy()
            put(rest)
            first, full = np.concatenate(first), np.concatenate(full)
            f.write(first.astype("<u8").tobytes() + full.astype("<u8").tobytes())
            index = pa.BufferOutputStream()
            if docs:
                with pa.ipc.new_stream(index, docs[0].schema) as stream:
                    for batch in docs:
                        stream.write_batch(batch)
            index = index.getvalue()
            f.write(index)
            n_docs = sum(len(b) for b in docs)
            f.write(np.array([n_ids, n_words, len(first), simple8b.BLOCK, index.size, n_docs], "<u8").tobytes() + MAGIC)
        return Written(part, name, n_docs, n_ids)

    def commit(self, messages: list[Written | None]) -> None:
        """Lists the files of the attempts that succeeded; from then on readers see these and nothing else."""
        files, base = [], 0
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            files.append({"name": m.name, "docs": m.docs, "ids": m.ids, "base": base})
            base += m.ids
        fs, root = _opened(self.path)
        fs.create_dir(root, recursive=True)
        made = f"{root}/manifest-{uuid.uuid4().hex}"
        with fs.open_output_stream(made, compression=None) as f:
            f.write(json.dumps({"doc_id": self.kind, "files": files}).encode())
        fs.move(made, f"{root}/manifest.json")
        listed = {x["name"] for x in files}
        for x in fs.get_file_info(pa.fs.FileSelector(root)):
            if x.base_name.endswith(".s8b") and x.base_name not in listed:
                fs.delete_file(x.path)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _opened(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{root}/{m.name}")


class TokenReader(DataSourceReader):
    """doc_id, start, n_tokens, ids of the documents of each file."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[File]:
        return [File(x["name"], x["base"]) for x in _manifest(self.path)["files"] if x["docs"]] or [File("", 0)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, root = _opened(self.path)
        with fs.open_input_file(f"{root}/{partition.name}") as f:
            yield from documents_of(f, partition.base)


def documents_of(f: pa.NativeFile, base: int) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id, start, n_tokens, ids of one file; base: ids before it."""
    tail = f.size() - 56
    f.seek(tail)
    end = f.read(56)
    if end[-8:] != MAGIC:
        raise ValueError("not a whole file of token ids")
    n_ids, n_words, n_blocks, block, index_bytes, _ = np.frombuffer(end[:-8], "<u8").astype(np.int64)
    if block != simple8b.BLOCK:
        raise ValueError("blocks of another length")
    f.seek(len(MAGIC) + 8 * n_words)
    tables = np.frombuffer(f.read(16 * n_blocks), "<u8").astype(np.int64)
    first, full = np.append(tables[:n_blocks], n_words), tables[n_blocks:]
    index = pa.ipc.open_stream(f.read(int(index_bytes))).read_all() if index_bytes else None
    if index is None:
        return
    ids, lengths = index["doc_id"], index["n_tokens"].to_numpy()
    ends = np.cumsum(lengths)
    rest, held, done, at = [], 0, 0, 0  # decoded ids not yet given out, documents and ids given out
    for b in range(0, n_blocks, READ_BLOCKS):
        c = min(n_blocks, b + READ_BLOCKS)
        f.seek(len(MAGIC) + 8 * int(first[b]))
        words = np.frombuffer(f.read(8 * int(first[c] - first[b])), "<u8")
        got = simple8b.decode(words, first[b:c] - first[b], full[b:c] - first[b], int(min(n_ids, c * block) - b * block)).astype("<u4")
        rest.append(got)
        held += len(got)
        upto = int(np.searchsorted(ends, at + held, "right"))
        if upto > done:
            got = np.concatenate(rest)
            cuts = ends[done:upto] - at
            data = pa.py_buffer(got[: cuts[-1]].tobytes())
            offsets = pa.py_buffer((np.append(0, cuts) * 4).astype(np.int64).tobytes())
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), upto - done, [None, offsets, data]).cast(pa.binary())
            starts = base + ends[done:upto] - lengths[done:upto]
            yield pa.RecordBatch.from_arrays([_part(ids, done, upto), pa.array(starts), pa.array(lengths[done:upto]), binary], ["doc_id", "start", "n_tokens", "ids"])
            rest, held, at, done = [got[cuts[-1] :]], held - int(cuts[-1]), at + int(cuts[-1]), upto
    if done < len(lengths):  # documents without ids, at the end
        n = len(lengths) - done
        yield pa.RecordBatch.from_arrays([_part(ids, done, len(lengths)), pa.array(base + ends[done:]), pa.array(lengths[done:]), pa.array([b""] * n)], ["doc_id", "start", "n_tokens", "ids"])


def _part(column: pa.ChunkedArray, i: int, j: int) -> pa.Array:
    return pa.concat_arrays(column.slice(i, j - i).chunks) if j > i else pa.array([], column.type)


def _manifest(path: str) -> dict:
    fs, root = _opened(path)
    with fs.open_input_file(f"{root}/manifest.json") as f:
        return json.loads(f.read())


class TokenFiles(DataSource):
    """The format "token_files": writes doc_id, ids as files of Simple-8b words under path, and reads them as doc_id, start, n_tokens, ids.

    path is an absolute path or a URI that pyarrow opens, in a folder that driver and executors share. Only
    mode("overwrite") is taken: earlier files stay readable until the new ones are all written.
    """

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return f"doc_id {_manifest(self.options['path'])['doc_id']}, start long, n_tokens long, ids binary"

    def reader(self, schema: StructType) -> TokenReader:
        return TokenReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> TokenWriter:
        if not overwrite:
            raise ValueError('token_files takes mode("overwrite") only')
        fs, root = _opened(self.options["path"])
        fs.create_dir(root, recursive=True)
        return TokenWriter(self.options["path"], schema["doc_id"].dataType.simpleString())


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end: int | None = END, parts: int | None = None) -> None:
    """Encodes every whole text of docs and writes its ids to path, in ascending order of doc_id."""
    docs.sparkSession.dataSource.register(TokenFiles)
    ordered = in_order(docs, parts or planned_parts(docs, FILE_BYTES))
    token_ids(ordered, tokenizer, end).write.format("token_files").mode("overwrite").save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)


def op11_token_files(documents: DataFrame) -> DataFrame:
    """Digests of the documents' ids as read back from files under spark.checkpoint.dir."""
    import public_tokenizers

    spark = documents.sparkSession
    path = f"{shared_dir(spark)}/boutlake/token-files-{uuid.uuid4().hex}"
    write_token_files(documents, public_tokenizers.path("word_bpe_49k.json"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
