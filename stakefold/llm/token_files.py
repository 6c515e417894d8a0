"""Token ids of documents in binary files of patched frame-of-reference blocks.

The ids of all documents, in ascending order of doc_id, form one stream that is cut into files and the files into
blocks of a fixed number of ids.  A block keeps its minimum and, for every id, what it exceeds the minimum by, in as
many bits as the percentile of these differences needs; the few that need more are listed beside it with their places
and whole differences (the packed place holds their low bits).  A file ends with the start of every block, the documents
with their lengths, and a footer, so any range of ids is read from the blocks it touches.

A task writes the documents of one range of ids, one file after the other, named after its own attempt; the reports of
the attempts that count are stored as the manifest.  Nothing but the reports (a row a file) leaves the tasks.

Layout, little-endian: magic | blocks | u64 start of each block, and their end | i64 doc_id, u64 length, u8 whether there
is an id, each for all documents | footer.  A block: u32 minimum, u8 bits, u8 zero, u16 exceptions, packed bits, u16
places, u32 differences.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stakefold.llm import common
from stakefold.llm.warc import filesystem

MAGIC = b"PFORIDS1"
HEAD = np.dtype([("least", "<u4"), ("bits", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
FOOTER = struct.Struct("<QQQQI8s")  # ids, documents, place of the block starts, place of the documents, block, magic
BLOCK_IDS = 512
BLOCKS_AT_ONCE = 256
PERCENTILE = 90
FILE_IDS = 1 << 26
END_ID = 1
KEPT_CHARS, MOST_KEPT = 64, 1 << 19
MANIFEST = "shard long, file string, ids long, documents long, bytes long"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def packed(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks (a row of ids each) as bytes, and the size of each."""
    count, length = ids.shape
    least = ids.min(axis=1)
    over = ids - least[:, None]
    place = -(-length * percentile // 100) - 1
    usual = np.partition(over, place, axis=1)[:, place]
    bits = np.ceil(np.log2(usual.astype(np.float64) + 1)).astype(np.uint8)
    head = np.zeros(count, HEAD)
    head["least"], head["bits"] = least, bits
    outlying = over.astype(np.uint64) >> bits[:, None].astype(np.uint64) > 0
    head["exceptions"] = outlying.sum(axis=1)
    bodies: list[bytes] = [b""] * count
    for width in np.unique(bits):
        rows = np.flatnonzero(bits == width)
        flat = np.unpackbits(over[rows].astype("<u4").view(np.uint8), axis=1, bitorder="little")
        flat = flat.reshape(len(rows), length, 32)[:, :, :width].reshape(len(rows), -1)
        for row, body in zip(rows, np.packbits(flat, axis=1, bitorder="little"), strict=True):
            bodies[row] = body.tobytes()
    parts, sizes = [], np.zeros(count, np.int64)
    for row in range(count):
        part = head[row].tobytes() + bodies[row]
        if head["exceptions"][row]:
            places = np.flatnonzero(outlying[row])
            part += places.astype("<u2").tobytes() + over[row, places].astype("<u4").tobytes()
        parts.append(part)
        sizes[row] = len(part)
    return b"".join(parts), sizes


def unpacked(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """The ids of the blocks that begin at starts, a row each."""
    raw = np.frombuffer(data, np.uint8)
    head = np.ascontiguousarray(raw[starts[:, None] + np.arange(HEAD.itemsize)]).view(HEAD)[:, 0]
    over = np.zeros((len(starts), length), np.uint32)
    for width in np.unique(head["bits"]).astype(int):
        rows, size = np.flatnonzero(head["bits"] == width), -(-length * width // 8)
        if width:
            body = raw[(starts[rows] + HEAD.itemsize)[:, None] + np.arange(size)]
            flat = np.zeros((len(rows), length, 32), np.uint8)
            flat[:, :, :width] = np.unpackbits(body, axis=1, bitorder="little")[:, : length * width].reshape(len(rows), length, width)
            over[rows] = np.packbits(flat.reshape(len(rows), -1), axis=1, bitorder="little").view("<u4")
    for row in np.flatnonzero(head["exceptions"]):
        count = int(head["exceptions"][row])
        at = int(starts[row]) + HEAD.itemsize + -(-length * int(head["bits"][row]) // 8)
        places = np.frombuffer(data, "<u2", count, at)
        over[row, places] = np.frombuffer(data, "<u4", count, at + 2 * count)
    return over + head["least"][:, None]


@dataclass
class Writer:
    """A file under way: full blocks are written as ids come, the index and the documents when it closes."""

    uri: str
    block: int = BLOCK_IDS
    percentile: int = PERCENTILE
    ids: int = 0
    waiting: list[np.ndarray] = field(default_factory=list)
    held: int = 0
    sizes: list[np.ndarray] = field(default_factory=list)
    keys: list[int | None] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    out: pa.NativeFile = field(init=False)

    def __post_init__(self) -> None:
        if not 0 < self.block < 1 << 16:
            raise ValueError("a block holds 1 to 65,535 ids")
        system, path = filesystem(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.out.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.ids, self.held = self.ids + len(ids), self.held + len(ids)
        if self.held >= self.block * BLOCKS_AT_ONCE:
            self._write(False)

    def _write(self, last: bool) -> None:
        flow = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        if last and len(flow) % self.block:
            flow = np.concatenate([flow, np.repeat(flow[-1:], -len(flow) % self.block)])
        whole = len(flow) // self.block
        for first in range(0, whole, BLOCKS_AT_ONCE):
            upto = min(whole, first + BLOCKS_AT_ONCE)
            data, sizes = packed(flow[first * self.block : upto * self.block].reshape(-1, self.block), self.percentile)
            self.out.write(data)
            self.sizes.append(sizes)
        rest = flow[whole * self.block :].copy()
        self.waiting, self.held = [rest] if len(rest) else [], len(rest)

    def close(self) -> tuple[str, int, int, int]:
        self._write(True)
        starts = len(MAGIC) + np.cumsum(np.concatenate([[0], *self.sizes]))
        index_at = int(starts[-1])
        documents_at = index_at + 8 * len(starts)
        known = np.array([key is not None for key in self.keys], np.uint8)
        for part in (starts.astype("<u8"), np.array([key or 0 for key in self.keys], "<i8"), np.array(self.lengths, "<u8"), known):
            self.out.write(part.tobytes())
        self.out.write(FOOTER.pack(self.ids, len(self.keys), index_at, documents_at, self.block, MAGIC))
        self.out.close()
        return self.uri, self.ids, len(self.keys), documents_at + 17 * len(self.keys) + FOOTER.size


class Reader:
    """A written file: its documents, and any range of its ids."""

    def __init__(self, uri: str) -> None:
        system, path = filesystem(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(FOOTER.size, max(0, size - FOOTER.size))
        if size < len(MAGIC) + FOOTER.size or tail[-8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is not a whole file of token ids")
        self.ids, count, index_at, documents_at, self.block, _ = FOOTER.unpack(tail)
        self.starts = np.frombuffer(self.file.read_at(documents_at - index_at, index_at), "<u8").astype(np.int64)
        self.keys = np.frombuffer(self.file.read_at(8 * count, documents_at), "<i8")
        self.lengths = np.frombuffer(self.file.read_at(8 * count, documents_at + 8 * count), "<u8").astype(np.int64)
        self.known = np.frombuffer(self.file.read_at(count, documents_at + 16 * count), np.uint8)

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def blocks(self, first: int, upto: int) -> np.ndarray:
        starts = self.starts[first : upto + 1]
        data = self.file.read_at(int(starts[-1] - starts[0]), int(starts[0]))
        return unpacked(data, starts[:-1] - starts[0], self.block).reshape(-1)

    def range(self, start: int, stop: int) -> np.ndarray:
        """The ids from start up to stop, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first = start // self.block
        return self.blocks(first, -(-stop // self.block))[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id, ids) of every document; some hundred blocks are held at a time, or one document's."""
        held, held_from, at = np.zeros(0, np.uint32), 0, 0
        for key, length, known in zip(self.keys.tolist(), self.lengths.tolist(), self.known.tolist(), strict=True):
            if at + length > held_from + len(held):
                first = at // self.block
                upto = min(len(self.starts) - 1, max(first + BLOCKS_AT_ONCE, -(-(at + length) // self.block)))
                held, held_from = self.blocks(first, upto), first * self.block
            yield key if known else None, at, held[at - held_from : at - held_from + length]
            at += length


# The normalizer and the pattern of words of the vocabulary files that chunks are known to be right for.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same pattern for lower-case text of ASCII and the letters of Latin-1, whose classes are the same in any version of Unicode.
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \n\ta-zß-öø-ÿ0-9]+")
PLAIN = re.compile(r"[ \n\t!-~À-ÖØ-öø-ÿ]*")


class Kept(dict):
    """Results of a function, in two generations that bound the memory: when the newer one is full it becomes the older,
    and what is used again moves up.  Long arguments are never kept."""

    def __init__(self, of: Callable[[str], bytes]) -> None:
        super().__init__()
        self.of, self.older = of, {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.of(text)
        if len(text) <= KEPT_CHARS:
            if len(self) >= MOST_KEPT:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class Encoder:
    """Ids of whole texts by the tokenizers library.  In a vocabulary that drops white space, blanks end every token, so
    a text's ids are those of its chunks between blanks in a row.  Where characters are plain, the words of the pattern
    go to the library's model one by one; other chunks go to the whole library; so do whole texts if the vocabulary
    file works in another way."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(vocabulary)
        self.model = self.library.model
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.known, self.added = self._known(json.loads(self.library.to_str()))
        self.words, self.chunks = Kept(self._word), Kept(self._library)

    @staticmethod
    def _known(file: dict) -> tuple[bool, re.Pattern]:
        steps = (file["normalizer"] or {}).get("normalizers", [])
        before = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
        added = file["added_tokens"]
        known = [s["type"] for s in steps] == NORMALIZERS and [s["type"] for s in before] == ["Split", "ByteLevel"]
        known = known and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " " and before[0]["pattern"] == {"Regex": WORDS}
        known = known and before[0]["behavior"] == "Removed" and before[0]["invert"] and not before[1]["add_prefix_space"]
        known = known and not any(t[flag] for t in added for flag in ("lstrip", "rstrip", "single_word", "normalized"))
        known = known and not any(set(t["content"]) & set(" \n\t") for t in added) and file["model"]["dropout"] is None
        return known, re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)")

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(word if word.isascii() else self.bytes_of(word)[0][0])]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes | None:
        if not PLAIN.fullmatch(text) or self.added.search(text):
            return None
        return b"".join(map(self.words.__getitem__, PLAIN_WORDS.findall(text.lower())))

    def _chunk(self, chunk: str) -> bytes:
        found = self._plain(chunk)
        return self.chunks[chunk] if found is None else found

    def encode(self, text: str) -> np.ndarray:
        if not self.known:
            found = self._library(text)
        elif (found := self._plain(text)) is None:
            found = b"".join(map(self._chunk, text.replace("\n", " ").replace("\t", " ").split(" ")))
        return np.frombuffer(found, "<u4")


@functools.cache
def encoder_of(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def write_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, block: int = BLOCK_IDS,
                percentile: int = PERCENTILE, file_ids: int = FILE_IDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all documents, an end id after each, write them in ascending order of the key and return the stored
    manifest (shard, file, ids, documents, bytes), shards rising with the key.

    A null text counts as empty: its end id alone.  A null key comes
    first.  Rows of one key, repeated rows too, are all written, in the order of a hash of their texts (equal texts have
    equal ids); so no key, however common, has to stay in one task.  A very long text is one document like any other; a
    file is closed after the document that fills it.  An empty table gives an empty manifest.  Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, done, number = TaskContext.get(), None, [], 0
        encode, end = encoder_of(vocabulary).encode, np.array([end_id], "<u4")
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    out = Writer(f"{folder}/part-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}.ids", block, percentile)
                out.add(doc, np.concatenate([encode(value or ""), end]))
                if out.ids >= file_ids:
                    done.append(((task.partitionId() << 32) + number, *out.close()))
                    out, number = None, number + 1
        if out is not None:
            done.append(((task.partitionId() << 32) + number, *out.close()))
        if done:
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    return common.stored(rows.mapInArrow(run, MANIFEST), "ids-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files in a manifest: doc_id, start (ids of all documents before it), n_tokens and the CRC-32 of
    its ids, all from what the files hold.  The running sum goes over the manifest, which has one row a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[tuple] = []
                with Reader(uri) as file:
                    for key, at, ids in file.documents():
                        out.append((key, before + at, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes())))
                        if len(out) >= 5_000:
                            yield batch_of(out)
                            out = []
                if out:
                    yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")
    files = max(1, manifest.count())
    return manifest.select("shard", "file", before.alias("before")).repartition(files, "shard").select(
        "file", "before").mapInArrow(run, SCHEMA)
