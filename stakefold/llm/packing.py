"""Vector bin packing of documents or instruction examples into training sequences.

Every item has a demand in three limits at once: tokens, segments (one each) and loss-bearing tokens.  A sequence is
filled by the dot-product heuristic: of the items that fit, the next is the one whose demand, in parts of the limits,
has the largest scalar product with what is left of the limits.  When nothing fits any more and items may be cut, the
item with the most tokens gives up a piece that fills the sequence.

Packing is done inside each partition in a pool of bounded size, so it needs no shuffle.  The last tokens of a
partition go to sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

END_ID = 0
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "loss_tokens long")


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024
    pool: int = 512


@functools.cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """The byte-level vocabulary's encoder of ordinary text.  The file of ranks holds the vocabulary of
    byte_bpe_50k.json; the ids are those of the tokenizers library (a test compares them), four times as fast."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


@functools.cache
def document_encoder(path: str) -> Callable[[str], list[int]]:
    """The ids that the tokenizers library gives for the json beside the file of ranks, without special tokens put
    around the text: added tokens that stand in the text have their own ids, what lies between them is ordinary."""
    ordinary = encoder(path)
    with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"added tokens of {path} that take in or look at their neighbours are not supported")
    ids = {token["content"]: token["id"] for token in added}
    if not ids:
        return ordinary
    split = re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")").split

    def encode(text: str) -> list[int]:
        parts = split(text)
        if len(parts) == 1:
            return ordinary(text)
        found = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(ids[part])
            else:
                found += ordinary(part)
        return found

    return encode


def choose(demand: np.ndarray, left: np.ndarray, caps: np.ndarray) -> int:
    """Index of the item that fits and has the largest dot product with what is left; -1 if none fits."""
    fits = (demand <= left).all(axis=1)
    if not fits.any():
        return -1
    score = np.where(fits, (demand / caps) @ (left / caps), -1.0)
    return int(score.argmax())


class Packer:
    """Items are (key, ids, loss mask); pieces come out as tuples in the order of SCHEMA."""

    def __init__(self, limits: Limits, first_sequence: int, cut: bool = True, cut_longer: bool = False) -> None:
        self.limits, self.sequence, self.cut, self.cut_longer = limits, first_sequence, cut, cut or cut_longer
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.items: list[tuple] = []  # key, ids, mask, start, tokens of the whole document, loss-bearing tokens left

    def _next(self) -> int:
        self.sequence += 1
        return self.sequence - 1

    @staticmethod
    def _piece(item: tuple, size: int, sequence: int, offset: int) -> tuple[tuple, tuple | None]:
        key, ids, mask, start, total, loss = item
        used = loss if size == len(ids) else int(mask[:size].sum())
        row = (key, start, size, zlib.crc32(ids[:size].tobytes()), total, sequence, offset, used)
        return row, (key, ids[size:], mask[size:], start + size, total, loss - used) if size < len(ids) else None

    def _most(self, item: tuple, tokens: int, loss: int) -> int:
        """The longest prefix of the item with at most so many tokens and loss-bearing tokens."""
        if item[5] <= loss or tokens <= loss:
            return min(tokens, len(item[1]))
        return int(min(tokens, len(item[1]), np.searchsorted(np.cumsum(item[2][:tokens]), loss, side="right")))

    def add(self, key: int, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple]:
        item = (key, ids, mask, 0, len(ids), int(mask.sum()))
        if not self.cut_longer and (len(ids) > self.limits.tokens or item[5] > self.limits.loss):
            raise ValueError(f"example {key} exceeds a limit and must not be cut")
        while item is not None and self.cut_longer and (len(item[1]) >= self.limits.tokens or item[5] > self.limits.loss):
            row, item = self._piece(item, max(1, self._most(item, self.limits.tokens, self.limits.loss)), self._next(), 0)
            yield row
        if item is not None:
            self.items.append(item)
        while len(self.items) >= self.limits.pool:
            yield from self._sequence()

    def _demand(self) -> np.ndarray:
        return np.array([(len(i[1]), 1, i[5]) for i in self.items], dtype=float)

    def _sequence(self) -> Iterator[tuple]:
        sequence, offset, left = self._next(), 0, self.caps.copy()
        demand = self._demand()
        alive = np.ones(len(self.items), bool)
        while alive.any() and left[0] > 0:
            live = np.flatnonzero(alive)
            at = choose(demand[live], left, self.caps)
            if at < 0:
                break
            at = live[at]
            row, _ = self._piece(self.items[at], int(demand[at, 0]), sequence, offset)
            yield row
            offset, left, alive[at] = offset + row[2], left - demand[at], False
        if self.cut and alive.any() and left[0] > 0 and left[1] > 0:
            at = np.flatnonzero(alive)[demand[alive][:, 0].argmax()]
            size = self._most(self.items[at], int(left[0]), int(left[2]))
            if size:
                row, rest = self._piece(self.items[at], size, sequence, offset)
                yield row
                self.items[at] = rest
                alive[at] = rest is not None
        self.items = [item for item, stays in zip(self.items, alive, strict=True) if stays]

    def finish(self) -> Iterator[tuple]:
        """What is left in the pool: full sequences, then, if cuts are allowed, sequences of powers of two."""
        while self.items and (not self.cut or sum(len(i[1]) for i in self.items) >= self.limits.tokens
                              or len(self.items) > self.limits.segments):
            yield from self._sequence()
        total = sum(len(i[1]) for i in self.items)
        sizes = [1 << bit for bit in reversed(range(total.bit_length())) if total >> bit & 1]
        rest: list[tuple] = self.items[::-1]
        self.items = []
        for size in sizes:
            sequence, offset, loss = self._next(), 0, self.limits.loss
            while offset < size:
                item = rest.pop()
                room = self._most(item, size - offset, loss)
                if not room:  # only a loss limit below the token limit leads here
                    rest.append(item)
                    break
                row, left = self._piece(item, room, sequence, offset)
                yield row
                offset, loss = offset + row[2], loss - row[7]
                if left is not None:
                    rest.append(left)
        if rest:
            self.items = rest[::-1]
            while self.items:
                yield from self._sequence()


def packed(rows: DataFrame, items: Callable[[pa.RecordBatch], Iterator[tuple]], limits: Limits, cut: bool) -> DataFrame:
    """Pieces of the (key, ids, mask) that items makes of the batches, packed inside each partition."""

    def pieces(packer: Packer, batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [row for item in items(batch) for row in packer.add(*item)]
        yield list(packer.finish())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        packer = Packer(limits, TaskContext.get().partitionId() << 40, cut, cut_longer=True)
        for out in pieces(packer, batches):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    return rows.mapInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, vocabulary: str, limits: Limits = Limits(), key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Pieces of all documents, packed.  A null or empty text is its end id alone; texts of any length are cut; ties in
    the heuristic go to the earlier item; repeated rows are packed as often as they come; an empty table has no pieces;
    other columns are not read.  Token arrays of one batch of rows and the pool are all that a task holds."""

    def items(batch: pa.RecordBatch) -> Iterator[tuple]:
        encode = document_encoder(vocabulary)
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.array([*encode(value or ""), END_ID], dtype="<u4")
            mask = np.ones(len(ids), np.int64)
            mask[-1] = 0
            yield doc, ids, mask

    return packed(docs.select(docs[key].alias("doc_id"), docs[text].alias("text")), items, limits, cut=True)


def pack_instructions(examples: DataFrame, limits: Limits, cut: bool = False, key: str = "doc_id", ids: str = "ids",
                      mask: str = "loss_mask") -> DataFrame:
    """Pieces of tokenised instruction examples: ids is an array of token ids, mask one of 0 and 1 beside it, 1 for the
    tokens that bear loss.  Unless cut is set, every example stays whole; one that no sequence can hold is cut all the same.

    Null ids are an example without tokens, which takes up a segment.  Without a mask all tokens bear loss; entries that are null or missing
    are 0, those beyond the ids are not read.  Ties go to the earlier row, repeated rows are packed as often as they come,
    an empty table has no pieces, other columns are not read."""

    def items(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc, tokens, marks in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            tokens = np.array(tokens or [], "<u4")
            bears = np.ones(len(tokens), np.int64)
            if marks is not None:
                given = np.array([bool(m) for m in marks[:len(tokens)]], np.int64)
                bears = np.r_[given, np.zeros(len(tokens) - len(given), np.int64)]
            yield doc, tokens, bears

    rows = examples.select(examples[key].cast("long").alias("doc_id"), examples[ids].cast("array<long>").alias("ids"),
                           examples[mask].cast("array<int>").alias("mask"))
    return packed(rows, items, limits, cut)


def pack_examples(examples: list[tuple[int, np.ndarray, np.ndarray]], limits: Limits) -> list[tuple]:
    """Pack whole (key, ids, loss mask) examples of one partition without cutting any."""
    packer = Packer(limits, 0, cut=False)
    rows = [row for key, ids, mask in examples for row in packer.add(key, np.asarray(ids, "<u4"), np.asarray(mask, np.int64))]
    return rows + list(packer.finish())
