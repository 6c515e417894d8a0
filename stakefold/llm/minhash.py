"""Near-duplicate documents by b-bit MinHash.

Every document gets the minima of many hash functions over its distinct word shingles.  Bands of whole minima give
candidate buckets; of each minimum only the low bits are kept, packed sixteen to a 64-bit word, and comparing two
signatures is counting bits of an exclusive or.  The share of equal lanes, corrected for lanes that agree by chance,
estimates the similarity.

Documents of equal shingle sets are one class from the start.  Inside the buckets all pairs of classes are estimated
(in blocks of bounded size, never emitted); pairs whose estimate is not far below the threshold bind classes to
families.  Inside a family the similarity is computed exactly on the full sets, again in blocks, and only links that
join what is not yet connected leave a task.  Components of these links are the groups of near-duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakefold.llm import common

LANE_BITS = 4
LANES = 64 // LANE_BITS
LOW = np.uint64(0x1111111111111111)


@dataclass(frozen=True)
class Settings:
    """Documents with 100 * intersection >= percent * union are linked.  slack is how far below the threshold an
    estimate may lie for the exact comparison to be made: wide enough that at the threshold the estimates of 120 hashes
    lose fewer pairs (5.4 in a hundred million, by the binomial distribution) than the bands (1.4 in ten million)."""

    words: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 4
    slack: float = 0.22
    block: int = 2048

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


WORDS = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(33)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles: A-Z in lower case, words between white space of ASCII.  A text with fewer
    words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    short = len(hashes) < size
    span = len(hashes) if short else size
    out = np.full(len(hashes) - span + 1, span if short else 0, np.uint64)
    for i in range(span):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - span + 1 + i])
    return np.unique(out)


def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20240101).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 2048):
        np.minimum(out, (factors[:, None] * values[None, start:start + 2048]).min(axis=1), out=out)
    return mixed(out)


def packed(found: np.ndarray) -> np.ndarray:
    """The low bits of the minima, LANES to a word; missing lanes are 0."""
    lanes = np.zeros(-(-len(found) // LANES) * LANES, np.uint64)
    lanes[:len(found)] = found & np.uint64((1 << LANE_BITS) - 1)
    shifts = np.arange(LANES, dtype=np.uint64) * np.uint64(LANE_BITS)
    return np.bitwise_or.reduce(lanes.reshape(-1, LANES) << shifts, axis=1)


def estimates(one: np.ndarray, many: np.ndarray, hashes: int) -> np.ndarray:
    """Similarity of a signature with others, from counted bits, corrected for lanes equal by chance."""
    differ = many ^ one
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    equal = 1 - np.bitwise_count(differ & LOW).sum(axis=1) / hashes
    chance = 2.0 ** -LANE_BITS
    return (equal - chance) / (1 - chance)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n, key, signature, bands): set size, digest of the whole set, packed low bits, hashes of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(settings.hashes)
        band = np.arange(1, settings.bands + 1, dtype=np.uint64)
        for batch in batches:
            n, key, signature, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, settings.words)
                n.append(len(own))
                key.append(xxhash.xxh3_128_digest(own.tobytes()))
                if not len(own):
                    signature.append(b"")
                    bands.append([])
                    continue
                found = minima(own, factors)
                signature.append(packed(found).tobytes())
                mark = band.copy()
                for column in found.reshape(settings.bands, settings.rows).T:
                    mark = mixed(mark * np.uint64(0x9E3779B97F4A7C15) + column)
                bands.append(mark.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(signature, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n", "key", "signature", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, key binary, signature binary, bands array<long>")


def stars(ids: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From group numbers, pairs of the smallest id of each group and every other id of it."""
    order = np.lexsort((ids, groups))
    ids, groups = ids[order], groups[order]
    first = np.r_[True, groups[1:] != groups[:-1]]
    heads = ids[first][np.cumsum(first) - 1]
    other = heads != ids
    return heads[other], ids[other]


def estimated_groups(signature: np.ndarray, sizes: np.ndarray, settings: Settings) -> np.ndarray:
    """Group numbers: connected by pairs whose estimate reaches the threshold less the slack and whose sizes allow it."""
    least, share = settings.percent / 100 - settings.slack, settings.percent / 100
    groups, free = np.zeros(len(sizes), np.int64), np.arange(len(sizes))
    number = 0
    while len(free):
        number += 1
        waiting, free = [free[0]], free[1:]
        while waiting and len(free):
            at = waiting.pop()
            groups[at] = number
            near = (estimates(signature[at], signature[free], settings.hashes) >= least)
            near &= (sizes[free] >= share * sizes[at] * 0.999) & (sizes[at] >= share * sizes[free] * 0.999)
            waiting.extend(free[near].tolist())
            groups[free[near]] = number
            free = free[~near]
        groups[waiting] = number
    return groups


def family_links(buckets: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) with a < b, binding classes whose estimated similarity inside a bucket is not far below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.segments(batches, 3):
            if table.num_rows < 2:
                continue
            ids, sizes = table.column(3).to_numpy(), table.column(4).to_numpy()
            signature = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint64).reshape(len(ids), -1)
            a, b = stars(ids, estimated_groups(signature, sizes, settings))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return buckets.select("bucket", "lo", "hi", "doc_id", "size", "signature").mapInArrow(run, "a long, b long").distinct()


def exact_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component numbers of the links 100 * intersection >= percent * union among these sets.

    Whole rows of intersections are counted at a time.  A document outside the largest component is compared with all
    others; then no pair across components is left, and pairs inside the largest need no comparison."""
    sizes = np.array([len(s) for s in sets])
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    mark = np.zeros(numbers.max() + 1, bool)
    group = np.arange(len(sets))
    done = np.zeros(len(sets), bool)
    while True:
        count = np.bincount(group, minlength=len(sets))
        largest = int(count.argmax())
        open_ = np.flatnonzero(~done & (group != largest))
        if not len(open_):
            if count[largest] > 1 or done.all():
                return group
            open_ = np.flatnonzero(~done)
        at = int(open_[0])
        own = numbers[starts[at]:starts[at] + sizes[at]]
        mark[own] = True
        common_ = np.add.reduceat(mark[numbers], starts)
        mark[own] = False
        linked = 100 * common_ >= percent * (sizes + sizes[at] - common_)
        for other in np.unique(group[linked]):
            group[group == other] = group[at]
        done[at] = True


def exact_links(members: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): links that connect the classes of a block of a family, from the full shingle sets of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.segments(batches, 3):
            if table.num_rows < 2:
                continue
            ids = table.column(3).to_numpy()
            sets = [shingles(text, settings.words) for text in table.column(4).to_pylist()]
            a, b = stars(ids, exact_groups(sets, settings.percent))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return members.select("family", "lo", "hi", "doc_id", "text").mapInArrow(run, "a long, b long").distinct()


def groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    component_id is the smallest doc_id reachable by links, kept tells whether that is the document itself.  Texts that
    are null or have no word have no shingle and link with nothing.  Rows with a null doc_id are their own group: their
    component_id is null and they are kept.  Rows that share a doc_id are taken for one document by its id.  Only doc_id
    and text are read; an empty table gives no rows."""
    common.drop_used_shuffles(docs.sparkSession)
    signed = common.stored(signatures(docs, settings), "signatures")
    sets = signed.where("n > 0 and doc_id is not null")
    first = sets.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = sets.select("doc_id", "key").join(first, "key").where("doc_id <> first").select("doc_id", "first").distinct()
    copies = copies.checkpoint()
    classes = sets.join(copies, "doc_id", "left_anti")

    bands = classes.select("doc_id", F.col("n").alias("size"), "signature", F.explode("bands").alias("bucket"))
    sizes = classes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = common.in_blocks(bands, sizes, "bucket", "doc_id", settings.block)
    families = common.components(family_links(buckets, settings))

    members = families.select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(members, "doc_id")
    family_sizes = members.groupBy("family").agg(F.count("*").alias("n"))
    links = exact_links(common.in_blocks(texts, family_sizes, "family", "doc_id", settings.block // 2), settings)

    linked = common.components(links.unionAll(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))))
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(
        linked.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", "component_id",
                     F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")).checkpoint()
    common.drop_stored(signed)
    return out
