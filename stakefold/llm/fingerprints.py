"""I-Match document fingerprints over several randomised lexicons.

Document frequencies of all terms come from the whole corpus, counted over distinct texts, so a text weighs once however
many copies it has.  The lexicon keeps the terms whose inverse document frequency ln(N / df) lies in a band, so it can
hold no more than e^upper times the mean number of distinct terms of a text: that bounds what is broadcast, whatever
the size of the corpus.  Each of the subsets takes a random share of
the lexicon, fixed by a hash of the term.  For every subset, the distinct terms of a document in it are sorted and
hashed; the fingerprint is the list of these hashes.  Sparse subsets survive edits, dense ones tell documents apart.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = re.compile(r"\w+")
EMPTY = "-"
BUCKET_BITS = 24
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
DEALT = "place int, tail boolean, doc_id long, no_id boolean, tie long, packed binary"


@dataclass(frozen=True)
class Band:
    lower: float = math.log(4)
    upper: float = math.log(2000)
    rates: tuple[float, ...] = (1 / 8, 1 / 32, 1 / 128, 1 / 512)
    subsets_per_rate: int = 16


def terms(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


@dataclass(frozen=True)
class Copies:
    """How many distinct texts there are, and a bit map of the buckets of digests that hold a text with copies.  Its
    size is fixed; more texts only mean that more single ones share a bucket with copies."""

    texts: int
    bits: np.ndarray

    def suspected(self, digests: np.ndarray) -> np.ndarray:
        buckets = digests.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)
        return (self.bits[buckets >> np.uint64(3)] >> (buckets & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def find_copies(texts: DataFrame) -> Copies:
    """From (text, digest)."""
    groups = texts.groupBy("digest").agg((F.count("*") > 1).alias("copied"))
    bucket = F.when(F.col("copied"), F.shiftrightunsigned("digest", 64 - BUCKET_BITS))
    found = groups.groupBy(bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n")).toPandas()
    buckets = found["bucket"].dropna().to_numpy(np.int64)
    bits = np.zeros(1 << BUCKET_BITS - 3, np.uint8)
    np.bitwise_or.at(bits, buckets >> 3, np.uint8(1) << (buckets & 7).astype(np.uint8))
    return Copies(int(found["n"].sum()), bits)


def document_frequencies(texts: DataFrame, copies: Copies) -> DataFrame:
    """(term, df): term hashes with the number of distinct texts that hold them; counted first in every task.

    Of (text, digest), rows outside the suspected buckets have no copies and are counted where they lie.  Only the
    others are shuffled by their text and come to one row each, at most one a task from every text."""
    shared = texts.sparkSession.sparkContext.broadcast(copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t in counts), np.uint64, len(counts)).view(np.int64)
            n = np.fromiter(counts.values(), np.int64, len(counts))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["term", "n"])

        counts: Counter = Counter()
        for batch in batches:
            column = batch.column(0)
            if batch.num_columns > 1:
                column = column.filter(pa.array(~shared.value.suspected(batch.column(1).to_numpy())))
            for text in column.to_pylist():
                counts.update(terms(text))
            if len(counts) > 250_000:
                yield flush()
        yield flush()

    @F.pandas_udf("boolean")
    def suspected(digests: pd.Series) -> pd.Series:
        return pd.Series(shared.value.suspected(digests.to_numpy(np.int64)))

    found = texts.mapInArrow(run, "term long, n long")
    if copies.bits.any():
        once = texts.where(suspected("digest")).select("text").distinct()
        found = found.union(once.mapInArrow(run, "term long, n long"))
    return found.groupBy("term").agg(F.sum("n").alias("df"))


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted term hashes
    members: np.ndarray  # by key: bit k is set if the term is in subset k

    @staticmethod
    def of(hashes: np.ndarray, band: Band) -> Lexicon:
        keys = np.sort(hashes.astype(np.int64).view(np.uint64))
        members = np.zeros(len(keys), np.uint64)
        rates = [rate for rate in band.rates for _ in range(band.subsets_per_rate)]
        for k, rate in enumerate(rates):
            mixed = (keys ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            members |= ((mixed >> np.uint64(11)) < np.uint64(rate * 2 ** 53)).astype(np.uint64) << np.uint64(k)
        return Lexicon(keys, members)


def learn_lexicon(docs: DataFrame, band: Band) -> Lexicon:
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))
    copies = find_copies(texts)
    least, most = max(2, math.ceil(copies.texts / math.exp(band.upper))), math.floor(copies.texts / math.exp(band.lower))
    kept = document_frequencies(texts, copies).where(F.col("df").between(least, most)).select("term").toPandas()
    return Lexicon.of(kept["term"].to_numpy(np.int64), band)


class Printer:
    def __init__(self, lexicon: Lexicon, band: Band) -> None:
        self.lexicon, self.per_rate = lexicon, band.subsets_per_rate
        self.size = len(band.rates) * band.subsets_per_rate
        self.hashes: dict[str, int] = {}

    def __call__(self, text: str) -> list[str]:
        """The subset hashes.  A text without a lexicon term in any subset gets one hash of its terms, or of itself."""
        found = terms(text)
        if len(self.hashes) > 120_000:
            self.hashes.clear()
        for term in found:
            if term not in self.hashes:
                self.hashes[term] = xxhash.xxh64_intdigest(term)
        own = np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))
        own.sort()
        keys = self.lexicon.keys
        prints = [EMPTY] * self.size
        if len(keys) and len(own):
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            kept = own[keys[at] == own]
            members = self.lexicon.members[at[keys[at] == own]]
            if len(kept):
                inside = (members >> np.arange(self.size, dtype=np.uint64)[:, None] & np.uint64(1)).astype(bool)
                for k in np.flatnonzero(inside.any(axis=1)).tolist():
                    prints[k] = hashlib.blake2b(kept[inside[k]].tobytes(), digest_size=4).hexdigest()
        if all(p == EMPTY for p in prints):
            whole = own.tobytes() if len(own) else text.encode()
            return ["=" + hashlib.blake2b(whole, digest_size=16).hexdigest()]
        return prints


def likeness(one: list[str], other: list[str], per_rate: int) -> float:
    """Share of equal hashes among the subsets that are not empty in both: those of the sparsest rate of which at least
    half hold terms, so that a subset has about one term whatever the length of the text; else those of all rates."""
    if len(one) != len(other):
        return 0.0
    pairs = list(zip(one, other, strict=True))
    for start in (*range(len(pairs) - per_rate, -1, -per_rate), None):
        seen = [(a, b) for a, b in (pairs if start is None else pairs[start:start + per_rate]) if a != EMPTY or b != EMPTY]
        if start is None or 2 * len(seen) >= per_rate:
            break
    return sum(a == b for a, b in seen) / len(seen)


def with_successors(docs: DataFrame) -> DataFrame:
    """(place, tail, doc_id, no_id, tie, packed): each row in the place of its range of ids, sorted; the first row of a
    range comes a second time, marked as tail, at the end of the range before it (the first of all at the end of the
    last).  packed is the text, compressed before it is shuffled; tie is a hash of it, which orders rows of one id.

    The bounds of the ranges are quantiles of doc_id; only they and the smallest id of each range reach the driver."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
                       F.col("doc_id").isNull().alias("no_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / (8 * parts) for i in range(1, 8 * parts)]  # several ranges a partition, which evens them out
    bounds = np.unique(np.array(rows.approxQuantile("doc_id", shares, 1 / (32 * parts)) or [0.0]).astype(np.int64))

    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), side="right"))

    firsts = rows.groupBy(F.pandas_udf(place, "int")("doc_id").alias("place")).agg(F.min("doc_id").alias("first"))
    starts = sorted((r["place"], r["first"]) for r in firsts.collect())
    before = {first: starts[i - 1][0] for i, (_, first) in enumerate(starts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids, no_id = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            texts = [text.encode() for text in batch.column(2).to_pylist()]
            own = np.searchsorted(bounds, ids, side="right")
            again = np.array([i for i, known in enumerate(ids.tolist()) if known in before], np.int64)
            rows = np.concatenate([np.arange(len(ids)), again])
            place = np.concatenate([own, [before[i] for i in ids[again].tolist()]])
            ties = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), pa.array(np.arange(len(rows)) >= len(ids)), pa.array(ids[rows]), pa.array(no_id[rows]),
                 pa.array(ties[rows]), pa.array(list(map(pack, texts)), pa.binary()).take(pa.array(rows))],
                [f.split()[0] for f in DEALT.split(", ")])

    return rows.select("doc_id", "no_id", "text").mapInArrow(deal, DEALT).repartition(parts, "place").sortWithinPartitions(
        "place", "tail", "doc_id", "tie", "packed")


def fingerprint_documents(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Fingerprints of every document and of its edited text: the last quarter of its code points replaced by as many
    from the start of the next document (ascending doc_id, equal ids by a hash of their texts; after the last comes the first).

    Null texts count as empty, a null doc_id comes before all others.  Repeated rows each give a row.  Columns other
    than doc_id and text are not read.  An empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(learn_lexicon(docs, band))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fingerprint = Printer(shared.value, band)
        unpack = zstandard.ZstdDecompressor().decompress
        waiting: tuple | None = None  # place, doc_id, text, fingerprint
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5)]
            for place, tail, doc, no_id, packed in zip(*columns, strict=True):
                if tail and waiting is None:
                    continue
                text = unpack(packed).decode()
                own = fingerprint(text)
                if waiting is not None:
                    out.append(compared(fingerprint, *waiting[1:], text, own))
                waiting = None if tail else (place, None if no_id else doc, text, own)
            if out:
                names = [f.split()[0] for f in SCHEMA.split(", ")]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return with_successors(docs).mapInArrow(run, SCHEMA)


def compared(fingerprint: Printer, doc: int, text: str, own: list[str], following: str, next_print: list[str]) -> tuple:
    size = len(text) // 4
    edited = text[:len(text) - size] + following[:size]
    changed = fingerprint(edited)
    return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), " ".join(own), " ".join(changed),
            likeness(own, changed, fingerprint.per_rate), likeness(own, next_print, fingerprint.per_rate))
