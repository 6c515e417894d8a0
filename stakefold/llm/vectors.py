"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to all filters whose scalar product with it exceeds a threshold.  The
directions are structured: after a random rotation the vector is cut in two halves, each half has a random codebook,
and every pair of codewords is a direction, a million of them for two books of 1,024.  Scores add up over the halves,
so the list of all exceeding directions is decoded from the two sorted score lists without looking at the others.
How many filters a vector has depends on its luck with a codebook, so several independent codes are used.

Vectors with equal labels meet where they share a filter, in blocks of bounded size, and the cosine is computed in
double precision.  A pair that shares several filters counts in the smallest of them only.  Tests and README give the
recall measured against brute force.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakefold.llm import common

SMALLEST = 8  # vectors of fewer dimensions have one filter, and so meet all of their label


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    codes: int = 6
    codewords: int = 1024
    filters: float = 8.0  # mean number of filters of a vector in each code
    block: int = 2048


@dataclass(frozen=True)
class Code:
    rotation: np.ndarray
    books: tuple[np.ndarray, np.ndarray]
    threshold: float

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = unit @ self.rotation
        cut = self.books[0].shape[1]
        return turned[:, :cut] @ self.books[0].T, turned[:, cut:] @ self.books[1].T

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each row, the numbers of all directions that exceed the threshold, sorted."""
        left, right = self.halves(unit)
        size, width = left.shape[1], 48
        while True:  # wide enough if no codeword beyond the width can exceed the threshold with the other half's best
            width = min(width, size)
            by_left, by_right = best(left, width), best(right, width)
            top_left, top_right = np.take_along_axis(left, by_left, 1), np.take_along_axis(right, by_right, 1)
            if width == size or not ((top_left[:, -1] + top_right[:, 0] > self.threshold).any()
                                     or (top_right[:, -1] + top_left[:, 0] > self.threshold).any()):
                break
            width *= 2
        row, i, j = np.nonzero(top_left[:, :, None] + top_right[:, None, :] > self.threshold)
        numbers = by_left[row, i].astype(np.int64) * size + by_right[row, j]
        edges = np.searchsorted(row, np.arange(len(unit) + 1))
        return [np.sort(numbers[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def best(scores: np.ndarray, width: int) -> np.ndarray:
    """By row, the columns of the highest scores, in descending order."""
    found = np.argpartition(-scores, width - 1, axis=1)[:, :width] if width < scores.shape[1] else np.arange(scores.shape[1])[None, :].repeat(len(scores), 0)
    return np.take_along_axis(found, np.argsort(-np.take_along_axis(scores, found, 1), axis=1), 1)


def units(rng: np.random.Generator, n: int, d: int) -> np.ndarray:
    x = rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@functools.cache
def code(dimensions: int, number: int, settings: Settings) -> Code:
    """A code of a dimension, the same in every task.  The threshold gives random directions the wanted mean number."""
    rng = np.random.default_rng((dimensions, number))
    rotation = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0]
    cut = dimensions // 2
    made = Code(rotation, (units(rng, settings.codewords, cut), units(rng, settings.codewords, dimensions - cut)), 0.0)
    probes = made.halves(units(rng, 200, dimensions))
    totals = (np.sort(probes[0])[:, -128:, None] + np.sort(probes[1])[:, None, -128:]).ravel()
    keep = int(settings.filters * 200)
    return Code(rotation, made.books, float(np.partition(totals, len(totals) - keep)[len(totals) - keep]))


def filters_of(unit: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """By row, the sorted numbers of its filters in all codes."""
    d, size = unit.shape[1], settings.codewords ** 2
    if d < SMALLEST:
        return [np.zeros(1, np.int64)] * len(unit)
    lists = [code(d, n, settings).decode(unit) for n in range(settings.codes)]
    return [np.concatenate([own + n * size for n, own in enumerate(rows)]) for rows in zip(*lists, strict=True)]


def stored_vector(x: np.ndarray) -> bytes:
    """Eight bytes a component, or four if that is exact."""
    short = x.astype(np.float32)
    return b"f" + short.tobytes() if (short == x).all() else b"d" + x.tobytes()


def loaded_vector(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float32 if data[:1] == b"f" else np.float64, offset=1).astype(np.float64)


def filtered(vectors: DataFrame, settings: Settings) -> DataFrame:
    """(vec_id, label, key, vector, filters) of the vectors that can link; key is a digest of label and components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, raw, found = [], [], [], []
            for vec_id, label, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if vec_id is None or label is None or not values or None in values:
                    continue
                x = np.array(values, np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(vec_id)
                    labels.append(label)
                    raw.append(x)
            found = [np.zeros(0, np.int64)] * len(raw)
            for d in {len(x) for x in raw}:
                rows = [i for i, x in enumerate(raw) if len(x) == d]
                for start in range(0, len(rows), 256):
                    some = rows[start:start + 256]
                    x = np.array([raw[i] / np.abs(raw[i]).max() for i in some])
                    for i, own in zip(some, filters_of(x / np.linalg.norm(x, axis=1, keepdims=True), settings), strict=True):
                        found[i] = own
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(x.tobytes(), seed=label & 0xFFFFFFFF) for x, label in zip(raw, labels, strict=True)]),
                     pa.array([stored_vector(x) for x in raw]), pa.array(found, pa.list_(pa.int32()))],
                    ["vec_id", "label", "key", "vector", "filters"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, label long, key binary, vector binary, filters array<int>")


def linked_pairs(unit: np.ndarray, cosine: float) -> np.ndarray:
    pairs = unit @ unit.T >= cosine
    np.fill_diagonal(pairs, False)
    return pairs


def smaller_shared(filters: list[np.ndarray], here: int) -> np.ndarray:
    """Whether two rows share a filter below this one."""
    below = [f[f < here] for f in filters]
    known, numbers = np.unique(np.concatenate(below), return_inverse=True)
    has = np.zeros((len(filters), len(known)), np.float32)
    has[np.repeat(np.arange(len(below)), [len(b) for b in below]), numbers] = 1
    return has @ has.T > 0


def block_links(table: pa.Table, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(vec_id, links counted here, smallest id linked with it in this block) of the classes with links."""
    ids, labels, copies = (table.column(c).to_numpy() for c in ("vec_id", "label", "copies"))
    here, own = table.column("filter").to_numpy(), table.column("own").to_numpy()
    raw = [loaded_vector(v) for v in table.column("vector").to_pylist()]
    lists = table.column("filters").to_pylist()
    kinds = {}  # one bucket holds one label, dimension and filter but for colliding hashes
    for i, x in enumerate(raw):
        kinds.setdefault((labels[i], len(x), here[i]), []).append(i)
    for (_, _, at), rows in kinds.items():
        if len(rows) < 2:
            continue
        x = np.array([raw[i] / np.abs(raw[i]).max() for i in rows])
        pairs = linked_pairs(x / np.linalg.norm(x, axis=1, keepdims=True), cosine)
        if not pairs.any():
            continue
        side = own[rows]
        across = side[:, None] != side[None, :] if len(set(side.tolist())) > 1 else np.ones_like(pairs)
        touched = np.flatnonzero(pairs.any(axis=1))
        pairs, across, kept = pairs[np.ix_(touched, touched)], across[np.ix_(touched, touched)], [rows[i] for i in touched]
        counted = pairs & across & ~smaller_shared([np.array(lists[i], np.int64) for i in kept], int(at))
        group = components_of(pairs)
        a, b = ids[kept], np.empty(len(kept), np.int64)
        for g in np.unique(group):
            b[group == g] = a[group == g].min()
        yield a, counted @ copies[kept], b


def components_of(pairs: np.ndarray) -> np.ndarray:
    group = np.full(len(pairs), -1)
    for start in range(len(pairs)):
        if group[start] < 0:
            front = np.zeros(len(pairs), bool)
            front[start] = True
            while front.any():
                group[front] = start
                front = pairs[front].any(axis=0) & (group < 0)
    return group


def groups(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors with an equal, non-null label and a cosine of at least the threshold are linked.  Null, zero, empty and
    non-finite vectors and those of another dimension link with nothing.  Equal vectors form one class that is compared
    once.  Rows that share a vec_id are each counted, and take part in links under that one id.  A row without vec_id
    has no links and no component and is kept.  Columns other than vec_id, embedding and label are not read."""
    common.small_batches(vectors.sparkSession)
    found = common.stored(filtered(vectors, settings), "filtered")
    classes = found.groupBy("label", "key").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = classes.checkpoint()
    first = classes.select(F.col("first").alias("vec_id"), "key", "label", "copies")
    heads = found.join(first, ["vec_id", "key", "label"]).dropDuplicates(["vec_id", "key", "label"])
    heads = heads.withColumn("size", F.octet_length("vector")).checkpoint()
    # Only ids meet by filter first; vectors follow where there is more than one.
    light = heads.select("vec_id", "label", "size", F.explode("filters").alias("filter"))
    light = light.withColumn("bucket", F.xxhash64("label", "filter", "size"))
    sizes = light.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = common.in_blocks(light, sizes, "bucket", "vec_id", settings.block,
                              heads.select("vec_id", "label", "size", "key", "copies", "vector", "filters"),
                              ["vec_id", "label", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.segments(batches, 3):
            for a, links, b in block_links(table, settings.cosine) if table.num_rows > 1 else ():
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(links.astype(np.int64)), pa.array(b)],
                                                 ["vec_id", "links", "low"])

    columns = ["bucket", "lo", "hi", "own", "vec_id", "label", "copies", "filter", "vector", "filters"]
    linked = blocks.select(columns).mapInArrow(run, "vec_id long, links long, low long").checkpoint()
    counts = linked.groupBy("vec_id").agg(F.sum("links").alias("links"))
    members = found.join(classes, ["label", "key"]).select("vec_id", "label", "key", "first", "copies")
    edges = linked.select(F.col("low").alias("a"), F.col("vec_id").alias("b")).unionAll(
        members.select(F.col("first").alias("a"), F.col("vec_id").alias("b"))).where("a <> b").distinct()
    component = common.components(edges)
    per_row = members.join(counts.withColumnRenamed("vec_id", "first"), "first", "left").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    per_row = per_row.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(per_row, "vec_id", "left").join(
        component.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
