"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, x = floor(256 c).  The fit list has every distinct x once; its centred rows are the matrix X
that is never built: a pass over the stored list multiplies every row by the newest right vector v, takes off what the
earlier left vectors u hold of it, and sums the products with the rows (X'u), with all earlier left vectors (to
reorthogonalise) and with itself.  Left vectors have an entry a row and are not kept: a row's entries follow from its
products with the right vectors by forward substitution in the small triangular factor R of XV = UR, bidiagonal but
for the roundings that reorthogonalisation takes off.  The driver holds V and R, whose size is the dimension squared.

A pass gives one alpha and one beta.  A beta of nothing means that the space is used up: it starts anew with another
vector orthogonal to all before, so that repeated deviations are found as often as they are.  Steps end with the
dimension, or before it when the wanted triplets have settled to rounding and what is left of the trace is less than
the last of them, so that no direction outside can come before it.  The SVD of R gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakefold.llm import common

MOST = 1 << 62  # entries beyond are taken as this
EPS = float(np.finfo(np.float64).eps)
SUMS = "i long, v double"
APPLIED = "vec_id long, deviation long, whitened array<double>"


@dataclass(frozen=True)
class Settings:
    """scale times an entry is cut to an integer; so many components are wanted; seed is that of the start vectors."""

    scale: int = 256
    components: int = 4
    seed: int = 20240101


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with sums S; unit components (a column each) by falling variance; the trace of the covariance;
    the largest entry of the whitened fit list's covariance minus the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace if self.trace else self.variances


def integers(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, x) of the vectors that are usable, see whiten()."""
    entries = F.col("c")
    bad = F.exists(entries, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))

    def cut(v: Column) -> Column:
        return F.greatest(F.least(F.floor(v * F.lit(float(scale))), F.lit(MOST)), F.lit(-MOST))

    known = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    known = known.where(F.col("c").isNotNull() & (F.size("c") > 0) & ~bad)
    return known.select("vec_id", F.transform("c", cut).alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and the sum of each entry, in whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = None, 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                safe = int(np.abs(x).max()) * len(x) < 1 << 62
                part = x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)
                total, rows = part if total is None else total + part, rows + len(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total))), pa.array([rows] * len(total)), pa.array([str(v) for v in total])], ["i", "n", "s"])

    found = fit.select("x").mapInArrow(run, "i long, n long, s string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


class Centred:
    """x - S/n of integer rows: the whole part is taken off in whole numbers, so only the last step rounds."""

    def __init__(self, n: int, sums: tuple[int, ...]) -> None:
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def summed(fit: DataFrame, size: int, part) -> np.ndarray:
    """The sum over all rows of part(x), an array of so many numbers a batch of rows; one array a task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    found = fit.select("x").mapInArrow(run, SUMS).groupBy("i").agg(F.sum("v").alias("v")).collect()
    values = np.zeros(size)
    for row in found:
        values[row["i"]] = row["v"]
    return values


def left_vectors(products: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows of U from rows of XV = UR."""
    u = np.zeros_like(products)
    for j in range(products.shape[1]):
        if r[j, j]:
            u[:, j] = (products[:, j] - u[:, :j] @ r[:j, j]) / r[j, j]
    return u


def orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(fit: DataFrame, centred: Centred, wanted: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """V, R and the square sum of X.  Every step is one pass over the fit list."""
    size = len(centred.whole)
    rng = np.random.default_rng(seed)
    v = rng.standard_normal(size)
    v /= np.linalg.norm(v)
    basis, back, r = np.zeros((size, 0)), np.zeros((size, 0)), np.zeros((0, 0))
    beta, energy, scale = 0.0, 0.0, 0.0
    while True:
        k = basis.shape[1]

        def part(x: np.ndarray, basis=basis, r=r, v=v, beta=beta, k=k) -> np.ndarray:
            rows = centred(x)
            products = rows @ np.column_stack([basis, v])
            u = left_vectors(products[:, :k], r)
            w = products[:, k] - (beta * u[:, k - 1] if k else 0.0)
            return np.concatenate([rows.T @ w, u.T @ w, [w @ w, np.einsum("ij,ij->", rows, rows)]])

        found = summed(fit, size + k + 2, part)
        product, held, square, energy = found[:size], found[size : size + k], found[-2], found[-1]
        alpha = float(np.sqrt(max(0.0, square - held @ held)))
        scale = max(scale, alpha, beta)
        if alpha <= size * EPS * max(scale, np.sqrt(energy / size)):
            alpha = 0.0
        column = held.copy()
        if k:
            column[-1] += beta
        r = np.block([[r, column[:, None]], [np.zeros((1, k)), np.array([[alpha]])]])
        basis = np.column_stack([basis, v])
        z = (product - back @ held) / alpha if alpha else np.zeros(size)
        back = np.column_stack([back, z])
        if k + 1 == size or not energy:
            return basis, r, energy
        v = orthogonal(z, basis)
        beta = float(np.linalg.norm(v))
        if beta <= size * EPS * scale:  # used up: another start, orthogonal to all
            beta = 0.0
            v = orthogonal(rng.standard_normal(size), basis)
        v /= np.linalg.norm(v)
        if k + 1 >= wanted:
            p, s, _ = np.linalg.svd(r)
            outside = max(0.0, energy - float((s**2).sum())) + size * EPS * energy
            if (beta * np.abs(p[-1, :wanted]) <= 4 * EPS * s[0]).all() and outside < s[wanted - 1] ** 2:
                return basis, r, energy


def train(rows: DataFrame, settings: Settings = Settings()) -> Whitening | None:
    """The whitening of (vec_id, x); None if there is nothing to learn from."""
    fit = common.stored(rows.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit)
    if not n:
        common.drop_stored(fit)
        return None
    centred = Centred(n, tuple(sums))
    wanted = min(settings.components, len(sums))
    basis, r, energy = bidiagonalise(fit, centred, wanted, settings.seed)
    _, s, q = np.linalg.svd(r)
    kept = int((s[:wanted] > 8 * len(sums) * EPS * s[0]).sum()) if energy else 0
    components = basis @ q[:kept].T
    components /= np.linalg.norm(components, axis=0)
    lead = components[np.abs(components).argmax(axis=0), np.arange(kept)] if kept else np.zeros(0)
    components, variances = components * np.sign(lead), s[:kept] ** 2 / n

    def moments(x: np.ndarray) -> np.ndarray:
        white = centred(x) @ components / np.sqrt(variances)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = summed(fit, kept + kept * kept, moments) / n if kept else np.zeros(0)
    mean, second = found[:kept], found[kept:].reshape(kept, kept)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(kept)).max()) if kept else 0.0
    common.drop_stored(fit)
    return Whitening(n, tuple(sums), components, variances, energy / n, error)


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of (vec_id, x).  A deviation beyond a long is null."""

    def deviations(x: np.ndarray) -> list[int | None]:
        most = max(int(np.abs(x).max()) * model.n + max(map(abs, model.sums)), 1)
        if most * most * x.shape[1] < 1 << 63:
            off = x * model.n - np.array(model.sums, np.int64)
            return np.einsum("ij,ij->i", off, off).tolist()
        exact = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred = Centred(model.n, model.sums)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                white = centred(x) @ model.components / np.sqrt(model.variances)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], white.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(deviations(x), pa.int64()), lists], [f.split()[0] for f in APPLIED.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(run, APPLIED)


def usual_length(rows: DataFrame) -> int | None:
    found = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else None


def whiten(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
           settings: Settings = Settings()) -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold null or non-finite entries, are left out, as are those that are not as long
    as most are (of equally frequent lengths the longest counts).  Entries beyond 2^62 after scaling count as 2^62;
    a null id stays null; repeated rows come out as often as they come in and count once in the fit; other columns
    are not read.  A direction without variance is no component: one single distinct vector, or an empty table, gives no
    rows.  Components of equal variance are some basis of their space."""
    rows = integers(vectors, key, vector, settings.scale)
    length = usual_length(rows)
    rows = rows.where(F.size("x") == F.lit(length))
    model = None if length is None else train(rows, settings)
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return spark.createDataFrame([], names)
    each = F.posexplode("whitened").alias("place", "whitened")
    explained = F.get(F.array(*[F.lit(float(v)) for v in model.explained]), F.col("place"))
    return apply(rows, model).select("vec_id", "deviation", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
