"""Written intermediates.

A result that several branches read is written once, as Parquet, in a folder
all executors share and read back.  That cuts lineage, survives lost executors,
and gives Catalyst true sizes, so that its size-checked broadcast choice works
on intermediates as well.  The folder is the one given, or the one that
``spark.checkpoint.dir`` names.  Without either nothing is written: the result
is persisted, and Spark computes blocks anew that were lost with an executor.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLLECT_S = 2.0  # seconds between collections of garbage


def file_system(spark: SparkSession, path: str):
    """A path and its file system, whichever that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    target, system = file_system(spark, path)
    system.delete(target, True)


def swap_folder(spark: SparkSession, new: str, place: str) -> None:
    """Put a written folder in the place of another; if that fails the old one is put back."""
    source, system = file_system(spark, new)
    target, _ = file_system(spark, place)
    aside, _ = file_system(spark, f"{new}_old")
    held = system.exists(target)
    if held and not system.rename(target, aside):
        raise RuntimeError(f"{place}: the old rows could not be put aside")
    if not system.rename(source, target):
        if held:
            system.rename(aside, target)
        raise RuntimeError(f"{place}: the new rows could not be put in place")
    if held:
        system.delete(aside, True)


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's checkpoint folder, if one is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else None


class StageArea:
    """One private sub-folder per run."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark)
        self._root: str | None = None
        self._taken: set[str] = set()
        self._places: dict[str, str] = {}
        self._held: list[DataFrame] = []
        self._collected = time.monotonic()

    @classmethod
    def scratch(cls, spark: SparkSession) -> StageArea:
        """An area for files that a lazy result still reads: dropped when the program ends."""
        area = cls(spark)

        def end() -> None:
            with contextlib.suppress(Exception):  # the session may be gone already
                area.clear()

        atexit.register(end)
        return area

    @property
    def root(self) -> str:
        """Where files of this run go; without a shared folder that is beside the warehouse's tables, which executors share."""
        if self._root is None:
            folder = self.folder or f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stage"
            self._root = f"{folder}/run-{uuid.uuid4().hex}"
        return self._root

    def _path(self, name: str) -> str:
        label, n = name, 1
        while label in self._taken:
            n += 1
            label = f"{name}-{n}"
        self._taken.add(label)
        return f"{self.root}/{label}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the stored table."""
        return self.put_all({name: df})[name]

    def put_all(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Store independent results, one after the other: the driver holds the plan, the broadcasts and the threads of
        one job at a time."""
        if not self.folder:
            held = {name: df.persist() for name, df in frames.items()}
            self._held += held.values()
            return held
        return self._write_all(frames)

    def put_parts(self, parts: Sequence[DataFrame], name: str) -> DataFrame:
        """Store what adds up to a result and return it as one table.

        Each part is a job of its own.  What the driver keeps of a plan grows with the square of the plan, as adaptive
        execution plans all of it anew after each of its stages."""
        schema = reduce(DataFrame.unionByName, parts).schema
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        stored = self.put_all({f"{name}-part{n}": part.select(*columns) for n, part in enumerate(parts)})
        if not self.folder:
            return reduce(DataFrame.unionByName, stored.values())
        return self.spark.read.schema(schema).parquet(*[self._places[label] for label in stored])

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` in any case and return the stored table."""
        return self._write_all({name: df})[name]

    def _write_all(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        paths = {name: self._path(name) for name in frames}
        self._places |= paths
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(paths[name])
            # what the job broadcast and shuffled goes when the driver collects its garbage, and its heap shrinks again;
            # plans of results that nothing reads any more are held by Python until it has collected its own.  Jobs of
            # less than a second leave little, so some of them share one collection
            if time.monotonic() - self._collected > COLLECT_S:
                gc.collect()
                self.spark._jvm.System.gc()
                self._collected = time.monotonic()
        return {name: self.spark.read.schema(df.schema).parquet(paths[name]) for name, df in frames.items()}

    def clear(self) -> None:
        """Drop this run's stored tables, once its result is written elsewhere."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        if self._root is not None:
            drop_folder(self.spark, self._root)
        self._root = None
        self._taken.clear()
