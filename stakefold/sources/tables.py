"""Access to the domain tables.

``Tables`` hands out one DataFrame per table name.  Jobs only ever ask it for
tables, so the same job runs on Parquet folders, catalog tables or derived data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.membership import KeyFilter, key_filter
from .schemas import table_schema
from .stage import StageArea

# Catalyst takes the size of compressed files for that of their rows.  Keys of 2 or 3 bytes in Parquet are 80 in a hash
# table, so tables of 10 MB were broadcast as 300 MB through the driver, several at once.
FACTOR, ROWS_PER_FILE_BYTES = "spark.sql.sources.fileCompressionFactor", 16.0


def expect_compressed(spark: SparkSession) -> None:
    """Let Catalyst judge by the size of the rows which tables are small enough to hand to every task; what turns out
    small is still broadcast by AQE.  A factor that the session has set stays."""
    if float(spark.conf.get(FACTOR)) == 1.0:
        spark.conf.set(FACTOR, str(ROWS_PER_FILE_BYTES))


# Below this much of a shuffle in one partition its rows fit a hash table many times over.
HASHED, ADVISED, MOST_HASHED = (
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20
)


def _bytes(spark: SparkSession, name: str) -> int:
    """A size that the session has set, in whichever unit."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


def expect_small_partitions(spark: SparkSession) -> None:
    """Let AQE join by a hash table what it has measured to be small in every partition, in place of sorting both sides.
    It does so from the advised size of partitions on, so where those are large nothing changes.  What the session has
    set stays."""
    advised = _bytes(spark, ADVISED)
    if not _bytes(spark, HASHED) and advised <= MOST_HASHED:
        spark.conf.set(HASHED, str(advised))


class Tables:
    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame], stage: StageArea | None = None):
        expect_compressed(spark)
        expect_small_partitions(spark)
        self.spark = spark
        self.stage = stage or StageArea(spark)
        self._load = load
        self.states = None  # an index of the state tables, where one is kept (plans.state_index)
        self._open: dict[str, DataFrame] = {}
        self._filters: dict[tuple[int, str], tuple[DataFrame, KeyFilter | None]] = {}

    def filter_of(self, keys: DataFrame, column: str) -> KeyFilter | None:
        """The filter of a stored frame's keys, counted, made and stored once for all tables and jobs that test it."""
        if (id(keys), column) not in self._filters:
            made = key_filter(keys.select(column), column, hold=lambda row: self.stage.put(row, f"filter-{column}"))
            self._filters[id(keys), column] = (keys, made)  # the frame is held, so no other gets its id
        return self._filters[id(keys), column][1]

    @classmethod
    def parquet(cls, spark: SparkSession, root: str) -> Tables:
        """One Parquet folder per table, read with the declared schema."""

        def load(name: str) -> DataFrame:
            return spark.read.schema(table_schema(name)).parquet(f"{root}/{name}")

        return cls(spark, load)

    @classmethod
    def catalog(cls, spark: SparkSession, database: str | None = None) -> Tables:
        prefix = f"{database}." if database else ""
        return cls(spark, lambda name: spark.table(prefix + name))

    @classmethod
    def frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        """Tables given as DataFrames; a table not given is empty with the declared schema."""

        def load(name: str) -> DataFrame:
            return frames[name] if name in frames else spark.createDataFrame([], table_schema(name))

        return cls(spark, load)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._load(name)
        return self._open[name]
