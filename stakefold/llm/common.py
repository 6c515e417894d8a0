"""Helpers shared by the training-data operators: shared folder, written intermediates, components of links."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: hand Python a thousand rows at a time, not ten thousand."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one beside the warehouse's tables where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stage/llm-{uuid.uuid4().hex}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, gives true sizes."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def drop_used_shuffles(spark: SparkSession) -> None:
    """Have Spark delete a step's shuffle files when the step ends, not when the driver's garbage is collected: of
    several stored steps only one then has its shuffles on the disks."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def drop_stored(*tables: DataFrame) -> None:
    """Remove tables that stored() wrote, on whatever file system they are, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc32_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the undirected links (a, b).

    Every round sends each node the smallest label among itself and its neighbours and then jumps to the label's own
    label, so chains shorten by doubling.  Labels live in checkpointed frames; only one changed-row count reaches the
    driver.  A hot node's neighbours meet in a grouping with map-side minima.  Empty links give an empty frame.
    """
    shared_folder(links.sparkSession)
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.where("a <> b").distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    labels = labels.select("node", F.least("node", "m").alias("component")).checkpoint()
    for _ in range(rounds):
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["a"]).select(
            "node", F.col("component").alias("before"), F.least("component", "heard").alias("low"))
        own = lower.select(F.col("node").alias("target"), F.col("low").alias("target_low"))
        jumped = lower.join(own, lower["low"] == own["target"], "left").select(
            "node", "before", F.least("low", F.coalesce("target_low", "low")).alias("component")).checkpoint()
        labels = jumped.select("node", "component")
        if jumped.where("component <> before").isEmpty():
            return labels
    raise RuntimeError("links have not settled")


def in_blocks(rows: DataFrame, sizes: DataFrame, group: str, node: str, block: int, wide: DataFrame | None = None,
              wide_on: list[str] | None = None) -> DataFrame:
    """Deal the rows of each group to pairs of blocks, so that any two rows of a group meet in some pair and no pair
    holds much more than two blocks of rows, however large the group is.  sizes is (group, n); groups it lacks go.

    Adds lo and hi, the numbers of the two blocks, and own, the row's.  Rows come dealt by (group, lo, hi) and sorted by them and the node.
    wide, joined on wide_on after the groups of one row have gone, adds columns too large to deal with every row."""
    found = rows.join(sizes, group).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    found = found.withColumn("own", F.pmod(F.xxhash64(node), F.col("blocks").cast("long")).cast("int"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = found.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.drop("n", "blocks", "other")
    if wide is not None:
        found = found.join(wide, wide_on)
    found = found.repartition(parts, group, "lo", "hi")
    return found.sortWithinPartitions(group, "lo", "hi", node)


def segments(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the consecutive rows that agree in the first so many columns (integers without nulls)."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        if parts and any(c[0] != parts[-1].column(i)[parts[-1].num_rows - 1].as_py() for i, c in enumerate(columns)):
            yield pa.Table.from_batches(parts)
            parts = []
        changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        edges = [0, *changes.tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            if start:
                yield pa.Table.from_batches(parts)
                parts = []
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield pa.Table.from_batches(parts)
