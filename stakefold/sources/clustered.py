"""Tables clustered for the joins the jobs make: bucketed and sorted by ticket header, partitioned by day.

Headers, states and lines of one bucket lie in files of one number, so joins and groupings by header need no exchange,
and a window of days reads the folders of these days.  Tables that join each other must have the same number of
buckets.  Rows are dealt by the bucket's own hash before they are written, so a day has one file a bucket and no more.

Result tables are made from their declared fields, partitioned by run date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from .schemas import TABLES, output_schema, table_schema
from .sinks import RUN_COLUMN
from .tables import Tables

KEY = "tranheaderid"
DAY_COLUMN = "DAYPART"
# the time that dates a table's rows; a keyed table without one is clustered by its key alone
DATED = {
    "header": "createddate", "header_state": "captureddate", "validated": "createdvalidationdate",
    "validated_state": "captureddate", "cancelled": "cancelleddate", "horse_line": "createddate",
    "fourd_number": "createddate", "pool_line": "createddate", "sweep_number": "createddate", "sports_line": "createddate",
    "sports_number": "createddate",
}


def write_clustered(df: DataFrame, name: str, key: str, buckets: int, at: str | None = None, path: str | None = None) -> None:
    """Store a frame as a catalog table in buckets of its key, sorted by it, and by the day of ``at`` if there is one.

    A null time has a partition of its own, a null key a bucket; an existing table of the name is replaced."""
    rows = df if at is None else df.withColumn(DAY_COLUMN, F.col(at).cast("date"))
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if at is not None:
        writer = writer.partitionBy(DAY_COLUMN)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def of_days(table: DataFrame, at: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """The rows from lo up to hi, from the folders of these days only."""
    rows = table.where(D.window(F.col(at), lo, hi, "left"))
    return rows.where(F.col(DAY_COLUMN).between(F.lit(lo.date()), F.lit(hi.date())))


def cluster_tables(t: Tables, database: str, buckets: int, names: list[str] | None = None) -> None:
    """Store domain tables in a database: those with a header key clustered by it, the others as they are."""
    for name in names or TABLES:
        keyed = KEY in table_schema(name).names
        if keyed:
            write_clustered(t[name], f"{database}.{name}", KEY, buckets, DATED.get(name))
        else:
            t[name].write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def clustered(spark: SparkSession, database: str) -> Tables:
    """The tables of a clustered database, without the day column."""
    return Tables(spark, lambda name: spark.table(f"{database}.{name}").drop(DAY_COLUMN))


def output_ddl(job: str, name: str, path: str | None = None) -> str:
    """The statement that makes a job's result table, partitioned by run date."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in output_schema(job, stored=True).fields)
    place = "" if path is None else f" LOCATION '{path}'"
    return f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY ({RUN_COLUMN}){place}"


def create_output_table(spark: SparkSession, job: str, name: str, path: str | None = None) -> None:
    spark.sql(output_ddl(job, name, path))
