"""Open the derived domain tables in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.schemas import table_schema
from ..sources.tables import Tables
from . import binding

_open: dict[tuple[str, str, str], DataFrame] = {}


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; the handle (not the data) is kept per session, so its footer is read once."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _open:
        _open[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _open[key]


def domain_tables(spark: SparkSession, folder: str) -> Tables:
    """Domain tables over the Parquet files of ``folder``, conformed to the declared schemas."""
    sql = binding.tables(binding.SPARK)

    def load(name: str) -> DataFrame:
        text = sql[name]
        used = {}
        for b in binding.BASE:
            if f"FROM {b}" in text:
                text = text.replace(f"FROM {b}", f"FROM {{{b}}}")
                used[b] = base_table(spark, folder, b)
        missing = set(binding.ABSENT.get(name, ()))
        fields = ", ".join(
            f"CAST({'NULL' if f.name in missing else f.name} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in table_schema(name).fields
        )
        return spark.sql(f"SELECT {fields} FROM ({text})", **used)

    return Tables(spark, load)
