"""Reading helpers."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def clean_header(name: str) -> str:
    """Upper case; anything but letters and digits becomes one underscore; none at the ends."""
    return re.sub(r"[^0-9A-Z]+", "_", name.upper()).strip("_")


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def read_csv_clean(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return clean_names((reader.schema(schema) if schema else reader).csv(path))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and how many rows it holds."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
