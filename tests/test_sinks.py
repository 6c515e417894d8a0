"""Sinks and stored intermediates: nothing is cut in silence, a failed write loses nothing."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stakefold.functions import money as M
from stakefold.operators import spine_table
from stakefold.plans import run
from stakefold.sources import StageArea, Tables, conform, fixed_width, read_run_table, write_run_catalog, write_run_partition
from stakefold.sources import stage
from stakefold.sources.schemas import output_schema
from stakefold.sources.sinks import TextField

DAY = dt.date(2024, 1, 5)


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(("value", "source", "sink"), [
    (Dec("12345678901.50"), "decimal(22,2)", "decimal(10,2)"), ("99999999999", "string", "int"), ("2024-13-01", "string", "date"),
    (1e300, "double", "decimal(22,2)")])
def test_a_value_the_sink_cannot_hold_fails(spark, ansi, value, source, sink):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(value,)], f"x {source}")
        with pytest.raises(PySparkException, match="does not fit"):
            conform(df, schema(spark, f"x {sink}")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_only_missing_numbers_become_zero(spark):
    df = spark.createDataFrame([(None, None, float("nan")), (5, "2024-01-05", -1.5)], "n int, d string, x double")
    got = conform(df, schema(spark, "n int, d date, x decimal(10,2)")).collect()
    assert [tuple(r) for r in got] == [(None, None, Dec("0.00")), (5, DAY, Dec("-1.50"))]


def test_fixed_width_numbers_keep_sign_and_digits(spark):
    fields = [TextField("n", 6, "0", left=False), TextField("s", 3)]
    rows = spark.createDataFrame([(-5, "abcdef"), (123456, None), (None, "x"), (-12345, "")], "n long, s string")
    assert [r[0] for r in fixed_width(fields, rows).collect()] == ["-00005abc", "123456   ", "000000x  ", "-12345   "]
    for wide in (1234567, -123456):
        with pytest.raises(PySparkException, match="wider than 6"):
            fixed_width(fields, spark.createDataFrame([(wide, "a")], "n long, s string")).collect()


def test_amounts_times_counts_are_exact(spark):
    values = [(Dec("123456789.123456789012"), 150_000_000), (Dec("-0.000000000001"), 3), (Dec("-7.500000000000"), 10**9)]
    df = spark.createDataFrame(values, "x decimal(32,12), n long")
    got = df.select(M.by_count(F.col("x"), F.col("n"), "decimal(37,12)").alias("y")).collect()
    assert [r.y for r in got] == [Dec("18518518368518518.351800000000"), Dec("-0.000000000003"), Dec("-7500000000.000000000000")]
    assert df.select(F.lit(150_000_000).cast(M.COUNT).alias("n")).first().n == 150_000_000


def test_a_code_table_of_any_length_unfolds(spark):
    codes = spark.range(1001).select(F.col("id").cast("int").alias("prodid"))
    got = spine_table(spark.createDataFrame([("a",), ("b",)], "k string"), codes)
    assert got.count() == 2002 and got.distinct().count() == 2002
    assert spine_table(spark.createDataFrame([("a",)], "k string"), codes.where("false")).count() == 0


def test_a_failed_write_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    write_run_partition(spark.createDataFrame([(1,), (2,)], "v int"), path, DAY)
    broken = spark.createDataFrame([(1,), (0,)], "v int").select(
        F.when(F.col("v") == 0, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(PySparkException, match="broken"):
        write_run_partition(broken, path, DAY)
    assert sorted(r.v for r in read_run_table(spark, path, schema(spark, "v int")).collect()) == [1, 2]
    assert [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("_new")] == []


def test_a_catalog_table_is_replaced_by_run_date(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS settled LOCATION '{tmp_path}/settled'")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "v int, t string")
    try:
        name = "settled.daily"
        assert write_run_catalog(one, name, DAY) == 2 == write_run_catalog(one, name, DAY)
        assert write_run_catalog(one.select("t", "v").limit(1), name, DAY + dt.timedelta(days=1)) == 1
        assert sorted(map(tuple, spark.table(name).groupBy("PROCDATE").count().collect())) == [("20240105", 2), ("20240106", 1)]
        assert write_run_catalog(one.where("false"), name, DAY) == 0
        assert spark.table(name).count() == 1
    finally:
        spark.sql("DROP DATABASE settled CASCADE")


def test_without_a_shared_folder_results_are_held_not_written(spark, monkeypatch):
    monkeypatch.setattr(stage, "shared_folder", lambda spark: None)
    area = StageArea(spark)
    assert area.folder is None
    held = area.put(spark.range(5).toDF("v"), "five")
    assert held.is_cached and held.count() == 5
    area.clear()
    assert not held.is_cached


def test_stage_folder_is_dropped_with_the_run(spark, tmp_path):
    area = StageArea(spark, str(tmp_path / "stage"))
    assert area.put(spark.range(5).toDF("v"), "five").count() == 5 and list((tmp_path / "stage").iterdir())
    area.clear()
    assert list((tmp_path / "stage").iterdir()) == []


def test_runner_takes_an_interval_and_writes_the_ledger_file(spark, tmp_path, monkeypatch):
    seen = []
    out = output_schema("interval_transactions")
    monkeypatch.setattr(run, "interval_transactions", lambda t, a, b: seen.append((a, b)) or spark.createDataFrame([], out))
    monkeypatch.setattr(run.SparkSession.Builder, "getOrCreate", lambda self: spark)
    run.main(["interval_transactions", "2024-01-05T08:00:00", "2024-01-07T20:00:00", str(tmp_path), str(tmp_path / "out")])
    assert seen == [(dt.datetime(2024, 1, 5, 8), dt.datetime(2024, 1, 7, 20))]
    assert (tmp_path / "out/interval_transactions/PROCDATE=20240105").is_dir()
    fields = output_schema("shop_ledger")
    row = {f.name: "x" if f.dataType.simpleString() == "string" else None for f in fields}
    row |= {"businessdate": DAY, "documentdate": DAY, "amount": Dec("-1234.00"), "idmmbusinessday": "0", "itemid": "0", "transactionid": "7"}
    ledger = spark.createDataFrame([tuple(row[f.name] for f in fields)], fields)
    monkeypatch.setitem(run.JOBS, "shop_ledger", lambda t, day: ledger)
    for _ in range(2):
        assert run.run_job("shop_ledger", Tables.frames(spark, {}), DAY, str(tmp_path / "out")) == 1
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out/shop_ledger_file/RT05012024").collect()]
    assert [len(x) for x in lines] == [238] and "-00000000001234" in lines[0]
    with pytest.raises(SystemExit):
        run.main(["hq_prizes", "2024-01-05", "2024-01-06", str(tmp_path), str(tmp_path / "out")])
