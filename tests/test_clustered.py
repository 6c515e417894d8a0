"""Clustered tables: joins and groupings by header without an exchange, windows from their days' folders, same results."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stakefold.plans import run
from stakefold.plans.business_dates import run_windows
from stakefold.plans.ticket_amounts import ticket_amounts
from stakefold.queries import jobs
from stakefold.sources import clustered as K
from stakefold.sources.schemas import OUTPUTS, TABLES, output_schema
from stakefold.testbed.load import domain_tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    name = f"clustered_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION 'file://{tmp_path_factory.mktemp('db')}'")
    K.cluster_tables(domain_tables(spark, FOLDER), name, buckets=8)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_header_state_and_lines_meet_without_an_exchange(spark, database, no_broadcast):
    t = K.clustered(spark, database)
    rows = t["header"].join(t["header_state"].where("betstatetypeid = 'PB06'"), "tranheaderid").join(
        t["horse_line"].select("tranheaderid", "betpriceamount"), "tranheaderid")
    per = rows.groupBy("tranheaderid").agg(F.sum("betpriceamount").alias("x"), F.count(F.lit(1)).alias("n"))
    assert "SortMergeJoin" in plan(per) and "Exchange" not in plan(per)
    plain = domain_tables(spark, FOLDER)
    want = plain["header"].join(plain["header_state"].where("betstatetypeid = 'PB06'"), "tranheaderid").join(
        plain["horse_line"].select("tranheaderid", "betpriceamount"), "tranheaderid")
    want = want.groupBy("tranheaderid").agg(F.sum("betpriceamount").alias("x"), F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, per.collect())) == sorted(map(tuple, want.collect()))


def test_a_window_reads_its_days(spark, database):
    lo, hi = dt.datetime(2024, 1, 5, 8), dt.datetime(2024, 1, 6, 9)
    rows = K.of_days(spark.table(f"{database}.header"), "createddate", lo, hi)
    assert "PartitionFilters: [isnotnull(DAYPART" in plan(rows)
    days = {f.split("DAYPART=")[1][:10] for f in rows.inputFiles()}
    assert days == {"2024-01-05", "2024-01-06"}
    want = domain_tables(spark, FOLDER)["header"].where((F.col("createddate") >= F.lit(lo)) & (F.col("createddate") < F.lit(hi)))
    assert rows.count() == want.count() > 0


def test_a_day_has_one_file_a_bucket(spark, database):
    files = spark.table(f"{database}.header").inputFiles()
    assert len(files) == len({(f.split("DAYPART=")[1][:10], f.rsplit("_", 1)[1]) for f in files})


def test_a_job_on_clustered_tables_gives_the_same(spark, database):
    plain = domain_tables(spark, FOLDER)
    w = run_windows(plain, jobs.START, jobs.END)
    a, b = (sorted(map(str, ticket_amounts(t, w).collect())) for t in (plain, K.clustered(spark, database)))
    assert a == b and a


def test_null_keys_and_times_are_kept_and_a_table_is_replaced(spark, database):
    rows = spark.createDataFrame([(None, None), ("a", dt.datetime(2024, 1, 5)), (None, dt.datetime(2024, 1, 6))], "k string, at timestamp_ntz")
    for _ in range(2):
        K.write_clustered(rows, f"{database}.odd", "k", 4, "at")
    got = spark.table(f"{database}.odd").drop(K.DAY_COLUMN).collect()
    assert sorted(map(str, got)) == sorted(map(str, rows.collect()))


def test_every_result_table_can_be_made_from_its_fields(spark, database):
    for job in OUTPUTS:
        K.create_output_table(spark, job, f"{database}.{job}_out")
        made = spark.table(f"{database}.{job}_out").schema
        assert {(f.name, f.dataType) for f in made} == {(f.name, f.dataType) for f in output_schema(job, stored=True)}
        assert made.names[-1] == "PROCDATE"
    day = dt.date(2024, 1, 6)
    t = domain_tables(spark, FOLDER)
    K.create_output_table(spark, "hq_prizes", f"{database}.hq_prizes")
    for _ in range(2):
        assert run.run_job("hq_prizes", t, day, f"catalog:{database}") == spark.table(f"{database}.hq_prizes").count()
    assert set(TABLES) >= set(K.DATED)
