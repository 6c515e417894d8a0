"""Physical plans: what must never appear, and what must reach the scan."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stakefold import operators as O
from stakefold.plans import ticket_amounts
from stakefold.plans.business_dates import run_windows
from stakefold.queries import jobs, operators
from stakefold.sources import StageArea, Tables
from stakefold.sources.schemas import TABLES
from stakefold.testbed.load import domain_tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in operators.QUERIES if not n.endswith(("round_trip", "run_partition"))])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(operators.QUERIES[name](spark, FOLDER))
    assert [x for x in FORBIDDEN if x in text] == []


def test_distinct_counts_repeat_no_row(spark):
    for name in ("multi_distinct", "distinct_texts"):
        text = plan(operators.QUERIES[name](spark, FOLDER))
        assert "Expand" not in text and "bitmap_construct_agg" in text


def test_time_window_and_columns_reach_the_scan(spark):
    text = plan(operators.QUERIES["scan_window_halfopen"](spark, FOLDER))
    assert "o_orderpriority" not in text.split("ReadSchema")[1]
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_conditional_net_needs_one_shuffle(spark):
    assert plan(operators.QUERIES["full_net_due"](spark, FOLDER)).count("Exchange hashpartitioning") == 1


@pytest.fixture
def small_broadcasts(spark):
    """As on a cluster: what is broadcast there must be seen to be tiny."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20kB")
    yield
    spark.conf.set(limit, before)


@pytest.fixture
def recorded(monkeypatch):
    """The plans of all results that a job stores on its way."""
    seen = []
    put_all = StageArea.put_all

    def record(self, frames):
        seen.extend(plan(df) for df in frames.values())
        return put_all(self, frames)

    monkeypatch.setattr(StageArea, "put_all", record)
    return seen


LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", ["interval_join_calendar", "validity_join_rate"])
def test_facts_are_not_dealt_out_by_day(spark, small_broadcasts, name):
    text = plan(operators.QUERIES[name](spark, LARGER))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert text.count("events.parquet") + text.count("orders.parquet") <= 1


def test_numbering_reads_its_input_once(spark, recorded):
    text = plan(operators.QUERIES["row_number_board"](spark, LARGER))
    assert "lineitem.parquet" not in text and sum(p.count("lineitem.parquet") for p in recorded) == 1


def test_document_numbers_meet_in_no_single_task(spark, small_broadcasts):
    assert "SinglePartition" not in plan(operators.QUERIES["document_number"](spark, LARGER))


def test_a_ticket_with_sequential_line_ids_is_split(spark):
    rows = spark.range(5000).select(F.lit("t").alias("k"), F.format_string("%012d", "id").alias("line"))
    bucket = O.quantile_bucket(rows, "line")
    sizes = sorted(r["count"] for r in rows.groupBy(bucket.alias("b")).count().collect())
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sizes[-1] < 2 * sizes[0]
    got = O.number_within(rows, ["k"], ["line"], bucket, "n").orderBy("line").collect()
    assert [r["n"] for r in got] == list(range(1, 5001))


@pytest.mark.parametrize("name", list(jobs.QUERIES))
def test_job_plans(spark, small_broadcasts, recorded, name):
    plans = [*recorded, plan(jobs.QUERIES[name](spark, FOLDER)), *recorded]
    for text in plans:
        assert [x for x in FORBIDDEN if x in text] == []
        windows = re.findall(r"Window .*\n(?:.*(?:Sort|AQEShuffleRead|ColumnarToRow).*\n)*.*Exchange SinglePartition", text)
        # the groups of the ledger's rules, a list of fixed length, are put in order; nothing else meets in one task
        assert len(windows) <= (1 if name in ("shop_ledger", "ledger_file") else 0)


def test_bounds_reach_the_header_scan(spark, tmp_path):
    t = domain_tables(spark, FOLDER)
    needed = ["header", "header_state", "draw", "terminal", "location", "calendar", "period_history", "validated", "validated_state",
              "horse_line", "fourd_number", "pool_line", "sweep_line", "sweep_number", "sports_line", "sports_number",
              "adhoctimehistory", "adhoctimeconfig", "lookupvalueconfig"]
    for name in [n for n in needed if n in TABLES]:
        t[name].write.parquet(f"{tmp_path}/{name}")
    stored = Tables.parquet(spark, str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    text = plan(ticket_amounts._tickets(stored, run_windows(t, jobs.START, jobs.END)))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "isexchangeticket" in line)
    assert "GreaterThanOrEqual(createddate,2024-01" in scan and "LessThan(createddate,2024-01" in scan
