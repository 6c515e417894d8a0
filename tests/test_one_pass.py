"""Shared work is done once: histories are read once, filters are made once, spines are not dealt out."""

import datetime as dt

from pyspark.sql import functions as F

from stakefold.operators import spine_join, spine_measures, spine_table
from stakefold.operators import joins as J
from stakefold.plans import placed_measures as P
from stakefold.plans import shop_ledger as S
from stakefold.plans import transaction_details as T
from stakefold.plans.business_dates import run_windows
from stakefold.plans.common import near
from stakefold.queries import jobs
from stakefold.sources import StageArea, Tables
from stakefold.testbed.load import domain_tables

FOLDER = "/root/testdata/sf0.001"


def stored_names(monkeypatch):
    seen, put_all = [], StageArea.put_all

    def record(self, frames):
        seen.extend(frames)
        return put_all(self, frames)

    monkeypatch.setattr(StageArea, "put_all", record)
    return seen


def test_the_ledger_measures_day_and_period_in_one_pass(spark, monkeypatch):
    seen = stored_names(monkeypatch)
    jobs.QUERIES["shop_ledger"](spark, FOLDER)
    for name in ("line-keys", "placed-tickets", "placed-part4", "paid-rows", "gone-rows"):
        assert seen.count(name) == 1, name
    # a row for every terminal and branch is added up as it unfolds, not written and read again
    assert "cells-part0" in seen and not [name for name in seen if "details" in name]


def test_windows_in_one_pass_are_the_windows_by_themselves(spark):
    t = domain_tables(spark, FOLDER)
    ws = [run_windows(t, jobs.START, jobs.START), run_windows(t, jobs.START - dt.timedelta(days=3), jobs.END),
          run_windows(t, jobs.END, jobs.END)]
    for w, both in zip(ws, T.inputs_of_windows(t, *ws), strict=True):
        for name, alone in T.detail_inputs(t, w).items():
            cols = alone.columns
            assert both[name].count() == alone.count()
            assert both[name].select(cols).exceptAll(alone).count() == 0, name


def test_histories_are_read_once_for_all_areas(spark):
    t = domain_tables(spark, FOLDER)
    w = run_windows(t, jobs.START, jobs.END)
    opened = []
    load = t._load
    t._load = lambda name: opened.append(name) or load(name)
    keys = t.stage.put(P.line_keys(t, w), "line-keys")
    parts = P.placed_measures(t, keys, w)
    plans = [p._jdf.queryExecution().optimizedPlan().toString() for p in parts[:5]]
    assert all("o_orderkey" not in text for text in plans)


def test_a_filter_is_made_once(spark, tmp_path):
    spark.range(5000).select(F.format_string("k%d", "id").alias("k")).write.parquet(f"{tmp_path}/keys")
    history = spark.range(9000).select(F.format_string("k%d", "id").alias("k"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1kB")
    try:
        t = Tables.frames(spark, {"a": history, "b": history})
        t.stage = StageArea(spark, f"{tmp_path}/stage")
        made = []
        put = t.stage.put
        t.stage.put = lambda df, name: made.append(name) or put(df, name)
        keys = spark.read.parquet(f"{tmp_path}/keys")
        got = [near(t, name, keys, "k") for name in ("a", "b")]
        assert made == ["filter-k"]
        assert all(5000 <= df.count() < 6000 for df in got)
        assert all(df.join(keys, "k").count() == 5000 for df in got)
    finally:
        spark.conf.set(limit, before)


def test_instant_payments_stand_beside_their_rows(spark):
    at = (1, "L1", "one", 2, False, True)
    rows = [("t1", T.PAYNOW_ALL, "CAS", "CL", "5.00"), ("t1", T.PAYNOW, "CAS", "TF", "0.50"), ("t2", T.PAYNOW_ALL, "CAS", "CL", "1.00"),
            ("t1", T.PAYNOWQR_ALL, "CAS", "CL", "0.00"), ("t1", T.NETS, "CAS", "CL", "7.00"), ("t1", T.FUNDING, "FUN", "CH", "-3.00"),
            ("t2", T.FUNDING, "FUN", "CH", "-3.00")]
    details = spark.createDataFrame([(*at, *r) for r in rows], [*S.PLACE, "terdisplayid", "prodname", "flag", "transtype", "x"])
    details = details.withColumn("amount", F.col("x").cast("decimal(22,2)")).withColumn("loctypeid", F.col("loctypeid").cast("int"))
    got = {(r.prodname, r.flag, r.transtype): int(r.amount) for r in S.location_cells(S.net_instant_payments(details)).collect()}
    assert got == {
        (T.PAYNOW_ALL, "CAS", "CL"): 600, (T.PAYNOW, "CAS", "TF"): 50, (T.PAYNOW, "CAS", "CL"): 550, (T.PAYNOWQR_ALL, "CAS", "CL"): 0,
        (T.NETS, "CAS", "CL"): 700, (T.FUNDING, "FUN", "CH"): -300}


def spine_tables(spark):
    dimension = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, v int")
    codes = spark.createDataFrame([("x", "p"), ("y", "p"), ("y", None), (None, "q")], "c string, d string")
    one = spark.createDataFrame(
        [("a", "x", "p", 1), ("a", "x", "p", 2), ("b", "y", "p", 3), ("a", None, "q", 4), ("b", "y", None, 5), (None, "x", "p", 6)],
        "k string, c string, d string, m int")
    two = spark.createDataFrame([("a", "x", "p", "n"), ("c", "z", "p", "o")], "k string, c string, d string, n string")
    return dimension, codes, one, two


def test_spine_measures_are_spine_table_and_spine_join(spark, monkeypatch):
    dimension, codes, one, two = spine_tables(spark)
    on = ["k", "c", "d"]
    want = spine_join(spine_join(spine_table(dimension, codes), one, on), two, on)
    cols = ["k", "v", "c", "d", "m", "n"]
    got = spine_measures(dimension, codes, [one, two], "k", ["c", "d"])
    rows = sorted(want.select(cols).collect(), key=str)
    assert sorted(got.select(cols).collect(), key=str) == rows and len(rows) == 22
    monkeypatch.setattr(J, "UNFOLDED", 1)
    assert sorted(spine_measures(dimension, codes, [one, two], "k", ["c", "d"]).select(cols).collect(), key=str) == rows


def test_spine_rows_are_not_dealt_out(spark):
    dimension, codes, one, two = spine_tables(spark)
    text = spine_measures(dimension, codes, [one.drop("d"), two.drop("d")], "k", ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline(" in text and "Join" not in text[:text.rindex("Generate inline(")]
