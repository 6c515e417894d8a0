"""Rules of the jobs on hand-made rows, above all where sources of the specification disagree."""

import datetime as dt
import os
import time
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from stakefold.operators.postings import LINE_COLUMNS
from stakefold.plans import interval_transactions as IT
from stakefold.plans import invoice, run, shop_ledger
from stakefold.plans import transaction_details as T
from stakefold.plans.business_dates import RunWindows, Span, business_dates, fund_window
from stakefold.plans.hq_prizes import hq_prizes
from stakefold.plans.sweep_sales import sweep_sales
from stakefold.plans.ticket_amounts import ticket_amounts
from stakefold.sources import StageArea, Tables, conform, read_run_table, write_run_partition
from stakefold.sources.schemas import TABLES, output_schema, table_schema

DAY = dt.date(2024, 1, 5)
AT = dt.datetime(2024, 1, 5, 4)  # utc, inside the window


def windows(first=DAY):
    span = Span(dt.datetime.combine(first, dt.time(1)), dt.datetime(2024, 1, 6, 1))
    return RunWindows(DAY, DAY, span, span, span, span, dt.date(2024, 1, 8), dt.date(2024, 1, 11))


def frames(spark, **rows):
    """Tables from dicts; columns left out are null."""
    out = {}
    for name, dicts in rows.items():
        schema = table_schema(name)
        out[name] = spark.createDataFrame([tuple(d.get(f) for f in schema.fieldNames()) for d in dicts], schema)
    return Tables.frames(spark, out)


def header(key, prodid, **more):
    base = dict(
        tranheaderid=key, ticketserialnumber=f"T{key}", tickettransactionid=f"X{key}", prodid=prodid, terdisplayid="000000001",
        createddate=AT, iscancelled=False, isexchangeticket=False, isbetrejectedbytrader=False,
    )
    return base | more


def state(key, code="PB06", at=AT):
    return dict(tranheaderid=key, betstatetypeid=code, placedbetlifecycleid=f"{key}{code}", captureddate=at)


def money(x):
    return Dec(x)


def amounts_of(t):
    return {r.ticketserialnumber: r for r in ticket_amounts(t, windows()).collect()}


def test_horse_amounts_halve_two_way_bets_and_multiply_by_validations(spark):
    line = dict(tranheaderid="a", terdisplayid="000000001", createddate=AT, salescommamount=money("10"), salesfactoramount=money("90"))
    t = frames(
        spark,
        header=[header("a", 1), header("late", 1, createddate=dt.datetime(2024, 1, 5, 17))],
        header_state=[state("a"), state("late")],
        horse_line=[line | dict(bettypeid="W-P", betpriceamount=money("101")), line | dict(bettypeid="WIN", betpriceamount=money("100")),
                    line | dict(tranheaderid="late", bettypeid="WIN", betpriceamount=money("7"))],
        validated=[dict(tranheaderid=k, ticketserialnumber="Ta", winningamount=money(x)) for k, x in (("v1", "30"), ("v2", "5"))],
    )
    got = amounts_of(t)
    assert set(got) == {"Ta"}  # the window's end is open
    r = got["Ta"]
    assert (r.wager, r.sales, r.winningamount) == (Dec("301.00"), Dec("270"), Dec("35.00"))
    assert r.gst == Dec("31.000000000000") and r.returnamount == Dec("336.00")


def test_pool_counts_the_first_unit_only(spark):
    line = dict(tranheaderid="p", createddate=AT, bettypeid="ORD", betpriceamount=money("50"), salesfactoramount=money("45"), salescommamount=money("1"))
    t = frames(
        spark, header=[header("p", 3), header("x", 3, isexchangeticket=True)], header_state=[state("p"), state("x")],
        pool_line=[line | dict(tranlineitemid=str(i), groupunitsequence=s) for i, s in enumerate((None, 1, 2))]
        + [line | dict(tranheaderid="x", tranlineitemid="9")],
    )
    got = amounts_of(t)
    assert set(got) == {"Tp"} and got["Tp"].wager == Dec("100.00")


def sweep_frames(spark, printed, states, indicator):
    return frames(
        spark, header=[header("s", 4)], header_state=[state("s", c) for c in states],
        sweep_line=[dict(tranheaderid="s", tranlineitemid="1", isprinted=printed)],
        sweep_number=[dict(tranheaderid="s", tranlineitemid="1", terdisplayid="000000001", createddate=AT, issoldout=False,
                           betpriceamount=money("30"), salesfactoramount=money("27"), salescommamount=money("3"))],
        terminal=[dict(terdisplayid="000000001", locid=1, isdeleted=False)], location=[dict(locid=1, sweepindicator=indicator)],
    )


@pytest.mark.parametrize(
    "printed, states, indicator, wager",
    [(1, ["PB06"], 1, "30.00"), (None, ["PB06"], None, "30.00"), (None, ["PB06"], 1, None), (None, ["PB06", "PB03"], 1, "30.00")],
)
def test_unprinted_consignee_sweeps_wait_for_their_state(spark, printed, states, indicator, wager):
    got = amounts_of(sweep_frames(spark, printed, states, indicator))
    assert (got["Ts"].wager if "Ts" in got else None) == (None if wager is None else Dec(wager))


def test_sports_repeats_count_once(spark):
    line = dict(tranheaderid="b", terdisplayid="000000001", createddate=AT, betamount=money("10"), salescommamount=money("1"),
                salesfactoramount=money("9"), sourcesystemtransactionid="S", issinglebet=True)
    t = frames(
        spark, header=[header("b", 5), header("r", 6, isbetrejectedbytrader=True)], header_state=[state("b"), state("r")],
        sports_line=[line | dict(tranlineitemid=str(i)) for i in range(3)] + [line | dict(tranheaderid="r", tranlineitemid="r")],
        sports_number=[dict(tranheaderid="b", tranlineitemid=str(i)) for i in range(3)] * 2,
    )
    got = amounts_of(t)
    assert set(got) == {"Tb"} and (got["Tb"].wager, got["Tb"].sales) == (Dec("10.00"), Dec("9"))


def test_sweep_sales_date_edge_counts_in_both_periods(spark):
    t = sweep_frames(spark, 1, ["PB06"], 1)
    edge = AT
    shift = dt.timedelta(hours=8)
    periods = [(DAY, edge - dt.timedelta(days=1), edge), (DAY + dt.timedelta(days=1), edge, edge + dt.timedelta(days=1))]
    t._open["calendar"] = spark.createDataFrame(
        [(1, d, lo + shift, hi + shift, lo, hi) for d, lo, hi in periods], table_schema("calendar")
    )
    got = sorted(r.actualdate for r in sweep_sales(t, windows(dt.date(2024, 1, 4))).collect())
    assert got == [DAY, DAY + dt.timedelta(days=1)]


def test_fund_window_runs_four_or_three_to_six_days():
    monday, friday = dt.date(2024, 1, 8), dt.date(2024, 1, 5)
    assert fund_window(monday) == (dt.date(2024, 1, 12), dt.date(2024, 1, 14))
    assert fund_window(friday) == (dt.date(2024, 1, 8), dt.date(2024, 1, 11))
    assert fund_window(dt.date(2024, 1, 6)) == (None, None)


def test_default_times_stand_in_for_a_missing_history(spark):
    t = frames(
        spark, lookup=[dict(configname="RTMS_Host", fld1value=str(i), fld2value=n) for i, n in ((1, "IGT"), (2, "BMCS"), (3, "OB"))],
        period_default=[dict(host=1, adhoctime=None, defaulttime="25:30:00"), dict(host=2, adhoctime="03:00:00", defaulttime="01:00:00"),
                        dict(host=3, adhoctime=None, defaulttime="02:00:00")],
        period_history=[dict(host=3, actualdate=DAY, perioddatetime=dt.datetime(2024, 1, 6, 4))],
    )
    r = business_dates(t, DAY, DAY).first()
    assert r.fromdateigt == dt.datetime(2024, 1, 5, 1, 30)  # hour 25 wraps onto the same day, minutes kept
    assert r.todatebmcs == dt.datetime(2024, 1, 6, 3) and r.utctodatebmcs == dt.datetime(2024, 1, 5, 19)
    assert r.todateob == dt.datetime(2024, 1, 6, 4) and r.todatenonhost == dt.datetime(2024, 1, 6, 4)
    assert r.fromdatenonhost == dt.datetime(2024, 1, 5, 1, 30)


def test_match_tax_is_a_difference_of_rounded_taxes(spark):
    t = frames(
        spark, tax_rate=[dict(gstrate=money("9"), effectivefrom=dt.date(2023, 1, 1))], terminal=[dict(terdisplayid="t", locid=1)],
        location_tax=[dict(locid=1, startdate=dt.date(2023, 1, 1), enddate=dt.date(2025, 1, 1), isgst=True, isdeleted=False)],
    )
    cells = spark.createDataFrame(
        [("t", "TOTO", money("-0.50"), 1, DAY), ("t", "TOTO MATCH", money("-0.06"), 2, DAY), ("t", "TOTO", money("-9"), 1, None)],
        "terdisplayid string, prodname string, amount decimal(22,2), ticketcount int, actualdate date",
    )
    got = {r.prodname: (r.amount, r.ticketcount) for r in T._tax(t, cells).collect()}
    # 0.56 -> 0.0504 -> 0.05 less 0.50 -> 0.045 -> 0.05 leaves nothing; the tax of 0.06 alone would be 0.01
    assert got == {"TOTO": (Dec("-0.05"), 1), "TOTO MATCH": (Dec("0.00"), 2)}


def test_two_way_bets_count_once_per_price(spark):
    rows = spark.createDataFrame(
        [("h", "W-P", 5), ("h", "W-P", 5), ("h", "W-P", 7), ("h", "WIN", 5), ("h", "WIN", 5)], "tranheaderid string, bettypeid string, x int"
    ).withColumn("k", F.lit(1))
    assert IT.once_per_price(rows, ["k"], ["x"], {"s": "x"}).first().s == 22


def test_ticket_cells_cut_to_cents_per_terminal_and_skip_cancelled(spark):
    t = frames(spark, header=[header("a", 1), header("b", 1), header("c", 1, iscancelled=True)])
    amounts = spark.createDataFrame(
        [("Ta", money("10.40"), money("9.60")), ("Tb", money("10.50"), money("9.60")), ("Tc", money("99"), money("99"))],
        "ticketserialnumber string, wager decimal(22,2), sales decimal(22,12)",
    )
    place = spark.createDataFrame([("000000001", 2)], "terdisplayid string, loctypeid int")
    got = {r.flag: r.amount for r in shop_ledger.ticket_cells(t, amounts, place).collect()}
    assert got == {"WAGER": Dec("20.00"), "SALES": Dec("19.00")}


def test_bank_netting_is_per_location(spark):
    rows = [(1, "COL", 100), (1, "PAY", -150), (2, "COL", 80)]
    period = spark.createDataFrame(
        [(loc, f"L{loc}", "n", 2, True, "HORSE RACING", f, "CH", money(x)) for loc, f, x in rows],
        "locid int, locdisplayid string, locname string, loctypeid int, isibg boolean, prodname string, flag string, transtype string, amount decimal(22,2)",
    )
    got = {r.locid: r.net for r in shop_ledger.net_per_location(period, shop_ledger.HORSE).collect()}
    assert got == {1: Dec("-50.00"), 2: Dec("80.00")}


def test_manual_payments_keys_accounts_and_numbers(spark):
    net = spark.createDataFrame(
        [(3, "L3", "Shop three", False, money("5")), (1, "L1", "Shop one", False, money("-7")), (2, "L2", "Shop two", False, money("0")),
         (4, "L4", "By bank", True, money("9"))],
        "locid int, locdisplayid string, locname string, isibg boolean, net decimal(22,2)",
    )
    got = {r.linecode: r for r in shop_ledger.manual_lines(net, shop_ledger.SPORTS, DAY).collect()}
    assert set(got) == {"MPYT1", "MPYT2", "MPYT3", "MPYT4"}
    key = {k: (r.sappostingkey, r.sapcontrolacctcode, r.local_no, r.amount) for k, r in got.items()}
    assert key["MPYT1"] == ("11", "21100091", 3, Dec("5.00")) and key["MPYT2"] == ("01", "L3", 3, Dec("5.00"))
    assert key["MPYT3"] == ("01", "21100091", 1, Dec("7.00")) and key["MPYT4"] == ("11", "L1", 1, Dec("7.00"))
    assert got["MPYT2"].linetext == "MANUAL PAYMENT ENDED 05/01/2024-Shop three"
    assert list(got["MPYT1"].asDict()) == LINE_COLUMNS


def test_tax_codes_follow_the_date():
    assert shop_ledger.tax_codes(dt.date(2022, 10, 31)) == ("ZA", "P1")
    assert shop_ledger.tax_codes(dt.date(2023, 12, 31)) == ("YA", "P2")
    assert shop_ledger.tax_codes(dt.date(2024, 1, 1)) == ("XA", "P3")
    assert shop_ledger.period_start(dt.date(2024, 1, 8)) == dt.date(2024, 1, 6)
    assert shop_ledger.period_start(dt.date(2024, 1, 5)) == dt.date(2024, 1, 2)
    assert shop_ledger.period_start(dt.date(2024, 1, 6)) is None


def test_credit_sides_of_the_invoices_differ_in_the_tax():
    assert "6" in invoice.LOCATION.credit_types and "6" not in invoice.TERMINAL.credit_types


def test_ledger_line_is_238_characters_in_its_fields(spark):
    row = dict.fromkeys(output_schema("shop_ledger").fieldNames(), "")
    row |= dict(
        idmmbusinessday="0" * 12, businessdate=dt.date(2025, 6, 25), itemid="0" * 12, transactionid="000000000001",
        documentdate=dt.date(2025, 6, 26), linecode="MCOL16", sapdoctype="Y8", sappostingkey="01", sapcontrolacctcode="23100000",
        linetext="INVOICE FOR BRANCHES", glnumber="12100003", saptaxbaseamount=0, currencycode="SGD", amount=Dec("20828200.00"),
        product="HORSE RACING",
    )
    schema = output_schema("shop_ledger")
    df = spark.createDataFrame([tuple(row[f] for f in schema.fieldNames())], schema)
    text = shop_ledger.ledger_text(df).first()[0]
    assert len(text) == 238
    fields = {(12, 8): "25062025", (32, 12): "000000000001", (44, 8): "26062025", (52, 12): "MCOL16", (64, 2): "Y8", (66, 2): "01",
              (68, 15): "23100000", (83, 50): "INVOICE FOR BRANCHES", (133, 10): "12100003", (143, 31): "", (174, 3): "SGD",
              (177, 15): "000000020828200", (192, 18): "HORSE RACING", (210, 18): "", (228, 10): ""}
    assert {k: text[k[0]:k[0] + k[1]].rstrip() for k in fields} == fields


def test_run_partition_is_replaced_and_emptied(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "v int"
    one = spark.createDataFrame([(1,), (2,)], schema)
    assert write_run_partition(one, path, DAY) == 2 == write_run_partition(one, path, DAY)
    write_run_partition(one.limit(1), path, DAY + dt.timedelta(days=1))
    table = read_run_table(spark, path, one.schema)
    assert table.count() == 3 and {r[0] for r in table.select("PROCDATE").distinct().collect()} == {"20240105", "20240106"}
    assert write_run_partition(one.where("false"), path, DAY) == 0
    assert read_run_table(spark, path, one.schema).count() == 1


def test_conform_drops_infinities_and_cuts_text(spark):
    df = spark.createDataFrame([("abcdef", float("inf")), (None, 2.5)], "s string, x double")
    got = conform(df, spark.createDataFrame([], "s string, x decimal(10,2)").schema, {"s": 3}).collect()
    assert [tuple(r) for r in got] == [("abc", Dec("0.00")), (None, Dec("2.50"))]


def test_prizes_run_end_to_end_twice(spark, tmp_path):
    lo = dt.datetime(2024, 1, 5, 2)
    t = frames(
        spark, calendar=[dict(host=3, actualdate=DAY, previousperioddatetime=lo, perioddatetime=lo + dt.timedelta(days=1))],
        cart=[dict(cartid="k", terdisplayid="t", cartcreateddate=AT)], terminal=[dict(terdisplayid="t", locid=1)],
        location=[dict(locid=1, locdisplayid="008888")], header=[header("a", 5)], product=[dict(prodid=5, prodname="x")],
        validation_type=[dict(validationtypeid="VALD")], validated_state=[dict(tranheaderid="a", betstatetypeid="VB06")],
        validated=[dict(tranheaderid="a", ticketserialnumber="Ta", cartid="k", validationtypeid="VALD", winningamount=money("12.50"))],
    )
    assert hq_prizes(t, DAY, "000000").count() == 0
    for _ in range(2):
        assert run.run_job("hq_prizes", t, DAY, str(tmp_path)) == 1
    got = read_run_table(spark, str(tmp_path / "hq_prizes"), output_schema("hq_prizes", stored=True)).collect()
    assert [(r.prizeamount, r.refundamount, r.txndate, r.X_ETL_NAME) for r in got] == [(Dec("12.50"), Dec("0.00"), DAY, "hq_prizes")]


def test_stored_intermediates_come_back_and_go(spark):
    stage = StageArea(spark)
    got = stage.put_all({"a": spark.range(3).toDF("x"), "b": spark.range(5).toDF("y")})
    assert (got["a"].count(), got["b"].count(), stage.put(spark.range(1), "a").count()) == (3, 5, 1)
    root = stage.root
    stage.clear()
    assert stage.root != root and not os.path.exists(root)


def test_results_are_stored_one_at_a_time(spark, tmp_path, monkeypatch):
    """Jobs side by side had their plans, broadcasts and threads on the driver together."""
    parquet, running, seen = DataFrameWriter.parquet, [], []

    def counted(self, *args, **kwargs):
        running.append(1)
        seen.append(len(running))
        time.sleep(0.2)
        parquet(self, *args, **kwargs)
        running.pop()

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    got = StageArea(spark, str(tmp_path)).put_all({"a": spark.range(3), "b": spark.range(5), "c": spark.range(7)})
    assert seen == [1, 1, 1] and got["c"].count() == 7


def test_run_date_falls_back_to_yesterday():
    assert run.run_date_of("20240105") == DAY
    assert run.run_date_of("x", dt.date(2024, 1, 6)) == DAY


def test_every_table_has_a_schema(spark):
    assert all(table_schema(n).fields for n in TABLES)
