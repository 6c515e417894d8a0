"""Sign-on and sign-off, first and last sale, first- and last-hour counts per terminal."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..sources.tables import Tables
from .business_dates import Span
from .common import lines_of

HOUR = 1


def latest_period(t: Tables, day: dt.date) -> Span | None:
    """The latest period of a business day over all hosts."""
    row = (
        t["calendar"].where(F.col("actualdate") == D.date_lit(day))
        .orderBy(F.col("previousperioddatetime").desc_nulls_last(), F.col("perioddatetime").desc_nulls_last())
        .select("previousperioddatetime", "perioddatetime").first()
    )
    return None if row is None else Span(row[0], row[1])


def _event(rows: DataFrame, at: Column, weight: Column, sale: bool, printed: Column | None, need: str) -> DataFrame:
    """One countable event; ``need`` says which shops it counts for (see ``_counts_for``)."""
    return rows.select(
        F.col("terdisplayid"), at.alias("at"), weight.cast("int").alias("weight"),
        (at if sale else F.lit(None).cast("timestamp_ntz")).alias("sale_at"),
        (F.lit(None).cast("boolean") if printed is None else printed).alias("printed"),
        F.lit(need).alias("need"),
    )


def _counts_for(need: Column, printed: Column, indicator: Column) -> Column:
    plain = indicator.isNull()
    return (
        F.when(need == "placed", plain | printed)
        .when(need == "unprinted", ~plain)
        .otherwise(F.lit(True))
    )


def _events(t: Tables, span: Span) -> DataFrame:
    utc = span.utc
    one = F.lit(1)
    accepted = F.col("isbetrejectedbytrader") == F.lit(False)
    header = t.stage.put(
        t["header"].where(accepted & D.window(F.col("createddate"), utc.lo, utc.hi, "both")).select(
            "tranheaderid", "terdisplayid", "createddate", "isexchangeticket"
        ),
        "hours-tickets",
    )
    keys = header.select("tranheaderid").distinct()
    state = lines_of(t, "header_state", keys).select("tranheaderid", "betstatetypeid")
    pool_ok = F.col("groupunitsequence").isNull() | (F.col("groupunitsequence") == 1)
    sold = F.col("issoldout").isNull() | (F.col("issoldout") == F.lit(False))
    # the window's tickets reduce the line history before it meets anything else
    sweep = t.stage.put(
        lines_of(t, "sweep_number", keys).select(
            "tranheaderid", "tranlineitemid", F.coalesce("issoldout", F.lit(False)).alias("issoldout")
        ),
        "hours-numbers",
    )
    boards = sweep.select("tranlineitemid").distinct()
    printed_lines = lines_of(t, "sweep_line", boards, "tranlineitemid").select("tranlineitemid", "isprinted")
    at_header = D.to_local(F.col("createddate"))
    ident = ["tranheaderid", "terdisplayid", "createddate"]
    placed = (
        header.where(F.col("isexchangeticket") == F.lit(False))
        .join(state.where(F.col("betstatetypeid") == "PB06").select("tranheaderid"), "tranheaderid")
        .join(lines_of(t, "pool_line", keys).select("tranheaderid", "groupunitsequence"), "tranheaderid", "left")
        .where(pool_ok)
        .join(sweep, "tranheaderid", "left")
        .where(sold)
        .join(printed_lines, "tranlineitemid", "left")
        .groupBy(*ident)
        .agg(F.max(F.col("isprinted").isNotNull()).alias("printed"))
    )
    unprinted_lines = t.stage.put(
        lines_of(t, "sweep_line", keys).where(F.col("isprinted").isNull()).select("tranheaderid", "tranlineitemid"),
        "hours-unprinted",
    )
    their_numbers = lines_of(t, "sweep_number", unprinted_lines.select("tranlineitemid").distinct(), "tranlineitemid")
    unprinted = (
        header.join(state.where(F.col("betstatetypeid") == "PB03").select("tranheaderid"), "tranheaderid")
        .join(unprinted_lines, "tranheaderid")
        .join(their_numbers.where(F.col("issoldout") == F.lit(False)).select("tranlineitemid"), "tranlineitemid", "left_semi")
        .select(*ident).distinct()
    )
    kept_group = F.col("groupunitsequence").isNull() | (F.col("cancelledamout") != 0)
    gone = t.stage.put(
        t["cancelled"].where(D.window(F.col("cancelleddate"), span.lo, span.hi, "both"))
        .select("tranheaderid", "terdisplayid", "cancelleddate", "cancelledamout"),
        "hours-cancelled",
    )
    gone_keys = gone.select("tranheaderid").distinct()
    cancelled = (
        gone
        .join(lines_of(t, "cancelled_state", gone_keys).where(F.col("betstatetypeid") == "CB06").select("tranheaderid"), "tranheaderid")
        .join(lines_of(t, "header", gone_keys).where(accepted).select("tranheaderid"), "tranheaderid")
        .join(lines_of(t, "pool_line", gone_keys).select("tranheaderid", "groupunitsequence"), "tranheaderid", "left")
        .where(kept_group)
        .select("tranheaderid", "terdisplayid", "cancelleddate").distinct()
    )
    validated = (
        t["validated"].where(D.window(F.col("validationdate"), span.lo, span.hi, "both"))
        .select("tranheaderid", "terdisplayid", "validationdate", "winningamount", "rebateamount", "refundamount")
        .join(t["validated_state"].where(F.col("betstatetypeid") == "VB06").select("tranheaderid"), "tranheaderid")
    )
    payouts = reduce(
        lambda a, b: a + b,
        [F.when(F.col(c) != 0, 1).otherwise(0) for c in ("winningamount", "rebateamount", "refundamount")],
    )
    rebated = (
        t["horse_line"]
        .where((F.col("boardrebateamount") > 0) & D.window(F.col("createddate"), utc.lo, utc.hi, "both"))
        .select(*ident)
        .join(t["header_state"].where(F.col("betstatetypeid") == "PB06").select("tranheaderid"), "tranheaderid", "left_semi")
        .distinct()
    )
    vouchers = (
        t["offline_voucher"].where(F.col("isactive")).select("headerid", "terdisplayid")
        .join(
            t["offline_header"].where(D.window(F.col("transactiontime"), span.lo, span.hi, "both"))
            .select(F.col("transactionheaderid").alias("headerid"), "transactiontime"),
            "headerid",
        )
    )
    parts = [
        _event(placed, at_header, one, True, F.col("printed"), "placed"),
        _event(unprinted, at_header, one, True, None, "unprinted"),
        _event(cancelled, F.col("cancelleddate"), one, False, None, "any"),
        _event(validated, F.col("validationdate"), payouts, False, None, "any"),
        _event(rebated, at_header, one, False, None, "any"),
        _event(vouchers, F.col("transactiontime"), one, False, None, "any"),
    ]
    for part in ("charity", "spa", "topup", "festive"):
        rows = t[f"offline_{part}"].where(D.window(F.col("createddate"), utc.lo, utc.hi, "both"))
        parts.append(_event(rows, at_header, F.col("repeatedticket"), False, None, "any"))
    return reduce(DataFrame.unionByName, parts)


def operating_hours(t: Tables, run_date: dt.date) -> DataFrame:
    span = latest_period(t, run_date)
    terminals = t["terminal"].select("terdisplayid", "locid", "isdeleted")
    if span is None:
        span = Span(dt.datetime.max.replace(microsecond=0), dt.datetime.min.replace(year=1000))
    sessions = (
        t["session"].where(D.window(F.col("sessionstartdatetime"), span.lo, span.hi, "both"))
        .groupBy("terdisplayid")
        .agg(F.min("sessionstartdatetime").alias("start"), F.max("sessionenddatetime").alias("end"))
        .join(terminals.select("terdisplayid", "locid"), "terdisplayid")
        .join(t["location"].select("locid", "sweepindicator"), "locid")
        .select("terdisplayid", "start", "end", "sweepindicator")
    )
    at = F.col("at")
    first = D.closed(at, F.col("start"), F.col("start") + D.hours(HOUR))
    last = D.closed(at, F.col("end") - D.hours(HOUR), F.col("end"))
    counts = (
        _events(t, span).join(sessions, "terdisplayid")
        .where(_counts_for(F.col("need"), F.col("printed"), F.col("sweepindicator")))
        .groupBy("terdisplayid")
        .agg(
            F.min("sale_at").alias("first_sale"), F.max("sale_at").alias("last_sale"),
            F.sum(F.when(first, F.col("weight")).otherwise(0)).alias("first_count"),
            F.sum(F.when(last, F.col("weight")).otherwise(0)).alias("last_count"),
        )
    )
    day_number = (span.lo - dt.timedelta(days=1)).isoweekday() % 7 + 1
    hours = t["operating_hours"].where(
        (F.col("isdeleted") == F.lit(False)) & (F.col("dayno") == day_number)
    ).select("locid", "opentime", "closetime")
    location = t["location"].where(F.col("isdeleted") == F.lit(False)).select("locid", "locname", "locdisplayid")
    return (
        terminals.where(F.col("isdeleted") == F.lit(False)).select("terdisplayid", "locid")
        .join(hours, "locid", "left")
        .join(location, "locid", "left")
        .join(sessions.drop("sweepindicator"), "terdisplayid", "left")
        .join(counts, "terdisplayid", "left")
        .select(
            F.col("locname").alias("locationname"),
            F.col("locdisplayid").alias("locationid"),
            F.col("terdisplayid").alias("terminalid"),
            F.col("opentime"),
            D.dotted_date(F.col("start")).alias("signondate"),
            D.clock_text(F.col("start")).alias("signontime"),
            D.clock_text(F.col("first_sale")).alias("firstsaletime"),
            F.coalesce("first_count", F.lit(0)).cast("int").alias("firsthourcount"),
            F.col("closetime"),
            D.dotted_date(F.col("end")).alias("signoffdate"),
            D.clock_text(F.col("end")).alias("signofftime"),
            D.clock_text(F.col("last_sale")).alias("lastsaletime"),
            F.coalesce("last_count", F.lit(0)).cast("int").alias("lasthourcount"),
        )
        .orderBy("locationname", "terminalid")
    )
