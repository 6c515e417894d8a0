"""Sports prizes and refunds paid at headquarters, by local day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import dates as D
from ..functions import money as M
from ..sources.tables import Tables
from .common import lines_of

HQ_LOCATION = "008888"


def hq_prizes(t: Tables, run_date: dt.date, hq_location: str = HQ_LOCATION) -> DataFrame:
    period = (
        t["calendar"]
        .where((F.col("host") == C.HOST_SPORTS) & (F.col("actualdate") == D.date_lit(run_date)))
        .select("previousperioddatetime", "perioddatetime")
        .orderBy("previousperioddatetime")
        .first()
    )
    lo, hi = period or (None, None)
    local = D.to_local(F.col("cartcreateddate"))
    utc_lo = D.ts_lit(lo) - D.hours(D.UTC_OFFSET_HOURS)
    utc_hi = D.ts_lit(hi) - D.hours(D.UTC_OFFSET_HOURS)
    hq = (
        t["terminal"].select("terdisplayid", "locid")
        .join(t["location"].where(F.col("locdisplayid") == hq_location).select("locid"), "locid")
        .select("terdisplayid")
    )
    carts = (
        t["cart"].where(D.closed(F.col("cartcreateddate"), utc_lo, utc_hi))
        .join(hq, "terdisplayid")
        .select("cartid", local.cast("date").alias("txndate"))
    )
    carts = t.stage.put(carts, "hq-carts")
    paid = (
        lines_of(t, "validated", carts, "cartid")
        .select("cartid", "ticketserialnumber", "validationtypeid", "winningamount", "refundamount")
        .join(t["validation_type"].select("validationtypeid"), "validationtypeid")
        .join(carts, "cartid")
    )
    paid = t.stage.put(paid, "hq-validations")
    headers = (
        lines_of(t, "header", paid, "ticketserialnumber").where(F.col("prodid").isin(C.SPORTS, C.SPORTS_LIVE))
        .select("tranheaderid", "ticketserialnumber", "prodid")
        .join(t["product"].select("prodid"), "prodid")
    )
    headers = t.stage.put(headers, "hq-headers")
    states = lines_of(t, "validated_state", headers).where(F.col("betstatetypeid") == "VB06").select("tranheaderid")
    paid = paid.join(headers.join(states, "tranheaderid"), "ticketserialnumber")
    return paid.groupBy("txndate").agg(
        F.sum(M.nz("winningamount")).cast("decimal(18,2)").alias("prizeamount"),
        F.sum(M.nz("refundamount")).cast("decimal(18,2)").alias("refundamount"),
    ).select(
        D.date_lit(run_date).alias("businessdate"), F.lit("2").alias("producttype"), "prizeamount", "refundamount",
        "txndate",
    )
