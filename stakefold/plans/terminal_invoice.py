"""Daily invoice per terminal."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..sources.tables import Tables
from . import invoice
from .business_dates import run_windows


def terminal_invoice(t: Tables, business_date: dt.date) -> DataFrame:
    w = run_windows(t, business_date, business_date)
    lines = invoice.invoice_lines(invoice.prepare(t, w, invoice.TERMINAL, business_date))
    return lines.select(
        "terdisplayid", D.date_lit(business_date).alias("transactiondate"), "prodid", "locdisplayid", "sales_type",
        "totalcount", "amount",
    )
