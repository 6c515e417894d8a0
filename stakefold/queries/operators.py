"""One query per reusable operator on the test tables, each with its DuckDB statement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import operators as O
from ..functions import codes as C
from ..functions import dates as D
from ..functions import money as M
from ..operators.postings import Rule, number_documents, posting_rules, totals
from ..plans.interval_transactions import once_per_price
from ..sources import (
    StageArea,
    audit_columns,
    clean_names,
    conform,
    drop_audit_columns,
    fixed_scale_text,
    fixed_width,
    read_csv_clean,
    read_run_table,
    row_counts,
    write_run_partition,
)
from ..sources.sinks import TextField
from ..testbed.binding import BASE
from ..testbed.load import base_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Base tables by attribute, with money columns exact."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return base_table(self.spark, self._folder, name)

    @property
    def sales(self) -> DataFrame:
        """Orders as tickets: product is the first character of the priority."""
        return self.orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
            F.col("o_orderdate").cast("timestamp_ntz").alias("made"),
            F.col("o_orderdate").cast("date").alias("day"),
            F.left("o_orderpriority", F.lit(1)).cast("int").alias("prodid"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        )

    @property
    def lines(self) -> DataFrame:
        """Order lines with exact amounts."""
        exact = {"price": "l_extendedprice", "qty": "l_quantity", "disc": "l_discount", "tax": "l_tax"}
        return self.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
            *[F.col(c).cast("decimal(18,2)").alias(a) for a, c in exact.items()],
        )


SALES_SQL = """sales AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate AS made, CAST(o_orderdate AS DATE) AS day,
  CAST(left(o_orderpriority, 1) AS INT) AS prodid, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders)"""
LINES_SQL = """lines AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(18,2)) AS qty, CAST(l_discount AS DECIMAL(18,2)) AS disc,
  CAST(l_tax AS DECIMAL(18,2)) AS tax FROM lineitem)"""


def query(name: str, sql: str | None):
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = f"WITH {SALES_SQL}, {LINES_SQL} {sql.strip()}"
        return fn

    return register


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# --- scans, sinks -------------------------------------------------------------


@query("scan_window_halfopen", "SELECT o_orderkey, o_custkey, total FROM sales WHERE made >= TIMESTAMP '1996-01-01' AND made < TIMESTAMP '1997-01-01'")
def _(t):
    lo, hi = dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)
    return t.sales.where(D.window(F.col("made"), lo, hi, "left")).select("o_orderkey", "o_custkey", "total")


@query("scan_window_closed", "SELECT o_orderkey, o_custkey, total FROM sales WHERE made BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-01-01'")
def _(t):
    lo, hi = dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)
    return t.sales.where(D.window(F.col("made"), lo, hi, "both")).select("o_orderkey", "o_custkey", "total")


@query("scan_clean_header", "SELECT p_partkey AS PART_KEY, p_brand AS BRAND_CODE, p_size AS SIZE_MM FROM part")
def _(t):
    raw = t.part.select("p_partkey", "p_brand", "p_size").toDF(" part--key ", "Brand (code)", "size.[mm]")
    return clean_names(raw)


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{b}' AS table_name, count(*) AS row_count FROM {b}" for b in BASE))
def _(t):
    return row_counts({b: getattr(t, b) for b in BASE})


_DAILY = "SELECT o_custkey, count(*) AS n, CAST(sum(total) AS DECIMAL(28,2)) AS total, '{d}' AS PROCDATE, 'daily' AS X_ETL_NAME FROM sales {w} GROUP BY 1"


@query(
    "audit_run_partition",
    _DAILY.format(d="20240105", w="WHERE o_orderstatus <> 'P'") + " UNION ALL " + _DAILY.format(d="20240106", w="WHERE o_orderstatus = 'P'"),
)
def _(t):
    path = f"{StageArea.scratch(t.spark).root}/daily"

    def run(rows, day):
        out = rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("total").cast("decimal(28,2)").alias("total"))
        write_run_partition(audit_columns(out, "daily", day), path, day)

    first, second = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    cancelled = F.col("o_orderstatus") == "P"
    run(t.sales, first)  # replaced by the re-run of the same date
    run(t.sales.where(cancelled), second)
    run(t.sales.where(~cancelled), first)
    schema = StructType.fromDDL("o_custkey bigint, n bigint, total decimal(28,2), X_ETL_NAME string")
    return read_run_table(t.spark, path, schema)


@query("csv_round_trip", "SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_mktsegment AS C_MKTSEGMENT FROM customer")
def _(t):
    path = f"{StageArea.scratch(t.spark).root}/customers-csv"
    t.customer.select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(path)
    return read_csv_clean(t.spark, path, StructType.fromDDL("c_custkey bigint, c_name string, c_mktsegment string"))


@query("parquet_round_trip", "SELECT s_nationkey, count(*) AS n, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS bal FROM supplier GROUP BY 1")
def _(t):
    stored = StageArea.scratch(t.spark).write(t.supplier.withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(18,2)")), "supplier")
    return stored.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("s_acctbal").cast("decimal(28,2)").alias("bal"))


@query(
    "conform_output",
    """SELECT c_custkey AS id, left(c_name, 12) AS name, CAST(coalesce(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END, 0) AS DECIMAL(18,2)) AS bal,
    CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(32,11)) AS VARCHAR) AS txt FROM customer""",
)
def _(t):
    raw = audit_columns(t.customer, "x", dt.date(2024, 1, 5)).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 20 == 0, F.lit(float("inf"))).when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("bal"),
        fixed_scale_text(F.col("c_acctbal").cast("decimal(18,2)")).alias("txt"), "X_ETL_NAME",
    )
    schema = StructType.fromDDL("id bigint, name string, bal decimal(18,2), txt string")
    return conform(drop_audit_columns(raw), schema, {"name": 12})


_LAYOUT = [
    TextField("o_orderkey", 12, "0", left=False), TextField("day", 8), TextField("o_orderpriority", 6),
    TextField("cents", 15, "0", left=False),
]


@query(
    "fixed_width_ledger",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || strftime(day, '%d%m%Y') || rpad(o_orderpriority, 6, ' ')
    || lpad(CAST(CAST(total * 100 AS DECIMAL(20,0)) AS VARCHAR), 15, '0') AS value FROM sales""",
)
def _(t):
    rows = t.sales.select(
        "o_orderkey", F.date_format("day", "ddMMyyyy").alias("day"), "o_orderpriority",
        (F.col("total") * 100).cast("decimal(20,0)").alias("cents"),
    )
    return fixed_width(_LAYOUT, rows)


# --- predicates and decodes ---------------------------------------------------


@query(
    "status_code",
    """SELECT o_orderkey, CAST(CASE WHEN x AND (r OR c) THEN 5 WHEN x THEN 6 WHEN r AND c THEN 4 WHEN r THEN 3 WHEN c THEN 2 ELSE 1 END AS INT) AS status
    FROM (SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 = 0 END, false) AS r, o_orderstatus = 'P' AS c, o_orderkey % 11 = 0 AS x FROM sales)""",
)
def _(t):
    key = F.col("o_orderkey")
    rejected = F.when(key % 7 != 0, key % 5 == 0)
    return t.sales.select("o_orderkey", C.bet_status(rejected, F.col("o_orderstatus") == "P", key % 11 == 0).alias("status"))


@query(
    "decode_multi",
    """SELECT code, count(*) AS n FROM (SELECT CAST(CASE l_linenumber % 4
      WHEN 0 THEN s * 5 WHEN 1 THEN 1 + s * 5 + p WHEN 2 THEN 27 + s * 4 + p ELSE 15 + s * 4 + l_suppkey % 4 END AS VARCHAR) AS code FROM (
      SELECT l_linenumber, l_suppkey, CASE WHEN qty > 10 THEN CASE WHEN tax > 0 THEN 2 ELSE 0 END WHEN tax > 0 THEN 1 END AS s,
      CASE l_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 END AS p FROM lines)) GROUP BY 1""",
)
def _(t):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("ORD", "SYS", "IBET", "ROLL")]), F.col("l_linenumber") % 4 + 1)
    step = C.lookup((F.col("l_partkey") % 5).cast("int"), {0: 24, 1: 12, 2: 4, 3: 6})
    number = C.lookup((F.col("l_suppkey") % 4).cast("int"), {0: "R123", 1: "1R23", 2: "12R3", 3: "123R"})
    big = F.when(F.col("qty") > 10, F.col("qty"))
    code = C.four_d_bet_code(kind, big, F.col("tax"), step, number)
    return t.lines.select(code.alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "host_window_filter",
    """SELECT prodid, count(*) AS n, CAST(sum(total) AS DECIMAL(28,2)) AS total FROM sales WHERE
    (prodid = 1 AND made >= TIMESTAMP '1995-06-01' AND made < TIMESTAMP '1997-06-01') OR (prodid IN (2, 3, 4) AND made >= TIMESTAMP '1996-01-01'
    AND made < TIMESTAMP '1999-01-01') OR (prodid = 5 AND made >= TIMESTAMP '1998-01-01' AND made < TIMESTAMP '2001-01-01') GROUP BY 1""",
)
def _(t):
    def ts(y, m):
        return D.ts_lit(dt.datetime(y, m, 1))

    hosts = [([1], ts(1995, 6), ts(1997, 6)), ([2, 3, 4], ts(1996, 1), ts(1999, 1)), ([5], ts(1998, 1), ts(2001, 1))]
    return t.sales.where(O.host_window_filter(F.col("prodid"), F.col("made"), hosts, "left")).groupBy("prodid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").cast("decimal(28,2)").alias("total")
    )


@query(
    "any_all_set",
    """SELECT p_brand, count(*) FILTER (WHERE p_type IN ('ECONOMY', 'SMALL')) AS in_set, count(*) FILTER (WHERE p_type NOT IN ('ECONOMY', 'SMALL')) AS out_set
    FROM part GROUP BY 1""",
)
def _(t):
    chosen = F.col("p_type").isin("ECONOMY", "SMALL")
    return t.part.groupBy("p_brand").agg(F.count(F.when(chosen, 1)).alias("in_set"), F.count(F.when(~chosen, 1)).alias("out_set"))


@query(
    "prefix_and_code_maps",
    """SELECT CASE WHEN starts_with(o_orderpriority, '1-') THEN 'RFD' WHEN starts_with(o_orderpriority, '2-') THEN 'RBT' ELSE 'PAY' END AS flag,
    CAST(CASE prodid WHEN 1 THEN 7 WHEN 2 THEN 9 WHEN 3 THEN 23 WHEN 4 THEN 11 ELSE 20 END AS INT) AS code, count(*) AS n FROM sales GROUP BY 1, 2""",
)
def _(t):
    p = F.col("o_orderpriority")
    flag = F.when(p.startswith("1-"), "RFD").when(p.startswith("2-"), "RBT").otherwise("PAY")
    return t.sales.groupBy(flag.alias("flag"), C.lookup(F.col("prodid"), C.PRODUCT_CODES).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sweep_print_rule",
    """SELECT state, count(*) AS n FROM (SELECT CASE WHEN l_linestatus = 'O' THEN 'PB06' ELSE 'PB03' END AS state, CASE WHEN l_returnflag <> 'R' THEN 1 END AS printed,
    CASE WHEN l_suppkey % 3 = 0 THEN 1 END AS ind FROM lines) WHERE (state = 'PB06' AND (printed IS NOT NULL OR ind IS NULL))
    OR (state = 'PB03' AND printed IS NULL AND ind IS NOT NULL) GROUP BY 1""",
)
def _(t):
    state = F.when(F.col("l_linestatus") == "O", "PB06").otherwise("PB03")
    printed, ind = F.when(F.col("l_returnflag") != "R", 1), F.when(F.col("l_suppkey") % 3 == 0, 1)
    rows = t.lines.select(state.alias("state"), printed.alias("printed"), ind.alias("ind"))
    return rows.where(C.sweep_counts(F.col("state"), F.col("printed"), F.col("ind"))).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


# --- joins --------------------------------------------------------------------


@query("inner_ticket_lines", "SELECT s.o_orderkey, s.o_custkey, count(*) AS n, CAST(sum(l.price) AS DECIMAL(28,2)) AS price FROM sales s JOIN lines l ON l.l_orderkey = s.o_orderkey GROUP BY 1, 2")
def _(t):
    # lines are reduced per order before they meet the orders
    per = t.lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("price"))
    return t.sales.join(per, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "n", "price")


@query(
    "left_spine_terminals",
    """SELECT c.c_custkey, coalesce(q.n, 0) AS n, CAST(coalesce(q.x, 0) AS DECIMAL(28,2)) AS total FROM customer c LEFT JOIN
    (SELECT o_custkey, count(*) AS n, sum(total) AS x FROM sales GROUP BY 1) q ON q.o_custkey = c.c_custkey""",
)
def _(t):
    measured = t.sales.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("x")
    )
    return O.spine_join(t.customer.select("c_custkey"), measured, ["c_custkey"]).select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("x", F.lit(0)).cast("decimal(28,2)").alias("total")
    )


@query(
    "full_net_due",
    """SELECT coalesce(d.o_custkey, c.o_custkey) AS o_custkey, CAST(coalesce(d.x, 0) - coalesce(c.x, 0) AS DECIMAL(28,2)) AS net FROM
    (SELECT o_custkey, sum(total) AS x FROM sales WHERE o_orderstatus <> 'P' GROUP BY 1) d FULL JOIN
    (SELECT o_custkey, sum(total) AS x FROM sales WHERE o_orderstatus = 'P' GROUP BY 1) c ON c.o_custkey = d.o_custkey""",
)
def _(t):
    status = F.col("o_orderstatus")
    return O.net_debit_credit(t.sales, ["o_custkey"], status != "P", status == "P", "total", "net").withColumn("net", F.col("net").cast("decimal(28,2)"))


@query(
    "cross_spine",
    """SELECT n.n_nationkey, v.p AS prodid, count(s.o_orderkey) AS n FROM nation n CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6)) v(p)
    LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN sales s ON s.o_custkey = c.c_custkey AND s.prodid = v.p GROUP BY 1, 2""",
)
def _(t):
    sold = t.sales.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")), "o_custkey")
    per = sold.groupBy("n_nationkey", "prodid").agg(F.count(F.lit(1)).alias("m"))
    spine = O.spine_of(t.nation.select("n_nationkey"), [1, 2, 3, 4, 5, 6], "prodid")
    return O.spine_join(spine, per, ["n_nationkey", "prodid"]).select("n_nationkey", "prodid", F.coalesce("m", F.lit(0)).alias("n"))


@query(
    "chain_lookup",
    """SELECT r.r_name, n.n_name, count(*) AS n, CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS bal FROM customer c
    JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1, 2""",
)
def _(t):
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")
    per = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("decimal(28,2)").alias("bal")
    )
    return per.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select("r_name", "n_name", "n", "bal")


_CAL = "cal AS (SELECT d AS actualdate, CAST(d AS TIMESTAMP) + INTERVAL 90 MINUTES AS lo, CAST(d AS TIMESTAMP) + INTERVAL 1530 MINUTES AS hi FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events))"


@query(
    "interval_join_calendar",
    f""", {_CAL} SELECT c.actualdate, count(*) AS n, CAST(sum(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM events e LEFT JOIN cal c ON e.ts BETWEEN c.lo AND c.hi GROUP BY 1""",
)
def _(t):
    events = t.events.select(F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    start = F.col("actualdate").cast("timestamp_ntz")
    cal = events.select(F.col("ts").cast("date").alias("actualdate")).distinct().select(
        "actualdate", (start + D.hours(1.5)).alias("lo"), (start + D.hours(25.5)).alias("hi")
    )
    cal = StageArea.scratch(t.spark).put(cal, "calendar")  # stored, its true size is seen
    return O.interval_join(events, cal, "ts", "lo", "hi", ["actualdate"]).groupBy("actualdate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(28,2)").alias("total")
    )


@query(
    "interval_join_mixed",
    f""", {_CAL}, every AS (SELECT strftime(actualdate, '%Y-%m-%d') AS label, lo, hi FROM cal
    UNION ALL SELECT 'month-' || strftime(m, '%m'), CAST(m AS TIMESTAMP), CAST(m AS TIMESTAMP) + INTERVAL 31 DAYS
      FROM (SELECT DISTINCT date_trunc('month', actualdate) AS m FROM cal)
    UNION ALL SELECT 'open', CAST(min(actualdate) AS TIMESTAMP) + INTERVAL 36 HOURS, TIMESTAMP '9999-12-31 00:00:00' FROM cal)
    SELECT c.label, count(*) AS n, CAST(sum(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM events e LEFT JOIN every c ON e.ts BETWEEN c.lo AND c.hi GROUP BY 1""",
)
def _(t):
    events = t.events.select(F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    days = events.select(F.col("ts").cast("date").alias("d")).distinct()
    start = F.col("d").cast("timestamp_ntz")
    daily = days.select(F.date_format("d", "yyyy-MM-dd").alias("label"), (start + D.hours(1.5)).alias("lo"), (start + D.hours(25.5)).alias("hi"))
    monthly = days.select(F.trunc("d", "month").alias("d")).distinct().select(
        F.concat(F.lit("month-"), F.date_format("d", "MM")).alias("label"), start.alias("lo"), (start + D.hours(31 * 24)).alias("hi"))
    last = D.ts_lit(dt.datetime(9999, 12, 31))
    always = days.agg(F.min("d").alias("d")).select(F.lit("open").alias("label"), (start + D.hours(36)).alias("lo"), last.alias("hi"))
    cal = StageArea.scratch(t.spark).put(reduce(DataFrame.unionByName, [daily, monthly, always]), "calendar")
    return O.interval_join(events, cal, "ts", "lo", "hi", ["label"]).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(28,2)").alias("total"))


_RATES = "rates AS (SELECT * FROM (VALUES (7.00::DECIMAL(9,2), DATE '1995-01-01', DATE '1997-03-31'), (8.00, DATE '1997-04-01', DATE '1999-12-31'), (9.00, DATE '2000-01-01', NULL)) v(rate, s, e))"


@query(
    "validity_join_rate",
    f""", {_RATES} SELECT r.rate, count(*) AS n, CAST(sum(round(x.total * r.rate * 0.01, 2)) AS DECIMAL(28,2)) AS tax FROM sales x
    JOIN rates r ON x.day >= r.s AND (r.e IS NULL OR x.day <= r.e) GROUP BY 1""",
)
def _(t):
    d = dt.date
    listed = [(Decimal(7), d(1995, 1, 1), d(1997, 3, 31)), (Decimal(8), d(1997, 4, 1), d(1999, 12, 31)), (Decimal(9), d(2000, 1, 1), None)]
    rates = t.spark.range(1).select(F.inline(O.code_table(listed, "rate decimal(9,2), s date, e date")))
    per_day = t.sales.select("day", "total")
    return O.validity_join(per_day, rates, "day", "s", "e", ["rate"]).groupBy("rate").agg(
        F.count(F.lit(1)).alias("n"), F.sum(M.tax_add(F.col("total"), F.col("rate"))).cast("decimal(28,2)").alias("tax")
    )


@query(
    "validity_join_entity",
    """, hist AS (SELECT s_suppkey AS k, DATE '1995-01-01' + CAST(s_suppkey % 900 AS INT) AS s, DATE '1998-01-01' + CAST(s_suppkey % 900 AS INT) AS e, s_suppkey % 3 <> 0 AS taxed FROM supplier)
    SELECT h.taxed, count(*) AS n, CAST(sum(l.price) AS DECIMAL(28,2)) AS price FROM lines l JOIN sales o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN hist h ON h.k = l.l_suppkey AND o.day BETWEEN h.s AND h.e GROUP BY 1""",
)
def _(t):
    shift = (F.col("s_suppkey") % 900).cast("int")
    hist = t.supplier.select(
        F.col("s_suppkey").alias("k"), F.date_add(F.lit(dt.date(1995, 1, 1)), shift).alias("s"),
        F.date_add(F.lit(dt.date(1998, 1, 1)), shift).alias("e"), (F.col("s_suppkey") % 3 != 0).alias("taxed"),
    )
    rows = t.lines.join(t.sales.select(F.col("o_orderkey").alias("l_orderkey"), "day"), "l_orderkey").select("l_suppkey", "day", "price")
    joined = O.validity_join(rows, hist, "day", "s", "e", ["taxed"], on=[("l_suppkey", "k")], how="left")
    return joined.groupBy("taxed").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("price"))


@query(
    "history_by_keys",
    """SELECT l_returnflag, count(*) AS n, CAST(sum(price) AS DECIMAL(28,2)) AS total FROM lines
    WHERE l_orderkey IN (SELECT o_orderkey FROM sales WHERE prodid = 1 AND o_orderstatus = 'F') GROUP BY 1""",
)
def _(t):
    keys = t.sales.where("prodid = 1 AND o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    possible = t.lines.where(O.key_filter(keys, "l_orderkey").test("l_orderkey"))  # tested in the scan, exact by the join
    return possible.join(keys, "l_orderkey", "left_semi").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("total"))


@query("exists_flag", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lines l WHERE l.l_orderkey = s.o_orderkey AND l.l_returnflag = 'R') AS returned FROM sales s")
def _(t):
    back = t.lines.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return O.exists_flag(t.sales.select("o_orderkey"), back, ["o_orderkey"], "returned")


@query("semi_exists", "SELECT o_orderkey, total FROM sales s WHERE EXISTS (SELECT 1 FROM lines l WHERE l.l_orderkey = s.o_orderkey AND l.qty > 45)")
def _(t):
    big = t.lines.where(F.col("qty") > 45).select(F.col("l_orderkey").alias("o_orderkey"))
    return t.sales.select("o_orderkey", "total").join(big, "o_orderkey", "left_semi")


@query(
    "anti_not_exists",
    """SELECT o_orderkey, total FROM sales s WHERE NOT EXISTS (SELECT 1 FROM lines l JOIN supplier p ON p.s_suppkey = l.l_suppkey
    WHERE l.l_orderkey = s.o_orderkey AND p.s_nationkey < 12 AND l.disc > 0.02)""",
)
def _(t):
    near = t.supplier.where(F.col("s_nationkey") < 12).select(F.col("s_suppkey").alias("l_suppkey"))
    hit = t.lines.where(F.col("disc") > Decimal("0.02")).join(near, "l_suppkey", "left_semi")
    return t.sales.select("o_orderkey", "total").join(hit.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query(
    "delete_using",
    """SELECT o_custkey, prodid, CAST(sum(total) AS DECIMAL(28,2)) AS total FROM sales s WHERE NOT (prodid = 4 AND EXISTS
    (SELECT 1 FROM customer c WHERE c.c_custkey = s.o_custkey AND c.c_acctbal < 2000)) GROUP BY 1, 2""",
)
def _(t):
    marks = t.customer.where(F.col("c_acctbal") < 2000).select(F.col("c_custkey").alias("o_custkey"))
    per = t.sales.groupBy("o_custkey", "prodid").agg(F.sum("total").cast("decimal(28,2)").alias("total"))
    return per.where(F.col("prodid") != 4).unionByName(per.where(F.col("prodid") == 4).join(marks, "o_custkey", "left_anti"))


@query(
    "self_join_group",
    """SELECT a.l_orderkey, CAST(max(b.qty) AS DECIMAL(18,2)) AS top FROM lines a JOIN lines b ON b.l_partkey = a.l_partkey
    WHERE a.l_returnflag = 'R' GROUP BY 1""",
)
def _(t):
    # the group's maximum joins back by group id: no pair of rows is ever formed
    top = t.lines.groupBy("l_partkey").agg(F.max("qty").alias("m"))
    mine = t.lines.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey").distinct()
    return mine.join(top, "l_partkey").groupBy("l_orderkey").agg(F.max("m").alias("top"))


@query(
    "normalised_key_join",
    """SELECT replace(p_brand, '#', '') AS brand, x.n FROM (SELECT DISTINCT p_brand FROM part) p
    JOIN (SELECT replace(p_brand, '#', '|') AS b, count(*) AS n FROM part GROUP BY 1) x ON replace(x.b, '|', '') = replace(p.p_brand, '#', '')""",
)
def _(t):
    left = t.part.select("p_brand").distinct().select(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")).alias("brand"))
    piped = t.part.select(F.replace(F.col("p_brand"), F.lit("#"), F.lit("|")).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    right = piped.select(F.replace(F.col("b"), F.lit("|"), F.lit("")).alias("brand"), "n")
    return left.join(right, "brand")


# --- aggregates ---------------------------------------------------------------


@query("sum_count_group", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(price) AS DECIMAL(28,2)) AS price, CAST(sum(qty) AS DECIMAL(28,2)) AS qty FROM lines GROUP BY 1, 2")
def _(t):
    return t.lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("price"), F.sum("qty").cast("decimal(28,2)").alias("qty")
    )


@query("multi_distinct", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT day) AS days, count(*) AS n FROM sales GROUP BY 1")
def _(t):
    return O.distinct_counts(t.sales, ["o_orderstatus"], {"customers": "o_custkey", "days": "day"}, n=F.count(F.lit(1)))


@query(
    "distinct_texts",
    """SELECT o_orderpriority, count(DISTINCT pair) AS texts, count(DISTINCT o_custkey) AS customers, CAST(sum(total) AS DECIMAL(28,2)) AS total
    FROM (SELECT o_orderpriority, o_orderstatus || '/' || CAST(o_custkey AS VARCHAR) AS pair, o_custkey, total FROM sales) GROUP BY 1""",
)
def _(t):
    rows = t.sales.withColumn("pair", F.concat_ws("/", "o_orderstatus", F.col("o_custkey").cast("string")))
    return O.distinct_counts(O.dense_ids(rows, "pair", "pair_id"), ["o_orderpriority"], {"texts": "pair_id", "customers": "o_custkey"},
                             total=F.sum("total").cast("decimal(28,2)"))


@query(
    "conditional_agg",
    """SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN total ELSE 0 END) AS DECIMAL(28,2)) AS col, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS can,
    min(day) AS first_day, max(day) AS last_day FROM sales GROUP BY 1""",
)
def _(t):
    status = F.col("o_orderstatus")
    return t.sales.groupBy("o_custkey").agg(
        F.sum(F.when(status == "O", F.col("total")).otherwise(0)).cast("decimal(28,2)").alias("col"),
        F.count(F.when(status == "P", 1)).alias("can"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
    )


@query(
    "pivot_max",
    "SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{e}' THEN CAST(value AS DECIMAL(18,2)) END) AS \"{e}\"" for e in EVENT_TYPES) + " FROM events GROUP BY 1",
)
def _(t):
    v = t.events.select("user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("v"))
    return v.groupBy("user_id").pivot("event_type", EVENT_TYPES).agg(F.max("v"))


@query(
    "two_level_agg",
    """SELECT o_custkey, count(*) AS orders, CAST(sum(x) AS DECIMAL(28,2)) AS price, CAST(max(x) AS DECIMAL(28,2)) AS top FROM
    (SELECT s.o_custkey, s.o_orderkey, sum(l.price) AS x FROM sales s JOIN lines l ON l.l_orderkey = s.o_orderkey GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    per = t.lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("price").alias("x"))
    return t.sales.select("o_orderkey", "o_custkey").join(per, "o_orderkey").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("x").cast("decimal(28,2)").alias("price"), F.max("x").cast("decimal(28,2)").alias("top")
    )


@query("distinct_then_sum", "SELECT l_returnflag, CAST(sum(qty) AS DECIMAL(28,2)) AS qty FROM (SELECT DISTINCT l_returnflag, l_orderkey, qty FROM lines) GROUP BY 1")
def _(t):
    return O.distinct_sum(t.lines, ["l_orderkey"], ["l_returnflag"], "qty", "s").select("l_returnflag", F.col("s").cast("decimal(28,2)").alias("qty"))


@query(
    "group_dedupe_mixed",
    """SELECT l_suppkey, CAST(sum(x) AS DECIMAL(28,2)) AS amount FROM (SELECT l_suppkey, l_orderkey, f, qty, CASE f WHEN 'W-P' THEN max(qty) ELSE sum(qty) END AS x
    FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN 'W-P' ELSE 'WIN' END AS f FROM lines) GROUP BY 1, 2, 3, 4) GROUP BY 1""",
)
def _(t):
    kind = F.when(F.col("l_returnflag") == "R", C.TWO_WAY).otherwise("WIN")
    rows = t.lines.select("l_suppkey", F.col("l_orderkey").alias("tranheaderid"), kind.alias("bettypeid"), "qty")
    return once_per_price(rows, ["l_suppkey"], ["qty"], {"amount": "qty"}).select("l_suppkey", F.col("amount").cast("decimal(28,2)").alias("amount"))


@query(
    "max_then_sum",
    """SELECT c_nationkey, CAST(sum(m) AS DECIMAL(28,2)) AS bal FROM (SELECT c.c_nationkey, c.c_custkey, max(CAST(c.c_acctbal AS DECIMAL(18,2))) AS m
    FROM customer c JOIN sales s ON s.o_custkey = c.c_custkey GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    rows = t.sales.select(F.col("o_custkey").alias("c_custkey")).join(
        t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("b")), "c_custkey"
    )
    return O.max_then_sum(rows, ["c_custkey"], ["c_nationkey"], "b", "s").select("c_nationkey", F.col("s").cast("decimal(28,2)").alias("bal"))


@query(
    "ordered_texts",
    """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS grp,
    string_agg(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), ',' ORDER BY l_orderkey * 10 + l_linenumber DESC) AS boards FROM lines GROUP BY 1""",
)
def _(t):
    order, grp = F.col("l_orderkey"), F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey"))  # a third in one group
    rows = t.lines.select(grp.alias("grp"), (order * 10 + F.col("l_linenumber")).alias("board"))
    return O.ordered_texts(rows, ["grp"], "board", ",", "boards", descending=True)


@query("ordered_concat", "SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber DESC) AS boards FROM lines GROUP BY 1")
def _(t):
    return t.lines.groupBy("l_orderkey").agg(O.ordered_concat(F.col("l_linenumber"), ",", descending=True).alias("boards"))


@query(
    "price_times_count",
    """SELECT l_suppkey, CAST(sum(x) AS DECIMAL(28,2)) AS amount FROM (SELECT l_suppkey, l_returnflag, qty, CASE WHEN l_returnflag = 'N' THEN qty * count(*) ELSE sum(qty) END AS x
    FROM lines GROUP BY 1, 2, 3) GROUP BY 1""",
)
def _(t):
    per = t.lines.groupBy("l_suppkey", "l_returnflag", "qty").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("s"))
    x = F.when(F.col("l_returnflag") == "N", F.col("qty") * F.col("n").cast(M.COUNT)).otherwise(F.col("s"))
    return per.groupBy("l_suppkey").agg(F.sum(x).cast("decimal(28,2)").alias("amount"))


@query(
    "avg_share",
    """SELECT l_orderkey, n, CAST((2 * CAST(x * 100 AS HUGEINT) + n) // (2 * n) * 0.01 AS DECIMAL(18,2)) AS share
    FROM (SELECT l_orderkey, count(*) AS n, sum(price) AS x FROM lines GROUP BY 1)""",
)
def _(t):
    per = t.lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(22,2)").alias("x"))
    return per.select("l_orderkey", "n", M.safe_ratio(F.col("x"), F.col("n").cast(M.COUNT), "decimal(18,2)").alias("share"))


@query(
    "signed_net",
    "SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN -total ELSE total END) AS DECIMAL(28,2)) AS net, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END) AS BIGINT) AS n FROM sales GROUP BY 1",
)
def _(t):
    rows = t.sales.select("o_custkey", "total", F.lit(1).alias("n"), "o_orderstatus")
    back = F.col("o_orderstatus") == "P"
    both = O.signed_union(rows.where(~back), rows.where(back), ["total", "n"])
    return both.groupBy("o_custkey").agg(F.sum("total").cast("decimal(28,2)").alias("net"), F.sum("n").alias("n"))


@query(
    "lifecycle_total",
    """SELECT total, count(*) AS tickets FROM (SELECT user_id, d, CAST(sum(c) AS BIGINT) AS total FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d,
    CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 3 WHEN 'error' THEN 5 WHEN 'signup' THEN 10 ELSE 20 END AS c FROM events) GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    code = C.lookup(F.col("event_type"), {"click": 1, "purchase": 3, "error": 5, "signup": 10, "view": 20})
    rows = t.events.select("user_id", F.col("ts").cast("date").alias("d"), code.alias("c")).distinct()
    return O.lifecycle_total(rows, ["user_id", "d"], "c", "total").groupBy("total").agg(F.count(F.lit(1)).alias("tickets"))


# --- numbering, order ---------------------------------------------------------

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "price"]


@query("row_number_board", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, price) AS board FROM lines")
def _(t):
    bucket = F.struct("l_linenumber", F.floor(F.col("l_partkey") / 100_000))
    rows = StageArea.scratch(t.spark).put(t.lines.select("l_orderkey", *_LINE_ORDER), "lines")  # numbering reads its rows twice
    return O.number_within(rows, ["l_orderkey"], _LINE_ORDER, bucket, "board").drop("price")


@query("first_leg", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, price) AS r FROM lines) WHERE r = 1")
def _(t):
    return O.first_per_group(t.lines.select("l_orderkey", *_LINE_ORDER), ["l_orderkey"], _LINE_ORDER)


@query("document_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 100 AS docno FROM sales")
def _(t):
    return O.document_numbers(t.sales.select("o_orderkey"), ["o_orderkey"], "docno", offset=100)


@query("latest_period", "SELECT o_orderkey, day, total FROM sales ORDER BY made DESC, o_orderkey DESC LIMIT 1")
def _(t):
    return t.sales.orderBy(F.col("made").desc(), F.col("o_orderkey").desc()).limit(1).select("o_orderkey", "day", "total")


@query("ordered_output", "SELECT o_custkey, prodid, CAST(sum(total) AS DECIMAL(28,2)) AS total FROM sales GROUP BY 1, 2 ORDER BY 1, 2")
def _(t):
    return t.sales.groupBy("o_custkey", "prodid").agg(F.sum("total").cast("decimal(28,2)").alias("total")).orderBy("o_custkey", "prodid")


# --- set operations, edits ----------------------------------------------------


@query(
    "union_all_branches",
    """SELECT 'COL' AS flag, o_custkey, total FROM sales WHERE o_orderstatus = 'O' UNION ALL SELECT 'PAY', o_custkey, -total FROM sales WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'CAN', o_custkey, -total FROM sales WHERE o_orderstatus = 'P'""",
)
def _(t):
    # branches that only tag rows of one table are one pass with a decode, not three scans
    flag = C.lookup(F.col("o_orderstatus"), {"O": "COL", "F": "PAY", "P": "CAN"})
    return t.sales.select(flag.alias("flag"), "o_custkey", M.signed(flag, ["PAY", "CAN"], F.col("total")).cast("decimal(18,2)").alias("total"))


@query("union_distinct", "SELECT o_custkey, prodid FROM sales WHERE o_orderstatus = 'O' UNION SELECT o_custkey, prodid FROM sales WHERE o_orderstatus <> 'O' UNION SELECT user_id, 0 FROM events")
def _(t):
    a = t.sales.select("o_custkey", "prodid")  # both branches are one scan
    b = t.events.select(F.col("user_id").alias("o_custkey"), F.lit(0).alias("prodid"))
    return a.unionByName(b).distinct()


@query("dedupe_subset", "SELECT o_custkey, prodid, min_by(o_orderkey, o_orderkey) AS o_orderkey FROM sales GROUP BY 1, 2")
def _(t):
    return O.first_per_group(t.sales.select("o_custkey", "prodid", "o_orderkey"), ["o_custkey", "prodid"], ["o_orderkey"])


@query(
    "replace_slice",
    """SELECT o_custkey, o_orderstatus AS flag, CAST(sum(total) AS DECIMAL(28,2)) AS x FROM sales WHERE o_orderstatus <> 'F' GROUP BY 1, 2
    UNION ALL SELECT o_custkey, 'F', CAST(max(total) AS DECIMAL(28,2)) FROM sales WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def _(t):
    base = t.sales.groupBy("o_custkey", F.col("o_orderstatus").alias("flag")).agg(F.sum("total").cast("decimal(28,2)").alias("x"))
    new = t.sales.where(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.max("total").cast("decimal(28,2)").alias("x"))
    return O.replace_slice(base, F.col("flag") == "F", new.withColumn("flag", F.lit("F")))


@query(
    "update_from",
    """SELECT s.o_orderkey, s.o_orderstatus, CAST(CASE WHEN s.o_orderstatus = 'P' THEN coalesce(q.n, 0) ELSE 0 END AS INT) AS n FROM sales s
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lines GROUP BY 1) q ON q.l_orderkey = s.o_orderkey""",
)
def _(t):
    base = t.sales.select("o_orderkey", "o_orderstatus", F.lit(0).alias("n"))
    new = t.lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    return O.update_from(base, new, ["o_orderkey"], "n", F.col("o_orderstatus") == "P")


@query(
    "rollup_insert",
    """, g AS (SELECT o_custkey, prodid, CAST(sum(total) AS DECIMAL(28,2)) AS x FROM sales GROUP BY 1, 2)
    SELECT o_custkey, prodid, x FROM g UNION ALL SELECT o_custkey, 34, CAST(sum(x) AS DECIMAL(28,2)) FROM g WHERE prodid IN (3, 4) GROUP BY 1
    UNION ALL SELECT o_custkey, 55, x FROM g WHERE prodid = 5""",
)
def _(t):
    g = t.sales.groupBy("o_custkey", "prodid").agg(F.sum("total").cast("decimal(28,2)").alias("x"))
    both = g.where(F.col("prodid").isin(3, 4)).groupBy("o_custkey").agg(F.sum("x").cast("decimal(28,2)").alias("x")).withColumn("prodid", F.lit(34))
    clone = g.where(F.col("prodid") == 5).withColumn("prodid", F.lit(55))
    return reduce(DataFrame.unionByName, [g, both, clone])


@query(
    "unpivot_nonzero",
    """SELECT kind, l_returnflag, count(*) AS n, CAST(sum(x) AS DECIMAL(28,2)) AS x FROM (SELECT l_returnflag, 'DISCOUNT' AS kind, disc AS x FROM lines
    UNION ALL SELECT l_returnflag, 'TAX', tax FROM lines UNION ALL SELECT l_returnflag, 'QUANTITY', qty FROM lines) WHERE x <> 0 GROUP BY 1, 2""",
)
def _(t):
    long = O.unpivot_nonzero(t.lines, ["l_returnflag"], {"disc": "DISCOUNT", "tax": "TAX", "qty": "QUANTITY"}, "kind", "x")
    return long.groupBy("kind", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("x").cast("decimal(28,2)").alias("x"))


# --- scalar functions ---------------------------------------------------------


@query(
    "round_trunc_money",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(v, 2) AS DECIMAL(22,2)) AS r, CAST(trunc(v * 100) * 0.01 AS DECIMAL(22,2)) AS t,
    CAST(round(v) * 0.01 AS DECIMAL(22,2)) AS rd, CAST(trunc(v) * 0.01 AS DECIMAL(22,2)) AS td
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * price * disc AS v FROM lines)""",
)
def _(t):
    sign = F.when(F.col("l_returnflag") == "R", F.lit(Decimal("-1"))).otherwise(F.lit(Decimal("1")))
    v = F.col("v")
    rows = t.lines.withColumn("v", (sign * F.col("price") * F.col("disc")).cast("decimal(22,4)"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", M.round_money(v).cast(M.MONEY).alias("r"),
        M.trunc_money(v).cast(M.MONEY).alias("t"), M.dollars_round(v).alias("rd"), M.dollars_trunc(v).alias("td"),
    )


@query(
    "tax_exclusive",
    "SELECT o_orderkey, CAST((2 * CAST(total * 100 AS HUGEINT) * 100 + 109) // 218 * 0.01 AS DECIMAL(18,2)) AS base FROM sales",
)
def _(t):
    rate = F.lit(Decimal("0.09"))
    return t.sales.select("o_orderkey", F.round(M.tax_exclusive(F.col("total"), rate), 2).cast("decimal(18,2)").alias("base"))


@query("tax_add", "SELECT o_orderkey, CAST(round(total * 9 * 0.01, 2) AS DECIMAL(22,2)) AS tax FROM sales")
def _(t):
    return t.sales.select("o_orderkey", M.tax_add(F.col("total"), F.lit(Decimal("9"))).alias("tax"))


@query("sign_by_flag", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'F') THEN -total ELSE total END AS x, CASE WHEN prodid = 1 THEN CAST(total * 0.5 AS DECIMAL(22,3)) ELSE total END AS h FROM sales")
def _(t):
    x = M.signed(F.col("o_orderstatus"), ["P", "F"], F.col("total")).cast("decimal(18,2)")
    return t.sales.select("o_orderkey", x.alias("x"), M.half_if(F.col("prodid") == 1, F.col("total")).cast("decimal(22,3)").alias("h"))


@query("cents_truncate", "SELECT o_custkey, CAST(trunc(sum(total * 0.07)) AS DECIMAL(22,2)) AS cents FROM sales GROUP BY 1")
def _(t):
    x = F.col("total") * F.lit(Decimal("0.07"))
    return t.sales.groupBy("o_custkey").agg(M.cents_trunc(F.sum(x)).alias("cents"))


@query(
    "half_week_period",
    """SELECT day, CASE WHEN isodow(day) <= 4 THEN CAST(date_trunc('week', day) AS DATE) - 3 ELSE CAST(date_trunc('week', day) AS DATE) END AS s,
    CASE WHEN isodow(day) <= 4 THEN CAST(date_trunc('week', day) AS DATE) - 1 ELSE CAST(date_trunc('week', day) AS DATE) + 3 END AS e, count(*) AS n FROM sales GROUP BY 1, 2, 3""",
)
def _(t):
    s, e = D.half_week_columns(F.col("day"))
    return t.sales.groupBy("day").agg(F.count(F.lit(1)).alias("n")).select("day", s.alias("s"), e.alias("e"), "n")


@query(
    "time_rollover",
    """SELECT o_orderkey, strftime(CAST(day AS TIMESTAMP) + to_hours(CAST((o_orderkey % 30) % 24 AS INT)) + INTERVAL 15 MINUTES, '%Y-%m-%d %H:%M:%S') AS at FROM sales""",
)
def _(t):
    clock = F.concat(F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0"), F.lit(":15:00"))
    return t.sales.select("o_orderkey", F.date_format(D.hour_rollover(F.col("day"), clock), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "date_format_local",
    """SELECT event_id, strftime(ts + INTERVAL 8 HOURS, '%d.%m.%Y') AS d, strftime(ts + INTERVAL 8 HOURS, '%H:%M:%S') AS c, CAST(ts + INTERVAL 8 HOURS AS DATE) AS local_day,
    CAST(date_trunc('second', ts) AS VARCHAR) AS cut FROM events""",
)
def _(t):
    ts = F.col("ts").cast("timestamp_ntz")
    local = D.to_local(ts)
    return t.events.select(
        "event_id", D.dotted_date(local).alias("d"), D.clock_text(local).alias("c"), local.cast("date").alias("local_day"),
        D.cut_seconds(ts).cast("string").alias("cut"),
    )


@query("weekday_tests", "SELECT CAST(isodow(day) - 1 AS INT) AS wd, CAST(dayofweek(day) + 1 AS INT) AS dn, count(*) AS n FROM sales GROUP BY 1, 2")
def _(t):
    day = F.col("day")
    return t.sales.groupBy(F.weekday(day).alias("wd"), D.sunday_first_day_number(day).alias("dn")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_functions",
    """SELECT p_partkey, upper(trim(' ' || p_name || ' ')) AS u, left(p_name, 3) || '/' || right(p_name, 2) AS lr, CAST(instr(p_name, 'e') AS INT) AS pos,
    CAST(length(CAST(p_partkey AS VARCHAR)) AS INT) AS len, concat(p_brand, NULL, p_type) AS skip FROM part""",
)
def _(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey", F.upper(F.trim(F.concat(F.lit(" "), name, F.lit(" ")))).alias("u"),
        F.concat(F.left(name, F.lit(3)), F.lit("/"), F.right(name, F.lit(2))).alias("lr"), F.instr(name, "e").alias("pos"),
        F.length(F.col("p_partkey").cast("string")).alias("len"), F.concat_ws("", "p_brand", F.lit(None).cast("string"), "p_type").alias("skip"),
    )


# --- composites ---------------------------------------------------------------


@query(
    "session_first_last_hour",
    """, s AS (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS st, max(ts) AS en FROM events GROUP BY 1, 2)
    SELECT s.user_id, s.d, count(CASE WHEN e.ts <= s.st + INTERVAL 1 HOUR THEN 1 END) AS first_hour, count(CASE WHEN e.ts >= s.en - INTERVAL 1 HOUR THEN 1 END) AS last_hour
    FROM s JOIN events e ON e.user_id = s.user_id AND CAST(e.ts AS DATE) = s.d GROUP BY 1, 2""",
)
def _(t):
    rows = t.events.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("ts").cast("date").alias("d"))
    spans = rows.groupBy("user_id", "d").agg(F.min("ts").alias("st"), F.max("ts").alias("en"))
    ts = F.col("ts")
    return rows.join(spans, ["user_id", "d"]).groupBy("user_id", "d").agg(
        F.count(F.when(ts <= F.col("st") + D.hours(1), 1)).alias("first_hour"),
        F.count(F.when(ts >= F.col("en") - D.hours(1), 1)).alias("last_hour"),
    )


@query(
    "posting_rules",
    """, m AS (SELECT sum(CASE WHEN o_orderstatus = 'O' THEN total END) AS col, sum(CASE WHEN o_orderstatus = 'P' THEN total END) AS can,
    sum(CASE WHEN prodid = 9 THEN total ELSE 0 END) AS none FROM sales),
    l AS (SELECT 'L1' AS linecode, 1 AS grp, '01' AS pk, CAST(col AS DECIMAL(22,2)) AS amount FROM m UNION ALL SELECT 'L2', 1, '50', CAST(col AS DECIMAL(22,2)) FROM m
    UNION ALL SELECT 'L5', 3, CASE WHEN col - 2 * can > 0 THEN '40' ELSE '15' END, CAST(abs(col - 2 * can) AS DECIMAL(22,2)) FROM m)
    SELECT linecode, pk AS sappostingkey, amount, CAST(dense_rank() OVER (ORDER BY grp) AS BIGINT) AS docno FROM l""",
)
def _(t):
    status = F.col("o_orderstatus")
    row = totals(t.sales, {"col": status == "O", "can": status == "P", "none": F.col("prodid") == 9}, "total")
    row = row.withColumn("net", (F.col("col") - F.col("can") * 2).cast("decimal(22,2)"))
    rules = [
        Rule("L1", 1, "Y8", "IN", "col", "01"), Rule("L2", 1, "Y8", "IN", "col", "50"), Rule("L3", 2, "Y8", "NONE", "none", "01"),
        Rule("L5", 3, "YA", "NET", "net", "40", key_neg="15"),
    ]
    return number_documents(posting_rules(row, rules)).select("linecode", "sappostingkey", "amount", "docno")
