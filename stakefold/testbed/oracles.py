"""DuckDB statements that state the jobs' results independently, over the derived domain tables.

Money rules used below: ``trunc(cents) * 0.01`` is dollars cut at two digits and
``round(cents) * 0.01`` dollars rounded, both exact for decimals.
"""

from __future__ import annotations

from .binding import oracle

START, END = "2024-01-05", "2024-01-07"


def windows(start: str = START, end: str = END, name: str = "win") -> str:
    def one(host: int | None, alias: str) -> str:
        cond = "" if host is None else f" AND host = {host}"
        return (
            f"max(CASE WHEN actualdate = DATE '{start}' - 1{cond} THEN perioddatetime END) AS {alias}_lo, "
            f"max(CASE WHEN actualdate = DATE '{end}'{cond} THEN perioddatetime END) AS {alias}_hi"
        )

    names = [one(1, "lot"), one(2, "hor"), one(3, "spo"), one(None, "non")]
    return (
        f"{name}_l AS (SELECT {', '.join(names)} FROM period_history),\n{name} AS (SELECT *, "
        + ", ".join(
            f"{a}_{s} - INTERVAL 8 HOURS AS u{a}_{s}" for a in ("lot", "hor", "spo", "non") for s in ("lo", "hi")
        )
        + f" FROM {name}_l)"
    )


AMOUNT_TABLES = [
    "period_history", "header", "header_state", "horse_line", "fourd_number", "pool_line", "sweep_line",
    "sweep_number", "sports_line", "sports_number", "draw", "terminal", "location", "validated", "validated_state",
]


def amounts_cte(win: str = "win", out: str = "amounts") -> str:
    """Per-ticket amounts written as plain joins (wager x sales x validations)."""
    return f"""
ga_h AS (SELECT h.*, s.betstatetypeid AS st, s.placedbetlifecycleid AS st_id FROM header h
  JOIN header_state s ON s.tranheaderid = h.tranheaderid JOIN {win} w ON
  (h.prodid = 1 AND h.createddate >= w.uhor_lo AND h.createddate < w.uhor_hi)
  OR (h.prodid IN (2, 3, 4) AND h.createddate >= w.ulot_lo AND h.createddate < w.ulot_hi)
  OR (h.prodid IN (5, 6) AND h.createddate >= w.uspo_lo AND h.createddate < w.uspo_hi)),
ga_ind AS (SELECT t.terdisplayid FROM terminal t JOIN location l ON l.locid = t.locid
  WHERE l.sweepindicator IS NOT NULL),
ga_sw AS (SELECT h.*, b.isprinted, n.betpriceamount AS price, n.salescommamount AS comm, n.salesfactoramount AS fac
  FROM ga_h h JOIN sweep_line b ON b.tranheaderid = h.tranheaderid
  JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout WHERE h.prodid = 4),
ga_sp AS (SELECT h.*, b.betamount, b.salescommamount AS comm, b.salesfactoramount AS fac,
  b.sourcesystemtransactionid AS src, b.issinglebet AS single FROM ga_h h
  JOIN sports_line b ON b.tranheaderid = h.tranheaderid
  JOIN sports_number n ON n.tranlineitemid = b.tranlineitemid
  WHERE h.prodid IN (5, 6) AND h.st = 'PB06' AND h.isbetrejectedbytrader = false),
ga_w AS (
  SELECT h.ticketserialnumber AS tk, sum(coalesce(b.betpriceamount, 0) * CASE b.bettypeid WHEN 'W-P' THEN 0.5 ELSE 1.0 END) AS w1,
    0 AS w2 FROM ga_h h JOIN horse_line b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 1 AND h.st = 'PB06' GROUP BY 1
  UNION ALL SELECT h.ticketserialnumber, sum(coalesce(b.bigbetacceptedwager, 0)), sum(coalesce(b.smallbetacceptedwager, 0))
    FROM ga_h h JOIN fourd_number b ON b.tranheaderid = h.tranheaderid JOIN draw d ON d.tranheaderid = h.tranheaderid
    WHERE h.prodid = 2 AND h.st = 'PB06' AND h.isexchangeticket = false GROUP BY 1
  UNION ALL SELECT h.ticketserialnumber, sum(coalesce(b.betpriceamount, 0)), 0 FROM ga_h h
    JOIN pool_line b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 3 AND h.st = 'PB06'
    AND h.isexchangeticket = false AND coalesce(b.groupunitsequence, 1) = 1 GROUP BY 1
  UNION ALL SELECT g.ticketserialnumber, sum(coalesce(g.price, 0)), 0 FROM ga_sw g WHERE g.st = 'PB06'
    AND NOT (g.isprinted IS NULL AND g.terdisplayid IN (SELECT terdisplayid FROM ga_ind) AND g.tranheaderid IN
      (SELECT s.tranheaderid FROM header_state s, {win} w WHERE s.betstatetypeid = 'PB06'
       AND s.captureddate >= w.ulot_lo AND s.captureddate < w.ulot_hi)) GROUP BY 1
  UNION ALL SELECT g.ticketserialnumber, sum(coalesce(g.price, 0)), 0 FROM ga_sw g JOIN ga_ind i ON i.terdisplayid = g.terdisplayid
    WHERE g.st = 'PB03' AND g.isprinted IS NULL GROUP BY 1
  UNION ALL SELECT ticketserialnumber, sum(coalesce(betamount, 0)), 0
    FROM (SELECT DISTINCT ticketserialnumber, betamount FROM ga_sp) GROUP BY 1),
ga_s AS (
  SELECT h.ticketserialnumber AS tk, sum(coalesce(b.salesfactoramount, 0) * CASE b.bettypeid WHEN 'W-P' THEN 0.5 ELSE 1.0 END) AS s1,
    0 AS s2, sum(coalesce(b.salescommamount, 0) * CASE b.bettypeid WHEN 'W-P' THEN 0.5 ELSE 1.0 END) AS c1, 0 AS c2
    FROM ga_h h JOIN horse_line b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 1 AND h.st = 'PB06' GROUP BY 1
  UNION ALL SELECT h.ticketserialnumber, sum(coalesce(b.salesfactoramountbig, 0)), sum(coalesce(b.salesfactoramountsmall, 0)),
    sum(coalesce(b.salescommamountbig, 0)), sum(coalesce(b.salescommamountsmall, 0))
    FROM ga_h h JOIN fourd_number b ON b.tranheaderid = h.tranheaderid JOIN draw d ON d.tranheaderid = h.tranheaderid
    WHERE h.prodid = 2 AND h.st = 'PB06' AND h.isexchangeticket = false GROUP BY 1
  UNION ALL SELECT h.ticketserialnumber, sum(coalesce(b.salesfactoramount, 0)), 0, sum(coalesce(b.salescommamount, 0)), 0
    FROM ga_h h JOIN pool_line b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 3 AND h.st = 'PB06'
    AND h.isexchangeticket = false AND coalesce(b.groupunitsequence, 1) = 1 GROUP BY 1
  UNION ALL SELECT ticketserialnumber, sum(coalesce(fac, 0)), 0, sum(coalesce(comm, 0)), 0 FROM ga_sw
    WHERE st = 'PB06' GROUP BY 1
  UNION ALL SELECT ticketserialnumber, sum(fac), 0, sum(comm), 0 FROM (SELECT DISTINCT ticketserialnumber, prodid,
    tranheaderid, st_id, src, st, single, CAST(createddate + INTERVAL 8 HOURS AS DATE) AS d, coalesce(fac, 0) AS fac,
    coalesce(comm, 0) AS comm FROM ga_sp) GROUP BY 1),
{out} AS (SELECT w.tk AS ticketserialnumber, CAST(sum(w.w1) AS DECIMAL(22,2)) AS wager,
  CAST(sum(w.w2) AS DECIMAL(22,2)) AS secondwager, CAST(sum(s.s1) AS DECIMAL(22,12)) AS sales,
  CAST(sum(s.s2) AS DECIMAL(22,12)) AS secondsales, CAST(sum(s.c1) AS DECIMAL(22,12)) AS salescomm,
  CAST(sum(s.c2) AS DECIMAL(22,12)) AS secondsalescomm,
  CAST(CAST(sum(w.w1) AS DECIMAL(22,2)) - CAST(sum(s.s1) AS DECIMAL(22,12)) AS DECIMAL(22,12)) AS gst,
  CAST(CAST(sum(w.w2) AS DECIMAL(22,2)) - CAST(sum(s.s2) AS DECIMAL(22,12)) AS DECIMAL(22,12)) AS secondgst,
  CAST(sum(coalesce(v.winningamount, 0)) + sum(w.w1) + sum(w.w2) AS DECIMAL(22,2)) AS returnamount,
  CAST(sum(coalesce(v.winningamount, 0)) AS DECIMAL(22,2)) AS winningamount
  FROM ga_w w LEFT JOIN ga_s s ON s.tk = w.tk
  LEFT JOIN validated v ON v.ticketserialnumber = w.tk AND v.winningamount IS NOT NULL
  LEFT JOIN validated_state x ON x.tranheaderid = v.tranheaderid AND x.betstatetypeid = 'VB06' GROUP BY 1)"""


def ticket_amounts() -> str:
    return oracle(f"{windows()}, {amounts_cte()} SELECT * FROM amounts", *AMOUNT_TABLES)


SWEEP_TABLES = [
    "period_history", "calendar", "header", "header_state", "sweep_line", "sweep_number", "terminal", "location",
    "product", "cancelled", "cancelled_state",
]


def sweep_cte(win: str = "win", out: str = "sweeps") -> str:
    return f"""
sw_cal AS (SELECT c.* FROM calendar c, {win} w WHERE c.host = 1
  AND CAST(c.previousperioddatetime AS DATE) BETWEEN CAST(w.lot_lo AS DATE) AND CAST(w.lot_hi AS DATE)),
sw_ter AS (SELECT t.terdisplayid FROM terminal t JOIN location l ON l.locid = t.locid WHERE l.sweepindicator IS NOT NULL),
sw_pos AS (SELECT h.terdisplayid, h.prodid, c.actualdate, h.ticketserialnumber AS tk, n.salesfactoramount AS x
  FROM header h JOIN {win} w ON h.createddate BETWEEN w.ulot_lo AND w.ulot_hi
  JOIN sw_ter t ON t.terdisplayid = h.terdisplayid
  JOIN header_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'PB06'
  JOIN sweep_line b ON b.tranheaderid = h.tranheaderid
  JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout
  LEFT JOIN sw_cal c ON h.createddate BETWEEN c.previousperioddatetimeutc AND c.perioddatetimeutc),
sw_neg AS (SELECT h.terdisplayid, h.prodid, c.actualdate, h.ticketserialnumber AS tk, n.salesfactoramount AS x
  FROM cancelled h JOIN {win} w ON h.cancelleddate BETWEEN w.lot_lo AND w.lot_hi
  JOIN sw_ter t ON t.terdisplayid = h.terdisplayid
  JOIN cancelled_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'CB06'
  JOIN sweep_line b ON b.tranheaderid = h.tranheaderid
  JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout
    AND n.createddate >= w.ulot_lo - INTERVAL 45 DAYS AND n.createddate < w.ulot_hi
  LEFT JOIN sw_cal c ON h.cancelleddate BETWEEN c.previousperioddatetime AND c.perioddatetime
  WHERE h.prodid = 4),
sw_net AS (SELECT terdisplayid, prodid, actualdate, count(DISTINCT tk) AS n, sum(coalesce(x, 0)) AS x FROM sw_pos GROUP BY 1, 2, 3
  UNION ALL SELECT terdisplayid, prodid, actualdate, -count(DISTINCT tk), -sum(coalesce(x, 0)) FROM sw_neg GROUP BY 1, 2, 3),
{out} AS (SELECT q.terdisplayid, q.prodid, p.prodname, q.actualdate, CAST(sum(q.n) AS BIGINT) AS totalcount,
  CAST(CAST(trunc(sum(q.x)) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(22,2)) AS amount
  FROM sw_net q LEFT JOIN product p ON p.prodid = q.prodid GROUP BY 1, 2, 3, 4)"""


def sweep_sales() -> str:
    return oracle(f"{windows()}, {sweep_cte()} SELECT * FROM sweeps", *SWEEP_TABLES)


def hq_prizes(day: str, location: str) -> str:
    return oracle(
        f"""
per AS (SELECT previousperioddatetime AS lo, perioddatetime AS hi FROM calendar WHERE host = 3 AND actualdate = DATE '{day}')
SELECT DATE '{day}' AS businessdate, '2' AS producttype,
  CAST(sum(coalesce(v.winningamount, 0)) AS DECIMAL(18,2)) AS prizeamount,
  CAST(sum(coalesce(v.refundamount, 0)) AS DECIMAL(18,2)) AS refundamount,
  CAST(c.cartcreateddate + INTERVAL 8 HOURS AS DATE) AS txndate
FROM cart c JOIN per ON c.cartcreateddate + INTERVAL 8 HOURS BETWEEN per.lo AND per.hi
JOIN terminal t ON t.terdisplayid = c.terdisplayid JOIN location l ON l.locid = t.locid
JOIN validated v ON v.cartid = c.cartid JOIN header h ON h.ticketserialnumber = v.ticketserialnumber
JOIN product p ON p.prodid = h.prodid JOIN validation_type y ON y.validationtypeid = v.validationtypeid
JOIN validated_state x ON x.tranheaderid = h.tranheaderid AND x.betstatetypeid = 'VB06'
WHERE l.locdisplayid = '{location}' AND p.prodid IN (5, 6) GROUP BY 5""",
        "calendar", "cart", "terminal", "location", "validated", "header", "product", "validation_type", "validated_state",
    )


def state_index(first: str, last: str) -> str:
    parts = [
        f"""SELECT '{table}' AS state_table, strftime(e.day, '%Y%m%d') AS PROCDATE, s.betstatetypeid,
  count(DISTINCT s.tranheaderid) AS headers, count(*)::BIGINT AS states, CAST(max({captured}) AS VARCHAR) AS last
FROM (SELECT DISTINCT tranheaderid, CAST({at} AS DATE) AS day FROM {parent}) e JOIN {table} s ON s.tranheaderid = e.tranheaderid
WHERE e.day BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY 2, 3"""
        for table, parent, at, captured in (
            ("header_state", "header", "createddate", "s.captureddate"),
            ("validated_state", "validated", "createdvalidationdate", "s.captureddate"),
            ("cancelled_state", "cancelled", "cancelleddate", "CAST(NULL AS TIMESTAMP)"),
        )
    ]
    return oracle("dummy AS (SELECT 1) " + "\nUNION ALL ".join(parts), "header", "header_state", "validated", "validated_state", "cancelled",
                  "cancelled_state")


def clustered_join(lo: str, hi: str) -> str:
    return oracle(
        f"""
per AS (SELECT h.tranheaderid, h.createddate, count(*) AS n, sum(l.betpriceamount) AS x FROM header h
  JOIN header_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'PB06' JOIN horse_line l ON l.tranheaderid = h.tranheaderid
  WHERE h.createddate >= TIMESTAMP '{lo}' AND h.createddate < TIMESTAMP '{hi}' GROUP BY 1, 2)
SELECT CAST(createddate AS DATE) AS day, count(*) AS tickets, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(x) AS DECIMAL(28,2)) AS stake
FROM per GROUP BY 1""",
        "header", "header_state", "horse_line",
    )


def business_dates(start: str = START, end: str = END) -> str:
    sides = []
    for label, short in (("igt", "lot"), ("bmcs", "hor"), ("ob", "spo"), ("nonhost", "non")):
        for s, which in (("lo", "from"), ("hi", "to")):
            sides.append(f"CAST({short}_{s} AS VARCHAR) AS {which}date{label}")
            sides.append(f"CAST(u{short}_{s} AS VARCHAR) AS utc{which}date{label}")
    return oracle(
        f"""{windows(start, end)} SELECT DATE '{start}' AS infromdate, DATE '{end}' AS intodate, {', '.join(sides)},
CASE extract(isodow FROM DATE '{start}') WHEN 1 THEN DATE '{start}' + 4 WHEN 5 THEN DATE '{start}' + 3 END AS fundfromdate,
CASE extract(isodow FROM DATE '{start}') WHEN 1 THEN DATE '{start}' + 6 WHEN 5 THEN DATE '{start}' + 6 END AS fundtodate
FROM win""",
        "period_history",
    )


DETAIL_TABLES = [
    "period_history", "calendar", "header", "header_state", "horse_line", "fourd_number", "pool_line", "sweep_line",
    "sweep_number", "sports_line", "draw", "terminal", "location", "product", "validation_type", "validated",
    "validated_state", "cancelled", "cancelled_state", "payment", "instant_payment", "cart", "offline_header",
    "offline_voucher", "offline_charity", "offline_spa", "offline_topup", "offline_festive", "funding", "recovery",
    "adjustment", "lookup", "tax_rate", "location_tax",
]

_STATUS = """CASE WHEN h.isexchangeticket THEN CASE WHEN coalesce(h.isbetrejectedbytrader, false) OR h.iscancelled THEN 5 ELSE 6 END
  WHEN coalesce(h.isbetrejectedbytrader, false) THEN CASE WHEN h.iscancelled THEN 4 ELSE 3 END
  WHEN h.iscancelled THEN 2 ELSE 1 END"""
_MATCH = "('M AN', 'M 2', 'M 3', 'M 4')"


def details_cte(
    win: str = "win", out: str = "details", start: str = START, pre: str = "td"
) -> str:
    """Transaction measures written branch by branch."""
    p = pre
    dow = "extract(isodow FROM DATE '" + start + "')"
    fund_lo = f"CASE {dow} WHEN 1 THEN DATE '{start}' + 4 WHEN 5 THEN DATE '{start}' + 3 END"
    fund_hi = f"CASE {dow} WHEN 1 THEN DATE '{start}' + 6 WHEN 5 THEN DATE '{start}' + 6 END"

    def cal(host: int) -> str:
        return (
            f"LEFT JOIN (SELECT DISTINCT * FROM calendar WHERE host = {host}) k ON b.createddate "
            "BETWEEN k.previousperioddatetimeutc AND k.perioddatetimeutc"
        )

    def offline(part: str, amount: str, count: str, cond: str) -> str:
        return (
            f"SELECT o.terdisplayid, sum({amount}) AS a, sum({count}) AS n FROM offline_header o JOIN offline_{part} x "
            f"ON x.headerid = o.transactionheaderid JOIN {win} w ON o.transactiontime >= w.non_lo "
            f"AND o.transactiontime < w.non_hi WHERE {cond} GROUP BY 1"
        )

    times = "x.totalamount * x.repeatedticket", "x.repeatedticket"
    oo_col = " UNION ALL ".join([
        offline("voucher", "x.amount", "1", "x.isactive AND x.transactiontype = 1"),
        offline("charity", *times, "true"), offline("spa", *times, "x.transactiontype = 1"),
        offline("topup", *times, "x.transactiontype = 1"), offline("festive", *times, "true"),
    ])
    oo_rfd = " UNION ALL ".join([
        offline("voucher", "x.amount", "1", "x.isactive AND x.transactiontype IN (2, 3)"),
        offline("spa", *times, "x.transactiontype = 2"), offline("topup", *times, "x.transactiontype = 2"),
    ])
    instant = (
        f"FROM instant_payment i JOIN cart c ON c.cartid = i.cartid JOIN {win} w ON i.updateddatetime >= w.lot_lo "
        "AND i.updateddatetime < w.lot_hi WHERE "
    )
    pnr = "i.paymenttypeid = 'PNRIC' AND i.transactionstatus IN ('01', '03', '04') GROUP BY 1"
    pnq = "i.paymenttypeid = 'PNQR' AND i.transactionstatus = '01' GROUP BY 1"

    def every(name: str, flag: str, body: str) -> str:
        return (
            f"SELECT t.terdisplayid, '{name}' AS prodname, '{flag}' AS flag, CAST(q.a AS DECIMAL(24,6)) AS amount, q.n AS n "
            f"FROM terminal t LEFT JOIN ({body}) q ON q.terdisplayid = t.terdisplayid"
        )

    cards = (
        f"SELECT y.terdisplayid, sum(y.paidamount) AS a, count(DISTINCT y.paymentdetailid) AS n FROM payment y JOIN {win} w "
        "ON y.createddate >= w.unon_lo AND y.createddate < w.unon_hi WHERE y.paymenttypeid IN "
    )
    adjust = (
        "SELECT t.terdisplayid, sum(coalesce(j.adjustmentamount, 0)) AS a, count(j.adjustinvoiceid) AS n FROM adjustment j "
        "JOIN location l ON l.locid = j.locid JOIN terminal t ON t.locid = l.locid JOIN lookup k ON "
        "k.configname = 'RTMS_AdjustmentCode' AND k.fld1value = CAST(j.adjustmentcode AS VARCHAR) "
        f"JOIN {win} w ON j.createddatetime >= w.non_lo AND j.createddatetime < w.non_hi WHERE j.approvalstatus = 1 AND "
    )
    can = f"""SELECT c.terdisplayid, sum(c.cancelledamout) AS a, count(c.tranheaderid) AS n FROM {p}_h h
      JOIN cancelled c ON c.tranheaderid = h.tranheaderid"""
    return f"""
{p}_h AS (SELECT h.*, {_STATUS} AS status FROM header h),
{p}_p AS (SELECT h.* FROM {p}_h h JOIN header_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'PB06'),
{p}_mt AS (SELECT DISTINCT tranheaderid FROM pool_line WHERE bettypeid IN {_MATCH}),
{p}_tl AS (SELECT t.terdisplayid, t.locid, l.loctypeid FROM terminal t JOIN location l ON l.locid = t.locid),
{p}_pr AS (SELECT DISTINCT CASE prodid WHEN 5 THEN 'SPORTS' ELSE trim(prodname) END AS prodname FROM product
  WHERE prodid BETWEEN 1 AND 5 UNION ALL SELECT 'TOTO MATCH'),
{p}_horse AS (SELECT b.*, CASE b.bettypeid WHEN 'W-P' THEN 0.5 ELSE 1.0 END AS f FROM horse_line b
  JOIN {win} w ON b.createddate >= w.uhor_lo AND b.createddate < w.uhor_hi),
{p}_pool AS (SELECT b.* FROM pool_line b JOIN {win} w ON b.createddate >= w.ulot_lo AND b.createddate < w.ulot_hi
  WHERE coalesce(b.groupunitsequence, 1) = 1),
{p}_sal AS (
  SELECT terdisplayid, 'HORSE RACING' AS prodname, trunc(sum(a)) * 0.01 AS d, sum(n) AS n, actualdate FROM (
    SELECT h.terdisplayid, k.actualdate, b.bettypeid, sum(coalesce(b.salescommamount, 0) * b.f) AS a,
    count(DISTINCT h.ticketserialnumber) AS n FROM {p}_p h JOIN {p}_horse b ON b.tranheaderid = h.tranheaderid {cal(1)}
    WHERE h.prodid = 1 AND h.status = 1 GROUP BY 1, 2, 3) GROUP BY terdisplayid, actualdate
  UNION ALL SELECT h.terdisplayid, '4D Lottery', trunc(sum(coalesce(b.salescommamountbig, 0) + coalesce(b.salescommamountsmall, 0))) * 0.01,
    count(DISTINCT h.ticketserialnumber), k.actualdate FROM {p}_p h JOIN fourd_number b ON b.tranheaderid = h.tranheaderid
    JOIN draw d ON d.tranheaderid = h.tranheaderid JOIN {win} w ON b.createddate >= w.ulot_lo AND b.createddate < w.ulot_hi
    {cal(2)} WHERE h.prodid = 2 AND h.status = 1 GROUP BY h.terdisplayid, k.actualdate
  UNION ALL SELECT h.terdisplayid, 'TOTO', trunc(sum(b.salescommamount)) * 0.01, count(DISTINCT h.ticketserialnumber),
    k.actualdate FROM {p}_p h JOIN {p}_pool b ON b.tranheaderid = h.tranheaderid {cal(2)}
    WHERE h.prodid = 3 AND h.status = 1 AND b.bettypeid NOT IN {_MATCH} GROUP BY h.terdisplayid, k.actualdate
  UNION ALL SELECT h.terdisplayid, 'TOTO MATCH', (trunc(sum(b.salescommamount))
    - trunc(sum(CASE WHEN b.bettypeid NOT IN {_MATCH} THEN b.salescommamount ELSE 0 END))) * 0.01,
    count(DISTINCT h.ticketserialnumber), k.actualdate FROM {p}_p h JOIN {p}_pool b ON b.tranheaderid = h.tranheaderid {cal(2)}
    WHERE h.prodid = 3 AND h.status = 1 GROUP BY h.terdisplayid, k.actualdate
  UNION ALL SELECT h.terdisplayid, 'SINGAPORE SWEEP', trunc(sum(coalesce(b.salescommamount, 0))) * 0.01,
    count(DISTINCT h.ticketserialnumber), k.actualdate FROM {p}_p h JOIN sweep_number b ON b.tranheaderid = h.tranheaderid
    AND NOT b.issoldout JOIN {win} w ON b.createddate >= w.ulot_lo AND b.createddate < w.ulot_hi {cal(2)}
    WHERE h.prodid = 4 GROUP BY h.terdisplayid, k.actualdate
  UNION ALL SELECT c.terdisplayid, 'SINGAPORE SWEEP', trunc(-sum(coalesce(b.salescommamount, 0))) * 0.01,
    -count(DISTINCT c.ticketserialnumber), k.actualdate FROM cancelled c
    JOIN cancelled_state s ON s.tranheaderid = c.tranheaderid AND s.betstatetypeid = 'CB06'
    JOIN {win} w ON c.cancelleddate BETWEEN w.lot_lo AND w.lot_hi
    JOIN sweep_number b ON b.tranheaderid = c.tranheaderid AND NOT b.issoldout AND b.terdisplayid = c.terdisplayid
    AND b.createddate >= w.ulot_lo - INTERVAL 45 DAYS AND b.createddate < w.ulot_hi {cal(2)}
    WHERE c.prodid = 4 GROUP BY c.terdisplayid, k.actualdate
  UNION ALL SELECT terdisplayid, 'SPORTS', trunc(sum(coalesce(salescommamount, 0))) * 0.01, sum(n), actualdate FROM (
    SELECT b.terdisplayid, b.salescommamount, b.betamount, b.accumulatorid, b.tranheaderid, k.actualdate,
    count(DISTINCT h.ticketserialnumber) AS n FROM {p}_p h JOIN sports_line b ON b.tranheaderid = h.tranheaderid
    JOIN {win} w ON b.createddate >= w.uspo_lo AND b.createddate < w.uspo_hi {cal(3)}
    WHERE h.prodid IN (5, 6) AND h.status = 1 GROUP BY 1, 2, 3, 4, 5, 6) GROUP BY terdisplayid, actualdate),
{p}_cells AS (SELECT s.terdisplayid, s.prodname, CAST(-s.d AS DECIMAL(22,2)) AS amount, CAST(s.n AS INT) AS n, s.actualdate
  FROM {p}_sal s WHERE s.terdisplayid IN (SELECT terdisplayid FROM {p}_tl)),
{p}_gst1 AS (
  SELECT c.terdisplayid, c.prodname, c.actualdate, round(sum(c.amount) * r.gstrate * 0.01, 2) AS amount, sum(c.n) AS n
    FROM {p}_cells c JOIN tax_rate r ON c.actualdate >= r.effectivefrom AND (r.enddate IS NULL OR c.actualdate <= r.enddate)
    WHERE c.prodname <> 'TOTO MATCH' GROUP BY 1, 2, 3, r.gstrate
  UNION ALL SELECT c.terdisplayid, 'TOTO MATCH', c.actualdate, round(sum(c.amount) * r.gstrate * 0.01, 2)
    - round(sum(CASE c.prodname WHEN 'TOTO' THEN c.amount * r.gstrate * 0.01 ELSE 0 END), 2),
    sum(CASE c.prodname WHEN 'TOTO MATCH' THEN c.n ELSE 0 END) FROM {p}_cells c
    JOIN tax_rate r ON c.actualdate >= r.effectivefrom AND (r.enddate IS NULL OR c.actualdate <= r.enddate)
    WHERE c.prodname IN ('TOTO', 'TOTO MATCH') GROUP BY 1, 2, 3, r.gstrate),
{p}_gst AS (SELECT DISTINCT g.terdisplayid, g.prodname, CASE WHEN x.isgst THEN g.amount ELSE 0 END AS amount, g.n, g.actualdate
  FROM {p}_gst1 g JOIN terminal t ON t.terdisplayid = g.terdisplayid JOIN location_tax x ON x.locid = t.locid
  AND g.actualdate BETWEEN x.startdate AND x.enddate AND x.isdeleted = false),
{p}_salgst AS (
  SELECT t.terdisplayid, n.prodname, 'SAL' AS flag, CAST(coalesce(sum(c.amount), 0) AS DECIMAL(22,2)) AS amount,
    coalesce(sum(c.n), 0) AS n FROM {p}_tl t
    CROSS JOIN (VALUES ('HORSE RACING'), ('4D Lottery'), ('TOTO'), ('TOTO MATCH'), ('SINGAPORE SWEEP'), ('SPORTS')) n(prodname)
    LEFT JOIN {p}_cells c ON c.terdisplayid = t.terdisplayid AND c.prodname = n.prodname GROUP BY 1, 2
  UNION ALL SELECT t.terdisplayid, n.prodname, 'GST', CAST(coalesce(sum(g.amount), 0) AS DECIMAL(22,2)), coalesce(sum(g.n), 0)
    FROM terminal t CROSS JOIN {p}_pr n LEFT JOIN {p}_gst g ON g.terdisplayid = t.terdisplayid AND g.prodname = n.prodname
    GROUP BY 1, 2),
{p}_val AS (SELECT v.terdisplayid, CASE WHEN v.prodid IN (5, 6) THEN 'SPORTS' WHEN v.prodid = 3 AND m.tranheaderid IS NOT NULL
  THEN 'TOTO MATCH' ELSE trim(p.prodname) END AS pn, v.winningamount, v.rebateamount, v.refundamount
  FROM validated v JOIN product p ON p.prodid = v.prodid
  JOIN validated_state s ON s.tranheaderid = v.tranheaderid AND s.betstatetypeid = 'VB06'
  JOIN (SELECT [1] AS ps, uhor_lo AS lo, uhor_hi AS hi FROM {win} UNION ALL SELECT [2, 3, 4], ulot_lo, ulot_hi FROM {win}
    UNION ALL SELECT [5, 6], uspo_lo, uspo_hi FROM {win}) w ON list_contains(w.ps, v.prodid)
  AND v.createdvalidationdate >= w.lo AND v.createdvalidationdate < w.hi
  AND s.captureddate BETWEEN CAST(w.lo AS DATE) - 1 AND CAST(w.hi AS DATE) + 1
  LEFT JOIN {p}_mt m ON m.tranheaderid = v.tranheaderid),
{p}_pay AS (SELECT terdisplayid, k || '-' || pn AS prodname, sum(a) AS a, count(a) AS n FROM (
  SELECT terdisplayid, pn, 'VALIDATED' AS k, winningamount AS a FROM {p}_val
  UNION ALL SELECT terdisplayid, pn, 'LOSING BET REBATE', rebateamount FROM {p}_val
  UNION ALL SELECT terdisplayid, pn, 'REFUNDED', refundamount FROM {p}_val) WHERE a <> 0 GROUP BY 1, 2),
{p}_can AS (
  SELECT 'HORSE RACING' AS prodname, q.* FROM ({can} JOIN cancelled_state s ON s.tranheaderid = h.tranheaderid
    AND s.betstatetypeid = 'CB06' JOIN {win} w ON c.cancelleddate >= w.hor_lo AND c.cancelleddate < w.hor_hi
    WHERE h.prodid = 1 GROUP BY 1) q
  UNION ALL SELECT CASE WHEN z.prodid = 3 AND z.m THEN 'TOTO MATCH' ELSE z.pn END, z.terdisplayid, sum(z.a), sum(z.n) FROM (
    SELECT c.terdisplayid, h.prodid, trim(y.prodname) AS pn, h.tranheaderid IN (SELECT tranheaderid FROM {p}_mt) AS m,
    c.cancelledamout AS a, 1 AS n FROM {p}_h h JOIN cancelled c ON c.tranheaderid = h.tranheaderid
    JOIN product y ON y.prodid = h.prodid JOIN {win} w ON c.cancelleddate >= w.lot_lo AND c.cancelleddate < w.lot_hi
    WHERE h.prodid IN (2, 3) AND h.status = 2) z GROUP BY 1, 2
  UNION ALL SELECT trim(y.prodname), c.terdisplayid, sum(coalesce(c.cancelledamout, 0)), count(c.tranheaderid) FROM cancelled c
    JOIN cancelled_state s ON s.tranheaderid = c.tranheaderid AND s.betstatetypeid = 'CB06' JOIN product y ON y.prodid = c.prodid
    JOIN {win} w ON c.cancelleddate BETWEEN w.lot_lo AND w.lot_hi WHERE c.prodid = 4 GROUP BY 1, 2
  UNION ALL SELECT 'SPORTS', q.* FROM ({can} JOIN cancelled_state s ON s.tranheaderid = h.tranheaderid
    AND s.betstatetypeid = 'CB06' JOIN {win} w ON c.cancelleddate >= w.spo_lo AND c.cancelleddate < w.spo_hi
    WHERE h.prodid IN (5, 6) AND h.status IN (1, 2) GROUP BY 1) q),
{p}_cnt AS (SELECT terdisplayid, prodname, sum(n) AS n FROM (
  SELECT c.terdisplayid, CASE WHEN b.bettypeid IN {_MATCH} THEN 'TOTO MATCH' ELSE 'TOTO' END AS prodname,
    count(DISTINCT CASE WHEN b.groupunitsequence IS NULL THEN h.ticketserialnumber END)
    + count(DISTINCT CASE WHEN b.groupunitsequence IS NOT NULL THEN b.grouphostid END) AS n
    FROM cancelled c JOIN cancelled_state s ON s.tranheaderid = c.tranheaderid AND s.betstatetypeid = 'CB06'
    JOIN {win} w ON c.cancelleddate >= w.lot_lo AND c.cancelleddate < w.lot_hi JOIN header h ON h.tranheaderid = c.tranheaderid
    JOIN pool_line b ON b.tranheaderid = h.tranheaderid GROUP BY 1, 2) GROUP BY 1, 2),
{p}_rows AS (
  {every('HORSE RACING', 'COL', f"SELECT terdisplayid, sum(a) AS a, sum(n) AS n FROM (SELECT b.terdisplayid, b.bettypeid, sum(coalesce(b.betpriceamount, 0) * b.f) AS a, count(DISTINCT b.tranheaderid) AS n FROM header_state s JOIN {p}_horse b ON b.tranheaderid = s.tranheaderid WHERE s.betstatetypeid = 'PB06' GROUP BY 1, 2) GROUP BY 1")}
  UNION ALL {every('4D Lottery', 'COL', f"SELECT h.terdisplayid, sum(coalesce(b.bigbetacceptedwager, 0) + coalesce(b.smallbetacceptedwager, 0)) AS a, count(DISTINCT h.ticketserialnumber) AS n FROM {p}_p h JOIN fourd_number b ON b.tranheaderid = h.tranheaderid JOIN draw d ON d.tranheaderid = h.tranheaderid JOIN {win} w ON b.createddate >= w.ulot_lo AND b.createddate < w.ulot_hi WHERE h.prodid = 2 AND h.status IN (1, 2) GROUP BY 1")}
  UNION ALL {every('TOTO', 'COL', f"SELECT terdisplayid, sum(a) AS a, sum(n) AS n FROM (SELECT h.terdisplayid, b.grouphostid, b.betpriceamount, sum(b.betpriceamount) AS a, count(DISTINCT h.ticketserialnumber) AS n FROM {p}_p h JOIN {p}_pool b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 3 AND h.status IN (1, 2) AND b.bettypeid NOT IN {_MATCH} GROUP BY 1, 2, 3) GROUP BY 1")}
  UNION ALL {every('TOTO MATCH', 'COL', f"SELECT terdisplayid, sum(a) AS a, sum(n) AS n FROM (SELECT h.terdisplayid, b.grouphostid, b.betpriceamount, sum(b.betpriceamount) AS a, count(DISTINCT h.ticketserialnumber) AS n FROM {p}_p h JOIN {p}_pool b ON b.tranheaderid = h.tranheaderid WHERE h.prodid = 3 AND h.status IN (1, 2) AND b.bettypeid IN {_MATCH} GROUP BY 1, 2, 3) GROUP BY 1")}
  UNION ALL {every('SINGAPORE SWEEP', 'COL', f"SELECT h.terdisplayid, sum(coalesce(b.betpriceamount, 0)) AS a, count(DISTINCT h.tickettransactionid) AS n FROM header h JOIN header_state s ON s.tranheaderid = h.tranheaderid JOIN sweep_line e ON e.tranheaderid = h.tranheaderid JOIN sweep_number b ON b.tranlineitemid = e.tranlineitemid AND NOT b.issoldout JOIN terminal t ON t.terdisplayid = h.terdisplayid JOIN location l ON l.locid = t.locid JOIN {win} w ON b.createddate >= w.ulot_lo AND b.createddate < w.ulot_hi WHERE h.prodid = 4 AND ((s.betstatetypeid = 'PB06' AND (e.isprinted IS NOT NULL OR l.sweepindicator IS NULL)) OR (s.betstatetypeid = 'PB03' AND e.isprinted IS NULL AND l.sweepindicator IS NOT NULL)) GROUP BY 1")}
  UNION ALL {every('SPORTS', 'COL', f"SELECT terdisplayid, sum(betamount) AS a, count(DISTINCT tranheaderid) AS n FROM (SELECT DISTINCT b.terdisplayid, b.betamount, b.accumulatorid, b.tranheaderid FROM {p}_p h JOIN sports_line b ON b.tranheaderid = h.tranheaderid JOIN {win} w ON b.createddate >= w.uspo_lo AND b.createddate < w.uspo_hi WHERE h.prodid IN (5, 6) AND h.status IN (1, 2)) GROUP BY 1")}
  UNION ALL SELECT t.terdisplayid, v.validationname || '-' || n.prodname, 'PAY', CAST(q.a AS DECIMAL(24,6)), q.n FROM terminal t CROSS JOIN {p}_pr n
    CROSS JOIN validation_type v LEFT JOIN {p}_pay q ON q.terdisplayid = t.terdisplayid
    AND q.prodname = v.validationname || '-' || n.prodname
  UNION ALL SELECT t.terdisplayid, 'LOSING BET REBATE-HORSE RACING', 'PAY', CAST(round(q.a, 2) AS DECIMAL(24,6)), q.n FROM {p}_tl t LEFT JOIN (
    SELECT terdisplayid, sum(a) AS a, sum(n) AS n FROM (SELECT b.terdisplayid, b.bettypeid, sum(coalesce(b.boardrebateamount, 0) * b.f) AS a,
    count(DISTINCT b.tranheaderid) AS n FROM header_state s JOIN {p}_horse b ON b.tranheaderid = s.tranheaderid
    WHERE s.betstatetypeid = 'PB06' GROUP BY 1, 2) GROUP BY 1) q ON q.terdisplayid = t.terdisplayid
  UNION ALL SELECT t.terdisplayid, n.prodname, 'CAN', CAST(q.a AS DECIMAL(24,6)), coalesce(k.n, q.n) FROM terminal t CROSS JOIN {p}_pr n
    LEFT JOIN {p}_can q ON q.terdisplayid = t.terdisplayid AND q.prodname = n.prodname
    LEFT JOIN {p}_cnt k ON k.terdisplayid = t.terdisplayid AND k.prodname = n.prodname
  UNION ALL {every('NETS', 'CAS', cards + "('NC', 'NN') GROUP BY 1")}
  UNION ALL {every('CASHCARD/Flashpay', 'CAS', cards + "('NCC', 'NFP') GROUP BY 1")}
  UNION ALL {every('Paynow [+trans fee]', 'CAS', f"SELECT c.terdisplayid, sum(i.transactionfee - i.netamount) AS a, count(DISTINCT i.paymentdetailid) AS n {instant} {pnr}")}
  UNION ALL {every('PaynowQR [+trans fee]', 'CAS', f"SELECT c.terdisplayid, sum(i.transactionfee + i.netamount) AS a, count(DISTINCT i.paymentdetailid) AS n {instant} {pnq}")}
  UNION ALL {every('Paynow', 'CAS', f"SELECT c.terdisplayid, sum(i.transactionfee) AS a, count(DISTINCT i.paymentdetailid) AS n {instant} {pnr}")}
  UNION ALL {every('PaynowQR', 'CAS', f"SELECT c.terdisplayid, sum(i.transactionfee) AS a, count(DISTINCT i.paymentdetailid) AS n {instant} {pnq}")}
  UNION ALL {every('Offline Orders', 'COL', oo_col)}
  UNION ALL {every('Offline Orders', 'RFD', oo_rfd)}
  UNION ALL {every('Gate Admission', 'COL', offline("topup", *times, "x.transactiontype = 1"))}
  UNION ALL {every('Funding and Recovery', 'FUN', f"SELECT t.terdisplayid, sum(coalesce(f.fundingamount, 0)) AS a, 0 AS n FROM funding f JOIN location l ON l.locid = f.locid AND l.loctypeid IN (2, 4) JOIN terminal t ON t.locid = l.locid WHERE CAST(f.fundperiodstart AS DATE) = {fund_lo} AND CAST(f.fundperiodend AS DATE) = {fund_hi} GROUP BY 1")}
  UNION ALL {every('Funding and Recovery', 'REC', f"SELECT t.terdisplayid, sum(coalesce(f.fundingamount, 0)) AS a, 0 AS n FROM funding f JOIN recovery r ON r.fundingid = f.fundingid JOIN location l ON l.locid = f.locid AND l.loctypeid IN (2, 4) JOIN terminal t ON t.locid = l.locid WHERE CAST(r.recperiodstart AS DATE) = {fund_lo} AND CAST(r.recperiodend AS DATE) = {fund_hi} GROUP BY 1")}
  UNION ALL {every('Online Adjustment', 'FUN', adjust + "left(k.fld2value, 1) = 'C' GROUP BY 1")}
  UNION ALL {every('Online Adjustment', 'REC', adjust + "left(k.fld2value, 1) = 'D' GROUP BY 1")}),
{p}_all AS (
  SELECT terdisplayid, prodname, flag, CAST(round(coalesce(amount, 0)) * 0.01 * CASE WHEN flag IN ('CAN', 'PAY', 'RFD', 'FUN') THEN -1 ELSE 1 END
    AS DECIMAL(22,2)) AS amount, CAST(coalesce(n, 0) AS INT) AS n FROM {p}_rows
  UNION ALL SELECT s.terdisplayid, s.prodname, s.flag, s.amount, CAST(coalesce(CASE WHEN s.flag = 'SAL' THEN k.n END, s.n) AS INT)
    FROM {p}_salgst s LEFT JOIN (SELECT terdisplayid, prodname, sum(coalesce(CASE flag WHEN 'COL' THEN n ELSE -n END, 0)) AS n
    FROM {p}_rows WHERE flag IN ('COL', 'CAN') AND prodname IN ('TOTO', 'TOTO MATCH') GROUP BY 1, 2) k
    ON k.terdisplayid = s.terdisplayid AND k.prodname = s.prodname),
{out} AS (SELECT a.terdisplayid, regexp_replace(a.prodname, '^(REFUNDED|LOSING BET REBATE|VALIDATED)-', '') AS prodname,
  CASE WHEN starts_with(a.prodname, 'REFUNDED-') THEN 'RFD' WHEN starts_with(a.prodname, 'LOSING BET REBATE-') THEN 'RBT' ELSE a.flag END AS flag,
  a.amount, CASE WHEN a.flag = 'SAL' AND l.loctypeid = 1 THEN 0 ELSE a.n END AS ticketcount, CAST(NULL AS DATE) AS actualdate,
  CASE WHEN a.prodname IN ('Offline Orders', 'Gate Admission') THEN 'OO'
    WHEN a.prodname IN ('NETS', 'CASHCARD/Flashpay', 'Paynow [+trans fee]', 'PaynowQR [+trans fee]') THEN 'CL'
    WHEN a.prodname IN ('Paynow', 'PaynowQR') THEN 'TF' ELSE 'CH' END AS transtype
  FROM {p}_all a LEFT JOIN {p}_tl l ON l.terdisplayid = a.terdisplayid WHERE NOT starts_with(a.prodname, 'EXPIRED-'))"""


def transaction_details() -> str:
    return oracle(f"{windows()}, {details_cte()} SELECT * FROM details", *DETAIL_TABLES)


INVOICE_TABLES = list(dict.fromkeys([*DETAIL_TABLES, *AMOUNT_TABLES, *SWEEP_TABLES, "chain", "commission", "ledger_product", "invoice_period"]))


def invoice(start: str, end: str, rate_day: str, by_terminal: bool) -> str:
    """Both invoices: lines as one long union, then netting, roll-up and mapping."""
    k = "i.terdisplayid, i.locdisplayid" if by_terminal else "i.locdisplayid, i.chdisplayid"
    kc = k.replace("i.", "")
    pay_lo, pay_hi = ("w.unon_lo", "w.unon_hi") if by_terminal else ("w.ulot_lo", "w.ulot_hi")
    day = "" if by_terminal else ", CAST(h.createddate AS DATE)"
    fixed_from = "iv_place" if by_terminal else "iv_loc"
    ends = "<=" if by_terminal else "<"
    credit = "'2','3','7','108','110','112','4','61'" + ("" if by_terminal else ",'6','571','-3'")
    debit = "'1'" + ("" if by_terminal else ",'572','-2'")

    def lines(prod: str, kind: str, n: str, a: str, sub: str, body: str) -> str:
        return (
            f"SELECT {k}, CAST({prod} AS INT) AS prodid, {kind} AS sales_type, CAST({n} AS INT) AS totalcount, "
            f"CAST({a} AS DECIMAL(32,11)) AS amount, {sub} AS sub_prod FROM {body} GROUP BY ALL"
        )

    det = "details a JOIN iv_place i ON i.terdisplayid = a.terdisplayid"
    named = f"{det} JOIN iv_prod p ON p.prodname = a.prodname WHERE p.prodid BETWEEN 1 AND 5 AND "
    parts = [
        lines("p.prodid", "'1'", "sum(a.ticketcount)", "sum(a.amount * 100)", "a.prodname", named + "a.flag = 'COL' AND a.transtype <> 'OO'"),
        lines("CASE a.prodname WHEN 'Gate Admission' THEN 99 ELSE 31 END", "'1'", "sum(a.ticketcount)", "sum(a.amount * 100)",
              "''", f"{det} WHERE a.flag = 'COL' AND a.transtype = 'OO'"),
        lines("p.prodid", "CASE a.flag WHEN 'CAN' THEN '2' WHEN 'PAY' THEN '3' WHEN 'RBT' THEN '4' WHEN 'GST' THEN '6' ELSE '7' END",
              "sum(a.ticketcount)", "-sum(a.amount * 100)", "a.prodname", named + "a.flag IN ('CAN', 'PAY', 'RBT', 'GST', 'SAL')"),
        lines("p.prodid", "'61'", "sum(a.ticketcount)", "-sum(a.amount * 100)", "a.prodname", named + "a.flag = 'RFD' AND a.transtype <> 'OO'"),
        lines("31", "'61'", "sum(a.ticketcount)", "-sum(a.amount * 100)", "''", f"{det} WHERE a.flag = 'RFD' AND a.transtype = 'OO'"),
        lines("3", "'16'", "count(DISTINCT v.tranheaderid)", "sum(v.winningamount)", f"CASE WHEN b.bettypeid IN {_MATCH} THEN 'TOTO MATCH' ELSE 'TOTO' END",
              "validated v JOIN win w ON v.createdvalidationdate >= w.ulot_lo AND v.createdvalidationdate < w.ulot_hi "
              "JOIN validated_state s ON s.tranheaderid = v.tranheaderid AND s.betstatetypeid = 'VB06' "
              "JOIN (SELECT DISTINCT tranheaderid, grouphostid, groupunitsequence, bettypeid FROM pool_line WHERE groupunitsequence IS NOT NULL) b "
              "ON b.tranheaderid = v.tranheaderid JOIN iv_place i ON i.terdisplayid = v.terdisplayid WHERE v.winningamount <> 0"),
        lines("3", "'52'", "sum(y.n)", "sum(y.wager)", "'TOTO'", "iv_house y JOIN iv_place i ON i.terdisplayid = y.terdisplayid"),
        lines("3", "'25'", "sum(y.n - y.c)", "sum(trunc(y.sales))", "'TOTO'", "iv_house y JOIN iv_place i ON i.terdisplayid = y.terdisplayid"),
        lines("3", "'69'", "sum(y.n)", "sum(y.wager)", "y.sub", "iv_group y JOIN iv_place i ON i.terdisplayid = y.terdisplayid"),
        lines("3", "'60'", "sum(y.n - y.c)", "sum(trunc(y.sales))", "y.sub", "iv_group y JOIN iv_place i ON i.terdisplayid = y.terdisplayid"),
        lines("3", "'59'", "count(DISTINCT c.ticketserialnumber)", "sum(coalesce(c.cancelledamout, 0))", "'TOTO'",
              f"iv_can c JOIN win w ON c.cancelleddate >= w.lot_lo AND c.cancelleddate {ends} w.lot_hi JOIN iv_it e ON "
              "e.ticketserialnumber = c.ticketserialnumber AND e.itotoindicator JOIN iv_place i ON i.terdisplayid = c.terdisplayid WHERE c.prodid = 3"),
        lines("3", "'70'", "count(DISTINCT e.grouphostid)", "sum(coalesce(c.cancelledamout, 0))", "e.sub",
              f"iv_can c JOIN win w ON c.cancelleddate >= w.lot_lo AND c.cancelleddate {ends} w.lot_hi JOIN iv_gt e ON "
              "e.ticketserialnumber = c.ticketserialnumber JOIN iv_place i ON i.terdisplayid = c.terdisplayid WHERE c.prodid = 3"),
        lines("0", "CASE y.label WHEN 'NETS' THEN '108' WHEN 'Flashpay' THEN '110' ELSE '112' END", "sum(y.n)", "sum(y.a)", "''",
              "iv_cash y JOIN iv_place i ON i.terdisplayid = y.terdisplayid"),
        f"SELECT {k}, p.prodid, '40', 0, CAST(r.gstrate AS DECIMAL(32,11)), p.prodname FROM {fixed_from} i CROSS JOIN "
        "(SELECT * FROM iv_prod WHERE prodid IN (2, 3, 4)) p CROSS JOIN iv_rate r WHERE i.isgst",
        f"SELECT DISTINCT {k}, c.prodid, '105', 0, CAST(c.salescommission AS DECIMAL(32,11)), c.sub FROM {fixed_from} i CROSS JOIN iv_conf c WHERE i.isgst",
        f"SELECT DISTINCT {k}, c.prodid, '119', 0, CAST(c.salesfactor AS DECIMAL(32,11)), c.sub FROM {fixed_from} i CROSS JOIN iv_conf c"
        + ("" if by_terminal else " WHERE i.chdisplayid IS NOT NULL"),
    ]
    base = list(parts)
    general = lines("y.prodid", "'116'", "sum(y.n)", "sum(trunc(y.a))", "y.sub", "iv_sold y JOIN iv_place i ON i.terdisplayid = y.terdisplayid")
    if by_terminal:
        kept = f"SELECT * FROM (SELECT y.*, 1 AS one FROM ({general}) y) z WHERE NOT EXISTS (SELECT 1 FROM sweeps s WHERE s.terdisplayid = z.terdisplayid AND s.prodid = z.prodid)"
        fresh = (
            "SELECT i.terdisplayid, i.locdisplayid, s.prodid, '116', CAST(s.totalcount AS INT), CAST(s.amount * 100 AS DECIMAL(32,11)), '' "
            f"FROM sweeps s JOIN iv_place i ON i.terdisplayid = s.terdisplayid WHERE s.actualdate = DATE '{start}'"
        )
        gate_den = "(100 + CAST(r.gstrate AS INT))"
        gate = (
            f"SELECT {k}, q.prodid, '116', q.totalcount, CAST(CAST((2 * CAST(q.amount * 100 AS HUGEINT) * 100000000000 + {gate_den}) // (2 * {gate_den}) "
            "AS DECIMAL(38,0)) * 0.00000000001 AS DECIMAL(32,11)), '' FROM (SELECT * FROM iv_det WHERE prodid = 99) i JOIN iv_det q "
            "ON q.terdisplayid = i.terdisplayid AND q.prodid = 99 CROSS JOIN iv_rate r"
        )
        extra = ""
    else:
        kept = f"SELECT * FROM (SELECT y.*, 1 AS one FROM ({general}) y) z WHERE NOT EXISTS (SELECT 1 FROM iv_sw s WHERE s.locdisplayid = z.locdisplayid AND s.prodid = z.prodid)"
        fresh = "SELECT locdisplayid, chdisplayid, prodid, '116', n, a, '' FROM iv_sw"
        gate = ""
        fund = (
            "(SELECT i.locid, i.locdisplayid, i.chdisplayid, a.prodname, a.flag, max(a.amount) AS d, max(a.ticketcount) AS n FROM details a "
            "JOIN iv_place i ON i.terdisplayid = a.terdisplayid WHERE a.flag IN ('FUN', 'REC') AND (a.prodname = 'Online Adjustment' "
            "OR (a.prodname = 'Funding and Recovery' AND i.loctypeid IN (2, 4))) GROUP BY ALL) i"
        )
        extra = " UNION ALL " + lines(
            "0", "CASE WHEN i.prodname = 'Online Adjustment' THEN CASE i.flag WHEN 'REC' THEN '-2' ELSE '-3' END ELSE CASE i.flag WHEN 'REC' THEN '572' ELSE '571' END END",
            "sum(CASE i.prodname WHEN 'Online Adjustment' THEN i.n ELSE 0 END)", "sum(i.d * 100 * CASE i.flag WHEN 'FUN' THEN -1 ELSE 1 END)", "''", fund,
        )
    kept = kept.replace("SELECT * FROM (SELECT y.*, 1 AS one", f"SELECT {kc}, prodid, sales_type, totalcount, amount, sub_prod FROM (SELECT y.*")
    gone = (
        "SELECT DISTINCT c.ticketserialnumber, c.terdisplayid, c.prodid, CASE WHEN c.prodid <> 3 THEN '' WHEN c.tranheaderid IN "
        "(SELECT tranheaderid FROM td_mt) THEN 'TOTO MATCH' ELSE 'TOTO' END AS sub FROM amounts a JOIN iv_can c ON c.ticketserialnumber = a.ticketserialnumber WHERE c.prodid IN (2, 3, 4)"
        if by_terminal else
        "SELECT DISTINCT h.ticketserialnumber, h.terdisplayid, h.prodid, h.sub FROM amounts a JOIN iv_can c ON c.ticketserialnumber = a.ticketserialnumber "
        "JOIN iv_hdr h ON h.ticketserialnumber = a.ticketserialnumber WHERE h.prodid IN (2, 3, 4)"
    )

    def synd(cond: str, sub: str) -> str:
        """House or player syndicate sums per terminal (and day), with the specification's fan-out."""
        return f"""(SELECT h.terdisplayid{day} AS d, f.sub, count(DISTINCT f.tk) AS n, count(DISTINCT g.tk) AS c, sum(coalesce(f.wager, 0)) AS wager,
    sum(coalesce(f.sales, 0)) AS sales FROM header h JOIN win w ON h.createddate BETWEEN w.ulot_lo AND w.ulot_hi
    JOIN (SELECT a.ticketserialnumber AS tk, a.wager, CASE WHEN x.ticketserialnumber IS NULL THEN a.sales ELSE 0 END AS sales, {sub} AS sub
      FROM iv_it e JOIN amounts a ON a.ticketserialnumber = e.ticketserialnumber
      LEFT JOIN iv_can x ON x.ticketserialnumber = a.ticketserialnumber WHERE {cond}) f ON f.tk = h.ticketserialnumber
    LEFT JOIN (SELECT a.ticketserialnumber AS tk FROM iv_it e JOIN amounts a ON a.ticketserialnumber = e.ticketserialnumber
      JOIN iv_can x ON x.ticketserialnumber = a.ticketserialnumber WHERE {cond}) g ON g.tk = h.ticketserialnumber
    WHERE h.prodid = 3 GROUP BY ALL)""".replace(" AS d, f.sub", ", f.sub" if by_terminal else " AS d, f.sub")

    body = f"""{windows(start, end)}, {amounts_cte()}, {sweep_cte()}, {details_cte(start=start)},
iv_loc AS (SELECT l.*, c.chdisplayid FROM location l LEFT JOIN chain c ON c.chid = l.chid),
iv_place AS (SELECT t.terdisplayid, l.* FROM terminal t JOIN iv_loc l ON l.locid = t.locid),
iv_prod AS (SELECT prodid, CASE prodid WHEN 5 THEN 'SPORTS' ELSE trim(prodname) END AS prodname FROM product WHERE prodid <> 6
  UNION ALL SELECT 3, 'TOTO MATCH'),
iv_rate AS (SELECT gstrate FROM tax_rate WHERE DATE '{rate_day}' >= effectivefrom AND (enddate IS NULL OR DATE '{rate_day}' <= enddate)),
iv_conf AS (SELECT c.*, s.sub FROM commission c JOIN (VALUES (2, ''), (4, ''), (3, 'TOTO'), (3, 'TOTO MATCH')) s(prodid, sub)
  ON s.prodid = c.prodid WHERE c.commissiontype = 1 AND NOT c.isdeleted),
iv_can AS (SELECT c.* FROM cancelled c JOIN cancelled_state s ON s.tranheaderid = c.tranheaderid AND s.betstatetypeid = 'CB06'
  JOIN win w ON c.cancelleddate BETWEEN w.lot_lo AND w.lot_hi),
iv_pl AS (SELECT h.ticketserialnumber, b.*, b.bettypeid IN {_MATCH} AS m FROM header h JOIN win w ON h.createddate BETWEEN w.ulot_lo AND w.ulot_hi
  JOIN pool_line b ON b.tranheaderid = h.tranheaderid),
iv_it AS (SELECT DISTINCT ticketserialnumber, itotoindicator, groupunitsequence, m FROM iv_pl WHERE groupunitsequence = 1 OR itotoindicator),
iv_gt AS (SELECT DISTINCT ticketserialnumber, grouphostid, groupunitsequence, CASE WHEN m THEN 'TOTO MATCH' ELSE 'TOTO' END AS sub
  FROM iv_pl WHERE groupunitsequence IS NOT NULL),
iv_group AS {synd("e.groupunitsequence = 1", "CASE WHEN e.m THEN 'TOTO MATCH' ELSE 'TOTO' END")},
iv_house AS {synd("e.itotoindicator", "'TOTO'")},
iv_cash AS (SELECT y.terdisplayid, CASE y.paymenttypeid WHEN 'NCC' THEN 'CASHCARD' WHEN 'NFP' THEN 'Flashpay' ELSE 'NETS' END AS label,
  {"" if by_terminal else "y.paymenttypeid AS ty, "}sum(coalesce(y.paidamount, 0)) AS a, count(DISTINCT y.paymentdetailid) AS n
  FROM payment y JOIN win w ON y.createddate >= {pay_lo} AND y.createddate < {pay_hi}
  WHERE y.paymenttypeid IN ('NC', 'NN', 'NCC', 'NFP') GROUP BY ALL),
iv_hdr AS (SELECT h.*, CASE WHEN h.prodid <> 3 THEN '' WHEN h.tranheaderid IN (SELECT tranheaderid FROM td_mt) THEN 'TOTO MATCH' ELSE 'TOTO' END AS sub
  FROM header h),
iv_gone AS ({gone}),
iv_tk AS (SELECT h.ticketserialnumber, h.terdisplayid, h.prodid, h.sub{"" if by_terminal else ", h.createddate"}, sum(a.sales + a.secondsales) AS a
  FROM amounts a JOIN iv_hdr h ON h.ticketserialnumber = a.ticketserialnumber JOIN win w ON
  (h.prodid IN (2, 3, 4) AND h.createddate BETWEEN w.ulot_lo AND w.ulot_hi) OR (h.prodid IN (5, 6) AND h.createddate BETWEEN w.uspo_lo AND w.uspo_hi)
  OR (h.prodid = 1 AND h.createddate BETWEEN w.uhor_lo AND w.uhor_hi) WHERE h.iscancelled = false GROUP BY ALL),
iv_sold AS (SELECT x.terdisplayid, CASE x.prodid WHEN 6 THEN 5 ELSE x.prodid END AS prodid, x.sub{"" if by_terminal else ", CAST(x.createddate AS DATE) AS d"},
  sum(1 - CASE WHEN g.ticketserialnumber IS NULL THEN 0 ELSE 1 END) AS n, sum(coalesce(x.a, 0)) AS a FROM iv_tk x
  LEFT JOIN iv_gone g ON g.ticketserialnumber = x.ticketserialnumber AND g.terdisplayid = x.terdisplayid
  AND g.prodid = CASE x.prodid WHEN 6 THEN 5 ELSE x.prodid END AND g.sub = x.sub GROUP BY ALL),
iv_sw AS (SELECT i.locdisplayid, i.chdisplayid, s.prodid, CAST(sum(s.totalcount) AS INT) AS n, CAST(sum(s.amount * 100) AS DECIMAL(32,11)) AS a
  FROM sweeps s JOIN iv_place i ON i.terdisplayid = s.terdisplayid GROUP BY ALL),
iv_det AS ({parts[1]}),
iv_one AS ({" UNION ALL ".join(f"SELECT * FROM ({b})" for b in base)} UNION ALL {kept} UNION ALL {fresh}{" UNION ALL " + gate if gate else ""}{extra}),
iv_net AS (SELECT {kc}, 0 AS prodid, '727' AS sales_type, 0 AS totalcount, CAST(coalesce(sum(CASE WHEN sales_type IN ({debit}) THEN amount END), 0)
  - coalesce(sum(CASE WHEN sales_type IN ({credit}) THEN amount END), 0) AS DECIMAL(32,11)) AS amount, '' AS sub_prod
  FROM iv_one WHERE prodid NOT IN (31, 99) AND sales_type IN ({debit},{credit}) GROUP BY ALL),
iv_two AS (SELECT * FROM iv_one WHERE sales_type NOT IN ('-2', '-3') UNION ALL SELECT * FROM iv_net
  UNION ALL SELECT {kc}, prodid, sales_type, CAST(sum(totalcount) AS INT), CAST(sum(amount) AS DECIMAL(32,11)), '' FROM iv_one
    WHERE sub_prod IN ('TOTO', 'TOTO MATCH') AND sales_type NOT IN ('40', '119', '105') GROUP BY ALL
  UNION ALL SELECT {kc}, prodid, sales_type, totalcount, amount, '' FROM iv_one WHERE sub_prod = 'TOTO MATCH' AND sales_type IN ('40', '119', '105')),
iv_out AS (SELECT DISTINCT {kc}, CAST(coalesce(CASE WHEN l.prodid IS NULL THEN q.prodid WHEN q.prodid = 3 AND q.sub_prod = 'TOTO' THEN 71
  WHEN q.prodid = 3 AND q.sub_prod = 'TOTO MATCH' THEN 66 ELSE CAST(l.sapprodid AS INT) END, 0) AS INT) AS prodid, q.sales_type, q.totalcount, q.amount
  FROM iv_two q LEFT JOIN ledger_product l ON l.prodid = q.prodid WHERE q.totalcount <> 0 OR q.amount <> 0)
"""
    if by_terminal:
        body += f"SELECT terdisplayid, DATE '{start}' AS transactiondate, prodid, locdisplayid, sales_type, totalcount, amount FROM iv_out"
    else:
        body += f"""SELECT o.locdisplayid, p.invoiceperiodid AS agentinvoice_invid, o.chdisplayid AS agentinvoice_finidn,
  o.prodid AS agentinvoice_productid, o.sales_type, o.totalcount, o.amount FROM iv_out o
  JOIN invoice_period p ON p.startdate = DATE '{start}' AND p.enddate = DATE '{end}' WHERE coalesce(o.chdisplayid, '') <> ''"""
    return oracle(body, *INVOICE_TABLES)


HOURS_TABLES = [
    "calendar", "session", "terminal", "location", "header", "header_state", "pool_line", "sweep_number", "sweep_line",
    "cancelled", "cancelled_state", "validated", "validated_state", "horse_line", "offline_voucher", "offline_header",
    "offline_charity", "offline_spa", "offline_topup", "offline_festive", "operating_hours",
]


def operating_hours(day: str) -> str:
    def flags(at: str, start: str, end: str, n: str = "1", miss: str = "NULL") -> str:
        return (
            f"CASE WHEN {at} >= s.{start} AND {at} <= s.{start} + INTERVAL 1 HOUR THEN {n} ELSE {miss} END AS f, "
            f"CASE WHEN {at} >= s.{end} - INTERVAL 1 HOUR AND {at} <= s.{end} THEN {n} ELSE {miss} END AS l"
        )

    def offline(part: str) -> str:
        return (
            f"SELECT s.terdisplayid, NULL, {flags('x.createddate', 'ust', 'uen', 'x.repeatedticket', '0')} FROM ss s "
            f"JOIN offline_{part} x ON x.terdisplayid = s.terdisplayid JOIN pd p ON x.createddate BETWEEN p.ulo AND p.uhi"
        )

    return oracle(
        f"""
pd AS (SELECT *, lo - INTERVAL 8 HOURS AS ulo, hi - INTERVAL 8 HOURS AS uhi FROM (SELECT previousperioddatetime AS lo,
  perioddatetime AS hi FROM calendar WHERE actualdate = DATE '{day}' ORDER BY 1 DESC, 2 DESC LIMIT 1)),
ss AS (SELECT *, st - INTERVAL 8 HOURS AS ust, en - INTERVAL 8 HOURS AS uen FROM (SELECT e.terdisplayid, min(e.sessionstartdatetime) AS st,
  max(e.sessionenddatetime) AS en, l.sweepindicator AS ind FROM session e JOIN terminal t ON t.terdisplayid = e.terdisplayid
  JOIN location l ON l.locid = t.locid JOIN pd p ON e.sessionstartdatetime BETWEEN p.lo AND p.hi GROUP BY 1, 4)),
ct AS (
  SELECT terdisplayid, d, f, l FROM (SELECT DISTINCT h.terdisplayid, h.createddate AS d, {flags('h.createddate', 'ust', 'uen')}, h.tranheaderid
    FROM ss s JOIN header h ON h.terdisplayid = s.terdisplayid JOIN pd p ON h.createddate BETWEEN p.ulo AND p.uhi
    JOIN header_state z ON z.tranheaderid = h.tranheaderid AND z.betstatetypeid = 'PB06'
    LEFT JOIN pool_line b ON b.tranheaderid = h.tranheaderid LEFT JOIN sweep_number n ON n.tranheaderid = h.tranheaderid
    LEFT JOIN sweep_line q ON q.tranlineitemid = n.tranlineitemid
    WHERE NOT h.isexchangeticket AND h.isbetrejectedbytrader = false AND coalesce(b.groupunitsequence, 1) = 1
    AND NOT coalesce(n.issoldout, false) AND (s.ind IS NULL OR q.isprinted IS NOT NULL))
  UNION ALL SELECT terdisplayid, d, f, l FROM (SELECT DISTINCT h.terdisplayid, h.createddate AS d, {flags('h.createddate', 'ust', 'uen')}, h.tranheaderid
    FROM ss s JOIN header h ON h.terdisplayid = s.terdisplayid JOIN pd p ON h.createddate BETWEEN p.ulo AND p.uhi
    JOIN header_state z ON z.tranheaderid = h.tranheaderid AND z.betstatetypeid = 'PB03'
    JOIN sweep_line q ON q.tranheaderid = h.tranheaderid JOIN sweep_number n ON n.tranlineitemid = q.tranlineitemid AND NOT n.issoldout
    WHERE h.isbetrejectedbytrader = false AND s.ind IS NOT NULL AND q.isprinted IS NULL)
  UNION ALL SELECT terdisplayid, NULL, f, l FROM (SELECT DISTINCT s.terdisplayid, c.cancelleddate, {flags('c.cancelleddate', 'st', 'en')}, h.tranheaderid
    FROM ss s JOIN cancelled c ON c.terdisplayid = s.terdisplayid JOIN pd p ON c.cancelleddate BETWEEN p.lo AND p.hi
    JOIN cancelled_state z ON z.tranheaderid = c.tranheaderid AND z.betstatetypeid = 'CB06' JOIN header h ON h.tranheaderid = c.tranheaderid
    LEFT JOIN pool_line b ON b.tranheaderid = c.tranheaderid WHERE h.isbetrejectedbytrader = false
    AND (b.groupunitsequence IS NULL OR c.cancelledamout <> 0))
  UNION ALL SELECT v.terdisplayid, NULL, v.f, v.l FROM (SELECT s.terdisplayid, v.winningamount, v.rebateamount, v.refundamount,
    {flags('v.validationdate', 'st', 'en')} FROM ss s JOIN validated v ON v.terdisplayid = s.terdisplayid
    JOIN validated_state z ON z.tranheaderid = v.tranheaderid AND z.betstatetypeid = 'VB06'
    JOIN pd p ON v.validationdate BETWEEN p.lo AND p.hi) v, LATERAL (VALUES (v.winningamount), (v.rebateamount), (v.refundamount)) u(x)
    WHERE coalesce(u.x, 0) <> 0
  UNION ALL SELECT terdisplayid, NULL, f, l FROM (SELECT DISTINCT s.terdisplayid, b.tranheaderid, b.createddate, {flags('b.createddate', 'ust', 'uen')}
    FROM ss s JOIN horse_line b ON b.terdisplayid = s.terdisplayid JOIN pd p ON b.createddate BETWEEN p.ulo AND p.uhi
    JOIN header_state z ON z.tranheaderid = b.tranheaderid AND z.betstatetypeid = 'PB06' WHERE b.boardrebateamount > 0)
  UNION ALL SELECT s.terdisplayid, NULL, {flags('o.transactiontime', 'st', 'en')} FROM ss s JOIN offline_voucher x ON x.terdisplayid = s.terdisplayid
    JOIN offline_header o ON o.transactionheaderid = x.headerid JOIN pd p ON o.transactiontime BETWEEN p.lo AND p.hi WHERE x.isactive
  UNION ALL {" UNION ALL ".join(offline(p) for p in ("charity", "spa", "topup", "festive"))}),
cc AS (SELECT terdisplayid, min(d) AS fd, max(d) AS ld, sum(f) AS f, sum(l) AS l FROM ct GROUP BY 1)
SELECT l.locname AS locationname, l.locdisplayid AS locationid, t.terdisplayid AS terminalid, o.opentime,
  strftime(s.st, '%d.%m.%Y') AS signondate, strftime(s.st, '%H:%M:%S') AS signontime,
  strftime(c.fd + INTERVAL 8 HOURS, '%H:%M:%S') AS firstsaletime, CAST(coalesce(c.f, 0) AS INT) AS firsthourcount, o.closetime,
  strftime(s.en, '%d.%m.%Y') AS signoffdate, strftime(s.en, '%H:%M:%S') AS signofftime,
  strftime(c.ld + INTERVAL 8 HOURS, '%H:%M:%S') AS lastsaletime, CAST(coalesce(c.l, 0) AS INT) AS lasthourcount
FROM terminal t LEFT JOIN operating_hours o ON o.locid = t.locid AND NOT o.isdeleted
  AND o.dayno = (SELECT extract(dow FROM CAST(lo AS DATE) - 1) + 1 FROM pd)
LEFT JOIN location l ON l.locid = t.locid AND NOT l.isdeleted LEFT JOIN ss s ON s.terdisplayid = t.terdisplayid
LEFT JOIN cc c ON c.terdisplayid = t.terdisplayid WHERE NOT t.isdeleted""",
        *HOURS_TABLES,
    )


def shop_ledger(day: str, day_text: str, next_day: str, period: str, rate: int) -> str:
    """Ledger lines of an invoice day, each total spelled out."""

    def cells(src: str, extra: str = "") -> str:
        return (
            "SELECT i.locid, i.locdisplayid, i.locname, i.loctypeid AS lt, i.isibg, i.isgst, q.prodname AS pn, q.flag, q.transtype AS ty, "
            "CASE WHEN q.flag IN ('FUN', 'REC') THEN max(q.amount) ELSE sum(q.amount) END * 100 AS x FROM "
            f"(SELECT terdisplayid, prodname, flag, amount, transtype FROM {src}{extra}) q JOIN iv_place i ON i.terdisplayid = q.terdisplayid GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9"
        )

    net = (
        " UNION ALL SELECT terdisplayid, CASE WHEN starts_with(prodname, 'PaynowQR') THEN 'PaynowQR' ELSE 'Paynow' END, 'CAS', "
        "sum(CASE WHEN transtype = 'TF' THEN -amount ELSE amount END), 'CL' FROM details WHERE flag = 'CAS' AND amount <> 0 "
        "AND starts_with(prodname, 'Paynow') GROUP BY 1, 2"
    )

    def s(cond: str, src: str = "lc") -> str:
        return f"(SELECT coalesce(sum(x), 0) FROM {src} WHERE {cond})"

    ret, br = "lt IN (2, 4)", "lt = 1"
    rows: list[tuple] = []

    def post(code, grp, doc, key, acct, text, gl, tax, base, cc, amount, product="", cust="''"):
        rows.append((code, grp, doc, key, acct, text, gl, tax, base, cc, amount, product, cust))

    den = 100 + rate

    def base_of(x: str) -> str:  # round(x * 100 / den, 2) on exact integers, x has two digits
        return (
            f"(CAST((2 * CAST({x} * 100 AS HUGEINT) * 100 + sign({x}) * {den}) AS HUGEINT) // {2 * den}) * 0.01"
        )

    code = 21
    acct = {("PaynowQR", ret): "24100060", ("Paynow", ret): "24100062", ("PaynowQR", br): "24100061", ("Paynow", br): "24100063"}
    for n, ((pn, at), a) in enumerate(acct.items()):
        fee = s(f"flag = 'CAS' AND pn = '{pn}' AND ty = 'TF' AND {at}")
        text = f"PAYNOW QR TXN {day_text} - UBT E-PYT BANK FEE" if pn == "PaynowQR" else f"PAYNOW TXN {day_text} - UBT PZ CLAIM BANK FEE"
        post(f"MCOL{code}", 10 + n, "Y5", "'01'", a, text, "12100000", "", "NULL", "", fee)
        post(f"MCOL{code + 1}", 10 + n, "Y5", "'50'", "", text, "41090007", "", "NULL", "2001200000", base_of(fee))
        post(f"MCOL{code + 2}", 10 + n, "Y5", "'50'", "", text, "22000000", "S3", base_of(fee), "", f"{fee} - {base_of(fee)}")
        code += 3
    for n, ((pn, at), a) in enumerate(acct.items()):
        sign = "" if pn == "PaynowQR" else "-"
        x = sign + s(f"flag = 'CAS' AND pn = '{pn}' AND ty = 'CL' AND {at}")
        text = f"GAMING INVOICE ON {day_text} {'RET' if at == ret else 'BR'}-{'PAYNOW QR' if pn == 'PaynowQR' else 'PAYNOW'}"
        k1, k2 = ("'11'", "'01'") if pn == "PaynowQR" else ("'01'", "'11'")
        post(f"MCOL{code}", 50 + n, "Y8", k1, "21100091" if at == ret else "23100000", text, "12100001" if at == ret else "12100003", "", "NULL", "", x)
        post(f"MCOL{code + 1}", 50 + n, "Y8", k2, "21100091" if at == ret else a, text, "12100000", "", "NULL", "", x)
        code += 2

    def area(g, product, names, pnames, prods, cash, gl_s, gl_t, gl_p, gl_b, sports):
        mine = f"pn IN ({names}) AND "
        on = "ty <> 'OO'"

        def tk(col, at):
            return f"(SELECT coalesce(sum({col}), 0) FROM tk WHERE prod IN ({prods}) AND {at})"

        def signed(x, pos, neg):
            return f"CASE WHEN {x} > 0 THEN '{pos}' ELSE '{neg}' END"

        for at, c0, own, gl0, off in ((ret, 1, "21100091", "12100001", 1), (br, 16, "23100000", gl_b, 2)):
            who = "RETAILERS" if at == ret else "BRANCHES"
            flags = "('CAN', 'PAY', 'RBT', 'SAL')" if at == ret else "('CAN', 'PAY', 'RBT')"
            inv = s(f"{mine}{at} AND ((flag IN ('COL', 'RFD') AND {on}) OR flag IN {flags})")
            post(f"MCOL{c0}", g + off, "Y8", signed(inv, "01", "11"), own, f"INVOICE FOR {who}", gl0, "", "NULL", "", f"abs({inv})", product)
            post(f"MCOL{c0 + 1}", g + off, "Y8", "'50'", "", f"SALES IN ADV FOR {who}", gl_s, "", "NULL", "", tk("s", at), product)
            tax = f"{tk('w', at)} - {tk('s', at)}"
            post(f"MCOL{c0 + 2}", g + off, "Y8", "'50'", "", f"GOOD & SERVICES TAX FOR {who}", gl_t, "XA" if sports else "",
                 tk("w", at) if sports else "NULL", "", tax, product)
            pay, rfd, rbt = (s(f"{mine}{at} AND flag = '{f}' AND {on}") for f in ("PAY", "RFD", "RBT"))
            if sports and at == ret:
                post("MCOL5", g + 1, "Y8", "'40'", "", "PRIZES PAID BY RETAILERS", gl_p, "", "NULL", "", f"-{pay}", product)
            if sports:
                post("MCOL6" if at == ret else "MCOL20", g + off, "Y8", "'40'", "", f"REDEMPTION COLLECTION-{who}", "21816001", "", "NULL", "", f"-{rfd}", product)
            else:
                post("MCOL5" if at == ret else "MCOL19", g + off, "Y8", "'40'", "", f"PRIZES PAID BY {who}", gl_p, "", "NULL", "", f"-{pay} - {rfd}", product)
                post("MCOL6" if at == ret else "MCOL20", g + off, "Y8", "'40'", "", f"REBATE FOR {who}", "21100211", "", "NULL", "", f"-{rbt}", product)
        gate = s(f"pn = 'Gate Admission' AND flag = 'COL' AND {br}")
        if not sports:
            post("MCOL21", g + 3, "Y8", signed(gate, "01", "11"), "23100000", "INVOICE FOR BRANCHES", "12100003", "", "NULL", "", f"abs({gate})", product)
        col = s(f"{mine}{br} AND flag = 'COL' AND {on}")
        out = s(f"{mine}{br} AND ((flag = 'RFD' AND {on}) OR flag IN ('PAY', 'CAN'{'' if sports else ', ' + chr(39) + 'RBT' + chr(39)}))")
        inst = {p: s(f"flag = 'CAS' AND pn = '{p}' AND ty = 'CL' AND {br}") for p in ("Paynow", "PaynowQR")}
        cin = f"({col} - {inst['PaynowQR']})" if sports else f"({col} + {gate})"
        cout = f"(-{out} + {inst['Paynow']})" if sports else f"(-{out})"
        for c, grp, key, a, text, gl, x in (
            ("MDEP1", 4, signed(cin, "40", "15"), "", "RECEIPTS", "10010001", cin),
            ("MDEP2", 4, signed(cin, "15", "40"), "23100000", "RECEIPTS", "12100003", cin),
            ("MDEP3", 5, signed(cout, "01", "50"), "23100000", "PAYMENTS", "12100003", cout),
            ("MDEP4", 5, signed(cout, "50", "01"), "", "PAYMENTS", "10010001", cout),
        ):
            post(c, g + grp, "YA", key, a, f"{cash}CASH {text}", gl, "", "NULL", "", f"abs({x})", product)
        pm = f"pn IN ({pnames}) AND {ret} AND "
        gst, sal = s(pm + "flag = 'GST'", "lp"), s(pm + "flag = 'SAL' AND isgst", "lp")
        text = "INPUT TAX ON SALES COMMISSION TO RETAILERS"
        post("MTAX1", g + 6, "Y5", "'11'", "21100091", text, "12100001", "", "NULL", "", f"-{gst}", product)
        post("MTAX2", g + 6, "Y5", "'40'", "", text, "22005000", "P3", f"-{sal}", "", f"-{gst}", product)
        which = "sp" if sports else "ho"
        neg = f"(SELECT coalesce(-sum(net), 0) FROM nt WHERE area = '{which}' AND isibg AND net < 0)"
        pos = f"(SELECT coalesce(sum(net), 0) FROM nt WHERE area = '{which}' AND isibg AND net > 0)"
        post("MDEP5", g + 7, "YA", "'01'", "21100091", "IBG PAYMENTS", "12100001", "", "NULL", "", neg, product)
        post("MDEP6", g + 7, "YA", "'50'", "", "IBG PAYMENTS", "11003010", "", "NULL", "", neg, product)
        post("MDEP7", g + 8, "YA", "'40'", "", "IBG RECEIPTS", "11003060", "", "NULL", "", pos, product)
        post("MDEP8", g + 8, "YA", "'15'", "21100091", "IBG RECEIPTS", "12100001", "", "NULL", "", pos, product)

    area(100, "SPORTS", "'SPORTS', 'Offline Orders'", "'SPORTS', 'Offline Orders'", "5, 6", "", "21814004", "22000011", "5020218150", "12100001", True)
    area(200, "HORSE RACING", "'HORSE RACING', 'Gate Admission'", "'HORSE RACING'", "1", "HR ", "21814009", "22000013", "21815016", "12100003", False)
    static = " UNION ALL ".join(
        f"SELECT '{c}' AS code, {g} AS grp, CAST(1 AS BIGINT) AS n, '{d}' AS doc, {k} AS pk, '{a}' AS acct, '{t}' AS txt, '{gl}' AS gl, '{tax}' AS tax, "
        f"CAST({b} AS DECIMAL(22,2)) AS base, '{cc}' AS cc, CAST({x} AS DECIMAL(22,2)) AS x, '{p}' AS product, {cu} AS cust"
        for c, g, d, k, a, t, gl, tax, b, cc, x, p, cu in rows
    )

    def comm(g, names):
        return (
            f"SELECT 'MCOL4', {g}, 1, 'Y8', '40', '', 'SALES COMMISSION FOR RETAILERS', '50200010', '', NULL, '', CAST(-sum(x) AS DECIMAL(22,2)), pn, "
            f"locdisplayid FROM lc WHERE lt IN (2, 4) AND flag = 'SAL' AND pn IN ({names}) AND x <> 0 GROUP BY pn, locdisplayid"
        )

    gates = "(SELECT locdisplayid, sum(x) AS x FROM lc WHERE lt = 1 AND flag = 'COL' AND pn = 'Gate Admission' GROUP BY 1)"
    gtext = f"'GATEADMISSION {day_text}-RET NO-' || locdisplayid"

    def manual(g, which, product):
        return f"""SELECT CASE WHEN net >= 0 THEN CASE c WHEN 1 THEN 'MPYT1' ELSE 'MPYT2' END ELSE CASE c WHEN 1 THEN 'MPYT3' ELSE 'MPYT4' END END,
  {g}, seq, 'Y6', CASE WHEN (net >= 0) = (c = 1) THEN '11' ELSE '01' END, CASE c WHEN 1 THEN '21100091' ELSE locdisplayid END,
  left('MANUAL PAYMENT ENDED {day_text}-' || CASE c WHEN 1 THEN 'NON IBG RETAILERS' ELSE locname END, 50), '12100001', '', NULL, '',
  CAST(abs(net) AS DECIMAL(22,2)), '{product}', '' FROM (SELECT *, row_number() OVER (ORDER BY locid, locname) AS seq FROM nt WHERE area = '{which}' AND isibg = false)
  CROSS JOIN (VALUES (1), (2)) v(c) WHERE net <> 0"""

    tabs = list(dict.fromkeys([*DETAIL_TABLES, *AMOUNT_TABLES, "chain"]))
    return oracle(
        f"""{windows(day, day)}, {windows(period, day, 'winp')}, {amounts_cte()}, {details_cte(start=day)},
{details_cte('winp', 'detailsp', period, 'tp')},
iv_place AS (SELECT t.terdisplayid, l.* FROM terminal t JOIN location l ON l.locid = t.locid),
lc AS ({cells('details', net)}), lp AS ({cells('detailsp')}),
tk AS (SELECT h.terdisplayid, CASE h.prodid WHEN 1 THEN 1 ELSE 5 END AS prod, i.loctypeid AS lt,
  trunc(sum(CASE WHEN h.iscancelled THEN 0 ELSE coalesce(a.wager, 0) END)) AS w, trunc(sum(CASE WHEN h.iscancelled THEN 0 ELSE coalesce(a.sales, 0) END)) AS s
  FROM amounts a JOIN header h ON h.ticketserialnumber = a.ticketserialnumber JOIN iv_place i ON i.terdisplayid = h.terdisplayid
  WHERE h.prodid IN (1, 5, 6) GROUP BY 1, 2, 3),
nt AS (SELECT v.area, q.locid, q.locdisplayid, q.locname, q.isibg, coalesce(sum(CASE WHEN list_contains(v.names, q.pn) AND
  ((q.flag IN ('COL', 'CAN', 'PAY', 'RFD', 'RBT') AND q.ty <> 'OO') OR q.flag IN ('SAL', 'GST')) THEN q.x END), 0) AS net
  FROM lp q CROSS JOIN (VALUES ('sp', ['SPORTS', 'Offline Orders']), ('ho', ['HORSE RACING'])) v(area, names) WHERE q.lt IN (2, 4) GROUP BY 1, 2, 3, 4, 5),
ln AS (SELECT * FROM ({static}) WHERE x <> 0
  UNION ALL {comm(101, "'SPORTS', 'Offline Orders'")} UNION ALL {comm(201, "'HORSE RACING', 'Gate Admission'")}
  UNION ALL SELECT 'MCOL23', 203, 1, 'Y8', '50', '', {gtext}, '22000000', 'S3', CAST({base_of('x')} AS DECIMAL(22,2)), '',
    CAST(x - {base_of('x')} AS DECIMAL(22,2)), 'HORSE RACING', '' FROM {gates} WHERE x - {base_of('x')} <> 0
  UNION ALL SELECT 'MCOL22', 203, 1, 'Y8', '50', '', {gtext}, '41090020', '', NULL, '', CAST({base_of('x')} AS DECIMAL(22,2)), 'HORSE RACING', locdisplayid
    FROM {gates} WHERE {base_of('x')} <> 0
  UNION ALL {manual(109, 'sp', 'SPORTS')} UNION ALL {manual(209, 'ho', 'HORSE RACING')}),
st AS (SELECT grp, coalesce(sum(max(n)) OVER (ORDER BY grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ln GROUP BY grp)
SELECT repeat('0', 12) AS idmmbusinessday, DATE '{day}' AS businessdate, repeat('0', 12) AS itemid,
  lpad(CAST(CAST(s.ahead + l.n AS BIGINT) AS VARCHAR), 12, '0') AS transactionid, DATE '{next_day}' AS documentdate, l.code AS linecode,
  l.doc AS sapdoctype, l.pk AS sappostingkey, l.acct AS sapcontrolacctcode, l.txt AS linetext, l.gl AS glnumber, l.tax AS saptaxcode,
  CAST(coalesce(trunc(l.base), 0) AS BIGINT) AS saptaxbaseamount, l.cc AS cccode, '' AS sapassignment, 'SGD' AS currencycode, l.x AS amount,
  l.product, '' AS drawnumber, l.cust AS customer FROM ln l JOIN st s ON s.grp = l.grp""",
        *tabs,
    )


INTERVAL_TABLES = [
    "period_history", "header", "header_state", "validated", "validated_state", "cancelled", "cancelled_state",
    "horse_line", "fourd_line", "fourd_number", "pool_line", "pool_number", "sweep_line", "sweep_number", "sports_line",
    "sports_number", "draw", "sport_event", "sport_type", "sport_class", "sport_category", "sport_league", "terminal",
    "location",
]


def ledger_file(day: str, day_text: str, next_day: str, period: str, rate: int) -> str:
    """The 238 characters of every ledger line."""

    def text(column: str, width: int) -> str:
        return f"rpad(coalesce({column}, ''), {width}, ' ')"

    cents = "CAST(round(amount, 0) AS DECIMAL(20,0))"
    parts = [
        "lpad(idmmbusinessday, 12, '0')", "strftime(businessdate, '%d%m%Y')", "lpad(itemid, 12, '0')",
        "lpad(transactionid, 12, '0')", "strftime(documentdate, '%d%m%Y')", text("linecode", 12), text("sapdoctype", 2),
        text("sappostingkey", 2), text("sapcontrolacctcode", 15), text("linetext", 50), text("glnumber", 10),
        "repeat(' ', 31)", text("currencycode", 3),
        f"CASE WHEN {cents} < 0 THEN '-' || lpad(CAST(-{cents} AS VARCHAR), 14, '0') ELSE lpad(CAST({cents} AS VARCHAR), 15, '0') END",
        text("product", 18), text("drawnumber", 18), text("customer", 10),
    ]
    return f"SELECT {' || '.join(parts)} AS value FROM ({shop_ledger(day, day_text, next_day, period, rate)})"


def interval_transactions(start: str, end: str) -> str:
    day = start[:10]
    inside = "CASE WHEN k.tot IN (1, 4, 6) THEN {c} BETWEEN iv.ulo AND iv.uhi ELSE k.tot IN (3, 5) END"

    def scope(alias: str) -> str:
        return inside.format(c=f"{alias}.createddate")

    entry = "CASE upper({c}) WHEN 'MANUAL' THEN 0 WHEN 'BETSLIP' THEN 2 WHEN 'EDIT' THEN 10 WHEN 'EBETSLIP' THEN 16 END"
    attrs = "k.tk, k.hd, k.entry, k.dev, k.prod, k.rej, k.exch, k.ter"
    side = (
        "CASE WHEN coalesce(n.bigbetacceptedwager, 0) > 0 THEN CASE WHEN coalesce(n.smallbetacceptedwager, 0) > 0 THEN 2 ELSE 0 END "
        "WHEN coalesce(n.smallbetacceptedwager, 0) > 0 THEN 1 END"
    )
    step = "CASE b.permutation WHEN 24 THEN 0 WHEN 12 THEN 1 WHEN 4 THEN 2 WHEN 6 THEN 3 END"
    roll = "CASE WHEN instr(n.selectedbetnumber, 'R') BETWEEN 1 AND 3 THEN instr(n.selectedbetnumber, 'R') - 1 ELSE 3 END"
    four = (
        f"CASE b.bettypeid WHEN 'ORD' THEN {side} * 5 WHEN 'SYS' THEN 1 + {side} * 5 + {step} "
        f"WHEN 'IBET' THEN 27 + {side} * 4 + {step} WHEN 'ROLL' THEN 15 + {side} * 4 + {roll} END"
    )
    pool_code = (
        "CASE b.bettypeid WHEN 'ORD' THEN '0' WHEN 'SYSR' THEN '1' WHEN 'SYS7' THEN '2' WHEN 'SYS8' THEN '3' WHEN 'SYS9' THEN '4' "
        "WHEN 'SYS10' THEN '5' WHEN 'SYS11' THEN '6' WHEN 'SYS12' THEN '7' WHEN 'M 4' THEN '16' WHEN 'M 3' THEN '17' WHEN 'M 2' THEN '18' WHEN 'M AN' THEN '19' END"
    )
    simple = (
        "CASE b.bettypeid WHEN 'SYSR' THEN 44 WHEN 'SYS7' THEN 7 WHEN 'SYS8' THEN 28 WHEN 'SYS9' THEN 84 WHEN 'SYS10' THEN 210 "
        "WHEN 'SYS11' THEN 462 WHEN 'SYS12' THEN 924 ELSE 1 END"
    )
    staked = "coalesce(n.bigbetacceptedwager, 0) + coalesce(n.smallbetacceptedwager, 0) > 0"
    sweep_rule = (
        "((s.betstatetypeid = 'PB06' AND (b.isprinted IS NOT NULL OR l.sweepindicator IS NULL)) OR "
        "(s.betstatetypeid = 'PB03' AND b.isprinted IS NULL AND l.sweepindicator IS NOT NULL))"
    )
    sweep_from = (
        "FROM tk k CROSS JOIN iv JOIN sweep_line b ON b.tranheaderid = k.hd JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout "
        "JOIN header_state s ON s.tranheaderid = k.hd JOIN terminal t ON t.terdisplayid = k.ter JOIN location l ON l.locid = t.locid "
        f"WHERE k.prod = 4 AND {sweep_rule} AND {scope('n')}"
    )

    def biz(h: str) -> str:
        return (
            f"CASE WHEN t.at < w.{h}_lo THEN CAST(w.{h}_lo AS DATE) - 1 WHEN t.at > w.{h}_hi THEN CAST(w.{h}_lo AS DATE) + 1 "
            f"ELSE CAST(w.{h}_lo AS DATE) END"
        )

    code = "CASE t.prod WHEN 1 THEN 7 WHEN 2 THEN 9 WHEN 3 THEN 23 WHEN 4 THEN 11 ELSE 20 END"
    ret = "CASE WHEN t.ty = 3 THEN a.ret ELSE 0 END"
    mode = "CASE WHEN t.ty = 3 AND coalesce(a.ret, 0) > 0 THEN 'CA' ELSE '' END"
    money = (
        "CAST(coalesce(a.w1, 0) AS DECIMAL(22,2)), CAST(coalesce(a.w2, 0) AS DECIMAL(22,2)), CAST(coalesce(a.s1, 0) AS DECIMAL(22,11)), "
        "CAST(coalesce(a.s2, 0) AS DECIMAL(22,11)), CAST(coalesce(a.c1, 0) AS DECIMAL(22,11)), CAST(coalesce(a.c2, 0) AS DECIMAL(22,11)), "
        "CAST(coalesce(a.g1, 0) AS DECIMAL(22,11)), CAST(coalesce(a.g2, 0) AS DECIMAL(22,11))"
    )
    names = (
        "uuid, tranheaderid, transactiontype, productid, bettypeid, selection, businessdate, transactiontimestamp, terminalid, userid, locationid, "
        "boardseqnumber, entrymethod, numboards, numdraws, drawid, ebetslipinfo_mobnbr, numsimplebets, qpflag, nummarks, bulkid, itoto_numparts, "
        "itoto_totalparts, grptoto_numparts, eventid, leaguecode, liveindicator, eventname, market, odds, matchkickoff, wager1, wager2, sales1, sales2, "
        "salescomm1, salescomm2, gst1, gst2, returnamount, winningamount, paymentmode, cartid, betlinerebateamount"
    )
    m2 = "DECIMAL(22,2)"
    return oracle(
        f"""{windows(day, day)},
iv AS (SELECT TIMESTAMP '{start}' AS lo, TIMESTAMP '{end}' AS hi, TIMESTAMP '{start}' - INTERVAL 8 HOURS AS ulo, TIMESTAMP '{end}' - INTERVAL 8 HOURS AS uhi),
ev AS (SELECT h.ticketserialnumber AS tk, h.tranheaderid AS hd, h.entrymethodid AS entry, h.deviceid AS dev, h.prodid AS prod, h.isbetrejectedbytrader AS rej,
    h.isexchangeticket AS exch, h.terdisplayid AS ter, h.createddate AS cr, h.requestid AS req, h.userdisplayid AS usr, h.cartid AS cart, 1 AS kind
    FROM header h JOIN iv ON h.createddate BETWEEN iv.ulo AND iv.uhi JOIN header_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'PB06'
  UNION SELECT v.ticketserialnumber, v.tranheaderid, h.entrymethodid, h.deviceid, h.prodid, h.isbetrejectedbytrader, h.isexchangeticket, h.terdisplayid,
    h.createddate, h.requestid, v.userdisplayid, v.cartid, 3 FROM validated v JOIN iv ON v.createdvalidationdate BETWEEN iv.ulo AND iv.uhi
    JOIN header h ON h.ticketserialnumber = v.ticketserialnumber JOIN validated_state s ON s.tranheaderid = v.tranheaderid AND s.betstatetypeid = 'VB06'
    WHERE v.validationtypeid IN ('VALD', 'RFND')
  UNION SELECT c.ticketserialnumber, c.tranheaderid, h.entrymethodid, h.deviceid, h.prodid, h.isbetrejectedbytrader, h.isexchangeticket, h.terdisplayid,
    h.createddate, h.requestid, c.userdisplayid, c.cartid, 5 FROM cancelled c JOIN iv ON c.cancelleddate BETWEEN iv.lo AND iv.hi
    JOIN header h ON h.ticketserialnumber = c.ticketserialnumber AND h.isbetrejectedbytrader = false
    JOIN cancelled_state s ON s.tranheaderid = h.tranheaderid AND s.betstatetypeid = 'CB06'),
tk AS (SELECT tk, hd, entry, dev, prod, rej, exch, ter, sum(kind) AS tot FROM ev GROUP BY ALL),
bt AS (SELECT k.tk, b.tranlineitemid AS li, CAST({four} AS VARCHAR) AS code FROM tk k CROSS JOIN iv JOIN fourd_line b ON b.tranheaderid = k.hd
    JOIN fourd_number n ON n.tranlineitemid = b.tranlineitemid WHERE k.prod = 2 AND {staked} AND {scope('n')}
  UNION ALL SELECT k.tk, b.tranlineitemid, {pool_code} FROM tk k CROSS JOIN iv JOIN pool_line b ON b.tranheaderid = k.hd WHERE k.prod = 3 AND {scope('b')}
  UNION ALL SELECT k.tk, n.tranlineitemid, '0' FROM tk k CROSS JOIN iv JOIN sweep_number n ON n.tranheaderid = k.hd AND NOT n.issoldout WHERE k.prod = 4 AND {scope('n')}
  UNION ALL SELECT tk, li, CASE WHEN cat = 2 THEN 'S' ELSE CASE acc WHEN 'ACC4' THEN '4F' WHEN 'DBL' THEN 'D' WHEN 'SGL' THEN 'S' WHEN 'TBL' THEN 'T' END END FROM (
    SELECT DISTINCT k.tk, n.tranlineitemid AS li, g.categoryid AS cat, b.accumulatorid AS acc FROM tk k JOIN sports_line b ON b.tranheaderid = k.hd
    JOIN sports_number n ON n.tranlineitemid = b.tranlineitemid JOIN sport_event e ON e.eventid = n.eventid JOIN sport_type y ON y.typeid = e.typeid
    JOIN sport_class c ON c.classid = y.classid JOIN sport_category g ON g.categoryid = c.categoryid
    WHERE g.categoryid = 1 OR (g.categoryid = 2 AND k.prod IN (5, 6)))),
hd AS (SELECT tk, entry, sum(x) AS reb FROM (SELECT k.tk, k.hd, k.entry, CASE b.bettypeid WHEN 'W-P' THEN max(coalesce(b.boardrebateamount, 0))
    ELSE sum(coalesce(b.boardrebateamount, 0)) END AS x FROM tk k CROSS JOIN iv JOIN horse_line b ON b.tranheaderid = k.hd
    WHERE k.prod = 1 AND {scope('b')} GROUP BY k.tk, k.hd, b.bettypeid, b.boardrebateamount, k.entry) GROUP BY 1, 2),
nb AS (SELECT k.tk, count(n.tranlineitemid) AS n, NULL AS bulk FROM tk k CROSS JOIN iv JOIN fourd_number n ON n.tranheaderid = k.hd
    WHERE k.prod = 2 AND {staked} AND {scope('n')} GROUP BY 1
  UNION ALL SELECT k.tk, count(b.tranlineitemid), NULL FROM tk k CROSS JOIN iv JOIN pool_line b ON b.tranheaderid = k.hd WHERE k.prod = 3 AND {scope('b')} GROUP BY 1
  UNION ALL SELECT k.tk, count(n.tranlineitemid), b.bulkid FROM tk k CROSS JOIN iv JOIN sweep_line b ON b.tranheaderid = k.hd
    JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout WHERE k.prod = 4 AND {scope('n')} GROUP BY 1, 3),
nd AS (SELECT k.tk, count(*) AS n, string_agg(CAST(d.hostdrawdatesid AS VARCHAR), ',' ORDER BY d.hostdrawdatesid) AS ids FROM tk k
    JOIN draw d ON d.tranheaderid = k.hd WHERE k.prod IN (2, 3, 4) GROUP BY 1),
sq AS (SELECT n.tranlineitemid AS li, max(n.sequence) AS seq FROM pool_number n GROUP BY 1),
gp AS (SELECT grouphostid, max(groupunitsequence) AS units FROM pool_line WHERE grouphostid IN (SELECT b.grouphostid FROM tk k JOIN pool_line b ON b.tranheaderid = k.hd
    WHERE k.prod = 3 AND b.grouphostid <> '00000000-0000-0000-0000-000000000000' AND b.groupunitsequence IS NOT NULL) GROUP BY 1),
lb AS (SELECT {attrs}, k.tot, b.tranlineitemid AS li, CASE WHEN coalesce(b.permutation, 0) = 0 THEN 1 ELSE b.permutation END AS simp,
    CAST(b.quickpickindicator AS INT) AS qp, 4 AS marks, NULL AS p1, NULL AS p2, NULL AS p3 FROM tk k CROSS JOIN iv JOIN fourd_line b ON b.tranheaderid = k.hd
    JOIN fourd_number n ON n.tranlineitemid = b.tranlineitemid WHERE k.prod = 2 AND {staked} AND {scope('n')}
  UNION ALL SELECT {attrs}, k.tot, b.tranlineitemid, {simple}, CAST(b.quickpickindicator AS INT), q.seq, CAST(b.units AS VARCHAR),
    CAST(b.syndicatepartsallowed AS VARCHAR), CAST(g.units AS VARCHAR) FROM tk k CROSS JOIN iv JOIN pool_line b ON b.tranheaderid = k.hd
    JOIN sq q ON q.li = b.tranlineitemid LEFT JOIN gp g ON g.grouphostid = b.grouphostid WHERE k.prod = 3 AND {scope('b')}
  UNION ALL SELECT {attrs}, k.tot, b.tranlineitemid, 1, CAST(b.quickpickindicator AS INT), length(CAST(b.userselectednumber AS VARCHAR)), NULL, NULL, NULL
    FROM tk k CROSS JOIN iv JOIN sweep_line b ON b.tranheaderid = k.hd JOIN sweep_number n ON n.tranlineitemid = b.tranlineitemid AND NOT n.issoldout
    WHERE k.prod = 4 AND {scope('n')}),
ld AS (SELECT l.*, nb.n AS boards, nb.bulk, nd.n AS draws, nd.ids, row_number() OVER (PARTITION BY l.tk, l.tot IN (1, 4, 6)
    ORDER BY l.li, l.hd, nb.bulk NULLS FIRST, l.entry, l.dev, l.tot) AS board FROM lb l JOIN nb ON nb.tk = l.tk JOIN nd ON nd.tk = l.tk),
li AS (SELECT DISTINCT tk, live FROM (SELECT k.tk, row_number() OVER (PARTITION BY n.tranheaderid ORDER BY n.tranlineitemid) AS r,
    CASE WHEN e.hasbetinrun AND n.createddate BETWEEN e.starttime AND e.suspendtime THEN 'Y' ELSE 'N' END AS live FROM tk k
    JOIN sports_number n ON n.tranheaderid = k.hd JOIN sport_event e ON e.eventid = n.eventid WHERE k.prod IN (5, 6)) WHERE r = 1),
sd AS (SELECT DISTINCT k.tk, n.tranlineitemid AS li, k.entry, n.eventid, g.leaguecode, l.live, n.eventname, n.bettypename, n.selectionname, n.selectionodds,
    strftime(e.starttime, '%Y%m%d %H%M%S') AS ko, bt.code FROM tk k JOIN sports_number n ON n.tranheaderid = k.hd JOIN sport_event e ON e.eventid = n.eventid
    JOIN sport_type y ON y.typeid = e.typeid JOIN sport_league g ON replace(g.name, '|', '') = replace(y.name, '|', '') JOIN li l ON l.tk = k.tk
    JOIN bt ON bt.li = n.tranlineitemid WHERE k.prod IN (5, 6)),
tl AS (SELECT t.terdisplayid, l.locdisplayid FROM terminal t LEFT JOIN location l ON l.locid = t.locid),
ve AS (SELECT v.*, p.* FROM validated v JOIN iv ON v.createdvalidationdate BETWEEN iv.ulo AND iv.uhi JOIN ev p ON p.tk = v.ticketserialnumber AND p.kind = 3),
tr AS (SELECT p.entry, p.prod, p.rej, p.tk, p.req AS uuid, 1 AS ty, p.cr + INTERVAL 8 HOURS AS at, p.ter, p.usr, l.locdisplayid AS loc, p.cart, p.hd
    FROM ev p JOIN tl l ON l.terdisplayid = p.ter WHERE p.kind = 1
  UNION ALL SELECT v.entry, v.prod, v.rej, v.ticketserialnumber, CASE WHEN v.prod IN (2, 3, 4) THEN v.requestid ELSE v.req END, 3, v.validationdate, v.terdisplayid,
    v.userdisplayid, l.locdisplayid, v.cartid, v.tranheaderid FROM ve v JOIN tl l ON l.terdisplayid = v.ter
    WHERE (v.prod = 1 AND (coalesce(v.winningamount, 0) > 0 OR coalesce(v.rebatereclaim, 0) > 0))
    OR (v.prod <> 1 AND coalesce(v.winningamount, 0) > 0 AND v.validationtypeid = 'VALD')
  UNION ALL SELECT v.entry, v.prod, v.rej, v.ticketserialnumber, v.req, 61, v.validationdate, v.terdisplayid, v.userdisplayid, l.locdisplayid, v.cartid, v.tranheaderid
    FROM ve v JOIN tl l ON l.terdisplayid = v.ter WHERE v.prod IN (5, 6) AND v.validationtypeid = 'RFND'
  UNION ALL SELECT p.entry, p.prod, p.rej, c.ticketserialnumber, CASE WHEN p.prod IN (2, 3, 4) THEN c.requestid ELSE p.req END, 2, c.cancelleddate, c.terdisplayid,
    c.userdisplayid, l.locdisplayid, c.cartid, c.tranheaderid FROM cancelled c JOIN iv ON c.cancelleddate BETWEEN iv.lo AND iv.hi
    JOIN ev p ON p.tk = c.ticketserialnumber AND p.kind = 5 JOIN tl l ON l.terdisplayid = p.ter),
rw AS (SELECT 1 AS prod, tk, NULL AS li, sum(x) AS w1, 0 AS w2 FROM (SELECT k.tk, k.hd, CASE b.bettypeid WHEN 'W-P' THEN max(coalesce(b.betpriceamount, 0))
    ELSE sum(coalesce(b.betpriceamount, 0)) END AS x FROM tk k CROSS JOIN iv JOIN horse_line b ON b.tranheaderid = k.hd WHERE k.prod = 1 AND {scope('b')}
    GROUP BY k.tk, k.hd, b.bettypeid, b.betpriceamount) GROUP BY tk
  UNION ALL SELECT 2, k.tk, n.tranlineitemid, sum(coalesce(n.bigbetacceptedwager, 0)), sum(coalesce(n.smallbetacceptedwager, 0)) FROM tk k CROSS JOIN iv
    JOIN fourd_number n ON n.tranheaderid = k.hd JOIN draw d ON d.tranheaderid = n.tranheaderid WHERE k.prod = 2 AND NOT k.exch AND {scope('n')} GROUP BY 2, 3
  UNION ALL SELECT 3, k.tk, b.tranlineitemid, sum(coalesce(b.betpriceamount, 0)), 0 FROM tk k CROSS JOIN iv JOIN pool_line b ON b.tranheaderid = k.hd
    WHERE k.prod = 3 AND NOT k.exch AND {scope('b')} GROUP BY 2, 3
  UNION ALL SELECT 4, k.tk, n.tranlineitemid, sum(coalesce(n.betpriceamount, 0)), 0 {sweep_from} GROUP BY 2, 3
  UNION ALL SELECT prod, tk, NULL, sum(coalesce(betamount, 0)), 0 FROM (SELECT DISTINCT k.prod, k.hd, b.sourcesystemtransactionid, b.issinglebet, b.accumulatorid,
    b.betamount, k.tk FROM tk k JOIN sports_line b ON b.tranheaderid = k.hd WHERE k.prod IN (5, 6) AND k.rej = false) GROUP BY 1, 2),
sc AS (SELECT tk, li, sum(s1) AS s1, sum(s2) AS s2, sum(c1) AS c1, sum(c2) AS c2 FROM (
    SELECT k.tk, b.tranlineitemid AS li, sum(coalesce(b.salesfactoramount, 0)) AS s1, 0 AS s2, sum(coalesce(b.salescommamount, 0)) AS c1, 0 AS c2 FROM tk k CROSS JOIN iv
      JOIN pool_line b ON b.tranheaderid = k.hd WHERE k.prod = 3 AND NOT k.exch AND {scope('b')} GROUP BY 1, 2
    UNION ALL SELECT tk, NULL, sum(s), 0, sum(c), 0 FROM (SELECT k.tk, k.hd, CASE b.bettypeid WHEN 'W-P' THEN max(coalesce(b.salesfactoramount, 0)) ELSE
      sum(coalesce(b.salesfactoramount, 0)) END AS s, CASE b.bettypeid WHEN 'W-P' THEN max(coalesce(b.salescommamount, 0)) ELSE sum(coalesce(b.salescommamount, 0)) END AS c
      FROM tk k CROSS JOIN iv JOIN horse_line b ON b.tranheaderid = k.hd JOIN terminal t ON t.terdisplayid = k.ter WHERE k.prod = 1 AND {scope('b')}
      GROUP BY k.tk, k.hd, CAST(b.createddate AS DATE), b.bettypeid, b.salescommamount, b.salesfactoramount) GROUP BY tk
    UNION ALL SELECT k.tk, n.tranlineitemid, sum(coalesce(n.salesfactoramountbig, 0)), sum(coalesce(n.salesfactoramountsmall, 0)), sum(coalesce(n.salescommamountbig, 0)),
      sum(coalesce(n.salescommamountsmall, 0)) FROM tk k CROSS JOIN iv JOIN fourd_number n ON n.tranheaderid = k.hd JOIN draw d ON d.tranheaderid = k.hd
      WHERE k.prod = 2 AND NOT k.exch AND {scope('n')} GROUP BY 1, 2
    UNION ALL SELECT k.tk, n.tranlineitemid, sum(coalesce(n.salesfactoramount, 0)), 0, sum(coalesce(n.salescommamount, 0)), 0 {sweep_from} GROUP BY 1, 2
    UNION ALL SELECT tk, NULL, sum(coalesce(salesfactoramount, 0)), 0, sum(coalesce(salescommamount, 0)), 0 FROM (SELECT DISTINCT k.prod, k.hd,
      b.sourcesystemtransactionid, b.issinglebet, b.accumulatorid, b.salescommamount, k.tk, CAST(b.createddate AS DATE) AS d, b.salesfactoramount
      FROM tk k JOIN sports_line b ON b.tranheaderid = k.hd WHERE k.prod IN (5, 6) AND k.rej = false) GROUP BY 1) GROUP BY 1, 2),
gs AS (SELECT w.tk, w.li, round(w.w1 - s.s1, 2) AS g1, round(w.w2 - s.s2, 2) AS g2 FROM rw w JOIN tk k ON k.tk = w.tk JOIN sc s ON s.tk = w.tk AND s.li = w.li
    WHERE w.prod IN (2, 3, 4)
  UNION ALL SELECT w.tk, w.li, round(w.w1 - s.s1, 2), round(w.w2 - s.s2, 2) FROM rw w JOIN tk k ON k.tk = w.tk JOIN sc s ON s.tk = w.tk WHERE w.prod IN (1, 5, 6)),
rv AS (SELECT tk, win AS ret, refundamount AS rf, rebatereclaim AS rc, CASE WHEN coalesce(win, 0) > 0 THEN
    CAST(CAST(sign(num) AS INT) * ((2 * abs(num) + n) // (2 * n)) * 0.01 AS {m2}) ELSE 0 END AS win FROM (
    SELECT v.ticketserialnumber AS tk, v.winningamount AS win, v.refundamount, v.rebatereclaim, count(*) AS n,
    CAST((v.winningamount * count(*) - CAST(sum(w.w1) AS DECIMAL(24,2)) - CAST(sum(w.w2) AS DECIMAL(24,2))) * 100 AS HUGEINT) AS num
    FROM rw w JOIN validated v ON v.ticketserialnumber = w.tk
    JOIN validated_state s ON s.tranheaderid = v.tranheaderid AND s.betstatetypeid = 'VB06' WHERE v.validationtypeid IN ('VALD', 'RFND') GROUP BY 1, 2, 3, 4)),
xe AS (SELECT v.ticketserialnumber AS tk, b.tranlineitemid AS li, v.winningamount AS win, v.refundamount AS rf, v.rebatereclaim AS rc FROM validated v
    JOIN (SELECT 2 AS p, tranheaderid, tranlineitemid FROM fourd_line UNION ALL SELECT 3, tranheaderid, tranlineitemid FROM pool_line
      UNION ALL SELECT 4, tranheaderid, tranlineitemid FROM sweep_line) b ON b.tranheaderid = v.tranheaderid AND b.p = v.prodid
    JOIN validated_state s ON s.tranheaderid = v.tranheaderid AND s.betstatetypeid = 'VB06' JOIN tk k ON k.hd = v.tranheaderid AND k.exch),
am AS (SELECT w.tk, w.li, sum(w.w1) AS w1, sum(w.w2) AS w2, sum(s.s1) AS s1, sum(s.s2) AS s2, sum(s.c1) AS c1, sum(s.c2) AS c2, sum(g.g1) AS g1, sum(g.g2) AS g2,
    max(v.ret) AS ret, max(v.win) AS win, max(v.rf) AS rf, max(v.rc) AS rc FROM rw w LEFT JOIN sc s ON s.tk = w.tk AND s.li = w.li
    LEFT JOIN gs g ON g.tk = w.tk AND g.li = w.li LEFT JOIN rv v ON v.tk = w.tk WHERE w.prod IN (2, 3, 4) GROUP BY 1, 2
  UNION ALL SELECT w.tk, NULL, sum(w.w1), sum(w.w2), sum(s.s1), sum(s.s2), sum(s.c1), sum(s.c2), sum(g.g1), sum(g.g2), max(v.ret), max(v.win), max(v.rf), max(v.rc)
    FROM rw w LEFT JOIN sc s ON s.tk = w.tk LEFT JOIN gs g ON g.tk = w.tk LEFT JOIN rv v ON v.tk = w.tk WHERE w.prod IN (1, 5, 6) GROUP BY 1
  UNION ALL SELECT tk, li, 0, 0, 0, 0, 0, 0, 0, 0, win, win, rf, rc FROM xe),
se AS (SELECT k.tk, NULL AS li, string_agg(b.betlineannotation, ',' ORDER BY b.betlineannotation DESC) AS txt FROM tk k CROSS JOIN iv JOIN horse_line b ON b.tranheaderid = k.hd
    WHERE k.prod = 1 AND {scope('b')} GROUP BY k.tk, k.hd
  UNION ALL SELECT k.tk, n.tranlineitemid, left(n.selectedbetnumber, 10) FROM tk k CROSS JOIN iv JOIN fourd_number n ON n.tranheaderid = k.hd WHERE k.prod = 2 AND {scope('n')}
  UNION ALL SELECT k.tk, b.tranlineitemid, string_agg(CAST(p.singlebetnumber AS VARCHAR), ' ' ORDER BY p.singlebetnumber DESC) FROM tk k CROSS JOIN iv
    JOIN pool_line b ON b.tranheaderid = k.hd JOIN pool_number p ON p.tranlineitemid = b.tranlineitemid WHERE k.prod = 3 AND {scope('b')} GROUP BY 1, 2
  UNION ALL SELECT k.tk, n.tranlineitemid, string_agg(left(n.selectednumber, 10), ' ' ORDER BY n.selectednumber DESC) FROM tk k CROSS JOIN iv
    JOIN sweep_number n ON n.tranheaderid = k.hd WHERE k.prod = 4 AND {scope('n')} GROUP BY 1, 2),
fin({names}) AS (
  SELECT t.uuid, t.hd, t.ty, {code}, b.code, x.txt, {biz('lot')}, date_trunc('second', t.at), t.ter, t.usr, t.loc,
    t.uuid || ' - ' || right('00' || coalesce(CAST(l.board AS VARCHAR), ''), 2), coalesce({entry.format(c='l.entry')}, 0), coalesce(l.boards, 0), coalesce(l.draws, 0),
    coalesce(l.ids, ''), coalesce(l.dev, ''), coalesce(l.simp, 0), coalesce(l.qp, 0), coalesce(l.marks, 0), coalesce(l.bulk, ''), coalesce(l.p1, ''), l.p2, l.p3,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, {money}, CAST({ret} AS {m2}), CAST(CASE WHEN t.ty = 3 THEN a.win ELSE 0 END AS {m2}), {mode}, t.cart, CAST(0 AS {m2})
    FROM tr t CROSS JOIN iv CROSS JOIN win w JOIN bt b ON b.tk = t.tk AND b.code IS NOT NULL LEFT JOIN ld l ON l.tk = t.tk AND l.li = b.li
    LEFT JOIN se x ON x.tk = t.tk AND x.li = l.li LEFT JOIN am a ON a.tk = t.tk AND a.li = l.li
    WHERE t.prod IN (2, 3, 4) AND t.rej = false AND t.at BETWEEN iv.lo AND iv.hi
  UNION ALL SELECT t.uuid, t.hd, t.ty, {code}, b.code, x.txt, {biz('hor')}, date_trunc('second', t.at), t.ter, t.usr, t.loc, t.uuid,
    coalesce({entry.format(c='t.entry')}, 0), 0, 0, '', '', 0, 0, 0, '', '', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {money}, CAST({ret} AS {m2}),
    CAST(CASE WHEN t.ty = 3 THEN a.win ELSE 0 END AS {m2}), {mode}, t.cart, CAST(coalesce(CASE WHEN t.ty = 3 THEN a.rc ELSE d.reb END, 0) AS {m2})
    FROM tr t CROSS JOIN iv CROSS JOIN win w LEFT JOIN bt b ON b.tk = t.tk LEFT JOIN hd d ON d.tk = t.tk LEFT JOIN se x ON x.tk = t.tk LEFT JOIN am a ON a.tk = t.tk
    WHERE t.prod = 1 AND t.rej = false AND t.at BETWEEN iv.lo AND iv.hi
  UNION ALL SELECT t.uuid, t.hd, t.ty, {code}, s.code, s.selectionname, {biz('spo')}, date_trunc('second', t.at), t.ter, t.usr, t.loc, t.uuid,
    coalesce({entry.format(c='s.entry')}, 0), 0, 0, '', '', 0, 0, 0, '', '', NULL, NULL, s.eventid, s.leaguecode, s.live, s.eventname, s.bettypename, s.selectionodds, s.ko,
    CAST(a.w1 AS {m2}), CAST(a.w2 AS {m2}), CAST(p.salesfactoramount AS DECIMAL(22,11)), CAST(a.s2 AS DECIMAL(22,11)), CAST(coalesce(a.c1, 0) AS DECIMAL(22,11)),
    CAST(coalesce(a.c2, 0) AS DECIMAL(22,11)), CAST(coalesce(a.g1, 0) AS DECIMAL(22,11)), CAST(coalesce(a.g2, 0) AS DECIMAL(22,11)),
    CAST(CASE t.ty WHEN 3 THEN a.ret WHEN 61 THEN a.rf ELSE 0 END AS {m2}), CAST(CASE WHEN t.ty = 3 THEN a.win ELSE 0 END AS {m2}), {mode}, t.cart, CAST(0 AS {m2})
    FROM tr t CROSS JOIN iv CROSS JOIN win w JOIN sports_line p ON p.tranheaderid = t.hd JOIN tk k ON k.hd = t.hd AND k.tot IN (1, 3, 4, 5, 6)
    LEFT JOIN sd s ON s.tk = t.tk AND s.li = p.tranlineitemid LEFT JOIN am a ON a.tk = t.tk
    WHERE t.prod IN (5, 6) AND t.rej = false AND t.at BETWEEN iv.lo AND iv.hi)
SELECT * REPLACE (CAST(transactiontimestamp AS VARCHAR) AS transactiontimestamp, CAST(entrymethod AS INT) AS entrymethod, CAST(numboards AS INT) AS numboards,
  CAST(numdraws AS INT) AS numdraws, CAST(nummarks AS INT) AS nummarks) FROM fin""",
        *INTERVAL_TABLES,
    )
