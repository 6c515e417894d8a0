"""Domain tables as SQL over the TPC-H-like test tables.

Every order becomes a ticket and every order line a bet line; customers are
terminals, suppliers locations, nations chains, and events carry payments,
offline sales and sessions.  Sales of all orders fall around one half-week
(Friday 2024-01-05 to Sunday 2024-01-07) so that a run reads whole tables.

The text is valid for Spark and for DuckDB; the few places where the dialects
differ go through ``Dialect``.
"""

from __future__ import annotations

from dataclasses import dataclass

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


# columns the test tables have nothing for
ABSENT = {"location": ("accountnumber", "branchid", "bankid", "retid")}


@dataclass(frozen=True)
class Dialect:
    ts: str

    def at(self, base: str, seconds: str) -> str:
        if self.ts == "TIMESTAMP_NTZ":
            step = f"make_dt_interval(0, 0, 0, CAST({seconds} AS DECIMAL(18,6)))"
        else:
            step = f"to_seconds({seconds})"
        return f"({self.ts} '{base}' + {step})"


SPARK = Dialect("TIMESTAMP_NTZ")
DUCKDB = Dialect("TIMESTAMP")


def tables(d: Dialect) -> dict[str, str]:
    start, spread = "2024-01-04 15:00:00", 280800

    def order_time(key: str, extra: str = "0") -> str:
        return d.at(start, f"({key} * 7919) % {spread} + {extra}")

    def terminal(key: str) -> str:
        return f"lpad(CAST(CAST(floor({key} / 10) AS BIGINT) AS STRING), 9, '0')"

    def ident(prefix: str, key: str) -> str:
        return f"'{prefix}' || CAST({key} AS STRING)"

    ticket = "'T' || CAST(CASE WHEN o_orderkey % 60 >= 54 THEN o_orderkey - 6 ELSE o_orderkey END AS STRING)"
    line_id = (
        "'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
        "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
    )
    line_time = order_time("l_orderkey", "l_linenumber")
    price = "CAST(l_extendedprice AS DECIMAL(22,2))"
    small = "CAST(l_quantity * 100 AS DECIMAL(22,2))"
    disc = "CAST(l_discount AS DECIMAL(4,2))"
    keep = "(CAST(1 AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)))"

    def factor(x: str) -> str:
        return f"CAST({x} AS DECIMAL(22,12))"

    total = "CAST(o_totalprice AS DECIMAL(22,2))"
    value = "CAST(value AS DECIMAL(22,2))"
    event_terminal = "lpad(CAST(user_id AS STRING), 9, '0')"
    event_utc = d.at(start, f"(event_id * 7919) % {spread}")
    event_local = f"({event_utc} + INTERVAL 8 HOURS)"

    return {
        "header": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, {ticket} AS ticketserialnumber,
            {ident('X', 'o_orderkey')} AS tickettransactionid, CAST(o_orderkey % 6 + 1 AS INT) AS prodid,
            {terminal('o_orderkey')} AS terdisplayid, {ident('U', 'o_custkey % 50')} AS userdisplayid,
            {ident('K', 'o_orderkey')} AS cartid, {ident('R', 'o_orderkey')} AS requestid,
            {ident('D', 'o_custkey')} AS deviceid,
            CASE o_orderkey % 5 WHEN 0 THEN 'Manual' WHEN 1 THEN 'BetSlip' WHEN 2 THEN 'Edit'
                WHEN 3 THEN 'EBetSlip' ELSE 'Other' END AS entrymethodid,
            {order_time('o_orderkey')} AS createddate, o_orderstatus = 'P' AS iscancelled,
            o_orderkey % 23 = 0 AS isexchangeticket,
            CASE WHEN o_orderkey % 19 = 0 THEN true WHEN o_orderkey % 17 = 0 THEN NULL ELSE false END
                AS isbetrejectedbytrader
            FROM orders""",
        "header_state": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, 'PB06' AS betstatetypeid,
            {ident('P6', 'o_orderkey')} AS placedbetlifecycleid, {order_time('o_orderkey', '1')} AS captureddate
            FROM orders WHERE o_orderkey % 11 <> 0
            UNION ALL SELECT {ident('H', 'o_orderkey')}, 'PB03', {ident('P3', 'o_orderkey')},
            {order_time('o_orderkey')} FROM orders WHERE o_orderkey % 7 <> 0""",
        "validated": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, {ticket} AS ticketserialnumber,
            {ident('KV', 'o_orderkey')} AS cartid, CAST(o_orderkey % 6 + 1 AS INT) AS prodid,
            {terminal('o_orderkey')} AS terdisplayid, {ident('V', 'o_custkey % 50')} AS userdisplayid,
            {ident('RV', 'o_orderkey')} AS requestid,
            CASE WHEN o_orderkey % 37 = 0 THEN 'LBRB' WHEN o_orderkey % 7 = 0 THEN 'RFND' ELSE 'VALD' END
                AS validationtypeid,
            {order_time('o_orderkey', '1800')} + INTERVAL 8 HOURS AS validationdate,
            {order_time('o_orderkey', '1800')} AS createdvalidationdate,
            CASE WHEN o_orderkey % 13 = 5 THEN NULL WHEN o_orderkey % 9 = 0 THEN CAST(0 AS DECIMAL(22,2))
                ELSE {total} END AS winningamount,
            CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS DECIMAL(22,2)) END AS rebateamount,
            CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 1000 AS DECIMAL(22,2)) END AS refundamount,
            CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey % 100 AS DECIMAL(22,2)) END AS rebatereclaim
            FROM orders WHERE o_orderstatus = 'F'""",
        "validated_state": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, 'VB06' AS betstatetypeid,
            {order_time('o_orderkey', '1860')} AS captureddate FROM orders
            WHERE o_orderstatus = 'F' AND o_orderkey % 13 <> 0
            UNION ALL SELECT {ident('H', 'o_orderkey')}, 'VB01', {order_time('o_orderkey', '1801')} FROM orders
            WHERE o_orderstatus = 'F'""",
        "cancelled": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, {ticket} AS ticketserialnumber,
            CAST(o_orderkey % 6 + 1 AS INT) AS prodid, {terminal('o_orderkey')} AS terdisplayid,
            {ident('C', 'o_custkey % 50')} AS userdisplayid, {ident('RC', 'o_orderkey')} AS requestid,
            {ident('KC', 'o_orderkey')} AS cartid,
            {order_time('o_orderkey', '600')} + INTERVAL 8 HOURS AS cancelleddate, {total} AS cancelledamout
            FROM orders WHERE o_orderstatus = 'P'""",
        "cancelled_state": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid, 'CB06' AS betstatetypeid
            FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 13 <> 1""",
        "horse_line": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {terminal('l_orderkey')} AS terdisplayid,
            {line_time} AS createddate,
            CASE l_linenumber % 3 WHEN 0 THEN 'W-P' WHEN 1 THEN 'WIN' ELSE 'PLC' END AS bettypeid,
            {price} AS betpriceamount, {factor(f'{price} * {disc}')} AS salescommamount,
            {factor(f'{price} * {keep}')} AS salesfactoramount,
            CASE WHEN l_quantity > 40 THEN {small} WHEN l_quantity > 30 THEN CAST(0 AS DECIMAL(22,2)) END
                AS boardrebateamount,
            {ident('B', 'l_partkey')} AS betlineannotation
            FROM lineitem WHERE l_orderkey % 6 = 0""",
        "fourd_line": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            CASE l_linenumber % 4 WHEN 0 THEN 'ORD' WHEN 1 THEN 'SYS' WHEN 2 THEN 'IBET' ELSE 'ROLL' END AS bettypeid,
            CASE l_partkey % 6 WHEN 0 THEN 24 WHEN 1 THEN 12 WHEN 2 THEN 4 WHEN 3 THEN 6 WHEN 4 THEN 0 END
                AS permutation,
            l_suppkey % 2 = 0 AS quickpickindicator
            FROM lineitem WHERE l_orderkey % 6 = 1""",
        "fourd_number": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            {line_time} AS createddate,
            CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE {price} END AS bigbetacceptedwager,
            CASE WHEN l_linenumber % 3 = 1 THEN CAST(0 AS DECIMAL(22,2)) ELSE {small} END AS smallbetacceptedwager,
            {factor(f'{price} * {disc}')} AS salescommamountbig, {factor(f'{small} * {disc}')} AS salescommamountsmall,
            {factor(f'{price} * {keep}')} AS salesfactoramountbig,
            {factor(f'{small} * {keep}')} AS salesfactoramountsmall,
            CASE WHEN l_linenumber % 4 = 3 THEN CASE l_partkey % 4 WHEN 0 THEN 'R123' WHEN 1 THEN '1R23'
                WHEN 2 THEN '12R3' ELSE '123R' END
                ELSE lpad(CAST(l_partkey % 10000 AS STRING), 4, '0') END AS selectedbetnumber
            FROM lineitem WHERE l_orderkey % 6 = 1""",
        "pool_line": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            {line_time} AS createddate,
            CASE WHEN l_orderkey % 18 = 2 THEN CASE l_partkey % 4 WHEN 0 THEN 'M 2' WHEN 1 THEN 'M 3'
                WHEN 2 THEN 'M 4' ELSE 'M AN' END
                ELSE CASE l_partkey % 8 WHEN 0 THEN 'ORD' WHEN 1 THEN 'SYSR' WHEN 2 THEN 'SYS7' WHEN 3 THEN 'SYS8'
                WHEN 4 THEN 'SYS9' WHEN 5 THEN 'SYS10' WHEN 6 THEN 'SYS11' ELSE 'SYS12' END END AS bettypeid,
            {price} AS betpriceamount, {factor(f'{price} * {disc}')} AS salescommamount,
            {factor(f'{price} * {keep}')} AS salesfactoramount,
            CASE WHEN l_orderkey % 5 = 0 THEN CASE WHEN l_quantity > 25 THEN 2 ELSE 1 END END AS groupunitsequence,
            CASE WHEN l_orderkey % 5 = 0 THEN 'G' || CAST(CAST(floor(l_orderkey / 300) AS BIGINT) AS STRING)
                ELSE '00000000-0000-0000-0000-000000000000' END AS grouphostid,
            l_orderkey % 7 = 0 AS itotoindicator, CAST(l_quantity AS INT) AS units,
            l_linenumber + 1 AS syndicatepartsallowed, l_suppkey % 2 = 0 AS quickpickindicator
            FROM lineitem WHERE l_orderkey % 6 = 2""",
        "pool_number": f"""SELECT {line_id} AS tranlineitemid, 1 AS sequence,
            CAST(l_partkey % 49 + 1 AS INT) AS singlebetnumber FROM lineitem WHERE l_orderkey % 6 = 2
            UNION ALL SELECT {line_id}, 2, CAST(l_suppkey % 49 + 1 AS INT) FROM lineitem WHERE l_orderkey % 6 = 2""",
        "sweep_line": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            CASE WHEN l_orderkey % 4 = 1 THEN NULL ELSE 1 END AS isprinted,
            l_suppkey % 2 = 0 AS quickpickindicator, l_partkey AS userselectednumber,
            CASE WHEN l_orderkey % 8 <> 3 THEN {ident('BK', 'l_orderkey % 100')} END AS bulkid
            FROM lineitem WHERE l_orderkey % 6 = 3""",
        "sweep_number": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            {terminal('l_orderkey')} AS terdisplayid, {line_time} AS createddate, l_quantity > 45 AS issoldout,
            {price} AS betpriceamount, {factor(f'{price} * {disc}')} AS salescommamount,
            {factor(f'{price} * {keep}')} AS salesfactoramount,
            lpad(CAST(l_partkey AS STRING), 7, '0') AS selectednumber
            FROM lineitem WHERE l_orderkey % 6 = 3""",
        "sports_line": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            {terminal('l_orderkey')} AS terdisplayid, {line_time} AS createddate,
            CASE l_linenumber % 4 WHEN 0 THEN 'SGL' WHEN 1 THEN 'DBL' WHEN 2 THEN 'TBL' ELSE 'ACC4' END
                AS accumulatorid,
            CAST(floor(l_quantity / 10) * 1000 + 500 AS DECIMAL(22,2)) AS betamount,
            {factor("CAST(floor(l_quantity / 10) * 1000 + 500 AS DECIMAL(22,2)) * CAST(0.05 AS DECIMAL(4,2))")}
                AS salescommamount,
            {factor("CAST(floor(l_quantity / 10) * 1000 + 500 AS DECIMAL(22,2)) * CAST(0.93 AS DECIMAL(4,2))")}
                AS salesfactoramount,
            {ident('S', 'l_orderkey')} AS sourcesystemtransactionid, l_linenumber % 4 = 0 AS issinglebet
            FROM lineitem WHERE l_orderkey % 6 >= 4""",
        "sports_number": f"""SELECT {ident('H', 'l_orderkey')} AS tranheaderid, {line_id} AS tranlineitemid,
            {line_time} AS createddate, {ident('E', 'l_partkey % 50')} AS eventid,
            'Event ' || CAST(l_partkey % 50 AS STRING) AS eventname,
            'Market ' || CAST(l_suppkey % 5 AS STRING) AS bettypename,
            'Pick ' || CAST(l_partkey % 10 AS STRING) AS selectionname,
            '1.' || CAST(l_linenumber AS STRING) AS selectionodds
            FROM lineitem WHERE l_orderkey % 6 >= 4""",
        "draw": f"""SELECT {ident('H', 'o_orderkey')} AS tranheaderid,
            CAST(100 + o_custkey % 7 AS INT) AS hostdrawdatesid FROM orders WHERE o_orderkey % 6 IN (1, 2, 3)
            UNION ALL SELECT {ident('H', 'o_orderkey')}, CAST(200 + o_custkey % 7 AS INT) FROM orders
            WHERE o_orderkey % 6 IN (1, 2, 3) AND o_custkey % 5 = 1""",
        "sport_event": f"""SELECT {ident('E', 'k')} AS eventid, CAST(k % 10 AS INT) AS typeid, k % 2 = 0 AS hasbetinrun,
            {d.at('2024-01-04 16:00:00', 'k * 3600')} AS starttime,
            {d.at('2024-01-04 16:00:00', 'k * 3600 + 72000')} AS suspendtime
            FROM (SELECT DISTINCT p_partkey % 50 AS k FROM part) AS e""",
        "sport_type": """SELECT CAST(k AS INT) AS typeid, CAST(k % 4 AS INT) AS classid,
            'Lea|gue ' || CAST(k AS STRING) AS name FROM (SELECT DISTINCT p_partkey % 10 AS k FROM part) AS e""",
        "sport_class": """SELECT CAST(k AS INT) AS classid, CAST(k % 3 + 1 AS INT) AS categoryid
            FROM (SELECT DISTINCT p_partkey % 4 AS k FROM part) AS e""",
        "sport_category": """SELECT CAST(k AS INT) AS categoryid
            FROM (SELECT DISTINCT p_partkey % 3 + 1 AS k FROM part) AS e""",
        "sport_league": """SELECT 'League ' || CAST(k AS STRING) AS name, 'LC' || CAST(k AS STRING) AS leaguecode
            FROM (SELECT DISTINCT p_partkey % 10 AS k FROM part) AS e""",
        "terminal": """SELECT lpad(CAST(c_custkey AS STRING), 9, '0') AS terdisplayid,
            CAST(floor(c_custkey / 15) AS INT) AS locid, c_custkey % 40 = 39 AS isdeleted FROM customer""",
        "location": """SELECT CAST(s_suppkey AS INT) AS locid, lpad(CAST(s_suppkey AS STRING), 6, '0') AS locdisplayid,
            s_name AS locname, CASE s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 2 END AS loctypeid,
            CASE WHEN s_suppkey % 3 = 0 THEN 1 END AS sweepindicator, s_suppkey % 5 <> 0 AS isgst,
            s_suppkey % 2 = 0 AS isibg, s_suppkey % 3 = 2 AS ishq,
            CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_nationkey END AS chid, s_suppkey % 25 = 24 AS isdeleted
            FROM supplier""",
        "chain": """SELECT n_nationkey AS chid, 'C' || lpad(CAST(n_nationkey AS STRING), 3, '0') AS chdisplayid,
            n_name AS chname FROM nation""",
        "product": """SELECT * FROM (VALUES (1, 'HORSE RACING'), (2, ' 4D Lottery'), (3, 'TOTO'),
            (4, 'SINGAPORE SWEEP'), (5, 'SPORTS PRE'), (6, 'SPORTS LIVE')) AS v(prodid, prodname)""",
        "ledger_product": """SELECT * FROM (VALUES (1, '51'), (2, '52'), (3, '53'), (4, '54'), (5, '55'))
            AS v(prodid, sapprodid)""",
        "validation_type": """SELECT * FROM (VALUES ('VALD', 'VALIDATED'), ('RFND', 'REFUNDED'),
            ('LBRB', 'LOSING BET REBATE'), ('EXPD', 'EXPIRED')) AS v(validationtypeid, validationname)""",
        "operating_hours": """SELECT CAST(s_suppkey AS INT) AS locid, CAST(s_suppkey % 2 + 5 AS INT) AS dayno,
            '08:30:00' AS opentime, '21:15:00' AS closetime, s_suppkey % 7 = 6 AS isdeleted FROM supplier""",
        "session": f"""SELECT {event_terminal} AS terdisplayid, {event_local} AS sessionstartdatetime,
            {event_local} + INTERVAL 6 HOURS AS sessionenddatetime FROM events""",
        "calendar": " UNION ALL ".join(
            f"""SELECT {host} AS host, d AS actualdate, CAST(d AS {d.ts}) + INTERVAL {lead} MINUTES
            AS previousperioddatetime, CAST(d AS {d.ts}) + INTERVAL {lead + 1440} MINUTES AS perioddatetime,
            CAST(d AS {d.ts}) + INTERVAL {lead} MINUTES - INTERVAL 8 HOURS AS previousperioddatetimeutc,
            CAST(d AS {d.ts}) + INTERVAL {lead + 1440} MINUTES - INTERVAL 8 HOURS AS perioddatetimeutc
            FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) AS days"""
            for host, lead in ((1, 60), (2, 30), (3, 120))
        ),
        "period_history": " UNION ALL ".join(
            f"""SELECT {host} AS host, d AS actualdate, CAST(d AS {d.ts}) + INTERVAL {lead + 1440} MINUTES
            AS perioddatetime FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) AS days"""
            for host, lead in ((1, 60), (2, 30), (3, 120))
        ),
        "period_default": """SELECT * FROM (VALUES (1, CAST(NULL AS STRING), '25:00:00'), (2, '24:30:00', '23:00:00'),
            (3, CAST(NULL AS STRING), '02:00:00')) AS v(host, adhoctime, defaulttime)""",
        "lookup": """SELECT * FROM (VALUES ('RTMS_Host', '1', 'IGT'), ('RTMS_Host', '2', 'BMCS'),
            ('RTMS_Host', '3', 'OB'), ('RTMS_AdjustmentCode', '0', 'Credit A'), ('RTMS_AdjustmentCode', '1', 'Debit A'),
            ('RTMS_AdjustmentCode', '2', 'Credit B'), ('RTMS_AdjustmentCode', '3', 'X'))
            AS v(configname, fld1value, fld2value)""",
        "invoice_period": """SELECT * FROM (VALUES ('IP240105', DATE '2024-01-05', DATE '2024-01-07'),
            ('IP240108', DATE '2024-01-08', DATE '2024-01-11')) AS v(invoiceperiodid, startdate, enddate)""",
        "tax_rate": """SELECT * FROM (VALUES (CAST(8 AS DECIMAL(9,2)), DATE '2023-01-01', DATE '2024-01-05'),
            (CAST(9 AS DECIMAL(9,2)), DATE '2024-01-06', CAST(NULL AS DATE))) AS v(gstrate, effectivefrom, enddate)""",
        "location_tax": """SELECT CAST(s_suppkey AS INT) AS locid, DATE '2023-06-01' AS startdate,
            DATE '2024-12-31' AS enddate, s_suppkey % 5 <> 0 AS isgst, s_suppkey % 11 = 10 AS isdeleted
            FROM supplier""",
        "commission": """SELECT * FROM (VALUES (1, 1, CAST(4 AS DECIMAL(9,2)), CAST(0.94 AS DECIMAL(13,12)), false),
            (2, 1, CAST(5 AS DECIMAL(9,2)), CAST(0.93 AS DECIMAL(13,12)), false),
            (3, 1, CAST(5.5 AS DECIMAL(9,2)), CAST(0.92 AS DECIMAL(13,12)), false),
            (4, 1, CAST(6 AS DECIMAL(9,2)), CAST(0.91 AS DECIMAL(13,12)), false),
            (4, 2, CAST(7 AS DECIMAL(9,2)), CAST(0.9 AS DECIMAL(13,12)), false),
            (2, 1, CAST(1 AS DECIMAL(9,2)), CAST(0.5 AS DECIMAL(13,12)), true))
            AS v(prodid, commissiontype, salescommission, salesfactor, isdeleted)""",
        "payment": f"""SELECT {ident('PY', 'event_id')} AS paymentdetailid, {event_terminal} AS terdisplayid,
            CASE event_type WHEN 'click' THEN 'NC' WHEN 'view' THEN 'NN' WHEN 'purchase' THEN 'NCC'
                WHEN 'signup' THEN 'NFP' ELSE 'CSH' END AS paymenttypeid, {value} AS paidamount,
            {event_utc} AS createddate FROM events""",
        "cart": f"""SELECT {ident('K', 'o_orderkey')} AS cartid, {terminal('o_orderkey')} AS terdisplayid,
            {order_time('o_orderkey')} AS cartcreateddate FROM orders
            UNION ALL SELECT {ident('KV', 'o_orderkey')}, {terminal('o_orderkey')},
            {order_time('o_orderkey', '1800')} FROM orders WHERE o_orderstatus = 'F'""",
        "instant_payment": f"""SELECT {ident('K', 'o_orderkey')} AS cartid, {ident('IP', 'o_orderkey')} AS paymentdetailid,
            CASE o_custkey % 3 WHEN 0 THEN 'PNRIC' WHEN 1 THEN 'PNQR' ELSE 'OTHER' END AS paymenttypeid,
            CASE o_custkey % 5 WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '04' WHEN 3 THEN '99' ELSE '01' END
                AS transactionstatus,
            {total} AS netamount, CAST(o_custkey % 200 + 1 AS DECIMAL(22,2)) AS transactionfee,
            {order_time('o_orderkey', '60')} + INTERVAL 8 HOURS AS updateddatetime FROM orders""",
        "offline_header": f"""SELECT {ident('O', 'event_id')} AS transactionheaderid, {event_terminal} AS terdisplayid,
            {event_local} AS transactiontime FROM events""",
        "offline_voucher": f"""SELECT {ident('O', 'event_id')} AS headerid, {event_terminal} AS terdisplayid,
            event_id % 10 <> 0 AS isactive, CAST(event_id % 3 + 1 AS INT) AS transactiontype, {value} AS amount,
            {event_utc} AS createddate FROM events WHERE event_type = 'click'""",
        "offline_charity": f"""SELECT {ident('O', 'event_id')} AS headerid, {ident('CH', 'event_id')}
            AS charitytransactionid, {event_terminal} AS terdisplayid, {value} AS totalamount,
            CAST(event_id % 3 + 1 AS INT) AS repeatedticket, {event_utc} AS createddate
            FROM events WHERE event_type = 'view'""",
        "offline_spa": f"""SELECT {ident('O', 'event_id')} AS headerid, {event_terminal} AS terdisplayid,
            CAST(event_id % 2 + 1 AS INT) AS transactiontype, {value} AS totalamount,
            CAST(event_id % 3 + 1 AS INT) AS repeatedticket, {event_utc} AS createddate
            FROM events WHERE event_type = 'purchase'""",
        "offline_topup": f"""SELECT {ident('O', 'event_id')} AS headerid, {event_terminal} AS terdisplayid,
            CAST(event_id % 2 + 1 AS INT) AS transactiontype, {value} AS totalamount,
            CAST(event_id % 3 + 1 AS INT) AS repeatedticket, {event_utc} AS createddate
            FROM events WHERE event_type = 'signup'""",
        "offline_festive": f"""SELECT {ident('O', 'event_id')} AS headerid, {event_terminal} AS terdisplayid,
            {value} AS totalamount, CAST(event_id % 3 + 1 AS INT) AS repeatedticket, {event_utc} AS createddate
            FROM events WHERE event_type = 'error'""",
        "funding": f"""SELECT {ident('F', 's_suppkey')} AS fundingid, CAST(s_suppkey AS INT) AS locid,
            CAST(s_acctbal AS DECIMAL(22,2)) AS fundingamount,
            CASE WHEN s_suppkey % 8 = 7 THEN {d.ts} '2024-01-12 00:00:00' ELSE {d.ts} '2024-01-08 09:00:00' END
                AS fundperiodstart, {d.ts} '2024-01-11 18:00:00' AS fundperiodend FROM supplier""",
        "recovery": f"""SELECT {ident('F', 's_suppkey')} AS fundingid, {d.ts} '2024-01-08 00:00:00' AS recperiodstart,
            CASE WHEN s_suppkey % 3 = 0 THEN {d.ts} '2024-01-11 00:00:00' ELSE {d.ts} '2024-01-15 00:00:00' END
                AS recperiodend FROM supplier""",
        "adjustment": f"""SELECT {ident('A', 's_suppkey')} AS adjustinvoiceid, CAST(s_suppkey AS INT) AS locid,
            CAST(s_acctbal * 2 AS DECIMAL(22,2)) AS adjustmentamount, CAST(s_suppkey % 4 AS INT) AS adjustmentcode,
            CASE WHEN s_suppkey % 9 = 8 THEN 0 ELSE 1 END AS approvalstatus,
            {d.ts} '2024-01-06 10:00:00' AS createddatetime FROM supplier""",
    }


def oracle(body: str, *names: str) -> str:
    """DuckDB text: the named domain tables as CTEs, then ``body`` (starting with CTEs of its own)."""
    text = tables(DUCKDB)
    return "WITH " + ",\n".join(f"{n} AS ({text[n]})" for n in names) + (",\n" if names else "") + body.strip()
