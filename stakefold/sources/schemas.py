"""Declared schemas of the input tables and of the outputs.

Money is ``decimal(22,2)`` cents; ``decimal(22,12)`` holds amounts after a sales
factor; every time is zone-less (``utc`` or local as noted).
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

_DDL: dict[str, str] = {
    # ticket events
    "header": """tranheaderid string, ticketserialnumber string, tickettransactionid string, prodid int,
        terdisplayid string, userdisplayid string, cartid string, requestid string, deviceid string,
        entrymethodid string, createddate timestamp_ntz, iscancelled boolean, isexchangeticket boolean,
        isbetrejectedbytrader boolean""",  # createddate utc
    "header_state": """tranheaderid string, betstatetypeid string, placedbetlifecycleid string,
        captureddate timestamp_ntz""",  # utc
    "validated": """tranheaderid string, ticketserialnumber string, cartid string, prodid int, terdisplayid string,
        userdisplayid string, requestid string, validationtypeid string, validationdate timestamp_ntz,
        createdvalidationdate timestamp_ntz, winningamount decimal(22,2), rebateamount decimal(22,2),
        refundamount decimal(22,2), rebatereclaim decimal(22,2)""",  # local, utc
    "validated_state": "tranheaderid string, betstatetypeid string, captureddate timestamp_ntz",
    "cancelled": """tranheaderid string, ticketserialnumber string, prodid int, terdisplayid string,
        userdisplayid string, requestid string, cartid string, cancelleddate timestamp_ntz,
        cancelledamout decimal(22,2)""",  # local
    "cancelled_state": "tranheaderid string, betstatetypeid string",
    # line items
    "horse_line": """tranheaderid string, terdisplayid string, createddate timestamp_ntz, bettypeid string,
        betpriceamount decimal(22,2), salescommamount decimal(22,12), salesfactoramount decimal(22,12),
        boardrebateamount decimal(22,2), betlineannotation string""",
    "fourd_line": """tranheaderid string, tranlineitemid string, bettypeid string, permutation int,
        quickpickindicator boolean""",
    "fourd_number": """tranheaderid string, tranlineitemid string, createddate timestamp_ntz,
        bigbetacceptedwager decimal(22,2), smallbetacceptedwager decimal(22,2),
        salescommamountbig decimal(22,12), salescommamountsmall decimal(22,12),
        salesfactoramountbig decimal(22,12), salesfactoramountsmall decimal(22,12), selectedbetnumber string""",
    "pool_line": """tranheaderid string, tranlineitemid string, createddate timestamp_ntz, bettypeid string,
        betpriceamount decimal(22,2), salescommamount decimal(22,12), salesfactoramount decimal(22,12),
        groupunitsequence int, grouphostid string, itotoindicator boolean, units int, syndicatepartsallowed int,
        quickpickindicator boolean""",
    "pool_number": "tranlineitemid string, sequence int, singlebetnumber int",
    "sweep_line": """tranheaderid string, tranlineitemid string, isprinted int, quickpickindicator boolean,
        userselectednumber bigint, bulkid string""",
    "sweep_number": """tranheaderid string, tranlineitemid string, terdisplayid string, createddate timestamp_ntz,
        issoldout boolean, betpriceamount decimal(22,2), salescommamount decimal(22,12),
        salesfactoramount decimal(22,12), selectednumber string""",
    "sports_line": """tranheaderid string, tranlineitemid string, terdisplayid string, createddate timestamp_ntz,
        accumulatorid string, betamount decimal(22,2), salescommamount decimal(22,12),
        salesfactoramount decimal(22,12), sourcesystemtransactionid string, issinglebet boolean""",
    "sports_number": """tranheaderid string, tranlineitemid string, createddate timestamp_ntz, eventid string,
        eventname string, bettypename string, selectionname string, selectionodds string""",
    "draw": "tranheaderid string, hostdrawdatesid int",
    "sport_event": """eventid string, typeid int, hasbetinrun boolean, starttime timestamp_ntz,
        suspendtime timestamp_ntz""",
    "sport_type": "typeid int, classid int, name string",
    "sport_class": "classid int, categoryid int",
    "sport_category": "categoryid int",
    "sport_league": "name string, leaguecode string",
    # dimensions
    "terminal": "terdisplayid string, locid int, isdeleted boolean",
    "location": """locid int, locdisplayid string, locname string, loctypeid int, sweepindicator int, isgst boolean,
        isibg boolean, ishq boolean, accountnumber string, branchid string, bankid string, retid int, chid int,
        isdeleted boolean""",
    "chain": "chid int, chdisplayid string, chname string",
    "product": "prodid int, prodname string",
    "ledger_product": "prodid int, sapprodid int",
    "validation_type": "validationtypeid string, validationname string",
    "operating_hours": "locid int, dayno int, opentime string, closetime string, isdeleted boolean",
    "session": """terdisplayid string, sessionstartdatetime timestamp_ntz,
        sessionenddatetime timestamp_ntz""",  # local
    # calendar and configuration
    "calendar": """host int, actualdate date, previousperioddatetime timestamp_ntz, perioddatetime timestamp_ntz,
        previousperioddatetimeutc timestamp_ntz, perioddatetimeutc timestamp_ntz""",
    "period_history": "host int, actualdate date, perioddatetime timestamp_ntz",
    "period_default": "host int, adhoctime string, defaulttime string",
    "lookup": "configname string, fld1value string, fld2value string",
    "invoice_period": "invoiceperiodid string, startdate date, enddate date",
    "tax_rate": "gstrate decimal(9,2), effectivefrom date, enddate date",
    "location_tax": "locid int, startdate date, enddate date, isgst boolean, isdeleted boolean",
    "commission": """prodid int, commissiontype int, salescommission decimal(9,2), salesfactor decimal(13,12),
        isdeleted boolean""",
    # payments, offline products, funding
    "payment": """paymentdetailid string, terdisplayid string, paymenttypeid string, paidamount decimal(22,2),
        createddate timestamp_ntz""",
    "cart": "cartid string, terdisplayid string, cartcreateddate timestamp_ntz",
    "instant_payment": """cartid string, paymentdetailid string, paymenttypeid string, transactionstatus string,
        netamount decimal(22,2), transactionfee decimal(22,2), updateddatetime timestamp_ntz""",  # local
    "offline_header": "transactionheaderid string, terdisplayid string, transactiontime timestamp_ntz",  # local
    "offline_voucher": """headerid string, terdisplayid string, isactive boolean, transactiontype int,
        amount decimal(22,2), createddate timestamp_ntz""",
    "offline_charity": """headerid string, charitytransactionid string, terdisplayid string,
        totalamount decimal(22,2), repeatedticket int, createddate timestamp_ntz""",
    "offline_spa": """headerid string, terdisplayid string, transactiontype int, totalamount decimal(22,2),
        repeatedticket int, createddate timestamp_ntz""",
    "offline_topup": """headerid string, terdisplayid string, transactiontype int, totalamount decimal(22,2),
        repeatedticket int, createddate timestamp_ntz""",
    "offline_festive": """headerid string, terdisplayid string, totalamount decimal(22,2), repeatedticket int,
        createddate timestamp_ntz""",
    "funding": """fundingid string, locid int, fundingamount decimal(22,2), fundperiodstart timestamp_ntz,
        fundperiodend timestamp_ntz""",
    "recovery": "fundingid string, recperiodstart timestamp_ntz, recperiodend timestamp_ntz",
    "adjustment": """adjustinvoiceid string, locid int, adjustmentamount decimal(22,2), adjustmentcode int,
        approvalstatus int, createddatetime timestamp_ntz""",  # local
}

_AUDIT = "PROCDATE string, X_ETL_NAME string, X_RECORD_INSERT_TS timestamp_ntz, X_RECORD_UPDATE_TS timestamp_ntz"

_OUTPUT_DDL: dict[str, str] = {
    "location_invoice": """locdisplayid string, agentinvoice_invid string, agentinvoice_finidn string,
        agentinvoice_productid int, sales_type string, totalcount int, amount decimal(32,11)""",
    "terminal_invoice": """terdisplayid string, transactiondate date, prodid int, locdisplayid string,
        sales_type string, totalcount int, amount decimal(32,11)""",
    "interval_transactions": """uuid string, tranheaderid string, transactiontype int, productid int,
        bettypeid string, selection string, businessdate date, transactiontimestamp timestamp_ntz, terminalid string,
        userid string, locationid string, boardseqnumber string, entrymethod int, numboards int, numdraws int,
        drawid string, ebetslipinfo_mobnbr string, numsimplebets int, qpflag int, nummarks int, bulkid string,
        itoto_numparts string, itoto_totalparts string, grptoto_numparts string, eventid string, leaguecode string,
        liveindicator string, eventname string, market string, odds string, matchkickoff string,
        wager1 decimal(22,2), wager2 decimal(22,2), sales1 decimal(22,11), sales2 decimal(22,11),
        salescomm1 decimal(22,11), salescomm2 decimal(22,11), gst1 decimal(22,11), gst2 decimal(22,11),
        returnamount decimal(22,2), winningamount decimal(22,2), paymentmode string, cartid string,
        betlinerebateamount decimal(22,2)""",
    "operating_hours": """locationname string, locationid string, terminalid string, opentime string,
        signondate string, signontime string, firstsaletime string, firsthourcount int, closetime string,
        signoffdate string, signofftime string, lastsaletime string, lasthourcount int""",
    "hq_prizes": """businessdate date, producttype string, prizeamount decimal(18,2), refundamount decimal(18,2),
        txndate date""",
    "shop_ledger": """idmmbusinessday string, businessdate date, itemid string, transactionid string,
        documentdate date, linecode string, sapdoctype string, sappostingkey string, sapcontrolacctcode string,
        linetext string, glnumber string, saptaxcode string, saptaxbaseamount bigint, cccode string,
        sapassignment string, currencycode string, amount decimal(22,2), product string, drawnumber string,
        customer string""",
}

TABLES = list(_DDL)
OUTPUTS = list(_OUTPUT_DDL)


@cache
def table_schema(name: str) -> StructType:
    """Schema of an input table (needs a running session to parse)."""
    return StructType.fromDDL(" ".join(_DDL[name].split()))


@cache
def output_schema(name: str, stored: bool = False) -> StructType:
    """Schema of a job's result; ``stored`` adds the run date and audit columns."""
    ddl = _OUTPUT_DDL[name] + (f", {_AUDIT}" if stored else "")
    return StructType.fromDDL(" ".join(ddl.split()))
