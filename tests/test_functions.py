import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from stakefold.functions import codes as C
from stakefold.functions import dates as D
from stakefold.functions import money as M


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def dec(text, kind="decimal(32,12)"):
    return F.lit(text).cast(kind)


def test_truncation_is_toward_zero(spark):
    got = one(
        spark, a=M.trunc_money(dec("1.239")), b=M.trunc_money(dec("-1.239")),
        c=M.dollars_trunc(dec("123.99")), d=M.dollars_trunc(dec("-123.99")), e=M.cents_trunc(dec("-0.999")),
    )
    assert [got[k] for k in "abcde"] == [Dec("1.23"), Dec("-1.23"), Dec("1.23"), Dec("-1.23"), Dec("0.00")]


def test_rounding_is_half_away_from_zero(spark):
    got = one(spark, a=M.dollars_round(dec("100.5")), b=M.dollars_round(dec("-100.5")), c=M.round_money(dec("2.345")))
    assert (got["a"], got["b"], got["c"]) == (Dec("1.01"), Dec("-1.01"), Dec("2.35"))


def test_truncation_never_rounds_up_a_long_fraction(spark):
    assert one(spark, a=M.dollars_trunc(dec("99.999999999999")))["a"] == Dec("0.99")


def test_tax_needs_a_fraction(spark):
    got = one(spark, a=M.tax_exclusive(dec("10900", "decimal(22,2)"), F.lit(Dec("0.09"))), b=M.tax_add(dec("100.50", "decimal(22,2)"), F.lit(Dec("9"))))
    assert got["a"] == Dec("10000") and got["b"] == Dec("9.05")


def test_tax_exclusive_keeps_eleven_digits(spark):
    got = one(spark, a=M.tax_exclusive(dec("100", "decimal(22,2)"), F.lit(Dec("0.09"))))
    assert got["a"] == Dec("91.74311926606")


def test_empty_group_ratio_is_null(spark):
    assert one(spark, a=M.safe_ratio(dec("1"), F.lit(0).cast("decimal(8,0)")))["a"] is None


def test_half_week_bounds():
    friday, sunday = dt.date(2024, 1, 5), dt.date(2024, 1, 7)
    for day in range(8, 12):  # Monday to Thursday settle Friday to Sunday
        assert D.half_week(dt.date(2024, 1, day)) == (friday, sunday)
    for day in range(12, 15):
        assert D.half_week(dt.date(2024, 1, day)) == (dt.date(2024, 1, 8), dt.date(2024, 1, 11))


def test_hour_beyond_midnight_stays_on_the_day_with_its_minutes(spark):
    got = one(spark, a=D.hour_rollover(F.lit(dt.date(2024, 1, 5)), F.lit("25:45:10")))
    assert got["a"] == dt.datetime(2024, 1, 5, 1, 45, 10)


def test_day_number_starts_on_sunday(spark):
    days = [dt.date(2024, 1, 7) + dt.timedelta(days=i) for i in range(7)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(D.sunday_first_day_number(F.col("d"))).collect()
    assert [r[0] for r in rows] == [1, 2, 3, 4, 5, 6, 7]


def test_window_ends_differ_at_the_edge(spark):
    edge = dt.datetime(2024, 1, 5, 1)
    lo = dt.datetime(2024, 1, 4, 1)
    got = one(spark, a=D.window(D.ts_lit(edge), lo, edge, "left"), b=D.window(D.ts_lit(edge), lo, edge, "both"))
    assert got == {"a": False, "b": True}


def test_ticket_status_codes(spark):
    rows = spark.createDataFrame(
        [(None, False, False, 1), (False, True, False, 2), (True, False, False, 3), (True, True, False, 4),
         (False, False, True, 6), (True, False, True, 5), (False, True, True, 5)],
        "r boolean, c boolean, x boolean, want int",
    )
    got = rows.select(C.bet_status(F.col("r"), F.col("c"), F.col("x")).alias("s"), "want").collect()
    assert all(r.s == r.want for r in got)


def test_four_d_codes(spark):
    rows = spark.createDataFrame(
        [("ORD", 1, 0, 0, "1234", "0"), ("ORD", 0, 1, 0, "1234", "5"), ("ORD", 1, 1, 0, "1234", "10"),
         ("SYS", 1, 0, 24, "1234", "1"), ("SYS", 0, 1, 6, "1234", "9"), ("SYS", 1, 1, 4, "1234", "13"),
         ("IBET", 1, 0, 12, "1234", "28"), ("IBET", 0, 1, 24, "1234", "31"), ("IBET", 1, 1, 6, "1234", "38"),
         ("ROLL", 1, 0, 0, "R123", "15"), ("ROLL", 0, 1, 0, "1R23", "20"), ("ROLL", 1, 1, 0, "123R", "26"),
         ("SYS", 1, 0, 5, "1234", None), ("ORD", 0, 0, 0, "1234", None)],
        "k string, b int, s int, p int, n string, want string",
    )
    got = rows.select(C.four_d_bet_code(*[F.col(c) for c in "kbspn"]).alias("c"), "want").collect()
    assert [(r.c, r.want) for r in got if r.c != r.want] == []


def test_entry_methods_ignore_case(spark):
    got = one(spark, a=C.entry_method(F.lit("Manual")), b=C.entry_method(F.lit("EBETSLIP")), c=C.entry_method(F.lit("x")))
    assert got == {"a": 0, "b": 16, "c": None}


def test_unprinted_consignee_tickets_count_when_taken(spark):
    rows = spark.createDataFrame(
        [("PB06", 1, 1, True), ("PB06", None, 1, False), ("PB06", None, None, True), ("PB03", None, 1, True),
         ("PB03", 1, 1, False), ("PB03", None, None, False)],
        "s string, p int, i int, want boolean",
    )
    got = rows.select(C.sweep_counts(F.col("s"), F.col("p"), F.col("i")).alias("c"), "want").collect()
    assert all(r.c == r.want for r in got)
