import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from stakefold import operators as O
from stakefold.operators.postings import Rule, number_documents, posting_rules, totals


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def calendar(spark):
    d = dt.datetime
    return spark.createDataFrame(
        [(dt.date(2024, 1, 5), d(2024, 1, 5, 1), d(2024, 1, 6, 1)), (dt.date(2024, 1, 6), d(2024, 1, 6, 1), d(2024, 1, 7, 1)),
         (dt.date(2024, 1, 7), None, d(2024, 1, 8, 1))],
        "day date, lo timestamp_ntz, hi timestamp_ntz",
    )


def test_interval_join_keeps_left_rows_and_doubles_on_a_shared_edge(spark, calendar):
    d = dt.datetime
    ev = spark.createDataFrame([(1, d(2024, 1, 5, 12)), (2, d(2024, 1, 6, 1)), (3, d(2024, 1, 9)), (4, None)], "id int, at timestamp_ntz")
    got = O.interval_join(ev, calendar, "at", "lo", "hi", ["day"])
    d5, d6 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    assert sorted(str(tuple(r)) for r in got.select("id", "day").collect()) == sorted(
        map(str, [(1, d5), (2, d5), (2, d6), (3, None), (4, None)])
    )
    half = O.interval_join(ev, calendar, "at", "lo", "hi", ["day"], how="inner", ends="left")
    assert rows(half, "id", "day") == [(1, d5), (2, d6)]


def test_interval_join_equals_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    events = [(i, base + dt.timedelta(hours=7 * i, minutes=i)) for i in range(60)]
    periods = [(n, base + dt.timedelta(hours=n * 20), base + dt.timedelta(hours=n * 20 + 50)) for n in range(15)]
    ev = spark.createDataFrame(events, "id int, at timestamp_ntz")
    cal = spark.createDataFrame(periods, "n int, lo timestamp_ntz, hi timestamp_ntz")
    got = rows(O.interval_join(ev, cal, "at", "lo", "hi", ["n"], how="inner"), "id", "n")
    assert got == sorted((i, n) for i, at in events for n, lo, hi in periods if lo <= at <= hi)


def test_validity_join_open_end_and_entity(spark):
    d = dt.date
    facts = spark.createDataFrame([(1, d(2024, 1, 5)), (2, d(2024, 1, 6)), (3, d(2022, 1, 1))], "k int, day date")
    hist = spark.createDataFrame([(8, d(2023, 1, 1), d(2024, 1, 5), 1), (9, d(2024, 1, 6), None, 2)], "rate int, s date, e date, k2 int")
    assert rows(O.validity_join(facts, hist, "day", "s", "e", ["rate"]), "k", "rate") == [(1, 8), (2, 9)]
    by_entity = O.validity_join(facts, hist, "day", "s", "e", ["rate"], on=[("k", "k2")], how="left")
    assert {(r.k, r.rate) for r in by_entity.collect()} == {(1, 8), (2, 9), (3, None)}


def test_net_due_counts_a_missing_side_as_nothing(spark):
    df = spark.createDataFrame([("a", "1", 10), ("a", "2", 3), ("b", "1", 5), ("c", "2", 4), ("d", "9", 1)], "k string, t string, x int")
    got = O.net_debit_credit(df, ["k"], F.col("t") == "1", F.col("t") == "2", "x", "net")
    assert rows(got, "k", "net") == [("a", 7), ("b", 5), ("c", -4)]


def test_distinct_sum_ignores_fan_out(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "x", 5), (2, "x", 5)], "id int, k string, v int")
    assert rows(O.distinct_sum(df, ["id"], ["k"], "v", "s"), "k", "s") == [("x", 10)]


def test_max_then_sum(spark):
    df = spark.createDataFrame([("L1", "t1", 7), ("L1", "t2", 7), ("L2", "t3", 2)], "loc string, t string, v int")
    got = O.max_then_sum(df.withColumn("g", F.lit("all")), ["loc"], ["g"], "v", "s")
    assert rows(got, "s") == [(9,)]


@pytest.mark.parametrize(("how", "ends"), [("left", "both"), ("inner", "both"), ("left", "left"), ("inner", "left")])
def test_interval_join_of_periods_of_any_length(spark, how, ends):
    chance, base = random.Random(5), dt.datetime(2024, 1, 1)
    periods = [(n, n % 3, base + dt.timedelta(hours=chance.randrange(2000)), None) for n in range(80)]
    periods = [(n, k, lo, lo + dt.timedelta(hours=chance.choice([0, 1, 5, 24, 100, 900]))) for n, k, lo, _ in periods]
    periods += [(100, 1, base, dt.datetime(9999, 12, 31)), (101, 1, None, base), (102, 2, base, None), (103, 0, base, base - dt.timedelta(1)),
                (104, None, base, dt.datetime(2025, 1, 1)), (105, 2, dt.datetime(1950, 1, 1), dt.datetime(1970, 1, 2))]
    times = [(i, i % 3, base + dt.timedelta(hours=chance.randrange(-50, 2500))) for i in range(150)]
    times += [(200, 1, None), (201, None, base), (202, 1, dt.datetime(2500, 1, 1)), (203, 2, dt.datetime(1969, 12, 31, 5)), (204, 0, periods[0][2])]
    ev = spark.createDataFrame(times, "id int, k int, at timestamp_ntz")
    cal = spark.createDataFrame(periods, "n int, k int, lo timestamp_ntz, hi timestamp_ntz")
    assert cal.count() < O.dyadic_blocks(cal, "lo", "hi").count() <= 2 * cal.count()
    got = O.interval_join(ev, cal, "at", "lo", "hi", ["n", "k"], on=[("k", "k")], how=how, ends=ends)
    assert got.columns == ["id", "k", "at", "n", "k"]
    got = sorted(((r[0], r[3]) for r in got.collect()), key=str)
    want = []
    for i, k, at in times:
        own = [n for n, c, lo, hi in periods if at and lo and hi and lo <= hi and k is not None and k == c
               and lo <= at and (at <= hi if ends == "both" else at < hi)]
        want += [(i, n) for n in own or ([None] if how == "left" else [])]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("cell", [1, 7, 1000])
def test_block_product_is_every_pair_once(spark, cell):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c")], "x int, s string").repartition(3)
    right = spark.range(23).select(F.col("id").alias("y"), F.lit("k").alias("t")).repartition(2)
    got = O.block_product(left, right, cell_rows=cell)
    assert got.columns == ["x", "s", "y", "t"]
    want = sorted(str((a.x, a.s, b.y, b.t)) for a in left.collect() for b in right.collect())
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert O.block_product(left.where("false"), right, cell).collect() == [] == O.block_product(left, right.where("false"), cell).collect()


def test_a_code_table_of_a_million_rows_stays_distributed(spark):
    codes = spark.range(1_000_000).toDF("code")
    got = O.spine_table(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), codes)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert [tuple(r) for r in got.groupBy("k").agg(F.count_distinct("code").alias("n"), F.count("code").alias("m")).orderBy("k").collect()] == [
        (k, 1_000_000, 1_000_000) for k in "abc"]


@pytest.mark.parametrize("descending", [False, True])
def test_ordered_texts_of_a_hot_group(spark, descending):
    chance = random.Random(2)
    data = [("hot" if i % 3 == 0 else f"g{i % 40}", chance.randrange(500) if i % 11 else None) for i in range(3000)]
    data += [(None, 5), (None, 7), ("nulls", None), ("nulls", None)]
    df = spark.createDataFrame(data, "k string, v int")
    want = {}
    for k, v in data:
        want.setdefault(k, []).append(v)
    want = {k: " ".join(map(str, sorted((v for v in own if v is not None), reverse=descending))) for k, own in want.items()}
    got = {r.k: r.t for r in O.ordered_texts(df, ["k"], "v", " ", "t", descending).collect()}
    assert got == want
    assert O.ordered_texts(df.where("false"), ["k"], "v", " ", "t").collect() == []


def test_an_open_period_makes_few_rows(spark):
    cal = spark.createDataFrame([(dt.datetime(2024, 1, 5), dt.datetime(9999, 12, 31))], "lo timestamp_ntz, hi timestamp_ntz")
    assert O.dyadic_blocks(cal, "lo", "hi").count() <= 2
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 4),), (dt.datetime(5000, 1, 1),)], "at timestamp_ntz")
    got = O.interval_join(ev, cal.withColumn("n", F.lit(1)), "at", "lo", "hi", ["n"]).collect()
    assert sorted((r["at"].year, r["n"]) for r in got) == [(2024, None), (5000, 1)]
    none = O.interval_join(ev, cal.where("false").withColumn("n", F.lit(1)), "at", "lo", "hi", ["n"])
    assert [r["n"] for r in none.collect()] == [None, None]


def test_ordered_concat_sorts_numbers_as_numbers(spark):
    df = spark.createDataFrame([(1, 9), (1, 10), (1, 2), (1, None)], "k int, v int")
    got = df.groupBy("k").agg(O.ordered_concat(F.col("v"), " ", descending=True).alias("t"))
    assert rows(got, "t") == [("10 9 2",)]


def test_replace_slice_is_idempotent_and_keeps_null_flags(spark):
    base = spark.createDataFrame([("SAL", 1), ("COL", 2), (None, 3)], "f string, v int")
    new = spark.createDataFrame([("SAL", 9)], "f string, v int")
    cond = F.col("f") == "SAL"
    once = O.replace_slice(base, cond, new)
    twice = O.replace_slice(once, cond, new)
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == {("SAL", 9), ("COL", 2), (None, 3)}


def test_update_from_touches_only_matches(spark):
    base = spark.createDataFrame([(1, "SAL", 5), (1, "COL", 6), (2, "SAL", 7)], "k int, f string, n int")
    new = spark.createDataFrame([(1, 99)], "k int, n int")
    assert rows(O.update_from(base, new, ["k"], "n", F.col("f") == "SAL"), "k", "f", "n") == [(1, "COL", 6), (1, "SAL", 99), (2, "SAL", 7)]


def test_unpivot_keeps_the_total(spark):
    df = spark.createDataFrame([(1, 5, 0), (2, None, -3)], "id int, a int, b int")
    got = O.unpivot_nonzero(df, ["id"], {"a": "A", "b": "B"}, "kind", "v")
    assert rows(got, "id", "kind", "v") == [(1, "A", 5), (2, "B", -3)]


def test_numbering_inside_a_hot_group(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("hot")).alias("k"), (F.lit(3000) - F.col("id")).alias("v"))
    got = O.number_within(df, ["k"], ["v"], F.floor(F.col("v") / 100), "n")
    want = df.selectExpr("k", "v", "row_number() over (partition by k order by v) as n")
    assert got.count() == 3000 and got.select("k", "v", "n").exceptAll(want).count() == 0


def test_numbering_gives_every_task_about_as_many_rows(spark, monkeypatch):
    monkeypatch.setattr("stakefold.operators.numbering.ROWS_A_TASK", 100)
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = O.number_within(rows, ["k"], ["id"], F.col("id"), "n")
    dealt = re.findall(r", (\d+)\), REPARTITION_BY_NUM", got._jdf.queryExecution().executedPlan().toString())
    assert dealt and set(dealt) == {"10"}
    assert all(r.n == r.id // 7 + 1 for r in got.collect())


def test_document_numbers_are_dense_and_ordered(spark):
    df = spark.createDataFrame([(i * 37 % 5000,) for i in range(500)], "id int").distinct()
    got = O.document_numbers(df, ["id"], "n", offset=5).orderBy("id").collect()
    assert [r.n for r in got] == list(range(6, 6 + len(got)))


def test_first_per_group(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 5, "e")], "k int, o int, v string")
    assert rows(O.first_per_group(df, ["k"], ["o"]), "k", "o", "v") == [(1, 2, "b"), (2, 5, "e")]


def test_exists_flag_never_multiplies(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(O.exists_flag(left, right, ["k"], "f"), "k", "f") == [(1, True), (2, False)]


def test_posting_rules_balance_and_skip_zero(spark):
    cells = spark.createDataFrame([("COL", 100), ("CAN", -140)], "flag string, x int").selectExpr("flag", "cast(x as decimal(22,2)) x")
    row = totals(cells, {"col": F.col("flag") == "COL", "can": F.col("flag") == "CAN", "none": F.col("flag") == "?"}, "x")
    rules = [
        Rule("A", 1, "Y8", "t", "col", "01"), Rule("B", 1, "Y8", "t", "col", "50"), Rule("C", 2, "Y8", "t", "none", "01"),
        Rule("D", 3, "YA", "t", "can", "40", key_neg="15"),
    ]
    got = number_documents(posting_rules(row, rules), first=7).orderBy("linecode").collect()
    assert [(r.linecode, r.sappostingkey, int(r.amount), r.docno) for r in got] == [("A", "01", 100, 7), ("B", "50", 100, 7), ("D", "15", 140, 8)]


def test_distinct_counts_equal_sets(spark):
    rng = random.Random(8)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, -40_000, -1, 0, 1, 32_768, 32_769, 10**12, rng.randrange(10**6)]),
             rng.choice([None, dt.date(1969, 12, 31), dt.date(2024, 1, rng.randrange(1, 29))]), rng.choice([None, "x", "é", str(rng.randrange(300))]))
            for _ in range(3000)]
    data += [("hot", i % 70_000, dt.date(2024, 2, 1), "t") for i in range(100_000)] + [("none", None, None, None)]
    df = spark.createDataFrame(data, "k string, id long, day date, word string")
    got = O.distinct_counts(O.dense_ids(df, "word", "word_id"), ["k"], {"ids": "id", "days": "day", "words": "word_id"}, n=F.count(F.lit(1)), top=F.max("id"))
    want = []
    for k in {r[0] for r in data}:
        own = [r for r in data if r[0] == k]
        sets = [{r[c] for r in own} - {None} for c in (1, 2, 3)]
        want.append((k, *map(len, sets), len(own), max(sets[0], default=None)))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert O.distinct_counts(df.where("false"), ["k"], {"ids": "id"}).collect() == []
    with pytest.raises(TypeError):
        O.distinct_counts(df, ["k"], {"words": "word"})


def test_dense_ids_are_dense(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "a", None, "c", "a", ""] * 50], "w string")
    got = {(r["w"], r["n"]) for r in O.dense_ids(df, "w", "n").collect()}
    assert len(got) == 5 and (None, None) in got and sorted(n for _, n in got if n) == [1, 2, 3, 4]
