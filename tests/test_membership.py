"""Histories reduced to keys in hand: no key is lost, hardly a stranger passes, and none is shuffled."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stakefold.operators import membership as S
from stakefold.operators import reduced, sifted
from stakefold.sources.tables import Tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.1")


@pytest.fixture
def no_broadcast(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


@pytest.mark.parametrize("kind", ["string", "bigint", "int", "decimal(20,2)", "date"])
def test_no_key_is_lost_and_few_strangers_pass(spark, kind):
    keys = spark.range(0, 9000, 3).select((F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")) if kind == "date"
                                           else F.col("id").cast(kind)).alias("k"))
    found = S.key_filter(keys, "k")
    every = spark.range(9000).select("id", (F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")) if kind == "date"
                                            else F.col("id").cast(kind)).alias("k"))
    passed = {r["id"] for r in every.where(found.test("k")).select("id").collect()}
    assert passed >= set(range(0, 9000, 3))
    assert len(passed) - 3000 < 0.03 * 6000


def test_size_follows_the_keys_up_to_a_bound(spark):
    assert S.words_for(0) == S.LEAST_WORDS and S.words_for(1 << 20) == 1 << 18 and S.words_for(1 << 40) == S.MOST_WORDS
    keys = spark.range(10).toDF("k")
    assert S.key_filter(keys, "k", count=1 << 40) is None
    assert S.key_filter(keys, "k").words == S.LEAST_WORDS


def test_filters_stay_small_for_the_driver(spark):
    """Every stage that tests a filter carries it, many times over in a plan of many joins on its key."""
    assert S.words_for(9_000_000) * 8 <= 2 << 20
    assert S.key_filter(spark.range(10).toDF("k"), "k", count=9_000_000) is None


def test_many_stored_keys_are_not_broadcast_for_their_small_file(spark, tmp_path):
    """Two million keys take 9 MB in Parquet and 160 MB in the hash table that the driver would build."""
    spark.range(2_000_000).select(F.concat(F.lit("H"), "id").alias("k")).write.parquet(f"{tmp_path}/keys")
    Tables.frames(spark, {})
    assert not S.fits_broadcast(spark.read.parquet(f"{tmp_path}/keys"))
    spark.range(100).select(F.concat(F.lit("H"), "id").alias("k")).write.parquet(f"{tmp_path}/few")
    assert S.fits_broadcast(spark.read.parquet(f"{tmp_path}/few"))


def test_null_repeated_and_no_keys(spark, no_broadcast):
    history = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    some = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "own string")
    assert sorted(r.v for r in reduced(history, some, "k", "own").collect()) == [1, 2]
    assert reduced(history, some.where("false"), "k", "own").collect() == []
    assert sifted(history, some.where("false"), "k", "own").where("k is not null").collect() == []


def test_keys_of_another_type_are_found(spark, no_broadcast):
    history = spark.range(1000).select(F.col("id").cast("int").alias("k"))
    keys = spark.createDataFrame([(5,), (900,)], "k bigint")
    assert sorted(r.k for r in reduced(history, keys, "k").collect()) == [5, 900]


def test_small_keys_are_left_to_a_broadcast(spark):
    history, keys = spark.range(1000).toDF("k"), spark.range(5).toDF("k")
    assert sifted(history, keys, "k") is history


def test_a_filter_is_tested_only_where_its_history_is_scanned(spark, no_broadcast, tmp_path):
    """Catalyst copied it to every side of the joins on the key; the driver then held one for each in a stage's code."""
    history = spark.range(1000).select(F.concat(F.lit("H"), "id").alias("k"), (F.col("id") % 5).alias("v"))
    keys = spark.range(0, 1000, 100).select(F.concat(F.lit("H"), "id").alias("k"))
    own, other = reduced(history, keys, "k").where("v = 0"), history.groupBy("k").count()
    out = own.join(other, "k").join(keys.withColumn("one", F.lit(1)), "k", "left")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery#") == 1
    assert out.count() == 10


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_no_stranger_leaves_the_scan(spark, no_broadcast):
    """The rows that the shuffle of the history writes, by its metric, are those of the keys and few more."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").where("o_custkey % 50 = 7")
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    out = reduced(lines, keys, "l_orderkey")
    matched = lines.join(keys, "l_orderkey").count()
    text = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter .*Subquery", text)
    assert len(out.collect()) == matched
    written = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange":
            written.append((node.metrics().apply("shuffleRecordsWritten").value(), "lineitem.parquet" in node.toString()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(out._jdf.queryExecution().executedPlan())
    history = [n for n, lines_side in written if lines_side]
    strangers = lines.count() - matched
    assert history and 0 <= history[0] - matched < 0.01 * strangers
