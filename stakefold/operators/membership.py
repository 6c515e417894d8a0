"""Histories reduced to the keys in hand, where they are scanned.

A join with keys that fit a broadcast leaves the history where it lies.  Beyond that size both sides would be dealt
out, all of the history with them.  So the keys are then condensed to a Bloom filter first: words of 64 bits, made by
``bit_or`` in a grouping, gathered into one array (a scalar subquery) and tested in the scan's own filter.  Only rows
that pass are shuffled; the join that follows takes out the false positives.  The filter is sized from the number of
keys, up to a bound; a filter that full is of no use any more and is left out, and the join does it all.  The bound is
low because the driver holds the filter and puts it into the code of every stage that tests it.  Catalyst would repeat
the test on all sides of the joins on its key, as often as the key occurs, and the filter with it.  It leaves conditions
alone that are not deterministic, so ``sifted`` makes its test look like one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 3  # bits that a key sets in its word
BITS_PER_KEY = 16
LEAST_WORDS, MOST_WORDS = 1 << 7, 1 << 18  # 2 MB at most
USELESS_BITS_PER_KEY = 4


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter over one column: an array of words as a subquery, and the type its keys have."""

    table: Column
    words: int
    kind: str

    def test(self, key: Column | str) -> Column:
        """Whether a value can be one of the keys; never false for one that is.  Nulls may pass."""
        return self._missing(key) == 0

    def test_here(self, key: Column | str) -> Column:
        """The same, but only where it is written: the partition's number, which is never negative, keeps it there."""
        return self._missing(key) == F.when(F.spark_partition_id() >= 0, 0)

    def _missing(self, key: Column | str) -> Column:
        h = F.xxhash64((F.col(key) if isinstance(key, str) else key).cast(self.kind))
        return F.bitwise_not(F.get(self.table, _word(h, self.words))).bitwiseAND(_mask(h))


def _word(h: Column, words: int) -> Column:
    """The leading bits choose the word, the last ones the bits in it."""
    return F.shiftrightunsigned(h, 64 - (words.bit_length() - 1)).cast("int")


def _mask(h: Column) -> Column:
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def words_for(keys: int) -> int:
    """Words of a filter for so many keys: a power of two with at least 16 bits a key, up to the bound."""
    needed = max(1, -(-keys * BITS_PER_KEY // 64))
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << (needed - 1).bit_length()))


def key_filter(
    keys: DataFrame, column: str, count: int | None = None, hold: Callable[[DataFrame], DataFrame] | None = None
) -> KeyFilter | None:
    """A filter of the column's values; None if there are too many for one of the largest size.  ``hold`` stores the one
    row of the filter; without it every job that tests the filter makes it anew."""
    count = keys.count() if count is None else count
    words = words_for(count)
    if words * 64 < count * USELESS_BITS_PER_KEY:
        return None
    h = F.xxhash64(column)
    marked = keys.where(F.col(column).isNotNull()).groupBy(_word(h, words).alias("w")).agg(F.bit_or(_mask(h)).alias("b"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("w")).join(marked, "w", "left")
    filled = F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))))
    row = every.agg(F.transform(filled, lambda s: s["b"]).alias("t"))
    return KeyFilter((row if hold is None else hold(row)).scalar(), words, dict(keys.dtypes)[column])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst will take the frame as small enough to hand to every task."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


FilterOf = Callable[[DataFrame, str], KeyFilter | None]


def sifted(
    history: DataFrame, keys: DataFrame, key: str, own: str | None = None, filter_of: FilterOf | None = None
) -> DataFrame:
    """The history for a join with keys (a stored table) on ``key``: as it is where the keys can be broadcast, else
    without the rows that a filter of the keys excludes.  ``own`` is the keys' name of the column, ``filter_of`` a
    source of filters that are made once and kept."""
    named = own or key
    if fits_broadcast(keys.select(named)):
        return history
    found = key_filter(keys.select(named), named) if filter_of is None else filter_of(keys, named)
    return history if found is None else history.where(found.test_here(key))


def reduced(
    history: DataFrame, keys: DataFrame, key: str, own: str | None = None, filter_of: FilterOf | None = None
) -> DataFrame:
    """The rows of a history whose key is among the keys, each once."""
    named = own or key
    return sifted(history, keys, key, own, filter_of).join(keys.select(F.col(named).alias(key)), key, "left_semi")
