"""Joins the settlement jobs share.

No join here carries a broadcast hint.  Range joins get an equality key (a day
bucket) so that Catalyst may pick a broadcast hash join when the dimension is
measured to be small and a sort-merge join, with AQE skew splitting, when not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day_number(day: Column) -> Column:
    return F.date_diff(F.to_date(day), F.lit(dt.date(1970, 1, 1)))


def dyadic_blocks(calendar: DataFrame, lo: str, hi: str, level: str = "_level", block: str = "_block") -> DataFrame:
    """Every period with the one or two aligned blocks of 2^level days that hold it, whatever its length.

    The level is the least whose blocks are longer than the period reaches, so a day and
    a period that is open to the year 9999 both give two rows at most.  Rows without bounds match nothing."""
    first, last = _day_number(F.col(lo)), _day_number(F.col(hi))
    reach = last - first
    known = calendar.where(F.col(lo).isNotNull() & (F.col(lo) <= F.col(hi)))
    known = known.withColumn(level, F.when(reach == 0, 0).otherwise(F.floor(F.log2(reach)).cast("int") + 1))
    ends = [F.call_function("shiftright", n, F.col(level)) for n in (first, last)]
    return known.withColumn(block, F.explode(F.array_distinct(F.array(*ends))))


def interval_join(
    events: DataFrame,
    calendar: DataFrame,
    ts: str,
    lo: str,
    hi: str,
    keep: Sequence[str],
    on: Sequence[tuple[str, str]] = (),
    how: str = "left",
    ends: str = "both",
) -> DataFrame:
    """Attach the calendar rows whose period holds each event's time.

    ``on`` pairs (event column, calendar column) that must also be equal.  With
    closed ends an event on a shared edge matches both periods, as specified.

    An event looks up one block per level that the calendar has.  Periods of like length
    are of one level, and the lookup is a join.  With more levels, the periods of a block
    become one value and the event unfolds those that hold it, so it stays one row until all
    levels are looked up.  Only the list of levels, 23 at most, reaches the driver.
    """
    names = {c: f"_cal_{c}" for c in {lo, hi, *keep, *[c for _, c in on]}}
    cal = dyadic_blocks(calendar, lo, hi).select("_level", "_block", *[F.col(c).alias(n) for c, n in names.items()])
    levels = sorted(r["_level"] for r in cal.select("_level").distinct().collect()) or [0]
    t, day = F.col(ts), _day_number(F.col(ts))
    out = [F.col(names[c]).alias(c) for c in keep]

    def inside(a: Column, b: Column) -> Column:
        return (t >= a) & ((t <= b) if ends == "both" else (t < b))

    def same_block(level: int, block: str) -> Column:
        cond = F.shiftright(day, level) == F.col(block)
        for ev, ca in on:
            cond = cond & (F.col(ev) == F.col(names[ca]))
        return cond

    if len(levels) == 1:
        cond = same_block(levels[0], "_block") & inside(F.col(names[lo]), F.col(names[hi]))
        return events.join(cal.drop("_level"), cond, how).select(*[events[c] for c in events.columns], *out)
    joined, found = events, []
    fields = dict.fromkeys([lo, hi, *keep])
    for level in levels:
        by = [F.col("_block").alias(f"_block_{level}"), *[F.col(names[c]) for _, c in on]]
        one = cal.where(F.col("_level") == level).groupBy(*by).agg(
            F.collect_list(F.struct(*[F.col(names[c]) for c in fields])).alias(f"_periods_{level}"))
        joined = joined.join(one, same_block(level, f"_block_{level}"), "left").drop(f"_block_{level}", *[names[c] for _, c in on])
        found.append(F.filter(F.col(f"_periods_{level}"), lambda p: inside(p[names[lo]], p[names[hi]])))
    every = F.flatten(F.filter(F.array(*found), lambda p: p.isNotNull()))
    unfold = F.inline_outer if how == "left" else F.inline
    return joined.select(*events.columns, unfold(every)).select(*events.columns, *out)


LAST_DAY = dt.date(9999, 12, 31)


def _decade(day: Column) -> Column:
    return F.floor(F.year(day) / 10).cast("int")


def validity_join(
    facts: DataFrame,
    history: DataFrame,
    day: str,
    start: str,
    end: str,
    keep: Sequence[str],
    on: Sequence[tuple[str, str]] = (),
    how: str = "inner",
) -> DataFrame:
    """Join facts to the history rows valid on their day (a null end is open).

    With an entity key the range test rides on the equality join.  Without one,
    the history is spread over the decades it touches, the decade is the equality
    key and the range a residual.  The history is its own small table, so Catalyst
    sees its size, and the facts are read once and stay where they are.
    """
    fields = list(dict.fromkeys([start, end, *keep, *[c for _, c in on]]))
    h = history.select(*[F.col(c).alias(f"_h_{c}") for c in fields])

    def valid(d: Column) -> Column:
        return (d >= F.col(f"_h_{start}")) & (F.col(f"_h_{end}").isNull() | (d <= F.col(f"_h_{end}")))

    out = [F.col(f"_h_{c}").alias(c) for c in keep]
    if on:
        cond = valid(F.col(day))
        for f, c in on:
            cond = cond & (F.col(f) == F.col(f"_h_{c}"))
        return facts.join(h, cond, how).select(*[facts[c] for c in facts.columns], *out)
    first, last = F.col(f"_h_{start}"), F.coalesce(F.col(f"_h_{end}"), F.lit(LAST_DAY))
    spread = h.where(first <= last).withColumn("_decade", F.explode(F.sequence(_decade(first), _decade(last))))
    joined = facts.join(spread, (_decade(facts[day]) == F.col("_decade")) & valid(facts[day]), how)
    return joined.select(*[facts[c] for c in facts.columns], *out)


def spine_of(dimension: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Every dimension row once per literal value.

    ``values`` is a short code list, so this is a row generator inside the scan
    stage, not a join.
    """
    return dimension.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


UNFOLDED = 4096  # code rows that one value may hold
CELL_ROWS = 1 << 16


def spine_table(dimension: DataFrame, codes: DataFrame) -> DataFrame:
    """Every dimension row once per row of a code table.

    A short code table is gathered into one array (a scalar subquery) that every
    dimension row unfolds, so neither side is dealt out anew and there is no join.  The rows are
    counted as they are gathered, one more than allowed at most; a longer table meets the dimension in
    blocks, both sides distributed (``block_product``).
    """
    if codes.limit(UNFOLDED + 1).count() > UNFOLDED:
        return block_product(dimension, codes)
    listed = codes.agg(F.collect_list(F.struct(*codes.columns))).scalar()
    return dimension.withColumn("_codes", listed).select(*dimension.columns, F.inline("_codes"))


def block_product(left: DataFrame, right: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Every row of one side with every row of the other, as an equality join of blocks.

    Each side is dealt by a hash of its rows to as many blocks as it has rows for, and each
    block meets all blocks of the other side in a cell of its own.  So a row is copied once per
    block of the other side, a cell holds about the rows of one block of each (equal rows
    share a block), and nothing passes the driver but the two counts.
    """
    sides = {"_left": left, "_right": right}
    blocks = {name: max(1, -(-df.count() // cell_rows)) for name, df in sides.items()}
    dealt = []
    for own, other in (("_left", "_right"), ("_right", "_left")):
        df = sides[own]
        block = F.pmod(F.xxhash64(*df.columns), F.lit(blocks[own])).cast("int")  # the same again if a task is
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks[other] - 1)))
        dealt.append(df.select("*", block.alias(own)).select("*", every.alias(other)))
    return dealt[0].join(dealt[1], ["_left", "_right"]).select(*[dealt[0][c] for c in left.columns], *[dealt[1][c] for c in right.columns])


def code_table(rows: Sequence[tuple], ddl: str) -> Column:
    """A short literal table as one array column (to be inlined); a value that does not fit its type fails."""

    def sql(value, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"CAST('{text}' AS {kind})"

    fields = [part.split() for part in ddl.split(", ")]
    one = ["named_struct(" + ", ".join(f"'{n}', {sql(v, k)}" for (n, k), v in zip(fields, r, strict=True)) + ")" for r in rows]
    return F.expr(f"array({', '.join(one)})")


def spine_join(spine: DataFrame, measures: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every spine row kept; measures attached where they exist."""
    return spine.join(measures, list(on), "left")


def spine_measures(
    dimension: DataFrame, codes: DataFrame, measures: Sequence[DataFrame], key: str, on: Sequence[str]
) -> DataFrame:
    """Every dimension row once per row of a code table (``spine_table``), each of the measures attached where it exists
    (``spine_join``): by the dimension's ``key`` and the code table's columns ``on``.

    With a short code table only the dimension's rows are dealt out.  Of a measure all rows of a key become one map from
    the code, no longer than the code table and its repeats; a dimension row meets the maps, and looks each code up as it
    unfolds the table.  A longer table is unfolded first and then joined.
    """
    if codes.limit(UNFOLDED + 1).count() > UNFOLDED:
        rows = block_product(dimension, codes)
        for m in measures:
            rows = spine_join(rows, m, [key, *on])
        return rows
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    code = F.col(on[0]) if len(on) == 1 else F.struct(*on)
    listed = codes.agg(F.collect_list(F.struct(*codes.columns))).scalar()
    whole, values = dimension, []
    for i, m in enumerate(measures):
        values.append([c for c in m.columns if c not in (key, *on)])
        per_code = m.where(known & F.col(key).isNotNull()).groupBy(key, code.alias("_code")).agg(
            F.collect_list(F.struct(*values[i])).alias("_rows"))
        held = per_code.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_code", "_rows"))).alias(f"_held{i}"))
        whole = whole.join(held, key, "left")
    rows = whole.withColumn("_codes", listed)
    done = [*dimension.columns]
    rows = rows.select(*done, *[f"_held{i}" for i in range(len(measures))], F.inline("_codes"))
    done += codes.columns
    for i in range(len(measures)):
        rest = [f"_held{j}" for j in range(i + 1, len(measures))]
        found = F.when(known, F.try_element_at(f"_held{i}", code))
        rows = rows.select(*done, *rest, F.inline_outer(found))
        done += values[i]
    return rows


def net_debit_credit(
    rows: DataFrame, keys: Sequence[str], debit: Column, credit: Column, amount: str, out: str = "amount"
) -> DataFrame:
    """Debit minus credit per key, a missing side counting as nothing.

    A full outer join of two aggregates over one input is the same as one
    conditional aggregate, which needs a single shuffle and no join.
    """
    x = F.col(amount)
    return (
        rows.where(debit | credit)
        .groupBy(*keys)
        .agg(
            (
                F.coalesce(F.sum(F.when(debit, x)), F.lit(0)) - F.coalesce(F.sum(F.when(credit, x)), F.lit(0))
            ).alias(out)
        )
    )


def exists_flag(left: DataFrame, right: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Left rows with a boolean: does any right row share the key?"""
    keys = right.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(keys, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def host_window_filter(product: Column, ts: Column, windows: Sequence[tuple[Sequence[int], Column, Column]], ends: str):
    """OR over hosts of (product in the host's set AND time in the host's window)."""
    cond = F.lit(False)
    for products, lo, hi in windows:
        inside = (ts >= lo) & ((ts <= hi) if ends == "both" else (ts < hi))
        cond = cond | (product.isin(*products) & inside)
    return cond
