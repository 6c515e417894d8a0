"""Ledger postings from rules.

A rule names a total and says how it is posted.  All totals come from one
conditional aggregate; the rules are then spread over that single row, so
posting a hundred lines costs one pass over the cells and no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import code_table

AMOUNT = "decimal(22,2)"


@dataclass(frozen=True)
class Rule:
    """One posting line of a document.

    ``measure`` is the posted total and ``base`` the tax base, both names of
    totals.  ``key_neg`` is the posting key of a negative total; such a line is
    posted with its absolute amount.  Without it the amount keeps its sign.
    """

    code: str
    group: int
    doc_type: str
    text: str
    measure: str
    key: str
    key_neg: str | None = None
    account: str = ""
    gl: str = ""
    tax_code: str = ""
    base: str | None = None
    cost_centre: str = ""
    product: str = ""


_RULE_DDL = {f: "int" if f == "group" else "string" for f in Rule.__dataclass_fields__}

LINE_COLUMNS = [
    "grp", "local_no", "linecode", "sapdoctype", "sappostingkey", "sapcontrolacctcode", "linetext", "glnumber",
    "saptaxcode", "taxbase", "cccode", "amount", "product", "customer",
]


def line(
    group: Column, local_no: Column, code: Column, doc_type: Column, key: Column, account: Column, text: Column,
    gl: Column, tax_code: Column, base: Column, cost_centre: Column, amount: Column, product: Column, customer: Column,
) -> list[Column]:
    kinds = {"grp": "int", "local_no": "long", "taxbase": AMOUNT, "amount": AMOUNT}
    values = [group, local_no, code, doc_type, key, account, text, gl, tax_code, base, cost_centre, amount, product, customer]
    return [v.cast(kinds.get(n, "string")).alias(n) for n, v in zip(LINE_COLUMNS, values)]


def totals(cells: DataFrame, conditions: Mapping[str, Column], amount: str) -> DataFrame:
    """One row with every named total (a conditional sum, nothing counts as zero)."""
    x = F.col(amount)
    zero = F.lit(0).cast(AMOUNT)
    return cells.agg(
        *[F.coalesce(F.sum(F.when(c, x)), zero).cast(AMOUNT).alias(name) for name, c in conditions.items()]
    )


def posting_rules(total_row: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Spread the totals over the rules; lines whose total is zero are not posted."""
    names = sorted({n for r in rules for n in (r.measure, r.base) if n})
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast(AMOUNT))])
    table = code_table([tuple(getattr(r, f) for f in _RULE_DDL) for r in rules], ", ".join(f"{f} {k}" for f, k in _RULE_DDL.items()))
    rows = total_row.select(values.alias("_totals"), F.inline(table))
    x = F.col("_totals")[F.col("measure")]
    two_sided = F.col("key_neg").isNotNull()
    key = F.when(two_sided & (x < 0), F.col("key_neg")).otherwise(F.col("key"))
    lines = rows.select(
        *line(
            F.col("group"), F.lit(1), F.col("code"), F.col("doc_type"), key, F.col("account"), F.col("text"), F.col("gl"),
            F.col("tax_code"), F.try_element_at("_totals", F.col("base")), F.col("cost_centre"),
            F.when(two_sided, F.abs(x)).otherwise(x), F.col("product"), F.lit(""),
        )
    )
    return lines.where(F.col("amount") != 0)


def number_documents(lines: DataFrame, first: int = 1) -> DataFrame:
    """Document numbers in group order; a group takes as many numbers as its highest ``local_no``.

    Only the list of groups, which the rules bound, is put in order.
    """
    ahead = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lines.groupBy("grp").agg(F.max("local_no").alias("_width"))
        .withColumn("_before", F.coalesce(F.sum("_width").over(ahead), F.lit(0)))
        .select("grp", "_before")
    )
    return lines.join(starts, "grp").withColumn("docno", F.col("_before") + F.col("local_no") + F.lit(first - 1)).drop(
        "_before"
    )
