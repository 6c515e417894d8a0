"""Exact money expressions.

Amounts are held in cents.  Dividing a wide decimal by 100 would round at
Spark's capped scale, so every helper cuts to whole cents first (an exact
operation) and only then moves the decimal point with a multiplication.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(22,2)"
FACTOR = "decimal(22,12)"
SUM_FACTOR = "decimal(32,12)"


def _hundredth() -> Column:
    return F.lit(Decimal("0.01"))


def dec(col: Column | str, kind: str = MONEY) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(kind)


def zero(kind: str = MONEY) -> Column:
    return F.lit(0).cast(kind)


def nz(col: Column | str, kind: str = MONEY) -> Column:
    """Null amount counts as nothing."""
    return F.coalesce(dec(col, kind), zero(kind))


def trunc_money(x: Column, scale: int = 2) -> Column:
    """Cut toward zero at ``scale`` digits (Spark's ``trunc`` is for dates)."""
    return F.when(x >= 0, F.floor(x, F.lit(scale))).otherwise(F.ceil(x, F.lit(scale)))


def round_money(x: Column, scale: int = 2) -> Column:
    """Round half away from zero; ``x`` must be a decimal."""
    return F.round(x, scale)


def dollars_trunc(cents: Column) -> Column:
    """``trunc(cents / 100, 2)`` without an inexact division."""
    whole = F.when(cents >= 0, F.floor(cents)).otherwise(F.ceil(cents))
    return (whole.cast("decimal(20,0)") * _hundredth()).cast(MONEY)


def dollars_round(cents: Column) -> Column:
    """``round(cents / 100, 2)`` without an inexact division."""
    return (F.round(cents, 0).cast("decimal(20,0)") * _hundredth()).cast(MONEY)


def cents_trunc(cents: Column) -> Column:
    """Cents to dollars, cut at two digits, back to cents."""
    whole = F.when(cents >= 0, F.floor(cents)).otherwise(F.ceil(cents))
    return whole.cast(MONEY)


def to_cents(dollars: Column) -> Column:
    return (dollars * F.lit(Decimal("100"))).cast("decimal(32,11)")


def half_if(cond: Column, x: Column) -> Column:
    """Halve an amount where ``cond`` holds (two-way bets count half)."""
    return F.when(cond, x * F.lit(Decimal("0.5"))).otherwise(x)


def signed(flag: Column, negative: list[str], x: Column) -> Column:
    return F.when(flag.isin(*negative), -x).otherwise(x)


def tax_exclusive(x: Column, rate: Column, kind: str = "decimal(32,11)") -> Column:
    """Base amount of a tax-inclusive one; ``rate`` is a fraction (0.09).

    The operand widths are chosen so that Spark keeps 14 digits of the quotient.
    """
    base = (x.cast("decimal(18,4)") * F.lit(Decimal("100"))).cast("decimal(22,4)")
    share = (F.lit(Decimal("100")) + rate.cast("decimal(6,4)") * F.lit(Decimal("100"))).cast("decimal(9,6)")
    return F.try_divide(base, share).cast(kind)


def tax_add(x: Column, percent: Column) -> Column:
    """Tax on a net amount, rounded to cents of a dollar; ``percent`` is 9 for 9%."""
    return F.round(x * percent * _hundredth(), 2).cast(MONEY)


COUNT = "decimal(20,0)"


def by_count(x: Column, n: Column, kind: str) -> Column:
    """An amount of up to twelve decimals times a count of rows, exact.

    A plain product of such widths would lose decimals to Spark's 38 digits, so the
    whole part and the rest are multiplied apart.  Most counts are one.
    """
    whole = F.floor(x)
    rest = (x - whole).cast("decimal(13,12)")
    scaled = (whole.cast(COUNT) * n.cast("decimal(17,0)")).cast("decimal(37,12)")
    return F.when(n == 1, x.cast(kind)).otherwise((scaled + (rest * n.cast("decimal(17,0)")).cast("decimal(37,12)")).cast(kind))


def safe_ratio(num: Column, den: Column, kind: str = "decimal(32,12)") -> Column:
    """``num / den`` with nothing for an empty group instead of an ANSI error."""
    return F.try_divide(num, den).cast(kind)
