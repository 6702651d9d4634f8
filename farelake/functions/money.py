"""Aggregates with engine-independent results.

Sums of doubles depend on the order the partitions add up, so money is summed
as DECIMAL(18,2). Averages divide the exact decimal sum by the count and round
to 6 places. Values reported as NUMERIC(10,2) are rounded half away from zero
in integer cents, so no binary double is rounded at a half.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def sum_money(c: Column | str) -> Column:
    """Exact sum as DECIMAL(18,2)."""
    return F.sum(money(c)).cast(MONEY)


def sum_dec(c: Column | str) -> Column:
    """Exact sum, wide decimal; for partial sums that are summed again."""
    return F.sum(money(c))


def avg_of(sum_col: Column, count_col: Column) -> Column:
    """An average from an exact sum and a count, rounded to 6 places."""
    return F.round(sum_col.cast("double") / count_col, 6)


def avg_money(c: Column | str) -> Column:
    """Average of a money (or whole-number) column, rounded to 6 places."""
    c = F.col(c) if isinstance(c, str) else c
    return avg_of(F.sum(money(c)), F.count(c))


def cents(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def half_up_div(a: Column, b: Column) -> Column:
    """Integer a / b rounded half away from zero, for b > 0."""
    n = F.abs(a) * 2 + b
    # n - n % 2b is a multiple of 2b, so the division is exact.
    q = ((n - n % (b * 2)) / (b * 2)).cast("bigint")
    return F.when(a < 0, -q).otherwise(q)


def cents_to_numeric(c: Column, precision: int = 10) -> Column:
    """Whole cents as NUMERIC(precision, 2)."""
    return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(
        f"decimal({precision},2)")


def avg_numeric(c: Column | str, precision: int = 10) -> Column:
    """AVG(c)::numeric(precision,2) without a double in between."""
    c = F.col(c) if isinstance(c, str) else c
    return cents_to_numeric(half_up_div(F.sum(cents(c)), F.count(c)), precision)


def sum_numeric(c: Column | str, precision: int = 18) -> Column:
    """SUM(c)::numeric(precision,2)."""
    return F.sum(money(c)).cast(f"decimal({precision},2)")
