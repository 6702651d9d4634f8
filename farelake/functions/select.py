"""The k smallest values of a 60-bit column, without a sort.

A radix histogram: the values are counted by their top 15 bits (one partial
aggregate, at most 32,768 rows), the running count over that table names the
bucket that holds the k-th value, and the next pass counts only that bucket by
its next 15 bits. Four passes at most name the value exactly; a bucket of a
few values is read instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 60
DIGIT = 15
FEW = 10_000


def hash60(*parts: Column | str) -> Column:
    """60 bits of an md5 of the parts' text, joined by ``|`` (a null is ``None``)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("None")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def kth_smallest(df: DataFrame, col: str, k: int, few: int = FEW) -> tuple[int, int, int]:
    """(value, below, equal): the k-th smallest of a column of 60-bit values (1 <= k <= rows),
    and how many values are smaller than it and equal to it."""
    prefix, below, shift = 0, 0, BITS
    v, inside = F.col(col), df.select(col)
    while shift:
        shift -= DIGIT
        digit = F.shiftright(v, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        # At most 2^15 rows: the running count is a window over a bounded table.
        counts = inside.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        run = F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        at = (counts.withColumn("upto", run).where(F.col("upto") >= k - below).orderBy("digit").limit(1).first())
        below += at.upto - at.n
        prefix = (prefix << DIGIT) | at.digit
        inside = df.select(col).where(F.shiftright(v, shift) == prefix)
        if at.n <= few and shift:
            values = sorted(r[0] for r in inside.collect())   # at most ``few`` numbers
            value = values[k - below - 1]
            return value, below + values.index(value), values.count(value)
    return prefix, below, at.n
