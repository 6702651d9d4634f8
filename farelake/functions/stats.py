"""Exact quantiles that stay distributed.

``percentile`` gathers every value of a group into one task. Here the values
are first reduced to a histogram (value, count) with map-side combining, the
histogram is range-partitioned by value, running counts are computed per range
and offset by the totals of earlier ranges, and each requested rank is found
with a range lookup against a table of at most two rows per probability.
Interpolation is linear at position p * (n - 1), as in ``percentile`` and
DuckDB's ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.session import checkpoint_base


def value_ranks(df: DataFrame, col: str, num_partitions: int | None = None) -> DataFrame:
    """(v, c, lo, hi): each distinct non-null value with its count and the
    0-based rank range [lo, hi) it covers in sorted order."""
    spark = df.sparkSession
    checkpoint_base(spark)
    n = num_partitions  # None: default count, coalesced by AQE
    hist = (df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
              .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    ranged = (hist.repartitionByRange(n, "v") if n else hist.repartitionByRange("v"))
    ranged = ranged.sortWithinPartitions("v").checkpoint(eager=True)
    tagged = ranged.select("v", "c", F.spark_partition_id().alias("_pid"))
    totals = tagged.groupBy("_pid").agg(F.sum("c").alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = tagged.select("v", "c", "_pid", F.sum("c").over(within).alias("_cum"))
    # offsets has one row per partition: bounded broadcast.
    return run.join(F.broadcast(offsets), "_pid").select(
        "v", "c", (F.col("_off") + F.col("_cum") - F.col("c")).alias("lo"),
        (F.col("_off") + F.col("_cum")).alias("hi"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, ndigits: int | None = 6) -> DataFrame:
    """One row with one column per probability (null when there are no values)."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    spark = df.sparkSession
    ranks = value_ranks(df, col)
    total = ranks.agg(F.coalesce(F.sum("c"), F.lit(0))).scalar()  # a scalar subquery
    targets = spark.createDataFrame([(i, float(p)) for i, p in enumerate(probs)], "i int, p double")
    t = (targets.select("i", (F.col("p") * (total - 1)).alias("pos"), total.alias("n"))
         .where(F.col("n") > 0)
         .select("i", "pos", F.floor("pos").cast("bigint").alias("r_lo"),
                 F.ceil("pos").cast("bigint").alias("r_hi")))
    pick = t.select("i", "pos", F.col("r_lo").alias("r"), F.lit(0).alias("side")).unionByName(
        t.select("i", "pos", F.col("r_hi").alias("r"), F.lit(1).alias("side")))
    # At most 2 * |probs| rows on the broadcast side of a range lookup.
    hit = ranks.join(F.broadcast(pick), (F.col("lo") <= F.col("r")) & (F.col("r") < F.col("hi")))
    per = hit.groupBy("i").agg(
        F.first("pos").alias("pos"),
        F.max(F.when(F.col("side") == 0, F.col("v"))).alias("v_lo"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("v_hi"))
    val = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.floor("pos"))
    if ndigits is not None:
        val = F.round(val, ndigits)
    per = per.select("i", val.alias("q"))
    row = targets.select("i").join(per, "i", "left").agg(
        *[F.max(F.when(F.col("i") == k, F.col("q"))).alias(nm) for k, nm in enumerate(names)])
    return row


def multi_value_ranks(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None
                      ) -> DataFrame:
    """``value_ranks`` for several columns in one pass: (column, v, c, lo, hi).

    One histogram over (column, value) pairs, one range partitioning and one
    checkpoint; running counts restart per column. The offsets table has one
    row per (partition, column): bounded by partitions x columns.
    """
    spark = df.sparkSession
    checkpoint_base(spark)
    n = num_partitions  # None: default count, coalesced by AQE
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                for c in cols])).alias("p")
    hist = (df.select(pairs).select("p.column", "p.v").where(F.col("v").isNotNull())
              .groupBy("column", "v").agg(F.count(F.lit(1)).alias("c")))
    ranged = (hist.repartitionByRange(n, "column", "v") if n
              else hist.repartitionByRange("column", "v"))
    ranged = ranged.sortWithinPartitions("column", "v").checkpoint(eager=True)
    tagged = ranged.select("column", "v", "c", F.spark_partition_id().alias("_pid"))
    totals = tagged.groupBy("column", "_pid").agg(F.sum("c").alias("_t"))
    before = Window.partitionBy("column").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column", "_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_pid", "column").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = tagged.select("column", "v", "c", "_pid", F.sum("c").over(within).alias("_cum"))
    return run.join(F.broadcast(offsets), ["column", "_pid"]).select(
        "column", "v", "c", (F.col("_off") + F.col("_cum") - F.col("c")).alias("lo"),
        (F.col("_off") + F.col("_cum")).alias("hi"))


def exact_quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                         names: Sequence[str], ndigits: int | None = 6) -> DataFrame:
    """Exact quantiles of several columns in one pass: one row per column with
    one field per probability (null for a column without values)."""
    spark = df.sparkSession
    ranks = multi_value_ranks(df, cols)
    totals = ranks.groupBy("column").agg(F.sum("c").alias("n"))
    targets = spark.createDataFrame([(c, i, float(p)) for c in cols for i, p in enumerate(probs)],
                                    "column string, i int, p double")
    t = (targets.join(F.broadcast(totals), "column")  # |cols| x |probs| rows
         .select("column", "i", (F.col("p") * (F.col("n") - 1)).alias("pos"))
         .select("column", "i", "pos", F.floor("pos").cast("bigint").alias("r_lo"),
                 F.ceil("pos").cast("bigint").alias("r_hi")))
    pick = t.select("column", "i", "pos", F.col("r_lo").alias("r"), F.lit(0).alias("side")).unionByName(
        t.select("column", "i", "pos", F.col("r_hi").alias("r"), F.lit(1).alias("side")))
    hit = ranks.join(F.broadcast(pick), ["column"]).where(
        (F.col("lo") <= F.col("r")) & (F.col("r") < F.col("hi")))
    per = hit.groupBy("column", "i").agg(
        F.first("pos").alias("pos"),
        F.max(F.when(F.col("side") == 0, F.col("v"))).alias("v_lo"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("v_hi"))
    val = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.floor("pos"))
    if ndigits is not None:
        val = F.round(val, ndigits)
    per = per.select("column", "i", val.alias("q"))
    cols_df = spark.createDataFrame([(c,) for c in cols], "column string")
    return cols_df.join(per, "column", "left").groupBy("column").agg(
        *[F.max(F.when(F.col("i") == k, F.col("q"))).alias(nm) for k, nm in enumerate(names)])
