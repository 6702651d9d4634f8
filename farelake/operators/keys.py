"""Dense surrogate keys without pulling a table into one task.

``row_number() over (order by ...)`` with no partition runs in a single task.
Here the rows are range-partitioned on the ordering columns and sorted within
each partition; every row is written, with its range and its position in the
range, to a table in the shared folder. That fixes the contents (the range
bounds come from a sample) and cuts the lineage. Each row's number is its
position plus the row count of all earlier ranges, and the counts read one
column of the written table. The offsets table has one row per range; that
is its size bound, and the reason it may be broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions.joins import bounded
from farelake.session import scratch_path


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def dense_keys(df: DataFrame, order_cols: Sequence[str | Column], key_col: str,
               offset: int | Column = 0, num_partitions: int | None = None,
               key_type: str = "bigint", group_cols: Sequence[str] = (),
               scratch: list[str] | None = None) -> DataFrame:
    """Number the rows 1..n (plus ``offset``) in the total order of ``order_cols``.

    With ``group_cols`` the numbering restarts at 1 (plus ``offset``) in each
    group, still in one range-partitioned pass: rows are ranged on the group
    and order columns, so a partition holds contiguous runs of groups and a
    large group spans several partitions.

    Rows that tie on the order columns get distinct numbers in an arbitrary
    order; for exact duplicates that is the same result. A row id is the last
    sort column, so a run of ties (however many) is split across ranges
    instead of landing in one task.

    The ranges are as many as ``spark.sql.shuffle.partitions`` (or
    ``num_partitions``); AQE merges small neighbours. Choosing them runs no
    job. The path of the numbering table is appended to ``scratch``, for the
    caller to remove once the result is written.
    """
    spark = df.sparkSession
    groups = list(group_cols)
    n = num_partitions
    order = _order([*groups, *order_cols]) + [F.col("_fl_tie")]
    # Without an explicit count AQE may merge adjacent small ranges; merged
    # ranges stay contiguous and in order, so the numbering still holds.
    tied = df.withColumn("_fl_tie", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(n, *order) if n else tied.repartitionByRange(*order))
    ranged = ranged.sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    placed = ranged.select(
        *[F.col(c) for c in df.columns],
        pid.alias("_fl_pid"),
        # The row's position in its sorted range.
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("_fl_pos"))
    path = scratch_path(spark, "numbering", uuid.uuid4().hex)
    if scratch is not None:
        scratch.append(path)
    placed.write.option("compression", "zstd").parquet(path)
    fixed = spark.read.schema(placed.schema).parquet(path)
    counts = fixed.groupBy("_fl_pid", *groups).agg(F.count(F.lit(1)).alias("_fl_n"),
                                                   F.min("_fl_pos").alias("_fl_first"))
    before = Window.partitionBy(*groups).orderBy("_fl_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("_fl_pid", *groups, "_fl_first",
                            F.coalesce(F.sum("_fl_n").over(before), F.lit(0)).alias("_fl_start"))
    # Without groups: one row per range, a bounded broadcast. With groups:
    # at most ranges + groups - 1 rows, broadcast after a checked count.
    offsets = bounded(offsets) if groups else F.broadcast(offsets)
    pos = F.col("_fl_pos") - F.col("_fl_first")
    start = offset if isinstance(offset, Column) else F.lit(offset)
    key = (start.cast("bigint") + F.col("_fl_start") + pos + 1).cast(key_type)
    return (fixed.join(offsets, ["_fl_pid", *groups])
                 .select(key.alias(key_col), *[F.col(c) for c in df.columns]))


def max_key(df: DataFrame, key_col: str) -> int:
    """Current maximum key, 0 for an empty table (one scalar to the driver)."""
    v = df.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0


def max_key_value(df: DataFrame, key_col: str) -> Column:
    """Current maximum key, 0 for an empty table, as a scalar subquery: it is
    computed inside the job that uses it, with no round trip of its own."""
    return df.agg(F.coalesce(F.max(key_col).cast("bigint"), F.lit(0).cast("bigint"))).scalar()
