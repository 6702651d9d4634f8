"""Rollups of the facts that are kept per month file.

Each load stores, beside the facts of its month files, their partial sums: per
hour or day of pickup and per dimension keys the number of trips, and of every
measure the exact sum and the count of its values. Partials of any two months
(or hours, or keys) add up to those of both, so a report over the rollup is the
report over the facts, and a month that is loaded again brings its new
partials with it: nothing else is recomputed.

There are three cubes in one table, so that the rollup stays small: ``mix`` by
hour, vendor, rate code, payment type and passengers, ``pickup`` by day and
pickup location, and ``dropoff`` by day and dropoff location. A trip is in each
cube once. All three come from one scan and one shuffle: the facts are dealt by
month file and day, and a row is then spread to its three cells and combined. A
window of days is a filter on the cell's time, which is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions import money as M

MEASURES = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
KEYS = {"mix": ("vendor_key", "rate_code_key", "payment_type_key", "passenger_count"),
        "pickup": ("pu_location_key",), "dropoff": ("do_location_key",)}
GRAIN = {"mix": "hour", "pickup": "day", "dropoff": "day"}
ALL_KEYS = tuple(k for keys in KEYS.values() for k in keys)
SUM = T.DecimalType(28, 2)   # a sum of DECIMAL(18,2) values

ROLLUP = T.StructType(
    [T.StructField("cube", T.StringType()), T.StructField("pickup_ts", T.TimestampNTZType())]
    + [T.StructField(k, T.IntegerType()) for k in ALL_KEYS]
    + [T.StructField("_n", T.LongType())]
    + [f for m in MEASURES for f in (T.StructField(f"_s_{m}", SUM), T.StructField(f"_c_{m}", T.LongType()))]
    + [T.StructField("source_file", T.StringType())])


# Rows of a task of the rollup: a trip takes about 2 KB there, for its three cells in hash tables. The
# shuffled rows are narrow, so ranges made by their bytes would hold many times as many and spill.
ROWS_PER_TASK = 200_000


def rollup(facts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The partial sums of some facts, by month file."""
    n, cores = -(-facts.count() // rows_per_task), facts.sparkSession.sparkContext.defaultParallelism
    ranges = [max(n, cores)] if n > 1 else []   # few rows: as many as Spark makes
    cells = F.explode(F.array(*[F.struct(
        F.lit(cube).alias("cube"), F.date_trunc(GRAIN[cube], "pickup_ts").cast("timestamp_ntz").alias("pickup_ts"),
        *[(F.col(k) if k in keys else F.lit(None)).cast("int").alias(f"_k_{k}") for k in ALL_KEYS])
        for cube, keys in KEYS.items()])).alias("cell")
    # Amounts are made exact and the narrow rows are dealt by month file and day before they are spread:
    # a range of days holds all the rows of its cells, so one shuffle serves both the sums and the files.
    day = F.date_trunc("day", "pickup_ts").alias("_day")
    narrow = [c for c in ("pickup_ts", *ALL_KEYS) if c not in MEASURES]
    dealt = facts.select("source_file", day, *narrow, "passenger_count",
                         *[M.money(m).alias(f"_m_{m}") for m in MEASURES],
                         *[F.col(m).isNotNull().alias(f"_has_{m}") for m in MEASURES]
                         ).repartitionByRange(*ranges, "source_file", "_day")
    rows = dealt.select("source_file", "_day", *[f"{p}_{m}" for m in MEASURES for p in ("_m", "_has")], cells)
    keys = ["source_file", "_day", F.col("cell.cube").alias("cube"), F.col("cell.pickup_ts").alias("pickup_ts"),
            *[F.col(f"cell._k_{k}").alias(f"_k_{k}") for k in ALL_KEYS]]
    sums = [F.count(F.lit(1)).alias("_n")]
    for m in MEASURES:
        sums += [F.sum(f"_m_{m}").cast(SUM).alias(f"_s_{m}"), F.count_if(f"_has_{m}").alias(f"_c_{m}")]
    out = rows.groupBy(*keys).agg(*sums)
    return out.withColumnsRenamed({f"_k_{k}": k for k in ALL_KEYS}).select(*ROLLUP.fieldNames())


def cube_for(keys: list[str]) -> str | None:
    """The cube that has all the keys; without keys the hourly one."""
    return next((cube for cube, have in KEYS.items() if set(keys) <= {*have, "source_file"}), None)
