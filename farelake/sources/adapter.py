"""Test adapters: the driver's TPC-H-like tables re-shaped into trip records and a
zone lookup, so every query reads the given tables and grows with them.

The rules are those of FIXTURES.md sections 6 and 7. Money is derived in
integer cents, since rounding binary doubles at a half differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.joins import bounded, fits_all
from farelake.functions.text import month_file_name


# The driver tables the adapters read.
INPUT_TABLES = ("lineitem", "orders", "part", "nation", "region")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _trunc_div(a: Column, b: int) -> Column:
    """(a - a % b) / b as a bigint, the fixture's exact integer division."""
    return ((a - a % F.lit(b)) / F.lit(b)).cast("bigint")


def hundredths(c: Column) -> Column:
    """``round(c * 100)`` as a bigint, halves away from zero, in plain arithmetic: the row rules
    are pushed down to the scan and there repeat this for every mention of an amount, and
    ``round`` goes through a decimal object each time."""
    return (F.signum(c) * F.floor(F.abs(c * 100) + 0.5)).cast("bigint")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trip per lineitem; nulls are planted by the fixture rules."""
    line = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
        "l_shipdate", "l_extendedprice", "l_discount", "l_tax")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority")
    b = line.join(orders, line.l_orderkey == orders.o_orderkey, "inner").select(
        "*",
        hundredths(F.col("l_extendedprice")).alias("px"),
        hundredths(F.col("l_discount")).alias("dp"),
        hundredths(F.col("l_tax")).alias("tp"),
    )
    c = b.withColumn("fare_c", _trunc_div(F.col("px"), 350))
    d = (c.withColumn("tip_c", _trunc_div(F.col("fare_c") * F.col("dp"), 100))
          .withColumn("toll_c", _trunc_div(F.col("fare_c") * F.col("tp"), 100)))
    pickup_secs = ((F.col("l_orderkey") * 7919) % 86400).cast("int")
    dropoff_secs = ((F.col("l_partkey") * 104729) % 86400).cast("int")
    return d.select(
        F.nullif((F.col("l_suppkey") % 4).cast("int"), F.lit(0)).alias("VendorID"),
        F.nullif(F.col("l_linenumber").cast("bigint"), F.lit(7).cast("bigint")).alias("RatecodeID"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
        F.nullif((F.col("l_suppkey") % 263).cast("int"), F.lit(0)).alias("PULocationID"),
        (F.col("l_partkey") % 265 + 1).cast("int").alias("DOLocationID"),
        F.timestamp_add("SECOND", pickup_secs, F.col("o_orderdate")).alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", dropoff_secs, F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_quantity").cast("bigint") % 8, F.lit(7).cast("bigint")).alias("passenger_count"),
        (_trunc_div(F.col("px"), 3000) / 100).alias("trip_distance"),
        (F.col("fare_c") / 100).alias("fare_amount"),
        F.lit(1.0).cast("double").alias("extra"),
        F.lit(0.5).cast("double").alias("mta_tax"),
        (F.col("tip_c") / 100).alias("tip_amount"),
        (F.col("toll_c") / 100).alias("tolls_amount"),
        F.lit(1.0).cast("double").alias("improvement_surcharge"),
        ((F.col("fare_c") + F.col("tip_c") + F.col("toll_c") + 250) / 100).alias("total_amount"),
        month_file_name(F.year("o_orderdate"), F.month("o_orderdate")).alias("source_file"),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows (location_id, zone, borough, geometry as WKT text)."""
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    loc = F.col("location_id")
    ids = part.select((F.col("p_partkey") % 265 + 1).cast("int").alias("location_id")).distinct()
    g = (ids.where(~loc.isin(57, 104, 105, 264, 265))
            .withColumn("gx", (loc % 20).cast("bigint"))
            .withColumn("gy", (loc % 13).cast("bigint")))
    s = lambda c: c.cast("string")
    ring = F.concat(
        F.lit("(-74."), s(100 + F.col("gx")), F.lit(" 40."), s(100 + F.col("gy")),
        F.lit(", -74."), s(200 + F.col("gx")), F.lit(" 40."), s(100 + F.col("gy")),
        F.lit(", -74."), s(200 + F.col("gx")), F.lit(" 40."), s(200 + F.col("gy")),
        F.lit(")"))
    t = g.select("location_id", ring.alias("ring"))
    geometry = (
        F.when(loc % 31 == 0, F.lit(None).cast("string"))
         .when(loc % 7 == 0, F.concat(F.lit("MULTIPOLYGON (("), F.col("ring"),
                                      F.lit("), ((-73.5 40.5, -73.5 40.6, -73.7 40.6)))")))
         .when(loc % 11 == 0, F.concat(F.lit("MULTIPOLYGON (("), F.col("ring"),
                                       F.lit("), ((-70.5 41.5, -70.6 41.6)))")))
         .when(loc % 13 == 0, F.lit("MULTIPOLYGON (((-74 40, -75 41, -75 40)))"))
         .otherwise(F.concat(F.lit("MULTIPOLYGON (("), F.col("ring"), F.lit("))"))))
    # nation (25 rows) and region (5 rows) are fixed-size reference tables;
    # they are broadcast after a checked count all the same (one job for both).
    fits_all([nation, region])
    return (t.join(bounded(nation), nation.n_nationkey == loc % 25)
             .join(bounded(region), region.r_regionkey == loc % 5)
             .select(
                 loc,
                 F.concat(F.col("n_name"), F.lit(" "), s(loc)).alias("zone"),
                 F.when(loc % 50 == 0, F.lit(None).cast("string"))
                  .otherwise(F.col("r_name")).alias("borough"),
                 geometry.alias("geometry")))
