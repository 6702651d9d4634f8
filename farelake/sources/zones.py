"""Zone lookup file and the location map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.joins import fits
from farelake.schemas import ZONE_CSV_HEADER

# The lookup has one row per taxi zone (a few hundred); it is broadcast only
# after a row count below this bound.
ZONE_BROADCAST_MAX_ROWS = 100_000


def write_zone_csv(zones: DataFrame, path: str) -> None:
    """Write (location_id, zone, borough, geometry) as the published CSV layout:
    one file while the lookup is of its known size, else one per task."""
    out = zones.select(*[F.col(c).cast("string").alias(h) for c, h in
                         zip(["location_id", "zone", "borough", "geometry"], ZONE_CSV_HEADER)])
    out = out.coalesce(1) if fits(zones, ZONE_BROADCAST_MAX_ROWS) else out
    out.write.mode("overwrite").option("header", True).csv(path)


def read_zone_text(spark: SparkSession, path: str) -> DataFrame:
    """The lookup as text columns, as written."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup with the numeric id coerced: a bad id becomes null."""
    raw = read_zone_text(spark, path)
    return raw.select(
        F.col("`Location ID`").try_cast("int").alias("location_id"),
        F.col("Zone").alias("zone"), F.col("Borough").alias("borough"),
        F.col("`Shape Geometry`").alias("geometry"))


def zone_ids_to_load(zone_text: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Numeric ids of the lookup not yet in the location dimension."""
    ids = (zone_text.where(F.trim(F.col("`Location ID`")).rlike("^[0-9]+$"))
           .select(F.trim(F.col("`Location ID`")).cast("int").alias("location_id")).distinct())
    return ids.join(dim_location.select("location_id"), "location_id", "left_anti")


# Ids per JSON object of the location map: the lookup is written as one
# object per block of ids, so no group grows with the lookup.
MAP_BLOCK = 10_000


def location_map_json(zones: DataFrame) -> DataFrame:
    """JSON objects id -> zone name (S14), one per block of ids. A repeated id
    keeps one name (the largest), so the map has unique keys."""
    entries = (zones.where(F.col("location_id").isNotNull())
               .groupBy("location_id").agg(F.max("zone").alias("zone"))
               .select((F.col("location_id") / MAP_BLOCK).cast("bigint").alias("block"),
                       F.struct(F.col("location_id").cast("string").alias("k"),
                                F.col("zone").alias("v")).alias("e")))
    return entries.groupBy("block").agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list("e")))).alias("location_map")).select("location_map")


def write_location_map(zones: DataFrame, path: str) -> None:
    location_map_json(zones).write.mode("overwrite").text(path)


def read_location_map(spark: SparkSession, path: str) -> DataFrame:
    """(location_id, zone) rows from a written location map (all its objects)."""
    m = spark.read.text(path).select(
        F.from_json("value", "map<string,string>").alias("m"))
    return m.select(F.explode("m").alias("k", "zone")).select(
        F.col("k").cast("int").alias("location_id"), "zone")


def zone_name_index(zones: DataFrame) -> DataFrame:
    """zone name -> id; a repeated name keeps its last (largest) id, as the
    reverse lookup of the prediction form does."""
    return (zones.where(F.col("location_id").isNotNull() & F.col("zone").isNotNull())
            .groupBy("zone").agg(F.max("location_id").alias("location_id")))
