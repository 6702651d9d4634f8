"""Zone reports: centroids, the pickup map, tiers, extent, borough mix (A18,
A23-A26, A37, J09, J10, J12).

The zone lookup is a reference table of a few hundred rows; it is broadcast
after a checked count. Trip counts are aggregated to one row per location
before any zone join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.joins import bounded
from farelake.functions.text import fmt_money, fmt_num
from farelake.functions.wkt import centroid
from farelake.operators import reports as R
from farelake.operators.warehouse import Warehouse
from farelake.sources.zones import ZONE_BROADCAST_MAX_ROWS, zone_name_index


def small(df: DataFrame, max_rows: int = ZONE_BROADCAST_MAX_ROWS) -> DataFrame:
    return bounded(df, max_rows=max_rows)


def zone_centroids(zones: DataFrame) -> DataFrame:
    """Centroid of each zone's WKT rings."""
    c = zones.select("location_id", "zone", "borough", centroid(F.col("geometry")).alias("c"))
    return c.select("location_id", "zone", "borough", F.col("c.lon").alias("centroid_lon"),
                    F.col("c.lat").alias("centroid_lat"), F.col("c.n_rings").alias("n_rings"),
                    F.col("c.n_points").alias("n_points"))


def zone_map(zones: DataFrame, wh: Warehouse, start=None, end=None) -> DataFrame:
    """Every zone with its pickup count, 0 when none (J09). Trips at ids the
    lookup lacks are not shown."""
    counts = R.pickup_counts(wh, start, end)
    z = zone_centroids(zones)
    return (z.join(counts, "location_id", "left")
             .select("location_id", "zone", "borough", "centroid_lon", "centroid_lat",
                     F.coalesce(F.col("trips"), F.lit(0)).cast("bigint").alias("trips")))


def borough_mix(zones: DataFrame, wh: Warehouse, start=None, end=None, n: int = 6) -> DataFrame:
    """Top n boroughs by trips, with the unweighted mean of their zones'
    average tips (J10, A24). A null borough is dropped. One aggregation of
    the fact by pickup location feeds both measures."""
    per_zone = (zones.select("location_id", "borough").where(F.col("borough").isNotNull())
                .join(R.pickup_location_stats(wh, start, end), "location_id", "left"))
    b = per_zone.groupBy("borough").agg(
        F.sum(F.coalesce(F.col("trips"), F.lit(0))).cast("bigint").alias("trips"),
        # Zone means have 6 decimals: summed exactly, divided once.
        F.round(F.sum(F.col("avg_tip").cast("decimal(18,6)")).cast("double") / F.count("avg_tip"), 6
                ).alias("avg_tip"))
    top = b.orderBy(F.desc("trips"), "borough").limit(n)
    return top.select("borough", "trips", "avg_tip", fmt_num(F.col("trips"), 0).alias("trips_text"),
                      fmt_money(F.col("avg_tip")).alias("avg_tip_text")
                      ).orderBy(F.desc("trips"), "borough")


def zone_tiers(zones: DataFrame, wh: Warehouse, start=None, end=None) -> DataFrame:
    """Zones with a centroid in three tiers by pickup count: base (<= p90),
    hot (p90..p98], peak (> p98) (A25). Exact percentiles over the zones."""
    m = zone_map(zones, wh, start, end).where(F.col("centroid_lon").isNotNull()
                                            & F.col("centroid_lat").isNotNull())
    # One row per zone of the lookup: the percentiles are a window over it.
    q = lambda p: F.round(F.percentile(F.col("trips").cast("double"), p).over(R.whole()), 6)
    m = m.withColumn("_q90", q(0.9)).withColumn("_q98", q(0.98))
    tier = (F.when(F.col("trips") <= F.col("_q90"), "base")
             .when(F.col("trips") <= F.col("_q98"), "hot").otherwise("peak"))
    return m.select("location_id", "trips", "centroid_lon", "centroid_lat", tier.alias("tier"))


def map_extent(zones: DataFrame, wh: Warehouse, start=None, end=None) -> DataFrame:
    """p1..p99 of the centroids of active zones (all zones when none is
    active), widened by 5 % each side (A26)."""
    m = zone_map(zones, wh, start, end).where(F.col("centroid_lon").isNotNull()
                                            & F.col("centroid_lat").isNotNull())
    act = F.col("trips") > 0

    def pct(c, p, cond=None):
        v = F.col(c) if cond is None else F.when(cond, F.col(c))
        return F.percentile(v, p)

    a = m.agg(F.sum(F.when(act, 1).otherwise(0)).alias("n_active"),
              pct("centroid_lon", 0.01, act).alias("ax0"), pct("centroid_lon", 0.99, act).alias("ax1"),
              pct("centroid_lat", 0.01, act).alias("ay0"), pct("centroid_lat", 0.99, act).alias("ay1"),
              pct("centroid_lon", 0.01).alias("bx0"), pct("centroid_lon", 0.99).alias("bx1"),
              pct("centroid_lat", 0.01).alias("by0"), pct("centroid_lat", 0.99).alias("by1"))
    use = F.col("n_active") > 0
    x0, x1 = F.when(use, F.col("ax0")).otherwise(F.col("bx0")), F.when(use, F.col("ax1")).otherwise(F.col("bx1"))
    y0, y1 = F.when(use, F.col("ay0")).otherwise(F.col("by0")), F.when(use, F.col("ay1")).otherwise(F.col("by1"))
    b = a.select(x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    mx, my = (F.col("x1") - F.col("x0")) * 0.05, (F.col("y1") - F.col("y0")) * 0.05
    return b.select(F.round(F.col("x0") - mx, 6).alias("x_min"), F.round(F.col("x1") + mx, 6).alias("x_max"),
                    F.round(F.col("y0") - my, 6).alias("y_min"), F.round(F.col("y1") + my, 6).alias("y_max"))


def zone_ids_for_names(requests: DataFrame, zones: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Add the id of a zone name (J12); an unknown name gives null."""
    idx = small(zone_name_index(zones)).select(F.col("zone").alias(name_col),
                                               F.col("location_id").alias(id_col))
    return requests.join(idx, name_col, "left")
