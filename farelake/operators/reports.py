"""The report library (A01-A36, J08): one function per report.

Signature: ``name(wh, start=None, end=None, **params) -> DataFrame``. The date
window is half-open on the pickup time (F09). The stored fact keeps each
trip's pickup and dropoff time, so a window is a filter that reaches the scan
and a time attribute is computed from the fact: no report joins the datetime
dimension to learn a time. A fact without a pickup time (an orphan; the load
makes none and ``fk_orphans`` checks it) counts in reports without a window or
time attribute only.

Reports that count or sum trips (A01-A21, A23, A29-A32) are built from
``partials``; over ``wh.answering_from_rollup()`` they read the kept partial
sums of each month instead of the facts, with the same results.

Time reports aggregate by the attribute with map-side partial sums, so a hot
second is combined before the shuffle. Money follows ``farelake.functions.money``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions import money as M
from farelake.functions.joins import bounded
from farelake.functions.rules import date_window
from farelake.functions.text import passenger_group, short_label, weekday_label
from farelake.operators import rollups as RU
from farelake.operators.warehouse import Warehouse

PU_KEY = "pickup_datetime_key"


def whole() -> Window:
    """A window over a whole table. Used only on tables whose size has a bound
    that does not grow with the trips (days of the calendar span, a handful
    of payment or passenger groups, the zones of the lookup, an n-row
    sample): the table is read in one task, in the same pass that built it,
    instead of aggregating the fact again for a scalar."""
    return Window.partitionBy()


@dataclass(frozen=True)
class Role:
    """A part that a column can play: the names it goes by, and whether the
    first timestamp column may stand in."""

    names: tuple[str, ...]
    any_timestamp: bool = False
    optional: bool = False


def resolve_columns(schema: T.StructType, roles: dict[str, Role]) -> dict[str, str | None]:
    """The column of every role (S16): the first of its names that the schema
    has, else for ``any_timestamp`` the schema's first timestamp column. One
    error names all roles that stay open; optional ones become None."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    found = {}
    for role, want in roles.items():
        options = [n for n in want.names if n in schema.fieldNames()] + (times if want.any_timestamp else [])
        found[role] = options[0] if options else None
    open_roles = [f"{r} (one of {', '.join(roles[r].names)})" for r, c in found.items()
                  if c is None and not roles[r].optional]
    if open_roles:
        raise ValueError("no column for " + "; ".join(open_roles))
    return found


def trips(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Facts whose pickup time falls in the window (J03): a pushed filter."""
    return date_window(wh.fact_trip, "pickup_ts", start, end)


def _measure_partials(measures: Sequence[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("_n")]
    for m in measures:
        out += [M.sum_dec(m).alias(f"_s_{m}"), F.count(m).alias(f"_c_{m}")]
    return out


def partials(wh: Warehouse, start, end, by: Sequence[Column | str] = (), measures: Sequence[str] = (),
             keys: Sequence[str] = ()) -> DataFrame:
    """Counts and exact sums per ``by`` (expressions of ``ts``, the pickup time, and of
    ``keys``, fact columns): the groups plus ``_n``, ``_s_<m>``, ``_c_<m>``.

    One aggregation of the facts; or, of a warehouse that answers from its
    rollup, of the kept partial sums, without the facts.
    """
    if wh.from_rollup:
        cube = RU.cube_for(list(keys))
        if cube is None:
            raise ValueError(f"no rollup has {', '.join(keys)}")
        cells = date_window(wh.rollup.where(F.col("cube") == cube), "pickup_ts", start, end)
        return cells.withColumn("ts", F.col("pickup_ts")).groupBy(*by).agg(*_measure_finals(measures))
    return trips(wh, start, end).withColumn("ts", F.col("pickup_ts")).groupBy(*by).agg(*_measure_partials(measures))


def by_pickup_time(wh: Warehouse, start, end, attrs: Sequence[Column],
                   measures: Sequence[str] = ()) -> DataFrame:
    """Counts and exact sums per time attribute(s) of the pickup, expressions of ``ts``."""
    return partials(wh, start, end, attrs, measures)


def _measure_finals(measures: Sequence[str]) -> list[Column]:
    out = [F.sum("_n").cast("bigint").alias("_n")]
    for m in measures:
        out += [F.sum(f"_s_{m}").alias(f"_s_{m}"), F.sum(f"_c_{m}").alias(f"_c_{m}")]
    return out


def _count(name: str = "trips") -> Column:
    return F.coalesce("_n", F.lit(0)).cast("bigint").alias(name)   # no cells: no trips


def _avg(m: str) -> Column:
    return M.avg_of(F.col(f"_s_{m}"), F.col(f"_c_{m}"))


def _sum(m: str) -> Column:
    return F.col(f"_s_{m}").cast(M.MONEY)


def _avg_numeric(m: str, p: int = 10) -> Column:
    c = F.col(f"_s_{m}")
    cents = (c * 100).cast("bigint")
    return M.cents_to_numeric(M.half_up_div(cents, F.col(f"_c_{m}")), p)


# ---- KPIs (A01, A02) --------------------------------------------------------

def kpi(wh: Warehouse, start=None, end=None) -> DataFrame:
    have = resolve_columns(wh.fact_trip.schema, {
        "passengers": Role(("passenger_count",)), "distance": Role(("trip_distance",)),
        "revenue": Role(("total_amount",), optional=True), "fare": Role(("fare_amount",), optional=True),
        "tip": Role(("tip_amount",), optional=True)})
    measures = [c for c in have.values() if c]
    out = [_count(), _avg(have["passengers"]).alias("avg_passengers"), _avg(have["distance"]).alias("avg_distance")]
    if have["revenue"]:
        out.append(_sum(have["revenue"]).alias("total_revenue"))
    out += [_avg(have[r]).alias(f"avg_{r}") for r in ("fare", "tip") if have[r]]
    return partials(wh, start, end, measures=measures).select(*out)


def kpi_rounded(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = partials(wh, start, end, measures=["passenger_count", "trip_distance", "fare_amount", "total_amount", "tip_amount"])
    return g.select(
        _count("n_trips"),
        _avg_numeric("passenger_count").alias("avg_passengers"),
        _avg_numeric("trip_distance").alias("avg_distance"),
        _avg_numeric("fare_amount").alias("avg_fare"),
        _avg_numeric("total_amount").alias("avg_total"),
        _sum("total_amount").cast("decimal(18,2)").alias("sum_total"),
        _avg_numeric("tip_amount").alias("avg_tip"),
        _sum("tip_amount").cast("decimal(18,2)").alias("sum_tip"))


# ---- days (A03-A07, A31) ----------------------------------------------------

def daily_trips(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [F.to_date("ts").alias("day")])
    return g.select("day", F.col("_n").alias("trips")).orderBy("day")


def _daily_metric_rows(wh: Warehouse, start=None, end=None) -> DataFrame:
    ms = ["total_amount", "fare_amount", "tip_amount"]
    g = by_pickup_time(wh, start, end, [F.to_date("ts").alias("day")], ms)
    return g.select("day", F.col("_n").alias("trips"), _sum("total_amount").alias("revenue"),
                    _avg("fare_amount").alias("avg_fare"), _avg("tip_amount").alias("avg_tip"))


def daily_metrics(wh: Warehouse, start=None, end=None) -> DataFrame:
    return _daily_metric_rows(wh, start, end).orderBy("day")


def daily_rounded(wh: Warehouse, start=None, end=None) -> DataFrame:
    ms = ["total_amount", "trip_distance"]
    g = by_pickup_time(wh, start, end, [F.to_date("ts").alias("day")], ms)
    return g.select("day", F.col("_n").alias("trips"),
                    _sum("total_amount").cast("decimal(18,2)").alias("revenue"),
                    _avg_numeric("trip_distance").alias("avg_distance")).orderBy("day")


def daily_distance(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [F.to_date("ts").alias("day")], ["trip_distance"])
    return g.select("day", _avg("trip_distance").alias("avg_distance")).orderBy("day")


def daily_trimmed(wh: Warehouse, start=None, end=None, floor: float = 1000.0,
                  share: float = 0.02) -> DataFrame:
    """Days with trips >= max(floor, share * median day) (A07). The median is
    exact over the daily rows (one per day: a bounded table)."""
    return _trimmed_days(wh, start, end, floor, share).orderBy("day")


def _trimmed_days(wh: Warehouse, start, end, floor: float, share: float) -> DataFrame:
    # One row per day: the median is a window over the daily table.
    med = F.percentile(F.col("trips").cast("double"), 0.5).over(whole())
    cut = F.greatest(F.lit(float(floor)), F.coalesce(med, F.lit(0.0)) * float(share))
    return (_daily_metric_rows(wh, start, end).withColumn("_cut", cut)
            .where(F.col("trips") >= F.col("_cut")).drop("_cut"))


def daily_scaled(wh: Warehouse, start=None, end=None, floor: float = 1000.0,
                 share: float = 0.02) -> DataFrame:
    """Trend series on one scale (A31): revenue to max(revenue, 1) x max trips,
    fare x 10000, tip x 16000, over the trimmed days."""
    d = _trimmed_days(wh, start, end, floor, share)
    max_rev = F.max(F.col("revenue").cast("double")).over(whole())
    max_trips = F.max("trips").over(whole())
    return d.select(
        "day", "trips",
        F.round(F.col("revenue").cast("double") / F.greatest(max_rev, F.lit(1.0))
                * max_trips, 6).alias("revenue_scaled"),
        F.round(F.col("avg_fare") * 10000, 6).alias("avg_fare_scaled"),
        F.round(F.col("avg_tip") * 16000, 6).alias("avg_tip_scaled")).orderBy("day")


# ---- hours and weekdays (A08-A13) -------------------------------------------

def hourly_trips(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [F.hour("ts").cast("int").alias("hour")])
    return g.select("hour", F.col("_n").alias("trips")).orderBy("hour")


def hourly_fares(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [F.hour("ts").cast("int").alias("hour")],
                       ["fare_amount", "tip_amount"])
    return g.select("hour", F.col("_n").alias("trips"), _avg("fare_amount").alias("avg_fare"),
                    _avg("tip_amount").alias("avg_tip")).orderBy("hour")


def hourly_rounded(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [F.hour("ts").alias("hour")], ["total_amount"])
    return g.select("hour", F.col("_n").alias("trips"),
                    _avg_numeric("total_amount").alias("avg_total")).orderBy("hour")


def _dow0(ts: str = "ts") -> Column:
    """0..6 with Sunday = 0, as EXTRACT(DOW)."""
    return (F.dayofweek(ts) - 1).cast("int")


def dow_trips(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [_dow0().alias("dow")])
    return g.select("dow", weekday_label(F.col("dow")).alias("day"),
                    F.col("_n").alias("trips")).orderBy("dow")


def dow_rounded(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Weekday from the dimension, 1..7 with Sunday = 1."""
    g = by_pickup_time(wh, start, end, [F.dayofweek("ts").alias("dow")], ["total_amount"])
    return g.select("dow", F.col("_n").alias("trips"),
                    _avg_numeric("total_amount").alias("avg_total")).orderBy("dow")


def dow_hour(wh: Warehouse, start=None, end=None) -> DataFrame:
    g = by_pickup_time(wh, start, end, [_dow0().alias("dow"), F.hour("ts").cast("int").alias("hour")])
    return g.select("dow", "hour", F.col("_n").alias("trips")).orderBy("dow", "hour")


HOURS = list(range(24))


def dow_hour_matrix(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Weekday (dimension, 1..7) by hour, every hour a column, missing cells 0."""
    g = by_pickup_time(wh, start, end, [F.dayofweek("ts").alias("dow"), F.hour("ts").alias("hour")])
    # Pivot values are given, so no extra job lists them.
    p = g.groupBy("dow").pivot("hour", HOURS).agg(F.sum("_n"))
    return p.select("dow", *[F.coalesce(F.col(str(h)), F.lit(0)).cast("bigint").alias(f"h{h:02d}")
                             for h in HOURS]).orderBy("dow")


# ---- dimensions (A14-A21, A29, A30, A32) ------------------------------------

def _count_by_key(wh: Warehouse, start, end, key: str) -> DataFrame:
    return partials(wh, start, end, [key], keys=[key]).select(key, F.col("_n").alias("trips"))


def payment_mix(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Trips per payment type, labelled by the dimension's key as the reference
    does (no label column exists); null payment keys drop out (J04)."""
    c = _count_by_key(wh, start, end, "payment_type_key")
    d = wh.dim_payment_type.select("payment_type_key")
    return (c.join(bounded(d, wh.dim_payment_type), "payment_type_key")
             .select(F.col("payment_type_key").alias("payment_type"), "trips")
             .orderBy(F.desc("trips"), "payment_type"))


def payment_mix_fact(wh: Warehouse, start=None, end=None, n: int | None = None) -> DataFrame:
    """Trips per fact payment key as text; the null group is kept."""
    c = _count_by_key(wh, start, end, "payment_type_key").select(
        F.col("payment_type_key").cast("string").alias("payment"), "trips")
    c = c.orderBy(F.desc("trips"), F.asc_nulls_first("payment"))
    return c.limit(n) if n else c


def rate_mix(wh: Warehouse, start=None, end=None, n: int = 10) -> DataFrame:
    """Top rate codes by trips, labelled by the dimension key."""
    c = _count_by_key(wh, start, end, "rate_code_key")
    d = wh.dim_rate_code.select("rate_code_key")
    return (c.join(bounded(d, wh.dim_rate_code), "rate_code_key")
             .select(F.col("rate_code_key").alias("rate_code"), "trips")
             .orderBy(F.desc("trips"), "rate_code").limit(n))


def rate_mix_fact(wh: Warehouse, start=None, end=None, n: int | None = 5) -> DataFrame:
    c = _count_by_key(wh, start, end, "rate_code_key").select(
        F.col("rate_code_key").cast("string").alias("rate_code"), "trips")
    c = c.orderBy(F.desc("trips"), F.asc_nulls_first("rate_code"))
    return c.limit(n) if n else c


def rate_top_other(wh: Warehouse, start=None, end=None, n: int = 5) -> DataFrame:
    """Top n rate codes plus ``Other`` for the rest of the full ranking.

    The top n come from a distributed top-k (n rows); every other code is
    labelled ``Other`` through a null-safe join against them.
    """
    c = rate_mix_fact(wh, start, end, n=None)
    top = c.orderBy(F.desc("trips"), F.asc_nulls_first("rate_code")).limit(n).select(
        F.col("rate_code").alias("_top"), F.lit(True).alias("_is_top"))
    j = c.join(F.broadcast(top), c["rate_code"].eqNullSafe(top["_top"]), "left")
    label = F.when(F.col("_is_top"), F.coalesce(F.col("rate_code"), F.lit("None"))).otherwise(
        F.lit("Other"))
    return (j.groupBy(label.alias("rate_code"))
             .agg(F.sum("trips").cast("bigint").alias("trips"),
                  F.max(F.coalesce(F.col("_is_top"), F.lit(False))).alias("_t"))
             .orderBy(F.desc("_t"), F.desc("trips"), "rate_code").drop("_t"))


def _stats_by_natural_id(wh: Warehouse, start, end, key: str, dim: DataFrame, ident: str,
                         measures: Sequence[str]) -> DataFrame:
    partial = partials(wh, start, end, [key], measures, [key])
    j = partial.join(bounded(dim.select(key, ident), dim), key)
    g = j.groupBy(ident).agg(*_measure_finals(measures))
    return g.select(ident, F.col("_n").alias("trips"),
                    *[_avg_numeric(m).alias(f"avg_{m.split('_')[0]}") for m in measures]
                    ).orderBy(F.desc("trips"), ident)


def payment_stats(wh: Warehouse, start=None, end=None) -> DataFrame:
    return _stats_by_natural_id(wh, start, end, "payment_type_key", wh.dim_payment_type,
                                "payment_type_id", ["total_amount", "tip_amount"])


def vendor_stats(wh: Warehouse, start=None, end=None) -> DataFrame:
    return _stats_by_natural_id(wh, start, end, "vendor_key", wh.dim_vendor, "vendor_id",
                                ["total_amount"])


def rate_stats(wh: Warehouse, start=None, end=None) -> DataFrame:
    return _stats_by_natural_id(wh, start, end, "rate_code_key", wh.dim_rate_code, "rate_code_id",
                                ["total_amount"])


def _location_counts(wh: Warehouse, start, end, role: str) -> DataFrame:
    key = {"pickup": "pu_location_key", "dropoff": "do_location_key"}[role]
    c = _count_by_key(wh, start, end, key)
    d = wh.dim_location.select(F.col("location_key").alias(key), "location_id")
    return c.join(bounded(d, wh.dim_location), key).select(F.col("location_id").cast("int").alias("location_id"),
                                              "trips")


def pickup_counts(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Trips per pickup location id."""
    return _location_counts(wh, start, end, "pickup").orderBy("location_id")


def top_locations(wh: Warehouse, start=None, end=None, role: str = "pickup", n: int = 8
                  ) -> DataFrame:
    """Top n locations by trips, ties by id."""
    return _location_counts(wh, start, end, role).orderBy(F.desc("trips"), "location_id").limit(n)


def top_pickups(wh: Warehouse, start=None, end=None, n: int = 8) -> DataFrame:
    return top_locations(wh, start, end, "pickup", n)


def top_dropoffs(wh: Warehouse, start=None, end=None, n: int = 8) -> DataFrame:
    return top_locations(wh, start, end, "dropoff", n)


def top_tip_locations(wh: Warehouse, start=None, end=None, n: int = 5) -> DataFrame:
    """Top n pickup locations by summed tips, the id as text."""
    s = partials(wh, start, end, ["pu_location_key"], ["tip_amount"], ["pu_location_key"]).select(
        "pu_location_key", F.col("_s_tip_amount").alias("_s"))
    d = wh.dim_location.select(F.col("location_key").alias("pu_location_key"), "location_id")
    return (s.join(bounded(d, wh.dim_location), "pu_location_key")
             .groupBy(F.col("location_id").cast("string").alias("pickup_location"))
             .agg(F.sum("_s").cast(M.MONEY).alias("total_tips"))
             .orderBy(F.desc("total_tips"), "pickup_location").limit(n))


def pickup_location_stats(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Per pickup location id: trips and the average tip, from one
    aggregation of the fact by location key."""
    s = partials(wh, start, end, ["pu_location_key"], ["tip_amount"], ["pu_location_key"])
    d = wh.dim_location.select(F.col("location_key").alias("pu_location_key"), "location_id")
    g = s.join(bounded(d, wh.dim_location), "pu_location_key").groupBy(
        F.col("location_id").cast("int").alias("location_id")).agg(*_measure_finals(["tip_amount"]))
    return g.select("location_id", F.col("_n").alias("trips"), _avg("tip_amount").alias("avg_tip"))


def tip_by_location(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Average tip per pickup location id."""
    return pickup_location_stats(wh, start, end).select("location_id", "avg_tip").orderBy("location_id")


def source_files(wh: Warehouse, start=None, end=None, n: int = 10) -> DataFrame:
    """Top n source files by trips, with the short label of the chart."""
    c = _count_by_key(wh, start, end, "source_file")
    return (c.orderBy(F.desc("trips"), "source_file").limit(n)
             .select("source_file", short_label(F.col("source_file")).alias("label"), "trips"))


def passenger_mix(wh: Warehouse, start=None, end=None) -> DataFrame:
    """Trips per passenger group: Unknown, 4+, or the number."""
    c = _count_by_key(wh, start, end, "passenger_count")
    return (c.groupBy(passenger_group(F.col("passenger_count")).alias("pax_group"))
             .agg(F.sum("trips").cast("bigint").alias("trips"))
             .orderBy(F.desc("trips"), "pax_group"))


def with_share(df: DataFrame, count_col: str = "trips") -> DataFrame:
    """Share of the total per row (A30). ``df`` is a grouped mix (a handful
    of groups): the total is a window over it."""
    return df.withColumn("share", F.round(F.col(count_col) / F.sum(count_col).over(whole()), 6))


def payment_share(wh: Warehouse, start=None, end=None) -> DataFrame:
    return with_share(payment_mix(wh, start, end)).orderBy(F.desc("trips"), "payment_type")


def passenger_share(wh: Warehouse, start=None, end=None) -> DataFrame:
    return with_share(passenger_mix(wh, start, end)).orderBy(F.desc("trips"), "pax_group")


# ---- distributions (A22, A33, A34, F12) -------------------------------------

def distance_buckets(wh: Warehouse, start=None, end=None, low: float = 0.0, high: float = 30.0,
                     bins: int = 30) -> DataFrame:
    """width_bucket over [low, high] inclusive; x = high falls in bins + 1."""
    f = trips(wh, start, end).where(F.col("trip_distance").between(low, high))
    b = F.width_bucket(F.col("trip_distance"), F.lit(low), F.lit(high), F.lit(bins))
    return f.groupBy(b.cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("n")
                                                         ).orderBy("bucket")


def first_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of ``df`` with the smallest ``key`` (an ordered limit).

    An ordered limit over a large table ends in one task that merges up to n
    rows from every input split. Trip keys are dense and the fact is written
    in key order, so a key bound holding the first n rows is found first:
    count the rows under the bound (files past it are skipped by their
    min/max statistics), widening it 4x from the smallest key until it holds
    n or passes the largest key, as ``take`` scales up. The ordered limit then runs only on rows
    under the bound. The rows are the same either way.
    """
    lo, top = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return df.limit(0)
    span = max(int(n), 1)               # the bound covers keys lo .. lo + span - 1
    while lo + span - 1 < top and df.where(F.col(key) < lo + span).count() < n:
        span *= 4
    return df.where(F.col(key) < lo + span).orderBy(key).limit(n)


def dist_sample(wh: Warehouse, n: int = 200000) -> DataFrame:
    """Rows with distance and total present, at most n in trip-key order."""
    f = wh.fact_trip.where(F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull())
    return first_by_key(f, "trip_key", n).select(
        "trip_key", "trip_distance", "total_amount", "tip_amount", "passenger_count")


SUMMARY_MEASURES = ["trip_distance", "total_amount", "tip_amount", "passenger_count"]


def measured_trips(wh: Warehouse, n: int | None = None) -> DataFrame:
    """The trips with distance and total present; with ``n`` the sample F12 of them."""
    if n is not None:
        return dist_sample(wh, n)
    f = wh.fact_trip.where(F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull())
    return f.select("trip_distance", "total_amount", "tip_amount", "passenger_count")


def measure_summary(wh: Warehouse, n: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max of four measures (A33), over the
    whole fact (with ``n``: over the sample F12).

    The four measures are unpivoted into (measure, x) pairs and summarised by
    one grouped aggregate; mean and std come from exact decimal sums.
    Quartiles are exact and distributed (``exact_quantiles_long``, one pass
    for all four).
    """
    from farelake.functions.stats import exact_quantiles_long
    d = measured_trips(wh, n)
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x"))
                                for m in SUMMARY_MEASURES])).alias("p")
    stats = d.select(pairs).select("p.measure", "p.x").groupBy("measure").agg(
        F.count("x").alias("count"),
        M.avg_money("x").alias("mean"),
        F.round(F.stddev_samp(F.col("x").cast("decimal(18,2)")).cast("double"), 6).alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"))
    q = exact_quantiles_long(d, SUMMARY_MEASURES, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    # One row per measure, also for an empty fact.
    return (q.withColumnRenamed("column", "measure").join(stats, "measure", "left")
             .select("measure", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                     "mean", "std", "min", "p25", "p50", "p75", "max"))


def clipped_histogram(wh: Warehouse, measure: str, cap: float, bins: int, n: int | None = None
                      ) -> DataFrame:
    """Equal-width bins from min to max of least(x, cap); last bin closed (A34),
    over the whole fact (with ``n``: over the sample F12). The bounds are
    scalar subqueries; bins are counted with map-side partial counts."""
    d = measured_trips(wh, n).select(F.least(F.col(measure).cast("double"), F.lit(float(cap))).alias("x"))
    d = d.where(F.col("x").isNotNull())
    lo, hi = d.agg(F.min("x")).scalar(), d.agg(F.max("x")).scalar()
    d = d.select("x", lo.alias("_lo"), hi.alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    idx = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("_lo")) / width * bins), F.lit(bins - 1)))
    j = d.select(idx.cast("int").alias("bin"), "_lo", "_hi")
    return (j.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
             .select("bin",
                     F.round(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins, 6
                             ).alias("bin_start"),
                     F.round(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins, 6
                             ).alias("bin_end"),
                     "n").orderBy("bin"))


def hist_distance(wh: Warehouse) -> DataFrame:
    return clipped_histogram(wh, "trip_distance", 30.0, 60)


def hist_total(wh: Warehouse) -> DataFrame:
    return clipped_histogram(wh, "total_amount", 200.0, 80)


def hist_tip(wh: Warehouse) -> DataFrame:
    return clipped_histogram(wh, "tip_amount", 50.0, 60)


# ---- bounds, counts, samples (A27, A28, A36, J08) ---------------------------

def time_bounds(wh: Warehouse) -> DataFrame:
    """min/max of the dimension's time, and min/max pickup and dropoff times of
    the facts (A27): one aggregate of two stored columns of the fact."""
    dt = wh.dim_datetime
    bounds = [f(F.col(f"{role}_ts")).alias(f"{name}_{role}_ts")
              for role in ("pickup", "dropoff") for name, f in (("min", F.min), ("max", F.max))]
    return wh.fact_trip.agg(*bounds).select(
        "*", dt.agg(F.min("ts")).scalar().alias("min_ts"), dt.agg(F.max("ts")).scalar().alias("max_ts"))


def table_counts(wh: Warehouse) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("count"))
               .select(F.lit(name).alias("table_name"), "count")
             for name, df in wh.tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("count"), "table_name")


def latest_trips(wh: Warehouse, start=None, end=None, n: int = 200) -> DataFrame:
    """The n newest trips by pickup time, ties by trip key (A36): a top-k over
    the fact's own pickup time, n rows from each task."""
    have = resolve_columns(wh.fact_trip.schema, {
        "time": Role(("pickup_ts", "pickup_time"), any_timestamp=True), "tip": Role(("tip_amount",), optional=True)})
    cols = ["passenger_count", "trip_distance"] + ([have["tip"]] if have["tip"] else [])
    return (trips(wh, start, end).select("trip_key", F.col(have["time"]).alias("pickup_time"), *cols)
            .orderBy(F.desc("pickup_time"), "trip_key").limit(n))


def trip_sample(wh: Warehouse, n: int = 10) -> DataFrame:
    """Facts with three dimension roles and both times resolved, first n by trip key.
    Inner joins: a fact with a null payment, vendor or rate key drops out."""
    f = wh.fact_trip
    j = (f.join(bounded(wh.dim_payment_type), "payment_type_key")
          .join(bounded(wh.dim_vendor), "vendor_key")
          .join(bounded(wh.dim_rate_code), "rate_code_key"))
    top = first_by_key(j, "trip_key", n)
    return top.select("trip_key", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance",
                      "fare_amount", "total_amount", "tip_amount", "payment_type_id", "vendor_id",
                      "rate_code_id", "source_file").orderBy("trip_key")
