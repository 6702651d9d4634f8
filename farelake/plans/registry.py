"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the oracle SQL.

Each query reads the driver's tables under ``sf_dir`` (through the adapters)
or the warehouse Spark derives from them, over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farelake import schemas as S
from farelake.checks import oracle as O
from farelake.operators import reports as R
from farelake.operators import warehouse as W
from farelake.plans.star import warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def report(name: str, fn, sql: str | None, **params) -> None:
    """Register a warehouse report with fixed parameters."""
    QUERIES[name] = lambda spark, sf_dir: fn(warehouse(spark, sf_dir), **params)
    if sql is not None:
        SQL[name] = sql


star = O.star
PU = O.PU
am, sm, an = O.avg_money, O.sum_money, O.avg_numeric

# ---- warehouse tables (W02, W03, W05) ----------------------------------------

STORED_COLUMNS = {n: getattr(S, n.upper()).fieldNames() for n in (
    "dim_vendor", "dim_rate_code", "dim_payment_type", "dim_location", "dim_datetime", "fact_trip")}
for _t in ["dim_vendor", "dim_rate_code", "dim_payment_type", "dim_location", "dim_datetime",
           "fact_trip"]:
    report(_t, (lambda t: lambda wh: getattr(wh, t).select(*STORED_COLUMNS[t]))(_t), star(f"SELECT * FROM {_t}"))

report("fk_orphans", W.fk_orphans, star("\nUNION ALL\n".join(
    f"SELECT '{fk}' AS foreign_key, '{dim}' AS dimension, "
    f"CAST(count(f.{fk}) AS BIGINT) AS orphans FROM fact_trip f "
    f"WHERE f.{fk} IS NOT NULL AND f.{fk} NOT IN (SELECT {dk} FROM {dim})"
    for fk, dim, dk in W.FK_CHECKS)))


def _violation_sql() -> str:
    parts = []

    def dup(t, c):
        parts.append(f"SELECT '{t}' AS table_name, 'unique_{c}' AS check_name, "
                     f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations "
                     f"FROM (SELECT {c}, count(*) AS n FROM {t} GROUP BY {c} HAVING count(*) > 1)")

    def nulls(t, cols):
        for c in cols:
            parts.append(f"SELECT '{t}', 'not_null_{c}', CAST(count(*) - count({c}) AS BIGINT) FROM {t}")

    for spec in W.SMALL_DIMS:
        dup(spec.name, spec.id_col)
        dup(spec.name, spec.key_col)
        nulls(spec.name, [spec.key_col, spec.id_col])
    dup("dim_datetime", "ts")
    dup("dim_datetime", "datetime_key")
    nulls("dim_datetime", ["datetime_key", "ts", "date", "year", "month", "day", "hour", "dow"])
    dup("fact_trip", "trip_key")
    nulls("fact_trip", ["trip_key", "pickup_datetime_key", "dropoff_datetime_key"])
    return star("\nUNION ALL\n".join(parts))


report("constraint_violations", W.constraint_violations, _violation_sql())

report("surrogate_keys", W.key_ranges, star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, "
    f"CAST(min({k}) AS BIGINT) AS min_key, CAST(max({k}) AS BIGINT) AS max_key FROM {t}"
    for t, k in [("dim_vendor", "vendor_key"), ("dim_rate_code", "rate_code_key"),
                 ("dim_payment_type", "payment_type_key"), ("dim_location", "location_key"),
                 ("dim_datetime", "datetime_key"), ("fact_trip", "trip_key")])))

report("table_counts", R.table_counts, star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS count FROM {t}"
    for t in ["dim_vendor", "dim_rate_code", "dim_payment_type", "dim_location", "dim_datetime",
              "fact_trip"])))

# ---- KPIs and time reports (A01-A13, A27, A31) -------------------------------

report("kpi", R.kpi, star(f"""
SELECT COUNT(*) AS trips, {am('f.passenger_count')} AS avg_passengers,
       {am('f.trip_distance')} AS avg_distance, {sm('f.total_amount')} AS total_revenue,
       {am('f.fare_amount')} AS avg_fare, {am('f.tip_amount')} AS avg_tip
FROM {PU}"""))

report("kpi_rounded", R.kpi_rounded, star(f"""
SELECT COUNT(*) AS n_trips, {an('passenger_count')} AS avg_passengers,
       {an('trip_distance')} AS avg_distance, {an('fare_amount')} AS avg_fare,
       {an('total_amount')} AS avg_total, {sm('total_amount')} AS sum_total,
       {an('tip_amount')} AS avg_tip, {sm('tip_amount')} AS sum_tip
FROM fact_trip"""))

report("daily_trips", R.daily_trips, star(f"""
SELECT d.date AS day, COUNT(*) AS trips FROM {PU} GROUP BY 1"""))

report("daily_metrics", R.daily_metrics, star(f"""
SELECT d.date AS day, COUNT(*) AS trips, {sm('f.total_amount')} AS revenue,
       {am('f.fare_amount')} AS avg_fare, {am('f.tip_amount')} AS avg_tip
FROM {PU} GROUP BY 1"""))

report("daily_rounded", R.daily_rounded, star(f"""
SELECT CAST(d.ts AS DATE) AS day, COUNT(*) AS trips, {sm('f.total_amount')} AS revenue,
       {an('f.trip_distance')} AS avg_distance
FROM {PU} GROUP BY 1"""))

report("daily_distance", R.daily_distance, star(f"""
SELECT d.date AS day, {am('f.trip_distance')} AS avg_distance FROM {PU} GROUP BY 1"""))

DAY_FLOOR = 10.0
_daily_metrics_sql = f"""daily AS (
  SELECT d.date AS day, COUNT(*) AS trips, {sm('f.total_amount')} AS revenue,
         {am('f.fare_amount')} AS avg_fare, {am('f.tip_amount')} AS avg_tip
  FROM {PU} GROUP BY 1),
trimmed AS (
  SELECT * FROM daily
  WHERE trips >= greatest({DAY_FLOOR}, coalesce((SELECT quantile_cont(trips, 0.5) FROM daily), 0) * 0.02))"""

report("daily_trimmed", R.daily_trimmed, star(f", {_daily_metrics_sql}\nSELECT * FROM trimmed"
                                              ).replace("\n, daily AS", ",\ndaily AS"),
       floor=DAY_FLOOR)

report("daily_scaled", R.daily_scaled, star(f""", {_daily_metrics_sql}
SELECT day, trips,
  round(CAST(revenue AS DOUBLE) / greatest((SELECT max(CAST(revenue AS DOUBLE)) FROM trimmed), 1.0)
        * (SELECT max(trips) FROM trimmed), 6) AS revenue_scaled,
  round(avg_fare * 10000, 6) AS avg_fare_scaled, round(avg_tip * 16000, 6) AS avg_tip_scaled
FROM trimmed"""), floor=DAY_FLOOR)

report("hourly_trips", R.hourly_trips, star(f"""
SELECT CAST(EXTRACT(HOUR FROM d.ts) AS INTEGER) AS hour, COUNT(*) AS trips FROM {PU} GROUP BY 1"""))

report("hourly_fares", R.hourly_fares, star(f"""
SELECT CAST(EXTRACT(HOUR FROM d.ts) AS INTEGER) AS hour, COUNT(*) AS trips,
       {am('f.fare_amount')} AS avg_fare, {am('f.tip_amount')} AS avg_tip
FROM {PU} GROUP BY 1"""))

report("hourly_rounded", R.hourly_rounded, star(f"""
SELECT d.hour AS hour, COUNT(*) AS trips, {an('f.total_amount')} AS avg_total FROM {PU} GROUP BY 1"""))

_DOW_LABEL = "['Sun','Mon','Tue','Wed','Thu','Fri','Sat']"
report("dow_trips", R.dow_trips, star(f"""
SELECT CAST(EXTRACT(DOW FROM d.ts) AS INTEGER) AS dow,
       {_DOW_LABEL}[CAST(EXTRACT(DOW FROM d.ts) AS INTEGER) + 1] AS day, COUNT(*) AS trips
FROM {PU} GROUP BY 1, 2"""))

report("dow_rounded", R.dow_rounded, star(f"""
SELECT d.dow AS dow, COUNT(*) AS trips, {an('f.total_amount')} AS avg_total FROM {PU} GROUP BY 1"""))

report("dow_hour", R.dow_hour, star(f"""
SELECT CAST(EXTRACT(DOW FROM d.ts) AS INTEGER) AS dow, CAST(EXTRACT(HOUR FROM d.ts) AS INTEGER) AS hour,
       COUNT(*) AS trips
FROM {PU} GROUP BY 1, 2"""))

report("dow_hour_matrix", R.dow_hour_matrix, star(f"""
SELECT d.dow AS dow, {', '.join(f'CAST(count(*) FILTER (WHERE d.hour = {h}) AS BIGINT) AS h{h:02d}'
                                 for h in range(24))}
FROM {PU} GROUP BY 1"""))

report("time_bounds", R.time_bounds, star("""
SELECT (SELECT min(p.ts) FROM fact_trip f JOIN dim_datetime p ON p.datetime_key = f.pickup_datetime_key) AS min_pickup_ts,
       (SELECT max(p.ts) FROM fact_trip f JOIN dim_datetime p ON p.datetime_key = f.pickup_datetime_key) AS max_pickup_ts,
       (SELECT min(q.ts) FROM fact_trip f JOIN dim_datetime q ON q.datetime_key = f.dropoff_datetime_key) AS min_dropoff_ts,
       (SELECT max(q.ts) FROM fact_trip f JOIN dim_datetime q ON q.datetime_key = f.dropoff_datetime_key) AS max_dropoff_ts,
       (SELECT min(ts) FROM dim_datetime) AS min_ts, (SELECT max(ts) FROM dim_datetime) AS max_ts"""))

# ---- dimension mixes (A14-A21, A29, A30, A32) --------------------------------

report("payment_mix", R.payment_mix, star(f"""
SELECT p.payment_type_key AS payment_type, COUNT(*) AS trips
FROM {PU} JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key GROUP BY 1"""))

report("payment_mix_fact", R.payment_mix_fact, star(f"""
SELECT CAST(f.payment_type_key AS VARCHAR) AS payment, COUNT(*) AS trips FROM {PU} GROUP BY 1"""))

report("rate_mix", R.rate_mix, star(f"""
SELECT r.rate_code_key AS rate_code, COUNT(*) AS trips
FROM {PU} JOIN dim_rate_code r ON f.rate_code_key = r.rate_code_key
GROUP BY 1 ORDER BY trips DESC, rate_code LIMIT 10"""))

report("rate_mix_fact", R.rate_mix_fact, star(f"""
SELECT CAST(f.rate_code_key AS VARCHAR) AS rate_code, COUNT(*) AS trips FROM {PU}
GROUP BY 1 ORDER BY trips DESC, rate_code NULLS FIRST LIMIT 5"""))

report("rate_top_other", R.rate_top_other, star(f"""
SELECT label AS rate_code, CAST(sum(trips) AS BIGINT) AS trips FROM (
  SELECT CASE WHEN rn <= 5 THEN coalesce(rate_code, 'None') ELSE 'Other' END AS label, trips FROM (
    SELECT CAST(f.rate_code_key AS VARCHAR) AS rate_code, COUNT(*) AS trips,
           row_number() OVER (ORDER BY COUNT(*) DESC, CAST(f.rate_code_key AS VARCHAR) NULLS FIRST) AS rn
    FROM {PU} GROUP BY 1))
GROUP BY 1"""))

report("payment_stats", R.payment_stats, star(f"""
SELECT p.payment_type_id, COUNT(*) AS trips, {an('f.total_amount')} AS avg_total,
       {an('f.tip_amount')} AS avg_tip
FROM fact_trip f JOIN dim_payment_type p ON p.payment_type_key = f.payment_type_key GROUP BY 1"""))

report("vendor_stats", R.vendor_stats, star(f"""
SELECT v.vendor_id, COUNT(*) AS trips, {an('f.total_amount')} AS avg_total
FROM fact_trip f JOIN dim_vendor v ON v.vendor_key = f.vendor_key GROUP BY 1"""))

report("rate_stats", R.rate_stats, star(f"""
SELECT r.rate_code_id, COUNT(*) AS trips, {an('f.total_amount')} AS avg_total
FROM fact_trip f JOIN dim_rate_code r ON r.rate_code_key = f.rate_code_key GROUP BY 1"""))

_LOC = """SELECT CAST(l.location_id AS INTEGER) AS location_id, COUNT(*) AS trips
FROM fact_trip f JOIN dim_location l ON f.{k} = l.location_key
JOIN dim_datetime d ON f.pickup_datetime_key = d.datetime_key GROUP BY 1"""

report("pickup_counts", R.pickup_counts, star(_LOC.format(k="pu_location_key")))
report("top_pickups", R.top_pickups, star(_LOC.format(k="pu_location_key")
                                          + " ORDER BY trips DESC, location_id LIMIT 8"))
report("top_dropoffs", R.top_dropoffs, star(_LOC.format(k="do_location_key")
                                            + " ORDER BY trips DESC, location_id LIMIT 8"))

report("top_tip_locations", R.top_tip_locations, star(f"""
SELECT CAST(l.location_id AS VARCHAR) AS pickup_location, {sm('f.tip_amount')} AS total_tips
FROM {PU} JOIN dim_location l ON f.pu_location_key = l.location_key
GROUP BY 1 ORDER BY total_tips DESC, pickup_location LIMIT 5"""))

report("tip_by_location", R.tip_by_location, star(f"""
SELECT CAST(l.location_id AS INTEGER) AS location_id, {am('f.tip_amount')} AS avg_tip
FROM {PU} JOIN dim_location l ON f.pu_location_key = l.location_key GROUP BY 1"""))

report("source_files", R.source_files, star(f"""
SELECT source_file,
       CASE WHEN length(source_file) > 31 THEN concat(substr(source_file, 1, 28), '...')
            ELSE source_file END AS label, trips
FROM (SELECT f.source_file, COUNT(*) AS trips FROM {PU} GROUP BY 1
      ORDER BY trips DESC, source_file LIMIT 10)"""))

_PAX = f"""SELECT CASE WHEN f.passenger_count IS NULL THEN 'Unknown'
                WHEN f.passenger_count >= 4 THEN '4+'
                ELSE CAST(f.passenger_count AS VARCHAR) END AS pax_group, COUNT(*) AS trips
FROM {PU} GROUP BY 1"""
report("passenger_mix", R.passenger_mix, star(_PAX))
report("passenger_share", R.passenger_share, star(
    f"SELECT pax_group, trips, round(trips / sum(trips) OVER (), 6) AS share FROM ({_PAX})"))
report("payment_share", R.payment_share, star(f"""
SELECT payment_type, trips, round(trips / sum(trips) OVER (), 6) AS share FROM (
  SELECT p.payment_type_key AS payment_type, COUNT(*) AS trips
  FROM {PU} JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key GROUP BY 1)"""))

# ---- distributions (A22, A33, A34, F12) --------------------------------------

report("distance_buckets", R.distance_buckets, star(f"""
SELECT CAST(floor(f.trip_distance) + 1 AS BIGINT) AS bucket, COUNT(*) AS n
FROM {PU} WHERE f.trip_distance >= 0 AND f.trip_distance <= 30 GROUP BY 1"""))

_SAMPLE = """sample AS (
  SELECT trip_key, trip_distance, total_amount, tip_amount, passenger_count FROM fact_trip
  WHERE trip_distance IS NOT NULL AND total_amount IS NOT NULL ORDER BY trip_key LIMIT 200000)"""

report("dist_sample", R.dist_sample, star(f", {_SAMPLE}\nSELECT * FROM sample").replace(
    "\n, sample AS", ",\nsample AS"))

_MEASURED = """measured AS (
  SELECT trip_distance, total_amount, tip_amount, passenger_count FROM fact_trip
  WHERE trip_distance IS NOT NULL AND total_amount IS NOT NULL)"""

report("measure_summary", R.measure_summary, star(f", {_MEASURED}\n" + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS measure, COUNT({m}) AS count, {am(m)} AS mean, "
    f"round(CAST(stddev_samp(CAST({m} AS DECIMAL(18,2))) AS DOUBLE), 6) AS std, "
    f"CAST(min({m}) AS DOUBLE) AS min, round(quantile_cont(CAST({m} AS DOUBLE), 0.25), 6) AS p25, "
    f"round(quantile_cont(CAST({m} AS DOUBLE), 0.5), 6) AS p50, "
    f"round(quantile_cont(CAST({m} AS DOUBLE), 0.75), 6) AS p75, CAST(max({m}) AS DOUBLE) AS max "
    f"FROM measured" for m in R.SUMMARY_MEASURES)).replace("\n, measured AS", ",\nmeasured AS"))


def _hist_sql(m: str, cap: float, bins: int) -> str:
    return star(f""", {_MEASURED},
x AS (SELECT least(CAST({m} AS DOUBLE), {cap}) AS x FROM measured WHERE least(CAST({m} AS DOUBLE), {cap}) IS NOT NULL),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
hb AS (SELECT CAST(CASE WHEN hi - lo <= 0 THEN 0
                       ELSE least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin, lo, hi
      FROM x, mm)
SELECT bin, round(lo + (hi - lo) * bin / {bins}, 6) AS bin_start,
       round(lo + (hi - lo) * (bin + 1) / {bins}, 6) AS bin_end, COUNT(*) AS n
FROM hb GROUP BY bin, lo, hi""").replace("\n, measured AS", ",\nmeasured AS")


report("hist_distance", R.hist_distance, _hist_sql("trip_distance", 30.0, 60))
report("hist_total", R.hist_total, _hist_sql("total_amount", 200.0, 80))
report("hist_tip", R.hist_tip, _hist_sql("tip_amount", 50.0, 60))

report("latest_trips", R.latest_trips, star(f"""
SELECT f.trip_key, d.ts AS pickup_time, f.passenger_count, f.trip_distance, f.tip_amount
FROM {PU} ORDER BY d.ts DESC, f.trip_key LIMIT 200"""))

report("trip_sample", R.trip_sample, star("""
SELECT f.trip_key, pickup.ts AS pickup_ts, dropoff.ts AS dropoff_ts, f.passenger_count,
       f.trip_distance, f.fare_amount, f.total_amount, f.tip_amount, pay.payment_type_id,
       ven.vendor_id, rc.rate_code_id, f.source_file
FROM fact_trip f
JOIN dim_datetime pickup  ON pickup.datetime_key  = f.pickup_datetime_key
JOIN dim_datetime dropoff ON dropoff.datetime_key = f.dropoff_datetime_key
JOIN dim_payment_type pay ON pay.payment_type_key = f.payment_type_key
JOIN dim_vendor ven       ON ven.vendor_key       = f.vendor_key
JOIN dim_rate_code rc     ON rc.rate_code_key     = f.rate_code_key
ORDER BY f.trip_key LIMIT 10"""))

# ---- lake: scans, plans, partitions, ledger (S01-S11) ------------------------

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from farelake.functions import rules as FR  # noqa: E402
from farelake.functions.joins import bounded  # noqa: E402
from farelake.functions.text import month_file_name  # noqa: E402
from farelake.operators import sketches as SK  # noqa: E402
from farelake.operators import zones as Z  # noqa: E402
from farelake.plans import modes as P  # noqa: E402
from farelake.plans.star import (LoadRefused, load_batch, load_zone_ids, open_warehouse,  # noqa: E402
                                 publish_batch, read_table, reload_source, save_path, save_table, stage_batch,
                                 stage_facts, star_for)
from farelake.session import scratch_path  # noqa: E402
from farelake.sources import adapter as A  # noqa: E402
from farelake.sources import lake as L  # noqa: E402
from farelake.sources import zones as ZS  # noqa: E402
from farelake.streaming.ingest import land_month_files  # noqa: E402

def fresh(spark, name: str) -> str:
    """A folder of its own for each call: a second call never touches files that a first one reads."""
    return scratch_path(spark, name, uuid.uuid4().hex[:12])


RAW_COLS = ", ".join(S.RAW_COLUMNS)
CLEANED_COLS = RAW_COLS + ", source_file, ingestion_year, ingestion_month"
MONTH = (1996, 3)                       # the month read back or re-loaded
MONTH_FILE = "yellow_tripdata_1996-03.parquet"
CUTOFF = (2000, 1)                      # later months form the incremental batch
ROW_CAP = 5000

with_trips, with_cleaned = O.with_trips, O.with_cleaned


@register("scan_raw", with_trips("SELECT * FROM trips"))
def _scan_raw(spark, sf_dir):
    """Raw trips landed as parquet and scanned with the pinned schema."""
    path = save_path(A.raw_trips(spark, sf_dir), fresh(spark, "raw_scan"), "raw")
    return L.read_raw(spark, path, T.StructType(S.RAW_TRIP.fields + [
        T.StructField("source_file", T.StringType())]))


# Trips whose month files differ: by the month of the file, ids and passenger counts
# are int, bigint or double, and every fourth month has no surcharge column.
DRIFT_TYPES = ("int", "bigint", "double")
DRIFT_COLUMNS = ("VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID", "passenger_count")
_FILE_MONTH_NO = "CAST(substr(source_file, 22, 2) AS INTEGER)"
_DRIFTED = "CASE WHEN {} % 4 = 0 THEN NULL ELSE improvement_surcharge END AS improvement_surcharge".format(_FILE_MONTH_NO)


def land_drifted(spark, sf_dir, root: str) -> None:
    """Land the trips as month files of differing types: the trips are made and dealt by month
    once, then a few jobs each write the months of one type from that landing, without a shuffle."""
    trips, plain = A.raw_trips(spark, sf_dir), fresh(spark, "plain")
    land_month_files(trips, plain)
    raw = spark.read.schema(trips.schema).parquet(plain).withColumn("_m", F.substring("source_file", 22, 2).cast("int"))
    for i, kind in enumerate(DRIFT_TYPES):
        for absent in (False, True):
            part = raw.where((F.col("_m") % 3 == i) & ((F.col("_m") % 4 == 0) == F.lit(absent)))
            part = part.withColumns({c: F.col(c).cast(kind) for c in DRIFT_COLUMNS})
            drop = ["_m", "improvement_surcharge"] if absent else ["_m"]
            part.drop(*drop).write.mode("append").partitionBy("source_file").parquet(root)
    L.remove(spark, plain)


@register("scan_drifted", with_trips(f"SELECT * REPLACE ({_DRIFTED}) FROM trips"))
def _scan_drifted(spark, sf_dir):
    """Every month file of a landing whose types differ, read as one table in the pinned types."""
    root = fresh(spark, "drifted")
    land_drifted(spark, sf_dir, root)
    months = [f"{root}/{f}" for f in L.folders(spark, root)]
    return L.drift.conform(L.drift.read_files(spark, months, name_files=True))


@register("drift_report", with_trips(f"""
, files AS (SELECT DISTINCT source_file, {_FILE_MONTH_NO} AS m FROM trips),
kinds AS (SELECT unnest(['VendorID', 'PULocationID', 'DOLocationID']) AS column_name, 'int' AS stored_type
  UNION ALL SELECT unnest(['RatecodeID', 'payment_type', 'passenger_count']), 'bigint')
SELECT column_name, ['int', 'bigint', 'double'][m % 3 + 1] AS file_type, 'double' AS read_type, stored_type,
  CASE m % 3 WHEN 2 THEN 'narrowed' ELSE 'widened' END AS action, count(*) AS months
FROM kinds, files GROUP BY ALL
UNION ALL SELECT 'improvement_surcharge', CASE WHEN m % 4 <> 0 THEN 'double' END, 'double', 'double',
  CASE WHEN m % 4 = 0 THEN 'absent' ELSE 'same' END, count(*) FROM files GROUP BY ALL"""))
def _drift_report(spark, sf_dir):
    """What is read as another type, narrowed or absent in a landing whose types differ, in months."""
    root = fresh(spark, "drift_report")
    land_drifted(spark, sf_dir, root)
    months = [f"{root}/{f}" for f in L.folders(spark, root)]
    report = L.drift.schema_report(spark, months, count="paths")
    return (report.where(F.col("column_name").isin(*DRIFT_COLUMNS, "improvement_surcharge"))
            .select("column_name", "file_type", "read_type", "stored_type", "action", F.col("files").cast("bigint").alias("months")))


@register("land_raw", with_trips("SELECT * FROM trips"))
def _land_raw(spark, sf_dir):
    return L.land_raw(A.raw_trips(spark, sf_dir), fresh(spark, "raw_landed"))


_SPAN = """span AS (
  SELECT unnest(generate_series(date_trunc('month', min(tpep_pickup_datetime)),
                                date_trunc('month', max(tpep_pickup_datetime)), INTERVAL 1 MONTH)) AS m
  FROM trips)"""


@register("month_plan", with_trips(f""", {_SPAN}
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
       printf('yellow_tripdata_%04d-%02d.parquet', year(m), month(m)) AS file_name FROM span"""))
def _month_plan(spark, sf_dir):
    """Every month from the first to the last raw pickup month."""
    return L.month_span(A.raw_trips(spark, sf_dir))


_FILE = "printf('yellow_tripdata_%04d-%02d.parquet', y, m)"
_MONTH_LIST = "1, 4,11"


@register("month_plan_modes", with_trips(f""", years AS (
  SELECT CAST(year(min(tpep_pickup_datetime)) AS INTEGER) AS lo, CAST(year(max(tpep_pickup_datetime)) AS INTEGER) AS hi FROM trips),
plans AS (SELECT 'single_month' AS mode, lo AS y, 3 AS m FROM years
  UNION ALL SELECT 'one_year', hi, unnest(range(1, 13)) FROM years
  UNION ALL SELECT 'year_range', y, unnest(range(1, 13)) FROM (SELECT unnest(range(lo, hi + 1)) AS y FROM years)
  UNION ALL SELECT 'months', lo, unnest([1, 4, 11]) FROM years)
SELECT mode, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, {_FILE} AS file_name FROM plans"""))
def _month_plan_modes(spark, sf_dir):
    """The four validated plans, for the years of the data."""
    lo, hi = A.raw_trips(spark, sf_dir).agg(F.year(F.min("tpep_pickup_datetime")),
                                            F.year(F.max("tpep_pickup_datetime"))).first()
    plans = {"single_month": {"year": lo, "month": 3}, "one_year": {"year": hi},
             "year_range": {"start_year": lo, "end_year": hi}, "months": {"year": lo, "months": _MONTH_LIST}}
    out = None
    for mode, args in plans.items():
        part = L.month_plan(spark, mode, **args).select(F.lit(mode).alias("mode"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("month_file_names", with_trips("""
SELECT source_file, printf('yellow_tripdata_%04d-%02d.parquet', year(tpep_pickup_datetime),
       month(tpep_pickup_datetime)) AS file_name, COUNT(*) AS trips
FROM trips WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1, 2"""))
def _month_file_names(spark, sf_dir):
    """The file name of each pickup month next to the file a trip came from."""
    t = A.raw_trips(spark, sf_dir).where(F.col("tpep_pickup_datetime").isNotNull())
    return t.groupBy("source_file", month_file_name(F.year("tpep_pickup_datetime"),
                                                    F.month("tpep_pickup_datetime")).alias("file_name")
                     ).agg(F.count(F.lit(1)).alias("trips"))


@register("write_cleaned_partitions", with_cleaned(
    f"SELECT {CLEANED_COLS}, ingestion_year AS year, ingestion_month AS month FROM cleaned"))
def _write_cleaned_partitions(spark, sf_dir):
    """Cleaned partitions read from the root: year and month come back as ints."""
    b = star_for(spark, sf_dir)
    return spark.read.parquet(b.cleaned_path)


@register("read_cleaned_month", with_cleaned(
    f"SELECT {CLEANED_COLS} FROM cleaned WHERE ingestion_year = {MONTH[0]} AND ingestion_month = {MONTH[1]}"))
def _read_cleaned_month(spark, sf_dir):
    b = star_for(spark, sf_dir)
    return L.read_cleaned(spark, b.cleaned_path, *MONTH)


@register("row_cap", with_cleaned(
    f"SELECT {CLEANED_COLS} FROM cleaned ORDER BY "
    + ", ".join(c + " NULLS FIRST" for c in CLEANED_COLS.split(", ")) + f" LIMIT {ROW_CAP}"))
def _row_cap(spark, sf_dir):
    """The row cap as a top-k in a total order, materialised once."""
    b = star_for(spark, sf_dir)
    cleaned = b.cleaned(spark).select(*CLEANED_COLS.split(", "))
    return save_table(L.row_cap(cleaned, ROW_CAP), b.base, "capped")


_SPAN_FILE = "printf('yellow_tripdata_%04d-%02d.parquet', year(m), month(m))"


@register("ingest_ledger", "WITH " + O.TRIPS + "," + O.CLEANED + f""", {_SPAN},
planted AS (SELECT max(m) + INTERVAL 1 MONTH AS m FROM span)
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, {_SPAN_FILE} AS file_name,
       CASE WHEN c.n IS NULL THEN 'skipped' ELSE 'loaded' END AS status,
       CAST(coalesce(c.n, 0) AS BIGINT) AS rows,
       CASE WHEN c.n IS NULL THEN 'no data for ' || {_SPAN_FILE} END AS error
FROM span LEFT JOIN (SELECT ingestion_year, ingestion_month, count(*) AS n FROM cleaned GROUP BY 1, 2) c
  ON c.ingestion_year = year(m) AND c.ingestion_month = month(m)
UNION ALL SELECT CAST(year(m) AS INTEGER), CAST(month(m) AS INTEGER), {_SPAN_FILE}, 'failed', 0, 'not a parquet file' FROM planted""")
def _ingest_ledger(spark, sf_dir):
    """Every month cleaned by jobs of its own, from landed month files; the month
    after the last is a planted file that is not Parquet (S10)."""
    raw, base = A.raw_trips(spark, sf_dir), fresh(spark, "ledger")
    land_month_files(raw, f"{base}/raw")
    span = L.month_span(raw)
    last = span.agg(F.max(F.make_date("year", "month", F.lit(1))).alias("m")).select(
        F.add_months("m", 1).alias("m")).where("m IS NOT NULL")
    bad = last.select(F.year("m").alias("year"), F.month("m").alias("month"),
                      month_file_name(F.year("m"), F.month("m")).alias("file_name"))
    for r in bad.collect():
        bad.select(F.lit("no parquet here").alias("value")).write.text(f"{base}/raw/source_file={r.file_name}")

    def one(year, month, name):
        return L.clean_month(spark, f"{base}/raw", f"{base}/cleaned", year, month, name, folder=f"source_file={name}")

    ledger = L.ingest_months(spark, span.unionByName(bad), one, threads=8)
    # The engine's message is kept in the ledger; the query states the kind, which an oracle can.
    return ledger.withColumn("error", F.when(F.col("status") == "failed", F.lit("not a parquet file"))
                             .otherwise(F.col("error")))


@register("largest_file")
def _largest_file(spark, sf_dir):
    """The largest parquet file of the cleaned lake (S11); paths vary per run."""
    return L.largest_file(spark, star_for(spark, sf_dir).cleaned_path)


@register("dim_append", with_cleaned("""
, seeds AS (SELECT * FROM (VALUES (1, 1), (2, 2)) s(vendor_key, vendor_id))
SELECT vendor_key, vendor_id FROM seeds
UNION ALL
SELECT CAST(2 + row_number() OVER (ORDER BY vendor_id) AS INTEGER), vendor_id FROM (
  SELECT DISTINCT CAST(VendorID AS INTEGER) AS vendor_id FROM cleaned
  WHERE VendorID IS NOT NULL AND CAST(VendorID AS INTEGER) NOT IN (1, 2))"""))
def _dim_append(spark, sf_dir):
    """Reference rows first, then the trips' new vendors appended only when
    there are any (S08, W02)."""
    b = star_for(spark, sf_dir)
    spec = W.DIM_BY_NAME["dim_vendor"]
    path = fresh(spark, "dim_append")
    seeded = W.seed_dim(spec, spark.createDataFrame([], S.DIM_VENDOR))
    seeded.write.mode("overwrite").parquet(path)
    existing = spark.read.parquet(path)
    new = W.dense_keys(W.new_members(b.cleaned(spark), spec.sources, existing, spec.id_col),
                       [spec.id_col], spec.key_col, offset=W.max_key(existing, spec.key_col),
                       key_type="int")
    L.append_if_rows(new, path)
    return spark.read.parquet(path)


# ---- rules (F01-F09) ----------------------------------------------------------

@register("clean_trips", with_cleaned(f"SELECT {RAW_COLS}, source_file FROM cleaned"))
def _clean_trips(spark, sf_dir):
    return FR.clean(A.raw_trips(spark, sf_dir))


_REJECT_SQL = with_trips("\nUNION ALL\n".join(
    f"SELECT {i + 1} AS rule_order, '{name}' AS rule, "
    f"CAST(count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS BIGINT) AS rejected FROM trips"
    for i, (name, cond) in enumerate([
        ("passenger_count_positive", "passenger_count > 0"),
        ("trip_distance_positive", "trip_distance > 0"),
        ("fare_amount_positive", "fare_amount > 0"),
        ("pickup_present", "tpep_pickup_datetime IS NOT NULL"),
        ("dropoff_present", "tpep_dropoff_datetime IS NOT NULL"),
        ("pickup_before_dropoff", "tpep_pickup_datetime < tpep_dropoff_datetime"),
        ("pu_location_present", "PULocationID IS NOT NULL"),
        ("do_location_present", "DOLocationID IS NOT NULL")])))


@register("clean_rejects", _REJECT_SQL)
def _clean_rejects(spark, sf_dir):
    return FR.reject_profile(A.raw_trips(spark, sf_dir))


@register("provenance", with_cleaned(f"SELECT {CLEANED_COLS} FROM cleaned"))
def _provenance(spark, sf_dir):
    return FR.with_provenance(FR.clean(A.raw_trips(spark, sf_dir))).select(*CLEANED_COLS.split(", "))


@register("coerce_ts", with_trips("""
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, total_amount FROM trips"""))
def _coerce_ts(spark, sf_dir):
    """Timestamps that arrive as text are parsed back; bad text gives null."""
    t = A.raw_trips(spark, sf_dir).select(
        F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime"), "total_amount")
    return FR.coerce_ts(t, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])


_ML_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in FR.ML_REQUIRED)


@register("drop_required_nulls", with_trips(f"SELECT * FROM trips WHERE {_ML_NOT_NULL}"))
def _drop_required_nulls(spark, sf_dir):
    return FR.drop_null_rows(A.raw_trips(spark, sf_dir))


@register("ml_filter", with_trips(f"""
SELECT * FROM trips WHERE {_ML_NOT_NULL} AND passenger_count > 0 AND trip_distance > 0
  AND total_amount > 0 AND tpep_pickup_datetime < tpep_dropoff_datetime
  AND trip_distance < 100 AND total_amount < 300"""))
def _ml_filter(spark, sf_dir):
    return FR.ml_filter(FR.drop_null_rows(A.raw_trips(spark, sf_dir)))


WINDOW = ("1996-01-01", "1997-06-30")


@register("date_window", star(f"""
SELECT f.trip_key, d.ts AS pickup_ts FROM {PU}
WHERE d.ts >= TIMESTAMP '{WINDOW[0]} 00:00:00' AND d.ts < TIMESTAMP '{WINDOW[1]} 00:00:00' + INTERVAL 1 DAY"""))
def _date_window(spark, sf_dir):
    """Facts in a half-open pickup-day window."""
    return R.trips(warehouse(spark, sf_dir), *WINDOW).select("trip_key", "pickup_ts")


report("daily_trips_window", R.daily_trips, star(f"""
SELECT d.date AS day, COUNT(*) AS trips FROM {PU}
WHERE d.ts >= TIMESTAMP '{WINDOW[0]} 00:00:00' AND d.ts < TIMESTAMP '{WINDOW[1]} 00:00:00' + INTERVAL 1 DAY
GROUP BY 1"""), start=WINDOW[0], end=WINDOW[1])

report("kpi_window", R.kpi, star(f"""
SELECT COUNT(*) AS trips, {am('f.passenger_count')} AS avg_passengers,
       {am('f.trip_distance')} AS avg_distance, {sm('f.total_amount')} AS total_revenue,
       {am('f.fare_amount')} AS avg_fare, {am('f.tip_amount')} AS avg_tip
FROM {PU}
WHERE d.ts >= TIMESTAMP '{WINDOW[0]} 00:00:00' AND d.ts < TIMESTAMP '{WINDOW[1]} 00:00:00' + INTERVAL 1 DAY"""),
       start=WINDOW[0], end=WINDOW[1])

# ---- joins and warehouse jobs (J01, J02, W04, W08, W10) ----------------------

_BATCH = f"(ingestion_year > {CUTOFF[0]} OR (ingestion_year = {CUTOFF[0]} AND ingestion_month >= {CUTOFF[1]}))"


def _batch(cleaned):
    y, m = F.col("ingestion_year"), F.col("ingestion_month")
    is_new = (y > CUTOFF[0]) | ((y == CUTOFF[0]) & (m >= CUTOFF[1]))
    return cleaned.where(is_new), cleaned.where(~is_new)


def _new_members_sql(sources, ident, cast="INTEGER"):
    def ids(where):
        return " UNION ".join(f"SELECT CAST({s} AS {cast}) AS {ident} FROM cleaned WHERE {s} IS NOT NULL AND {where}"
                              for s in sources)
    return with_cleaned(f"""
SELECT DISTINCT {ident} FROM ({ids(_BATCH)})
WHERE {ident} NOT IN (SELECT {ident} FROM ({ids('NOT ' + _BATCH)}))""")


def _new_members_query(sources, ident, cast="int"):
    def run(spark, sf_dir):
        """Members of the latest months' batch not in the dimension loaded from
        the earlier months (J01)."""
        batch, earlier = _batch(star_for(spark, sf_dir).cleaned(spark))
        known = W.distinct_members(earlier, sources, ident, cast)
        return W.new_members(batch, sources, known, ident, cast)
    return run


for _name, _src, _id, _cast, _sqlcast in [
        ("vendor", ["VendorID"], "vendor_id", "int", "INTEGER"),
        ("rate", ["RatecodeID"], "rate_code_id", "int", "INTEGER"),
        ("payment", ["payment_type"], "payment_type_id", "int", "INTEGER"),
        ("location", ["PULocationID", "DOLocationID"], "location_id", "int", "INTEGER"),
        ("datetime", ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "ts", "timestamp_ntz",
         "TIMESTAMP")]:
    register(f"new_members_{_name}", _new_members_sql(_src, _id, _sqlcast))(
        _new_members_query(_src, _id, _cast))


@register("fact_enrich", star("SELECT * FROM fact_base"))
def _fact_enrich(spark, sf_dir):
    """Seven left joins from natural ids to keys."""
    b = star_for(spark, sf_dir)
    return W.resolve_keys(b.cleaned(spark), b.wh).select(*S.FACT_COLUMNS)


@register("seed_dims", star("""
SELECT 'dim_vendor' AS dimension, vendor_key AS key, vendor_id AS id FROM dim_vendor WHERE vendor_id IN (1, 2)
UNION ALL SELECT 'dim_rate_code', rate_code_key, rate_code_id FROM dim_rate_code WHERE rate_code_id BETWEEN 1 AND 6
UNION ALL SELECT 'dim_payment_type', payment_type_key, payment_type_id FROM dim_payment_type
  WHERE payment_type_id BETWEEN 1 AND 6"""))
def _seed_dims(spark, sf_dir):
    """The reference rows as loaded: seeded after the data, keys after the max.
    Seeding twice adds nothing."""
    wh = W.seed_dims(warehouse(spark, sf_dir))   # a second seed: repeat-safe
    parts = []
    for spec in W.SMALL_DIMS:
        if spec.seeds:
            d = getattr(wh, spec.name)
            parts.append(d.where(F.col(spec.id_col).isin(*spec.seeds)).select(
                F.lit(spec.name).alias("dimension"), F.col(spec.key_col).alias("key"),
                F.col(spec.id_col).alias("id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_TABLE_COUNTS_SQL = SQL["table_counts"]


@register("load_modes_full", _TABLE_COUNTS_SQL)
def _load_modes_full(spark, sf_dir):
    """q1 then q2 into a fresh folder: the same warehouse as full mode."""
    base = fresh(spark, "load_modes")
    P.run(spark, A.raw_trips(spark, sf_dir), base, "q1")
    return R.table_counts(P.run(spark, None, base, "q2").warehouse)


_PER_FILE = """
SELECT source_file, COUNT(*) AS trips, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
FROM fact_trip GROUP BY 1"""


def _per_file(facts):
    return facts.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue"))


@register("load_batches_twice", star(_PER_FILE.replace("AS revenue", "AS revenue, CAST(0 AS BIGINT) AS violations")))
def _load_batches_twice(spark, sf_dir):
    """The months of one year after the other on one warehouse, then all of them
    again: every month's facts are there once and no constraint is violated (W08, W10)."""
    base = fresh(spark, "load_twice")
    raw = A.raw_trips(spark, sf_dir)
    P.run(spark, raw, base, "q1")
    months = P.month_files(raw)
    for year in sorted({m.split("_")[-1][:4] for m in months}):
        P.run(spark, None, base, "q2", months=[m for m in months if f"_{year}-" in m])
    wh = P.run(spark, None, base, "q2").warehouse
    bad = W.constraint_violations(wh).agg(F.sum("violations")).scalar()
    return _per_file(wh.fact_trip).withColumn("violations", bad.cast("bigint"))


@register("reload_idempotent", star(_PER_FILE))
def _reload_idempotent(spark, sf_dir):
    """Re-loading a month replaces its facts instead of adding them twice.

    The reload changes the fact table in place, so it runs on a warehouse of
    its own, loaded from the same cleaned months as the shared one."""
    base = fresh(spark, "reload")
    cleaned = star_for(spark, sf_dir).cleaned(spark)
    wh = load_batch(cleaned, W.empty_warehouse(spark), base)
    wh = reload_source(wh, cleaned.where(F.col("source_file") == MONTH_FILE), base)
    return _per_file(wh.fact_trip)


@register("reload_emptied_month", star(f"""
, per_file AS ({_PER_FILE})
SELECT p.*, 'skipped' AS ledger_status, CAST(0 AS BIGINT) AS lake_rows FROM per_file p WHERE source_file <> '{MONTH_FILE}'"""))
def _reload_emptied_month(spark, sf_dir):
    """A month whose new file has no trip that passes the rules: its facts go, the
    others stay, and the ledger says so (S05, S10, W08, W10)."""
    base = fresh(spark, "emptied")
    raw = A.raw_trips(spark, sf_dir)
    P.run(spark, raw, base)
    month = raw.where(F.col("source_file") == MONTH_FILE)
    L.land_raw(month.drop("source_file").withColumn("fare_amount", -F.col("fare_amount")), f"{base}/raw/{MONTH_FILE}")
    ledger = P.run_months(spark, L.month_plan(spark, "single_month", *MONTH), f"{base}/raw", base)
    left = L.read_months(spark, f"{base}/cleaned", [MONTH_FILE]).agg(F.count(F.lit(1))).scalar()
    facts = open_warehouse(spark, base).fact_trip
    return _per_file(facts).select("*", ledger.select("status").scalar().alias("ledger_status"), left.alias("lake_rows"))


_AUDIT_BATCH = f"{_BATCH.replace('ingestion_year', 'y').replace('ingestion_month', 'm')}"


@register("audit_batch", star(f"""
, batch AS (SELECT * FROM (SELECT *, CAST(substr(source_file, 17, 4) AS INTEGER) AS y, {_FILE_MONTH_NO} AS m FROM fact_trip)
  WHERE {_AUDIT_BATCH}),
numbered AS (SELECT *, row_number() OVER (ORDER BY trip_key) AS k FROM batch),
counts AS (SELECT count(*) FILTER (WHERE k % 1000 = 0) AS repeated, count(*) FILTER (WHERE k % 777 = 0) AS lost,
  count(*) FILTER (WHERE k % 555 = 0 AND k % 777 <> 0) AS strayed FROM numbered)
SELECT 'clean' AS batch, check_name, CAST(0 AS BIGINT) AS violations, FALSE AS refused
FROM (SELECT unnest(['unique_trip_key', 'new_trip_key', 'not_null_trip_key', 'not_null_pickup_datetime_key',
  'not_null_dropoff_datetime_key', {', '.join(f"'orphan_{fk}'" for fk, _, _ in W.FK_CHECKS)}]) AS check_name)
UNION ALL SELECT 'planted', check_name, CASE check_name WHEN 'unique_trip_key' THEN repeated
  WHEN 'not_null_pickup_datetime_key' THEN lost WHEN 'orphan_pu_location_key' THEN strayed ELSE 0 END, TRUE
FROM counts, (SELECT unnest(['unique_trip_key', 'new_trip_key', 'not_null_trip_key', 'not_null_pickup_datetime_key',
  'not_null_dropoff_datetime_key', {', '.join(f"'orphan_{fk}'" for fk, _, _ in W.FK_CHECKS)}]) AS check_name)"""))
def _audit_batch(spark, sf_dir):
    """The latest months staged onto the warehouse of the earlier ones and audited:
    once as they are, and once with repeated keys, lost pickup keys and locations
    without a dimension row planted, which is refused (W06, J11)."""
    base = fresh(spark, "audit")
    batch, earlier = _batch(star_for(spark, sf_dir).cleaned(spark))
    wh = load_batch(earlier, W.empty_warehouse(spark), base)
    clean = stage_batch(batch, wh, base)
    k = F.col("trip_key") - wh.state.max_trip_key
    facts = clean.facts.withColumns({
        "pickup_datetime_key": F.when(k % 777 != 0, F.col("pickup_datetime_key")),
        "pu_location_key": F.when((k % 555 == 0) & (k % 777 != 0), -1).otherwise(F.col("pu_location_key"))})
    twice = clean.facts.where(k % 1000 == 0)
    planted = stage_facts(facts.unionByName(twice), clean.wh, wh, base, "planted")
    try:
        publish_batch(planted, base)
        refused = False
    except LoadRefused:
        refused = open_warehouse(spark, base).state == wh.state
    return (clean.audit.select(F.lit("clean").alias("batch"), "*", F.lit(False).alias("refused"))
            .unionByName(planted.audit.select(F.lit("planted").alias("batch"), "*", F.lit(refused).alias("refused"))))


@register("stream_facts", star(_PER_FILE.replace("AS revenue", "AS revenue, CAST(0 AS BIGINT) AS violations")))
def _stream_facts(spark, sf_dir):
    """Month files as a stream into a warehouse; the landing folder holds them all
    when the stream starts, and it is started twice: each fact is there once (S10)."""
    base = fresh(spark, "stream_facts")
    land_month_files(A.raw_trips(spark, sf_dir), f"{base}/raw")
    for _ in range(2):
        P.stream_months(spark, f"{base}/raw", base, f"{base}/stream", files_per_batch=1000).awaitTermination()
    wh = open_warehouse(spark, base)
    bad = W.constraint_violations(wh).agg(F.sum("violations")).scalar()
    return _per_file(wh.fact_trip).withColumn("violations", bad.cast("bigint"))


# The counting reports from the kept partial sums of each month, with the SQL of the reports over the facts.
ROLLUP_REPORTS = ("kpi", "kpi_rounded", "daily_metrics", "daily_rounded", "daily_trimmed", "hourly_fares", "hourly_rounded",
                  "dow_trips", "dow_rounded", "dow_hour", "dow_hour_matrix", "payment_mix", "payment_mix_fact", "rate_mix",
                  "rate_top_other", "payment_stats", "vendor_stats", "rate_stats", "pickup_counts", "top_dropoffs",
                  "top_tip_locations", "tip_by_location", "source_files", "passenger_share")


def _rollup_report(name, fn, **params):
    register(f"rollup_{name}", SQL[name])(
        lambda spark, sf_dir: fn(warehouse(spark, sf_dir).answering_from_rollup(), **params))


for _n in ROLLUP_REPORTS:
    _rollup_report(_n, getattr(R, _n), **({"floor": DAY_FLOOR} if _n == "daily_trimmed" else {}))
register("rollup_kpi_window", SQL["kpi_window"])(
    lambda spark, sf_dir: R.kpi(warehouse(spark, sf_dir).answering_from_rollup(), *WINDOW))


@register("split_share", with_cleaned(f"""
SELECT count(*) AS rows, CAST(ceil(0.2 * count(*)) AS BIGINT) AS test_rows FROM cleaned WHERE
  tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND passenger_count > 0 AND trip_distance > 0
  AND total_amount > 0 AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
  AND tpep_pickup_datetime < tpep_dropoff_datetime AND trip_distance < 100 AND total_amount < 300"""))
def _split_share(spark, sf_dir):
    """The test part is exactly a fifth of the model rows, rounded up."""
    return _rows(spark, sf_dir)[0].agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "test").alias("test_rows"))


@register("summary_sketched", star(f""", {_MEASURED},
v AS ({" UNION ALL ".join(f"SELECT '{m}' AS measure, CAST({m} AS DOUBLE) AS x FROM measured" for m in SK.MEASURES)})
SELECT measure, count(x) AS n, min(x) AS low, max(x) AS high, TRUE AS within FROM v WHERE x IS NOT NULL GROUP BY 1""").replace(
    "\n, measured AS", ",\nmeasured AS"))
def _summary_sketched(spark, sf_dir):
    """Quartiles from the kept sketches of all months, each within the stated rank error of the exact one."""
    wh = warehouse(spark, sf_dir)
    ok = SK.checked_quantiles(wh.fact_trip, wh.sketches).groupBy("measure").agg(F.bool_and("within").alias("within"))
    return SK.quantiles(wh.sketches).select("measure", "n", "low", "high").join(ok, "measure")


@register("reopened_warehouse", _TABLE_COUNTS_SQL)
def _reopened_warehouse(spark, sf_dir):
    """The saved warehouse opened by its folder, and its tables read by name."""
    base = star_for(spark, sf_dir).base
    counts = [read_table(spark, base, n).agg(F.count(F.lit(1)).alias("count")).select(
        F.lit(n).alias("table_name"), "count") for n in open_warehouse(spark, base).tables()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# ---- zones (S12-S14, J09, J12, A18, A23-A26, A37) -----------------------------

def zone_report(name, fn, sql, **params):
    def run(spark, sf_dir):
        b = star_for(spark, sf_dir)
        return fn(b.zones(spark), b.wh, **params)
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql


zstar = lambda sql: O.star(sql, zones=True)

register("zone_scan", O.with_zones("SELECT location_id, zone, borough, geometry FROM zones"))(
    lambda spark, sf_dir: star_for(spark, sf_dir).zones(spark))

register("zone_centroids", O.with_zones(
    "SELECT location_id, zone, borough, centroid_lon, centroid_lat, n_rings, n_points FROM zone_centroids"))(
    lambda spark, sf_dir: Z.zone_centroids(star_for(spark, sf_dir).zones(spark)))

register("zone_ids_load", zstar("""
SELECT DISTINCT location_id FROM zones WHERE location_id NOT IN (SELECT location_id FROM dim_location)"""))(
    lambda spark, sf_dir: ZS.zone_ids_to_load(star_for(spark, sf_dir).zone_text(spark),
                                              warehouse(spark, sf_dir).dim_location))


@register("zone_ids_loaded", zstar("""
, fresh AS (SELECT DISTINCT location_id FROM zones WHERE location_id NOT IN (SELECT location_id FROM dim_location))
SELECT location_key, location_id FROM dim_location
UNION ALL SELECT CAST((SELECT max(location_key) FROM dim_location) + row_number() OVER (ORDER BY location_id) AS INTEGER),
  location_id FROM fresh"""))
def _zone_ids_loaded(spark, sf_dir):
    """The lookup's ids numbered and added to the location dimension; again adds nothing."""
    b, base = star_for(spark, sf_dir), fresh(spark, "zone_ids")
    text, wh = b.zone_text(spark), W.empty_warehouse(spark).replace(dim_location=b.wh.dim_location)
    return load_zone_ids(load_zone_ids(wh, text, base), text, base).dim_location


@register("location_map", O.with_zones("SELECT location_id, zone FROM zones WHERE location_id IS NOT NULL"))
def _location_map(spark, sf_dir):
    """id -> zone JSON written and read back."""
    b = star_for(spark, sf_dir)
    path = fresh(spark, "location_map")
    ZS.write_location_map(b.zones(spark), path)
    return ZS.read_location_map(spark, path)


_ZMAP = f"""zmap AS (
  SELECT z.location_id, z.zone, z.borough, z.centroid_lon, z.centroid_lat,
         CAST(coalesce(c.trips, 0) AS BIGINT) AS trips
  FROM zone_centroids z LEFT JOIN (
    SELECT CAST(l.location_id AS INTEGER) AS location_id, COUNT(*) AS trips
    FROM {PU} JOIN dim_location l ON f.pu_location_key = l.location_key GROUP BY 1) c
  ON c.location_id = z.location_id)"""

zone_report("zone_map", Z.zone_map, zstar(f", {_ZMAP}\nSELECT * FROM zmap"))

zone_report("zone_tiers", Z.zone_tiers, zstar(f""", {_ZMAP},
zc AS (SELECT * FROM zmap WHERE centroid_lon IS NOT NULL AND centroid_lat IS NOT NULL),
q AS (SELECT round(quantile_cont(CAST(trips AS DOUBLE), 0.9), 6) AS q90,
             round(quantile_cont(CAST(trips AS DOUBLE), 0.98), 6) AS q98 FROM zc)
SELECT location_id, trips, centroid_lon, centroid_lat,
       CASE WHEN trips <= q90 THEN 'base' WHEN trips <= q98 THEN 'hot' ELSE 'peak' END AS tier
FROM zc, q"""))

zone_report("map_extent", Z.map_extent, zstar(f""", {_ZMAP},
zc AS (SELECT * FROM zmap WHERE centroid_lon IS NOT NULL AND centroid_lat IS NOT NULL),
ref AS (SELECT * FROM zc WHERE trips > 0 OR NOT EXISTS (SELECT 1 FROM zc WHERE trips > 0)),
ext AS (SELECT quantile_cont(centroid_lon, 0.01) AS x0, quantile_cont(centroid_lon, 0.99) AS x1,
             quantile_cont(centroid_lat, 0.01) AS y0, quantile_cont(centroid_lat, 0.99) AS y1 FROM ref)
SELECT round(x0 - (x1 - x0) * 0.05, 6) AS x_min, round(x1 + (x1 - x0) * 0.05, 6) AS x_max,
       round(y0 - (y1 - y0) * 0.05, 6) AS y_min, round(y1 + (y1 - y0) * 0.05, 6) AS y_max FROM ext"""))

zone_report("borough_mix", Z.borough_mix, zstar(f""", {_ZMAP},
bt AS (SELECT borough, CAST(sum(trips) AS BIGINT) AS trips FROM zmap WHERE borough IS NOT NULL
       GROUP BY 1 ORDER BY trips DESC, borough LIMIT 6),
tl AS (SELECT CAST(l.location_id AS INTEGER) AS location_id, {am('f.tip_amount')} AS avg_tip
       FROM {PU} JOIN dim_location l ON f.pu_location_key = l.location_key GROUP BY 1),
tb AS (SELECT z.borough, round(CAST(sum(CAST(tl.avg_tip AS DECIMAL(18,6))) AS DOUBLE) / count(tl.avg_tip), 6) AS avg_tip FROM zones z
       LEFT JOIN tl ON tl.location_id = z.location_id WHERE z.borough IS NOT NULL GROUP BY 1)
SELECT bt.borough, bt.trips, tb.avg_tip, format('{{:,}}', bt.trips) AS trips_text,
       coalesce('$' || printf('%.2f', tb.avg_tip), '-') AS avg_tip_text
FROM bt LEFT JOIN tb ON tb.borough = bt.borough"""))


@register("zone_name_to_id", zstar("""
, names AS (SELECT zone, max(location_id) AS location_id FROM zones
            WHERE location_id IS NOT NULL AND zone IS NOT NULL GROUP BY 1),
req AS (SELECT f.trip_key, pz.zone AS pu_zone, dz.zone AS do_zone
        FROM fact_trip f
        JOIN dim_location pl ON pl.location_key = f.pu_location_key
        JOIN dim_location dl ON dl.location_key = f.do_location_key
        LEFT JOIN zones pz ON pz.location_id = pl.location_id
        LEFT JOIN zones dz ON dz.location_id = dl.location_id)
SELECT req.trip_key, req.pu_zone, req.do_zone, pn.location_id AS PULocationID, dn.location_id AS DOLocationID
FROM req LEFT JOIN names pn ON pn.zone = req.pu_zone LEFT JOIN names dn ON dn.zone = req.do_zone"""))
def _zone_name_to_id(spark, sf_dir):
    """Zone names of every trip's pickup and dropoff mapped back to ids."""
    b = star_for(spark, sf_dir)
    zones = b.zones(spark)
    req = _zone_requests(b.wh, zones)
    out = Z.zone_ids_for_names(req, zones, "pu_zone", "PULocationID")
    out = Z.zone_ids_for_names(out, zones, "do_zone", "DOLocationID")
    return out.select("trip_key", "pu_zone", "do_zone", "PULocationID", "DOLocationID")


def _zone_requests(wh, zones, *carry):
    """Per trip: pickup and dropoff zone names (a form request per trip), and the fact columns ``carry``."""
    loc = wh.dim_location
    zn = Z.small(zones.select("location_id", "zone"))
    pl = loc.select(F.col("location_key").alias("pu_location_key"), F.col("location_id").alias("pu_id"))
    dl = loc.select(F.col("location_key").alias("do_location_key"), F.col("location_id").alias("do_id"))
    f = (wh.fact_trip.select("trip_key", "pu_location_key", "do_location_key", *carry)
         .join(bounded(pl, loc), "pu_location_key").join(bounded(dl, loc), "do_location_key"))
    f = f.join(zn.select(F.col("location_id").alias("pu_id"), F.col("zone").alias("pu_zone")), "pu_id", "left")
    return f.join(zn.select(F.col("location_id").alias("do_id"), F.col("zone").alias("do_zone")), "do_id", "left")

# ---- features and model (F05-F08, M01-M13) -----------------------------------

from farelake.operators import features as FE  # noqa: E402
from farelake.operators import model as MD  # noqa: E402

_ML_WHERE = f"""{_ML_NOT_NULL} AND passenger_count > 0 AND trip_distance > 0 AND total_amount > 0
  AND tpep_pickup_datetime < tpep_dropoff_datetime AND trip_distance < 100 AND total_amount < 300"""
_HASH_PARTS = ["CAST(epoch(tpep_pickup_datetime) AS BIGINT)", "CAST(epoch(tpep_dropoff_datetime) AS BIGINT)",
               "CAST(passenger_count AS BIGINT)", "CAST(round(trip_distance * 100) AS BIGINT)",
               "CAST(round(total_amount * 100) AS BIGINT)", *[f"CAST({c} AS BIGINT)" for c in FE.CATEGORICAL_CANDIDATES]]
_HASH = ("CAST('0x' || substr(md5('42|' || " + " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), 'None')" for p in _HASH_PARTS)
         + "), 1, 15) AS BIGINT)")
_CAT = ", ".join(f"coalesce(CAST(CAST({c} AS BIGINT) AS VARCHAR), 'None') AS {c}"
                 for c in FE.CATEGORICAL_CANDIDATES)
_MROWS = f"""mrows AS (
  SELECT CAST(passenger_count AS DOUBLE) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(hour(tpep_pickup_datetime) AS DOUBLE) AS pickup_hour,
         CAST(isodow(tpep_pickup_datetime) - 1 AS DOUBLE) AS pickup_dayofweek,
         CAST(month(tpep_pickup_datetime) AS DOUBLE) AS pickup_month, {_CAT},
         CAST(total_amount AS DOUBLE) AS total_amount,
         CASE WHEN row_number() OVER (ORDER BY {_HASH}) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM cleaned WHERE {_ML_WHERE}),
train AS (SELECT * FROM mrows WHERE split = 'train'),
test AS (SELECT * FROM mrows WHERE split = 'test')"""


def with_mrows(sql: str) -> str:
    return "WITH " + O.TRIPS + "," + O.CLEANED + ",\n" + _MROWS + "\n" + sql


def _cleaned(spark, sf_dir):
    return star_for(spark, sf_dir).cleaned(spark)


def _rows(spark, sf_dir):
    return FE.model_rows(_cleaned(spark, sf_dir))


@register("time_features", with_cleaned("""
SELECT tpep_pickup_datetime, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(isodow(tpep_pickup_datetime) - 1 AS INTEGER) AS pickup_dayofweek,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month FROM cleaned"""))
def _time_features(spark, sf_dir):
    return FE.time_features(_cleaned(spark, sf_dir)).select(
        "tpep_pickup_datetime", "pickup_hour", "pickup_dayofweek", "pickup_month")


@register("feature_matrix", with_mrows(
    "SELECT * EXCLUDE (split) FROM mrows"))
def _feature_matrix(spark, sf_dir):
    return FE.feature_matrix(_cleaned(spark, sf_dir))[0]


@register("train_test_split", with_mrows("SELECT * FROM mrows"))
def _train_test_split(spark, sf_dir):
    return _rows(spark, sf_dir)[0]


@register("impute_median", with_mrows("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.5), 6) AS median FROM train"
    for c in FE.NUMERIC_CANDIDATES)))
def _impute_median(spark, sf_dir):
    rows, spec = _rows(spark, sf_dir)
    return FE.fit_median(rows.where(F.col("split") == "train"), spec["numeric_cols"])


@register("impute_mode", with_mrows("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM train GROUP BY 1) "
    f"ORDER BY n DESC, v LIMIT 1) AS mode" for c in FE.CATEGORICAL_CANDIDATES)))
def _impute_mode(spark, sf_dir):
    rows, spec = _rows(spark, sf_dir)
    return FE.fit_mode(rows.where(F.col("split") == "train"), spec["categorical_cols"])


@register("ordinal_encode", with_mrows("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} AS value FROM train)" for c in FE.CATEGORICAL_CANDIDATES)))
def _ordinal_encode(spark, sf_dir):
    rows, spec = _rows(spark, sf_dir)
    return FE.fit_ordinal(rows.where(F.col("split") == "train"), spec["categorical_cols"])


_FEATS = FE.NUMERIC_CANDIDATES + FE.CATEGORICAL_CANDIDATES
_RAW_FEATURES = """raw_features AS (
  SELECT CAST(passenger_count AS DOUBLE) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
    CAST(hour(tpep_pickup_datetime) AS DOUBLE) AS pickup_hour,
    CAST(isodow(tpep_pickup_datetime) - 1 AS DOUBLE) AS pickup_dayofweek,
    CAST(month(tpep_pickup_datetime) AS DOUBLE) AS pickup_month, """ + ", ".join(
    f"CAST(CAST({c} AS BIGINT) AS VARCHAR) AS {c}" for c in FE.CATEGORICAL_CANDIDATES) + " FROM trips)"


def _raw_features(spark, sf_dir):
    """The features of every raw trip, with its nulls."""
    t = FE.time_features(A.raw_trips(spark, sf_dir))
    return t.select(*[F.col(c).cast("double").alias(c) for c in FE.NUMERIC_CANDIDATES],
                    *[F.col(c).cast("bigint").cast("string").alias(c) for c in FE.CATEGORICAL_CANDIDATES])


def _median_sql(c: str) -> str:
    return f"coalesce({c}, (SELECT round(quantile_cont({c}, 0.5), 6) FROM train)) AS {c}"


def _mode_sql(c: str) -> str:
    return (f"coalesce({c}, (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM train GROUP BY 1) "
            f"ORDER BY n DESC, v LIMIT 1)) AS {c}")


@register("imputed_rows", with_mrows(f", {_RAW_FEATURES}\nSELECT " + ", ".join(
    [_median_sql(c) for c in FE.NUMERIC_CANDIDATES] + [_mode_sql(c) for c in FE.CATEGORICAL_CANDIDATES])
    + " FROM raw_features"))
def _imputed_rows(spark, sf_dir):
    """Every raw trip's features, nulls filled with the training medians and modes."""
    rows, spec = _rows(spark, sf_dir)
    train = rows.where(F.col("split") == "train")
    medians = {r["column"]: r["median"] for r in FE.fit_median(train, spec["numeric_cols"]).collect()}
    modes = {r["column"]: r["mode"] for r in FE.fit_mode(train, spec["categorical_cols"]).collect()}
    return FE.impute_mode(FE.impute_median(_raw_features(spark, sf_dir), medians), modes)


_DICTS = ", ".join(f"dict_{c} AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code "
                   f"FROM (SELECT DISTINCT {c} AS value FROM train))" for c in FE.CATEGORICAL_CANDIDATES)


@register("encoded_rows", with_mrows(f", {_RAW_FEATURES}, {_DICTS}\nSELECT " + ", ".join(
    f"CAST(coalesce(dict_{c}.code, -1) AS DOUBLE) AS {c}" for c in FE.CATEGORICAL_CANDIDATES)
    + " FROM raw_features r " + " ".join(
    f"LEFT JOIN dict_{c} ON dict_{c}.value = coalesce(r.{c}, 'None')" for c in FE.CATEGORICAL_CANDIDATES)))
def _encoded_rows(spark, sf_dir):
    """Every raw trip's categories as training codes; those training never saw are -1."""
    rows, spec = _rows(spark, sf_dir)
    codes = FE.fit_ordinal(rows.where(F.col("split") == "train"), spec["categorical_cols"])
    cats = _raw_features(spark, sf_dir).select(*FE.CATEGORICAL_CANDIDATES).fillna(FE.NULL_TEXT)
    return FE.encode(cats, codes, spec["categorical_cols"])


SCENARIO = {"trip_distance": 8.0, "passenger_count": 2.0}


def _scenario_rows_df(spark, sf_dir):
    """A base record of zeros with the scenario's values, for each pickup and
    dropoff location pair of the cleaned trips."""
    spec = {"numeric_cols": FE.NUMERIC_CANDIDATES, "categorical_cols": FE.CATEGORICAL_CANDIDATES, "feature_cols": _FEATS}
    base = MD.scenarios(spark, spec, {"short": SCENARIO, "long": {**SCENARIO, "trip_distance": 25.0, "pickup_hour": 6}})
    pairs = _cleaned(spark, sf_dir).select(
        F.col("PULocationID").cast("bigint").cast("string").alias("PULocationID"),
        F.col("DOLocationID").cast("bigint").cast("string").alias("DOLocationID")).distinct()
    # Two rows: each pair takes both, through an array of literals rather than a join.
    rows = base.drop("PULocationID", "DOLocationID").collect()
    each = F.explode(F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in rows[0].asDict()]) for r in rows]))
    return pairs.select("*", each.alias("s")).select("s.*", "PULocationID", "DOLocationID")


@register("scenario_rows", with_cleaned("""
, pairs AS (SELECT DISTINCT CAST(CAST(PULocationID AS BIGINT) AS VARCHAR) AS PULocationID,
  CAST(CAST(DOLocationID AS BIGINT) AS VARCHAR) AS DOLocationID FROM cleaned)
SELECT s.scenario, CAST(2 AS DOUBLE) AS passenger_count, s.trip_distance, s.pickup_hour,
  CAST(0 AS DOUBLE) AS pickup_dayofweek, CAST(0 AS DOUBLE) AS pickup_month, '0' AS VendorID, '0' AS RatecodeID,
  '0' AS payment_type, PULocationID, DOLocationID
FROM pairs, (VALUES ('short', CAST(8 AS DOUBLE), CAST(0 AS DOUBLE)), ('long', CAST(25 AS DOUBLE), CAST(6 AS DOUBLE)))
  s(scenario, trip_distance, pickup_hour)"""))
def _scenario_rows(spark, sf_dir):
    """What-if rows before scoring: zeros plus overrides, two scenarios."""
    return _scenario_rows_df(spark, sf_dir)


@register("feature_quality", with_mrows("""
SELECT count(*) AS rows, coalesce(bool_and(total_amount > 0), true) AS target_positive,
       coalesce(bool_and(NOT (""" + " OR ".join(f"{c} IS NULL" for c in FE.NUMERIC_CANDIDATES
                                                 + FE.CATEGORICAL_CANDIDATES) + """)), true) AS no_missing_features,
       coalesce(bool_and(trip_distance > 0), true) AS distance_positive FROM mrows"""))
def _feature_quality(spark, sf_dir):
    X, spec = FE.feature_matrix(_cleaned(spark, sf_dir))
    return FE.feature_quality(X, spec)


@register("rmse", with_mrows(f"""
SELECT round(sqrt(avg(power(t.total_amount - m.p, 2))), 6) AS rmse, count(*) AS rows
FROM test t, (SELECT {am('total_amount')} AS p FROM train) m"""))
def _rmse(spark, sf_dir):
    """RMSE of the train-mean baseline on the test part."""
    from farelake.functions.money import avg_money
    rows, _ = _rows(spark, sf_dir)
    mean = rows.where(F.col("split") == "train").agg(avg_money(TARGET_COL)).scalar()
    return MD.rmse(rows.where(F.col("split") == "test").withColumn("prediction", mean))


TARGET_COL = "total_amount"
# The scored model may take up to 300 rounds and stops by its validation rows; a second fit of
# a fixed, small number of rounds is named in its key.
VALIDATION = 0.1
QUERY_ROUNDS = 20
_MODELS: dict = {}


def _model(spark, sf_dir, rounds: int = MD.ROUNDS, validation: float | None = VALIDATION):
    """A model of ``sf_dir``: trained once and published next to the
    warehouse it was trained from, so later runs load it."""
    from farelake.plans.star import publish_json, read_json
    key = (spark.sparkContext.applicationId, sf_dir, rounds)
    if key not in _MODELS:
        b = star_for(spark, sf_dir)
        manifest = f"{b.base}/model-r{rounds}.json"
        m = read_json(spark, manifest)
        if m is None:
            rows, spec = _rows(spark, sf_dir)
            rows_path = save_path(rows, b.base, "model_rows")
            rows = spark.read.parquet(rows_path)
            fit = MD.train(rows, spec, rounds=rounds, validation=validation)
            fit.rmse = MD.evaluate(fit, rows)
            path = fresh(spark, "model")
            MD.save(fit, path, spark)
            publish_json(spark, manifest, {"model": path, "rows": rows_path})
            m = read_json(spark, manifest)
        _MODELS[key] = (MD.load(m["model"], spark), spark.read.parquet(m["rows"]))
    return _MODELS[key]


def _fit_report(m, rows):
    return rows.where(F.col("split") == "test").agg(F.count(F.lit(1)).alias("test_rows")).select(
        F.lit(float(m.rmse)).alias("rmse"), F.lit(m.rounds).alias("rounds"),
        F.lit(MD.MAX_DEPTH).alias("max_depth"), F.lit(float(MD.LEARNING_RATE)).alias("learning_rate"),
        "test_rows")


@register("model_train")
def _model_train(spark, sf_dir):
    """Fit with up to 300 rounds, stopped by the validation rows; evaluate on the test
    part, save and reload (M08, M09, S17). ``rounds`` is how many it took."""
    return _fit_report(*_model(spark, sf_dir))


@register("model_beats_the_mean", with_mrows("SELECT count(*) AS test_rows, TRUE AS beats_mean, TRUE AS rounds_within, "
                                             "TRUE AS rmse_of_scores FROM test"))
def _model_beats_the_mean(spark, sf_dir):
    """The full fit against the train-mean predictor on the test part: its error is
    lower, its rounds are at most 300, and its stated error is that of its scores (M08-M10)."""
    m, rows = _model(spark, sf_dir)
    test = rows.where(F.col("split") == "test")
    own = MD.rmse(MD.score(m, test, keep=(TARGET_COL,)))
    mean = _rmse(spark, sf_dir).select("rmse").scalar()
    return own.select(F.col("rows").alias("test_rows"), (F.col("rmse") < mean).alias("beats_mean"),
                      F.lit(1 <= m.rounds <= MD.ROUNDS).alias("rounds_within"),
                      (F.abs(F.col("rmse") - F.lit(float(m.rmse))) < 1e-3).alias("rmse_of_scores"))


@register(f"model_train_{QUERY_ROUNDS}_rounds")
def _model_train_rounds(spark, sf_dir):
    """A fit of a fixed number of rounds without validation rows."""
    return _fit_report(*_model(spark, sf_dir, QUERY_ROUNDS, None))


def _scored(m, df, *keep):
    return MD.score(m, df, keep=keep).withColumn("rounds", F.lit(m.rounds))


@register("score_batch")
def _score_batch(spark, sf_dir):
    """Every model row scored, with the model's rounds."""
    m, rows = _model(spark, sf_dir)
    return _scored(m, rows, TARGET_COL)


@register("score_scenarios")
def _score_scenarios(spark, sf_dir):
    """The what-if rows scored."""
    m, _ = _model(spark, sf_dir)
    return _scored(m, _scenario_rows_df(spark, sf_dir), "scenario")


@register("request_rows", zstar("""
, names AS (SELECT zone, max(location_id) AS location_id FROM zones
            WHERE location_id IS NOT NULL AND zone IS NOT NULL GROUP BY 1)
SELECT f.trip_key, pn.location_id AS PULocationID, dn.location_id AS DOLocationID, f.passenger_count, f.trip_distance,
  CAST(hour(d.ts) AS INTEGER) AS pickup_hour, CAST(isodow(d.ts) - 1 AS INTEGER) AS pickup_dayofweek,
  CAST(month(d.ts) AS INTEGER) AS pickup_month
FROM fact_trip f JOIN dim_datetime d ON f.pickup_datetime_key = d.datetime_key
JOIN dim_location pl ON pl.location_key = f.pu_location_key
JOIN dim_location dl ON dl.location_key = f.do_location_key
LEFT JOIN zones pz ON pz.location_id = pl.location_id LEFT JOIN zones dz ON dz.location_id = dl.location_id
LEFT JOIN names pn ON pn.zone = pz.zone LEFT JOIN names dn ON dn.zone = dz.zone"""))
def _request_rows(spark, sf_dir):
    """Form requests before scoring: zone names and the pickup time of each trip as
    features; vendor, rate and payment left out (M12)."""
    b = star_for(spark, sf_dir)
    zones = b.zones(spark)
    req = _zone_requests(b.wh, zones, "passenger_count", "trip_distance", "pickup_ts")
    req = Z.zone_ids_for_names(req, zones, "pu_zone", "PULocationID")
    req = Z.zone_ids_for_names(req, zones, "do_zone", "DOLocationID")
    return FE.time_features(req, "pickup_ts").select(
        "trip_key", "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "pickup_hour",
        "pickup_dayofweek", "pickup_month")


@register("score_requests")
def _score_requests(spark, sf_dir):
    """The form requests scored."""
    m, _ = _model(spark, sf_dir)
    return _scored(m, _request_rows(spark, sf_dir), "trip_key")


@register("score_counts", star("", zones=True) + ", " + _MROWS + """
SELECT 'score_batch' AS query, count(*) AS rows, count(*) AS scored, CAST(NULL AS DECIMAL(38,0)) AS keys FROM mrows
UNION ALL SELECT 'score_requests', count(*), count(*), CAST(sum(trip_key) AS DECIMAL(38,0)) FROM fact_trip
  WHERE pu_location_key IS NOT NULL AND do_location_key IS NOT NULL
UNION ALL SELECT 'score_scenarios', 2 * count(*), 2 * count(*), NULL FROM (
  SELECT DISTINCT PULocationID, DOLocationID FROM cleaned)""")
def _score_counts(spark, sf_dir):
    """Rows and predictions of the three scoring queries, and the sum of their trip keys."""
    out = None
    for name in ("score_batch", "score_requests", "score_scenarios"):
        df = QUERIES[name](spark, sf_dir)
        keys = F.sum(F.col("trip_key").cast("decimal(38,0)")) if "trip_key" in df.columns else F.lit(None)
        part = df.agg(F.count(F.lit(1)).alias("rows"), F.count("prediction").alias("scored"),
                      keys.cast("decimal(38,0)").alias("keys")).select(F.lit(name).alias("query"), "*")
        out = part if out is None else out.unionByName(part)
    return out


_COLUMN_TYPES = [(t, f.name, f.dataType.simpleString(), i + 1) for t in STORED_COLUMNS
                 for i, f in enumerate(getattr(S, t.upper()).fields)]


@register("table_columns", star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, CAST({i} AS INTEGER) AS ordinal_position, "
    f"count({c}) AS filled FROM {t}" for t, c, k, i in _COLUMN_TYPES)))
def _table_columns(spark, sf_dir):
    """Name, type and position of every warehouse column, with the rows that
    hold a value: one aggregate per saved table (S15)."""
    wh, out = warehouse(spark, sf_dir), None
    for name, df in wh.tables().items():
        cols = [f for f in df.select(*STORED_COLUMNS[name]).schema.fields]
        filled = df.agg(*[F.count(f.name).alias(f.name) for f in cols])
        part = filled.select(F.inline(F.array(*[F.struct(
            F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(i + 1).alias("ordinal_position"),
            F.col(f.name).alias("filled")) for i, f in enumerate(cols)])))
        out = part if out is None else out.unionByName(part)
    return out


# The notebook's top-15 variants of A19: no date window, fifteen rows.
_LOC_ALL = """SELECT CAST(l.location_id AS INTEGER) AS location_id, COUNT(*) AS trips
FROM fact_trip f JOIN dim_location l ON f.{k} = l.location_key GROUP BY 1
ORDER BY trips DESC, location_id LIMIT 15"""
report("top_pickups_15", R.top_pickups, star(_LOC_ALL.format(k="pu_location_key")), n=15)
report("top_dropoffs_15", R.top_dropoffs, star(_LOC_ALL.format(k="do_location_key")), n=15)

# The donut shows the top 6 payment groups, the bar chart the top 4.
for _n in (6, 4):
    report(f"payment_mix_fact_top{_n}", R.payment_mix_fact, star(f"""
SELECT CAST(f.payment_type_key AS VARCHAR) AS payment, COUNT(*) AS trips FROM {PU}
GROUP BY 1 ORDER BY trips DESC, payment NULLS FIRST LIMIT {_n}"""), n=_n)
