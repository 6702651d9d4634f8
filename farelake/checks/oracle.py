"""DuckDB oracle SQL for every query with an oracle form.

The prefix rebuilds the same warehouse from the driver's base tables: the trip
adapter, the cleaning rules, dimensions keyed by natural id with reference rows
numbered after the data (the seed runs after the load), the datetime dimension
keyed in time order, and facts numbered in the order of all fact columns.
Reports are then written the way the reference writes them: joins to the
dimensions and the pickup-time join.
"""

from __future__ import annotations

from farelake.functions.wkt import RING_PATTERN

TRIPS = """
b AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_quantity, l.l_shipdate,
         o.o_orderdate, o.o_orderpriority,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS px,
         CAST(round(l.l_discount * 100) AS BIGINT) AS dp,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
c AS (SELECT *, CAST((px - px % 350) / 350 AS BIGINT) AS fare_c FROM b),
d AS (SELECT *, CAST((fare_c * dp - (fare_c * dp) % 100) / 100 AS BIGINT) AS tip_c,
                CAST((fare_c * tp - (fare_c * tp) % 100) / 100 AS BIGINT) AS toll_c FROM c),
trips AS (
SELECT
  NULLIF(CAST(l_suppkey % 4 AS INT), 0)                        AS VendorID,
  NULLIF(CAST(l_linenumber AS BIGINT), 7)                      AS RatecodeID,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT)                AS payment_type,
  NULLIF(CAST(l_suppkey % 263 AS INT), 0)                      AS PULocationID,
  CAST(l_partkey % 265 + 1 AS INT)                             AS DOLocationID,
  o_orderdate + INTERVAL '1' SECOND * CAST((l_orderkey * 7919) % 86400 AS INT)   AS tpep_pickup_datetime,
  l_shipdate  + INTERVAL '1' SECOND * CAST((l_partkey * 104729) % 86400 AS INT)  AS tpep_dropoff_datetime,
  NULLIF(CAST(l_quantity AS BIGINT) % 8, 7)                    AS passenger_count,
  ((px - px % 3000) / 3000) / 100                              AS trip_distance,
  fare_c / 100                                                 AS fare_amount,
  CAST(1.0 AS DOUBLE)                                          AS extra,
  CAST(0.5 AS DOUBLE)                                          AS mta_tax,
  tip_c / 100                                                  AS tip_amount,
  toll_c / 100                                                 AS tolls_amount,
  CAST(1.0 AS DOUBLE)                                          AS improvement_surcharge,
  (fare_c + tip_c + toll_c + 250) / 100                        AS total_amount,
  concat('yellow_tripdata_', CAST(year(o_orderdate) AS VARCHAR(4)), '-', lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0'), '.parquet') AS source_file
FROM d)"""

CLEAN_WHERE = """passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_pickup_datetime < tpep_dropoff_datetime
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"""

CLEANED = f"""
cleaned AS (
  SELECT VendorID, RatecodeID, payment_type, PULocationID, DOLocationID, tpep_pickup_datetime,
         tpep_dropoff_datetime, passenger_count, trip_distance, fare_amount, extra, mta_tax,
         tip_amount, tolls_amount, improvement_surcharge, total_amount, source_file,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS ingestion_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS ingestion_month
  FROM trips
  WHERE {CLEAN_WHERE})"""


def _small_dim(name: str, key: str, ident: str, sources: list[str], seeds: list[int]) -> str:
    union = " UNION ".join(f"SELECT CAST({s} AS INTEGER) AS {ident} FROM cleaned WHERE {s} IS NOT NULL"
                           for s in sources)
    data = f"{name}_data AS (SELECT DISTINCT {ident} FROM ({union}))"
    body = (f"SELECT CAST(row_number() OVER (ORDER BY {ident}) AS INTEGER) AS {key}, {ident} "
            f"FROM {name}_data")
    if seeds:
        vals = ", ".join(f"({s})" for s in seeds)
        body += (f"\n  UNION ALL SELECT CAST((SELECT count(*) FROM {name}_data) + row_number() OVER "
                 f"(ORDER BY s.{ident}) AS INTEGER), s.{ident} FROM (VALUES {vals}) s({ident}) "
                 f"WHERE s.{ident} NOT IN (SELECT {ident} FROM {name}_data)")
    return f"{data},\n{name} AS (\n  {body})"


DIMS = ",\n".join([
    _small_dim("dim_vendor", "vendor_key", "vendor_id", ["VendorID"], [1, 2]),
    _small_dim("dim_rate_code", "rate_code_key", "rate_code_id", ["RatecodeID"], [1, 2, 3, 4, 5, 6]),
    _small_dim("dim_payment_type", "payment_type_key", "payment_type_id", ["payment_type"],
               [1, 2, 3, 4, 5, 6]),
    _small_dim("dim_location", "location_key", "location_id", ["PULocationID", "DOLocationID"], []),
])

DATETIME = """
ts_data AS (SELECT DISTINCT ts FROM (SELECT tpep_pickup_datetime AS ts FROM cleaned
            UNION ALL SELECT tpep_dropoff_datetime FROM cleaned) WHERE ts IS NOT NULL),
dim_datetime AS (
  SELECT row_number() OVER (ORDER BY ts) AS datetime_key, ts, CAST(ts AS DATE) AS date,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS dow
  FROM ts_data)"""

FACT_COLS = ["pickup_datetime_key", "dropoff_datetime_key", "vendor_key", "rate_code_key",
             "payment_type_key", "pu_location_key", "do_location_key", "passenger_count",
             "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "total_amount", "source_file"]

FACT = f"""
fact_base AS (
  SELECT pd.datetime_key AS pickup_datetime_key, dd.datetime_key AS dropoff_datetime_key,
         v.vendor_key, r.rate_code_key, p.payment_type_key,
         pl.location_key AS pu_location_key, dl.location_key AS do_location_key,
         CAST(c.passenger_count AS INTEGER) AS passenger_count, c.trip_distance, c.fare_amount,
         c.extra, c.mta_tax, c.tip_amount, c.tolls_amount, c.improvement_surcharge,
         c.total_amount, c.source_file
  FROM cleaned c
  LEFT JOIN dim_vendor v ON v.vendor_id = CAST(c.VendorID AS INTEGER)
  LEFT JOIN dim_rate_code r ON r.rate_code_id = CAST(c.RatecodeID AS INTEGER)
  LEFT JOIN dim_payment_type p ON p.payment_type_id = CAST(c.payment_type AS INTEGER)
  LEFT JOIN dim_location pl ON pl.location_id = c.PULocationID
  LEFT JOIN dim_location dl ON dl.location_id = c.DOLocationID
  LEFT JOIN dim_datetime pd ON pd.ts = c.tpep_pickup_datetime
  LEFT JOIN dim_datetime dd ON dd.ts = c.tpep_dropoff_datetime),
fact_trip AS (
  SELECT row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in FACT_COLS)}) AS trip_key,
         {', '.join(FACT_COLS)}
  FROM fact_base)"""


ZONES = f"""
zid AS (SELECT DISTINCT CAST(p_partkey % 265 + 1 AS INT) AS location_id FROM part),
zg AS (
  SELECT location_id, CAST(location_id % 20 AS BIGINT) AS gx, CAST(location_id % 13 AS BIGINT) AS gy
  FROM zid WHERE location_id NOT IN (57, 104, 105, 264, 265)),
zt AS (
  SELECT location_id,
    concat('(-74.', CAST(100 + gx AS VARCHAR(9)), ' 40.', CAST(100 + gy AS VARCHAR(9)),
           ', -74.', CAST(200 + gx AS VARCHAR(9)), ' 40.', CAST(100 + gy AS VARCHAR(9)),
           ', -74.', CAST(200 + gx AS VARCHAR(9)), ' 40.', CAST(200 + gy AS VARCHAR(9)), ')') AS ring
  FROM zg),
zones AS (
SELECT zt.location_id,
  concat(n.n_name, ' ', CAST(zt.location_id AS VARCHAR(9))) AS zone,
  CASE WHEN zt.location_id % 50 = 0 THEN NULL ELSE r.r_name END AS borough,
  CASE WHEN zt.location_id % 31 = 0 THEN NULL
       WHEN zt.location_id % 7 = 0 THEN concat('MULTIPOLYGON ((', ring, '), ((-73.5 40.5, -73.5 40.6, -73.7 40.6)))')
       WHEN zt.location_id % 11 = 0 THEN concat('MULTIPOLYGON ((', ring, '), ((-70.5 41.5, -70.6 41.6)))')
       WHEN zt.location_id % 13 = 0 THEN 'MULTIPOLYGON (((-74 40, -75 41, -75 40)))'
       ELSE concat('MULTIPOLYGON ((', ring, '))') END AS geometry
FROM zt JOIN nation n ON n.n_nationkey = zt.location_id % 25
        JOIN region r ON r.r_regionkey = zt.location_id % 5),
zone_rings AS (
  SELECT location_id, zone, borough, geometry,
    list_filter(
      list_transform(regexp_extract_all(coalesce(geometry, ''), '{RING_PATTERN}', 1),
        lambda rt: list_transform(
          list_filter(list_transform(string_split(rt, ','),
                                     lambda p: regexp_split_to_array(trim(p), '\\s+')),
                      lambda a: len(a) >= 2),
          lambda a: {{'x': CAST(a[1] AS DOUBLE), 'y': CAST(a[2] AS DOUBLE)}})),
      lambda rr: len(rr) >= 3) AS rings
  FROM zones),
zone_pts AS (SELECT location_id, zone, borough, geometry, rings, flatten(rings) AS pts FROM zone_rings),
zone_centroids AS (
  SELECT location_id, zone, borough,
    CASE WHEN len(pts) > 0 THEN round(list_sum(list_transform(pts, lambda q: q.x)) / len(pts), 6) END AS centroid_lon,
    CASE WHEN len(pts) > 0 THEN round(list_sum(list_transform(pts, lambda q: q.y)) / len(pts), 6) END AS centroid_lat,
    CAST(len(rings) AS INTEGER) AS n_rings, CAST(len(pts) AS INTEGER) AS n_points
  FROM zone_pts)"""

STAR = ",\n".join([TRIPS, CLEANED, DIMS, DATETIME, FACT])


def star(sql: str, zones: bool = False) -> str:
    """A query over the oracle warehouse (and zones when asked)."""
    return "WITH " + STAR + ("," + ZONES if zones else "") + "\n" + sql


def with_trips(sql: str) -> str:
    return "WITH " + TRIPS + "\n" + sql


def with_cleaned(sql: str) -> str:
    return "WITH " + TRIPS + "," + CLEANED + "\n" + sql


def with_zones(sql: str) -> str:
    return "WITH " + ZONES.lstrip() + "\n" + sql


# Exact money: sums as DECIMAL(18,2); averages as rounded double of the exact
# sum; NUMERIC(10,2) averages by integer half-up in cents.
def avg_money(x: str) -> str:
    return f"round(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({x}), 6)"


def sum_money(x: str, p: int = 18) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DECIMAL({p},2))"


def avg_numeric(x: str, p: int = 10) -> str:
    s = f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) * 100 AS BIGINT)"
    n = f"COUNT({x})"
    q = f"CAST(((abs({s}) * 2 + {n}) - (abs({s}) * 2 + {n}) % ({n} * 2)) / ({n} * 2) AS BIGINT)"
    q = f"(CASE WHEN {s} < 0 THEN -{q} ELSE {q} END)"
    return f"CAST(CAST({q} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL({p},2))"


PU = "fact_trip f JOIN dim_datetime d ON f.pickup_datetime_key = d.datetime_key"
