"""Fixed schemas: raw month files, cleaned partitions, the star, the zone lookup."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TRIP = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("RatecodeID", T.LongType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

RAW_COLUMNS = [f.name for f in RAW_TRIP.fields]
MEASURES = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
            "tolls_amount", "improvement_surcharge", "total_amount"]

PROVENANCE = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("ingestion_year", T.IntegerType()),
    T.StructField("ingestion_month", T.IntegerType()),
])

CLEANED_TRIP = T.StructType(RAW_TRIP.fields + PROVENANCE.fields)


def _dim(key: str, ident: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.IntegerType(), False),
        T.StructField(ident, T.IntegerType(), False),
    ])


DIM_VENDOR = _dim("vendor_key", "vendor_id")
DIM_RATE_CODE = _dim("rate_code_key", "rate_code_id")
DIM_PAYMENT_TYPE = _dim("payment_type_key", "payment_type_id")
DIM_LOCATION = _dim("location_key", "location_id")

DIM_DATETIME = T.StructType([
    T.StructField("datetime_key", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("hour", T.IntegerType(), False),
    T.StructField("dow", T.IntegerType(), False),
])

FACT_TRIP = T.StructType([
    T.StructField("trip_key", T.LongType(), False),
    T.StructField("pickup_datetime_key", T.LongType(), False),
    T.StructField("dropoff_datetime_key", T.LongType(), False),
    T.StructField("vendor_key", T.IntegerType()),
    T.StructField("rate_code_key", T.IntegerType()),
    T.StructField("payment_type_key", T.IntegerType()),
    T.StructField("pu_location_key", T.IntegerType()),
    T.StructField("do_location_key", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
] + [T.StructField(m, T.DoubleType()) for m in MEASURES] + [
    T.StructField("source_file", T.StringType()),
])

# The stored fact also keeps the trip's own times, so time windows and time
# attributes need no join to the datetime dimension.
FACT_TIMES = ["pickup_ts", "dropoff_ts"]
FACT_STORED = T.StructType(FACT_TRIP.fields[:-1] + [T.StructField(c, T.TimestampNTZType()) for c in FACT_TIMES]
                           + FACT_TRIP.fields[-1:])

# Fact columns without the trip key, in load order (F10); also the total order
# that numbers trips.
FACT_COLUMNS = [f.name for f in FACT_TRIP.fields if f.name != "trip_key"]

ZONES = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("zone", T.StringType()),
    T.StructField("borough", T.StringType()),
    T.StructField("geometry", T.StringType()),
])

# Header of the zone lookup file as published with the trip data.
ZONE_CSV_HEADER = ["Location ID", "Zone", "Borough", "Shape Geometry"]

STAR_TABLES = ["dim_vendor", "dim_rate_code", "dim_payment_type", "dim_location",
               "dim_datetime", "fact_trip"]
