import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from farelake.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


RAW_DDL = ("VendorID int, RatecodeID bigint, payment_type bigint, PULocationID int, DOLocationID int, "
           "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
           "passenger_count bigint, trip_distance double, fare_amount double, extra double, "
           "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
           "total_amount double")


def trip(vendor=1, rate=1, pay=1, pu=10, do=20, pickup="2024-01-01 10:00:00",
         dropoff="2024-01-01 10:10:00", pax=1, dist=2.5, fare=10.0, tip=1.0, total=14.0):
    return (vendor, rate, pay, pu, do, ts(pickup) if pickup else None,
            ts(dropoff) if dropoff else None, pax, dist, fare, 1.0, 0.5, tip, 0.0, 1.0, total)


@pytest.fixture
def raw(spark):
    def make(rows, file=None):
        """Raw trips with the month file they came from: ``file``, or the pickup's month."""
        name = lambda r: file or f"yellow_tripdata_{(r[5] or ts('2024-01-01')):%Y-%m}.parquet"
        return spark.createDataFrame([(*r, name(r)) for r in rows], RAW_DDL + ", source_file string")
    return make
