import pytest
from pyspark.sql import functions as F

from farelake.functions import rules as R
from tests.conftest import trip


def test_clean_keeps_only_rows_passing_every_rule(raw):
    df = raw([
        trip(),                                       # kept
        trip(pax=None),                               # null passengers: a null comparison rejects
        trip(pax=0),
        trip(dist=0.0),
        trip(fare=0.0),
        trip(pickup=None),
        trip(dropoff=None),
        trip(dropoff="2024-01-01 10:00:00"),          # pickup == dropoff is not before
        trip(pu=None),
        trip(do=None),
        trip(vendor=None, rate=None, pay=None),      # coded ids may stay null
    ])
    out = R.clean(df)
    assert out.count() == 2
    prof = {r["rule"]: r["rejected"] for r in R.reject_profile(df).collect()}
    assert prof["passenger_count_positive"] == 2
    assert prof["pickup_before_dropoff"] == 3       # both null-time rows and the equal one
    assert prof["pu_location_present"] == 1


def test_provenance_is_that_of_the_file(raw):
    stray = trip(pickup="2024-02-01 00:03:00", dropoff="2024-02-01 00:20:00")
    got = lambda df: (df.source_file, df.ingestion_year, df.ingestion_month)
    jan = ("yellow_tripdata_2024-01.parquet", 2024, 1)
    df = raw([stray], file=jan[0])
    assert got(R.with_provenance(df).first()) == jan
    assert got(R.with_provenance(df.drop("source_file"), year=2024, month=1).first()) == jan
    assert got(R.with_provenance(df, "other.parquet", 2024, 1).first()) == ("other.parquet", 2024, 1)
    with pytest.raises(ValueError):
        R.with_provenance(df.drop("source_file"))


def test_require_columns_names_every_missing(raw):
    df = raw([trip()]).drop("passenger_count", "DOLocationID")
    with pytest.raises(ValueError) as e:
        R.require_columns(df, R.ML_REQUIRED)
    assert "passenger_count" in str(e.value) and "DOLocationID" in str(e.value)


def test_coerce_ts_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("not a time",), (None,)], "t string")
    out = [r.t for r in R.coerce_ts(df, ["t"]).collect()]
    assert out[0] is not None and out[1] is None and out[2] is None
    assert dict(R.coerce_ts(df, ["t"]).dtypes)["t"] == "timestamp_ntz"


def test_ml_filter_bounds_are_strict(raw):
    df = raw([trip(dist=99.99, total=299.99), trip(dist=100.0), trip(total=300.0), trip(total=0.0)])
    assert R.ml_filter(df).count() == 1


def test_date_window_is_half_open_on_days(raw):
    df = raw([trip(pickup="2024-01-01 00:00:00"), trip(pickup="2024-01-31 23:59:59"),
              trip(pickup="2024-02-01 00:00:00"), trip(pickup="2023-12-31 23:59:59")])
    out = R.date_window(df, "tpep_pickup_datetime", "2024-01-01", "2024-01-31")
    assert out.count() == 2
    assert R.date_window(df, "tpep_pickup_datetime").count() == 4


def test_drop_null_rows(raw):
    df = raw([trip(), trip(pax=None), trip(total=None)])
    assert R.drop_null_rows(df).count() == 1
    assert R.drop_null_rows(df).where(F.col("passenger_count").isNull()).count() == 0
