import pytest
from pyspark.sql import functions as F

from farelake.functions.rules import clean, with_provenance
from farelake.functions.wkt import centroid
from farelake.operators import features as FE
from farelake.operators import model as MD
from farelake.session import scratch_path
from farelake.sources import lake
from tests.conftest import trip


def test_parse_months_and_plans(spark):
    assert lake.parse_months("") == list(range(1, 13))
    assert lake.parse_months(" 1, 3 ,") == [1, 3]
    with pytest.raises(ValueError):
        lake.parse_months("13")
    with pytest.raises(ValueError):
        lake.parse_months("x")
    assert lake.month_plan(spark, "year_range", start_year=2023, end_year=2024).count() == 24
    one = lake.month_plan(spark, "single_month", year=2024, month=2).first()
    assert one.file_name == "yellow_tripdata_2024-02.parquet"
    with pytest.raises(ValueError):
        lake.month_plan(spark, "year_range", start_year=2025, end_year=2024)
    with pytest.raises(ValueError):
        lake.month_plan(spark, "weekly")


def test_cleaned_partitions_roundtrip_and_prune(spark, raw):
    base = scratch_path(spark, "test", "lake")
    df = with_provenance(clean(raw([trip(), trip(pickup="2024-02-03 10:00:00",
                                                 dropoff="2024-02-03 10:20:00")])))
    lake.write_cleaned(df, base)
    lake.write_cleaned(df, base)                      # overwrite of the same months: no duplicates
    assert lake.read_cleaned(spark, base).count() == 2
    feb = lake.read_cleaned(spark, base, 2024, 2)
    assert feb.count() == 1 and "month" not in feb.columns
    with pytest.raises(FileNotFoundError):
        lake.read_cleaned(spark, base, 2024, 5)
    root = spark.read.parquet(base)
    assert dict(root.dtypes)["month"] == "int"
    capped = lake.row_cap(lake.read_cleaned(spark, base), 1).collect()
    assert capped == lake.row_cap(lake.read_cleaned(spark, base), 1).collect()


def test_wkt_centroid_rules(spark):
    df = spark.createDataFrame([
        ("MULTIPOLYGON (((-74.0 40.0, -74.2 40.0, -74.2 40.2)))",),
        ("MULTIPOLYGON (((-74 40, -75 41, -75 40)))",),               # no decimal points
        ("MULTIPOLYGON (((-74.0 40.0, -74.2 40.0)))",),                # two points: dropped
        ("MULTIPOLYGON (((-74.0 40.0, -74.2 40.0, -74.2 40.2)), ((-73.0 41.0, -73.0 41.5, -73.5 41.5)))",),
        (None,),
    ], "g string")
    rows = df.select(centroid(F.col("g")).alias("c")).collect()
    assert rows[0].c.lon == pytest.approx(-74.133333) and rows[0].c.n_rings == 1
    assert rows[1].c.lon is None and rows[2].c.lon is None and rows[4].c.lon is None
    assert rows[3].c.n_points == 6 and rows[3].c.lat == pytest.approx((40.0 + 40.0 + 40.2 + 41 + 41.5 + 41.5) / 6)


def test_reference_unit_frame(spark):
    """The reference's two-row frame: no vendor, rate or payment column."""
    rows = [(1, 2.5, 10.0, 12.0, 100, 102, "2024-01-01 10:00:00", "2024-01-01 10:10:00"),
            (2, 3.0, 15.0, 18.0, 101, 103, "2024-01-01 11:00:00", "2024-01-01 11:15:00")]
    df = spark.createDataFrame(rows, "passenger_count long, trip_distance double, fare_amount double, "
                                     "total_amount double, PULocationID long, DOLocationID long, "
                                     "tpep_pickup_datetime string, tpep_dropoff_datetime string")
    X, spec = FE.feature_matrix(df)
    assert spec["categorical_cols"] == ["PULocationID", "DOLocationID"]
    q = FE.feature_quality(X, spec).first()
    assert q.rows == 2 and q.target_positive and q.no_missing_features and q.distance_positive
    first = X.orderBy("total_amount").first()
    assert first.pickup_dayofweek == 0.0 and first.PULocationID == "100"   # Monday = 0


def test_ordinal_encoding_unknown_is_minus_one(spark):
    train = spark.createDataFrame([("2",), ("10",), ("2",)], "c string")
    d = FE.fit_ordinal(train, ["c"])
    codes = {r.value: r.code for r in d.collect()}
    assert codes == {"10": 0, "2": 1}                 # sorted as text
    other = spark.createDataFrame([("2",), ("99",), (None,)], "c string")
    out = [r.c for r in FE.encode(other, d, ["c"]).collect()]
    assert sorted(out) == [-1.0, -1.0, 1.0]
    modes = {r.column: r["mode"] for r in FE.fit_mode(train, ["c"]).collect()}
    assert modes == {"c": "2"}


def test_model_trains_scores_and_beats_mean(spark):
    from farelake.plans import star as ST
    sf = "/root/testdata/sf0.001"
    rows, spec = FE.model_rows(ST.star_for(spark, sf).cleaned(spark))
    m = MD.train(rows, spec, rounds=5, max_depth=4)
    rmse = MD.evaluate(m, rows)
    test = rows.where(F.col("split") == "test")
    mean = rows.where(F.col("split") == "train").agg(F.avg("total_amount")).first()[0]
    base = test.agg(F.sqrt(F.avg((F.col("total_amount") - mean) ** 2))).first()[0]
    assert rmse < base
    missing = MD.score(m, test.drop("VendorID", "RatecodeID", "payment_type"), keep=("total_amount",))
    assert missing.where(F.col("prediction").isNull()).count() == 0
    path = scratch_path(spark, "test", "model")
    m.rmse = rmse
    MD.save(m, path, spark)
    back = MD.load(path, spark)
    assert back.spec == m.spec and abs(back.rmse - rmse) < 1e-12


def test_largest_file_lists_files_without_reading_rows(spark):
    from farelake.sources import lake as L
    base = scratch_path(spark, "test", "largest_file")
    spark.range(10).write.parquet(f"{base}/year=2024/month=01")
    spark.range(50000).selectExpr("id", "uuid() AS u").write.parquet(f"{base}/year=2024/month=02")
    row = L.largest_file(spark, base).first()
    assert "month=02" in row.file_path and row.file_size > 100000
    with pytest.raises(FileNotFoundError):
        spark.range(1).write.json(f"{base}-json")
        L.largest_file(spark, f"{base}-json")


def test_row_cap_numbering_path_matches_top_k(spark):
    rows = [(i % 13, None if i % 5 == 0 else f"s{i % 17}", float(i % 7)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(6)
    for n in (1, 40, 333, 5000):
        by_top_k = lake.row_cap(df, n).collect()
        by_ranges = lake.row_cap(df, n, merge_max_rows=0).collect()
        assert sorted(by_top_k, key=str) == sorted(by_ranges, key=str), n
        assert len(by_top_k) == min(n, 2000)


def test_boosting_stops_by_its_validation_rows(spark, raw):
    """At most the asked rounds; the rounds used are kept with the saved model."""
    rows = raw([trip(pu=1 + i % 7, do=1 + i % 5, dist=1.0 + i % 40 / 4, total=5.0 + 2.5 * (i % 40) + (i * 7919) % 13 / 10,
                     pickup=f"2024-01-{1 + i % 27:02d} {i % 24:02d}:00:00", dropoff="2024-02-01 00:00:00") for i in range(600)])
    X, spec = FE.model_rows(clean(rows))
    fit = MD.train(X, spec, max_depth=3, rounds=6, validation=0.2)
    fit.rmse = MD.evaluate(fit, X)
    mean = X.where("split = 'train'").agg(F.avg("total_amount")).first()[0]
    base = MD.rmse(X.where("split = 'test'").withColumn("prediction", F.lit(mean))).first().rmse
    assert 1 <= fit.rounds <= 6 and fit.rmse < base
    path = scratch_path(spark, "test", "model-rounds")
    MD.save(fit, path, spark)
    assert MD.load(path, spark).rounds == fit.rounds
    assert MD.train(X, spec, max_depth=2, rounds=2).rounds == 2
