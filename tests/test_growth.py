"""Steps whose cost once grew faster than their input: what they shuffle, repeat and deal."""

import pytest
from pyspark.sql import functions as F

from farelake.functions.rules import clean, with_provenance
from farelake.functions.text import MONTH_FILE_FORMAT, month_file_name
from farelake.operators import features as FE
from farelake.operators import model as MD
from farelake.operators import rollups as RU
from farelake.operators import warehouse as W
from farelake.plans import registry as Q
from farelake.plans import star as ST
from farelake.session import scratch_path
from farelake.sources import adapter as A
from farelake.sources import lake as L
from tests.conftest import SF_SMALL, trip


def test_a_rollup_shuffles_the_facts_once(spark):
    facts = Q.warehouse(spark, SF_SMALL).fact_trip
    plan = RU.rollup(facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(source_file" in plan


def test_a_rollup_is_dealt_by_rows(spark):
    facts = Q.warehouse(spark, SF_SMALL).fact_trip
    parts = lambda df: df.rdd.getNumPartitions()
    n = facts.count()
    assert parts(RU.rollup(facts, rows_per_task=n // 20)) >= 20
    many, few = RU.rollup(facts, rows_per_task=n // 20), RU.rollup(facts)
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty() and few.count() > 0


def test_a_drifted_landing_makes_the_trips_once(spark, raw, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(v):
        made.add(1)
        return v

    months = [raw([trip(vendor=m % 3, pickup=f"2024-{m:02d}-05 10:00:00") for _ in range(m)]) for m in range(1, 13)]
    trips = months[0]
    for m in months[1:]:
        trips = trips.unionByName(m)
    trips = trips.localCheckpoint()
    monkeypatch.setattr(A, "raw_trips", lambda *_: trips.withColumn("VendorID", seen("VendorID")))
    root = scratch_path(spark, "test", "drift_once")
    Q.land_drifted(spark, SF_SMALL, root)
    assert made.value == trips.count() == 78
    got = L.drift.read_files(spark, [f"{root}/{f}" for f in L.folders(spark, root)], name_files=True)
    per = {r.source_file: (r.n, r.v) for r in got.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("VendorID").alias("v")).collect()}
    assert per == {f"yellow_tripdata_2024-{m:02d}.parquet": (m, m % 3) for m in range(1, 13)}


def test_training_rows_are_dealt_by_rows(spark):
    X = spark.range(1000).coalesce(1)
    parts = lambda df: [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    many = parts(MD.dealt(X, rows_per_task=10, most=100))
    assert len(many) == 10 and sum(many) == 1000 and max(many) <= 110
    assert len(parts(MD.dealt(X, merge=False, rows_per_task=10))) == spark.sparkContext.defaultParallelism
    small = spark.range(1000).repartition(8)
    assert len(parts(MD.dealt(small, rows_per_task=400))) == 3
    assert len(parts(MD.dealt(small, merge=False, rows_per_task=400))) == 8


def test_pushed_rules_do_not_round_through_decimals(spark):
    plan = Q.QUERIES["ml_filter"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan and "total_amount" in plan


def test_hundredths_are_those_of_round(spark):
    values = [0.0, 0.005, 0.01, 0.015, 0.125, 1.005, 2.675, 104949.5, 901.004999, 12.345, 0.07, 0.29, 1e9 + 0.13, None]
    values += [-v for v in values if v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(A.hundredths(F.col("v")).alias("a"), F.round(F.col("v") * 100).cast("bigint").alias("b"))
    assert [r.a for r in got.collect()] == [r.b for r in got.collect()] and got.schema["a"].dataType == got.schema["b"].dataType


@pytest.mark.parametrize("y, m", [(1996, 3), (2024, 12), (1000, 1), (999, 1), (7, 7), (12024, 5), (-44, 3), (None, 3), (2024, None)])
def test_month_names_are_those_of_the_format(spark, y, m):
    row = spark.createDataFrame([(y, m)], "y int, m int").select(
        month_file_name(F.col("y"), F.col("m")).alias("a"), F.format_string(MONTH_FILE_FORMAT, "y", "m").alias("b")).first()
    assert row.a == row.b


def test_a_long_datetime_slice_joins_without_shuffling_the_facts(spark, raw, monkeypatch):
    """Above the slice's bound the keys come from bitmaps of the seconds; a second load, fractions
    of a second and times before 1970 give the same keys as the shuffle joins."""
    def trips(n, year, frac="", late=0):
        return with_provenance(clean(raw([trip(pickup=f"{year}-03-{1 + i % 5:02d} {i % 24:02d}:{i % 60:02d}:{(i * 7 + late) % 60:02d}{frac}",
                                               dropoff=f"{year}-03-{6 + i % 9:02d} 23:{i % 60:02d}:{late:02d}") for i in range(n)])))

    def facts_plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    base = scratch_path(spark, "test", "second_index")
    first = trips(300, 2024)
    wh = ST.load_batch(first, W.empty_warehouse(spark), base)
    dt = wh.dim_datetime.select("datetime_key", "ts")
    index = W.second_index(dt, 40)
    assert index is not None and index.count() <= 40 and W.second_index(dt, 3) is None
    got = W.with_second_key(dt, index, "ts", "k")
    assert got.where("k = datetime_key").count() == dt.count() == 300
    lone = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-01 00:00:01' AS ts UNION ALL SELECT TIMESTAMP_NTZ'2031-01-01 00:00:00' "
                     "UNION ALL SELECT CAST(NULL AS TIMESTAMP_NTZ) UNION ALL SELECT TIMESTAMP_NTZ'2024-03-01 00:00:00.5'")
    assert [r.k for r in W.with_second_key(lone, index, "ts", "k").collect()] == [None] * 4
    old = ST.load_batch(trips(300, 1960), W.empty_warehouse(spark), scratch_path(spark, "test", "second_index_old"))
    assert W.second_index(old.dim_datetime, 40) is not None

    def keys(w, rows, n):
        return sorted(W.resolve_keys(rows, w, datetime_max_rows=n).select(
            "pickup_ts", "pickup_datetime_key", "dropoff_ts", "dropoff_datetime_key").collect())

    monkeypatch.setattr(W, "SLICE_ROWS_PER_BUCKET", 1)   # few rows in the slice, more than its bound
    by_index = W.resolve_keys(first, wh, datetime_max_rows=40)
    assert "SortMergeJoin" not in facts_plan(by_index) and "_bits" in facts_plan(by_index)
    assert keys(wh, first, 40) == keys(wh, first, 0) and len(keys(wh, first, 40)) == 300
    more = trips(300, 2024, late=3)       # seconds between those of the first load
    wh = ST.load_batch(more, wh, base)
    assert W.second_index(wh.dim_datetime, 40) is None
    assert keys(wh, more, 40) == keys(wh, more, 0)
    halves = trips(300, 2024, ".500000")
    assert W.second_index(ST.load_batch(halves, W.empty_warehouse(spark), scratch_path(
        spark, "test", "second_index_half")).dim_datetime, 40) is None


def test_a_second_is_looked_up_in_a_short_piece_of_its_bitmap(spark):
    """The joined bitmaps are 128 bytes, not 4 KB; keys are right at both ends of pieces and buckets, before 1970 too."""
    seconds = [b * (1 << 15) + p * 1024 + s for b in (-3, 0, 40_000) for p in (0, 1, 13, 31) for s in (0, 1, 7, 8, 511, 1023)]
    dim = spark.createDataFrame([(100 + k, s) for k, s in enumerate(sorted(seconds))], "datetime_key long, s long").select(
        "datetime_key", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    index = W.second_index(dim, 10)
    assert index is not None and index.count() == 3
    cut = W.pieces(index)
    assert {r.n for r in cut.select(F.octet_length("_bits").alias("n")).collect()} == {128} and cut.count() == 12
    out = W.with_second_key(dim, index, "ts", "k")
    assert out.where(F.col("k").eqNullSafe(F.col("datetime_key"))).count() == len(seconds)
    assert "_piece" in out._jdf.queryExecution().executedPlan().toString()
    absent = spark.createDataFrame([(s,) for s in (-98_304 + 2, 9, 14 * 1024, 1 << 15, 40_001 << 15)], "s long").select(
        F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    assert [r.k for r in W.with_second_key(absent, index, "ts", "k").collect()] == [None] * 5


def test_a_split_reads_and_hashes_its_rows_once(spark, raw, monkeypatch):
    """The cut takes one pass over the rows, not one for the count and one for each step of the histogram."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(v):
        made.add(1)
        return v

    rows = raw([trip(pax=1 + i % 4, dist=1.0 + i / 100) for i in range(50)]).localCheckpoint()
    want = sorted(map(str, FE.with_split(rows).collect()))
    monkeypatch.setattr(FE, "split_hash", lambda df, seed, real=FE.split_hash: seen(real(df, seed)))
    split = FE.with_split(rows)
    assert made.value == 50
    assert sorted(map(str, split.collect())) == want and sum("split='test'" in r for r in want) == 10
    assert FE.with_split(rows.limit(0)).columns == [*rows.columns, "split"] and FE.with_split(rows.limit(0)).isEmpty()
