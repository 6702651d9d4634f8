"""Kept partial sums and sketches against the facts; the exact split and its selection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from farelake.functions.rules import clean, with_provenance
from farelake.functions.select import hash60, kth_smallest
from farelake.operators import features as FE
from farelake.operators import reports as R
from farelake.operators import rollups as RU
from farelake.operators import sketches as SK
from farelake.operators import warehouse as W
from farelake.plans import registry as Q
from farelake.plans import star as ST
from farelake.session import scratch_path
from tests.conftest import SF_SMALL, trip


def some_trips(n=200, seed=1):
    r = random.Random(seed)
    return [trip(vendor=r.choice([1, 2, None]), rate=r.choice([1, 2, None]), pay=r.choice([1, 2, 3, None]), pu=r.randint(1, 9),
                 do=r.randint(1, 9), pickup=f"2024-0{r.randint(1, 2)}-{r.randint(1, 28):02d} {r.randint(0, 23):02d}:15:00",
                 dropoff="2024-03-01 10:00:00", pax=r.randint(1, 6), dist=r.randint(1, 900) / 10, fare=r.randint(1, 9000) / 100,
                 tip=r.randint(0, 900) / 100, total=r.randint(1, 9999) / 100) for _ in range(n)]


@pytest.fixture(scope="module")
def star(spark):
    from tests.conftest import RAW_DDL
    rows = [(*t, f"yellow_tripdata_{t[5]:%Y-%m}.parquet") for t in some_trips()]
    base = scratch_path(spark, "test", "rollup")
    df = spark.createDataFrame(rows, RAW_DDL + ", source_file string")
    return ST.seed(ST.load_batch(with_provenance(clean(df)), W.empty_warehouse(spark), base), base), base


REPORTS = [R.kpi, R.kpi_rounded, R.daily_trips, R.daily_metrics, R.daily_rounded, R.daily_distance, R.daily_trimmed,
           R.daily_scaled, R.hourly_trips, R.hourly_fares, R.hourly_rounded, R.dow_trips, R.dow_rounded, R.dow_hour,
           R.dow_hour_matrix, R.payment_mix, R.payment_mix_fact, R.rate_mix, R.rate_mix_fact, R.rate_top_other, R.payment_stats,
           R.vendor_stats, R.rate_stats, R.pickup_counts, R.top_pickups, R.top_dropoffs, R.top_tip_locations, R.tip_by_location,
           R.source_files, R.passenger_mix, R.passenger_share, R.payment_share]


@pytest.mark.parametrize("window", [(None, None), ("2024-01-10", "2024-02-03"), ("2030-01-01", None)])
@pytest.mark.parametrize("report", REPORTS, ids=lambda f: f.__name__)
def test_reports_over_the_rollup_equal_those_over_the_facts(star, report, window):
    wh, _ = star
    args = {"floor": 1.0} if report in (R.daily_trimmed, R.daily_scaled) else {}
    over, facts = report(wh.answering_from_rollup(), *window, **args), report(wh, *window, **args)
    assert over.schema == facts.schema or [f.dataType for f in over.schema] == [f.dataType for f in facts.schema]
    assert over.collect() == facts.collect()


def test_rollup_reports_scan_no_fact(star):
    wh = star[0].answering_from_rollup()
    for report in REPORTS:
        files = report(wh).inputFiles()
        assert any("fact_rollup" in f for f in files) and not any("fact_trip" in f for f in files), report.__name__
    with pytest.raises(ValueError, match="no rollup"):
        R.partials(wh, None, None, ["vendor_key"], keys=["vendor_key", "pu_location_key"])
    with pytest.raises(ValueError, match="keeps no rollup"):
        W.empty_warehouse(wh.dim_vendor.sparkSession).answering_from_rollup()


def test_rollup_follows_a_reload_and_other_months_keep_their_files(spark, star, raw):
    wh, base = star
    jan = "yellow_tripdata_2024-01.parquet"
    feb_files = {f for f in wh.rollup.inputFiles() if "2024-02" in f}
    fewer = with_provenance(clean(raw(some_trips(30, seed=2)))).where(F.col("source_file") == jan)
    new = ST.reload_source(ST.open_warehouse(spark, base), fewer, base)
    assert {f for f in new.rollup.inputFiles() if "2024-02" in f} == feb_files
    assert R.daily_metrics(new.answering_from_rollup()).collect() == R.daily_metrics(new).collect()
    assert R.kpi(wh.answering_from_rollup()).first().trips == 200      # the state it was opened at
    cells = new.rollup.groupBy("cube").agg(F.sum("_n").alias("n")).collect()
    assert {r.n for r in cells} == {new.fact_trip.count()} and {r.cube for r in cells} == set(RU.KEYS)


def test_sketches_hold_their_rank_error(spark):
    wh = Q.warehouse(spark, SF_SMALL)
    rows = SK.checked_quantiles(wh.fact_trip, wh.sketches).collect()
    assert len(rows) == 12 and all(r.within for r in rows)
    q = SK.quantiles(wh.sketches)
    assert q._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert all("fact_sketch" in f for f in q.inputFiles())
    exact = {r.measure: r for r in R.measure_summary(wh).collect()}
    for r in SK.quantiles(wh.sketches).collect():
        assert (r.n, r.low, r.high) == (exact[r.measure]["count"], exact[r.measure].min, exact[r.measure].max)


def test_merged_sketches_of_a_large_column(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("m"), F.col("id") % 7).alias("source_file"),
                                       F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("trip_distance"),
                                       (F.col("id") / 7).alias("total_amount"), F.lit(None).cast("double").alias("tip_amount"),
                                       F.lit(1).alias("passenger_count"))
    kept = SK.sketches(rows)
    got = SK.checked_quantiles(rows, kept, (0.01, 0.25, 0.5, 0.75, 0.99)).collect()
    assert len(got) == 15 and all(r.within for r in got)
    assert max(len(r.sketch) for r in kept.collect()) < 40_000


# ---- the exact split -----------------------------------------------------------------

@pytest.mark.parametrize("few", [0, 5, 10_000])
def test_kth_smallest(spark, few):
    r = random.Random(7)
    values = [r.getrandbits(60) for _ in range(300)] + [r.getrandbits(20) for _ in range(50)] + [5] * 40 + [(1 << 60) - 1] * 3
    df = spark.createDataFrame([(v,) for v in values], "h long")
    order = sorted(values)
    for k in (1, 2, 40, 41, 90, 91, 200, len(values) - 2, len(values)):
        v = order[k - 1]
        assert kth_smallest(df, "h", k, few) == (v, order.index(v), order.count(v)), k


def test_the_split_is_exact_stable_and_not_linear(spark, raw):
    df = raw(some_trips(503))
    first = FE.with_split(df)
    n = df.count()
    assert first.where("split = 'test'").count() == math.ceil(0.2 * n)
    again = FE.with_split(df.repartition(7))
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
    for size, want in ((0.0, 0), (1.0, n), (0.5, math.ceil(0.5 * n))):
        assert FE.with_split(df, size).where("split = 'test'").count() == want
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    other = FE.with_split(df, seed=43)
    assert not first.exceptAll(other).isEmpty()
    assert FE.with_split(df.limit(0)).count() == 0


def test_identical_rows_at_the_cut_are_split_exactly(spark, raw):
    df = raw([trip()] * 60 + some_trips(40))
    for size in (0.1, 0.2, 0.3, 0.5, 0.9):
        out = FE.with_split(df, size)
        assert out.count() == 100 and out.where("split = 'test'").count() == math.ceil(round(size * 100, 9))


def test_hash_is_md5_text(spark):
    import hashlib
    row = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    want = int(hashlib.md5(b"42|1|None|x").hexdigest()[:15], 16)
    assert row.select(hash60(F.lit(42), "a", "b", "c").alias("h")).first().h == want
