"""One key may hold a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from farelake.functions.rules import clean, with_provenance
from farelake.operators import reports as R
from farelake.operators import warehouse as W
from farelake.operators.keys import dense_keys
from farelake.plans import star as ST
from farelake.session import scratch_path
from tests.conftest import trip


def test_hot_pickup_second_loads_and_reports(spark, raw):
    rows = []
    for i in range(300):
        if i % 3 == 0:      # a third of the trips share one pickup second
            pickup = "2024-03-01 08:00:00"
        else:
            pickup = (dt.datetime(2024, 3, 1) + dt.timedelta(minutes=7 * i)).isoformat(sep=" ")
        dropoff = (dt.datetime.fromisoformat(pickup) + dt.timedelta(minutes=5 + i % 11)).isoformat(sep=" ")
        rows.append(trip(pu=1 + i % 9, do=1 + i % 5, pickup=pickup, dropoff=dropoff,
                         total=10.0 + i % 17, tip=1.0 + i % 3))
    cleaned = with_provenance(clean(raw(rows)))
    base = scratch_path(spark, "test", "skew")
    wh = ST.seed(ST.load_batch(cleaned, W.empty_warehouse(spark), base), base)
    assert wh.fact_trip.count() == 300
    keys = [r.trip_key for r in wh.fact_trip.collect()]
    assert sorted(keys) == list(range(1, 301))
    daily = {r.day.isoformat(): r.trips for r in R.daily_trips(wh).collect()}
    want = {}
    for r in rows:
        d = r[5].date().isoformat()
        want[d] = want.get(d, 0) + 1
    assert daily == want
    hours = {r.hour: r.trips for r in R.hourly_trips(wh).collect()}
    assert hours[8] >= 100
    k = R.kpi(wh).first()
    assert k.trips == 300
    assert str(k.total_revenue) == f"{sum(r[15] for r in rows):.2f}"


def test_dense_keys_with_a_third_tied_on_the_first_column(spark):
    data = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int")
    got = dense_keys(df, ["a", "b"], "k", num_partitions=6)
    ref = df.select("a", "b", F.row_number().over(Window.orderBy("a", "b")).alias("r"))
    assert got.join(ref, ["a", "b"]).where(F.col("k") != F.col("r")).count() == 0


def test_datetime_roles_same_by_broadcast_slice_and_by_shuffle(spark, raw):
    rows = []
    for i in range(240):
        pickup = "2024-03-01 08:00:00" if i % 3 == 0 else (
            dt.datetime(2024, 3, 1) + dt.timedelta(minutes=11 * i)).isoformat(sep=" ")
        dropoff = (dt.datetime.fromisoformat(pickup) + dt.timedelta(minutes=3 + i % 7)).isoformat(sep=" ")
        rows.append(trip(pickup=pickup, dropoff=dropoff, pu=1 + i % 4))
    cleaned = with_provenance(clean(raw(rows)))
    base = scratch_path(spark, "test", "dt_roles")
    wh = ST.load_batch(cleaned, W.empty_warehouse(spark), base)
    by_slice = W.resolve_keys(cleaned, wh)
    by_shuffle = W.resolve_keys(cleaned, wh, datetime_max_rows=0)
    plan = by_shuffle._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("broadcast") == 5          # only the coded dimensions
    a, b = by_slice.collect(), by_shuffle.collect()
    assert len(a) == 240 and sorted(a) == sorted(b)
    assert all(r.pickup_datetime_key is not None and r.dropoff_datetime_key is not None for r in a)


def test_fact_load_joins_do_not_shuffle_the_fact_when_the_slice_fits(spark, raw):
    rows = [trip(pickup=f"2024-03-0{1 + i % 5} 0{i % 9}:00:00", dropoff=f"2024-03-0{1 + i % 5} 0{i % 9}:30:00")
            for i in range(40)]
    cleaned = with_provenance(clean(raw(rows)))
    wh = ST.load_batch(cleaned, W.empty_warehouse(spark), scratch_path(spark, "test", "no_shuffle"))
    plan = W.resolve_keys(cleaned, wh)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 7
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
