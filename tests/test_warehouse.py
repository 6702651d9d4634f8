from pyspark.sql import functions as F

from farelake.functions.rules import clean, with_provenance
from farelake.operators import reports as R
from farelake.operators import warehouse as W
from farelake.plans import star as ST
from farelake.session import scratch_path
from tests.conftest import trip


def _load(spark, raw, rows, name):
    base = scratch_path(spark, "test", name)
    cleaned = with_provenance(clean(raw(rows)))
    wh = ST.load_batch(cleaned, W.empty_warehouse(spark), base)
    return ST.seed(wh, base), cleaned, base


def test_star_keys_nulls_and_seeds(spark, raw):
    rows = [trip(vendor=2, pay=3, pu=5, do=7), trip(vendor=None, pay=None, pu=7, do=5,
                                                     pickup="2024-01-02 08:00:00",
                                                     dropoff="2024-01-02 08:30:00"),
            trip(vendor=7, rate=None, pu=5, do=5, pickup="2024-01-03 09:00:00",
                 dropoff="2024-01-03 09:20:00")]
    wh, _, _ = _load(spark, raw, rows, "keys")
    vend = {r.vendor_id: r.vendor_key for r in wh.dim_vendor.collect()}
    # data ids first (2, 7), then missing seed 1 after the max
    assert vend == {2: 1, 7: 2, 1: 3}
    pay = {r.payment_type_id: r.payment_type_key for r in wh.dim_payment_type.collect()}
    assert (pay[1], pay[3]) == (1, 2) and sorted(pay) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.location_id for r in wh.dim_location.collect()) == [5, 7]
    facts = wh.fact_trip.orderBy("trip_key").collect()
    assert [f.trip_key for f in facts] == [1, 2, 3]
    assert sum(1 for f in facts if f.vendor_key is None) == 1      # null id keeps a null key
    assert wh.dim_datetime.count() == 6
    dows = {r.ts.isoformat(): r.dow for r in wh.dim_datetime.collect()}
    assert dows["2024-01-01T10:00:00"] == 2                        # Monday, Sunday = 1
    assert all(r.orphans == 0 for r in W.fk_orphans(wh).collect())
    assert all(r.violations == 0 for r in W.constraint_violations(wh).collect())
    # seeding again adds nothing
    again = W.seed_dims(wh)
    assert again.dim_vendor.count() == wh.dim_vendor.count()


def test_reload_is_idempotent(spark, raw):
    rows = [trip(), trip(pickup="2024-02-01 10:00:00", dropoff="2024-02-01 10:30:00", total=20.0)]
    wh, cleaned, base = _load(spark, raw, rows, "reload")
    jan = cleaned.where(F.col("source_file") == "yellow_tripdata_2024-01.parquet")
    # The fact table is updated in place: read the state before reloading.
    before = {r.source_file: r["count"] for r in wh.fact_trip.groupBy("source_file").count().collect()}
    n_times = wh.dim_datetime.count()
    twice = ST.reload_source(ST.reload_source(wh, jan, base), jan, base)
    after = {r.source_file: r["count"] for r in twice.fact_trip.groupBy("source_file").count().collect()}
    assert before == after
    assert twice.dim_datetime.count() == n_times
    keys = [r.trip_key for r in twice.fact_trip.collect()]
    assert len(set(keys)) == len(keys)


def test_reports_edges(spark, raw):
    rows = [trip(dist=30.0), trip(dist=0.5, pickup="2024-01-02 10:00:00", dropoff="2024-01-02 11:00:00"),
            trip(dist=31.0, pay=None, pax=5, pickup="2024-01-07 10:00:00", dropoff="2024-01-07 11:00:00")]
    wh, _, _ = _load(spark, raw, rows, "edges")
    b = {r.bucket: r.n for r in R.distance_buckets(wh).collect()}
    assert b == {31: 1, 1: 1}                           # x = 30 falls in bucket 31; 31 is out
    pm = R.payment_mix(wh).collect()
    assert sum(r.trips for r in pm) == 2                # the null payment key drops out
    pf = {r.payment: r.trips for r in R.payment_mix_fact(wh).collect()}
    assert pf[None] == 1                                # the fact-key variant keeps it
    pax = {r.pax_group: r.trips for r in R.passenger_mix(wh).collect()}
    assert pax == {"1": 2, "4+": 1}
    dow = {r.dow: r.day for r in R.dow_trips(wh).collect()}
    assert dow[0] == "Sun" and dow[1] == "Mon"
    dr = {r.dow for r in R.dow_rounded(wh).collect()}
    assert dr == {1, 2, 3}                              # Sunday = 1 in the dimension
    k = R.kpi_rounded(wh).first()
    assert str(k.avg_total) == "14.00"
    assert R.latest_trips(wh, n=2).count() == 2


def test_resolve_columns():
    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("seen", T.TimestampType()),
                           T.StructField("ts2", T.TimestampNTZType()), T.StructField("datetime_key", T.LongType())])
    role = R.Role
    got = R.resolve_columns(schema, {"key": role(("date_time_key", "datetime_key")), "time": role(("ts",), any_timestamp=True),
                                     "tip": role(("tip",), optional=True)})
    assert got == {"key": "datetime_key", "time": "seen", "tip": None}
    with pytest.raises(ValueError) as e:
        R.resolve_columns(schema, {"key": role(("datetime_key",)), "label": role(("label", "name")), "loc": role(("location_key",))})
    assert "label" in str(e.value) and "location_key" in str(e.value) and "key (one of datetime_key" not in str(e.value)


def test_saved_tables_keep_declared_schemas(spark, raw):
    from farelake import schemas as S
    wh, _, _ = _load(spark, raw, [trip()], "schemas")
    declared = {"dim_vendor": S.DIM_VENDOR, "dim_datetime": S.DIM_DATETIME, "fact_trip": S.FACT_STORED}
    for name, schema in declared.items():
        got = [(f.name, f.dataType) for f in getattr(wh, name).schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields]


def test_load_modes(spark, raw):
    import pytest
    from farelake.plans import modes as P
    base = scratch_path(spark, "test", "modes")
    rows = raw([trip(), trip(pickup="2024-02-01 10:00:00", dropoff="2024-02-01 10:30:00")])
    q1 = P.run(spark, rows, base, "Q1")
    assert q1.warehouse is None and spark.read.parquet(q1.cleaned_path).count() == 2
    q2 = P.run(spark, None, base, "q2", max_rows=1)
    assert q2.warehouse.fact_trip.count() == 1
    with pytest.raises(ValueError):
        P.run(spark, rows, base, "q3")
    with pytest.raises(ValueError):
        P.run(spark, None, base, "full")


def _clean_warehouse(wh):
    return (all(r.violations == 0 for r in W.constraint_violations(wh).collect())
            and all(r.orphans == 0 for r in W.fk_orphans(wh).collect()))


def test_repeated_and_monthly_runs_keep_each_fact_once(spark, raw):
    from farelake.plans import modes as P
    march = raw([trip(pickup=f"2024-03-0{1 + i % 9} 10:0{i % 10}:00", dropoff=f"2024-03-0{1 + i % 9} 11:00:00") for i in range(20)])
    april = raw([trip(pickup=f"2024-04-0{1 + i % 9} 10:00:00", dropoff=f"2024-04-0{1 + i % 9} 11:00:00", vendor=2) for i in range(9)])
    base = scratch_path(spark, "test", "months")
    per = lambda wh: {r.source_file[-10:-8]: r["count"] for r in wh.fact_trip.groupBy("source_file").count().collect()}
    assert per(P.run(spark, march, base).warehouse) == {"03": 20}
    assert per(P.run(spark, april, base).warehouse) == {"03": 20, "04": 9}
    wh = P.run(spark, march.unionByName(april), base).warehouse
    assert per(wh) == {"03": 20, "04": 9} and _clean_warehouse(wh)
    again = ST.open_warehouse(spark, base)
    assert per(again) == {"03": 20, "04": 9} and again.dim_vendor.count() == 2
    assert ST.read_table(spark, base, "dim_datetime").count() == wh.dim_datetime.count()


def test_a_folder_without_manifest_is_refused(spark, raw):
    import pytest
    from farelake.plans import modes as P
    base = scratch_path(spark, "test", "unknown")
    spark.range(3).write.parquet(f"{base}/fact_trip")
    with pytest.raises(ValueError):
        P.run(spark, raw([trip()]), base)
    with pytest.raises(FileNotFoundError):
        ST.read_table(spark, scratch_path(spark, "test", "nothing"), "fact_trip")


def test_stray_trips_stay_with_their_file(spark, raw):
    from farelake.plans import modes as P
    feb, jan = "yellow_tripdata_2024-02.parquet", "yellow_tripdata_2024-01.parquet"
    many = [trip(pickup=f"2024-02-1{i} 10:00:00", dropoff=f"2024-02-1{i} 11:00:00") for i in range(9)]
    many.append(trip(pickup="2024-01-31 23:59:00", dropoff="2024-02-01 00:10:00"))     # stray, backwards
    few = [trip(), trip(pickup="2024-02-01 00:03:00", dropoff="2024-02-01 00:20:00")]  # stray, forwards
    base = scratch_path(spark, "test", "stray")
    P.run(spark, raw(many, file=feb), base)
    wh = P.run(spark, raw(few, file=jan), base).warehouse
    for df in (spark.read.parquet(f"{base}/cleaned"), wh.fact_trip):
        assert {r.source_file: r["count"] for r in df.groupBy("source_file").count().collect()} == {feb: 10, jan: 2}
    assert spark.read.parquet(f"{base}/cleaned").where("month = 1").count() == 2


def test_a_bad_month_does_not_stop_the_others(spark, raw):
    from farelake.plans import modes as P
    from farelake.sources import lake
    base = scratch_path(spark, "test", "ledger")
    for m in (1, 4):
        raw([trip(pickup=f"2024-0{m}-01 10:00:00", dropoff=f"2024-0{m}-01 11:00:00")]).drop("source_file").write.parquet(
            f"{base}/raw/yellow_tripdata_2024-0{m}.parquet")
    spark.createDataFrame([("not parquet",)], "value string").write.text(f"{base}/raw/yellow_tripdata_2024-03.parquet")
    plan = lake.month_plan(spark, "months", year=2024, months="1,2,3,4")
    ledger = {r.month: r for r in P.run_months(spark, plan, f"{base}/raw", base).collect()}
    assert {m: r.status for m, r in ledger.items()} == {1: "loaded", 2: "skipped", 3: "failed", 4: "loaded"}
    assert ledger[3].error and ledger[4].rows == 1 and ledger[2].rows == 0
    assert ST.open_warehouse(spark, base).fact_trip.count() == 2


def test_the_whole_run(spark, raw):
    from farelake.plans import modes as P
    rows = [trip(pu=1 + i % 5, pickup=f"2024-0{1 + i % 3}-0{1 + i % 7} 10:00:00",
                 dropoff=f"2024-0{1 + i % 3}-0{1 + i % 7} 10:30:00", total=10.0 + i % 9, dist=1.0 + i % 4) for i in range(60)]
    zones = spark.createDataFrame([("77", "a", "b", None), ("x", "a", "b", None)],
                                  "`Location ID` string, Zone string, Borough string, `Shape Geometry` string")
    r = P.run_all(P.Run(spark, raw(rows), zones, scratch_path(spark, "test", "whole"), rounds=2))
    assert [x.status for x in r.ledger.collect()] == ["loaded"] * 3
    assert r.reports["kpi"].first().trips == 60 and r.model.rmse is not None
    assert 77 in {x.location_id for x in r.warehouse.dim_location.collect()} and _clean_warehouse(r.warehouse)


def test_windowed_reports_do_not_join_the_fact(spark, raw):
    wh, _, _ = _load(spark, raw, [trip()], "window_plan")
    for df in (R.kpi(wh, "2024-01-01", "2024-01-31"), R.daily_metrics(wh, "2024-01-01", "2024-01-31"),
               R.latest_trips(wh, "2024-01-01", "2024-01-31"), R.time_bounds(wh)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
    assert "PushedFilters: [IsNotNull(pickup_ts)" in R.kpi(wh, "2024-01-01")._jdf.queryExecution().executedPlan().toString()


def test_planted_violations_are_counted(spark, raw):
    wh, _, _ = _load(spark, raw, [trip(), trip(pickup="2024-01-05 10:00:00", dropoff="2024-01-05 11:00:00")], "violations")
    dt = wh.dim_datetime.unionByName(wh.dim_datetime.limit(1)).unionByName(
        wh.dim_datetime.limit(2).withColumn("ts", F.lit(None).cast("timestamp_ntz")).withColumn("date", F.lit(None).cast("date")))
    got = {(r.table_name, r.check_name): r.violations for r in W.constraint_violations(wh.replace(dim_datetime=dt)).collect()}
    n = dt.groupBy("datetime_key").count().where("count > 1").agg(F.sum(F.col("count") - 1)).first()[0]
    bad = {k: v for k, v in got.items() if v}
    assert bad == {("dim_datetime", "unique_ts"): 2, ("dim_datetime", "unique_datetime_key"): n,
                   ("dim_datetime", "not_null_ts"): 2, ("dim_datetime", "not_null_date"): 2}


def test_summary_and_histograms_cover_the_whole_fact(spark):
    n = 230_000
    fact = spark.range(1, n + 1).select(
        F.col("id").alias("trip_key"), (F.col("id") % 40 / 2.0).alias("trip_distance"), (F.col("id") % 90 + 1.0).alias("total_amount"),
        F.lit(1.0).alias("tip_amount"), F.lit(1).alias("passenger_count"))
    wh = W.Warehouse(*([fact] * 6))
    assert {r["count"] for r in R.measure_summary(wh).collect()} == {n}
    assert sum(r.n for r in R.hist_distance(wh).collect()) == n
    assert {r["count"] for r in R.measure_summary(wh, 1000).collect()} == {1000}


def test_window_reports_after_a_load_of_earlier_times(spark, raw):
    # The second batch has earlier pickups, so its datetime keys are larger
    # than the first batch's while its times are smaller: the key-range
    # prefilter of windowed reports must still keep every in-window trip.
    first = [trip(pickup="2024-03-01 10:00:00", dropoff="2024-03-01 10:10:00"),
             trip(pickup="2024-03-05 11:00:00", dropoff="2024-03-05 11:30:00")]
    later = [trip(pickup="2024-02-10 09:00:00", dropoff="2024-02-10 09:20:00"),
             trip(pickup="2024-03-02 07:00:00", dropoff="2024-03-02 07:15:00", pu=8)]
    wh, _, base = _load(spark, raw, first, "window_keys")
    wh = ST.load_batch(with_provenance(clean(raw(later))), wh, base)
    got = {r.day.isoformat(): r.trips for r in R.daily_trips(wh, "2024-02-01", "2024-03-02").collect()}
    assert got == {"2024-02-10": 1, "2024-03-01": 1, "2024-03-02": 1}
    k = R.kpi(wh, "2024-03-02", "2024-03-05").first()
    assert k.trips == 2
    assert R.kpi(wh, "2025-01-01", "2025-01-31").first().trips == 0


def test_second_load_shares_seconds_without_duplicates(spark, raw):
    first = [trip(pickup="2024-03-01 10:00:00", dropoff="2024-03-01 10:10:00")]
    second = [trip(pickup="2024-03-01 10:00:00", dropoff="2024-03-01 10:20:00"),   # known pickup
              trip(pickup="2023-12-31 23:59:00", dropoff="2024-03-01 10:10:00")]   # known dropoff
    wh, _, base = _load(spark, raw, first, "dt_overlap")
    wh = ST.load_batch(with_provenance(clean(raw(second))), wh, base)
    ts = sorted(r.ts.isoformat() for r in wh.dim_datetime.collect())
    assert ts == ["2023-12-31T23:59:00", "2024-03-01T10:00:00", "2024-03-01T10:10:00",
                  "2024-03-01T10:20:00"]
    keys = {r.ts.isoformat(): r.datetime_key for r in wh.dim_datetime.collect()}
    assert keys["2024-03-01T10:00:00"] == 1 and keys["2024-03-01T10:10:00"] == 2
    assert all(r.violations == 0 for r in W.constraint_violations(wh).collect())
    assert all(r.orphans == 0 for r in W.fk_orphans(wh).collect())


def test_loads_and_reloads_touch_only_their_own_month_files(spark, raw):
    rows = [trip(), trip(pickup="2024-02-01 10:00:00", dropoff="2024-02-01 10:30:00", total=20.0)]
    wh, cleaned, base = _load(spark, raw, rows, "reload_files")
    files = lambda df: set(df.inputFiles())                    # noqa: E731
    first, first_dt = files(wh.fact_trip), files(wh.dim_datetime)
    march = [trip(pickup="2024-03-03 10:00:00", dropoff="2024-03-03 10:30:00")]
    wh = ST.load_batch(with_provenance(clean(raw(march))), wh, base)
    appended = files(wh.fact_trip)
    assert first < appended                                   # append: old files kept as they are
    assert first_dt < files(wh.dim_datetime)                  # new seconds appended, old kept
    assert wh.dim_datetime.count() == 6
    jan = cleaned.where(F.col("source_file") == "yellow_tripdata_2024-01.parquet")
    wh = ST.reload_source(wh, jan, base)
    reloaded = files(wh.fact_trip)
    is_jan = lambda p: "yellow_tripdata_2024-01" in p          # noqa: E731
    assert {p for p in appended if not is_jan(p)} == {p for p in reloaded if not is_jan(p)}
    assert {p for p in appended if is_jan(p)}.isdisjoint({p for p in reloaded if is_jan(p)})
    assert wh.fact_trip.count() == 3


def test_dist_sample_key_bound_matches_plain_ordered_limit(spark):
    # Only every 7th trip has a distance, so the bound has to grow past n.
    fact = spark.range(1, 5001).select(
        F.col("id").alias("trip_key"),
        F.when(F.col("id") % 7 == 0, F.col("id") / 10).alias("trip_distance"),
        (F.col("id") % 50 + 1.0).alias("total_amount"),
        F.lit(1.0).alias("tip_amount"), F.lit(1).alias("passenger_count"))
    wh = W.Warehouse(*([fact] * 6))
    for n in (1, 30, 500, 10000):
        got = R.dist_sample(wh, n).collect()
        want = (fact.where(F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull())
                .orderBy("trip_key").limit(n).collect())
        assert got == want, n


def test_first_by_key_with_keys_starting_high(spark):
    df = spark.range(10**9, 10**9 + 3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    df = df.where(F.col("v") == 0)
    for n in (1, 7, 999, 1000, 5000):
        assert R.first_by_key(df, "k", n).collect() == df.orderBy("k").limit(n).collect(), n
    assert R.first_by_key(df.where(F.col("k") < 0), "k", 5).count() == 0


def test_latest_trips_match_the_join(spark, raw):
    # Every dropoff is later than every pickup; two trips tie on the pickup.
    rows = [trip(pickup=f"2024-03-01 0{i // 6}:{i % 6}0:00", dropoff=f"2024-03-02 0{i // 6}:{i % 6}0:00",
                 total=10.0 + i) for i in range(36)]
    rows += [trip(pickup="2024-03-01 05:50:00", dropoff="2024-03-02 07:00:00", total=99.0)]
    wh, _, _ = _load(spark, raw, rows, "latest")
    dt = wh.dim_datetime.select(F.col("datetime_key").alias("pickup_datetime_key"), F.col("ts").alias("pickup_time"))
    for n in (1, 2, 5, 100):
        got = R.latest_trips(wh, n=n).select("trip_key", "pickup_time").collect()
        want = (wh.fact_trip.join(dt, "pickup_datetime_key").orderBy(F.desc("pickup_time"), "trip_key").limit(n)
                .select("trip_key", "pickup_time").collect())
        assert got == want
