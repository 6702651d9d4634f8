"""Month files whose types drift, emptied months, audited and versioned loads, streams into the warehouse."""

import pytest
from pyspark.sql import functions as F

from farelake import schemas as S
from farelake.functions.rules import clean, with_provenance
from farelake.operators import reports as R
from farelake.operators import warehouse as W
from farelake.plans import modes as P
from farelake.plans import star as ST
from farelake.session import scratch_path
from farelake.sources import drift, lake
from farelake.streaming.ingest import land_month_files
from tests.conftest import trip

JAN, FEB, MAR = (f"yellow_tripdata_2024-0{m}.parquet" for m in (1, 2, 3))


def of_month(m, n=10, **kw):
    return [trip(pickup=f"2024-0{m}-0{1 + i % 9} 10:0{i % 10}:00", dropoff=f"2024-0{m}-0{1 + i % 9} 11:00:00", **kw)
            for i in range(n)]


def base_of(spark, name):
    import uuid
    return scratch_path(spark, "test", f"{name}-{uuid.uuid4().hex[:6]}")


def per_file(df):
    return {r.source_file: r["count"] for r in df.groupBy("source_file").count().collect()}


def state(spark, base):
    """The published facts and table sizes, read anew."""
    wh = ST.open_warehouse(spark, base)
    return (per_file(wh.fact_trip), {n: df.count() for n, df in wh.tables().items()}, wh.version)


# ---- drifting types ---------------------------------------------------------------

def land(df, base, name, types=None, drop=(), rename=None, mode="append"):
    df = df.drop("source_file", *drop).withColumns({c: F.col(c).cast(t) for c, t in (types or {}).items()})
    df.withColumnsRenamed(rename or {}).coalesce(1).write.mode(mode).parquet(f"{base}/raw/{name}")


IDS = ("VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID", "passenger_count")


def test_months_of_other_types_are_loaded(spark, raw):
    base = base_of(spark, "drift")
    rows = of_month(1, 6, vendor=None) + of_month(1, 4, pax=2)
    for name, kind in ((JAN, "int"), (FEB, "bigint"), (MAR, "double")):
        land(raw(rows), base, name, dict.fromkeys(IDS, kind))
    land(raw(of_month(4, 5)), base, "yellow_tripdata_2024-04.parquet", {"passenger_count": "string", "PULocationID": "smallint"},
         drop=["extra"], rename={"VendorID": "vendorid", "trip_distance": "Trip_Distance"})
    plan = lake.month_plan(spark, "months", year=2024, months="1,2,3,4")
    ledger = P.run_months(spark, plan, f"{base}/raw", base).collect()
    assert [(r.status, r.rows, r.error) for r in ledger] == [("loaded", 10, None)] * 3 + [("loaded", 5, None)]
    fact = ST.open_warehouse(spark, base).fact_trip
    assert per_file(fact) == {JAN: 10, FEB: 10, MAR: 10, "yellow_tripdata_2024-04.parquet": 5}
    cols = [c for c in S.FACT_COLUMNS if c not in ("source_file", "vendor_key")]
    months = [fact.where(F.col("source_file") == m).select(cols) for m in (JAN, FEB, MAR)]
    assert months[0].exceptAll(months[1]).isEmpty() and months[0].exceptAll(months[2]).isEmpty()
    april = fact.where(F.col("source_file").contains("-04")).select("extra", "vendor_key", "passenger_count").distinct().collect()
    assert [tuple(r) for r in april] == [(None, 1, 1)]
    types = dict(spark.read.parquet(f"{base}/cleaned").dtypes)
    assert {f.name: f.dataType.simpleString() for f in S.CLEANED_TRIP.fields}.items() <= types.items()


def test_files_of_one_month_may_differ(spark, raw):
    base = base_of(spark, "drift_files")
    land(raw(of_month(1, 3)), base, JAN, {"passenger_count": "int"})
    land(raw(of_month(1, 4)), base, JAN, {"passenger_count": "double"}, drop=["tolls_amount"])
    land(raw(of_month(1, 2)), base, JAN, {"passenger_count": "int"})
    groups = drift.file_groups(spark, [f"{base}/raw/{JAN}"])
    assert sorted(g.files for g in groups) == [1, 2]
    df = drift.read_files(spark, [f"{base}/raw/{JAN}"])
    assert dict(df.dtypes)["passenger_count"] == "double" and df.count() == 9
    assert df.where("tolls_amount IS NULL").count() == 4
    assert lake.read_raw(spark, f"{base}/raw/{JAN}").schema == S.RAW_TRIP
    report = {(r.column_name, r.file_type): (r.files, r.action) for r in drift.schema_report(spark, [f"{base}/raw/{JAN}"]).collect()}
    assert report["passenger_count", "int"] == (2, "widened") and report["passenger_count", "double"] == (1, "narrowed")
    assert report["tolls_amount", None] == (1, "absent") and report["VendorID", "int"] == (3, "same")
    with pytest.raises(FileNotFoundError):
        spark.range(0).limit(0).write.parquet(f"{base}/raw/none")
        lake.remove(spark, f"{base}/raw/none")
        lake.hadoop_path(spark, f"{base}/raw/none")[0].mkdirs(lake.hadoop_path(spark, f"{base}/raw/none")[1])
        drift.read_files(spark, [f"{base}/raw/none"])


def test_rules_run_on_what_the_file_holds(spark, raw):
    """Half a passenger is more than none; stored as a whole number it is 0. NaN and bad text are null."""
    base = base_of(spark, "drift_rules")
    df = raw(of_month(1, 3)).withColumn("passenger_count", F.lit(0.5))
    land(df, base, JAN)
    assert lake.clean_month(spark, f"{base}/raw", f"{base}/cleaned", 2024, 1, JAN) == 3
    assert [r.passenger_count for r in lake.read_cleaned(spark, f"{base}/cleaned").collect()] == [0, 0, 0]
    odd = raw(of_month(2, 3)).withColumn("passenger_count", F.lit("x")).withColumn("RatecodeID", F.lit(float("nan")))
    land(odd.limit(2), base, FEB, {"passenger_count": "string"})
    land(odd.limit(1).withColumn("passenger_count", F.lit("2.0")), base, FEB)
    assert lake.clean_month(spark, f"{base}/raw", f"{base}/cleaned", 2024, 2, FEB) == 1
    row = lake.read_cleaned(spark, f"{base}/cleaned", 2024, 2).first()
    assert row.passenger_count == 2 and row.RatecodeID is None


def test_a_column_of_the_pinned_type_keeps_its_pushed_filter(spark, raw):
    base = base_of(spark, "drift_push")
    land(raw(of_month(1, 3)), base, JAN, {"passenger_count": "double"})
    pushed = clean(drift.read_files(spark, [f"{base}/raw/{JAN}"])).select("PULocationID")
    plan = pushed._jdf.queryExecution().explainString(pushed._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThan(trip_distance,0.0)" in plan and "GreaterThan(passenger_count,0.0)" in plan


def test_common_types():
    from pyspark.sql import types as T
    t = drift.common_type
    assert t([T.IntegerType(), T.LongType(), T.ShortType()]) == T.LongType()
    assert t([T.IntegerType(), T.DoubleType()]) == t([T.FloatType(), T.DecimalType(9, 2)]) == T.DoubleType()
    assert t([T.TimestampType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert t([T.StringType(), T.IntegerType()]) == t([T.TimestampNTZType(), T.LongType()]) == T.StringType()


# ---- emptied months ---------------------------------------------------------------

def test_an_emptied_month_leaves_lake_facts_and_rollup(spark, raw):
    base = base_of(spark, "emptied")
    for m, name in ((1, JAN), (2, FEB)):
        land(raw(of_month(m)), base, name)
    plan = lake.month_plan(spark, "months", year=2024, months="1,2")
    assert [r.rows for r in P.run_months(spark, plan, f"{base}/raw", base).collect()] == [10, 10]
    land(raw(of_month(1, dist=-1.0)), base, JAN, mode="overwrite")
    ledger = P.run_months(spark, plan, f"{base}/raw", base).collect()
    assert [(r.status, r.rows) for r in ledger] == [("skipped", 0), ("loaded", 10)]
    assert per_file(lake.read_cleaned(spark, f"{base}/cleaned")) == {FEB: 10}
    wh = ST.open_warehouse(spark, base)
    assert per_file(wh.fact_trip) == {FEB: 10} and set(wh.state.months) == {FEB}
    assert R.kpi(wh.answering_from_rollup()).first().trips == 10
    # A month without a file is skipped too, and keeps what it has.
    lake.remove(spark, f"{base}/raw/{FEB}")
    assert [r.status for r in P.run_months(spark, plan, f"{base}/raw", base).collect()] == ["skipped", "skipped"]
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {FEB: 10}
    # And it comes back.
    land(raw(of_month(1, 4)), base, JAN, mode="overwrite")
    P.run_months(spark, plan, f"{base}/raw", base)
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {JAN: 4, FEB: 10}


def test_full_and_q2_drop_emptied_months(spark, raw):
    base = base_of(spark, "emptied_full")
    both = raw(of_month(1)).unionByName(raw(of_month(2)))
    assert per_file(P.run(spark, both, base).warehouse.fact_trip) == {JAN: 10, FEB: 10}
    bad = raw(of_month(1, fare=0.0)).unionByName(raw(of_month(2, 3)))
    assert per_file(P.run(spark, bad, base).warehouse.fact_trip) == {FEB: 3}
    P.run(spark, raw(of_month(2, fare=0.0)), base, "q1")
    assert per_file(P.run(spark, None, base, "q2").warehouse.fact_trip) == {}
    assert P.run(spark, raw(of_month(3, 2)), base).warehouse.fact_trip.count() == 2


def test_the_first_month_may_be_empty(spark, raw):
    base = base_of(spark, "first_empty")
    wh = P.run(spark, raw(of_month(1, pax=0)), base).warehouse
    assert wh.fact_trip.count() == 0 and wh.dim_vendor.count() == 2 and R.kpi(wh).first().trips == 0
    assert R.kpi(wh.answering_from_rollup()).first().trips == 0


def test_a_failed_write_leaves_the_lake(spark, raw):
    base = base_of(spark, "failed_write")
    lake.write_cleaned(with_provenance(clean(raw(of_month(1)))), base)
    broken = with_provenance(clean(raw(of_month(1, 3)))).withColumn("fare_amount", F.raise_error(F.lit("planted")).cast("double"))
    with pytest.raises(Exception, match="planted"):
        lake.write_cleaned(broken, base)
    assert lake.read_cleaned(spark, base).count() == 10 and lake.folders(spark, base) == ["year=2024"]


# ---- write, audit, publish ----------------------------------------------------------

def cleaned_of(raw, m, n=10, **kw):
    return with_provenance(clean(raw(of_month(m, n, **kw))))


def test_a_batch_that_breaks_constraints_is_not_published(spark, raw):
    base = base_of(spark, "audit")
    wh = ST.load_batch(cleaned_of(raw, 1), W.empty_warehouse(spark), base)
    before = state(spark, base)
    clean_batch = ST.stage_batch(cleaned_of(raw, 2, vendor=9), wh, base)
    assert {r.violations for r in clean_batch.audit.collect()} == {0} and clean_batch.audit.count() == 12
    f = clean_batch.facts
    first = f.agg(F.min("trip_key")).first()[0]
    at = lambda k: F.col("trip_key") == first + k
    planted = (f.withColumn("vendor_key", F.when(at(0), 77).otherwise(F.col("vendor_key")))
               .withColumn("pickup_datetime_key", F.when(at(1), None).when(at(2), 10**6).otherwise(F.col("pickup_datetime_key")))
               .withColumn("trip_key", F.when(at(3), first + 4).when(at(5), 1).otherwise(F.col("trip_key"))))
    staged = ST.stage_facts(planted, clean_batch.wh, wh, base, "planted", [FEB])
    with pytest.raises(ST.LoadRefused) as e:
        ST.publish_batch(staged, base)
    assert e.value.violations == {"unique_trip_key": 1, "new_trip_key": 1, "not_null_pickup_datetime_key": 1,
                                  "orphan_pickup_datetime_key": 1, "orphan_vendor_key": 1}
    assert "orphan_vendor_key 1" in str(e.value) and state(spark, base) == before
    assert not lake.path_exists(spark, f"{base}/fact_trip/batch=planted")
    # The next load goes on from the published state.
    again = ST.load_batch(cleaned_of(raw, 2, vendor=9), ST.open_warehouse(spark, base), base)
    assert per_file(again.fact_trip) == {JAN: 10, FEB: 10}
    assert all(r.violations == 0 for r in W.constraint_violations(again).collect())
    assert all(r.orphans == 0 for r in W.fk_orphans(again).collect())


def test_readers_see_a_month_before_or_after_a_load(spark, raw):
    base = base_of(spark, "readers")
    wh = ST.load_batch(cleaned_of(raw, 1), W.empty_warehouse(spark), base)
    before = state(spark, base)
    reader = ST.open_warehouse(spark, base)
    staged = ST.stage_batch(cleaned_of(raw, 1, 3, vendor=9, pu=99), wh, base, [JAN])
    assert state(spark, base) == before                       # dimensions and facts are written: nobody sees them
    ST.publish_batch(staged, base)
    facts, sizes, version = state(spark, base)
    assert facts == {JAN: 3} and version == before[2] + 1 and sizes["dim_vendor"] == before[1]["dim_vendor"] + 1
    # A reader of the state before still reads it whole.
    assert per_file(reader.fact_trip) == {JAN: 10} and reader.dim_vendor.count() == before[1]["dim_vendor"]
    assert R.kpi(reader).first().trips == R.kpi(reader.answering_from_rollup()).first().trips == 10


def test_two_loads_from_one_state_do_not_both_publish(spark, raw):
    base = base_of(spark, "conflict")
    ST.load_batch(cleaned_of(raw, 1), W.empty_warehouse(spark), base)
    a, b = ST.open_warehouse(spark, base), ST.open_warehouse(spark, base)
    ST.load_batch(cleaned_of(raw, 2), a, base)
    with pytest.raises(ST.LoadConflict):
        ST.load_batch(cleaned_of(raw, 3), b, base)
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {JAN: 10, FEB: 10}


def test_vacuum_keeps_the_last_states(spark, raw):
    base = base_of(spark, "vacuum")
    wh = ST.load_batch(cleaned_of(raw, 1), W.empty_warehouse(spark), base)
    wh = ST.load_batch(cleaned_of(raw, 2), wh, base)
    wh = ST.reload_source(wh, cleaned_of(raw, 1, 4, vendor=9), base)
    older = ST.open_warehouse(spark, base)
    wh = ST.reload_source(wh, cleaned_of(raw, 1, 5), base)
    gone = ST.vacuum(spark, base)
    assert any(g.startswith("fact_trip/") for g in gone) and any(g.startswith("dim_vendor-") for g in gone)
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {JAN: 5, FEB: 10}
    assert per_file(older.fact_trip) == {JAN: 4, FEB: 10} and older.dim_datetime.count() > 0
    assert ST.vacuum(spark, base) == []
    ST.vacuum(spark, base, keep=1)
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {JAN: 5, FEB: 10}
    assert ST.load_batch(cleaned_of(raw, 3), ST.open_warehouse(spark, base), base).fact_trip.count() == 25


# ---- streams into the warehouse --------------------------------------------------------

def test_a_replayed_batch_loads_its_facts_once(spark, raw):
    base = base_of(spark, "stream")
    land_month_files(raw(of_month(1)).unionByName(raw(of_month(2))), f"{base}/raw")
    run = lambda ckpt: P.stream_months(spark, f"{base}/raw", base, f"{base}/{ckpt}", files_per_batch=100).awaitTermination(300)
    run("ckpt")
    facts, _, version = state(spark, base)
    assert facts == {JAN: 10, FEB: 10} and ST.open_warehouse(spark, base).state.streams == {"months": 0}
    # The stream's own record of the batch is lost: batch 0 comes again and is passed over.
    run("ckpt2")
    assert state(spark, base)[2] == version and state(spark, base)[0] == facts
    # Further files of a month, and a month whose file has no good trip any more.
    raw(of_month(1, 3)).write.mode("append").partitionBy("source_file").parquet(f"{base}/raw")
    bad = raw(of_month(2, 3, fare=-1.0))
    bad.drop("source_file").write.mode("overwrite").parquet(f"{base}/raw/source_file={FEB}")
    run("ckpt2")
    wh = ST.open_warehouse(spark, base)
    assert per_file(wh.fact_trip) == {JAN: 13} and wh.state.streams == {"months": 1}
    assert all(r.violations == 0 for r in W.constraint_violations(wh).collect())


def test_a_batch_that_failed_before_it_was_published_is_loaded_when_it_comes_again(spark, raw, monkeypatch):
    base = base_of(spark, "stream_fail")
    land_month_files(raw(of_month(1)), f"{base}/raw")
    real, calls = ST.publish_batch, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("planted")
        return real(*args)

    monkeypatch.setattr(ST, "publish_batch", failing)
    q = P.stream_months(spark, f"{base}/raw", base, f"{base}/ckpt")
    with pytest.raises(Exception, match="planted"):
        q.awaitTermination(300)
    P.stream_months(spark, f"{base}/raw", base, f"{base}/ckpt").awaitTermination(300)
    assert per_file(ST.open_warehouse(spark, base).fact_trip) == {JAN: 10} and len(calls) == 2
