from pyspark.sql import functions as F

from farelake.functions.rules import clean
from farelake.session import scratch_path
from farelake.sources import adapter, lake
from farelake.streaming.ingest import land_month_files, start_ingest


def test_stream_ingest_matches_batch_clean(spark):
    sf = "/root/testdata/sf0.001"
    raw = adapter.raw_trips(spark, sf)
    months = ["yellow_tripdata_1996-03.parquet", "yellow_tripdata_1996-04.parquet"]
    subset = raw.where(F.col("source_file").isin(*months))
    base = scratch_path(spark, "test", "stream")
    land_month_files(subset, f"{base}/raw")
    q = start_ingest(spark, f"{base}/raw", f"{base}/cleaned", f"{base}/ckpt")
    q.awaitTermination(300)
    got = lake.read_cleaned(spark, f"{base}/cleaned")
    want = clean(subset)
    assert got.count() == want.count() > 0
    per_file = {r.source_file: r["count"] for r in got.groupBy("source_file").count().collect()}
    assert set(per_file) <= set(months)
    # a second run finds no new files and changes nothing
    q2 = start_ingest(spark, f"{base}/raw", f"{base}/cleaned", f"{base}/ckpt")
    q2.awaitTermination(300)
    assert lake.read_cleaned(spark, f"{base}/cleaned").count() == want.count()


def test_stream_month_arriving_in_two_files_is_rebuilt_whole(spark):
    sf = "/root/testdata/sf0.001"
    raw = adapter.raw_trips(spark, sf)
    months = ["yellow_tripdata_1996-03.parquet", "yellow_tripdata_1996-04.parquet"]
    subset = raw.where(F.col("source_file").isin(*months))
    half = F.pmod(F.xxhash64(*subset.columns), F.lit(2)) == 0
    base = scratch_path(spark, "test", "stream2")
    land_month_files(subset.where(half), f"{base}/raw")
    q = start_ingest(spark, f"{base}/raw", f"{base}/cleaned", f"{base}/ckpt", files_per_batch=1)
    q.awaitTermination(300)
    assert lake.read_cleaned(spark, f"{base}/cleaned").count() == clean(subset.where(half)).count()
    # The other half of both months lands later as extra files in the same folders.
    subset.where(~half).write.mode("append").partitionBy("source_file").parquet(f"{base}/raw")
    q = start_ingest(spark, f"{base}/raw", f"{base}/cleaned", f"{base}/ckpt", files_per_batch=1)
    q.awaitTermination(300)
    got = lake.read_cleaned(spark, f"{base}/cleaned")
    assert got.count() == clean(subset).count() > 0
    cols = [c for c in got.columns if c not in ("ingestion_year", "ingestion_month")]
    assert got.select(cols).exceptAll(clean(subset).select(cols)).count() == 0
