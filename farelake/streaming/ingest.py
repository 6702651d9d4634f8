"""Month files as a stream: land -> clean -> partition write per micro-batch.

The reference ingests month files one by one in a driver loop. As a stream,
newly landed files are picked up by Spark's file source, which records the
files it has processed in the checkpoint. A micro-batch names the months that
got new files; each of those months is then rebuilt whole from its own landing
folder, cleaned with the same rules and put in its place in the ``year=/month=``
lake. So a month whose files arrive over several batches ends up complete, and
a retried batch writes the same rows again instead of adding them twice.
Provenance comes from the month folder a row was read from.
``plans.modes.stream_months`` takes the stream on into the warehouse.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelake.sources import lake

FILE_MONTH = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet"


def land_month_files(raw: DataFrame, raw_dir: str) -> None:
    """Land raw trips as one folder per month file, in one job.

    ``raw`` needs a ``source_file`` column naming the month file of each row.
    The rebalance hint groups a month's rows into few tasks and lets AQE split
    a large month over several, so no month is written by a single task.
    """
    (raw.hint("rebalance", "source_file").write.mode("overwrite")
        .partitionBy("source_file").parquet(raw_dir))


def month_stream(spark: SparkSession, raw_dir: str, files_per_batch: int = 1) -> DataFrame:
    """Month file names of newly landed parquet files: a ``binaryFile`` stream
    without its ``content`` column gives one row per file and reads no data."""
    src = (spark.readStream.format("binaryFile")
           .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
           .option("pathGlobFilter", "*.parquet")
           .option("maxFilesPerTrigger", files_per_batch)
           .option("recursiveFileLookup", "true")
           .load(raw_dir))
    return src.select(F.regexp_extract(F.col("path"), FILE_MONTH, 0).alias("source_file"))


def start_ingest(spark: SparkSession, raw_dir: str, cleaned_base: str, checkpoint: str,
                 available_now: bool = True, files_per_batch: int = 1,
                 after_batch: Callable[[SparkSession, list[str], int], None] | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is landed and
    stops. ``after_batch(spark, month files, batch id)`` runs when a batch's
    months are in the lake."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # The months touched by this batch: at most one name per file of the
        # batch, and bounded by the calendar.
        session = batch.sparkSession
        months = sorted(r.source_file for r in batch.distinct().collect() if r.source_file)
        for name in months:
            (year, month), = lake.months_of([name])
            lake.clean_month(session, raw_dir, cleaned_base, year, month, name, folder=f"source_file={name}")
        if months and after_batch is not None:
            after_batch(session, months, epoch_id)

    writer = (month_stream(spark, raw_dir, files_per_batch).writeStream
              .foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
