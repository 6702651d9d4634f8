"""The trip lake: month plans, raw landing, cleaned partitions, ledgers.

Cleaned data lives under ``base/year=YYYY/month=MM/`` with the month zero-padded
as the text of the partition directory. Reading the root gives ``year`` and
``month`` back as int partition columns; a filter on them prunes directories.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas as S
from farelake.functions.rules import clean, with_provenance
from farelake.functions.text import month_file_name
from farelake.sources import drift

MODES = ("single_month", "one_year", "year_range", "months")


def parse_months(raw: str | None) -> list[int]:
    """Comma list of months; blank means all twelve; a bad token raises."""
    if raw is None or not raw.strip():
        return list(range(1, 13))
    out = []
    for token in (t.strip() for t in raw.split(",")):
        if not token:
            continue
        try:
            m = int(token)
        except ValueError as e:
            raise ValueError(f"{token!r} in the month list is not a number") from e
        if not 1 <= m <= 12:
            raise ValueError(f"the month list holds {m}; months run from 1 to 12")
        out.append(m)
    return out


def month_plan(spark: SparkSession, mode: str, year: int | None = None, month: int | None = None,
               start_year: int | None = None, end_year: int | None = None,
               months: str | None = None) -> DataFrame:
    """(year, month, file_name) rows for a plan; arguments validated first."""
    if mode == "single_month":
        if month is None or not 1 <= month <= 12:
            raise ValueError(f"single_month needs a month from 1 to 12, got {month}")
        pairs = [(int(year), int(month))]
    elif mode == "one_year":
        pairs = [(int(year), m) for m in range(1, 13)]
    elif mode == "year_range":
        if start_year is None or end_year is None or start_year > end_year:
            raise ValueError(f"year_range needs start_year <= end_year, got {start_year} and {end_year}")
        pairs = [(y, m) for y in range(start_year, end_year + 1) for m in range(1, 13)]
    elif mode == "months":
        pairs = [(int(year), m) for m in parse_months(months)]
    else:
        raise ValueError(f"plan mode {mode!r} is none of {', '.join(MODES)}")
    df = spark.createDataFrame(pairs, "year int, month int")
    return df.select("year", "month", month_file_name(F.col("year"), F.col("month")).alias("file_name"))


def month_span(trips: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Every month from the first to the last pickup month, as a plan.

    The bounds are one aggregate row; ``sequence`` expands it on an executor.
    """
    b = trips.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    m = F.explode(F.sequence(F.trunc(F.to_date("lo"), "month"), F.trunc(F.to_date("hi"), "month"),
                             F.expr("interval 1 month"))).alias("m")
    return (b.where(F.col("lo").isNotNull()).select(m)
             .select(F.year("m").alias("year"), F.month("m").alias("month"))
             .select("year", "month", month_file_name(F.col("year"), F.col("month")).alias("file_name")))


def read_raw(spark: SparkSession, path: str, schema=S.RAW_TRIP) -> DataFrame:
    """Scan raw month file(s) in the pinned types (S01). The files may hold
    other types or lack a column: see ``drift``."""
    return drift.conform(drift.read_files(spark, [path], schema), schema)


def land_raw(df: DataFrame, path: str) -> DataFrame:
    """Write a raw month, replacing what is there, and return the landed data."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _partition_cols(df: DataFrame) -> DataFrame:
    def padded(c: str, width: int) -> Column:   # a formatter per row is slow
        fits = F.col(c).between(0, 10 ** width - 1)
        return F.when(fits, F.lpad(F.col(c).cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", F.col(c)))

    return df.withColumn("year", padded("ingestion_year", 4)).withColumn("month", padded("ingestion_month", 2))


def write_cleaned(df: DataFrame, base: str, mode: str = "overwrite",
                  months: Iterable[tuple[int, int]] | None = None) -> None:
    """Write cleaned trips under year=/month=.

    ``overwrite`` replaces the months of ``df`` and those named in ``months``,
    and no other: a named month of which ``df`` has no row loses its partition,
    so a month that has become empty does not keep its old trips. The rows are
    written beside the lake first and each month is then put in its place, so
    a write that fails changes nothing. ``append`` adds files as the reference
    job does.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode}")
    # Rows of a month go to the same tasks, so each task writes few files;
    # AQE splits a month larger than the advisory partition size over several
    # tasks, so no month is written by one task.
    out = _partition_cols(df).hint("rebalance", "year", "month")
    if mode == "append":
        write_partitions(out, base, ["year", "month"], mode)
        return
    spark = df.sparkSession
    staged = f"{base}/_staged-{uuid.uuid4().hex[:12]}"   # readers skip names that start with _
    try:
        out.write.partitionBy("year", "month").parquet(staged)
        leaves = [f"{y}/{m}" for y in folders(spark, staged) for m in folders(spark, f"{staged}/{y}")]
        for leaf in leaves:
            remove(spark, f"{base}/{leaf}")
            move(spark, f"{staged}/{leaf}", f"{base}/{leaf}")
        for year, month in months or ():
            if month_leaf(year, month) not in leaves:
                remove(spark, f"{base}/{month_leaf(year, month)}")
    finally:
        remove(spark, staged)


def month_leaf(year: int, month: int) -> str:
    return f"year={int(year):04d}/month={int(month):02d}"


MONTH_NAME = re.compile(r"(\d{4})-(\d{2})\.parquet$")


def months_of(files: Iterable[str]) -> list[tuple[int, int]]:
    """(year, month) of month file names; names of another form have none."""
    found = [MONTH_NAME.search(f) for f in files]
    return [(int(m[1]), int(m[2])) for m in found if m]


def write_partitions(df: DataFrame, path: str, cols: Sequence[str], mode: str) -> None:
    """Write ``df`` partitioned by ``cols``. ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic partition overwrite); ``append``
    adds files and leaves every existing file in place."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


def hadoop_path(spark: SparkSession, path: str):
    """The cluster's file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library on the cluster's file system."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; its new parent is made, and a refusal raises."""
    fs, p = hadoop_path(spark, path)
    _, q = hadoop_path(spark, to)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"{path} could not be moved to {to}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the cluster's file system."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str, only_folders: bool = False) -> list[str]:
    """Names of what a folder holds (none if it does not exist), without what readers skip."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    found = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory() or not only_folders]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    return names(spark, path, only_folders=True)


def read_cleaned(spark: SparkSession, base: str, year: int | None = None,
                 month: int | None = None) -> DataFrame:
    """Read cleaned trips; with year and month, one month by partition pruning.

    The result has the data columns only, as a leaf-path read does. Raises when
    the month has no files.
    """
    df = spark.read.option("basePath", base).parquet(base)
    if year is not None and month is not None:
        df = df.where((F.col("year") == int(year)) & (F.col("month") == int(month)))
        if df.isEmpty():
            raise FileNotFoundError(f"{base} has no rows for {year:04d}-{month:02d}")
    return df.drop("year", "month")


def read_months(spark: SparkSession, base: str, files: Sequence[str] | None = None) -> DataFrame:
    """The cleaned trips of some month files (all when None), with the pinned columns.

    Only the folders of those months are listed and read; a month without rows,
    or a lake without any, gives no rows.
    """
    keys = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    schema = T.StructType(S.CLEANED_TRIP.fields + keys.fields)
    if files is None:
        paths = [base] if folders(spark, base) else []
    else:
        paths = [p for ym in sorted(set(months_of(files))) if path_exists(spark, p := f"{base}/{month_leaf(*ym)}")]
    if not paths:
        return spark.createDataFrame([], S.CLEANED_TRIP)
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("year", "month")
    return rows if files is None else rows.where(F.col("source_file").isin(list(files)))


def append_if_rows(df: DataFrame, path: str) -> bool:
    """Append to a table only when there is something to add."""
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


# A top-k ends in one task that merges up to n rows from every split; above
# this many merged rows the cap numbers the rows with range partitions instead.
TOP_K_MERGE_MAX_ROWS = 20_000_000


def row_cap(df: DataFrame, n: int, order: Sequence[str] | None = None,
            merge_max_rows: int = TOP_K_MERGE_MAX_ROWS) -> DataFrame:
    """At most ``n`` rows in a total order (S09): the same rows on every
    evaluation.

    While n x splits stays under ``merge_max_rows`` Spark's top-k
    (TakeOrderedAndProject) does it. Beyond that the rows are numbered in the
    order with range partitions (``dense_keys``: no task sees more than its
    range) and the first n numbers are kept; the rows are the same.
    """
    from farelake.operators.keys import dense_keys
    if n is None or n <= 0:
        raise ValueError(f"the row cap must be positive, got {n}")
    cols = list(order or df.columns)
    # Files are cut into about this many splits by the scan, or fewer after a shuffle.
    splits = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), scan_splits(df))
    if int(n) * splits <= merge_max_rows:
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(int(n))
    keyed = dense_keys(df, cols, "_cap_k")
    return keyed.where(F.col("_cap_k") <= int(n)).drop("_cap_k")


def scan_splits(df: DataFrame) -> int:
    """Upper estimate of the splits that read ``df``'s source, from the optimizer's size of the plan
    (file sizes, so no job runs)."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    per = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(1, -(-size // max(1, int(per))))


LEDGER = "year int, month int, file_name string, status string, rows bigint, error string"


def ingest_months(spark: SparkSession, plan: DataFrame, load_month: Callable[[int, int, str], int | None],
                  threads: int = 4) -> DataFrame:
    """Load the planned months one by one and keep a ledger.

    ``load_month(year, month, file_name)`` loads a month as jobs of its own and
    returns its row count, or None (or 0) when there is nothing to load. A month
    that raises is recorded as ``failed`` with its error, one without data as
    ``skipped``; the others go on. The plan is a list of calendar months, so
    the loop is short; independent months run on ``threads`` threads.
    """
    def one(r):
        try:
            rows = load_month(r.year, r.month, r.file_name)
        except Exception as e:  # noqa: BLE001 - the ledger's purpose: one month's failure stops no other
            return r.year, r.month, r.file_name, "failed", 0, f"{type(e).__name__}: {e}"[:2000]
        if not rows:
            return r.year, r.month, r.file_name, "skipped", 0, f"no data for {r.file_name}"
        return r.year, r.month, r.file_name, "loaded", int(rows), None

    with ThreadPoolExecutor(max_workers=threads) as pool:
        rows = list(pool.map(one, plan.orderBy("year", "month").collect()))
    return spark.createDataFrame(rows, LEDGER)


def clean_month(spark: SparkSession, raw_root: str, cleaned: str, year: int, month: int, file_name: str,
                folder: str | None = None) -> int | None:
    """Clean one landed month file (``raw_root/folder``, by default its file name)
    into the lake (S05): None when there is no such file, else its row count.

    The rules run on the types that the files hold, and the rows are stored in
    the pinned types. A file none of whose trips pass them takes the month's
    partition away (0). The count reads the footers of the month's own files."""
    path = f"{raw_root}/{folder or file_name}"
    if not path_exists(spark, path):
        return None
    rows = drift.conform(clean(drift.read_files(spark, [path])))
    write_cleaned(with_provenance(rows, file_name, year, month), cleaned, months=[(year, month)])
    leaf = f"{cleaned}/{month_leaf(year, month)}"
    return spark.read.schema(S.CLEANED_TRIP).parquet(leaf).count() if path_exists(spark, leaf) else 0


def largest_file(spark: SparkSession, path: str) -> DataFrame:
    """The largest parquet file under ``path`` and its size.

    The ``binaryFile`` source lists the files with their lengths, one row per
    file, and reads no content when ``content`` is not selected: the work
    grows with the number of files, not with the rows in them. Ties go to
    the smallest path. Raises when there is no parquet file.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    if files.isEmpty():
        raise FileNotFoundError(f"{path} holds no parquet file")
    return files.agg(F.min_by("path", F.struct(-F.col("length"), F.col("path"))).alias("file_path"),
                     F.max("length").alias("file_size"))
