"""Month files whose column types drift.

Public month files change types between years: ids are int in one, bigint or
double in the next, and a column can be absent. Reading them under one pinned
schema fails, so the schemas are reconciled first, from the files' own footers:

1. ``file_groups`` reads the types of the files under some paths. One job
   merges all footers of a path; only a path whose files disagree is looked at
   file by file.
2. ``reconcile`` plans one read type per wanted column: the common type of
   what the files have (integers of several widths give the widest, an integer
   and a fraction a double, dates and times a timestamp without zone, anything
   and text a text). Names match without regard to case; absent columns are null.
3. ``read_files`` scans each group of files of one type under its own schema,
   with one cast per column that needs one, and unites the groups by name. A
   column that needs no cast keeps its pushed filters.
4. ``conform`` casts to the pinned types after the row rules have run on what
   the files hold, as the reference does; a value that does not fit is null.

``schema_report`` says per column what was read as is, widened or absent.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas as S

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)
TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)
REPORT = "column_name string, file_type string, read_type string, stored_type string, files int, action string"


@dataclass
class FileGroup:
    """Files that have the same columns and types."""

    schema: T.StructType
    paths: list[str] = field(default_factory=list)
    files: int = 0

    def find(self, name: str) -> T.StructField | None:
        """The file's column of that name; an exact match goes before one in another case."""
        near = [f for f in self.schema.fields if f.name.lower() == name.lower()]
        return next((f for f in near if f.name == name), near[0] if near else None)


def leaf_files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path, from the cluster's file system; no job runs.
    A month is some files, so the list is short. Names that readers skip are left out."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, more = [], fs.listFiles(p, True)
    while more.hasNext():
        f = more.next().getPath()
        if not f.getName().startswith(("_", ".")):
            found.append(f.toString())
    return sorted(found)


def _own_schema(spark: SparkSession, path: str, merge: bool) -> T.StructType:
    return (spark.read.option("recursiveFileLookup", "true").option("mergeSchema", str(merge).lower())
            .parquet(path).schema)


def file_groups(spark: SparkSession, paths: Sequence[str], threads: int = 8) -> list[FileGroup]:
    """The files under the paths, grouped by their types (in the order found)."""
    def of_path(path: str) -> list[tuple[str, T.StructType, int]]:
        files = leaf_files(spark, path)
        if not files:
            raise FileNotFoundError(f"{path} holds no data file")
        if len(files) == 1:
            return [(path, _own_schema(spark, path, False), 1)]
        try:
            return [(path, _own_schema(spark, path, True), len(files))]
        except Exception as e:  # noqa: BLE001 - Spark raises a plain Java error here; others go on
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
        return [(f, _own_schema(spark, f, False), 1) for f in files]

    with ThreadPoolExecutor(max_workers=threads) as pool:
        found = [x for part in pool.map(of_path, paths) for x in part]
    groups: dict[tuple, FileGroup] = {}
    for path, schema, files in found:
        g = groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in schema.fields), FileGroup(schema))
        g.paths.append(path)
        g.files += files
    return list(groups.values())


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """The one type that values of all the types are read as."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, INTEGRAL) for t in distinct):
        return max(distinct, key=lambda t: INTEGRAL.index(type(t)))
    if all(isinstance(t, INTEGRAL + FRACTION) for t in distinct):
        return T.DoubleType()
    if all(isinstance(t, TIME) for t in distinct):
        return T.TimestampNTZType()
    return T.StringType()


def reconcile(groups: Sequence[FileGroup], wanted: T.StructType = S.RAW_TRIP) -> T.StructType:
    """The read type of every wanted column over all groups; a column that no file has keeps its wanted type."""
    out = []
    for w in wanted.fields:
        have = [f.dataType for g in groups if (f := g.find(w.name)) is not None]
        read = common_type(have) if have else w.dataType
        if isinstance(read, T.StringType):   # text of a number or time takes part in the rules as one
            read = T.DoubleType() if isinstance(w.dataType, INTEGRAL + FRACTION) else w.dataType
        out.append(T.StructField(w.name, read))
    return T.StructType(out)


MONTH_FILE = r"yellow_tripdata_\d{4}-\d{2}\.parquet"


def read_groups(spark: SparkSession, groups: Sequence[FileGroup], read: T.StructType, name_files: bool = False
                ) -> DataFrame:
    """All groups under their own types, cast to the read types, united by name;
    with ``name_files`` also ``source_file``, the month file named in a row's path."""
    out = None
    for g in groups:
        own = [f for r in read.fields if (f := g.find(r.name)) is not None]
        rows = spark.read.schema(T.StructType(own)).option("recursiveFileLookup", "true").parquet(*g.paths)
        cols = []
        for r in read.fields:
            f = g.find(r.name)
            c = F.lit(None) if f is None else F.col(f"`{f.name}`")
            if f is None or f.dataType != r.dataType:
                text = f is not None and isinstance(f.dataType, T.StringType)
                c = c.try_cast(r.dataType) if text else c.cast(r.dataType)   # text that is no value is null
            cols.append(c.alias(r.name))
        if name_files:
            cols.append(F.regexp_extract("_metadata.file_path", MONTH_FILE, 0).alias("source_file"))
        part = rows.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def read_files(spark: SparkSession, paths: Sequence[str], wanted: T.StructType = S.RAW_TRIP,
               name_files: bool = False) -> DataFrame:
    """The wanted columns of month files, each as the common type of what the files hold."""
    groups = file_groups(spark, paths)
    return read_groups(spark, groups, reconcile(groups, wanted), name_files)


def fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as the wanted type, null where it does not fit; a fraction stored as an integer loses its decimals."""
    return c if have == want else c.try_cast(want)


def conform(df: DataFrame, wanted: T.StructType = S.RAW_TRIP) -> DataFrame:
    """The wanted columns in their pinned types, and the other columns as they are."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in wanted.fields}
    return df.select(*[fitted(F.col(c), have[c], want[c]).alias(c) if c in want else F.col(c) for c in df.columns])


def schema_report(spark: SparkSession, paths: Sequence[str], wanted: T.StructType = S.RAW_TRIP,
                  count: str = "files") -> DataFrame:
    """Per wanted column and type found: how many files (or, with ``count="paths"``,
    how many of the paths) have it, and what is done with it.

    ``action``: same (read and stored as it is), widened (read as another type),
    narrowed (read as it is, stored as the pinned type), absent (null).
    """
    groups = file_groups(spark, paths)
    rows = []
    for w, r in zip(wanted.fields, reconcile(groups, wanted).fields, strict=True):
        files: dict[str | None, int] = {}
        for g in groups:
            f = g.find(w.name)
            kind = f.dataType.simpleString() if f is not None else None
            files[kind] = files.get(kind, 0) + (g.files if count == "files" else len(g.paths))
        read, stored = r.dataType.simpleString(), w.dataType.simpleString()
        for kind, n in files.items():
            action = "absent" if kind is None else "widened" if kind != read else "same" if read == stored else "narrowed"
            rows.append((w.name, kind, read, stored, n, action))
    return spark.createDataFrame(rows, REPORT)
