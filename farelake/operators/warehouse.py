"""Warehouse jobs: dimension upserts, the datetime dimension, reference rows,
the fact load, constraint checks, foreign-key orphans (W02-W07, J01, J02, J11).

A dimension load is: project the natural id, cast, drop nulls, distinct, minus
the members already known (left anti join), number the new members after the
current maximum key, append. Facts resolve every natural id against the
dimensions with left joins, so a null id keeps a null key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields
from dataclasses import replace as _replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake import schemas as S
from farelake.functions.joins import bounded, fits, fits_all
from farelake.operators.keys import dense_keys, max_key, max_key_value
from farelake.session import scratch_path


@dataclass(frozen=True)
class DimSpec:
    name: str
    sources: tuple[str, ...]   # raw columns feeding the dimension
    id_col: str
    key_col: str
    seeds: tuple[int, ...] = ()


# Reference rows of the three coded dimensions (vendor 1-2,
# rate codes 1-6, payment types 1-6).
SMALL_DIMS = (
    DimSpec("dim_vendor", ("VendorID",), "vendor_id", "vendor_key", (1, 2)),
    DimSpec("dim_rate_code", ("RatecodeID",), "rate_code_id", "rate_code_key", (1, 2, 3, 4, 5, 6)),
    DimSpec("dim_payment_type", ("payment_type",), "payment_type_id", "payment_type_key",
            (1, 2, 3, 4, 5, 6)),
    DimSpec("dim_location", ("PULocationID", "DOLocationID"), "location_id", "location_key"),
)
DIM_BY_NAME = {d.name: d for d in SMALL_DIMS}

# A coded dimension is broadcast into the fact load only below this many rows,
# checked on the materialised table; above it the join shuffles.
SMALL_DIM_MAX_ROWS = 1_000_000


@dataclass(frozen=True)
class State:
    """Where the tables of a saved warehouse are. Every folder is written once
    and never changed; a load adds folders and names them in a new state."""

    # Folder of each table that is rewritten whole (the coded dimensions).
    paths: dict[str, str] = field(default_factory=dict)
    # Folders of the facts (and of their rollup and sketches), by month file.
    months: dict[str, list[str]] = field(default_factory=dict)
    rollups: dict[str, list[str]] = field(default_factory=dict)
    sketches: dict[str, list[str]] = field(default_factory=dict)
    # Folders of the datetime dimension: each load adds its new seconds.
    datetimes: list[str] = field(default_factory=list)
    # Largest keys given out so far.
    max_trip_key: int = 0
    max_datetime_key: int = 0
    # Last micro-batch loaded, by stream.
    streams: dict[str, int] = field(default_factory=dict)
    # Whether the reference rows have been added; members are never removed.
    seeded: bool = False

    def replace(self, **kw) -> "State":
        return _replace(self, **kw)


@dataclass
class Warehouse:
    dim_vendor: DataFrame
    dim_rate_code: DataFrame
    dim_payment_type: DataFrame
    dim_location: DataFrame
    dim_datetime: DataFrame
    fact_trip: DataFrame
    # What the manifest of a saved warehouse names (``plans.star``).
    state: "State" = field(default_factory=lambda: State())
    version: int = 0             # number of the manifest it was read from or last published as
    # Reads a table that is kept beside the facts ("rollup", "sketches") when it is asked for.
    kept: Callable[[str], DataFrame] | None = None
    from_rollup: bool = False

    @property
    def rollup(self) -> DataFrame:
        """Kept partial sums of the facts (``operators.rollups``)."""
        return self._kept("rollup")

    @property
    def sketches(self) -> DataFrame:
        """Kept quantile sketches of the measures (``operators.sketches``)."""
        return self._kept("sketches")

    def _kept(self, name: str) -> DataFrame:
        if self.kept is None:
            raise ValueError(f"this warehouse keeps no {name}")
        return self.kept(name)

    def answering_from_rollup(self) -> "Warehouse":
        """The same warehouse, whose counting reports read the rollup instead of the facts."""
        rows = self.rollup
        return self.replace(from_rollup=True, kept=lambda name: rows if name == "rollup" else self._kept(name))

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)
                if f.name not in ("state", "version", "kept", "from_rollup")}

    def replace(self, **kw) -> "Warehouse":
        return _replace(self, **kw)


def empty_warehouse(spark: SparkSession) -> Warehouse:
    e = lambda s: spark.createDataFrame([], s)
    return Warehouse(e(S.DIM_VENDOR), e(S.DIM_RATE_CODE), e(S.DIM_PAYMENT_TYPE),
                     e(S.DIM_LOCATION), e(S.DIM_DATETIME), e(S.FACT_STORED))


def distinct_members(df: DataFrame, sources: Sequence[str], id_col: str,
                     cast: str = "int") -> DataFrame:
    """Distinct non-null ids over one or more columns (A35), from one scan:
    each row yields its ids through ``explode``, not one scan per column."""
    ids = F.explode(F.array(*[F.col(c).cast(cast) for c in sources])).alias(id_col)
    return df.select(ids).dropna().distinct()


def new_members(df: DataFrame, sources: Sequence[str], dim: DataFrame, id_col: str,
                cast: str = "int") -> DataFrame:
    """Ids in ``df`` not yet in the dimension (J01). Distinct before the anti
    join, so the join sees one row per id."""
    return distinct_members(df, sources, id_col, cast).join(
        dim.select(id_col), id_col, "left_anti")


def seed_dim(spec: DimSpec, existing: DataFrame) -> DataFrame:
    """Add the reference rows that are missing, keys after the max.
    Running it again adds nothing. The seed list is a fixed handful of rows,
    so a window numbers it."""
    spark = existing.sparkSession
    seeds = spark.createDataFrame([(i,) for i in spec.seeds], f"{spec.id_col} int")
    new = seeds.join(existing.select(spec.id_col), spec.id_col, "left_anti")
    start = max_key_value(existing, spec.key_col)
    keyed = new.select((start + F.row_number().over(Window.orderBy(spec.id_col))).cast("int")
                       .alias(spec.key_col), spec.id_col)
    return existing.select(spec.key_col, spec.id_col).unionByName(keyed)


def upsert_small_dims(trips: DataFrame, wh: "Warehouse",
                      max_rows: int = SMALL_DIM_MAX_ROWS) -> dict[str, DataFrame]:
    """The four coded dimensions in one pass (W02): one distinct over
    (dimension, id) pairs, one anti join against the known members. Empty
    when the batch has no new member.

    New members are numbered per dimension with a window only after a count
    shows they are few (one task per dimension then holds a bounded set);
    otherwise all four are numbered in one range-partitioned pass.
    """
    # Every row yields its (dimension, id) pairs in one scan.
    pairs = trips.select(F.explode(F.array(*[
        F.struct(F.lit(spec.name).alias("dim"), F.col(src).cast("int").alias("id"))
        for spec in SMALL_DIMS for src in spec.sources])).alias("p")).select("p.dim", "p.id")
    known = None
    for spec in SMALL_DIMS:
        k = getattr(wh, spec.name).select(F.lit(spec.name).alias("dim"),
                                          F.col(spec.id_col).alias("id"), F.col(spec.key_col).alias("key"))
        known = k if known is None else known.unionByName(k)
    new = pairs.dropna().distinct().join(known.select("dim", "id"), ["dim", "id"], "left_anti")
    new = new.checkpoint(eager=True)
    starts = known.groupBy("dim").agg(F.max("key").alias("start"))
    out = {}
    n = new.count()
    if n == 0:
        return out
    if n <= max_rows:
        w = Window.partitionBy("dim").orderBy("id")
        numbered = (new.join(F.broadcast(starts), "dim", "left")  # one row per dimension
                    .select("dim", "id", (F.coalesce("start", F.lit(0)) + F.row_number().over(w))
                            .cast("int").alias("key")))
        for spec in SMALL_DIMS:
            fresh = numbered.where(F.col("dim") == spec.name).select(
                F.col("key").alias(spec.key_col), F.col("id").alias(spec.id_col))
            out[spec.name] = getattr(wh, spec.name).select(spec.key_col, spec.id_col).unionByName(fresh)
        return out
    # Many new members: one range-partitioned numbering for all four
    # dimensions, restarting per dimension, then shifted past each maximum.
    keyed = dense_keys(new, ["id"], "_pos", group_cols=["dim"])
    numbered = keyed.join(F.broadcast(starts), "dim", "left").select(  # one row per dimension
        "dim", "id", (F.coalesce("start", F.lit(0)) + F.col("_pos")).cast("int").alias("key"))
    for spec in SMALL_DIMS:
        fresh = numbered.where(F.col("dim") == spec.name).select(
            F.col("key").alias(spec.key_col), F.col("id").alias(spec.id_col))
        out[spec.name] = getattr(wh, spec.name).select(spec.key_col, spec.id_col).unionByName(fresh)
    return out


# The datetime rows a batch can match lie inside the batch's own time span.
# For month-at-a-time loads (the reference's unit) that slice is bounded: a
# month has at most 2,678,400 seconds, plus dropoffs just past its end.
DATETIME_SLICE_MAX_ROWS = 4_000_000


def datetime_slice(trips: DataFrame, dim_datetime: DataFrame,
                   ts_cols: tuple[str, str] = ("pickup_ts", "dropoff_ts")) -> DataFrame:
    """(datetime_key, ts) rows between the batch's first and last pickup or
    dropoff time; the bounds are scalar subqueries over the batch."""
    p, d = ts_cols
    lo = trips.agg(F.least(F.min(p), F.min(d)).cast("timestamp_ntz")).scalar()
    hi = trips.agg(F.greatest(F.max(p), F.max(d)).cast("timestamp_ntz")).scalar()
    return dim_datetime.select("datetime_key", "ts").where(F.col("ts").between(lo, hi))


def datetime_attributes(ts) -> list:
    """date, year, month, day, hour, dow with Sunday = 1."""
    return [F.to_date(ts).alias("date"), F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour"),
            F.dayofweek(ts).alias("dow")]


def new_datetime_rows(trips: DataFrame, existing: DataFrame,
                      slice_max_rows: int = DATETIME_SLICE_MAX_ROWS, start: int | None = None,
                      scratch: list[str] | None = None) -> DataFrame:
    """Datetime rows for the batch's seconds that the dimension lacks, keyed
    after its maximum (W03). The dimension grows with the facts, so the new
    rows are numbered with range partitions, never in one task. Known seconds
    can only lie in the batch's time span: the anti join reads that slice of
    the dimension (broadcast after a checked count), not all of it. ``start`` is
    the largest key given out, when it is known."""
    ts_cols = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    known = bounded(datetime_slice(trips, existing, ts_cols), max_rows=slice_max_rows)
    new = new_members(trips, ts_cols, known, "ts", cast="timestamp_ntz")
    offset = max_key_value(existing, "datetime_key") if start is None else start
    keyed = dense_keys(new, ["ts"], "datetime_key", offset=offset, scratch=scratch)
    return keyed.select("datetime_key", "ts", *datetime_attributes(F.col("ts")))


# Seconds of a bucket of ``second_index``: the positions of Spark's bitmaps. A bucket takes 4 KB, as much as
# this many rows of a broadcast slice.
BUCKET_BITS = 15
SLICE_ROWS_PER_BUCKET = 128
# Seconds of a piece of a bucket, as it is joined: every row that is looked up copies its piece and
# counts through half of it, so a piece is 128 bytes instead of 4 KB.
PIECE_BITS = 10


def _place(ts: str, bits: int) -> tuple[Column, Column, Column]:
    """Bucket (of 2^bits seconds) of a time, its position there, and whether the time is a whole second."""
    at = F.col(ts).cast("timestamp")
    sec = F.unix_seconds(at)
    return (F.shiftright(sec, bits), sec.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")),
            F.unix_micros(at) % 1_000_000 == 0)


def pieces(index: DataFrame) -> DataFrame:
    """The buckets of ``second_index`` cut into the pieces of 2^PIECE_BITS seconds that hold any."""
    n, size = 1 << (BUCKET_BITS - PIECE_BITS), 1 << (PIECE_BITS - 3)
    cut = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_at"))
    skip = F.col("_at") * size
    return cut.select((F.col("_bucket") * n + F.col("_at")).alias("_piece"),
                      (F.col("_first") + F.bitmap_count(F.substring("_bits", F.lit(1), skip))).alias("_first"),
                      F.substring("_bits", skip + 1, F.lit(size)).alias("_bits")).where(F.bitmap_count("_bits") > 0)


def with_second_key(df: DataFrame, index: DataFrame, ts: str, key_col: str) -> DataFrame:
    """``df`` with the key of the second ``ts`` by ``index``, null when it has none: the first key
    of its piece plus the number of earlier seconds in the piece's bitmap."""
    piece, pos, whole = _place(ts, PIECE_BITS)
    out = df.join(F.broadcast(pieces(index)), piece == F.col("_piece"), "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(pos, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = (pos % 8).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), bit)
    earlier = (F.bitmap_count(F.substring("_bits", F.lit(1), F.shiftright(pos, 3).cast("int")))
               + F.bit_count(byte.bitwiseAND(mask - 1)))
    key = F.when(whole & (byte.bitwiseAND(mask) != 0), F.col("_first") + earlier)
    return out.select(*df.columns, key.alias(key_col))


def second_index(dim: DataFrame, max_rows: int) -> DataFrame | None:
    """The keys of (datetime_key, ts) rows as one row per 2^15 seconds: the first key and a bitmap of the
    seconds there are. Its size follows the time span, not the rows. A load numbers its seconds in time
    order, so a second's key is the first key plus the earlier seconds; that is checked for every row. None
    when a row disagrees (several loads share a bucket, fractions) or there are more than ``max_rows`` buckets."""
    bucket, pos, _ = _place("ts", BUCKET_BITS)
    if max_rows <= 0:
        return None
    index = dim.groupBy(bucket.alias("_bucket")).agg(
        F.min("datetime_key").alias("_first"), F.bitmap_construct_agg(pos).alias("_bits")).checkpoint(eager=True)
    if not fits(index, max_rows):
        return None
    keyed = with_second_key(dim, index, "ts", "_key")
    return index if keyed.where(~F.col("_key").eqNullSafe(F.col("datetime_key"))).isEmpty() else None


def checked_broadcast(dim: DataFrame, max_rows: int = SMALL_DIM_MAX_ROWS,
                      source: DataFrame | None = None) -> DataFrame:
    """Broadcast a dimension only after counting it (or ``source``, the table
    it is projected from) below ``max_rows``."""
    return bounded(dim, source, max_rows)


def resolve_keys(cleaned: DataFrame, wh: Warehouse, broadcast_max_rows: int = SMALL_DIM_MAX_ROWS,
                 datetime_max_rows: int = DATETIME_SLICE_MAX_ROWS) -> DataFrame:
    """Seven left joins from natural ids to keys, then the 17 fact columns and
    the trip's own pickup and dropoff time (J02, F10).

    The four coded dimensions are broadcast after a size check. The datetime
    dimension grows with the data; only its slice inside the batch's time
    span can match, and that slice is broadcast when a count shows it within
    ``datetime_max_rows`` (a month's load), so the two role joins don't
    shuffle the fact. A longer slice is broadcast as bitmaps of its seconds
    (``second_index``), as much memory at most. Only when neither will do are
    they shuffle joins (AQE splits skewed partitions).
    """
    f = cleaned.select(
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("RatecodeID").cast("int").alias("rate_code_id"),
        F.col("payment_type").cast("int").alias("payment_type_id"),
        F.col("PULocationID").cast("int").alias("pu_location_id"),
        F.col("DOLocationID").cast("int").alias("do_location_id"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        *[F.col(m).cast("double").alias(m) for m in S.MEASURES],
        F.col("source_file"),
    )
    b = lambda d, src=None: checked_broadcast(d, broadcast_max_rows, src)
    loc = wh.dim_location
    fits_all([wh.dim_vendor, wh.dim_rate_code, wh.dim_payment_type, loc], broadcast_max_rows)
    dt = datetime_slice(f, wh.dim_datetime)
    index = None if fits(dt, datetime_max_rows) else second_index(dt, datetime_max_rows // SLICE_ROWS_PER_BUCKET)
    dt = bounded(dt, max_rows=datetime_max_rows)
    f = (f.join(b(wh.dim_vendor), "vendor_id", "left")
          .join(b(wh.dim_rate_code), "rate_code_id", "left")
          .join(b(wh.dim_payment_type), "payment_type_id", "left")
          .join(b(loc.select(F.col("location_id").alias("pu_location_id"),
                             F.col("location_key").alias("pu_location_key")), loc),
                "pu_location_id", "left")
          .join(b(loc.select(F.col("location_id").alias("do_location_id"),
                             F.col("location_key").alias("do_location_key")), loc),
                "do_location_id", "left"))
    for ts, key in (("pickup_ts", "pickup_datetime_key"), ("dropoff_ts", "dropoff_datetime_key")):
        f = (with_second_key(f, index, ts, key) if index is not None
             else f.join(dt.select(F.col("ts").alias(ts), F.col("datetime_key").alias(key)), ts, "left"))
    return f.select(*S.FACT_COLUMNS, *S.FACT_TIMES)


def load_fact(cleaned: DataFrame, wh: Warehouse, existing_fact: DataFrame | None = None,
              scratch: list[str] | None = None, start: int | None = None) -> DataFrame:
    """New facts, numbered after the current max trip key (``start``, when it is
    known) in the order of all fact columns (W05). Returns the new rows only.

    The resolved facts are written once, so the seven joins run once: the
    numbering samples and shuffles the written table. Paths to remove after
    the facts are saved are appended to ``scratch``.
    """
    spark = cleaned.sparkSession
    resolved = resolve_keys(cleaned, wh)
    path = scratch_path(spark, "resolved", uuid.uuid4().hex)
    resolved.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.append(path)
    resolved = spark.read.schema(resolved.schema).parquet(path)
    if start is None:
        start = max_key_value(existing_fact, "trip_key") if existing_fact is not None else 0
    return dense_keys(resolved, S.FACT_COLUMNS, "trip_key", offset=start, scratch=scratch).select(
        *S.FACT_STORED.fieldNames())


def seed_dims(wh: Warehouse) -> Warehouse:
    return wh.replace(**{spec.name: seed_dim(spec, getattr(wh, spec.name))
                         for spec in SMALL_DIMS if spec.seeds})


# ---- checks -----------------------------------------------------------------

FK_CHECKS = (  # (foreign key, dimension, dimension key)
    ("pickup_datetime_key", "dim_datetime", "datetime_key"),
    ("dropoff_datetime_key", "dim_datetime", "datetime_key"),
    ("vendor_key", "dim_vendor", "vendor_key"),
    ("rate_code_key", "dim_rate_code", "rate_code_key"),
    ("payment_type_key", "dim_payment_type", "payment_type_key"),
    ("pu_location_key", "dim_location", "location_key"),
    ("do_location_key", "dim_location", "location_key"),
)


def fk_orphans(wh: Warehouse) -> DataFrame:
    """Per foreign key: non-null fact keys with no dimension row.

    One scan of the fact: every row yields its (foreign key, value) pairs,
    which are reduced to distinct pairs with counts (map-side combined) before
    one anti join against the union of the dimensions' keys, tagged by the
    foreign key that references them.
    """
    t = wh.tables()
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("k"))
                                for fk, _, _ in FK_CHECKS])).alias("p")
    keys = (t["fact_trip"].select(pairs).select("p.fk", "p.k").where(F.col("k").isNotNull())
            .groupBy("fk", "k").agg(F.count(F.lit(1)).alias("n")))
    known = None
    for fk, dim, dk in FK_CHECKS:
        d = t[dim].select(F.lit(fk).alias("fk"), F.col(dk).cast("bigint").alias("k"))
        known = d if known is None else known.unionByName(d)
    orphans = keys.join(known, ["fk", "k"], "left_anti").groupBy("fk").agg(
        F.sum("n").cast("bigint").alias("orphans"))
    checks = wh.fact_trip.sparkSession.createDataFrame(
        [(fk, dim) for fk, dim, _ in FK_CHECKS], "foreign_key string, dimension string")
    # One row per foreign key (7): a bounded broadcast.
    return (checks.join(F.broadcast(orphans.withColumnRenamed("fk", "foreign_key")), "foreign_key", "left")
                  .select("foreign_key", "dimension",
                          F.coalesce(F.col("orphans"), F.lit(0).cast("bigint")).alias("orphans")))


def constraint_checks() -> list[tuple[str, list[str], list[str]]]:
    """(table, unique columns, non-null columns)."""
    small = [(d.name, [d.id_col, d.key_col], [d.key_col, d.id_col]) for d in SMALL_DIMS]
    return small + [
        ("dim_datetime", ["ts", "datetime_key"], S.DIM_DATETIME.fieldNames()),
        ("fact_trip", ["trip_key"], ["trip_key", "pickup_datetime_key", "dropoff_datetime_key"])]


def constraint_violations(wh: Warehouse) -> DataFrame:
    """Unique ids and timestamps, non-null columns, non-null datetime keys.

    One row per check: (table_name, check_name, violations). Every table is
    scanned once: a row yields the values of its unique columns, and of the
    other checked columns only nulls; one grouped count over all tables
    (combined map-side) then has every duplicate and every null.
    """
    t = wh.tables()
    values, rows = None, []
    for table, unique, required in constraint_checks():
        rows += [(table, f"unique_{c}", c, True) for c in unique]
        rows += [(table, f"not_null_{c}", c, False) for c in required]
        types = dict(t[table].dtypes)

        def value(c: str, types=types):
            v = F.unix_micros(F.col(c).cast("timestamp")) if types[c].startswith("timestamp") else F.col(c).cast("bigint")
            return F.struct(F.lit(c).alias("col"), v.alias("v"))

        always = [value(c) for c in unique]
        nulls = [F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("col"), F.lit(None).cast("bigint").alias("v")))
                 for c in required if c not in unique]
        found = F.explode(F.filter(F.array(*always, *nulls), lambda x: x.isNotNull())).alias("p")
        part = t[table].select(found).select(F.lit(table).alias("table_name"), "p.col", "p.v")
        values = part if values is None else values.unionByName(part)
    counts = values.groupBy("table_name", "col", "v").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy("table_name", "col").agg(
        F.sum(F.col("n") - 1).alias("repeats"), F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("nulls"))
    checks = wh.fact_trip.sparkSession.createDataFrame(
        rows, "table_name string, check_name string, col string, unique boolean")
    # One row per checked column: a bounded broadcast.
    return (checks.join(F.broadcast(sums), ["table_name", "col"], "left")
            .select("table_name", "check_name", F.coalesce(
                F.when(F.col("unique"), F.col("repeats")).otherwise(F.col("nulls")), F.lit(0)
            ).cast("bigint").alias("violations")))


def audit_batch(facts: DataFrame, dims: Warehouse, after: int = 0) -> DataFrame:
    """The constraints of the facts of one batch, before they are published:
    (check_name, violations), one row per check (W06, J11).

    ``unique_trip_key``: rows beyond the first of a key in the batch.
    ``new_trip_key``: keys that are not above ``after``, the largest published one
    (so a new key cannot repeat an old one). ``not_null_*``: the columns the
    fact table requires. ``orphan_*``: non-null foreign keys without a dimension
    row. Only the batch is read, and of the datetime dimension the slice inside
    the batch's time span; the published facts are not.
    """
    required = ["trip_key", "pickup_datetime_key", "dropoff_datetime_key"]
    small = facts.agg(
        F.sum(F.when(F.col("trip_key") <= after, 1).otherwise(0)).alias("new_trip_key"),
        *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"not_null_{c}") for c in required])
    repeated = (facts.where("trip_key IS NOT NULL").groupBy("trip_key").agg(F.count(F.lit(1)).alias("n"))
                .agg(F.sum(F.col("n") - 1).alias("unique_trip_key")))
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("k"))
                                for fk, _, _ in FK_CHECKS])).alias("p")
    keys = (facts.select(pairs).select("p.fk", "p.k").where("k IS NOT NULL")
            .groupBy("fk", "k").agg(F.count(F.lit(1)).alias("n")))
    known, times = None, datetime_slice(facts, dims.dim_datetime)
    for fk, dim, dk in FK_CHECKS:
        d = times if dim == "dim_datetime" else dims.tables()[dim]
        d = d.select(F.lit(fk).alias("fk"), F.col(dk).cast("bigint").alias("k"))
        known = d if known is None else known.unionByName(d)
    orphans = (keys.join(known, ["fk", "k"], "left_anti").groupBy(F.concat(F.lit("orphan_"), "fk").alias("check_name"))
               .agg(F.sum("n").alias("violations")))
    found = None
    for one in (small, repeated):   # one row each
        part = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("violations"))
                                             for c in one.columns])))
        found = part if found is None else found.unionByName(part)
    found = found.unionByName(orphans)
    names = facts.sparkSession.createDataFrame(
        [(c,) for c in [*repeated.columns, *small.columns, *[f"orphan_{fk}" for fk, _, _ in FK_CHECKS]]], "check_name string")
    # One row per check: a bounded broadcast.
    return names.join(F.broadcast(found), "check_name", "left").select(
        "check_name", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def key_ranges(wh: Warehouse) -> DataFrame:
    """Per table: rows, distinct keys, min and max key; dense keys give
    rows = distinct = max - min + 1 (W07)."""
    keys = {"dim_vendor": "vendor_key", "dim_rate_code": "rate_code_key",
            "dim_payment_type": "payment_type_key", "dim_location": "location_key",
            "dim_datetime": "datetime_key", "fact_trip": "trip_key"}
    parts = []
    for name, k in keys.items():
        df = getattr(wh, name)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"),
                            F.count_distinct(k).alias("n_keys"),
                            F.min(k).cast("bigint").alias("min_key"),
                            F.max(k).cast("bigint").alias("max_key"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_keys", "min_key", "max_key"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
