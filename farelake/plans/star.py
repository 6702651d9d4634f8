"""Build the star from cleaned trips and materialise it.

Stage order follows the reference: clean and write the month
partitions, read them back (the materialisation point), load dimensions, load
facts, then add the reference rows. Every table is written as parquet in the
shared folder and read back, so reports read a fixed warehouse and the lineage
of the load is cut.

A load writes, audits, then publishes. All it writes goes to fresh folders that
no reader knows; the batch's constraints are checked there; a numbered
manifest then names the folders of every table and month. So a batch that
breaks a constraint leaves the warehouse as it was, a reader sees a month
before or after a load and never between, and a month that has become empty
goes with the state that no longer names it. ``vacuum`` removes what only older
states name.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import uuid
import threading
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas as S
from farelake.functions.rules import clean, with_provenance
from farelake.operators import rollups as RU
from farelake.operators import sketches as SK
from farelake.operators import warehouse as W
from farelake.session import checkpoint_base, scratch_path
from farelake.sources import adapter, lake
from farelake.sources import zones as zone_src

_seq = itertools.count()
_lock = threading.Lock()
_STARS: dict[tuple[str, str], "StarBuild"] = {}


class StarBuild:
    """Paths and tables of one materialised warehouse."""

    def __init__(self, base: str, cleaned_path: str, wh: W.Warehouse, zones_path: str):
        self.base = base
        self.cleaned_path = cleaned_path
        self.wh = wh
        self.zones_path = zones_path

    def zones(self, spark: SparkSession) -> DataFrame:
        return zone_src.read_zones(spark, self.zones_path)

    def zone_text(self, spark: SparkSession) -> DataFrame:
        return zone_src.read_zone_text(spark, self.zones_path)

    def cleaned(self, spark: SparkSession) -> DataFrame:
        return lake.read_cleaned(spark, self.cleaned_path)


def save_path(df: DataFrame, base: str, name: str) -> str:
    """Write a table to a fresh folder; its path."""
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return path


def save_table(df: DataFrame, base: str, name: str) -> DataFrame:
    """Write a table to a fresh folder and read it back."""
    return df.sparkSession.read.parquet(save_path(df, base, name))


def save_small_dims(wh: W.Warehouse, base: str, only: tuple[str, ...]) -> W.Warehouse:
    """Write the chosen coded dimensions; independent writes are submitted as
    concurrent Spark jobs so small tables don't wait on each other."""
    tables = wh.tables()
    with ThreadPoolExecutor(max_workers=max(1, len(only))) as pool:
        futures = {n: pool.submit(save_path, tables[n], base, n) for n in only}
        paths = {n: f.result() for n, f in futures.items()}
    spark = wh.dim_vendor.sparkSession
    return wh.replace(**{n: spark.read.parquet(path) for n, path in paths.items()},
                      state=wh.state.replace(paths={**wh.state.paths, **paths}))


BATCH = T.StructField("batch", T.StringType())
# Tables kept by month file: each batch's months in folders of their own.
PARTED = ("fact_trip", "fact_rollup", "fact_sketch")


def read_parts(spark: SparkSession, base: str, table: str, schema: T.StructType,
               months: dict[str, list[str]]) -> DataFrame:
    """The rows of a table that is kept by month file: the folders that a state names,
    and no others. ``source_file`` is the partition column."""
    paths = [f"{base}/{p}" for parts in months.values() for p in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType(schema.fields + [BATCH])).option("basePath", f"{base}/{table}").parquet(*paths)
    return rows.select(*schema.fieldNames())


def write_parts(df: DataFrame, base: str, table: str, batch: str) -> dict[str, list[str]]:
    """Write a batch of such a table to folders of its own; (month file -> folders)."""
    spark, root = df.sparkSession, f"{table}/batch={batch}"
    df.write.partitionBy("source_file").parquet(f"{base}/{root}")
    names = lake.folders(spark, f"{base}/{root}")
    return {unquote(n.split("=", 1)[1]): [f"{root}/{n}"] for n in names}


def write_facts(facts: DataFrame, base: str, batch: str) -> dict[str, list[str]]:
    """Write the facts of a batch, partitioned by ``source_file``, in trip-key
    order inside each file (numbering ranges follow pickup time, so a task
    holds one or two months), which keeps parquet min/max statistics on the
    keys tight."""
    out = facts.select(*S.FACT_STORED.fieldNames()).sortWithinPartitions("source_file", "trip_key")
    return write_parts(out, base, "fact_trip", batch)


def read_facts(spark: SparkSession, base: str, state: W.State) -> DataFrame:
    return read_parts(spark, base, "fact_trip", S.FACT_STORED, state.months)


def read_datetimes(spark: SparkSession, base: str, state: W.State) -> DataFrame:
    paths = [f"{base}/{p}" for p in state.datetimes]
    return spark.read.schema(S.DIM_DATETIME).parquet(*paths) if paths else spark.createDataFrame([], S.DIM_DATETIME)


def load_dims(cleaned: DataFrame, wh: W.Warehouse, base: str, batch: str, scratch: list[str] | None = None) -> W.Warehouse:
    """The five dimension upserts of a batch, written but not published. The
    coded dimensions (small) are written whole to fresh folders if the batch has
    new members; the datetime dimension grows with the data, so only its new seconds are written, to a
    folder of this batch. The writes run as concurrent jobs."""
    spark = cleaned.sparkSession
    known = wh.state.max_datetime_key or None
    folder = f"dim_datetime/batch={batch}"

    def small_dims() -> tuple[str, ...]:
        changed = W.upsert_small_dims(cleaned, wh)
        if not wh.state.paths:   # the first load writes all four
            changed = {d.name: changed.get(d.name, getattr(wh, d.name)) for d in W.SMALL_DIMS}
        return save_small_dims(wh.replace(**changed), base, only=tuple(changed))

    def datetimes() -> int:
        W.new_datetime_rows(cleaned, wh.dim_datetime, start=known, scratch=scratch).write.parquet(f"{base}/{folder}")
        return W.max_key(spark.read.schema(S.DIM_DATETIME).parquet(f"{base}/{folder}"), "datetime_key")

    with ThreadPoolExecutor(max_workers=2) as pool:
        a, b = pool.submit(small_dims), pool.submit(datetimes)
        small, top = a.result(), b.result()
    state = small.state.replace(datetimes=[*small.state.datetimes, folder], max_datetime_key=max(top, known or 0))
    return small.replace(dim_datetime=read_datetimes(spark, base, state), state=state)


class LoadRefused(Exception):
    """A batch that breaks a constraint. ``violations``: check -> rows."""

    def __init__(self, violations: dict[str, int]):
        super().__init__("the batch was not published: " + ", ".join(f"{c} {n}" for c, n in sorted(violations.items())))
        self.violations = violations


class LoadConflict(Exception):
    """Another load published a warehouse state meanwhile."""


@dataclass
class Staged:
    """A batch that is written but that no reader sees yet."""

    wh: W.Warehouse            # the warehouse once the batch is published
    facts: DataFrame           # the batch's facts
    folders: list[str]         # what the batch wrote
    audit: DataFrame           # (check_name, violations) of the batch, one row per check
    violations: dict[str, int]


def stage_facts(facts: DataFrame, dims: W.Warehouse, before: W.Warehouse, base: str, batch: str,
                replaced: Sequence[str] | None = None) -> Staged:
    """Write a batch's facts, and their rollup and sketches, to folders of their own.

    ``replaced``: the month files the batch stands for; their published facts
    go, also those of a month of which the batch has no fact. None adds to what
    is there.
    """
    spark = facts.sparkSession
    months = write_facts(facts, base, batch)
    written = read_parts(spark, base, "fact_trip", S.FACT_STORED, months)
    # The audit and what is kept beside the facts read the written facts, each in one scan.
    with ThreadPoolExecutor(max_workers=3) as pool:
        audit = pool.submit(W.audit_batch(written, dims, before.state.max_trip_key).collect)
        rollup = pool.submit(write_parts, RU.rollup(written), base, "fact_rollup", batch) if months else None
        sketch = pool.submit(write_parts, SK.sketches(written), base, "fact_sketch", batch) if months else None
        checks = [(r.check_name, r.violations) for r in audit.result()]
        rollups, kept = (x.result() if x else {} for x in (rollup, sketch))

    def after(old: dict[str, list[str]], new: dict[str, list[str]]) -> dict[str, list[str]]:
        out = {m: list(parts) for m, parts in old.items() if m not in (replaced or ())}
        for m, parts in new.items():
            out[m] = out.get(m, []) + parts
        return out

    state = dims.state.replace(months=after(dims.state.months, months), rollups=after(dims.state.rollups, rollups),
                               sketches=after(dims.state.sketches, kept), max_trip_key=max(before.state.max_trip_key, W.max_key(written, "trip_key")))
    wh = attach(spark, dims.replace(state=state), base)
    mine = [f"{base}/{t}/batch={batch}" for t in (*PARTED, "dim_datetime")]
    mine += [p for n, p in state.paths.items() if before.state.paths.get(n) != p]
    return Staged(wh, written, mine, spark.createDataFrame(checks, "check_name string, violations long"),
                  {c: n for c, n in checks if n})


def stage_batch(cleaned: DataFrame, wh: W.Warehouse, base: str, replaced: Sequence[str] | None = None) -> Staged:
    """Write one batch of cleaned trips beside the published warehouse:
    dimensions first, then facts resolved against them. The resolved and
    numbering tables are removed afterwards."""
    spark, batch = cleaned.sparkSession, uuid.uuid4().hex[:12]
    scratch: list[str] = []
    if cleaned.isEmpty():   # nothing to resolve: the batch only takes months away
        return stage_facts(spark.createDataFrame([], S.FACT_STORED), wh, wh, base, batch, replaced)
    dims = load_dims(cleaned, wh, base, batch, scratch)
    facts = W.load_fact(cleaned, dims, wh.fact_trip, scratch, start=wh.state.max_trip_key or None)
    staged = stage_facts(facts, dims, wh, base, batch, replaced)
    for path in scratch:
        lake.remove(spark, path)
    return staged


def publish_batch(staged: Staged, base: str, stream: tuple[str, int] | None = None) -> W.Warehouse:
    """Publish a staged batch if its audit found no broken constraint: one
    manifest switches readers to its dimensions and facts at once. A batch that
    breaks one is removed and ``LoadRefused`` raised; the published warehouse
    stays as it was. ``stream``: (stream, micro-batch) to record with it."""
    spark = staged.facts.sparkSession
    if staged.violations:
        drop_staged(spark, staged)
        raise LoadRefused(staged.violations)
    wh = staged.wh
    if stream:
        wh = wh.replace(state=wh.state.replace(streams={**wh.state.streams, stream[0]: int(stream[1])}))
    publish_warehouse(spark, wh, base)
    return wh


def drop_staged(spark: SparkSession, staged: Staged) -> None:
    for path in staged.folders:
        lake.remove(spark, path)


def load_batch(cleaned: DataFrame, wh: W.Warehouse, base: str, replaced: Sequence[str] | None = None,
               stream: tuple[str, int] | None = None) -> W.Warehouse:
    """Write, audit and publish one batch of cleaned trips. With ``replaced`` the
    batch stands for those month files (see ``stage_facts``), so loading a
    month again adds nothing twice and an emptied month leaves nothing."""
    return publish_batch(stage_batch(cleaned, wh, base, replaced), base, stream)


def seed(wh: W.Warehouse, base: str) -> W.Warehouse:
    """Add the reference rows that are missing (W04) and publish; once added
    they stay, so later calls do nothing."""
    if wh.state.seeded:
        return wh
    out = save_small_dims(W.seed_dims(wh), base, only=tuple(d.name for d in W.SMALL_DIMS if d.seeds))
    out = out.replace(state=out.state.replace(seeded=True))
    publish_warehouse(wh.dim_vendor.sparkSession, out, base)
    return out


def load_zone_ids(wh: W.Warehouse, zone_text: DataFrame, base: str) -> W.Warehouse:
    """Add the lookup's numeric ids that ``dim_location`` lacks, numbered after
    its maximum, and publish (S13). Loading them again adds nothing."""
    spec = W.DIM_BY_NAME["dim_location"]
    new = zone_src.zone_ids_to_load(zone_text, wh.dim_location)
    keyed = W.dense_keys(new, [spec.id_col], spec.key_col,
                         offset=W.max_key_value(wh.dim_location, spec.key_col), key_type="int")
    out = wh.replace(dim_location=wh.dim_location.unionByName(keyed.select(spec.key_col, spec.id_col)))
    out = save_small_dims(out, base, only=("dim_location",))
    publish_warehouse(wh.dim_vendor.sparkSession, out, base)
    return out


def reload_source(wh: W.Warehouse, cleaned: DataFrame, base: str, files: Sequence[str] | None = None) -> W.Warehouse:
    """Idempotent re-load (W10): the facts of the batch take the place of those of
    its month files (``files``; by default those in the batch), so nothing is
    added twice and no other month is rewritten. New trip keys continue after
    the current maximum, as a database sequence does after deletes. Dimension
    members are kept (upserts add nothing twice)."""
    if files is None:
        files = [r[0] for r in cleaned.select("source_file").distinct().collect()]
    return load_batch(cleaned, wh, base, replaced=files)


def cleaned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw test trips, cleaned, with provenance (F01, F03). Lazy."""
    return with_provenance(clean(adapter.raw_trips(spark, sf_dir)))


def build_star(spark: SparkSession, sf_dir: str, base: str | None = None) -> StarBuild:
    """Full mode: clean -> write partitions -> read back -> load -> seed."""
    base = base or scratch_path(spark, "star", f"b{next(_seq)}")
    cleaned_path = f"{base}/cleaned"
    lake.write_cleaned(cleaned_trips(spark, sf_dir), cleaned_path)
    cleaned = lake.read_cleaned(spark, cleaned_path)
    wh = load_batch(cleaned, W.empty_warehouse(spark), base)
    wh = seed(wh, base)
    zones_path = f"{base}/zones_csv"
    zone_src.write_zone_csv(adapter.zone_lookup(spark, sf_dir), zones_path)
    return StarBuild(base, cleaned_path, wh, zones_path)


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of a build: the library's source and the input tables' size and
    modification time, read through the cluster file system."""
    h = hashlib.sha256()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for root, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                h.update(f.encode())
                with open(os.path.join(root, f), "rb") as fh:
                    h.update(fh.read())
    for name in adapter.INPUT_TABLES:
        fs, p = lake.hadoop_path(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        st = fs.getFileStatus(p)
        h.update(f"{name}:{fs.getContentSummary(p).getLength()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:24]


def publish_json(spark: SparkSession, path: str, payload: dict) -> bool:
    """Write a small JSON manifest through a rename: readers see all of it or
    nothing. If another run published first, its manifest is kept (False)."""
    fs, final = lake.hadoop_path(spark, path)
    _, tmp = lake.hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(payload).encode("utf-8")))
    out.close()
    done = not fs.exists(final) and fs.rename(tmp, final)
    if not done:
        fs.delete(tmp, False)
    return done


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = lake.hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


MANIFESTS = "_warehouse"


def _manifests(spark: SparkSession, base: str) -> list[str]:
    fs, p = lake.hadoop_path(spark, f"{base}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(n for n in names if n.endswith(".json"))


def publish_warehouse(spark: SparkSession, wh: W.Warehouse, base: str) -> None:
    """Record the state of the warehouse under ``base``: a numbered manifest that
    a rename makes visible as a whole. A reader has the state before or the
    state after, never a mixture. Raises ``LoadConflict`` when the state that
    ``wh`` is based on is no longer the latest."""
    have = _manifests(spark, base)
    number = int(have[-1].split(".")[0]) if have else 0
    if number != wh.version:
        raise LoadConflict(f"{base} is at state {number}; this load started from {wh.version}")
    path = f"{base}/{MANIFESTS}/{number + 1:08d}.json"
    if not publish_json(spark, path, asdict(wh.state)):
        raise LoadConflict(f"{path} was published by another load")
    wh.version = number + 1


def attach(spark: SparkSession, wh: W.Warehouse, base: str) -> W.Warehouse:
    """``wh`` with the tables that are kept in parts read by its state."""
    state = wh.state

    def kept(name: str) -> DataFrame:
        table, schema, months = {"rollup": ("fact_rollup", RU.ROLLUP, state.rollups),
                                 "sketches": ("fact_sketch", SK.SKETCHES, state.sketches)}[name]
        return read_parts(spark, base, table, schema, months)

    return wh.replace(fact_trip=read_facts(spark, base, state), dim_datetime=read_datetimes(spark, base, state), kept=kept)


def open_warehouse(spark: SparkSession, base: str) -> W.Warehouse | None:
    """The warehouse saved under ``base`` (S07), by its latest manifest; None
    when there is none. Its tables stay as they are while later loads publish
    other states. A folder that holds a fact or datetime table without a
    manifest is refused: loading onto it would mix two warehouses."""
    have = _manifests(spark, base)
    if not have:
        for name in ("fact_trip", "dim_datetime"):
            # Folders of batches are what loads that were never published left.
            if [n for n in lake.names(spark, f"{base}/{name}") if not n.startswith("batch=")]:
                raise ValueError(f"{base} holds a {name} table that no manifest describes")
        return None
    state = W.State(**read_json(spark, f"{base}/{MANIFESTS}/{have[-1]}"))
    wh = W.empty_warehouse(spark).replace(**{n: spark.read.parquet(p) for n, p in state.paths.items()}, state=state,
                                          version=int(have[-1].split(".")[0]))
    return attach(spark, wh, base)


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove the folders that none of the last ``keep`` states names, and the
    older manifests; what was removed. For a time when no load is running and
    no reader has an older state open."""
    have = _manifests(spark, base)
    states = [W.State(**read_json(spark, f"{base}/{MANIFESTS}/{n}")) for n in have[-keep:]]
    used = {p for s in states for parts in (*s.months.values(), *s.rollups.values(), *s.sketches.values(), s.datetimes)
            for p in parts}
    used |= {p.rsplit("/", 1)[1] for s in states for p in s.paths.values()}
    gone = []
    for table in PARTED:
        for batch in lake.folders(spark, f"{base}/{table}"):
            parts = lake.folders(spark, f"{base}/{table}/{batch}")
            dead = [p for p in parts if f"{table}/{batch}/{p}" not in used]
            gone += [f"{table}/{batch}"] if len(dead) == len(parts) else [f"{table}/{batch}/{p}" for p in dead]
    gone += [f"dim_datetime/{b}" for b in lake.folders(spark, f"{base}/dim_datetime") if f"dim_datetime/{b}" not in used]
    dims = tuple(f"{d.name}-" for d in W.SMALL_DIMS)
    gone += [n for n in lake.folders(spark, base) if n.startswith(dims) and n not in used]
    for path in [*gone, *[f"{MANIFESTS}/{n}" for n in have[:-keep]]]:
        lake.remove(spark, f"{base}/{path}")
    return gone


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of the warehouse saved under ``base``."""
    wh = open_warehouse(spark, base)
    if wh is None or name not in wh.tables():
        raise FileNotFoundError(f"{base} has no warehouse table {name}")
    return wh.tables()[name]


def _publish(spark: SparkSession, manifest: str, b: StarBuild) -> None:
    publish_json(spark, manifest, {"base": b.base, "cleaned_path": b.cleaned_path, "zones_path": b.zones_path})


def _load_published(spark: SparkSession, manifest: str) -> StarBuild | None:
    m = read_json(spark, manifest)
    if m is None:
        return None
    return StarBuild(m["base"], m["cleaned_path"], open_warehouse(spark, m["base"]), m["zones_path"])


def star_for(spark: SparkSession, sf_dir: str, reuse: bool = True) -> StarBuild:
    """The warehouse of ``sf_dir``: built once per application, and reused
    across applications from the shared folder when the same library source
    and the same input files built it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        if key in _STARS:
            return _STARS[key]
        build = None
        manifest = None
        if reuse:
            manifest = f"{checkpoint_base(spark)}/farelake-builds/{fingerprint(spark, sf_dir)}/manifest.json"
            build = _load_published(spark, manifest)
        if build is None:
            build = build_star(spark, sf_dir)
            if manifest:
                _publish(spark, manifest, build)
        _STARS[key] = build
        return build


def warehouse(spark: SparkSession, sf_dir: str) -> W.Warehouse:
    return star_for(spark, sf_dir).wh
