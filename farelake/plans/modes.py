"""Load modes, month loop and the whole run.

``q1`` cleans raw trips and writes the month partitions; ``q2`` loads the
warehouse from written partitions; ``full`` does both, for the months of the
raw trips it is given. A load opens the warehouse that is under ``base`` and
replaces the months it loads, so months can be loaded one by one, in any
order, and again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelake.functions.rules import clean, with_provenance
from farelake.operators import features as FE
from farelake.operators import model as MD
from farelake.operators import reports as R
from farelake.operators import warehouse as W
from farelake.plans.star import (load_batch, load_zone_ids, open_warehouse, save_table, seed)
from farelake.sources import lake
from farelake.streaming.ingest import land_month_files, start_ingest

MODES = ("q1", "q2", "full")


@dataclass
class RunResult:
    mode: str
    cleaned_path: str
    warehouse: W.Warehouse | None


def check_mode(mode: str) -> str:
    m = (mode or "full").strip().lower()
    if m not in MODES:
        raise ValueError(f"load mode {mode!r} is none of {', '.join(MODES)}")
    return m


def month_files(rows: DataFrame) -> list[str]:
    """The month files of some trips: at most one name per calendar month."""
    return sorted(r[0] for r in rows.select("source_file").distinct().collect() if r[0] is not None)


def load_months(spark: SparkSession, base: str, months: Sequence[str] | None = None,
                max_rows: int | None = None, stream: tuple[str, int] | None = None) -> W.Warehouse:
    """Load written months onto the warehouse under ``base`` (created when there
    is none), then the reference rows.

    The load stands for ``months``: their facts are replaced, and those of a
    month that the lake no longer has go. With None it stands for every month
    of the lake and of the warehouse. ``stream`` is recorded with the load.
    """
    cleaned = lake.read_months(spark, f"{base}/cleaned", months)
    wh = open_warehouse(spark, base) or W.empty_warehouse(spark)
    if months is None:
        replaced = sorted({*wh.state.months, *month_files(cleaned)})
    else:
        replaced = list(months)
    if max_rows is not None:
        # A total order and one materialisation: every load sees the same rows.
        cleaned = save_table(lake.row_cap(cleaned, max_rows), base, "capped")
    return seed(load_batch(cleaned, wh, base, replaced, stream), base)


def run(spark: SparkSession, raw: DataFrame | None, base: str, mode: str = "full",
        max_rows: int | None = None, months: Sequence[str] | None = None) -> RunResult:
    """Run one ingestion in the given mode under ``base``.

    ``raw`` (q1, full) carries ``source_file``. ``q2`` loads ``months``, by
    default every written month; ``full`` loads the months of ``raw``. A month
    of ``raw`` none of whose trips pass the rules ends up empty.
    """
    mode = check_mode(mode)
    cleaned_path = f"{base}/cleaned"
    if mode in ("q1", "full"):
        if raw is None:
            raise ValueError(f"mode {mode} starts from raw trips, and none are given")
        months = month_files(raw) if months is None else months
        lake.write_cleaned(with_provenance(clean(raw)), cleaned_path, months=lake.months_of(months))
    if mode == "q1":
        return RunResult(mode, cleaned_path, None)
    return RunResult(mode, cleaned_path, load_months(spark, base, months, max_rows))


def run_months(spark: SparkSession, plan: DataFrame, raw_root: str, base: str) -> DataFrame:
    """Load the landed month files of a plan one by one (S10); the ledger.

    Each month is cleaned and loaded by jobs of its own. A month whose file
    cannot be read or loaded is recorded and the others are loaded. A file none
    of whose trips pass the rules takes the month out of lake and warehouse;
    a month without a file is left as it is. Both are ``skipped``.
    """
    def one(year: int, month: int, file_name: str) -> int | None:
        rows = lake.clean_month(spark, raw_root, f"{base}/cleaned", year, month, file_name)
        if rows is not None:
            load_months(spark, base, [file_name])
        return rows

    # Loads of one warehouse number their keys after each other: one thread.
    return lake.ingest_months(spark, plan, one, threads=1)


def stream_months(spark: SparkSession, raw_dir: str, base: str, checkpoint: str, stream: str = "months",
                  available_now: bool = True, files_per_batch: int = 1) -> StreamingQuery:
    """Month files as a stream into the warehouse under ``base``.

    Each micro-batch rebuilds its months in the lake and loads them. The
    manifest that publishes their facts also records the batch's number, so a
    batch that is run again after a failure, published or not, loads its facts
    once: published ones are passed over, and others replace their months.
    """
    def load(session: SparkSession, months: list[str], batch: int) -> None:
        wh = open_warehouse(session, base)
        if wh is not None and wh.state.streams.get(stream, -1) >= batch:
            return
        load_months(session, base, months, stream=(stream, batch))

    return start_ingest(spark, raw_dir, f"{base}/cleaned", checkpoint, available_now, files_per_batch, load)


# ---- the whole run (W09) ------------------------------------------------------

@dataclass
class Run:
    """What the stages hand on."""

    spark: SparkSession
    raw: DataFrame                 # with source_file
    zones: DataFrame               # the zone lookup's text columns
    base: str
    rounds: int = MD.ROUNDS
    ledger: DataFrame | None = None
    warehouse: W.Warehouse | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)
    model: MD.FareModel | None = None


def _land(r: Run) -> None:
    land_month_files(r.raw, f"{r.base}/raw")


def _load(r: Run) -> None:
    names = r.spark.createDataFrame([(n,) for n in month_files(r.raw)], "file_name string")
    part = lambda g: F.regexp_extract("file_name", r"(\d{4})-(\d{2})", g).cast("int")
    plan = names.select(part(1).alias("year"), part(2).alias("month"), "file_name")

    def one(year: int, month: int, file_name: str) -> int | None:
        return lake.clean_month(r.spark, f"{r.base}/raw", f"{r.base}/cleaned", year, month,
                                file_name, folder=f"source_file={file_name}")

    # Months are cleaned on their own (one that fails stops no other), then loaded together.
    r.ledger = lake.ingest_months(r.spark, plan, one)
    loaded = [x.file_name for x in r.ledger.where("status <> 'failed'").collect()]
    r.warehouse = load_months(r.spark, r.base, loaded)


def _zones(r: Run) -> None:
    r.warehouse = load_zone_ids(r.warehouse, r.zones, r.base)


def _reports(r: Run) -> None:
    wh = r.warehouse
    r.reports = {f.__name__: f(wh) for f in (R.kpi, R.daily_metrics, R.hourly_fares, R.payment_mix, R.table_counts)}


def _model(r: Run) -> None:
    rows, spec = FE.model_rows(lake.read_cleaned(r.spark, f"{r.base}/cleaned"))
    r.model = MD.train(rows, spec, rounds=r.rounds)
    r.model.rmse = MD.evaluate(r.model, rows)


STAGES: tuple[tuple[str, Callable[[Run], None]], ...] = (
    ("land", _land), ("load", _load), ("zones", _zones), ("reports", _reports), ("model", _model))


def run_all(r: Run, until: str = "model") -> Run:
    """Run the stages in order, up to and including ``until``."""
    for name, stage in STAGES:
        stage(r)
        if name == until:
            return r
    raise ValueError(f"no stage named {until!r}")
