"""Row rules as named Columns: cleaning (F01-F03), model filters (F05-F08),
the date window (F09).

Every rule is a boolean Column; a row passes when the rule is true. A null
comparison is not true, so it rejects the row, as a SQL WHERE does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions.text import month_file_name

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TARGET = "total_amount"


def clean_rules() -> list[tuple[str, Column]]:
    """The cleaning rules of the ingestion job, in order."""
    c = F.col
    return [
        ("passenger_count_positive", c("passenger_count") > 0),
        ("trip_distance_positive", c("trip_distance") > 0),
        ("fare_amount_positive", c("fare_amount") > 0),
        ("pickup_present", c(PICKUP).isNotNull()),
        ("dropoff_present", c(DROPOFF).isNotNull()),
        ("pickup_before_dropoff", c(PICKUP) < c(DROPOFF)),
        ("pu_location_present", c("PULocationID").isNotNull()),
        ("do_location_present", c("DOLocationID").isNotNull()),
    ]


def all_of(rules: Sequence[tuple[str, Column]]) -> Column:
    cond = F.lit(True)
    for _, r in rules:
        cond = cond & r
    return cond


def clean(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Keep the rows that pass every rule (F01). Plain comparisons, so the
    predicates reach the parquet scan."""
    return df.where(all_of(rules or clean_rules()))


def reject_profile(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Rows failing each rule, one row per rule (F02): (rule_order, rule, rejected).

    A row is counted for every rule it fails; a null comparison fails.
    Computed in one pass: a global aggregate of one counter per rule.
    """
    rules = list(rules or clean_rules())
    counters = [F.sum(F.when(F.coalesce(r, F.lit(False)), 0).otherwise(1)).cast("bigint").alias(f"r{i}")
                for i, (_, r) in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *counters)
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("rule_order"), F.lit(name).alias("rule"),
                               F.coalesce(F.col(f"r{i}"), F.lit(0).cast("bigint")).alias("rejected"))
                      for i, (name, _) in enumerate(rules)])
    return wide.select(F.inline(pairs))


# The month file a row came from names its year and month.
FILE_MONTH = r"(\d{4})-(\d{2})\.parquet$"


def with_provenance(df: DataFrame, file_name: str | None = None, year: int | None = None,
                    month: int | None = None) -> DataFrame:
    """Add source_file, ingestion_year, ingestion_month.

    Provenance belongs to the file, not to the trip: with ``year`` and
    ``month`` (and, if it differs from the usual name, ``file_name``) it is that
    month's; otherwise ``df`` must carry ``source_file``, and year and month are
    read from its name. A trip whose pickup lies in another month stays with
    its file.
    """
    if year is not None and month is not None:
        y, m = F.lit(int(year)), F.lit(int(month))
        name = F.lit(file_name) if file_name else month_file_name(y, m)
    elif "source_file" in df.columns:
        name = F.col("source_file")
        y, m = (F.nullif(F.regexp_extract(name, FILE_MONTH, g), F.lit("")) for g in (1, 2))
    else:
        raise ValueError("provenance needs year and month, or a source_file column")
    cols = [c for c in df.columns if c not in ("source_file", "ingestion_year", "ingestion_month")]
    return df.select(*cols, name.alias("source_file"), y.cast("int").alias("ingestion_year"),
                     m.cast("int").alias("ingestion_month"))


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise naming every missing column."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError("the input lacks " + ", ".join(absent))


def coerce_ts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Timestamps from text or timestamps; unparseable text becomes null."""
    out = df
    types = dict(df.dtypes)
    for c in cols:
        if types.get(c) == "string":
            out = out.withColumn(c, F.try_to_timestamp(F.col(c)).cast("timestamp_ntz"))
        elif types.get(c) not in ("timestamp_ntz",):
            out = out.withColumn(c, F.col(c).try_cast("timestamp_ntz"))
    return out


# The columns the model input must have.
ML_REQUIRED = [PICKUP, DROPOFF, "passenger_count", "trip_distance", TARGET,
               "PULocationID", "DOLocationID"]


def drop_null_rows(df: DataFrame, cols: Sequence[str] = tuple(ML_REQUIRED)) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna(subset=list(cols))


def ml_rules(max_distance: float = 100.0, max_total: float = 300.0) -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("passenger_count_positive", c("passenger_count") > 0),
        ("trip_distance_positive", c("trip_distance") > 0),
        ("total_amount_positive", c(TARGET) > 0),
        ("pickup_before_dropoff", c(PICKUP) < c(DROPOFF)),
        ("distance_below_max", c("trip_distance") < max_distance),
        ("total_below_max", c(TARGET) < max_total),
    ]


def ml_filter(df: DataFrame, max_distance: float = 100.0, max_total: float = 300.0) -> DataFrame:
    """Coherence filters and outlier trims of the model input (F08), strict."""
    return df.where(all_of(ml_rules(max_distance, max_total)))


def _as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def window_predicate(ts: Column, start=None, end=None) -> Column:
    """Half-open day window: ts >= start and ts < end + 1 day.

    A missing bound means the min (max) of the datetime dimension, which every
    pickup time satisfies, so it adds no predicate.
    """
    cond = F.lit(True)
    if start is not None:
        s = _dt.datetime.combine(_as_date(start), _dt.time())
        cond = cond & (ts >= F.lit(s).cast("timestamp_ntz"))
    if end is not None:
        e = _dt.datetime.combine(_as_date(end) + _dt.timedelta(days=1), _dt.time())
        cond = cond & (ts < F.lit(e).cast("timestamp_ntz"))
    return cond


def date_window(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    return df.where(window_predicate(F.col(ts_col), start, end))
