"""Model input: checks, filters, time features, split, imputation, ordinal
codes, quality assertions (F05-F08, M01-M07, M13).

Everything is a DataFrame transformation; fitted values (medians, modes,
dictionaries) are small DataFrames or scalars learned on the training part.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions.rules import (DROPOFF, ML_REQUIRED, PICKUP, TARGET, coerce_ts,
                                      drop_null_rows, ml_filter, require_columns)
from farelake.functions.select import hash60, kth_smallest
from farelake.functions.stats import exact_quantiles_long
from farelake.operators.keys import dense_keys
from farelake.session import scratch_path
from farelake.sources.lake import remove

# The feature lists of the model.
NUMERIC_CANDIDATES = ["passenger_count", "trip_distance", "pickup_hour", "pickup_dayofweek",
                      "pickup_month"]
CATEGORICAL_CANDIDATES = ["VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID"]
NULL_TEXT = "None"          # text of a missing category
UNKNOWN_CODE = -1           # code of a category not seen in training
DICT_BROADCAST_MAX_ROWS = 1_000_000


def time_features(df: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Hour, weekday with Monday = 0, month of the pickup."""
    return (df.withColumn("pickup_hour", F.hour(ts).cast("int"))
              .withColumn("pickup_dayofweek", F.weekday(ts).cast("int"))
              .withColumn("pickup_month", F.month(ts).cast("int")))


def category_text(c: Column) -> Column:
    """Category as text: integral ids without a decimal part, null as ``None``;
    text that is not a number is kept."""
    return F.coalesce(c.try_cast("bigint").cast("string"), c.cast("string"), F.lit(NULL_TEXT))


def feature_columns(d: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """The feature columns and the target of checked rows, plus ``keep``.

    Fare, tip and extra are left out: they are parts of the target.
    """
    d = time_features(d)
    numeric = [c for c in NUMERIC_CANDIDATES if c in d.columns]
    categorical = [c for c in CATEGORICAL_CANDIDATES if c in d.columns]
    spec = {"numeric_cols": numeric, "categorical_cols": categorical,
            "feature_cols": numeric + categorical, "target": TARGET}
    return d.select(*[F.col(c).cast("double").alias(c) for c in numeric],
                    *[category_text(F.col(c)).alias(c) for c in categorical],
                    F.col(TARGET).cast("double").alias(TARGET), *keep), spec


def checked_rows(df: DataFrame) -> DataFrame:
    """Rows fit for the model: required columns, times, no nulls, in range."""
    require_columns(df, ML_REQUIRED)
    return ml_filter(drop_null_rows(coerce_ts(df, [PICKUP, DROPOFF])))


def feature_matrix(df: DataFrame) -> tuple[DataFrame, dict]:
    return feature_columns(checked_rows(df))


# What a row's split depends on: the raw columns that the model rows are made of.
SPLIT_COLUMNS = [PICKUP, DROPOFF, "passenger_count", "trip_distance", TARGET, *CATEGORICAL_CANDIDATES]


def split_hash(df: DataFrame, seed: int = 42) -> Column:
    """60 bits of an md5 of the row's content and the seed: times in seconds,
    amounts in hundredths, ids whole. It does not depend on partitioning or
    file order, and any SQL engine computes the same."""
    def part(c: str) -> Column:
        if c in (PICKUP, DROPOFF):
            return F.unix_seconds(F.col(c).cast("timestamp"))
        if c in ("trip_distance", TARGET):
            return F.round(F.col(c) * 100).cast("bigint")
        return F.col(c).cast("bigint")

    return hash60(F.lit(seed), *[part(c) for c in SPLIT_COLUMNS if c in df.columns])


def with_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: the ceil(test_size x rows) rows with the smallest content
    hashes are ``test``, the others ``train`` (M04); needs the raw columns.

    The cut is found by a radix histogram of the hash and applied as one
    filter; nothing is sorted. The hashes alone are written first: the rows are
    read and hashed once for the count and every pass of the histogram. Rows that tie at the cut are identical in all
    that the hash covers; they alone are numbered, to take as many as are due.
    """
    hashed, spark = df.withColumn("_h", split_hash(df, seed)), df.sparkSession
    path = scratch_path(spark, "split", uuid.uuid4().hex)
    hashed.select("_h").write.parquet(path)
    try:
        hashes = spark.read.schema("_h bigint").parquet(path)
        k = math.ceil(round(test_size * hashes.count(), 9))
        if k <= 0:
            return df.withColumn("split", F.lit("train"))
        cut, below, equal = kth_smallest(hashes, "_h", k)
    finally:
        remove(spark, path)
    due = k - below
    if due == equal:
        return hashed.withColumn("split", F.when(F.col("_h") <= cut, "test").otherwise("train")).drop("_h")
    ties = dense_keys(hashed.where(F.col("_h") == cut), df.columns, "_k")
    ties = ties.withColumn("split", F.when(F.col("_k") <= due, "test").otherwise("train"))
    rest = hashed.where(F.col("_h") != cut).withColumn("split", F.when(F.col("_h") < cut, "test").otherwise("train"))
    return rest.select(*df.columns, "split").unionByName(ties.select(*df.columns, "split"))


def model_rows(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, dict]:
    """Feature matrix plus the split label."""
    return feature_columns(with_split(checked_rows(df), test_size, seed), ["split"])


def fit_median(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of each column on the training rows (M05): (column, median)."""
    return exact_quantiles_long(train, cols, [0.5], ["median"])


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.fillna({c: float(v) for c, v in medians.items() if v is not None})


def _value_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, v): every non-null value of the columns as text, in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                for c in cols])).alias("p")
    return df.select(pairs).select("p.column", "p.v").where(F.col("v").isNotNull())


def fit_mode(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value of each column; ties go to the smallest value.

    One scan for all columns: (column, value) counts are combined map-side,
    then each column keeps its top value."""
    counts = _value_pairs(train, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))
    # One row per column, null for a column without values.
    names = train.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(modes, "column", "left")


def impute_mode(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.fillna({c: v for c, v in modes.items() if v is not None})


def fit_ordinal(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, the sorted distinct training values with codes 0..k-1 (M07):
    (column, value, code). One scan and one range-partitioned numbering for
    all columns; codes restart per column, never numbered in one task."""
    vals = _value_pairs(train, cols).select("column", F.col("v").alias("value")).distinct()
    return dense_keys(vals, ["value"], "code", offset=-1, key_type="int", group_cols=["column"]
                      ).select("column", "value", "code")


def encode(df: DataFrame, dictionary: DataFrame, cols: Sequence[str],
           max_rows: int = DICT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Replace each category by its code; unseen (or null) gives -1.

    The dictionary is broadcast after a checked count, else joined by shuffle.
    """
    small = dictionary.count() <= max_rows
    out = df
    for c in cols:
        d = dictionary.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                          F.col("code").alias(f"_k_{c}"))
        d = F.broadcast(d) if small else d
        out = (out.join(d, out[c].cast("string") == F.col(f"_v_{c}"), "left")
                  .withColumn(c, F.coalesce(F.col(f"_k_{c}"), F.lit(UNKNOWN_CODE)).cast("double"))
                  .drop(f"_v_{c}", f"_k_{c}"))
    return out


def feature_quality(X: DataFrame, spec: dict) -> DataFrame:
    """The data checks of the model input as one row of booleans."""
    feats = spec["feature_cols"]
    any_null = F.lit(False)
    for c in feats:
        any_null = any_null | F.col(c).isNull()
    return X.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bool_and(F.col(TARGET) > 0), F.lit(True)).alias("target_positive"),
        F.coalesce(F.bool_and(~any_null), F.lit(True)).alias("no_missing_features"),
        F.coalesce(F.bool_and(F.col("trip_distance") > 0), F.lit(True)).alias("distance_positive"))
