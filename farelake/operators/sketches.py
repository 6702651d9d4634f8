"""Mergeable quantile sketches of the measures, kept per month file.

Exact quartiles of the whole fact shuffle all its distinct values
(``functions.stats``). Beside them each load keeps a KLL sketch of every
measure of its month files: a few kilobytes that are built in one scan, merged
with those of other months, and replaced with the month. ``quantiles`` merges
the sketches and reads no fact.

The rank of a quantile that a merged sketch gives is within ``rank_error(K)``
of the asked one with a probability of 99 % (single value; the bound published
for this family of sketches, as an empirical fit in K). ``checked_quantiles``
puts the exact ranks of the sketch's answers beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 800
MEASURES = ("trip_distance", "total_amount", "tip_amount", "passenger_count")
SKETCHES = T.StructType([T.StructField("measure", T.StringType()), T.StructField("n", T.LongType()),
                         T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
                         T.StructField("sketch", T.BinaryType()), T.StructField("source_file", T.StringType())])


def rank_error(k: int = K) -> float:
    """Normalised rank error of one quantile at 99 % confidence (fixed values: the published fit)."""
    return 2.296 / k ** 0.9021


def _values(facts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(measure, x) of the facts with distance and total present, from one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x"))
                                for m in measures])).alias("p")
    keep = F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull()
    return facts.where(keep).select("source_file", pairs).select("source_file", "p.*").where("x IS NOT NULL")


def sketches(facts: DataFrame, measures: Sequence[str] = MEASURES, k: int = K) -> DataFrame:
    """One row per month file and measure: count, bounds and sketch. One group per
    month file holds all measures, so tasks keep few sketches at a time."""
    rows = facts.where(F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull())
    aggs = []
    for m in measures:
        x = F.col(m).cast("double")
        aggs += [F.count(x).alias(f"n_{m}"), F.min(x).alias(f"low_{m}"), F.max(x).alias(f"high_{m}"),
                 F.kll_sketch_agg_double(x, k).alias(f"sketch_{m}")]
    wide = rows.groupBy("source_file").agg(*aggs)
    return wide.select("source_file", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), *[F.col(f"{c}_{m}").alias(c) for c in ("n", "low", "high", "sketch")])
        for m in measures]))).where("n > 0").select(*SKETCHES.fieldNames())


def quantiles(kept: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), k: int = K) -> DataFrame:
    """Per measure: count, bounds, and the asked quantiles of the merged sketches."""
    merged = kept.groupBy("measure").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                                         F.kll_merge_agg_double("sketch", k).alias("sketch"))
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    named: list[Column] = [at[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)]
    return merged.select("measure", "n", "low", "high", *named)


def checked_quantiles(facts: DataFrame, kept: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), k: int = K
                      ) -> DataFrame:
    """(measure, p, n, value, rank_low, rank_high, within): the sketch's answers with their exact ranks.

    The ranks come from one scan of the facts; the answers (a few rows) are broadcast.
    ``within``: the asked rank lies at most ``rank_error`` outside the value's exact ranks.
    """
    q = quantiles(kept, probs, k)
    asked = q.select("measure", "n", F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.col(f"p{round(p * 100):02d}").alias("value")) for p in probs])))
    measures = [m for m in MEASURES]
    x = _values(facts, measures).join(F.broadcast(asked), "measure")   # measures x probs rows
    ranks = x.groupBy("measure", "p", "n", "value").agg(
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto"))
    e = rank_error(k)
    return ranks.select("measure", "p", "n", "value", (F.col("below") / F.col("n")).alias("rank_low"),
                        (F.col("upto") / F.col("n")).alias("rank_high"),
                        ((F.col("below") / F.col("n") - e <= F.col("p")) & (F.col("upto") / F.col("n") + e >= F.col("p")))
                        .alias("within"))
