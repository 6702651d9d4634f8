"""Total-amount regression on Spark ML.

Preprocessing is learned on the training part: exact medians for numeric
columns, modes and ordinal dictionaries for categories. Codes enter the
learner as plain numbers (no nominal metadata), as the reference feeds them,
with enough bins for every id. Hyperparameters default to the reference's.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.rules import TARGET
from farelake.operators import features as FE

# The reference's learner settings.
MAX_DEPTH = 8
LEARNING_RATE = 0.08
ROUNDS = 300
SEED = 42
MAX_BINS = 256


@dataclass
class FareModel:
    spec: dict
    medians: dict
    modes: dict
    dictionary: DataFrame
    pipeline: PipelineModel
    rmse: float | None = None
    rounds: int | None = None     # boosting rounds of the fitted model


def rmse(df: DataFrame, y: str = TARGET, p: str = "prediction") -> DataFrame:
    """sqrt(mean((y - p)^2)) as one row."""
    return df.agg(F.round(F.sqrt(F.avg((F.col(y) - F.col(p)) ** 2)), 6).alias("rmse"),
                  F.count(F.lit(1)).alias("rows"))


def prepare(df: DataFrame, m: "FareModel | dict", medians=None, modes=None, dictionary=None) -> DataFrame:
    if isinstance(m, FareModel):
        spec, medians, modes, dictionary = m.spec, m.medians, m.modes, m.dictionary
    else:
        spec = m
    d = FE.impute_median(df, medians)
    d = FE.impute_mode(d, modes)
    return FE.encode(d, dictionary, spec["categorical_cols"])


# Rows of a partition of the training data: a round is a job per tree level, so small data gets few tasks.
ROWS_PER_TASK = 50_000
# The learner keeps its rows unpacked (about 200 bytes each) and a task reads a whole partition; every
# partition also sends its histograms at every level, so partitions are no smaller than they must be.
MOST_ROWS_PER_TASK = 2_000_000


def dealt(X: DataFrame, merge: bool = True, rows_per_task: int = ROWS_PER_TASK, most: int = MOST_ROWS_PER_TASK
          ) -> DataFrame:
    """Training rows in partitions of a bounded number of rows: one per core, or
    as many as ``most`` asks for. Small data is left as it is, or with ``merge``
    put into fewer partitions. A scan deals by compressed bytes, of which a
    training row has few."""
    n, cores = X.count(), X.sparkSession.sparkContext.defaultParallelism
    if -(-n // rows_per_task) < cores:
        return X.coalesce(-(-n // rows_per_task) or 1) if merge else X
    return X.repartition(max(cores, -(-n // most)))


def train(rows: DataFrame, spec: dict, max_depth: int = MAX_DEPTH, step: float = LEARNING_RATE,
          rounds: int = ROUNDS, seed: int = SEED, max_bins: int = MAX_BINS,
          validation: float | None = None, tol: float = 0.0005) -> FareModel:
    """Fit preprocessing and boosting on ``split = 'train'`` rows.

    With ``validation``, that share of the training rows (by row hash) is held
    out of the trees, and boosting stops after the round that no longer lowers
    its squared error by ``tol`` of it; ``rounds`` is then the most there can
    be. Node ids are kept between levels and checkpointed, so the lineage of
    many rounds stays short.
    """
    tr = rows.where(F.col("split") == "train")
    medians = {r["column"]: r["median"] for r in FE.fit_median(tr, spec["numeric_cols"]).collect()}
    modes = {r["column"]: r["mode"] for r in FE.fit_mode(tr, spec["categorical_cols"]).collect()}
    dictionary = FE.fit_ordinal(FE.impute_mode(tr, modes), spec["categorical_cols"])
    X = prepare(tr, spec, medians, modes, dictionary)
    assembler = VectorAssembler(inputCols=spec["feature_cols"], outputCol="features",
                                handleInvalid="keep")
    more = {}
    if validation:
        held = F.pmod(F.xxhash64(F.lit(seed), *spec["feature_cols"], TARGET), F.lit(1000)) < round(1000 * validation)
        X = X.withColumn("_held", held)
        more = {"validationIndicatorCol": "_held", "validationTol": tol, "cacheNodeIds": True, "checkpointInterval": 10}
    X = dealt(X, merge=bool(validation))
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, maxDepth=max_depth, stepSize=step,
                       maxIter=rounds, seed=seed, maxBins=max_bins, **more)
    pipe = Pipeline(stages=[assembler, gbt]).fit(X)
    return FareModel(spec, medians, modes, dictionary, pipe, rounds=pipe.stages[-1].getNumTrees)


def score(m: FareModel, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Predictions for any rows (M10). Missing feature columns are added as
    null; numeric nulls take the training median; a missing category is the
    text ``None`` and encodes to -1 when training never saw it."""
    d = df
    for c in m.spec["numeric_cols"]:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("double"))
        else:
            d = d.withColumn(c, F.col(c).cast("double"))
    for c in m.spec["categorical_cols"]:
        src = F.col(c) if c in d.columns else F.lit(None)
        d = d.withColumn(c, FE.category_text(src))
    X = prepare(d, m)
    out = m.pipeline.transform(X)
    return out.select(*keep, *m.spec["feature_cols"], F.round("prediction", 6).alias("prediction"))


def evaluate(m: FareModel, rows: DataFrame) -> float:
    pred = score(m, rows.where(F.col("split") == "test"), keep=(TARGET,))
    return RegressionEvaluator(labelCol=TARGET, predictionCol="prediction",
                               metricName="rmse").evaluate(pred)


def scenarios(spark: SparkSession, spec: dict, overrides: dict[str, dict]) -> DataFrame:
    """What-if rows (M11): a base record of zeros with some features overridden,
    one row per named scenario, as (scenario, features...)."""
    cols = spec["feature_cols"]
    rows = [(name, *[float(o[c]) if c in spec["numeric_cols"] and c in o else str(o[c]) if c in o
                     else 0.0 if c in spec["numeric_cols"] else "0" for c in cols])
            for name, o in sorted(overrides.items())]
    types = ", ".join(f"{c} {'double' if c in spec['numeric_cols'] else 'string'}" for c in cols)
    return spark.createDataFrame(rows, f"scenario string, {types}")


def scenario_grid(base: DataFrame, overrides: dict) -> DataFrame:
    """Given rows with some features overridden."""
    return base.withColumns({k: F.lit(v) for k, v in overrides.items()})


def save(m: FareModel, path: str, spark: SparkSession) -> None:
    """Model, dictionaries and a one-row JSON spec with the metric."""
    m.pipeline.write().overwrite().save(f"{path}/pipeline")
    m.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    payload = dict(m.spec, rmse=m.rmse, medians=m.medians, modes=m.modes, rounds=m.rounds)
    spark.createDataFrame([(json.dumps(payload),)], "spec string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/feature_spec")


def load(path: str, spark: SparkSession) -> FareModel:
    payload = json.loads(spark.read.text(f"{path}/feature_spec").first()[0])
    spec = {k: payload[k] for k in ("numeric_cols", "categorical_cols", "feature_cols", "target")}
    return FareModel(spec, payload["medians"], payload["modes"],
                     spark.read.parquet(f"{path}/dictionary"),
                     PipelineModel.load(f"{path}/pipeline"), payload.get("rmse"), payload.get("rounds"))
