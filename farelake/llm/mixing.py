"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson number of times. The mean is its
source's target repetition rate; the draw inverts the Poisson distribution at
a uniform number hashed from the document's id and a seed, so a rerun, a
retried task or another partitioning draws the same counts. The copies are
then shuffled globally by sorting on a hashed order key.

Rates above ``CHUNK`` are split into equal parts, each inverted with its own
hash (a sum of Poisson draws is Poisson), so no term underflows.

Results on odd input: a null source is a source of its own; rows without id
are seeded by the md5 of their text; rows that repeat an id draw the same
count, each its own copies; null and empty texts are repeated like others; an
empty table gives an empty result. Input columns named ``mix_copy`` or
``mix_order`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.joins import bounded
from farelake.llm.common import stored

CHUNK = 32.0
#: Terms of the distribution at mean CHUNK: P(X > TERMS) < 1e-13.
TERMS = 96
SOURCES_MAX = 200_000


def hashed_unit(key: Column, *parts) -> Column:
    """A number in (0, 1) from the first 32 bits of an md5 of key and parts."""
    text = F.concat_ws(":", key, *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 32)


def source_rates(spark: SparkSession, docs: DataFrame, targets: DataFrame | None = None,
                 total: int | None = None, tau: float = 0.5, source: str = "source") -> DataFrame:
    """(source, rate): mean copies of each document of a source.

    ``targets`` holds (source, weight); without it weights are n ** tau, which
    flattens the sources. The expected size of the mix is ``total`` rows
    (default: as many as there are documents). Sources without a weight get 0.
    """
    n = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        w = n.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(tau)))
    else:
        t = targets.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        w = n.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"))
    w = stored(spark, w, "mix-weights")
    sums = w.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    size = float(total if total is not None else (sums["n"] or 0))
    scale = size / sums["w"] if sums["w"] else 0.0
    return w.select("source", (F.lit(scale) * F.col("weight") / F.col("n")).alias("rate"))


def poisson_mix(spark: SparkSession, docs: DataFrame, targets: DataFrame | None = None,
                total: int | None = None, tau: float = 0.5, seed: int = 7,
                key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` repeated to the target mix, in global random order.

    Adds ``mix_copy`` (from 1) and ``mix_order`` (the shuffle key).
    """
    rates = source_rates(spark, docs, targets, total, tau, source)
    step = F.greatest(F.ceil(F.col("rate") / CHUNK), F.lit(1)).cast("int")
    first = F.struct(F.exp(-F.col("__llm_r")).alias("p"), F.exp(-F.col("__llm_r")).alias("s"),
                     F.array(F.exp(-F.col("__llm_r"))).alias("cdf"))

    def term(acc, j):
        p = acc["p"] * F.col("__llm_r") / j
        return F.struct(p.alias("p"), (acc["s"] + p).alias("s"),
                        F.concat(acc["cdf"], F.array(acc["s"] + p)).alias("cdf"))

    rates = (rates.withColumn("__llm_parts", step).withColumn("__llm_r", F.col("rate") / F.col("__llm_parts"))
             .withColumn("__llm_cdf", F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, term,
                                             lambda acc: acc["cdf"]))
             .select(F.col("source").alias("__llm_source"), "__llm_parts", "__llm_cdf"))
    docs = docs.drop("mix_copy", "mix_order")
    row_key = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))

    def draws(acc, part):
        u = hashed_unit(F.col("__llm_key"), seed, part.cast("string"))
        return acc + F.size(F.filter("__llm_cdf", lambda c: c <= u))

    joined = docs.withColumn("__llm_key", row_key).join(
        bounded(rates, max_rows=SOURCES_MAX), F.col(source).eqNullSafe(F.col("__llm_source")))
    counted = joined.withColumn("__llm_n", F.aggregate(
        F.sequence(F.lit(1), F.col("__llm_parts")), F.lit(0), draws)).where("__llm_n > 0")
    copies = counted.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_n"))))
    order = F.conv(F.substring(F.md5(F.concat_ws(
        ":", "__llm_key", F.lit(str(seed)), F.lit("order"), F.col("mix_copy").cast("string"))), 1, 15), 16, 10)
    return (copies.withColumn("mix_order", order.cast("long"))
            .select(*docs.columns, "mix_copy", "mix_order").orderBy("mix_order", "mix_copy"))


def mix_sql(docs: str, tau: float = 0.5, seed: int = 7) -> str:
    """DuckDB SQL for ``poisson_mix`` of the relation ``docs`` (rates up to CHUNK)."""
    return f"""
WITH d AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS k FROM ({docs})),
n AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), {tau}) AS w FROM d GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n) / (SELECT sum(w) FROM n) * w / n AS rate FROM n),
u AS (SELECT d.*, rate, (CAST(('0x' || substr(md5(k || ':{seed}:1'), 1, 8)) AS BIGINT) + 0.5)
      / 4294967296.0 AS u FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
p AS (SELECT source, rate, j, exp(-rate) * pow(rate, j) / gamma(j + 1.0) AS p
      FROM r, generate_series(0, {TERMS}) t(j)),
c AS (SELECT source, j, sum(p) OVER (PARTITION BY source ORDER BY j) AS cdf FROM p),
m AS (SELECT source, list(cdf) AS cdf FROM c GROUP BY source),
x AS (SELECT u.*, len(list_filter(m.cdf, lambda v: v <= u.u)) AS n FROM u JOIN m
      ON u.source IS NOT DISTINCT FROM m.source),
e AS (SELECT x.*, CAST(i AS INTEGER) AS mix_copy FROM x, unnest(range(1, x.n + 1)) t(i))
SELECT doc_id, text, lang, source, n_chars, mix_copy,
  CAST(('0x' || substr(md5(k || ':{seed}:order:' || mix_copy), 1, 15)) AS BIGINT) AS mix_order FROM e"""
