"""The corpus pipeline: documents to a clean, mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
what a stage returns to the shared folder as Parquet, and the next stage reads
it back, so no stage's lineage reaches into another's; what the stage before
wrote is then removed.

1. quality: documents that the classifier rejects go.
2. line_dedup: later repeats of runs of lines are cut out of the texts; a
   document stays even if its text becomes empty. ``n_chars`` follows the text.
3. near_dedup: one document of each near-duplicate class stays.
4. decontaminate: documents that overlap a benchmark item go.
5. mix: documents are repeated towards the target mix and shuffled; adds
   ``mix_copy`` and ``mix_order``.

All stages but the last return the columns of ``documents`` (further columns
of the input are kept). Null and empty texts, repeated rows and empty tables
are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import discard, stored, table
from farelake.llm.decontam import decontaminate
from farelake.llm.linededup import dedup_lines
from farelake.llm.mixing import poisson_mix
from farelake.llm.neardup import keep_one
from farelake.llm.quality import keep_good


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs, counts=False).select(*[
        F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(spark, docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson_mix(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
]

# The classifier and the near-duplicate classes have no SQL form; the tests hold the
# pipeline against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        after: list[str] = []
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}", after)
        discard(spark, before)
        before = after
    return docs
