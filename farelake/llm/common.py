"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import scratch_path
from farelake.sources.lake import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """``df`` written to a fresh folder of the shared scratch space and read back.

    Cuts the lineage with files that every executor can read again. The folder
    is added to ``scratch``, for ``discard`` once nothing reads it any more.
    """
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Remove stored tables."""
    for path in scratch:
        remove(spark, path)
    scratch.clear()


def text_hash(col: str | Column = "text") -> Column:
    """64-bit hash of a text; with doc_id it names a row. Null and '' differ."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(c))


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; a null id hashes as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))
