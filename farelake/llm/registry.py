"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from farelake.llm import (audit, centroids, decontam, langid, licences, linededup, lm, mixing, neardup, quality, secrets,
                          topk, warc)
from farelake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@register("op1_neardup")
def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(spark, table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@register("op2_lm")
def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(spark, table(spark, sf_dir, "documents"))


@register("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@register("op5_warc", warc.WARC_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(spark, table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, manifest).select(
        F.col("row_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "verified")


@register("op6_licences", licences.licence_sql("SELECT * FROM documents"))
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_matches(spark, table(spark, sf_dir, "documents"))


@register("op7_mixing", mixing.mix_sql("SELECT * FROM documents"))
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(spark, table(spark, sf_dir, "documents"))


@register("op8_linededup", linededup.dedup_sql("SELECT * FROM documents"))
def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@register("op9_decontam", decontam.overlap_sql("SELECT * FROM documents"))
def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_words", "matched")


@register("op10_topk", topk.TOP_K_SQL)
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(50)) == 0)


@register("op11_langid")
def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(spark, table(spark, sf_dir, "documents"))


@register("op12_audit", audit.AUDIT_SQL)
def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op13_centroids", centroids.cluster_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(spark, table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
