"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we only
pick one ourselves when it is unset and Spark runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints (numbering, quantile histograms) are written compressed.
    "spark.checkpoint.compress": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "farelake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The ids, weekdays and dates of the reports assume wall-clock UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_base(spark)
    return spark


_LOCAL_BASES: dict[str, str] = {}


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Only when it is unset
    and the master is local do we create one under the system temp folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    app = sc.applicationId
    if app in _LOCAL_BASES:
        return _LOCAL_BASES[app]
    existing = sc.getCheckpointDir()
    if existing:
        base = os.path.dirname(existing.rstrip("/"))
        if base.startswith("file:"):
            base = base[len("file:"):]
        _LOCAL_BASES[app] = base
        return base
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; name a shared folder for checkpoints")
    base = tempfile.mkdtemp(prefix="farelake-")
    sc.setCheckpointDir(os.path.join(base, "checkpoints"))
    _LOCAL_BASES[app] = base
    return base


_RUN_TOKEN = uuid.uuid4().hex[:12]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder, for tables written to cut lineage.

    The shared folder is shared by every job of the cluster, so paths are
    namespaced by application and a per-process token: a run never reads or
    overwrites another run's tables.
    """
    app = spark.sparkContext.applicationId.replace("/", "_")
    return "/".join([checkpoint_base(spark), "farelake", f"{app}-{_RUN_TOKEN}"]
                    + [p.strip("/") for p in parts])
