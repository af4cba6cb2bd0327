"""Session configuration and the shared working folder.

Everything the library writes (targets, staging tables, checkpoints) lives below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent (a local test session) does :func:`shared_dir` create a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the operators rely on for results that match an ANSI SQL oracle.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tableferry",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """A session with the library defaults; used by tests, bench and examples."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings the operators depend on in an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set one only where it is unset."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_CONF, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/tableferry/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage: write ``df`` under the shared checkpoint folder and read it back.

    For small results reused by several downstream plans (the column catalog): the
    profiling job runs once, and a lost executor does not recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
