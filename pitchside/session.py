"""SparkSession construction and the shared scratch location.

Everything that must outlive one task (materialised bronze, lineage cuts) goes under the folder the
cluster names in ``spark.checkpoint.dir``. We only pick our own folder when that setting is unset
and the session runs in local mode (tests, laptops); on a cluster an unset value is an error, since a
machine-local temp folder is not visible to other executors.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings the pipeline relies on: UTC wall clock for bronze timestamps (the reference writes
# UTC), AQE for runtime join selection / skew splitting / partition coalescing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "pitchside", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediate data (``spark.checkpoint.dir``)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="pitchside-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def ensure_utc(spark: SparkSession) -> None:
    """Bronze timestamps are UTC instants; pin the session clock the first time we touch data."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
