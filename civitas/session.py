"""Session construction and shared-storage scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every civitas job relies on. AQE re-plans joins from measured
# shuffle sizes (so a side is broadcast only when it is proven small at
# run time), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small-in-bytes but CPU-heavy shuffles (JSON parsing, sort-based folds)
    # keep enough tasks to use every core; large shuffles are still sized
    # by the advisory partition size, so this only matters for small data.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a repeated JSON key keeps its last value, as the source's parsers do
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, app: str = "civitas",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local runs, tests) a folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            configured = None
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name shared storage "
                               "(checkpoints and scratch tables are written there)")
        # local runs and tests only: a folder on this machine is the shared storage
        configured = tempfile.mkdtemp(prefix="civitas-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/civitas-{name}-{uuid.uuid4().hex}"
