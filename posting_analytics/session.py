"""Session helpers.

Library code never creates a session; it uses the caller's.  ``local_session``
is for tests and scripts only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "posting_analytics",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session configured for tests and benchmarks."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is.  Only a local
    session without the setting (a bare test session) gets a scratch folder;
    elsewhere a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="pa-ckpt-")  # local test session only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/pa-{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, partition_bytes: str = "256m") -> dict[str, str]:
    """Starting settings for a large run (apply them to the session builder).

    Shuffle partitions start at three per core and AQE coalesces them to
    ``advisoryPartitionSizeInBytes``; skewed shuffle partitions are split.
    Scan splits of ``partition_bytes`` keep a page partition's HTML well inside
    executor memory.  Automatic broadcast stays at Spark's small default: the
    library broadcasts explicitly only where the size is bounded.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(200, 3 * int(total_cores))),
        "spark.sql.files.maxPartitionBytes": partition_bytes,
        "spark.sql.parquet.filterPushdown": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
