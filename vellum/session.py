"""Session helpers: a local test session and the shared working folder.

Library code never creates a session on import; operators receive DataFrames.
Only tests, ``bench.py`` and the driver entry build one through ``local_session``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def cluster_conf(executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for a large cluster (about 100 TB of input).

    * shuffle partitions: about 3 waves of tasks; AQE coalesces small ones
      and splits skewed ones (advisory 256 MiB), so the number is an upper bound;
    * file splits of 256 MiB for Parquet scans (one task reads one split);
    * Arrow batches of 2,048 rows: the numpy scoring block and the text UDFs
      hold one batch at a time (memory per Python worker stays small);
    * broadcast joins only under 64 MiB of measured size (AQE decides at run
      time); the search kernel has its own, explicit 32 MiB check;
    * ``spark.checkpoint.dir`` must be set by the deployment to shared storage.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(3 * slots),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", app: str = "vellum") -> SparkSession:
    """A local session with the cluster profile scaled down (UI off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in cluster_conf(1, 8).items():
        b = b.config(k, v)
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 << 20))
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage; it is only filled in
    here for a local session (tests, local bench) where it is missing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="vellum-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (for stores and cut lineage)."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
