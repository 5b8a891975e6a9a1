"""Session helpers: local sessions for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What we recommend to a cluster session. AQE does the runtime work the
# operators count on: splitting hot join partitions, splitting hot write
# partitions after a REBALANCE hint, and coalescing small ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "tidemark", cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session with the recommended settings, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * 2**20) -> int:
    """Set the number of shuffle partitions for a job over ``input_bytes`` of data.

    AQE merges partitions that turn out small but makes no new ones, so the
    start must be high enough for a partition to fit a task's memory.
    """
    n = max(spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    It is the folder named by ``spark.checkpoint.dir``. Only a local session
    may do without it: a machine-local folder is no use to remote executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the scratch folder, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
