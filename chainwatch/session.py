"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "chainwatch") -> SparkSession:
    """Session for tests and the local benchmark.  On a cluster, build the
    session from the cluster's own defaults instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    It is read from the session; only when it is unset and the master is local
    (as in tests) is a folder under the system temp directory chosen and
    registered.  On a cluster an unset folder is an error."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="chainwatch-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path inside the shared folder (never a machine-local temp dir
    when the cluster names one)."""
    base = shared_dir(spark)
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
    path = f"{base}/chainwatch/{leaf}"
    if "://" not in path or path.startswith("file:"):
        local = path[5:] if path.startswith("file:") else path
        os.makedirs(os.path.dirname(local.rstrip("/")) or "/", exist_ok=True)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the shared checkpoint folder (cuts the
    lineage; survives the loss of any executor).  Used for the tables of hot keys
    and of the splitters that fix their slices; Spark removes the files with the session if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is
    set."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def recommended_conf(input_bytes: int, *, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run: shuffle partitions sized so each
    holds about ``partition_bytes`` of input, AQE with skew handling, and
    scan splits of the same size."""
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
