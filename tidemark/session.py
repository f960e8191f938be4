"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the local bench. Cluster jobs use the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staging tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the cluster
    names one; only when nothing is set (local tests) a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set anywhere
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS/S3/...): checkpoints, staging "
                "tables and stream state must survive the loss of any one machine"
            )
        conf_dir = tempfile.mkdtemp(prefix="tidemark-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for a staging table under the shared checkpoint folder.

    The application's staging folder is deleted when it ends: results may read it until then."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-staging"  # the context's own checkpoint folder
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def stream_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """(sink path, checkpoint location) for one streaming query run."""
    root = staging_path(spark, f"stream-{name}")
    return os.path.join(root, "sink"), os.path.join(root, "checkpoint")


def cluster_conf(
    input_tb: float = 100.0, partition_mb: int = 256, shuffle_fraction: float = 0.2, max_partitions: int = 100_000
) -> dict[str, str]:
    """Suggested session settings for a large cluster (pass to ``SparkSession.builder.config``).

    Shuffle partitions are sized so a partition of the largest shuffle (``shuffle_fraction``
    of the input after pruning and map-side combining) is about ``partition_mb`` before AQE
    coalesces small ones, capped to keep map-status bookkeeping on the driver reasonable; skew
    join and coalescing stay on; broadcasts are limited to small sides; large streaming state
    goes to RocksDB. ``spark.checkpoint.dir`` must name a shared folder and is left to the cluster.
    """
    wanted = int(input_tb * shuffle_fraction * 1024 * 1024 / partition_mb)
    shuffle_partitions = min(max(200, wanted), max_partitions)
    size = f"{partition_mb}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.sources.bucketing.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
