"""Session helpers: a local session for tests and benches, and shared scratch paths.

Scratch data (intermediate tables, stream checkpoints, landed test files) is
always placed under the cluster's shared ``spark.checkpoint.dir``.  A private
temporary folder is only created when the session names none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[int, str] = {}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "opsflow",
                  driver_memory: str = "16g") -> SparkSession:
    """Session used by tests and the bench: local mode, AQE on, UTC, no UI."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests on a laptop) a private
    folder is created and registered as the checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        key = id(spark.sparkContext)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="opsflow-ckpt-")
        root = _LOCAL_FALLBACK[key]
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/opsflow/{name}-{uuid.uuid4().hex[:12]}"


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the bytes the job reads.

    Shuffle partitions start high enough that each holds about
    ``target_partition_bytes`` of the input (and at least three waves of the
    cluster's cores); AQE then coalesces small ones to the advisory size and
    splits skewed ones, so partitions fit in executor memory instead of
    spilling.  Scan splits follow the same size.  Broadcasts stay under 64 MB
    and are decided from size statistics only.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
