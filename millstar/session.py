"""Session construction and the shared scratch location.

The library never builds its own session inside a transformation: callers pass
one in.  ``build_session`` is what tests, the bench and the CLI use.

Scratch data (snapshots written by checks, reliable checkpoints) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only a local
session without one gets a folder under the system temp dir; a cluster session
without one is refused when scratch space is first needed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own size check; ``operators.lookup`` also hints sides it has measured.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = "local[*]", app_name: str = "millstar",
                  shuffle_partitions: int | None = 8,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``master=None`` keeps the submitted one."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark.sparkContext.master):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, creating one only in local mode.

    On a cluster the folder must be one that the driver and all executors share, so
    it is never made up: without ``spark.checkpoint.dir`` this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share "
                               f"(master is {sc.master})")
        configured = tempfile.mkdtemp(prefix="millstar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[...]``)."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/millstar-scratch/{purpose}-{uuid.uuid4().hex}"


# Broadcast sides together may take this part of the driver's heap; a row takes these bytes there beside its columns.
BROADCAST_HEAP_PART = 8
BROADCAST_ROW_BYTES = 48


def broadcast_room(spark: SparkSession) -> int:
    """Bytes of broadcast sides that may be under way at once: the driver collects and builds each before it is sent,
    which takes two to three times the finished side for a while."""
    return spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() // BROADCAST_HEAP_PART


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """``spark.sql.shuffle.partitions`` as an int (falls back when not numeric)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", str(default))
    return int(value) if str(value).isdigit() else default
