"""SparkSession defaults for the engine.

Everything here is configuration a Spark user would set: UTC session zone,
adaptive execution with skew handling, the RocksDB state store for streaming,
and a shared checkpoint folder taken from ``spark.checkpoint.dir`` when the
cluster provides one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Raise the row_number limit that Catalyst turns into a WindowGroupLimit so caps
# up to this size are cut per map task before the shuffle.
WINDOW_GROUP_LIMIT = 100_000

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": str(WINDOW_GROUP_LIMIT),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (not applied here; pass them as ``extra`` or in the
# launcher).  Sizes are per task: shuffle partitions so that a partition is
# ~128-256 MB after map-side aggregation (AQE coalesces small ones), input splits
# of 256 MB, and a higher AQE skew threshold than the local default.
CLUSTER_HINTS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str = "local[*]", app: str = "eventide",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster, pass ``master=None`` so the launcher's master is used.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) a fresh scratch folder is created and registered.  A cluster
    without the setting is refused: a folder of the driver's machine is not shared.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
    return d


def ensure_engine_conf(spark: SparkSession) -> None:
    """Apply the settings that change answers or plans of our operators to a
    session built elsewhere (for example by a job launcher)."""
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(WINDOW_GROUP_LIMIT))
