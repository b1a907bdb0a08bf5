"""Session settings the operators rely on.

Everything in the package assumes: session time zone UTC (timestamps without an
offset are read as UTC), ANSI mode on (bad casts and divisions raise unless a
``try_`` form is used), and adaptive query execution on (runtime broadcast
conversion, partition coalescing and skew-join splitting).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every session of ours carries. Values are chosen for correctness
# (UTC, ANSI) and for runtime re-planning (AQE); sizes are left to the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Texts differ in length by orders of magnitude; small Arrow batches bound a task's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Extra settings for a single-machine test session only.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints of ranked inputs are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(app: str = "strata", cores: int | str = "*", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {**BASE_CONF, **LOCAL_CONF, **(extra or {})}
    if "spark.checkpoint.dir" not in conf:
        # Tests only: a scratch folder of our own; a cluster names a shared one.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(
            prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster the folder is named by ``spark.checkpoint.dir`` (a shared
    file system) and we only read it. Only when it is unset in a ``local``
    session - as in tests - do we create a fresh scratch folder; on a cluster
    an unset folder is an error, as a machine-local one would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current

