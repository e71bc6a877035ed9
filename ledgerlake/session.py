"""Session construction and the shared working folder.

Jobs that must cut lineage or persist intermediate state (streaming
checkpoints, versioned upsert targets) write under the folder that the
cluster names in ``spark.checkpoint.dir``. We only choose one ourselves when
the session has none, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what was measured: no static broadcast from plan estimates
    # (they can be far off for aggregates), AQE converts a join at run time
    # when a side's shuffle output is measured below the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpointed frames (lag_split) are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    # streaming state (ST3 keys, ST7 per-transaction status) lives off-heap in RocksDB,
    # committed as change logs: state of millions of transactions per executor
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    The operators assume a UTC session time zone: the reference stores
    ``TIMESTAMP WITH TIME ZONE`` in a UTC database, and batch outputs are
    presented as UTC wall-clock ``timestamp_ntz``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or an already set SparkContext
    checkpoint dir). Only a local session without either gets a private folder
    of its own; on a cluster a machine-local folder would lose data, so there
    the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of :func:`checkpoint_root` for one job run.

    Writers create it. It is deleted when the application ends: results may
    be read from it until then.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Partitioned writes meanwhile keep up to ``n`` files open a task instead of sorting their rows by folder.

    A task that meets more folders sorts the rest, as Spark always does by default.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
