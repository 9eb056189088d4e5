"""Session construction and cluster settings read from the session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on.  Session time zone is pinned to UTC so a
# day boundary never depends on the machine; all timestamps are NTZ anyway.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what has been measured: no broadcast from planning-time
    # estimates (compressed file sizes can understate a side many times);
    # AQE turns a join into a broadcast join when a side's shuffle output,
    # as written, is under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.ansi.enabled": "true",
    # Streaming counts (one entry per word) live on disk with checkpoints in
    # the shared folder, not in executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # whole-stage method above that runs interpreted.  With the limit at
    # 8000 Spark falls back to per-operator code for such plans, whose
    # expressions are split into small, compiled methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def session_builder(
    master: str | None = None,
    app_name: str = "shoplens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession.Builder:
    """A builder with the settings above; ``hive`` reads the Hive metastore's tables.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset so the
    deployment's own values apply; tests and the bench pass small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.enableHiveSupport() if hive else builder


def build_session(*args, **kwargs) -> SparkSession:
    """The SparkSession of :func:`session_builder` (same parameters)."""
    spark = session_builder(*args, **kwargs).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and we use it as is.  Only when it
    is unset on a local master (tests) do we make a fresh scratch folder and
    record it on the session, so later callers see the same folder; on a
    cluster an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would not survive a lost executor or driver
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="shoplens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
