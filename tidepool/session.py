"""Session construction and the runtime settings every plan relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings (safe to apply to a session someone else built).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pre-merge session windows inside each map task before the shuffle, so
    # a hot key arrives at its reducer as a few partial sessions, not raw rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are planned for."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Session for tests, benchmarks and local runs.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the input
    (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **RUNTIME_CONF,
    }
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, streaming state and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when it is unset on a
    local master (unit tests, a laptop) a private folder is created and
    registered; on a cluster an unset setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach") from None
    root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(checkpoints and streaming state must survive lost executors)")
        root = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job."""
    import uuid

    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidepool/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local disk (tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["configure", "build_session", "checkpoint_root", "scratch_path", "local_path", "RUNTIME_CONF"]
