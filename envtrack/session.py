"""Session and shared-state helpers.

Everything that must survive an executor loss (stream checkpoints, lineage cuts, load state) lives
under the shared folder named by ``spark.checkpoint.dir``. We only invent a folder when the session
does not name one, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


def build_session(master: str = "local[*]", app: str = "envtrack", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way the library expects (UTC, AQE on, no UI)."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and state.

    Reads ``spark.checkpoint.dir`` from the session. When only an RDD checkpoint folder was set on
    the context, that one is used. When neither is set, a session on one machine (tests) gets a scratch
    folder, once per process; any other session is refused, as its executors could not see that folder.
    """
    global _LOCAL_FALLBACK
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context_dir = spark.sparkContext.getCheckpointDir()
    if context_dir and _LOCAL_FALLBACK is None:
        return context_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_FALLBACK is None:
        _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="envtrack-state-")
        spark.sparkContext.setCheckpointDir(os.path.join(_LOCAL_FALLBACK, "rdd"))
    return _LOCAL_FALLBACK


def state_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared state folder."""
    return "/".join([shared_dir(spark), *parts])
