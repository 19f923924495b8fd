"""Spark session helpers.

The library never creates its own cluster settings in production: ``get_session``
only fills settings that are unset, so a cluster's own values (shuffle partitions,
checkpoint folder, AQE) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. They are applied only when the session has no value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # what a batch caches has as many partitions as its size asks for, not one for each shuffle partition
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app_name: str = "assetlens", **conf) -> SparkSession:
    """Return the active session, or build a local one for tests and benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in DEFAULTS.items():
            if active.conf.get(k, None) is None:
                active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(os.cpu_count() or 8),
        **DEFAULTS,
        **conf,
    }
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """True where driver and executors are one process (``local``, ``local[N]``), not for ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to a shared file system; only in local mode, where one process does all the work,
    a private temporary folder stands in for it.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="assetlens-ckpt-")  # local mode only
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments reject runtime core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for tables a job writes for itself."""
    return f"{checkpoint_dir(spark)}/{name}"
