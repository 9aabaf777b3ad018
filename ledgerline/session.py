"""Session construction for tests and the benchmark, and shared scratch space.

The library itself never creates a session: every function receives
DataFrames (or the caller's session).  ``build_session`` exists for
tests, ``bench.py`` and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerline",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session with the settings the tests and the benchmark assume.

    AQE (coalescing + skew-join splitting) stays on so that a hot join key is
    split at run time; the UI is off (no HTTP server); the session time zone
    is pinned to UTC so that date/hour expressions do not depend on the host.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    for item in filter(None, os.environ.get("LEDGERLINE_SPARK_CONF", "").split(",")):
        key, _, value = item.partition("=")
        builder = builder.config(key.strip(), value.strip())
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is; without it nothing is written (a folder of one machine
    would be incomplete for the others).  Only a local session, as in tests,
    gets a private temporary folder.
    """
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        if not _one_machine(spark.sparkContext.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder.

    Used for intermediate tables (CSV round trips, landed stream batches,
    stream checkpoints) so that every executor can read what another wrote.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
