"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs expect of a cluster session. Shuffle partition count is the upper bound that
# AQE coalesces from, so it is sized for the cluster rather than for the data of one query.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def get_session(app: str = "tradeloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it; it then gets a folder of its own, once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="tradeloom-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_LANDED: dict[tuple[str, str], str] = {}


def landed(spark: SparkSession, name: str, build: Callable[[], DataFrame], per_file: int) -> str:
    """Folder of ``build()``'s rows in files of at most ``per_file`` records, written once per session and name.

    Each task writes the files of its own rows, so landing needs no shuffle, and a table that came as one file
    is read by many tasks from then on. Landed text repeats much, and zstd takes half the bytes of the default.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _LANDED:
        path = scratch(spark, "landed")
        build().write.option("maxRecordsPerFile", per_file).option("compression", "zstd").parquet(path)
        _LANDED[key] = path
    return _LANDED[key]
