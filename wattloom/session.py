"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job wants, whatever the size of the cluster. Sizes (memory, cores, shuffle
# partitions) belong to the submit command and are not set here.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, whatever store the session has: Spark's own default has no room for the states
    and timers of a processor. A stream takes its settings when it starts, so the session's come back at once."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_fallback()


@cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="wattloom-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
