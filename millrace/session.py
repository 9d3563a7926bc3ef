"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State that outgrows memory, and only its changes written at each commit; the rows of a
# busy session are merged in each input partition before the shuffle.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
# Counting the rows of the store looks every key up before it is written; a job that wants ``numRowsTotal`` turns it on.
UNCOUNTED_STATE = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE_STORE,
        "spark.python.unix.domain.socket.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, count_rows: bool = False) -> Iterator[None]:
    """Settings for starting a stateful query, put back afterwards.

    The number of state partitions is fixed for the life of a checkpoint: give as many as the cluster the job may
    grow to has cores.  By default it is one per core of now, at most the shuffle partitions, since each one costs a commit
    in every micro-batch.  ``count_rows`` has the store count its rows for the query progress.
    """
    if partitions is None:
        cores = spark.sparkContext.defaultParallelism
        partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)
    settings = {**STATE_STORE, **({} if count_rows else UNCOUNTED_STATE), "spark.sql.shuffle.partitions": str(partitions)}
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    That setting names storage every executor can reach.  Where it is unset, a local
    temporary folder stands in for it on a single machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to storage that every executor can reach")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
