"""Session settings and the shared scratch area of a job."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of long texts or sets: a batch for Python is bounded by bytes, not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def build_session(app: str = "broadloom", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the operators expect.

    ``master`` stays unset on a cluster, where spark-submit names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created, where it has none of its own."""
    context = spark.sparkContext
    chosen = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in chosen:
            spark.conf.set(key, value)
    if context.master.startswith("local") and "spark.sql.shuffle.partitions" not in chosen:
        # One machine: Spark's cluster default would open 200 state stores per stream.
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    # Python workers find this package wherever the driver found it.
    context.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a
    cluster a missing setting is an error, never a machine-local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="broadloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; two calls never collide."""
    return f"{shared_root(spark)}/broadloom/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to reliable storage."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the files.

    For intermediate results several later steps read; the files outlive lost
    executors and keep column pruning.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
