"""Session helpers: one place that knows about time zone, AQE and shared folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "shelfwise") -> SparkSession:
    """Build (or reuse) a session configured for this library.

    Shuffle partition count is left to the cluster default; AQE coalesces small
    partitions and splits skewed ones at run time, so nothing is hard-coded here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # checkpoints are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, on a session someone else built.

    UTC keeps timestamp parsing and day arithmetic identical on every executor.
    Skew handling stays on: one product, store or batch may hold a third of all rows.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's current
    checkpoint dir); only when neither is set, as in local tests, pick a fresh
    folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for staged feeds, stream checkpoints and result tables written by the
    registered queries, so every executor sees the same path on a cluster.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfwise-work/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_cleaned(spark: SparkSession):
    """Within the block, a query's shuffle files go when it ends, not when the driver next collects garbage."""
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def state_on_disk(spark: SparkSession, counted: bool):
    """A stream that starts within the block keeps its state in RocksDB, whose memory is bounded, unless the session
    names a state store; the default one holds every key on the heap. A checkpoint keeps the store it began with.
    ``counted``: its figures tell the rows held, which costs a lookup a row."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    default = spark.conf.get(provider).endswith(".HDFSBackedStateStoreProvider")
    option = "spark.sql.streaming.stateStore.rocksdb."
    return _set(spark, {provider: rocks, f"{option}boundedMemoryUsage": "true",
                        f"{option}trackTotalNumberOfRows": str(counted).lower()} if default else {})
