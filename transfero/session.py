"""Session helpers: building a local session for tests/bench and locating the checkpoint folder.

On a cluster the session is built by whoever submits the job; the library only reads its settings.
The one setting it depends on is the checkpoint folder (``spark.checkpoint.dir``), which must be a
shared, reliable location (HDFS/S3/ABFS) because numbering pins its input there so that every
executor, and every retried task, sees the same slices.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT = "/tmp"

#: Shuffled bytes that adaptive execution joins for one task, where the caller has set no size.
TASK_BYTES = "16m"


def build_local_session(cores: int | str = "*", app: str = "transfero",
                        shuffle_partitions: int = 8, event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the local bench. Cluster jobs bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session.

    Order: the folder already set on the SparkContext, then ``spark.checkpoint.dir`` from the
    session configuration. Only when neither is set and the master is local (tests, local bench)
    is a fresh private folder under /tmp created; on a cluster an unset folder is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="transfero-ckpt-", dir=_LOCAL_CHECKPOINT_ROOT)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def process_session(spark: SparkSession) -> SparkSession:
    """A session on the same context, with the caller's settings, whose joins may use a partitioning by some of their keys.

    Tables of a tender meet by its number first; rows that lie by it are then not moved again for a join that also
    names year, kind, lot or item. The caller's own session keeps its setting.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # Narrow keys compress well: 64 MB of them, Spark's own size, take gigabytes in a task's hash tables and sorts.
    if (size := "spark.sql.adaptive.advisoryPartitionSizeInBytes") not in spark.conf.getAll:
        own.conf.set(size, TASK_BYTES)
    return own


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a write removes its shuffle files as soon as it has ended; what it wrote is read from then on. Otherwise the
    files of every step lie on the executors' disks until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_planning: ContextVar[bool] = ContextVar("planning", default=False)


@contextmanager
def scratch_owner(paths: list[str]) -> Iterator[None]:
    """Scratch tables taken inside are added to ``paths``, so that their owner can remove them."""
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (owned := _scratch.get()) is not None:
        owned.append(path)
    return path


@contextmanager
def planning() -> Iterator[None]:
    """Inside, steps are built without running any job: what they would write at once is left out."""
    token = _planning.set(True)
    try:
        yield
    finally:
        _planning.reset(token)


def is_planning() -> bool:
    return _planning.get()


def sf_dir_default() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
