"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import contextlib
import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "revlens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings these jobs rely on. Master, memory and shuffle
    partitions stay what spark-submit or the Spark defaults say, unless given here
    (``local[N]`` for tests and the bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    event_dir = os.environ.get("REVLENS_EVENT_LOG")
    if event_dir:
        # stage and task times from Spark's event log (no UI server)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is only read.
    When it is unset (a local test run) a fresh local folder is created and
    registered, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    configured = (sc.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        # register once per context (each registration creates a new sub-folder)
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="revlens-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint location for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_STAGES: dict[tuple, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def input_stamp(spark: SparkSession, path: str) -> str:
    """Fingerprint of the files under ``path`` (name, size, modification time): a memo
    keyed by it notices changed input."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, seen = fs.listFiles(root, True), []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def materialize(df, name: str, memo: tuple | None = None, partition_by=None):
    """Write ``df`` as a parquet table under the checkpoint folder and read it
    back: the lineage is cut there (an executor lost later recomputes from the
    written files, not from raw input), later scans get column pruning and
    filter / partition pushdown, and the planner knows the table's real size.

    ``memo`` (any hashable) lets one session reuse a stage already written.
    """
    spark = df.sparkSession
    if memo is not None and (found := written(spark, name, memo)) is not None:
        return found
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with shuffles_freed(spark):
        writer.parquet(path)
    _WRITTEN.append((spark, path))
    if memo is not None:
        _STAGES[spark.sparkContext.applicationId, name, memo] = path
    df = spark.read.parquet(path)
    df._written_path = path
    return df


def written(spark: SparkSession, name: str, memo: tuple):
    """The stage table that ``materialize`` wrote for ``memo`` in this session, or None."""
    path = _STAGES.get((spark.sparkContext.applicationId, name, memo))
    return None if path is None else spark.read.parquet(path)


def drop_written(df) -> None:
    """Delete a table that ``materialize`` returned; nothing may read it any more."""
    at = (df.sparkSession, df._written_path)
    drop_tables([at])
    _WRITTEN[:] = [x for x in _WRITTEN if x[1] != at[1]]
    for key in [k for k, path in _STAGES.items() if path == at[1]]:
        del _STAGES[key]


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what is executed inside: rows with long lists
    are held a few at a time on both sides of the Python boundary."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(min(int(old), rows) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is written, not when the driver happens to
    collect its garbage: the written table is all that later steps read."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, least: int):
    """At least so many shuffle partitions for what is executed inside: a task's share of a table that
    grows with the input stays what it is (small partitions are merged by the adaptive planner)."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(max(int(old), least)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def drop_tables(tables) -> None:
    """Delete written tables, given as (session, path)."""
    for spark, path in tables:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_MEMO: dict = {}


def memo_get(key):
    """A stage object (for example a fitted transformer) kept for this session."""
    return _MEMO.get(key)


def memo_put(key, value) -> None:
    _MEMO[key] = value


def forget_stages() -> None:
    """Drop the memos and delete the tables written by ``materialize``; frames that
    still read them become invalid (the bench calls it between queries)."""
    drop_tables(_WRITTEN)
    _WRITTEN.clear()
    _STAGES.clear()
    _MEMO.clear()
