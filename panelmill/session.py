"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    # Snapshot dates are compared with purchase times, so one fixed zone is part of the semantics.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A JVM never compiles a method of more bytes. A stage with one runs by operators instead, whose methods are split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Bytes of stored input for each partition that a shuffle starts with.
INPUT_PER_PARTITION = 2 << 20
#: The most bytes of shuffled partitions put together for a task, and of a split of a file.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20, "spark.sql.files.maxPartitionBytes": 32 << 20}

# folders of this process by application: the last one is where new paths go
_FOLDERS: dict[str, list[str]] = {}


def build_session(
    app_name: str = "panelmill", master: str | None = None, shared: str | None = None, **extra: str
) -> SparkSession:
    """Create or fetch a session; cluster sizing stays with spark-submit.

    ``shared`` is the folder all executors reach, for ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_sql_settings(spark: SparkSession) -> SparkSession:
    """Put the SQL settings on a session somebody else created."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_tasks(spark: SparkSession, *folders: str) -> SparkSession:
    """Let the number of tasks follow the stored input, so that the memory of one does not.

    A purchase is exploded over its months right after a shuffle, so a task needs many times what it reads. With a fixed number of
    shuffle partitions that grows with the input. Here shuffles start with as many as the folders ask for, of which
    adaptive execution puts small ones together. More partitions or smaller tasks that somebody asked for stay.
    """
    jvm, stored = spark._jvm, 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        stored += system.getContentSummary(path).getLength() if system.exists(path) else 0
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if stored // INPUT_PER_PARTITION > int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(first, str(stored // INPUT_PER_PARTITION))
    for key, most in TASK_BYTES.items():
        if jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    In local mode the warehouse folder takes its place where it is unset. On a cluster a
    missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


def _folders(spark: SparkSession) -> list[str]:
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        root = f"{shared_dir(spark)}/run-{application}-{uuid.uuid4().hex[:8]}"
        _FOLDERS[application] = [root]
        atexit.register(_remove, spark, root)
    return _FOLDERS[application]


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for what is staged inside the block; it is removed at the end.

    Results that still read staged tables have to be written before. Outside of any such block
    staged tables go to the folder of the application, which is removed when the process ends.
    """
    folders = _folders(spark)
    path = f"{folders[-1]}/{uuid.uuid4().hex[:12]}"
    folders.append(path)
    try:
        yield path
    finally:
        folders.remove(path)
        _remove(spark, path)


#: Spark's switch for removing the files of a query's shuffles when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries in the block leave no shuffle files; else these stay until the driver happens to collect its garbage.

    For writes, whose frames are not run again. A Spark that lacks the switch ignores it.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the present scratch folder."""
    return f"{_folders(spark)[-1]}/{name}-{uuid.uuid4().hex[:12]}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point the context at the shared folder before iterative fits."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{_folders(spark)[0]}/checkpoints")
