"""Session settings, the shared work folder, and writing intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


#: Spark then removes the shuffle files of a query at its end, not at some collection of garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Writes that go on at a time, and the session's own setting, by session; the last one puts it back.
_WRITES: dict[int, tuple[int, str | None]] = {}
_WRITES_LOCK = threading.Lock()


def build_session(app_name: str = "gitsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans expect; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash partitions by ``key``, as many as ``spark.sql.shuffle.partitions`` says.

    The number is given so that it is not lowered for small texts: what follows
    costs far more work per byte than the shuffle's size suggests.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It lies below ``spark.checkpoint.dir``, or the checkpoint folder set on the
    context, or else Spark's warehouse, which every executor must reach anyway.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/gitsift-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder, removed when the session ends."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    filesystem.deleteOnExit(target)
    return path


@contextmanager
def temporary_path(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path below the work folder, removed when it is no longer needed."""
    path = new_path(spark, name)
    try:
        yield path
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def measured(df: DataFrame, name: str) -> DataFrame:
    """A table expected to be small, written so that Spark knows its real size.

    Planned from an aggregate over the corpus it would look as large as the
    corpus, and joining it would shuffle the other side by a few hot keys. From
    its file size Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles otherwise.
    """
    return materialise(df, name)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a write takes its shuffle files along: what is written replaces them.

    The session's own setting is put back, as other queries may want theirs again. Threads may
    write at the same time: the first keeps the setting and the last puts it back.
    """
    session = spark._jsparkSession.hashCode()
    with _WRITES_LOCK:
        writes, before = _WRITES.get(session) or (0, spark.conf.get(CLEAN_UP, None))
        _WRITES[session] = writes + 1, before
        spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            writes, before = _WRITES.pop(session)
            if writes > 1:
                _WRITES[session] = writes - 1, before
            elif before is None:
                spark.conf.unset(CLEAN_UP)
            else:
                spark.conf.set(CLEAN_UP, before)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later use does not recompute it.

    A written table survives the loss of executors, unlike cached blocks, and what was
    shuffled for it is no longer needed.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """A small new file; False if there is one of that name already.

    The file system decides between writers that try at the same time. A local one is
    asked by way of Java, as Hadoop's own check there is not atomic.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    filesystem.mkdirs(target.getParent())
    if filesystem.getUri().getScheme() == "file":
        if not jvm.java.io.File(target.toUri().getPath()).createNewFile():
            return False
        out = filesystem.create(target, True)
    else:
        try:
            out = filesystem.create(target, False)
        except Py4JJavaError:
            if filesystem.exists(target):
                return False
            raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def file_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of the files in a folder, which may not exist yet."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not filesystem.exists(target):
        return {}
    return {f.getPath().getName(): f.getLen() for f in filesystem.listStatus(target)}
