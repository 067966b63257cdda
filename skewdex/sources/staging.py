"""Tables written to shared storage to cut lineage, and read-through saving."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Codec of what is saved, or staged ``packed``: terms and counts take less of the disk than with Spark's default.
PACKED = "zstd"
#: With it, Spark deletes what a write has shuffled once the write has ended, and not when the driver frees its plan.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Staged(threading.local):
    """Folders of tables that a thread has staged inside ``temporary_tables``, innermost block last."""

    def __init__(self):
        self.blocks: list[list[str]] = []


_staged = _Staged()


def shared_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, which all executors must reach.

    Only a local session may go without one: there, driver and executors see the same disk,
    and the session's warehouse is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end.

    For jobs that write their result inside the block; a DataFrame that leaves it must not
    read a table staged in it.
    """
    _staged.blocks.append([])
    try:
        yield
    finally:
        for path in _staged.blocks.pop():
            system, folder = _paths(spark, path)
            system.delete(folder, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What writes inside the block have shuffled is deleted as each of them ends.

    A driver with a large heap may not free a plan for hours, and as long the disks hold what it shuffled.
    """
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def stage(df: DataFrame, name: str, packed: bool = False) -> DataFrame:
    """Write ``df`` once and go on from the written table; what it took to shuffle is deleted.

    Lost executors then cost a re-read, not a re-computation, the work above is done once
    however many branches follow, and Catalyst sees the true size.
    """
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _staged.blocks:
        _staged.blocks[-1].append(path)
    writer = df.write.mode("errorifexists")
    with tidy(df.sparkSession):
        (writer.option("compression", PACKED) if packed else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _paths(spark: SparkSession, *paths: str):
    """The file system of some paths of one store, and the paths as its own."""
    jvm = spark.sparkContext._jvm
    own = [jvm.org.apache.hadoop.fs.Path(path.rstrip("/")) for path in paths]
    return own[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), *own


def is_saved(spark: SparkSession, path: str) -> bool:
    """True if a finished write (with its ``_SUCCESS`` file) lies at ``path``."""
    system, marker = _paths(spark, f"{path.rstrip('/')}/_SUCCESS")
    return system.exists(marker)


def publish(spark: SparkSession, draft: str, path: str) -> bool:
    """Give the finished table at ``draft`` the name ``path``; False if a finished one has it.

    The folder is renamed, in one step on HDFS and local disks, and never into or over a
    finished table: of several that publish, one wins. What a failed write has left at
    ``path``, a folder without ``_SUCCESS``, gives way.
    """
    jvm = spark.sparkContext._jvm
    system, source, target = _paths(spark, draft, path)
    if is_saved(spark, path):
        return False
    if system.exists(target):
        system.delete(target, True)
    renames = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        renames.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError:
        if is_saved(spark, path):
            return False
        raise
    return True


def materialize(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Read the table saved at ``path``; if there is none, build it, save it and read it.

    A saved table is never overwritten. The table is written to a folder of its own beside
    ``path`` and then takes its name, so a failed save raises and leaves nothing in the way
    of the next one. Of concurrent builders one wins, and all read what it has saved. What
    ``builder`` stages and shuffles is deleted when the table is saved.
    """
    if not is_saved(spark, path):
        draft = f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"
        try:
            with temporary_tables(spark), tidy(spark):
                builder().write.mode("errorifexists").option("compression", PACKED).parquet(draft)
            publish(spark, draft, path)
        finally:
            system, folder = _paths(spark, draft)
            system.delete(folder, True)  # no longer there if it was published
    return spark.read.parquet(path)
