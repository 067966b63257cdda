"""Document texts from stored files, and their join to the listing."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The writer of files travels with the tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHARSET = "ISO-8859-1"
# Bytes of files that a task reads at least, as long as all cores have two tasks.
TASK_BYTES = 32 << 20
# Files that are put into a folder.
FOLDER_FILES = 2_000


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> list[str]:
    """Write ``content`` of each row to a file of its own, whose address ends in ``name``; returns where they are.

    Each task writes to folders of its own, of ``FOLDER_FILES`` each, which tasks list when they are
    read: with a folder for each file, the driver would rename every one, and list them one by one.
    Names may repeat. What a run that failed has left is in none of the folders returned.
    """
    spark = rows.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    uri = system.makeQualified(path).toString()
    uri = f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") and not uri.startswith("file://") else uri

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        run, n, within, folders = uuid.uuid4().hex, 0, "", []
        for batch in batches:
            for title, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if n % FOLDER_FILES == 0:
                    within = f"{run}-{n // FOLDER_FILES}"
                    store.create_dir(f"{root}/{within}", recursive=True)
                    folders.append(within)
                with store.open_output_stream(f"{root}/{within}/{n}.{title}") as out:
                    out.write(data)
                n += 1
        yield pa.RecordBatch.from_pydict({"run": pa.array(folders, pa.string())})

    done = rows.select(F.col(name).cast("string"), F.col(content).cast("binary")).mapInArrow(write, "run string").collect()
    return [f"{folder}/{r.run}" for r in done] or [folder]


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``url`` (the file's path), ``length`` and ``content`` of the stored files.

    Spark deals files to tasks by their lengths (``spark.sql.files.maxPartitionBytes``), and
    opens none for a plan that needs their lengths only. It takes each for 4 MB at least, so of
    small files a task has a few only: such tasks are put together, by what the files hold, as
    what follows is written in a file per task. An empty file is no row, any other is one: one above
    ``spark.sql.sources.binaryFile.maxLength`` raises.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select(
        F.col("path").alias("url"), "length", "content"
    )
    held = int(files._jdf.queryExecution().analyzed().stats().sizeInBytes())
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-held // TASK_BYTES))
    return files.coalesce(wanted) if wanted < files.select("url").rdd.getNumPartitions() else files


def decode_text(files: DataFrame, content: str = "content", charset: str = CHARSET) -> DataFrame:
    """``content`` decoded to ``text``."""
    return files.withColumn("text", F.decode(content, charset)).drop(content)


def attach_texts(listing: DataFrame, texts: DataFrame, url: str = "url", text: str = "text") -> DataFrame:
    """``listing`` with the text of its ``url``; documents without one, or an empty one, go.

    ``texts`` has one row per url. A text may be listed under several groups; which side
    moves, and whether the listing is small enough to be sent around, is left to Catalyst.
    """
    present = texts.where(F.col(text) != "").select(url, text)
    return listing.join(present, url)
