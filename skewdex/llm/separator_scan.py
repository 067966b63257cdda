"""Token counts of documents in flat token files without an index.

A flat file is nothing but token ids of a fixed width; each document ends with a separator
id. The files are read in blocks, in any order. A block gives the places of its separators,
found by one vectorised comparison. Where a document began that ends in a block, and how
many ended before, follows from the blocks before it by a prefix scan over one small row per
block, in two levels so that a huge file is not one task's work.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm import files
from skewdex.llm.arrow import map_rows, task_number
from skewdex.llm.byte_bpe import encoding

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens of a block, and blocks that the first level of the prefix scan takes together.
BLOCK, GROUP = 1 << 20, 1024


def write_flat(
    df: DataFrame, id_col: str, text_col: str, ranks: bytes, pattern: str, separator: int, folder: str,
    dtype: str = "<u2",
) -> None:
    """Encode each whole text and append it and ``separator`` to the file of its partition.

    Null texts count as empty: they give a separator alone. Which row lies where is kept
    beside the files (``folder``/rows), for those who want to name the documents again; the
    scan does not use it. ``dtype`` must be wide enough for every id.
    """
    row = T.StructType([T.StructField("file", T.StringType()), T.StructField("ordinal", T.LongType()),
                        T.StructField(id_col, df.schema[id_col].dataType)])
    largest = np.iinfo(dtype).max

    def make():
        name, bpe = f"part-{task_number():06d}.bin", encoding(ranks, pattern)
        out, ordinal = None, 0

        def step(emit, doc, text):
            nonlocal out, ordinal
            out = out or files.Output(folder, name)
            ids = np.array([*bpe.encode_ordinary(text or ""), separator])
            if ids.max() > largest:
                raise ValueError(f"an id of {ids.max()} does not fit {dtype}")
            out.write(ids.astype(dtype).tobytes())
            emit(name, ordinal, doc)
            ordinal += 1

        def close(emit):
            if out:
                out.close()

        step.close = close
        return step

    map_rows(df.select(F.col(id_col), F.col(text_col)), row, make).write.parquet(f"{folder}/rows")


def _blocks(spark: SparkSession, folder: str, separator: int, dtype: str, block: int) -> DataFrame:
    """(file, block, first, n, ends): the places of the separators, counted from the file's start."""
    width = np.dtype(dtype).itemsize
    found = files.sizes(folder, ".bin")
    if any(size % width for _, size in found):
        raise ValueError("a file does not hold whole ids")
    listed = spark.createDataFrame(found, "file string, size long").where("size > 0")
    total = -(-sum(size for _, size in found) // (block * width))
    tasks = max(1, min(total, int(spark.conf.get("spark.sql.shuffle.partitions")) + total // 16))
    dealt = listed.select(
        "file", (F.col("size") / width).cast("long").alias("tokens"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size div {width} - 1) div {block}"))).alias("block"),
    ).repartition(tasks, "file", "block")

    def make():
        system, path = files.at(folder)

        def step(emit, name, tokens, number):
            first = number * block
            n = min(block, tokens - first)
            with system.open_input_file(f"{path}/{name}") as file:
                ids = np.frombuffer(file.read_at(n * width, first * width), dtype)
            ends = np.flatnonzero(ids == separator) + first
            emit(name, number, first, n, ends, size=64 + 8 * len(ends))

        return step

    return map_rows(dealt, "file string, block long, first long, n long, ends array<long>", make)


def scan(
    spark: SparkSession, folder: str, separator: int, dtype: str = "<u2", block: int = BLOCK,
) -> DataFrame:
    """(file, ordinal, start, n_tokens, terminated): every document of every flat file.

    ``n_tokens`` leaves the separator out, so it is 0 for an empty document. Ids after the
    last separator of a file are a document that is not terminated. Empty files have none.
    """
    staged = f"{folder}/blocks-{separator}-{block}"
    _blocks(spark, folder, separator, dtype, block).write.mode("overwrite").parquet(staged)
    blocks = spark.read.parquet(staged)

    small = blocks.select(
        "file", "block", F.expr(f"block div {GROUP}").alias("grp"), F.size("ends").cast("long").alias("seps"),
        F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("last"), (F.col("first") + F.col("n")).alias("to"),
    )
    before = (Window.unboundedPreceding, -1)
    groups = small.groupBy("file", "grp").agg(F.sum("seps").alias("seps"), F.max("last").alias("last"))
    outer = Window.partitionBy("file").orderBy("grp").rowsBetween(*before)
    groups = groups.select(
        "file", "grp", F.sum("seps").over(outer).alias("seps_0"), F.max("last").over(outer).alias("last_0")
    )
    inner = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(*before)
    carried = (
        small.withColumns({"seps_1": F.sum("seps").over(inner), "last_1": F.max("last").over(inner)})
        .join(groups, ["file", "grp"])
        .select(
            "file", "block",
            (F.coalesce("seps_0", F.lit(0)) + F.coalesce("seps_1", F.lit(0))).alias("ordinal"),
            F.coalesce("last_1", "last_0", F.lit(-1)).alias("last"),
        )
    )
    ended = (
        blocks.select("file", "block", "ends").where(F.size("ends") > 0)
        .join(carried, ["file", "block"])
        .select("file", "ordinal", F.posexplode(F.arrays_zip(
            F.concat(F.array("last"), F.expr("slice(ends, 1, size(ends) - 1)")).alias("before"), F.col("ends").alias("end")
        )).alias("at", "span"))
        .select(
            "file", (F.col("ordinal") + F.col("at")).alias("ordinal"), (F.col("span.before") + 1).alias("start"),
            (F.col("span.end") - F.col("span.before") - 1).alias("n_tokens"), F.lit(True).alias("terminated"),
        )
    )
    rest = (
        small.groupBy("file").agg(F.max("to").alias("to"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"), F.sum("seps").alias("ordinal"))
        .where("to > last + 1")
        .select("file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("to") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
    )
    return ended.unionByName(rest)


def names(spark: SparkSession, folder: str) -> DataFrame:
    """(file, ordinal, id column): which row ``write_flat`` put where."""
    return spark.read.parquet(f"{folder}/rows")
