"""Length-delimited binary records with masked checksums, and an offset index.

A record is

    length of the payload   8 bytes, little-endian
    masked CRC-32 of those  4 bytes
    payload
    masked CRC-32 of it     4 bytes

and a payload is a byte of flags (1: no id, 2: wide), the document's id in 8 bytes, and the
token ids in 2 bytes each, or in 4 if one of them needs it. One file is written per
partition, in the order of its rows. The index is a Parquet table beside the files with a
row per record, so that readers can take records in any order and split files anywhere.
"""

from __future__ import annotations

import struct
import sys
import zlib

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm import files
from skewdex.llm.arrow import map_rows, task_number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD = 12
NO_ID, WIDE = 1, 2
#: What one task reads at least, in bytes of records.
READ_BYTES = 64 << 20
_BEFORE = (Window.unboundedPreceding, -1)
INDEX = "file string, record long, offset long, length long, n_tokens long"


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted: a checksum of data that itself holds checksums stays sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of a whole record; a damaged one raises."""
    if struct.unpack_from("<I", record, 8)[0] != masked(record[:8]):
        raise ValueError("the length of a record is damaged")
    payload = record[HEAD:-4]
    if struct.unpack_from("<Q", record)[0] != len(payload) or struct.unpack("<I", record[-4:])[0] != masked(payload):
        raise ValueError("a record is damaged")
    return payload


def pack(doc: int | None, tokens: bytes) -> bytes:
    ids = np.frombuffer(tokens, "<u4")
    wide = bool(ids.size and ids.max() >= 1 << 16)
    flags = NO_ID * (doc is None) | WIDE * wide
    return struct.pack("<Bq", flags, doc or 0) + (tokens if wide else ids.astype("<u2").tobytes())


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    flags, doc = struct.unpack_from("<Bq", payload)
    body = payload[9:]
    tokens = body if flags & WIDE else np.frombuffer(body, "<u2").astype("<u4").tobytes()
    return None if flags & NO_ID else doc, tokens


def write(df: DataFrame, id_col: str, tokens_col: str, folder: str) -> None:
    """Write a file per partition of ``df`` and then the index, to a new ``folder``.

    Ids are integers and may be null or repeated; null tokens count as none. Lay ``df`` out
    as the files shall lie, e.g. by ``ordered``.
    """

    def make():
        name = f"part-{task_number():06d}.rec"
        out, record = None, 0

        def step(emit, doc, tokens):
            nonlocal out, record
            out = out or files.Output(folder, name)
            framed = frame(pack(doc, tokens or b""))
            emit(name, record, out.write(framed), len(framed), len(tokens or b"") // 4)
            record += 1

        def close(emit):
            if out:
                out.close()

        step.close = close
        return step

    rows = df.select(F.col(id_col).cast("long"), F.col(tokens_col))
    map_rows(rows, INDEX, make).write.parquet(f"{folder}/index")


def ordered(df: DataFrame, by: str, tie: str) -> DataFrame:
    """Rows in ascending order of ``by``, over all partitions; rows of one key can be split."""
    keys = [F.col(by), F.xxhash64(tie)]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``, the number of ids in all records before."""
    found = spark.read.schema(INDEX).parquet(f"{folder}/index")
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select(  # a row per file
        "file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(*_BEFORE)), F.lit(0)).alias("base")
    )
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("record").rowsBetween(*_BEFORE))
    return (
        found.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(bases, "file")
        .select("file", "record", "offset", "length", "n_tokens", (F.col("base") + F.col("inside")).alias("start"))
    )


def read(spark: SparkSession, folder: str, seed: int | None = None) -> DataFrame:
    """(doc_id, file, record, start, tokens) of every record, each with its checksums tested.

    With a ``seed`` the records come shuffled: dealt to tasks at random and read there in a
    random order, by offset. Without, each task reads runs of neighbours.
    """
    found = index(spark, folder)
    total = sum(size for _, size in files.sizes(folder, ".rec"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // READ_BYTES))
    if seed is None:
        dealt = found.repartition(tasks, "file", F.expr(f"offset div {READ_BYTES // 16}"))
        dealt = dealt.sortWithinPartitions("file", "offset")
    else:
        place = F.xxhash64(F.lit(seed), "file", "record")
        dealt = found.repartition(tasks, place).sortWithinPartitions(place)

    def make():
        opened: dict = {}

        def step(emit, name, record, offset, length, n_tokens, start):
            if name not in opened:
                opened.clear()  # one file is open at a time
                system, path = files.at(folder)
                opened[name] = system.open_input_file(f"{path}/{name}")
            doc, tokens = unpack(unframe(opened[name].read_at(length, offset)))
            if len(tokens) != 4 * n_tokens:
                raise ValueError("the index does not fit the records")
            emit(doc, name, record, start, tokens, size=64 + len(tokens))

        return step

    return map_rows(dealt, "doc_id long, file string, record long, start long, tokens binary", make)
