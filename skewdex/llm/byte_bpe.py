"""Byte-level BPE: encoding by overlapping chunks, decoding by concatenation.

A long text is cut into chunks of ``chunk`` characters. Each chunk is read on into the next
one, to a place where a pre-token must start, and all chunks are pre-tokenised in parallel,
each from its own first character. That may lie inside a pre-token, but as the pattern looks
ahead only, two readings that share one boundary share all later ones: the first boundary
on which the readings of two neighbours agree is where their pieces are stitched. The pieces
are encoded in parallel, and their ids are joined by text.
"""

from __future__ import annotations

import base64
import sys

import regex
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm.arrow import kept, map_rows, task_number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a chunk; texts up to this length are encoded in one piece.
CHUNK = 1 << 15
#: Characters that a chunk shares with the next one, at least.
OVERLAP = 64
#: A match that ends this close to the end of a chunk could be longer in the whole text.
SLACK = 4
#: Between these two characters every reading has a boundary.
HARD = r"\P{White_Space}\p{White_Space}"


def read_ranks(path: str) -> bytes:
    """The rank file, read where the query is planned: executors need no copy of it."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, built once per Python worker."""

    def build():
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    return kept(("byte_bpe", ranks, pattern), build)


def chunks_of(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of each chunk.

    A chunk ends behind the first white space after other characters in the next one: no
    pre-token goes on over such a place, so both readings have a boundary there.
    """
    found, start = [], 0
    while True:
        edge = start + chunk
        hard = edge < len(text) and regex.compile(HARD).search(text, edge)
        end = max(edge + overlap, hard.end()) + SLACK + 1 if hard else len(text)
        if end >= len(text):
            return [*found, (start, len(text))]
        found.append((start, end))
        start = edge


def boundaries(text: str, at: int, end: int, whole: bool, pattern) -> list[int]:
    """Where pre-tokens end when ``text[at:end]`` is read from ``at``, as far as that is sure."""
    last = end if whole else end - SLACK
    return [m.end() for m in pattern.finditer(text, at, end) if m.end() <= last]


def stitch(text: str, chunk: int, pattern) -> int:
    """The first hard boundary of both readings of a chunk that overlaps the next one.

    ``text`` is the chunk with its overlap. Only boundaries between other characters and
    white space are taken; they hold in every version of the character tables.
    """
    own, hard = set(boundaries(text, 0, len(text), False, pattern)), regex.compile(HARD)
    for at in boundaries(text, chunk, len(text), False, pattern):
        if at in own and at > chunk and hard.match(text, at - 1):
            return at
    raise ValueError("a chunk without a shared boundary")


def scan_pattern(pattern: str) -> str:
    """The pattern with white space as the Unicode property, as the BPE library has it."""
    return pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


def encode(
    df: DataFrame, id_col: str, text_col: str, ranks: bytes, pattern: str,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(``id_col``, ids): the ids of each whole text, one row per row of ``df``.

    A null text counts as empty and has no ids. Ids may be null or repeated: each row is
    encoded by itself. Other columns are left behind.
    """
    key = df.schema[id_col].dataType
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = T.ArrayType(T.IntegerType())
    short_rows = T.StructType([T.StructField("id", key), T.StructField("ids", ids)])

    def short():
        bpe = encoding(ranks, pattern)

        def step(emit, doc, text):
            found = bpe.encode_ordinary(text)
            emit(doc, found, size=64 + 4 * len(found))

        return step

    def cut():
        task, made = task_number() << 33, 0

        def step(emit, doc, text):
            nonlocal made
            spans = chunks_of(text, chunk, overlap)
            for part, (start, end) in enumerate(spans):
                emit(task + made, doc, part, part + 1 == len(spans), text[start:end], size=64 + 2 * (end - start))
            made += 1

        return step

    def scan():
        compiled = regex.compile(scan_pattern(pattern))

        def step(emit, row, doc, part, last, text):
            at = None if last else stitch(text, chunk, compiled)
            emit(row, doc, part, 0 if part == 0 else None, at, text[:at], size=64 + 2 * len(text))
            if not last:
                emit(row, None, part + 1, at - chunk, None, None)

        return step

    def pieces():
        bpe = encoding(ranks, pattern)

        def step(emit, row, doc, part, start, text):
            found = bpe.encode_ordinary(text[start:])
            emit(row, doc, part, found, size=64 + 4 * len(found))

        return step

    direct = map_rows(docs.where(F.char_length("text") <= chunk), short_rows, short)
    row, part = T.StructField("row", T.LongType()), T.StructField("part", T.IntegerType())
    doc, text = T.StructField("id", key), T.StructField("text", T.StringType())
    last = T.StructField("last", T.BooleanType())
    start, end = T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())
    cuts = map_rows(docs.where(F.char_length("text") > chunk), T.StructType([row, doc, part, last, text]), cut)
    read = map_rows(cuts.repartition("row", "part"), T.StructType([row, doc, part, start, end, text]), scan)
    stitched = read.groupBy("row", "part").agg(
        F.max("id").alias("id"), F.max("start").alias("start"), F.max("text").alias("text")
    ).select("row", "id", "part", "start", "text")
    encoded = map_rows(stitched, T.StructType([row, doc, part, T.StructField("ids", ids)]), pieces)
    joined = (
        encoded.groupBy("row")
        .agg(F.max("id").alias("id"), F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
        .select("id", F.flatten(F.col("parts.ids")).alias("ids"))
    )
    return direct.unionByName(joined).select(F.col("id").alias(id_col), "ids")


def decode(df: DataFrame, ranks: bytes, pattern: str, ids_col: str = "ids", into: str = "bytes") -> DataFrame:
    """``df`` with the bytes of its ids in a further column; null ids give null.

    An id that the ranks don't have raises an error.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.BinaryType())])
    at = df.columns.index(ids_col)

    def make():
        bpe = encoding(ranks, pattern)

        def step(emit, *values):
            found = values[at]
            raw = None if found is None else bpe.decode_bytes(found)
            emit(*values, raw, size=64 + len(raw or b"") + 4 * len(found or ()))

        return step

    return map_rows(df, schema, make)
