"""Near-duplicate lines by segment partition, and documents without them.

Two lines are near if their edit distance is at most ``errors``. A line is cut into
``errors`` + 1 even segments; of two near lines the longer one has a segment of the shorter
one unchanged, at a place that the lengths and the segment's number leave few choices for.
So each line is listed under its own segments and, for each length that a near shorter line
can have, under its substrings at those places. Lines that share a list are compared by a
bit-parallel edit distance within a band of 2 * ``errors`` + 1 diagonals.
"""

from __future__ import annotations

import os
import struct
import sys
from functools import reduce

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm.arrow import map_rows
from skewdex.llm.lists import BUCKET, ENTRY, PACKED, Packer, classes, counted, few, shared
from skewdex.operators.joins import lookup_join
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ERRORS = 2
#: Lines of fewer characters are not compared by edits: a few edits turn one into quite another.
SHORTEST = 32
REMEMBERED = 300_000
#: Longest line whose places are kept for the next one of its length; lines, and their characters, made into entries at once.
REMEMBERED_LENGTH, LINES_AT_ONCE, CHARS_AT_ONCE = 4_096, 2_048, 1 << 18
#: Letters whose numbers are compared before lines are; any others would be right too.
LETTERS = "etanoisrhd"
#: Beside the letters' numbers: the line is listed here to find others, not to be found.
FINDS = 1 << 3 * len(LETTERS)
_NAME = "sid long, check long"
#: Of the hashes of many substrings at once: an odd base, its inverse and the factors that mix the bits.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def name(line: str) -> tuple[int, int]:
    """128 bits that stand for a line, as two numbers."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(line))


def segments(length: int, errors: int) -> list[tuple[int, int]]:
    """Start and size of the even segments of a line; the last ones are longer by one."""
    size, longer = divmod(length, errors + 1)
    sizes = [size + (i >= errors + 1 - longer) for i in range(errors + 1)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(errors + 1)]


def places(length: int, errors: int) -> list[tuple[int, int, int, bool]]:
    """(start, end, seed, own) of the substrings under which a line of ``length`` is listed.

    They are the segments of lines up to ``errors`` shorter that it could contain; its own come last.
    """
    found = []
    for shorter in range(max(length - errors, errors + 1), length + 1):
        gap = length - shorter
        for i, (start, size) in enumerate(segments(shorter, errors)):
            # Fewer than i + 1 errors lie left of the segment, or few enough right of it.
            low = max(0, start - i, start + gap - (errors - i))
            high = min(length - size, start + i, start + gap + (errors - i))
            found += [(at, at + size, (shorter << 8) + i, shorter == length and at == start) for at in range(low, high + 1)]
    return sorted(found, key=lambda place: place[3])


def keys(line: str, errors: int, known: dict[int, list] | None = None) -> dict[int, bool]:
    """Where a line is listed: segments of lines up to ``errors`` shorter that it could contain.

    True for its own segments, with which it is found; by the others it finds shorter lines.
    ``known`` holds the places of lengths seen before.
    """
    known = {} if known is None else known
    at = known.get(len(line))
    if at is None:
        at = places(len(line), errors)
        if len(line) <= REMEMBERED_LENGTH:
            known[len(line)] = at
    digest = xxhash.xxh64_intdigest
    return {digest(line[start:end], seed): own for start, end, seed, own in at}


def tally(line: str) -> int:
    """How often each of ``LETTERS`` occurs, modulo 8, in three bits each."""
    return sum((line.count(letter) & 7) << 3 * at for at, letter in enumerate(LETTERS))


def tallies(lines: list[str], chars: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``tally`` of each of the lines, whose code points are ``chars``, from ``start`` on."""
    known, found = np.minimum(chars, 127), np.zeros(len(lines), np.int64)
    for first in range(0, len(LETTERS), 5):  # five letters at once, in 12 bits each
        weight = np.zeros(128, np.uint64)
        for at, letter in enumerate(LETTERS[first : first + 5]):
            weight[ord(letter)] = 1 << 12 * at
        sums = np.add.reduceat(weight[known], start)
        for at in range(len(LETTERS[first : first + 5])):
            found |= (sums >> np.uint64(12 * at) & np.uint64(7)).astype(np.int64) << 3 * (first + at)
    for at, line in enumerate(lines):
        if len(line) >= 1 << 12:
            found[at] = tally(line)
    return found


class Lister:
    """Where many lines at once are listed: under hashes of the substrings that ``keys`` names."""

    def __init__(self, errors: int):
        self.errors, self.known, self.powers = errors, {}, np.ones((2, 1), np.uint64)

    def _places(self, length: int) -> tuple[np.ndarray, ...]:
        found = self.known.get(length)
        if found is None:
            start, end, seed, own = map(np.array, zip(*places(length, self.errors)[::-1]))  # own ones first: they stay of equal entries
            found = start, end, seed.astype(np.uint64), own
            if length <= REMEMBERED_LENGTH:
                self.known[length] = found
        return found

    def _up_to(self, n: int) -> np.ndarray:
        """The powers of the base and of its inverse, up to the ``n``-th at least."""
        while self.powers.shape[1] <= n:
            have = self.powers.shape[1]
            step = np.array([[pow(_BASE, have, 1 << 64)], [pow(_INVERSE, have, 1 << 64)]], np.uint64)
            self.powers = np.concatenate([self.powers, self.powers * step], axis=1)
        return self.powers

    def entries(self, sids: list[int], lines: list[str]) -> np.ndarray:
        """The entries of the lines, none of which is empty.

        A substring's hash is a sum of its code points times powers of the base, the difference
        of two running sums. Equal hashes of different substrings only make more pairs to compare.
        """
        length = np.fromiter(map(len, lines), np.int64, len(lines))
        begin = np.cumsum(length) - length
        chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
        powers, inverses = self._up_to(len(chars))
        sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum((chars + np.uint64(1)) * powers[: len(chars)], out=sums[1:])
        found = [self._places(len(line)) for line in lines]
        each = np.fromiter((len(f[0]) for f in found), np.int64, len(found))
        start, end, seed, own = map(np.concatenate, zip(*found))
        offset = np.repeat(begin, each)
        start, end = start + offset, end + offset
        h = (sums[end] - sums[start]) * inverses[start] ^ seed * _MIX[0]
        for factor in _MIX:
            h = (h ^ h >> np.uint64(29)) * factor
        h ^= h >> np.uint64(32)
        entries = np.empty(len(h), ENTRY)
        entries["key"], entries["sid"], entries["n"] = h.view(np.int64), np.repeat(sids, each), np.repeat(length, each)
        entries["pos"] = np.repeat(tallies(lines, chars, begin), each) | np.where(own, 0, FINDS)
        return entries


def _may_be_near(errors: int, a: str, b: str) -> Column:
    """An edit changes the length and the numbers of two letters by one at the most."""
    near = (F.abs(F.col(f"{a}.n") - F.col(f"{b}.n")) <= errors) & (
        (F.col(f"{a}.pos") < FINDS) | (F.col(f"{b}.pos") < FINDS)
    )
    gaps = [
        F.abs(F.shiftright(F.col(f"{a}.pos"), 3 * at).bitwiseAND(7) - F.shiftright(F.col(f"{b}.pos"), 3 * at).bitwiseAND(7))
        for at in range(len(LETTERS))
    ]
    return near & (reduce(Column.__add__, [F.least(gap, 8 - gap) for gap in gaps]) <= 2 * errors)


def distance(a: str, b: str, errors: int) -> int:
    """Edit distance of two strings, or ``errors`` + 1 if it is larger.

    State ``r[d]`` has a bit for each diagonal of the band: whether that many errors lead
    from the start to this place of ``b`` and the diagonal's place of ``a``.
    """
    if abs(len(a) - len(b)) > errors:
        return errors + 1
    start = len(os.path.commonprefix((a, b)))
    a, b = a[start:], b[start:]
    end = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - end], b[: len(b) - end]
    places: dict[str, int] = {}
    for at, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << at
    mask = (1 << 2 * errors + 1) - 1
    r = [((2 << d) - 1) << errors & mask for d in range(errors + 1)]
    for at, char in enumerate(b):
        match = places.get(char, 0)
        match = (match >> at - errors if at >= errors else match << errors - at) & mask
        new = [r[0] & match]
        for d in range(1, errors + 1):
            new.append((r[d] & match | r[d - 1] | r[d - 1] >> 1 | new[d - 1] << 1) & mask)
        r = new
        if not r[errors]:
            return errors + 1
    goal = 1 << len(a) - len(b) + errors
    return next((d for d in range(errors + 1) if r[d] & goal), errors + 1)


def _split(text: str | None, shortest: int) -> list[tuple[int, str]]:
    return [(no, line) for no, line in enumerate((text or "").split("\n")) if len(line) >= shortest]


def _lines(docs: DataFrame, text_col: str, shortest: int) -> DataFrame:
    """(sid, check, line) of the lines, each at most a few times per task."""

    def make():
        seen = set()

        def step(emit, text):
            for _, line in _split(text, shortest):
                sid, check = name(line)
                if sid not in seen:
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(sid)
                    emit(sid, check, line, size=64 + len(line))

        return step

    return map_rows(docs.select(F.col(text_col)), f"{_NAME}, line string", make)


def line_classes(docs: DataFrame, text_col: str, errors: int, shortest: int, lines: int) -> DataFrame | None:
    """(node, component): the class of each line (by ``sid``) that is near another one.

    ``lines`` is about the number of lines, for the number of buckets.
    """
    spark = docs.sparkSession
    per_line = len(keys("x" * max(shortest, 64), errors)) + 2 * errors
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines * per_line // BUCKET))

    def make():
        seen, packer, lister, sids, held, n_chars = set(), Packer(buckets), Lister(errors), [], [], 0

        def pack(emit):
            nonlocal n_chars
            if held:
                packer.add(lister.entries(sids, held), emit)
            sids.clear()
            held.clear()
            n_chars = 0

        def step(emit, text):
            nonlocal n_chars
            for _, line in _split(text, shortest):
                sid = name(line)[0]
                if sid in seen:
                    continue
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.add(sid)
                sids.append(sid)
                held.append(line)
                n_chars += len(line)
                if len(held) >= LINES_AT_ONCE or n_chars >= CHARS_AT_ONCE:
                    pack(emit)

        def close(emit):
            pack(emit)
            packer.flush(emit)

        step.close = close
        return step

    lists = shared(map_rows(docs.select(F.col(text_col)), PACKED, make), buckets)
    wanted = few(lists.select("sid").distinct(), "wanted")
    texts = stage(_lines(docs, text_col, shortest).join(wanted, "sid").dropDuplicates(["sid", "line"]), "line-texts")
    if texts.groupBy("sid").count().where("count > 1").head(1):
        raise ValueError("two different lines have the same 64-bit id")

    def compare(pairs: DataFrame) -> DataFrame:
        def make():
            def step(emit, a, b, mine, other):
                apart = distance(mine, other, errors)
                emit(a, b, apart <= errors, float(apart))

            return step

        mine = texts.select(F.col("sid").alias("b"), F.col("line").alias("mine"))
        other = texts.select(F.col("sid").alias("a"), F.col("line").alias("other"))
        joined = mine.join(pairs, "b").join(other, "a").select("a", "b", "mine", "other")
        return stage(map_rows(joined, "a long, b long, linked boolean, distance double", make).distinct(), "compared")

    return classes(lists, lambda a, b: _may_be_near(errors, a, b), compare, rank=F.when(F.col("pos") < FINDS, 0).otherwise(1))


def drop_repeated_lines(
    docs: DataFrame, id_col: str, text_col: str, errors: int = ERRORS, shortest: int = SHORTEST, equal: bool = False,
) -> DataFrame:
    """``docs`` with repeated lines dropped, and n_lines, n_long, n_dropped.

    Lines are what line feeds separate. Lines of ``shortest`` characters or more that chains
    of edit distances of at most ``errors`` link are one class. With ``equal``, shorter lines
    that are equal are one class, too; those of white space alone are layout and stay. The
    first line of a class stays, in the order of id (null last), text and line; all others go,
    also within one document. A null text stays null and has no lines. Rows that share id and
    text are one document given twice and lose the same lines. All columns are kept, but for
    those named as the new ones, which are replaced; ``n_long`` counts the lines of
    ``shortest`` characters or more.
    """
    if shortest <= errors:
        raise ValueError("a line needs a character for each segment")
    counts = T.StructType.fromDDL("n_lines int, n_long int, n_dropped int")
    docs = docs.drop(*counts.names)
    key = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    found = T.StructType([T.StructField("id", key), *T.StructType.fromDDL(f"text_key long, no int, {_NAME}").fields])

    def make():
        def step(emit, doc, text_key, text):
            for no, line in _split(text, 1 if equal else shortest):
                if len(line) >= shortest or not line.isspace():
                    emit(doc, text_key, no, *name(line))

        return step

    held, n_lines = counted(map_rows(rows, found, make), "lines")
    labels = line_classes(docs, text_col, errors, shortest, n_lines)
    named = held.withColumn("kind", F.concat_ws(":", "sid", "check"))
    if labels is not None:
        labels = few(labels.withColumnRenamed("node", "sid"), "line-classes")
        named = named.join(labels, "sid", "left").withColumn(
            "kind", F.coalesce(F.concat(F.lit("c"), F.col("component")), "kind")
        )
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_key", "no")
    firsts = named.groupBy("kind").agg(F.min(place).alias("first"), F.max(place).alias("other"), F.count(F.lit(1)).alias("n_held"))
    firsts = stage(firsts.where("first <> other").drop("other"), "first-lines")
    # A line may stand in a third of all documents: the kinds of most lines are looked up without a shuffle.
    dropped = lookup_join(named.select("kind", place.alias("place")), firsts, ["kind"], "n_held").where("place <> first")
    per_doc = dropped.groupBy("place.last", "place.id", "place.text_key").agg(F.collect_set("place.no").alias("numbers"))

    schema = T.StructType([*docs.schema.fields, *counts.fields])
    at = docs.columns.index(text_col)

    def cut():
        def step(emit, numbers, *values):
            text = values[at]
            if text is None:
                emit(*values, 0, 0, 0)
                return
            lines, gone = text.split("\n"), set(numbers or ())
            kept = "\n".join(line for no, line in enumerate(lines) if no not in gone)
            long = sum(len(line) >= shortest for line in lines)
            emit(*values[:at], kept, *values[at + 1 :], len(lines), long, len(gone), size=256 + len(kept))

        return step

    # Names of its own for the join, as ``docs`` may have columns of any name.
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = F.col(f"c{docs.columns.index(id_col)}"), F.col(f"c{at}")
    joined = inner.join(per_doc, doc.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("text_key")), "left")
    return map_rows(joined.select("numbers", *inner.columns), schema, cut)
