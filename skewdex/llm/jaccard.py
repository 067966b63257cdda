"""Exact Jaccard join of word n-gram sets, by prefix lists and set-relation skipping.

Sets are ordered by one global order, rare n-grams first, as a count sketch of the whole
corpus estimates them; any order is right, this one keeps lists short. Two sets of the asked
similarity share an n-gram of their prefixes. Equal sets are one set from the start.

An entry of a list has its place in its set, the set's size, and how many n-grams the set has
lost before that place, to lists that no similar set shares: two entries can still reach the
overlap that these leave. Lists are cut into blocks by size; only a block and the next are
joined, and entries whose place and losses leave no partner in the block are skipped before
pairs are made. Answers are derived from
those of similar sets (see ``lists``); what is known of two sets' similarities to a third
rules pairs out, as the Jaccard distance obeys the triangle inequality. Entries also carry
256 bits of their sets, the parity of the n-grams in each of as many classes: where more of
these differ than the similarity allows n-grams to, no pair is made. What is compared is
exact: whole sets of 64-bit n-gram hashes.
"""

from __future__ import annotations

import math
import sys
from functools import reduce

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm.arrow import map_rows
from skewdex.llm.lists import BUCKET, ENTRY, PACKED, Packer, classes, few, pruned, shared
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Counters of the sketch, whatever the size of the corpus, and the slices they are summed in.
COUNTERS, SLICES = 1 << 20, 16
REMEMBERED = 200_000
#: One n-gram in this many is listed beyond what shows that two sets share anything; what they
#: share must then be as many more, which leaves out sets that share little.
SPARE = 20
#: Columns that hold, for each of 256 classes of n-grams, whether a set has an odd number of them.
MARKS = ("mark_0", "mark_1", "mark_2", "mark_3")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def grams(text: bytes, size: int, words: dict) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text in UTF-8: lower-cased (A-Z) words between white space.

    A text of fewer words than ``size``, but not none, has one: all its words.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.int64)
    if len(words) > REMEMBERED:
        words.clear()
    ids = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(size, len(found))
    h = np.full(len(found) - width + 1, width, np.uint64)
    for at in range(width):
        h = (h ^ ids[at : at + len(h)]) * _MIX
        h ^= h >> np.uint64(29)
    h = np.sort(h.view(np.int64))  # as np.unique does, with less around it
    new = np.empty(len(h), bool)
    new[0] = True
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def set_id(found: np.ndarray, seed: int = 0) -> int:
    return np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes(), seed))).item()


def marks(found: np.ndarray) -> list[int]:
    """``MARKS`` of a set: two sets differ by at least as many n-grams as bits."""
    odd = np.bincount(found & (64 * len(MARKS) - 1), minlength=64 * len(MARKS)) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def prefix_length(n: int, percent: int) -> int:
    """How many first n-grams of a set are listed.

    Two sets with the similarity share ``wanted`` of these, for the smaller set's number, or
    all that they need to share if that is less.
    """
    return min(n, n - (n * percent + 99) // 100 + 1 + n // SPARE)


def _profile(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Staged: a row per document (id, text_key, sid, check, n), and rows of the sketch (counts)."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("text_key long, sid long, check long, n int, slice int, counts binary").fields
    ])

    def make():
        words, counts, held, n_held = _Words(), np.zeros(COUNTERS, np.uint32), [], 0

        def count():
            nonlocal n_held
            if held:
                counts[:] += np.bincount(np.concatenate(held) & (COUNTERS - 1), minlength=COUNTERS).astype(np.uint32)
            held.clear()
            n_held = 0

        def step(emit, doc, key, text):
            nonlocal n_held
            found = grams(text, size, words)
            held.append(found)
            n_held += len(found)
            if n_held > COUNTERS:
                count()
            emit(doc, key, set_id(found), set_id(found, 1), len(found), None, None)

        def close(emit):
            count()
            for number, part in enumerate(np.split(counts, SLICES)):
                place = np.flatnonzero(part)
                if len(place):
                    packed = np.stack([place.astype(np.uint32), part[place]]).tobytes()
                    emit(None, None, None, None, None, number, packed, size=len(packed))

        step.close = close
        return step

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.cast("binary"))
    return stage(map_rows(rows, schema, make), "profile")


def _sketch(profile: DataFrame) -> np.ndarray:
    """The counters of the whole corpus, up to 2**32 - 1: a fixed 4 MB, summed slice by slice in tasks."""

    def make():
        totals: dict[int, np.ndarray] = {}

        def step(emit, number, counts):
            place, n = np.frombuffer(counts, np.uint32).reshape(2, -1)
            totals.setdefault(number, np.zeros(COUNTERS // SLICES, np.uint64))[place] += n

        def close(emit):
            for number, total in totals.items():
                emit(number, np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes())

        step.close = close
        return step

    parts = profile.where("counts is not null").select("slice", "counts").repartitionById(SLICES, F.col("slice"))
    sketch = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for row in map_rows(parts, "slice int, counts binary", make).collect():
        sketch[row["slice"]] = np.frombuffer(row["counts"], np.uint32)
    return sketch.reshape(-1)


def _lists(docs: DataFrame, text_col: str, size: int, percent: int, sketch: np.ndarray, buckets: int) -> DataFrame:
    """Staged (key, sid, n, pos): the prefix entries whose n-gram several sets share."""
    counts_of = docs.sparkSession.sparkContext.broadcast(sketch)

    def make():
        words, counts, seen, packer = _Words(), counts_of.value, set(), Packer(buckets)

        def step(emit, text):
            found = grams(text, size, words)
            sid = set_id(found)
            if not len(found) or sid in seen:
                return
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.add(sid)
            keep = prefix_length(len(found), percent)
            rarity = counts[found & (COUNTERS - 1)]
            bound = np.partition(rarity, keep - 1)[keep - 1]
            near = np.flatnonzero(rarity <= bound)
            chosen = near[np.lexsort((found[near], rarity[near]))][:keep]
            entries = np.empty(keep, ENTRY)
            entries["key"], entries["sid"], entries["n"], entries["pos"] = found[chosen], sid, len(found), np.arange(keep)
            packer.add(entries, emit)

        step.close = packer.flush
        return step

    return shared(map_rows(docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), PACKED, make), buckets)


def _may_reach(percent: int, a: str, b: str) -> Column:
    """Whether sizes, positions and losses of two entries of a list leave the similarity possible.

    What both have before the list's n-gram is in lists, too, unless it is lost.
    """
    n_a, n_b, at_a, at_b, lost_a, lost_b = (F.col(f"{x}.{y}") for y in ("n", "pos", "lost") for x in (a, b))
    overlap = F.least(n_a - at_a, n_b - at_b) + F.least(at_a - lost_a, at_b - lost_b)
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (
        overlap * (100 + percent) >= (n_a + n_b) * percent
    )


def _differ(percent: int, a: str, b: str) -> Column:
    """Whether the marks of two sets show more n-grams that only one has than the similarity allows."""
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in MARKS])
    both = F.col(f"{a}.n").cast("long") + F.col(f"{b}.n")
    return (both - bits) * (100 + percent) < both * (2 * percent)


def _block(percent: int) -> Column:
    """A number of a set's size: sizes that the similarity allows are in one block or the next, rounding included."""
    return F.floor(F.ln("n") / math.log(100 / percent + 1e-6)) if percent < 100 else F.col("n")


def _sets(docs: DataFrame, text_col: str, size: int, wanted: DataFrame) -> DataFrame:
    """Staged (sid, grams) and ``MARKS``: the sets of the texts whose keys are ``wanted``."""

    def make():
        words, seen = _Words(), set()

        def step(emit, text):
            found = grams(text, size, words)
            sid = set_id(found)
            if sid not in seen:
                emit(sid, found.tobytes(), *marks(found), size=8 * len(found))
            seen.add(sid)
            if len(seen) > REMEMBERED:
                seen.clear()

        return step

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")).join(wanted, "text_key").select(F.col("text").cast("binary"))
    return stage(map_rows(rows, ", ".join(["sid long, grams binary", *(f"{m} long" for m in MARKS)]), make), "sets")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Staged (a, b, linked, distance) of each pair."""

    def make():
        def step(emit, a, b, mine, other):
            x, y = np.frombuffer(mine, np.int64), np.frombuffer(other, np.int64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            total = len(x) + len(y) - shared
            emit(a, b, 100 * shared >= percent * total, 1 - shared / total)

        return step

    mine = sets.select(F.col("sid").alias("b"), F.col("grams").alias("mine"))
    other = sets.select(F.col("sid").alias("a"), F.col("grams").alias("other"))
    joined = mine.join(pairs, "b").join(other, "a").select("a", "b", "mine", "other")
    return stage(map_rows(joined, "a long, b long, linked boolean, distance double", make).distinct(), "compared")


def similarity_classes(
    docs: DataFrame, id_col: str, text_col: str, size: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: id, n (size of the set), component_id.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    distinct ``size``-word n-grams; ``component_id`` is the smallest id that links reach, the
    own one included. A document without words, or a null text, has an empty set and is
    linked with nothing. Rows of equal texts are linked, also if they share an id. Null ids
    are never the smallest, unless a class has no other. Other columns are left behind.
    """
    spark = docs.sparkSession
    profile = _profile(docs, id_col, text_col, size)
    rows = profile.where("counts is null")
    full = rows.where("n > 0")
    clash = full.groupBy("sid").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high")
    entries = full.agg(F.sum(F.expr(f"least(n, n - (n * {percent} + 99) div 100 + 1 + n div {SPARE})")).alias("n")).first()["n"] or 0
    if entries and clash.head(1):
        raise ValueError("two different sets have the same 64-bit id")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-entries // BUCKET)))
    labels = _classes(docs, text_col, size, percent, profile, full, buckets) if entries else None
    if labels is None:
        named = full.withColumn("component", F.col("sid"))
    else:
        named = full.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    return (
        named.join(smallest, "component").select("id", "n", "component_id")
        .unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
        .withColumnRenamed("id", id_col)
    )


def _classes(docs, text_col, size, percent, profile, full, buckets) -> DataFrame | None:
    """(node, component) of the sets that are linked with others; None if there are none."""
    lists = _lists(docs, text_col, size, percent, _sketch(profile), buckets)
    least = f"(n * {percent} + 99) div 100"  # n-grams of the smallest set that one of n can be linked with
    lists = pruned(lists, F.expr(f"least({least}, 1 + {least} div {SPARE})"))
    keys = full.groupBy("sid").agg(F.min("text_key").alias("text_key"))
    wanted = few(lists.select("sid").distinct().join(keys, "sid").select("text_key").distinct(), "wanted")
    sets = _sets(docs, text_col, size, wanted)
    return classes(
        lists, lambda a, b: _may_reach(percent, a, b), lambda pairs: _compared(pairs, sets, percent),
        lambda p, q: F.abs(p - q) > 1 - percent / 100 + 1e-9,
        rank=F.col("lost") / F.col("n"),
        need=F.expr(f"least((high * {percent} + 99) div 100, 1 + low div {SPARE})"),
        block=_block(percent),
        alive=F.expr(f"(n - lost) * {100 + percent} >= (n + greatest(least_n, (n * {percent} + 99) div 100)) * {percent}"),
        marks=few(sets.select("sid", *MARKS).distinct(), "marks"),
        differ=lambda a, b: _differ(percent, a, b),
    )
