"""Lists of sets (or strings) under the keys they share, and classes of similar ones.

An entry is (key, sid, n, pos): a key of the one called ``sid``, whose size is ``n``, with a
place. Similar ones share a key. Entries are packed into arrays, dealt to buckets by key, and
those whose key nobody shares go there. Lists are cut into blocks by size, so that similar ones
are in the same block or in neighbouring ones. Then classes are made, and answers derived from
those of similar ones:

* within a block all are first compared with one pivot only, the one that has lost the least
  of what it could share, and those found similar to it are one class; no pair inside a class
  is looked at again;
* a few rounds compare classes by their representatives;
* entries that no partner of their block could reach are skipped, before any pair is made;
* then every pair of a block that could still link two classes is compared, unless what is
  known about both, or a few bits that each has in its entries, rule it out.

A group of near copies so costs a number of comparisons in proportion to its size.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skewdex.llm.arrow import released
from skewdex.llm.components import components
from skewdex.operators.joins import BROADCAST_ROWS
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries that a bucket holds, and a task before it hands them out.
BUCKET, HELD = 1 << 20, 1 << 19
#: Of a key with more entries than this in one task, all but two go past the buckets.
LONG = 64
#: Rounds in which classes are compared by representatives.
ROUNDS = 2
#: A block of a list as host, with the block before it as guest.
CELL = ["key", "cell"]
ENTRY = np.dtype([("key", "<i8"), ("sid", "<i8"), ("n", "<i4"), ("pos", "<i4")])
PACKED = "bucket int, packed binary"
LISTED = "key long, sid long, n int, pos int"
#: Entries that a task hands out at once.
EMITTED = 1 << 16


def _ordered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different entries by key and sid, where each key begins, and its number of entries.

    Of equal ones the first stays. Empties ``parts``, so that not all copies are held at once.
    """
    entries = np.concatenate(parts)
    parts.clear()
    key = np.ascontiguousarray(entries["key"])
    order = np.argsort(key)
    key = key[order]
    again = np.flatnonzero(key[1:] == key[:-1])
    if len(again):  # only keys of several entries are sorted further
        several = np.zeros(len(key), bool)
        several[again] = several[again + 1] = True
        at = order[several]
        order[several] = at[np.lexsort((at, entries["sid"][at], key[several]))]
    entries = entries[order]
    other, once = np.ones(len(entries), bool), np.ones(len(entries), bool)
    np.not_equal(entries["key"][1:], entries["key"][:-1], out=other[1:])
    np.not_equal(entries["sid"][1:], entries["sid"][:-1], out=once[1:])
    once |= other
    if not once.all():
        entries, other = entries[once], other[once]
    new = np.flatnonzero(other)
    return entries, new, np.diff(np.append(new, len(entries)))


class Packer:
    """Holds entries and hands them out by bucket; for use within a task."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.n = buckets, [], 0

    def add(self, entries: np.ndarray, emit) -> None:
        self.held.append(entries)
        self.n += len(entries)
        if self.n >= HELD:
            self.flush(emit)

    def flush(self, emit) -> None:
        if not self.held:
            return
        entries, new, length = _ordered(self.held)
        self.n = 0
        rank = np.arange(len(entries)) - np.repeat(new, length)
        past = (np.repeat(length, length) > LONG) & (rank >= 2)  # the two that stay show the key is shared
        place = np.where(past, -1, (entries["key"] >> 20) % self.buckets)
        order = np.argsort(place.astype(np.int16) if self.buckets < 1 << 15 else place, kind="stable")
        for run in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            emit(int(place[run[0]]), entries[run].tobytes(), size=len(run) * ENTRY.itemsize)


def shared(packed: DataFrame, buckets: int) -> DataFrame:
    """Staged (key, sid, n, pos): the packed entries whose key more than one ``sid`` has."""

    out = to_arrow_schema(T.StructType.fromDDL(LISTED))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def flush():
            if parts:
                entries, _, length = _ordered(parts)
                if now >= 0:
                    entries = entries[np.repeat(length > 1, length)]
                for at in range(0, len(entries), EMITTED):  # columns of a slice at a time, never a bucket as Python numbers
                    some = entries[at : at + EMITTED]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(some[c])) for c in ENTRY.names], schema=out)

        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now or now < 0:
                    yield from flush()
                    now = bucket
                parts.append(np.frombuffer(packed.as_py(), ENTRY))
        yield from flush()

    anywhere = F.pmod(F.xxhash64("packed"), F.lit(buckets)).cast("int")
    place = F.when(F.col("bucket") < 0, anywhere).otherwise(F.col("bucket"))
    dealt = packed.repartitionById(buckets, place).sortWithinPartitions("bucket")
    return stage(dealt.mapInArrow(released(gather), LISTED).distinct(), "lists")


def pruned(lists: DataFrame, need: Column, times: int = 2) -> DataFrame:
    """(key, sid, n, pos, lost) without those that stand in fewer lists than ``need``, and what they leave alone.

    ``need`` is an expression of ``n``. ``lost`` is how many keys of the same one, at places
    before ``pos``, are in no list any more: they are shared with none that is similar.
    """
    own = Window.partitionBy("sid")
    for at in range(times):
        left = lists.withColumn("n_lists", F.count(F.lit(1)).over(own)).where(F.col("n_lists") >= need).drop("n_lists")
        several = left.groupBy("key").agg(F.count(F.lit(1)).alias("n_sids")).where("n_sids > 1")
        lists = left.join(several.select("key"), "key", "left_semi")
        if at == times - 1:
            lists = lists.withColumn("lost", F.col("pos") - F.row_number().over(own.orderBy("pos")) + 1)
        lists = stage(lists, "lists")
    return lists


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A staged table and its number of rows."""
    seen = Observation()
    return stage(df.observe(seen, F.count(F.lit(1)).alias("n")), name), seen.get["n"]


def few(df: DataFrame, name: str) -> DataFrame:
    """A staged table of narrow rows, broadcast if it has few of them."""
    table, n = counted(df, name)
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def classes(
    lists: DataFrame, may_link: Callable[[str, str], Column], compare: Callable[[DataFrame], DataFrame],
    apart: Callable[[Column, Column], Column] | None = None, rank: Column | None = None,
    need: Column | None = None, block: Column | None = None, alive: Column | None = None,
    marks: DataFrame | None = None, differ: Callable[[str, str], Column] | None = None,
) -> DataFrame | None:
    """(node, component): the class of each ``sid`` that is linked with another; None if none is.

    ``may_link(a, b)`` says whether two entries of a list (structs of all columns but the key)
    could be similar. ``compare`` takes pairs (a, b) and returns a staged (a, b, linked, distance).
    ``apart(p, q)`` says whether two whose distances from a third are p and q can't be similar.
    Pivots and representatives are the entries with the least ``rank``, then ``sid``. Two must
    share at least ``need`` lists to be similar, an expression of their sizes, ``low`` and ``high``.
    ``block`` is a whole number that grows with ``n``: similar ones are in the same block or the
    next. ``alive`` says of an entry whether a partner in a block whose least size is ``least_n``
    could reach it. ``marks`` has a row for each ``sid``, with columns by which ``differ(a, b)`` tells
    that two entries can't be similar: no pair is made of those.
    """
    rank = F.lit(0) if rank is None else rank
    fields = [c for c in lists.columns if c != "key"]
    guest = F.lit(0) if block is None else F.explode(F.array(F.lit(0), F.lit(1)))
    tested, labels, turn = None, None, 0
    while True:
        entries = lists if labels is None else lists.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        entries = entries.withColumn("component", F.col("sid") if labels is None else F.coalesce("component", "sid"))
        if labels is not None:  # lists of a single class have been answered
            ends = entries.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            entries = stage(entries.join(ends.where("low <> high").select("key"), "key"), "entries")
            lists = entries.drop("component")  # classes only grow: what is answered stays so
        entries = entries.withColumn("guest", guest).withColumn("cell", F.lit(0) if block is None else block.cast("int") + F.col("guest"))
        last = turn >= ROUNDS
        if last:
            found = _rest(entries, fields, may_link, tested, apart, need, alive, marks, differ)
        else:
            found = _with_pivots(entries, fields, may_link, tested, rank)
        pairs, n = counted(found, "pairs")
        if n:
            found = compare(F.broadcast(pairs) if n <= BROADCAST_ROWS else pairs)
            tested = found if tested is None else tested.unionByName(found)
            if found.where("linked").head(1):
                labels = stage(components(tested.where("linked")), "labels")
        if last:
            return labels
        turn = turn + 1 if n else ROUNDS  # further rounds would find nothing either


def _with_pivots(entries: DataFrame, fields: list[str], may_link, tested: DataFrame | None, rank: Column) -> DataFrame:
    """(a, b): each class's representative in a cell with the cell's pivot, the best pivot for each b."""
    named = entries.groupBy(*CELL, "component").agg(F.min(F.struct(rank.alias("rank"), *fields)).alias("b"))
    pivots = named.groupBy(*CELL).agg(F.min("b").alias("a"), F.min_by("component", "b").alias("pivot"))
    met = named.join(pivots, CELL).where((F.col("component") != F.col("pivot")) & may_link("a", "b"))
    met = met.groupBy(F.col("a.sid").alias("a"), F.col("b.sid").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("a.rank").alias("rank"))
    if tested is not None:
        met = met.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return met.groupBy("b").agg(F.max(F.struct("n", -F.col("rank"), "a"))["a"].alias("a")).select("a", "b")


def _rest(
    entries: DataFrame, fields: list[str], may_link, tested: DataFrame | None, apart, need: Column | None, alive: Column | None,
    marks: DataFrame | None, differ,
) -> DataFrame:
    """Every pair of a cell that could still link two classes, and was not compared.

    The largest class of a cell meets the others only, never itself, and guests meet hosts only.
    """
    each = entries
    if alive is not None:  # skipped without a pair
        least = each.groupBy(*CELL).agg(F.min("n").alias("least_n"))
        each = stage(each.join(least, CELL).where(alive).drop("least_n"), "alive")
    sizes = each.groupBy(*CELL, "component").agg(F.count(F.lit(1)).alias("members"), F.min("guest").alias("guest"))
    largest = sizes.groupBy(*CELL).agg(
        F.max(F.struct("members", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("n_classes"), F.min("guest").alias("hosts")
    )
    largest = largest.where("n_classes > 1 and hosts = 0").drop("n_classes", "hosts")
    each, link = each.join(largest, CELL), may_link("x", "y")
    if marks is not None:
        each, fields = each.join(marks, "sid"), [*fields, *(c for c in marks.columns if c != "sid")]
        link = link & ~differ("x", "y")
    # Written first, as all below: a plan that has its inputs several times over weighs on the driver.
    each = stage(each.select(*CELL, "component", "largest", "guest", F.struct(*fields).alias("e")), "met")
    others = each.where("component <> largest").select(*CELL, F.col("component").alias("of_a"), F.col("guest").alias("guest_a"), F.col("e").alias("x"))
    everyone = each.select(*CELL, F.col("component").alias("of_b"), "largest", F.col("guest").alias("guest_b"), F.col("e").alias("y"))
    met = others.join(everyone, CELL).where(
        (F.col("of_a") != F.col("of_b")) & ((F.col("of_b") == F.col("largest")) | (F.col("x.sid") < F.col("y.sid")))
        & (F.col("guest_a") + F.col("guest_b") < 2) & link
    )
    low, high = F.least("x.n", "y.n").alias("low"), F.greatest("x.n", "y.n").alias("high")
    pairs = (
        met.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b"), low, high)
        .groupBy("a", "b", "low", "high").agg(F.count(F.lit(1)).alias("n_lists"))
        .where(F.col("n_lists") >= (F.lit(1) if need is None else need))
        .select("a", "b")
    )
    if tested is None:
        return pairs
    pairs = stage(pairs, "possible")
    both = tested.select("a", "b", "distance").union(tested.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    pairs = pairs.join(both.select("a", "b"), ["a", "b"], "left_anti")
    if apart is None:
        return pairs
    of_a = both.select("a", F.col("b").alias("third"), F.col("distance").alias("p"))
    of_b = both.select(F.col("a").alias("b"), F.col("b").alias("third"), F.col("distance").alias("q"))
    known = pairs.join(of_a, "a").join(of_b, ["b", "third"]).where(apart(F.col("p"), F.col("q")))
    return pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
