"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has a bit set where over half of the hashes of its word shingles have it.
Different fingerprints are compared, not documents. Two within ``radius`` bits agree on all
but ``radius`` of the 4 segments of the 64 bits, whichever those are, so they meet in a bucket
of fingerprints that have the other segments in common. Buckets of more than ``BUCKET`` are
opened further: what is left of the bits is cut into segments again. Fingerprints are
different, so the last buckets are small by themselves, and a dense heap of them costs a
number of steps in proportion to its size; nothing is left out.

Inside buckets the bits are stored vertically, a plane of 64 fingerprints to a word for each
bit. A fingerprint meets 64 others at a time: its distances to them are counted by carry-save
adders, a word for each digit, and a word is abandoned once all its lanes exceed the radius.

Cases: only A-Z are lower-cased; words are separated by ASCII white space. A null or empty
text, or one of white space, has fingerprint zero, linked like any other; one of fewer words
than a shingle has the whole sequence as its only shingle. Repeated rows, and equal ids, are
documents each. A row whose id is null gets the component of its fingerprint but names none
(null if no document that it reaches has an id). Further columns, whatever their names, are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skewdex.llm.arrow import map_rows
from skewdex.llm.components import components
from skewdex.llm.lists import counted
from skewdex.operators.joins import lookup_join
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, SEED, WORDS, RADIUS = 64, 42, 3, 2
#: Fingerprints that are compared in one bucket at most; larger ones are opened further.
BUCKET = 512
#: Segments that the open bits of a bucket are cut into.
SEGMENTS = 4
#: Hashes whose bits are added up at once, and (fingerprint, word) cells compared at once.
HASHES, CELLS = 1 << 14, 1 << 15
#: Planes that are added between two looks at which cells may be abandoned.
LOOK = 6


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a whole text; shingles count as often as they occur."""
    found = (text or "").encode().lower().split()  # of bytes: only A-Z, only ASCII white space
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, HASHES):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(found[p : p + words]), SEED) for p in range(at, min(n, at + HASHES))), "<u8"
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """(doc, fp): the fingerprint of each row's whole text, as a signed number."""

    def make():
        def step(emit, doc, text):
            found = fingerprint(text, words)
            emit(doc, found - (1 << 64) if found >> 63 else found)

        return step

    schema = T.StructType([T.StructField("doc", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, make)


def _segments(bits: tuple[int, ...]) -> list[tuple[int, ...]]:
    return [tuple(part.tolist()) for part in np.array_split(np.array(bits, int), SEGMENTS)]


def _mask(bits: tuple[int, ...]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _ways(fixed: tuple[int, ...], radius: int) -> list[tuple[int, ...]]:
    """The bits that are equal in each of the next buckets, given those that are already."""
    open_bits = tuple(b for b in range(BITS) if b not in fixed)
    parts = _segments(open_bits)
    return [
        tuple(sorted(fixed + tuple(b for part in kept for b in part)))
        for kept in combinations(parts, len(parts) - radius)
    ]


# -- inside buckets ----------------------------------------------------------------------


def planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): bit b of 64 consecutive fingerprints in each word of row b."""
    width = -(-len(fps) // 64)
    padded = np.zeros(width * 64, "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(width, 64, 8), axis=2, bitorder="little")
    # From (word, lane, bit) to (bit, word, lane), and the lanes of a word packed.
    lanes = np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little")
    return lanes.view("<u8").reshape(BITS, width)


def _cells(ends: np.ndarray, at: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, word, lanes) of the queries at .. stop: the lanes of later entries of their bucket."""
    query = np.arange(at, stop)
    first, last = query + 1, ends[at:stop]
    some = first < last
    query, first, last = query[some], first[some], last[some]
    low, high = first >> 6, (last - 1) >> 6
    n = high - low + 1
    own = np.repeat(np.arange(len(query)), n)
    word = low[own] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    left = np.where(word == low[own], every << (first[own] & 63).astype(np.uint64), every)
    right = np.where(word == high[own], every >> (63 - ((last[own] - 1) & 63)).astype(np.uint64), every)
    return query[own], word, left & right


def close_pairs(fps: np.ndarray, ends: np.ndarray, radius: int = RADIUS):
    """Yields (i, j), i < j: the entries of a bucket at most ``radius`` bits apart.

    Buckets are runs of ``fps``, ``ends`` has for each entry where its bucket ends. Distances
    are counted in ``digits`` binary digits; what goes beyond them, or the radius, is marked.
    """
    plane = planes(fps)
    digits = max(1, (radius + 1).bit_length())
    longest = int((ends - np.arange(len(fps))).max(initial=1))
    chunk = max(1, CELLS // (longest // 64 + 1))
    for at in range(0, len(fps), chunk):
        query, word, lanes = _cells(ends, at, min(len(fps), at + chunk))
        own = fps[query]
        count = [np.zeros(len(word), np.uint64) for _ in range(digits)]
        beyond = ~lanes  # lanes that are out: of other buckets, or too far
        for b in range(BITS):
            # All ones where the fingerprint has the bit, so that equal bits give 0.
            carry = plane[b][word] ^ (np.uint64(0) - (own >> np.uint64(b) & np.uint64(1)))
            for digit in range(digits):
                count[digit], carry = count[digit] ^ carry, count[digit] & carry
            beyond |= carry | _more_than(count, radius)
            if b % LOOK == LOOK - 1 or b == BITS - 1:
                left = np.flatnonzero(beyond != np.uint64(0xFFFFFFFFFFFFFFFF))
                if len(left) < len(word):
                    query, word, own, beyond = query[left], word[left], own[left], beyond[left]
                    count = [c[left] for c in count]
            if not len(word):
                break
        if len(word):
            hit = np.unpackbits(np.ascontiguousarray(~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cell, lane = np.nonzero(hit)
            yield query[cell], word[cell] * 64 + lane


def _more_than(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count, of digits least first, is above ``radius``."""
    above, equal = np.zeros_like(count[0]), np.full_like(count[0], 0xFFFFFFFFFFFFFFFF)
    for digit in reversed(range(len(count))):
        if radius >> digit & 1:
            equal &= count[digit]
        else:
            above |= equal & count[digit]
            equal &= ~count[digit]
    return above


def _joined(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` after the links (i, j): of linked entries, all have the least label."""
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _links(radius: int):
    """From rows (key, fp) sorted by key to the links (a, b) of a spanning forest of each bucket."""
    schema = to_arrow_schema(T.StructType.fromDDL("a long, b long"))

    def compare(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = np.repeat(np.append(starts[1:], len(key)), np.diff(np.append(starts, len(key))))
        label = np.arange(len(key))
        for i, j in close_pairs(fp.view("<u8"), ends, radius):
            label = _joined(len(key), i, j, label)
        linked = np.flatnonzero(label != np.arange(len(key)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], schema=schema)

    def run(batches):
        keys, fps = np.empty(0, "<i8"), np.empty(0, "<i8")
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy()))
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield compare(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield compare(keys, fps)

    return run


def near_pairs(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame | None:
    """(a, b): links among the different ``fp``, enough of them to reach all that links reach.

    None if there are no two fingerprints in any bucket.
    """
    if not 0 <= radius < SEGMENTS:
        raise ValueError(f"radius must be 0 to {SEGMENTS - 1}")
    # (way, fp): the way names the bits that are equal in the buckets that fp goes to next.
    level, rows, found = [()], distinct.select(F.lit(0).alias("way"), "fp"), None
    while True:
        following = [(at, bits) for at, fixed in enumerate(level) for bits in _ways(fixed, radius)]
        keys = F.array(*[
            F.when(F.col("way") == at, F.struct(
                F.lit(to).alias("way"), F.xxhash64(F.lit(to), F.col("fp").bitwiseAND(F.lit(_mask(bits)))).alias("key")))
            for to, (at, bits) in enumerate(following)
        ])
        # A key is a hash: two buckets that share one are compared as one, which adds no link.
        placed = rows.select("fp", F.inline(F.filter(keys, lambda k: k.isNotNull())))
        sizes, n = counted(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
        if not n:
            return found
        met = stage(lookup_join(placed, sizes, ["key"], "n"), "met")
        small = met.where(F.col("n") <= bucket).select("key", "fp").repartition("key").sortWithinPartitions("key")
        links = stage(small.mapInArrow(_links(radius), "a long, b long").distinct(), "links")
        found = links if found is None else found.unionByName(links)
        rows, n = counted(met.where(F.col("n") > bucket).select("way", "fp").distinct(), "opened")
        if not n:
            return found
        level = [bits for _, bits in following]


def simhash_classes(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``: the smallest id that links of fingerprints reach.

    One row per row of ``docs``. See the module for the cases.
    """
    found = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    groups = stage(found.groupBy("fp").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprints")
    links = near_pairs(groups, radius)
    if links is None:
        named = groups.select("fp", "n", F.col("least").alias("component_id"))
    else:
        classes = stage(components(links), "classes")
        heads = groups.select("fp", "least").join(classes.withColumnRenamed("node", "fp"), "fp")
        least = heads.groupBy("component").agg(F.min("least").alias("component_id"))
        members = classes.join(least, "component").select(F.col("node").alias("fp"), "component_id")
        named = groups.join(members, "fp", "left").select("fp", "n", F.coalesce("component_id", "least").alias("component_id"))
    result = lookup_join(found, stage(named, "named"), ["fp"], "n")
    return result.select("doc", "fp", "component_id").toDF(id_col, "fp", "component_id")
