"""Long strings that an earlier document also has, by sparse suffix arrays in levels.

Of every ``LENGTH`` consecutive bytes, the ``GRAM`` bytes with the smallest hash are the
anchor, so equal strings have equal anchors at equal offsets, and about one suffix in twenty
starts at an anchor. Only those suffixes are kept, ordered by the hash of their first
``GRAM`` bytes: a sparse suffix array. Neighbouring strings with the same anchor make one
piece of text.

1. Copies of a whole text are one text from the start, with the smallest id of them.
2. The texts are written in batches; each batch gets its suffix array. The arrays are dealt
   by hash to buckets. There each new batch's array is merge-scanned against the levels, for
   the anchors that both have, and then becomes a level; levels of equal size are merged, so
   there are as many as the number of batches has binary digits.
3. Pieces around shared anchors, and only those, meet by anchor. There the strings in them
   are compared byte by byte, and what an earlier document has is marked.

A batch sends one piece for all its copies of it, so what meets is bound by the number of
batches; around an anchor that very many batches share, strings are dealt anew, by a longer
anchor in each. Where pieces would take far more room than the texts, they are sent in rounds,
each of a share of the anchors.
"""

from __future__ import annotations

import sys
import zlib
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm import files
from skewdex.llm.arrow import map_rows, task_number
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, GRAM = 50, 16
#: Bytes of text in a batch, anchors in a bucket, and pieces that a task holds.
BATCH, BUCKET, HELD = 32 << 20, 1 << 21, 150_000
#: An anchor in more batches than this is dealt by anchors of so many bytes.
HOT, FINE = 256, 32
#: Bytes that a piece takes as it is sent, and how often the size of the texts a round of them may have.
PIECE, ROUND = 80, 2
#: Strings whose places are found at once.
SEGMENT = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5)]
_SPAN = np.dtype([("place", "<i4"), ("start", "<i4"), ("end", "<i4")])


def _windows(x: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` over every ``width`` neighbours, by doubling; ``join`` must not mind repeats."""
    reach = 1
    while reach * 2 <= width:
        x, reach = join(x[:-reach], x[reach:]), reach * 2
    return join(x[: len(x) - (width - reach)], x[width - reach :]) if reach < width else x


def pieces(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each piece, and the hash of its anchor.

    Every string of ``length`` bytes lies in exactly one piece that is its anchor's, and
    which anchor that is depends on the string alone. ``gram`` is 16 or 32.
    """
    found = []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw) - length + 1, SEGMENT):
        h = _BYTES[raw[at : at + SEGMENT + length - 1]]
        reach = 1
        for odd in _ODD[: gram.bit_length() - 1]:  # of 16 or 32 bytes, by doubling
            h, reach = h[:-reach] * odd + h[reach:], reach * 2
        h ^= h >> np.uint64(32)
        h *= _ODD[0]
        h ^= h >> np.uint64(29)
        least = _windows((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1, np.minimum)
        start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        end = np.append(start[1:], len(least)) + length - 1
        found.append((start + at, end + at, h[(least[start] & _PLACE).astype(np.int64)] & ~np.uint64(1)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


class Levels:
    """Sorted arrays of which no two have nearly the same size."""

    def __init__(self):
        self.arrays: list[np.ndarray] = []

    def add(self, new: np.ndarray) -> list[np.ndarray]:
        """Merge-scan a sorted array against all levels; returns what it shares with each."""
        shared = [np.intersect1d(new, level, assume_unique=True) for level in self.arrays]
        while self.arrays and len(self.arrays[-1]) < 2 * len(new):
            new = np.union1d(self.arrays.pop(), new)
        self.arrays.append(new)
        return shared


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Staged (batch, place, id, hash, text): each different text with its smallest id."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("hash", F.unhex(F.md5("text")))
    once = rows.groupBy("hash", "text").agg(F.min("id").alias("id")).select("id", "hash", F.col("text").cast("binary").alias("text"))

    def make():
        batch, place, held = task_number() << 24, 0, 0

        def step(emit, doc, key, text):
            nonlocal batch, place, held
            if held and held + len(text) > BATCH:
                batch, place, held = batch + 1, 0, 0
            emit(batch, place, doc, key, text, size=64 + len(text))
            place, held = place + 1, held + len(text)

        return step

    return stage(map_rows(once, "batch long, place int, id long, hash binary, text binary", make), "texts", packed=True)


#: Stands for a null id, which comes after all others.
_LAST = (1 << 63) - 1


class _Shared:
    """What was written for a batch, read when the batch comes."""

    def __init__(self, folder: str, dtype, of=lambda found: found):
        self.folder, self.dtype, self.part, self.batch, self.value = folder, dtype, of, None, None
        self.system, self.path = files.at(folder)

    def of(self, batch: int) -> np.ndarray:
        if batch != self.batch:
            name = f"{self.path}/{batch}.bin"
            found = self.system.get_file_info(name).is_file
            if found:
                with self.system.open_input_file(name) as file:
                    self.value = self.part(np.frombuffer(file.read(), self.dtype))
            else:
                self.value = np.empty(0, self.dtype)
            self.batch = batch
        return self.value


def _write_by_batch(rows: DataFrame, folder: str, dtype, key: str) -> int:
    """Write the arrays (batch, packed) of each batch to one file, ordered by ``key``; returns their length."""
    files.at(folder)[0].create_dir(files.at(folder)[1], recursive=True)

    def make():
        now, parts = None, []

        def flush(emit):
            if parts:
                whole = np.concatenate([np.frombuffer(p, dtype) for p in parts])
                out = files.Output(folder, f"{now}.bin")
                out.write((np.sort(whole) if key is None else whole[np.argsort(whole[key], kind="stable")]).tobytes())
                out.close()
                emit(now, len(whole))
                parts.clear()

        def step(emit, batch, packed):
            nonlocal now
            if batch != now:
                flush(emit)
                now = batch
            parts.append(packed)

        step.close = flush
        return step

    dealt = rows.repartition("batch").sortWithinPartitions("batch")
    return stage(map_rows(dealt, "batch long, n long", make), "written").agg(F.sum("n")).first()[0] or 0


def _shared_anchors(texts: DataFrame, folder: str, length: int, buckets: int) -> int:
    """Write for each batch which of its anchors another document has too; returns how many these are."""

    def arrays():
        now, held = None, []

        def flush(emit):
            if not held:
                return
            anchors, n = np.unique(np.concatenate(held), return_counts=True)  # the batch's suffix array
            held.clear()
            anchors |= (n > 1).astype(np.uint64)  # two documents of the batch have it
            place = (anchors >> np.uint64(24)) % np.uint64(buckets)
            order = np.argsort(place, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
                emit(int(place[run[0]]), now, anchors[run].tobytes(), size=8 * len(run))

        def step(emit, batch, text):
            nonlocal now
            if batch != now:
                flush(emit)
                now = batch
            found = np.unique(pieces(text, length)[2])
            if len(found):
                held.append(found)

        step.close = flush
        return step

    def merge():
        now, runs = None, []

        def flush(emit):
            if not runs:
                return
            levels, shared = Levels(), [np.empty(0, np.uint64)]
            for _, run in runs:
                anchors = run & ~np.uint64(1)
                shared.append(anchors[(run & np.uint64(1)) > 0])
                shared += levels.add(anchors)
            known = np.unique(np.concatenate(shared))
            mine = [(batch, np.intersect1d(run & ~np.uint64(1), known, assume_unique=True)) for batch, run in runs]
            n = np.zeros(len(known), np.int64)
            for _, found in mine:
                n[np.searchsorted(known, found)] += 1
            runs.clear()
            for batch, found in mine:
                hot = n[np.searchsorted(known, found)] > HOT
                if len(found):
                    emit(batch, (found | hot.astype(np.uint64)).tobytes(), size=8 * len(found))

        def step(emit, bucket, batch, packed):
            nonlocal now
            if bucket != now:
                flush(emit)
                now = bucket
            runs.append((batch, np.frombuffer(packed, np.uint64)))

        step.close = flush
        return step

    found = map_rows(texts.select("batch", "text"), "bucket int, batch long, packed binary", arrays)
    dealt = found.repartition(buckets, "bucket").sortWithinPartitions("bucket", "batch")
    return _write_by_batch(map_rows(dealt, "batch long, packed binary", merge), folder, np.uint64, None)


def _runs(marks: list[bool]) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], marks, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def earlier_strings(found: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For each (text, id), the parts of the text covered by strings that a smaller id has."""
    first: dict[bytes, int] = {}
    for text, doc in found:
        first[text] = min(doc, first.get(text, _LAST))
    if len(first) == 1:
        return [[(0, len(text))] if first[text] < doc else [] for text, doc in found]
    # By ascending id, strings are looked up among those of smaller ids, before they join them.
    earlier: set[bytes] = set()
    parts: dict[bytes, list[tuple[int, int]]] = {}
    for _, same in groupby(sorted(first.items(), key=itemgetter(1)), key=itemgetter(1)):
        strings = {text: [text[at : at + length] for at in range(len(text) - length + 1)] for text, _ in same}
        for text, each in strings.items():
            parts[text] = [] if earlier.isdisjoint(each) else _covered(each, earlier, length)
        earlier.update(chain.from_iterable(strings.values()))
    return [[(0, len(text))] if first[text] < doc else parts[text] for text, doc in found]


def _covered(strings: list[bytes], earlier: set[bytes], length: int) -> list[tuple[int, int]]:
    """The parts of a text that those of its strings cover that are in ``earlier``, by runs of them."""
    out, begin = [], None
    for at, string in enumerate(strings):
        if string in earlier:
            begin = at if begin is None else begin
        elif begin is not None:
            out.append((begin, at - 1 + length))
            begin = None
    if begin is not None:
        out.append((begin, len(strings) - 1 + length))
    return out


def _mark(texts: DataFrame, shared: str, folder: str, length: int, buckets: int, share: tuple[int, int] = (0, 1)) -> None:
    """Write for each batch the spans of its texts that an earlier document has.

    ``share`` is the round and the number of rounds; spans are those around the round's anchors.
    """
    row = "deal long, batch long, n int, size int, packed binary"

    def spread():
        anchors = _Shared(shared, np.uint64, lambda known: known[(known >> np.uint64(40)) % np.uint64(share[1]) == share[0]])
        now, held, spans = None, {}, []

        def keep(deal, data, doc, place, start):
            """Only the smallest id sends a piece; all others of the batch are marked here."""
            entry = held.get(data)
            if entry is None or doc < entry[1]:
                if entry:
                    spans.extend((p, s, s + len(data)) for p, s in entry[2])
                held[data] = (deal, doc, [(place, start)])
            elif doc == entry[1]:
                entry[2].append((place, start))
            else:
                spans.append((place, start, start + len(data)))

        def flush(emit):
            nonlocal spans
            if spans:
                packed = np.array(spans, _SPAN).tobytes()
                emit(zlib.crc32(packed), now, 0, len(packed), packed, size=len(packed))
            spans = []
            by_bucket: dict[int, list] = {}
            for data, (deal, doc, owners) in held.items():
                by_bucket.setdefault(deal % buckets, []).append((deal, data, doc, owners))
            held.clear()
            for bucket, entries in by_bucket.items():
                parts = [
                    np.array([e[0] for e in entries], np.uint64).tobytes(), np.array([e[2] for e in entries], np.int64).tobytes(),
                    np.array([len(e[1]) for e in entries], np.int32).tobytes(), np.array([len(e[3]) for e in entries], np.int32).tobytes(),
                    np.array([o for e in entries for o in e[3]], np.int32).tobytes(), *[e[1] for e in entries],
                ]
                whole = b"".join(parts)
                # In the shuffle's own codec, which is a fast one, texts take almost as much room as they are long.
                packed = pa.compress(whole, codec="zstd", asbytes=True)
                emit(bucket, now, len(entries), len(whole), packed, size=len(packed))

        def step(emit, batch, place, doc, text):
            nonlocal now
            if batch != now or len(held) > HELD:
                flush(emit)
                now = batch
            known = anchors.of(batch)
            start, end, anchor = pieces(text, length)
            if not len(known) or not len(start):
                return
            at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
            hit = known[at] & ~np.uint64(1) == anchor
            hot = hit & (known[at] & np.uint64(1) > 0)
            for a, b, deal in zip(*(x[hit & ~hot].tolist() for x in (start, end, anchor)), strict=True):
                keep(deal >> 1, text[a:b], doc, place, a)
            if not hot.any():
                return
            finer = pieces(text, length, FINE)
            first, last = np.searchsorted(finer[0], start[hot], "right") - 1, np.searchsorted(finer[0], end[hot] - length, "right")
            for a, b, i, j in zip(*(x.tolist() for x in (start[hot], end[hot], first, last)), strict=True):
                for x, y, deal in zip(*(part[i:j].tolist() for part in finer), strict=True):
                    keep(deal >> 1, text[max(a, x) : min(b, y)], doc, place, max(a, x))

        step.close = flush
        return step

    def meet():
        now, held, out, n_out = None, {}, {}, 0

        def give(emit):
            nonlocal n_out
            for batch, spans in out.items():
                packed = np.array(spans, _SPAN).tobytes()
                emit(batch, packed, size=len(packed))
            out.clear()
            n_out = 0

        def flush(emit):
            nonlocal n_out
            for entries in held.values():
                if len(entries) > 1:
                    for (_, _, batch, owners), parts in zip(entries, earlier_strings([e[:2] for e in entries], length), strict=True):
                        for place, start in owners if parts else ():
                            out.setdefault(batch, []).extend((place, start + a, start + b) for a, b in parts)
                            n_out += len(parts)
                if n_out > HELD:
                    give(emit)
            held.clear()

        def step(emit, deal, batch, n, size, packed):
            nonlocal now
            if not n:
                emit(batch, packed, size=len(packed))
                return
            if deal != now:
                flush(emit)
                now = deal
            packed = pa.decompress(packed, size, "zstd", asbytes=True)
            keys, ids = np.frombuffer(packed, np.uint64, n), np.frombuffer(packed, np.int64, n, 8 * n)
            sizes, owned = np.frombuffer(packed, np.int32, 2 * n, 16 * n).reshape(2, n)
            pairs = np.frombuffer(packed, np.int32, 2 * int(owned.sum()), 24 * n).reshape(-1, 2)
            at, of = 24 * n + pairs.nbytes, 0
            for key, doc, size, owners in zip(keys.tolist(), ids.tolist(), sizes.tolist(), owned.tolist(), strict=True):
                held.setdefault(key, []).append((packed[at : at + size], doc, batch, pairs[of : of + owners].tolist()))
                at, of = at + size, of + owners

        def close(emit):
            flush(emit)
            give(emit)

        step.close = close
        return step

    sent = map_rows(texts.select("batch", "place", "id", "text"), row, spread)
    dealt = sent.repartition(buckets, "deal").sortWithinPartitions(F.col("n") > 0, "deal")
    _write_by_batch(map_rows(dealt, "batch long, packed binary", meet), folder, _SPAN, "place")


def _cut(texts: DataFrame, folders: list[str]) -> DataFrame:
    """(hash, id, kept, spans) of each different text, by what was marked in each round."""

    def make():
        marked, now, spans, places = [_Shared(folder, _SPAN) for folder in folders], None, None, None

        def step(emit, batch, place, doc, key, text):
            nonlocal now, spans, places
            if batch != now:
                spans = np.concatenate([each.of(batch) for each in marked])
                spans = spans[np.argsort(spans["place"], kind="stable")] if len(marked) > 1 else spans
                now, places = batch, np.ascontiguousarray(spans["place"])
            a, b = np.searchsorted(places, [place, place + 1])
            if a == b:
                emit(key, doc, text, [], size=64 + len(text))
                return
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, spans["start"][a:b], 1)
            np.add.at(edge, spans["end"][a:b], -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            emit(key, doc, kept, [list(r) for r in _runs(gone)], size=64 + len(kept))

        return step

    schema = T.StructType.fromDDL("hash binary, first_id long, kept binary, spans array<array<long>>")
    return map_rows(texts.select("batch", "place", "id", "hash", "text"), schema, make)


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept.

    Texts are taken as UTF-8 bytes; null counts as empty. Each byte goes that is covered by a
    string of ``length`` bytes which also starts in a document with a smaller id, as the
    texts are given. ``n_spans`` counts the maximal removed runs, and ``kept`` has the other
    bytes. Ids are integers; a null id comes after all others, and rows of the same id don't
    affect each other. ``length`` is at least 32. Other columns are left behind.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {length} bytes are too short for anchors of {GRAM}")
    spark: SparkSession = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * BUCKET)))
    shared = files.new_folder(spark, "anchors")
    rounds = max(1, -(-_shared_anchors(texts, shared, length, buckets) * PIECE // max(1, ROUND * total)))
    marked = [files.new_folder(spark, "marked") for _ in range(rounds)]
    for at, folder in enumerate(marked):
        _mark(texts, shared, folder, length, buckets, (at, rounds))
    files.remove(shared)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("order"),
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("hash"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
    )
    copy = (F.col("order") > F.col("first_id")) & (F.col("n_bytes") >= length)
    left = F.octet_length("kept").cast("long")
    return rows.join(_cut(texts, marked), "hash").select(
        F.col("id").alias(id_col), "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("n_bytes") - left).alias("n_removed"),
        F.when(copy, 1).otherwise(F.size("spans")).cast("long").alias("n_spans"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
