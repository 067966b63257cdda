"""A toxicity classifier that scores a sentence alike whichever group it mentions.

Features are the presence of words and of the character five-grams inside words, hashed.
A logistic model is fitted to labelled texts with a further penalty: every labelled text
that names a group is written anew with the group's term swapped for another's, and the
squared difference of the two scores is charged. A term that merely goes along with insults
so gets no weight of its own, and a neutral mention no score.

The fit sees a bounded sample of labelled rows; scoring covers every row and whole texts.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewdex.llm.arrow import map_rows
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows of each label that the fit reads at most; chosen by a hash of their id.
SAMPLE = 6_000
#: Hash space of the features, and how many of them the model uses at most.
SPACE, USED = 1 << 22, 1 << 14
#: Slices of the hash space in which features are counted and judged.
SLICES = 16
SLICE = SPACE // SLICES
#: A feature must tell this much: chance alone hardly gets there, however many are tried.
TELLING = 15.0
#: Texts of this score or more are called toxic.
REJECT = 0.7
#: Terms for groups of people, in sets within which they are swapped.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "mexican"),
    ("immigrant", "native", "refugee", "foreigner"), ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young"), ("disabled", "abled"), ("deaf", "blind"),
)
WORD = re.compile(r"\w+")
SWAPS = {term: group[(at + 1) % len(group)] for group in IDENTITY for at, term in enumerate(group)}
#: Words whose features are remembered, and the characters of the longest of them.
REMEMBERED, REMEMBERED_CHARS = 60_000, 64


def features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its five-grams, with the ends marked."""
    marked = f"<{word}>"
    grams = {marked[at : at + 5] for at in range(len(marked) - 4)}
    return tuple({xxhash.xxh32_intdigest(g) % SPACE for g in (*grams, f"={word}")})


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _ids(words: set[str], known: dict[str, tuple[int, ...]]) -> bytes:
    if len(known) > REMEMBERED:
        known.clear()
    found: set[int] = set()
    for word in words:
        if (own := known.get(word)) is None:
            own = features(word)
            if len(word) <= REMEMBERED_CHARS:
                known[word] = own
        found.update(own)
    return np.fromiter(found, "<u4", len(found)).tobytes()


@dataclass(frozen=True)
class Model:
    """Weights of the features in use; of all others the weight is 0."""

    used: np.ndarray
    weights: np.ndarray
    bias: float


def _swapped(words: set[str]) -> set[str] | None:
    """The words of the counterfactual text; None if no group is named."""
    return {SWAPS.get(w, w) for w in words} if not words.isdisjoint(SWAPS) else None


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(row, y, own, other): features of at most about ``sample`` texts per label and of their counterfactuals.

    ``row`` grows in the order of the rows.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = known.groupBy(id_col).agg(F.max(label_col).alias("y"))  # toxic if anyone says so
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.lit(0.0)
    for y, n in counts.items():
        rate = F.when(F.col("y") == y, min(1.0, sample / n)).otherwise(rate)
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(17)), F.lit(1 << 30)) / (1 << 30)
    drawn = marked.where(place < rate)  # its size is bound by ``sample``, so it can be broadcast
    chosen = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(drawn), id_col)

    def make():
        known: dict[str, tuple[int, ...]] = {}

        def step(emit, y, text):
            words = words_of(text or "")
            other = _swapped(words)
            own = _ids(words, known)
            emit(int(y), own, None if other is None else _ids(other, known), size=64 + 2 * len(own))

        return step

    made = map_rows(chosen.select("y", "text"), "y int, own binary, other binary", make)
    return made.select(F.monotonically_increasing_id().alias("row"), "y", "own", "other")


def _told(seen: np.ndarray, pos: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The G statistic of features seen in ``seen`` texts, ``pos`` of them of label 1."""
    n = n1 + n0

    def part(found, margin, of):
        return np.where(found > 0, found * np.log(np.maximum(found, 1) * n / np.maximum(margin * of, 1)), 0.0)

    neg, none = seen - pos, n - seen
    return 2 * (part(pos, seen, n1) + part(neg, seen, n0) + part(n1 - pos, none, n1) + part(n0 - neg, none, n0))


def _telling(rows: DataFrame, n1: int, n0: int) -> np.ndarray:
    """The features in use, sorted: those that tell most about the label.

    They are counted and judged in tasks, slice by slice of the hash space; the driver gets
    the best of each slice only, as the counts of all features are a good part of its memory.
    """

    def count():
        seen, pos = np.zeros(SPACE, np.uint32), np.zeros(SPACE, np.uint32)

        def step(emit, y, own):
            ids = np.frombuffer(own, "<u4")
            seen[ids] += 1
            if y:
                pos[ids] += 1

        def close(emit):
            for number in range(SLICES):
                part = slice(number * SLICE, (number + 1) * SLICE)
                place = np.flatnonzero(seen[part])
                if len(place):
                    packed = np.stack([place.astype(np.uint32), seen[part][place], pos[part][place]]).tobytes()
                    emit(number, packed, size=len(packed))

        step.close = close
        return step

    def judge():
        totals: dict[int, np.ndarray] = {}

        def step(emit, number, packed):
            place, seen, pos = np.frombuffer(packed, np.uint32).reshape(3, -1)
            total = totals.setdefault(number, np.zeros((2, SLICE), np.int64))
            total[0, place] += seen
            total[1, place] += pos

        def close(emit):
            for number, (seen, pos) in totals.items():
                often = np.flatnonzero(seen > 1)
                told = _told(seen[often].astype(float), pos[often].astype(float), n1, n0)
                best = np.argsort(-told, kind="stable")[:USED]
                best = best[told[best] >= TELLING]
                emit((often[best] + number * SLICE).astype("<u4").tobytes(), told[best].astype("<f8").tobytes(), size=12 * len(best))

        step.close = close
        return step

    counted = map_rows(rows.select("y", "own"), "slice int, counts binary", count)
    found = map_rows(counted.repartitionById(SLICES, F.col("slice")), "ids binary, told binary", judge).collect()
    ids = np.concatenate([np.empty(0, "<u4"), *(np.frombuffer(r["ids"], "<u4") for r in found)])
    told = np.concatenate([np.empty(0), *(np.frombuffer(r["told"], "<f8") for r in found)])
    return np.sort(ids[np.lexsort((ids, -told))[:USED]])


def _placed(rows: DataFrame, used: np.ndarray) -> DataFrame:
    """(row, y, own, other) with the places in ``used`` of the features that are in it, in two bytes each."""

    def make():
        def places(ids: bytes) -> bytes:
            ids = np.frombuffer(ids, "<u4")
            at = np.minimum(np.searchsorted(used, ids), len(used) - 1)
            return at[used[at] == ids].astype("<u2").tobytes()

        def step(emit, row, y, own, other):
            own = places(own)
            emit(row, y, own, None if other is None else places(other), size=64 + 2 * len(own))

        return step

    return map_rows(rows, "row long, y int, own binary, other binary", make)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    sample: int = SAMPLE, fairness: float = 1.0, decay: float = 2e-4, rounds: int = 300,
) -> Model:
    """Fit to the labelled rows of ``docs``; ``labels`` has ``id_col`` and ``label_col`` (0 or 1).

    At most about ``sample`` rows per label are read. Without labels of both kinds, or
    without a word that tells them apart, the model scores everything near 0. A text that is null counts as empty.
    """
    rows = stage(training_rows(docs, labels, id_col, text_col, label_col, sample), "training")
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(np.empty(0, np.uint32), np.empty(0), -20.0)
    n1, n0 = counts[1], counts[0]
    used = _telling(rows, n1, n0)
    if not len(used):
        return Model(np.empty(0, np.uint32), np.empty(0), -20.0)
    rows = sorted(_placed(rows, used).collect(), key=lambda r: r["row"])
    y = np.array([r["y"] for r in rows], float)

    def matrix(texts):
        places = [np.frombuffer(p, "<u2") for p in texts]
        return np.repeat(np.arange(len(places), dtype=np.int32), [len(p) for p in places]), np.concatenate([*places, np.empty(0, "<u2")])

    row, col = matrix([r["own"] for r in rows])
    pairs = [r for r in rows if r["other"] is not None]
    row_a, col_a = matrix([r["own"] for r in pairs])
    row_b, col_b = matrix([r["other"] for r in pairs])
    pairs, rows = len(pairs), None

    each = np.where(y == 1, 0.5 / n1, 0.5 / n0)  # both labels weigh the same
    w, b = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, rounds + 1):  # Adam on all rows at once
        z = np.bincount(row, weights=w[col], minlength=len(y)) + b
        error = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g, gb = np.bincount(col, weights=error[row], minlength=len(used)) + decay * w, error.sum()
        if pairs:
            gap = np.bincount(row_a, weights=w[col_a], minlength=pairs) - np.bincount(row_b, weights=w[col_b], minlength=pairs)
            pull = 2 * fairness * gap / len(y)
            g += np.bincount(col_a, weights=pull[row_a], minlength=len(used)) - np.bincount(col_b, weights=pull[row_b], minlength=len(used))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fade, rise = 1 - 0.9**t, 1 - 0.999**t
        w = w - 0.05 * (m / fade) / (np.sqrt(v / rise) + 1e-8)
        b = b - 0.05 * (mb / fade) / (np.sqrt(vb / rise) + 1e-8)
    return Model(used, w, float(b))


def _scorer(model: Model):
    weight = dict(zip(model.used.tolist(), model.weights.tolist(), strict=True))
    known: dict[str, tuple[int, ...]] = {}

    def score_of(text: str | None) -> float:
        if len(known) > REMEMBERED:
            known.clear()
        found: set[int] = set()
        for word in words_of(text or ""):
            if (own := known.get(word)) is None:
                own = tuple(x for x in features(word) if x in weight)
                if len(word) <= REMEMBERED_CHARS:
                    known[word] = own
            found.update(own)
        z = model.bias + sum(weight[x] for x in sorted(found))
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))

    return score_of


def score(df: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """(``id_col``, score): from 0 to 1, higher if toxic is likelier; one row per row of ``df``.

    The whole text counts and nothing else. Null and empty texts get the score of a text
    without words.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("score", T.DoubleType())])

    def make():
        score_of = _scorer(model)
        return lambda emit, doc, text: emit(doc, score_of(text))

    return map_rows(df.select(F.col(id_col), F.col(text_col)), schema, make)


def with_score(df: DataFrame, text_col: str, model: Model, name: str) -> DataFrame:
    """``df`` with a column ``name``, the score of its text, as ``score`` gives it; no name may be twice."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    at = df.columns.index(text_col)

    def make():
        score_of = _scorer(model)

        def step(emit, *values):
            text = values[at]
            emit(*values, score_of(text), size=256 + 2 * len(text or ""))

        return step

    return map_rows(df, schema, make)
