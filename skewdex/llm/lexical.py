"""Ranked lexical search by two trees at once: the best documents for every item of a table.

A document's vector has, for each term of an item, the part of the score that depends on the
document; an item's vector has the term's weight; the score is their product. Both are put
into a hierarchy whose nodes hold the maximum of each coordinate: the product of two nodes'
maxima bounds every score between them. Pairs of nodes are opened from the top, and a pair
whose bound is below the weakest k-th score of its items so far is dropped with all that is
under it. All numbers are whole and below 2^53, so bounds and scores are exact in doubles.

Texts are cut once; what is staged is each document's length and its numbers of the items'
terms. Tasks search the documents they read, in blocks, and keep the best k of each item; the
best of these are the result. Items go by batches of bounded text, each with a pass of its
own, so that the vocabulary sent to the tasks is bounded however many items there are.

Cases: a null or empty text has no terms and is in no result; an item without terms, or with
none that any document has, gives no row. Rows of ``items`` with equal ids are one item with
the terms of all of them; a null id is an id. Each row of ``docs`` is a document, equal ids or
not; equal scores go by id, null last. Empty tables give an empty result. Further columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skewdex.llm.arrow import empty, map_rows
from skewdex.operators.ranking import keep_first
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Of UTF-8 in lower case: letters and digits of ASCII, and all that is beyond it.
TERM = re.compile(rb"[0-9a-z\x80-\xFF]+")
TOP = 10
#: Bytes of item texts that are searched for in one pass.
BATCH_BYTES = 4 << 20
#: Numbers in a block of documents' vectors, documents in it at most, and in a leaf.
BLOCK, BLOCK_DOCS, DOC_LEAF = 1 << 23, 2048, 16
#: Items in a leaf, and nodes below a node, of either tree.
ITEM_LEAF, FAN = 4, 8
#: Leaves of documents that are scored at once, the most promising first.
AT_ONCE = 8


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, repeats included."""
    return TERM.findall((text or "").encode().lower())  # of bytes: only A-Z


def counted_terms(docs: DataFrame, id_col: str, text_col: str, known: dict[bytes, int]) -> DataFrame:
    """(doc, n, ids, counts): number of terms, and the ``known`` ones with their occurrences, as packed numbers."""

    def make():
        number = known.get

        def step(emit, doc, text):
            found = terms(text)
            own = Counter(map(number, found))
            own.pop(None, None)
            ids, counts = np.fromiter(own.keys(), "<i4", len(own)), np.fromiter(own.values(), "<i4", len(own))
            emit(doc, len(found), ids.tobytes(), counts.tobytes(), size=64 + 8 * len(ids))

        return step

    schema = T.StructType([
        T.StructField("doc", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ])
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, make)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, and how many each row has."""
    n = np.array([len(v) for v in column.to_pylist()], np.int64) >> 2
    return np.frombuffer(b"".join(column.to_pylist()), "<i4"), n


def document_frequency(counted: DataFrame, known: int) -> DataFrame:
    """(term, df): documents that hold each of the ``known`` terms."""
    schema = T.StructType.fromDDL("term int, df long")
    out = to_arrow_schema(schema)

    def run(batches):
        total = np.zeros(known, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0))[0], minlength=known)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=out)

    # One row per term and task; the terms are those of a batch of items.
    return counted.select("ids").mapInArrow(run, schema).groupBy("term").agg(F.sum("df").alias("df"))


@dataclass(frozen=True)
class Level:
    """Nodes of a tree: the maxima of each, and the range of its children (or rows)."""

    maxima: np.ndarray
    first: np.ndarray
    last: np.ndarray


def tree(rows: np.ndarray, leaf: int) -> list[Level]:
    """Levels over consecutive rows, leaves first; the last one has at most ``FAN`` nodes."""
    levels, below, fan = [], rows, leaf
    while True:
        first = np.arange(0, len(below), fan)
        last = np.minimum(first + fan, len(below))
        below = np.maximum.reduceat(below, first, axis=0)
        levels.append(Level(below, first, last))
        if len(below) <= FAN:
            return levels
        fan = FAN


def _children(level: Level, nodes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.arange(level.first[n], level.last[n]) for n in nodes]) if len(nodes) else nodes


class Search:
    """The best documents so far for a batch of items; documents come in blocks."""

    def __init__(self, weights: np.ndarray, k: int):
        """``weights``: a row per item, a column per term."""
        self.k = k
        # Items whose heaviest terms are the same, or near in weight, become neighbours.
        heaviest = np.argsort(-weights, axis=1, kind="stable")[:, :2]
        self.order = np.lexsort((heaviest[:, 1] if weights.shape[1] > 1 else heaviest[:, 0], heaviest[:, 0]))
        self.weights = weights[self.order]
        self.items = tree(self.weights, ITEM_LEAF)
        self.columns = [np.flatnonzero(self.items[0].maxima[at]) for at in range(len(self.items[0].first))]
        self.best: list[list[tuple]] = [[] for _ in range(len(weights))]
        #: What a score must reach to count: at first anything above 0.
        self.least = np.ones(len(weights))

    def _needed(self, level: int) -> np.ndarray:
        """Per node of a level the weakest k-th score of its items."""
        needed = self.least
        for at in range(level + 1):
            needed = np.minimum.reduceat(needed, self.items[at].first)
        return needed

    def add(self, docs: list, rows: np.ndarray) -> None:
        """A block of documents; ``rows`` has their vectors, similar ones next to each other."""
        levels = tree(rows, DOC_LEAF)
        # Pairs of nodes as a table of item nodes by document nodes, opened level by level.
        item, doc = len(self.items) - 1, len(levels) - 1
        left = np.ones((len(self.items[item].first), len(levels[doc].first)), bool)
        while True:
            a, b = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
            if not len(a):
                return
            bound = np.zeros(left.shape)
            bound[np.ix_(a, b)] = self.items[item].maxima[a] @ levels[doc].maxima[b].T
            left &= bound >= self._needed(item)[:, None]
            if item == doc == 0:
                break
            if doc and (doc >= item or not item):
                left = np.repeat(left, levels[doc].last - levels[doc].first, axis=1)
                doc -= 1
            else:
                left = np.repeat(left, self.items[item].last - self.items[item].first, axis=0)
                item -= 1
        for node in np.flatnonzero(left.any(axis=1)):
            leaves = np.flatnonzero(left[node])
            leaves = leaves[np.argsort(-bound[node, leaves], kind="stable")]
            for at in range(0, len(leaves), AT_ONCE):
                some = leaves[at : at + AT_ONCE]
                first, last = self.items[0].first[node], self.items[0].last[node]
                some = some[bound[node, some] >= self.least[first:last].min()]
                if not len(some):
                    break
                at_rows = _children(levels[0], some)
                columns = self.columns[node]
                scores = rows[np.ix_(at_rows, columns)] @ self.weights[first:last, columns].T
                for item_at in np.flatnonzero((scores >= self.least[first:last]).any(axis=0)):
                    self._keep(first + item_at, docs, at_rows, scores[:, item_at])

    def _keep(self, item: int, docs: list, at_rows: np.ndarray, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least[item])
        found = [(-int(scores[at]), doc is None, "" if doc is None else doc) for at in good for doc in (docs[at_rows[at]],)]
        best = sorted(self.best[item] + found)[: self.k]
        self.best[item] = best
        if len(best) == self.k:
            self.least[item] = max(1, -best[-1][0])

    def results(self):
        """(row of ``weights``, document, score)."""
        for at, best in zip(self.order.tolist(), self.best):
            for score, unnamed, doc in best:
                yield at, None if unnamed else doc, -score


def search(counted: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc, score): the best ``k`` documents for each row of ``weights`` that each task has seen."""
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), counted.schema["doc"], T.StructField("score", T.LongType()),
    ])
    out = to_arrow_schema(schema)
    item, term = np.nonzero(weights)
    packed, shape = (item.astype(np.int32), term.astype(np.int32), weights[item, term]), weights.shape

    def run(batches):
        dense = np.zeros(shape)
        dense[packed[0], packed[1]] = packed[2]
        heaviest = dense.max(axis=0)
        # The place of each term among all, the heaviest first: documents lie by their heaviest terms.
        place = np.empty(shape[1], np.int64)
        place[np.argsort(-heaviest, kind="stable")] = np.arange(shape[1])
        best, size = Search(dense, k), max(DOC_LEAF, min(BLOCK_DOCS, BLOCK // max(1, shape[1])))

        def block(docs: list, n: np.ndarray, ids: np.ndarray, counts: np.ndarray, each: np.ndarray) -> None:
            own = np.repeat(np.arange(len(docs)), each)
            norm = 100 - 90 + (90 * n * n_docs) // n_terms
            parts = (1_000_000_000 * counts.astype(np.int64)) // (1000 * counts.astype(np.int64) + 8 * norm[own])
            start = np.cumsum(each) - each
            first = np.minimum.reduceat(place[ids], start)
            second = np.where(place[ids] == first[own], shape[1], place[ids])
            order = np.lexsort((np.minimum.reduceat(second, start), first))
            at = np.empty(len(docs), np.int64)
            at[order] = np.arange(len(docs))
            rows = np.zeros((len(docs), shape[1]))
            rows[at[own], ids] = parts
            best.add([docs[d] for d in order.tolist()], rows)

        for batch in batches:
            if not batch.num_rows:
                continue
            docs, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids, each = _numbers(batch.column(2))
            counts, _ = _numbers(batch.column(3))
            ends = np.cumsum(each)
            for lo in range(0, len(docs), size):
                hi = min(len(docs), lo + size)
                span = slice(int(ends[lo] - each[lo]), int(ends[hi - 1]))
                block(docs[lo:hi], n[lo:hi], ids[span], counts[span], each[lo:hi])
        found = list(best.results())
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[c] for row in found], f.type) for c, f in enumerate(out)], schema=out
        )

    # Documents without any of the terms score 0.
    some = counted.where(F.octet_length("ids") > 0).select("doc", "n", "ids", "counts")
    return some.mapInArrow(run, schema)


def _batch(rows: list, k: int, docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(item, doc, score) of some items, told by their place in ``rows``; None if there is nothing to find."""
    known: dict[bytes, int] = {}
    wanted = [sorted({known.setdefault(t, len(known)) for text in texts for t in terms(text)}) for texts in rows]
    if not known:
        return None
    counted = stage(counted_terms(docs, id_col, text_col, known), "terms")
    n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    # As many rows as a batch of items has terms.
    df = {r["term"]: r["df"] for r in document_frequency(counted, len(known)).collect()}
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(known))]
    if max(map(len, wanted)) * max(weight) * 1_000_000 >= 1 << 53:
        raise ValueError("an item has too many terms for exact scores")
    weights = np.zeros((len(rows), len(known)))
    for at, own in enumerate(wanted):
        weights[at, own] = [weight[t] for t in own]
    return search(counted, weights, n_docs, n_terms, k)


def rank(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, k: int = TOP,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``item_col``, ``rank``, ``id_col`` and ``score``: the ``k`` best documents for each item, from rank 1."""
    spark = docs.sparkSession
    asked = stage(items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")), "items")
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // batch_bytes)
    of = F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(max(1, n))).cast("int")
    parts = []
    for at in range(n):
        texts: dict = {}
        # About ``batch_bytes`` of text: the items are dealt to the batches by a hash.
        for row in asked.where(of == at).collect():
            texts.setdefault(row["item"], []).append(row["text"])
        part = _batch(list(texts.values()), k, docs, id_col, text_col) if texts else None
        if part is not None:
            name = spark.createDataFrame(list(enumerate(texts)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", asked.schema["item"].dataType)]))
            # As many rows as the batch has items.
            parts.append(stage(part, "found").join(F.broadcast(name), "item").select("name", "doc", "score"))
    if not parts:
        types = (asked.schema["item"].dataType, T.IntegerType(), docs.schema[id_col].dataType, T.LongType())
        return empty(spark, T.StructType([T.StructField(c, t) for c, t in zip((item_col, "rank", id_col, "score"), types)]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    # In two steps, so that no item's rows of all tasks meet in one.
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(64)))
    best = keep_first(keep_first(salted, ["name", "salt"], order, k, "_rank"), ["name"], order, k, "rank")
    return best.select("name", F.col("rank").cast("int").alias("rank"), "doc", "score").toDF(item_col, "rank", id_col, "score")
