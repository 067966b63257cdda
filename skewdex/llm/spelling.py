"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters fall into groups. The trie arranges the words by their numbers of letters in the
first group, the second, and so on. One inserted, deleted or replaced letter changes these
numbers by a surplus of one in one group, a deficit of one in another, or both, or neither.
So a word finds its near words by going down the trie with a budget of one surplus and one
deficit, and the words at the leaves it gets to are verified.

Each pair is found once, from the side on which a surplus comes first; words of equal numbers
meet by their order. The first levels of the descent are taken by rows: a word goes to every
node that it may reach, as (node, word, state). Nodes of more than ``NODE`` words of their own
go on down by rows; in the others a task walks the trie depth-first, with all the words that
reach a branch at once. Where very many others reach such a node, they are cut into blocks, and
its own words go to each. A last node that is still too large holds words of equal numbers in
all groups; its words are cut into blocks, and each that reaches it meets every block.

Cases: a null or empty text has no words; repeated rows are documents each, and equal ids make
equal choices. A null id counts as the empty string where words are misspelt. Ties of the most frequent
near word go to the smallest in code-point order. Words are of any length and whole. Further
columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skewdex.llm.arrow import map_rows
from skewdex.llm.lists import counted
from skewdex.operators.joins import BROADCAST_ROWS
from skewdex.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: In Latin-1, where a letter is a byte; what is not in Latin-1 separates words.
LETTER = rb"[A-Za-z\xC0-\xFF]"
SHORTEST, LEAST, TIMES, EVERY = 7, 2, 10, 31
#: A letter's group is its code point modulo the number of groups; those of frequent letters come first.
GROUPS = 16
ORDER = np.array([5, 4, 14, 1, 9, 8, 15, 2, 3, 12, 13, 7, 0, 6, 11, 10])
#: Levels taken by rows at first, words of its own that a node has at most to be walked by a task, and
#: how many times as many may reach it there.
FIRST, NODE, CROWD = 3, 4096, 2
#: Words of a branch that are compared at once, and numbers (words by words by groups) held for it.
BRANCH, HELD = 48, 1 << 22
#: Distinct words a task holds before it hands their counts out, and letters of words compared in bulk.
WORDS_HELD, SHORT = 200_000, 32
EQUAL, SURPLUS, BOTH = 0, 1, 2
ROUTED = "node binary, word binary, n long, state byte"


def word_counts(docs: DataFrame, id_col: str, text_col: str, shortest: int = SHORTEST, every: int | None = EVERY) -> DataFrame:
    """(word, n): occurrences of each word in all texts, words as Latin-1 bytes.

    With ``every``, a word whose checksum with its document's id is divisible by it loses the
    letter that the checksum points at, so that misspelt words are there to be found.
    """

    # A shorter run is no word, whether it loses a letter or not: it is not even cut out.
    runs = re.compile(LETTER + b"{%d,}" % max(1, shortest))

    def make():
        counts: Counter[bytes] = Counter()

        def flush(emit):
            for word, n in counts.items():
                yield emit(word, n, size=48 + len(word))
            counts.clear()

        def step(emit, doc, text):
            if not text:
                return
            start = zlib.crc32(f"{doc}:".encode())
            for word, n in Counter(runs.findall(text.encode("latin-1", "replace").lower())).items():
                if every:
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                if len(word) >= shortest:
                    counts[word] += n
            if len(counts) > WORDS_HELD:
                yield from flush(emit)

        step.close = flush
        return step

    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return map_rows(docs.select(named, F.col(text_col)), "word binary, n long", make).groupBy("word").agg(F.sum("n").alias("n"))


# -- words in bulk -----------------------------------------------------------------------


class Words:
    """Some words as numbers of letters by group, and padded from the left and from the right."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(self.length) - self.length
        own = np.repeat(np.arange(len(words)), self.length)
        place = np.arange(len(flat)) - np.repeat(start, self.length)
        sums = np.bincount(own * GROUPS + flat % GROUPS, minlength=len(words) * GROUPS)
        # A clipped number differs by no more than the true one.
        self.groups = np.minimum(sums, 100).astype(np.int8).reshape(-1, GROUPS)[:, ORDER]
        self.left = np.zeros((len(words), SHORT), np.uint8)
        self.right = np.zeros((len(words), SHORT), np.uint8)
        near = place < SHORT
        self.left[own[near], place[near]] = flat[near]
        place = self.length[own] - 1 - place
        near = place < SHORT
        self.right[own[near], place[near]] = flat[near]


def one_edit(a: bytes, b: bytes) -> bool:
    """True if exactly one letter is inserted, deleted or replaced between the two."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((p for p, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def verified(words: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) are one edit apart."""
    short, long = np.minimum(words.length[i], words.length[j]), np.maximum(words.length[i], words.length[j])
    ends = np.ones((len(i), 1), bool)

    def alike(side: np.ndarray) -> np.ndarray:
        return np.argmax(np.concatenate((side[i] != side[j], ends), axis=1), axis=1)

    # All letters but one of the longer word are in what both begin or end with.
    apart = np.minimum(alike(words.left), short) + np.minimum(alike(words.right), short) < long - 1
    good = ~apart & (long - short <= 1) & (long <= SHORT)
    for at in np.flatnonzero(long > SHORT):
        good[at] = one_edit(words.words[i[at]], words.words[j[at]])
    return good


def candidates(groups: np.ndarray, home: np.ndarray, asked: np.ndarray, state: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): rows ``asked`` with the rows of ``home`` that their budget gets them to, depth-first.

    ``groups`` are the numbers of all rows; those before ``level`` have been walked.
    """
    if not len(home):
        return
    home = home[np.lexsort(groups[home].T[::-1])]

    def walk(lo: int, hi: int, asked: np.ndarray, state: np.ndarray, level: int):
        if not len(asked):
            return
        if hi - lo <= BRANCH or level == GROUPS:
            yield from reach(home[lo:hi], asked, state, level)
            return
        counts = groups[home[lo:hi], level]
        edges = np.flatnonzero(np.concatenate(([True], counts[1:] != counts[:-1], [True])))
        own = groups[asked, level]
        for first, last in zip(edges[:-1], edges[1:]):
            more = counts[first] - own
            same, up, down = more == 0, (more == 1) & (state == EQUAL), (more == -1) & (state == SURPLUS)
            take = same | up | down
            yield from walk(lo + first, lo + last, asked[take], (state + up + down)[take], level + 1)

    def reach(branch: np.ndarray, asked: np.ndarray, state: np.ndarray, level: int):
        rest = groups[branch][:, level:]
        step = max(1, HELD // (len(branch) * max(1, rest.shape[1])))
        for at in range(0, len(asked), step):
            q, s = asked[at : at + step], state[at : at + step, None]
            more = rest[None, :, :] - groups[q][:, None, level:]
            up, down = (more == 1).sum(axis=2), (more == -1).sum(axis=2)
            # The first difference has to be the surplus.
            weight = np.where(more == 1, 1, np.where(more == -1, -1, 0)) if more.shape[2] else None
            ok = ~(np.abs(more) > 1).any(axis=2) & (up + (s > EQUAL) <= 1) & (down + (s == BOTH) <= 1)
            if weight is not None:
                first = np.take_along_axis(weight, np.argmax(weight != 0, axis=2)[:, :, None], axis=2)[:, :, 0]
                ok &= (s != EQUAL) | (first >= 0)
            i, j = np.nonzero(ok)
            # Of equal numbers in all groups: by the words' order, which is that of the rows.
            alike = (s[i, 0] == EQUAL) & (up[i, j] == 0) & (down[i, j] == 0)
            keep = ~alike | (q[i] < branch[j])
            yield q[i][keep], branch[j][keep]

    yield from walk(0, len(home), asked, state, level)


# -- the descent by rows -----------------------------------------------------------------


def _descend(level: int, to: int):
    """From (word, n, state) to ROUTED: each with the nodes of level ``to`` that it may reach."""
    out = to_arrow_schema(T.StructType.fromDDL(ROUTED))

    def steps(state: int) -> list[dict[int, int]]:
        """What may be added to the numbers of the next groups, the surplus first."""
        ups = range(level, to) if state == EQUAL else ()
        if state == EQUAL:
            return [{}, *({a: 1} for a in ups), *({a: 1, b: -1} for a in ups for b in range(a + 1, to))]
        return [{}, *({b: -1} for b in range(level, to))] if state == SURPLUS else [{}]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n, reached, before = (batch.column(at) for at in range(4))
            states = reached.to_numpy()
            groups = Words(words.to_pylist()).groups[:, :to]
            heads = np.frombuffer(b"".join(before.to_pylist()), np.int8).reshape(len(states), level)
            for state in np.unique(states):
                rows = np.flatnonzero(states == state)
                for change in steps(int(state)):
                    node = groups[rows].copy()
                    node[:, :level] = heads[rows]
                    for at, by in change.items():
                        node[:, at] += by
                    there = (node >= 0).all(axis=1)
                    own, node = rows[there], np.ascontiguousarray(node[there])
                    if len(own):
                        offsets = pa.py_buffer(np.arange(0, (len(own) + 1) * to, to, dtype=np.int32))
                        yield pa.RecordBatch.from_arrays([
                            pa.Array.from_buffers(pa.binary(), len(own), [None, offsets, pa.py_buffer(node)]),
                            words.take(pa.array(own)), n.take(pa.array(own)),
                            pa.array(np.full(len(own), state + len(change), np.int8)),
                        ], schema=out)

    return run


FOUND = "word binary, n_near long, most long, form binary"


def _compare(level: int):
    """From rows (node, block, word, n, state, home, asks) sorted by node and block to FOUND, a row per word and block."""
    out = to_arrow_schema(T.StructType.fromDDL(FOUND))

    def compare(names: list[bytes], n: np.ndarray, state: np.ndarray, home: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(names)), key=names.__getitem__)
        words, n, state, home, asks = Words([names[at] for at in order]), n[order], state[order], home[order], asks[order]
        total = np.zeros(len(order), np.int64)
        best = np.full(len(order), -1)

        def meet(i: np.ndarray, j: np.ndarray) -> None:
            # Rows are in the order of words: of equally frequent ones the first is the smallest.
            np.add.at(total, i, 1)
            rank = np.lexsort((j, -n[j], i))
            i, j = i[rank], j[rank]
            first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
            i, j = i[first], j[first]
            old = best[i]
            better = (old < 0) | (n[j] > n[old]) | ((n[j] == n[old]) & (j < old))
            best[i[better]] = j[better]

        for i, j in candidates(words.groups, np.flatnonzero(home), np.flatnonzero(asks), state[asks].astype(np.int64), level):
            good = verified(words, i, j)
            i, j = i[good], j[good]
            if len(i):
                meet(i, j)
                meet(j, i)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([
                pa.array([words.words[at] for at in some], pa.binary()), pa.array(total[some]),
                pa.array(n[best[some]]), pa.array([words.words[at] for at in best[some]], pa.binary()),
            ], schema=out)

    def run(batches):
        now, held = None, []

        def flush():
            if held:
                rows = pa.Table.from_batches(held)
                held.clear()
                yield from compare(rows.column("word").to_pylist(), *(rows.column(c).to_numpy() for c in ("n", "state", "home", "asks")))

        for batch in batches:
            if not batch.num_rows:
                continue
            key = list(zip(batch.column("node").to_pylist(), batch.column("block").to_pylist()))
            edges = [0, *(at for at in range(1, len(key)) if key[at] != key[at - 1]), len(key)]
            for first, last in zip(edges[:-1], edges[1:]):
                if key[first] != now:
                    yield from flush()
                    now = key[first]
                held.append(batch.slice(first, last - first))
        yield from flush()

    return run


def near_words(words: DataFrame, node: int = NODE) -> DataFrame:
    """(word, n_near, most, form) of each (word, n) that has words one edit away.

    ``most`` is the largest n of these, ``form`` the smallest of them that has it.
    """
    rows = words.select("word", "n", F.lit(EQUAL).cast("byte").alias("state"), F.lit(b"").alias("node"))
    level, parts = 0, []
    while level < GROUPS:
        to = min(GROUPS, level + (FIRST if level == 0 else 1))
        routed = stage(rows.select("word", "n", "state", "node").mapInArrow(_descend(level, to), ROUTED), "routed")
        level = to
        at_home = F.col("state") == EQUAL
        sizes = routed.groupBy("node").agg(F.count_if(at_home).alias("words"), F.count(F.lit(1)).alias("all"))
        nodes, n_nodes = counted(sizes.where((F.col("words") > node) | (F.col("words") > 0) & (F.col("all") > CROWD * node)), "nodes")
        marked = routed.join(F.broadcast(nodes) if n_nodes <= BROADCAST_ROWS else nodes, "node", "left")
        light = marked.where(F.coalesce(F.col("words") <= node, F.lit(True)))
        blocks = F.coalesce(F.ceil(F.col("all") / (CROWD * node)), F.lit(1)).cast("int")
        own = F.pmod(F.xxhash64("word"), blocks).cast("int")
        placed = light.select(
            "node", "word", "n", "state", at_home.alias("home"), own.alias("own"),
            F.explode(F.when(at_home, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))).alias("block"),
        )
        parts.append((level, placed.select("node", "block", "word", "n", "state", "home", (F.col("own") == F.col("block")).alias("asks"))))
        rows = marked.where(F.col("words") > node)
        if not n_nodes or not nodes.where(F.col("words") > node).head(1):
            break
    else:
        blocks = F.ceil(F.col("words") / node).cast("int")
        own = F.pmod(F.xxhash64("word"), blocks).cast("int")
        spread = rows.select("node", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), own.alias("own"), "word", "n", "state")
        home = (F.col("state") == EQUAL) & (F.col("own") == F.col("block"))
        parts.append((level, spread.select("node", "block", "word", "n", "state", home.alias("home"), F.lit(True).alias("asks"))))
    found = None
    for level, part in parts:
        dealt = part.repartition("node", "block").sortWithinPartitions("node", "block")
        one = stage(dealt.mapInArrow(_compare(level), FOUND), "near")
        found = one if found is None else found.unionByName(one)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.max("most").alias("most"),
        F.min(F.struct((-F.col("most")).alias("less"), "form"))["form"].alias("form"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow ``word``, of (word, form).

    Every round goes twice as far. A form is never followed back to its word, as its number
    is larger, and no word is the form of more than its near words.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, n = counted(
            now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms"
        )
        if not n or not now.where("moved").head(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(
    docs: DataFrame, id_col: str, text_col: str, shortest: int = SHORTEST, least: int = LEAST, times: int = TIMES,
    every: int | None = None,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each word that occurs ``least`` times.

    ``form`` is the most frequent word one edit away, if it occurs ``times`` as often.
    """
    words = stage(word_counts(docs, id_col, text_col, shortest, every).where(F.col("n") >= least), "words")
    near = near_words(words)
    strong = F.col("most") >= times * F.col("n")
    told = stage(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("most")).alias("form_n"),
        ), "variants",
    )
    last = roots(told.where(F.col("form").isNotNull()))
    return told.join(last, "word", "left").select(
        *(F.decode(c, "ISO-8859-1").alias(name) for c, name in (("word", "word"), ("form", "form"), (F.coalesce("root", "word"), "root"))),
        "n", "n_near", "form_n",
    )
