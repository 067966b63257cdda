"""Benchmark passages in a corpus, by a positional inverted index of rare terms.

The number of postings of every benchmark term is counted over the whole corpus. Of each
window of an item, the term with the fewest postings is its anchor, so every occurrence of a
window has a posting of an anchor at a known offset. Only postings of anchor terms are kept:
place, and the terms beside it as far as a window reaches, which are the lists of the other
terms adjusted to the anchor's offset. An anchor's list is intersected with those of its
neighbours outwards, term by term, as far as document and item agree.

Postings never meet each other, only the item's anchors, so a passage that a third of the
corpus holds costs one row per occurrence and anchor.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewdex.operators.joins import BROADCAST_ROWS
from skewdex.sources.staging import stage

#: Words of a window, and how many of them a proximity match needs within its reach.
WINDOW, NEAR = 10, 8
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text that is not lower-cased yet.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and all characters beyond ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, _SEPARATORS), lambda w: w != "")


def _key(id_col: str, text_col: str) -> Column:
    """A row's identity: rows of the same id and text have the same result."""
    shown = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    return F.md5(F.concat(shown, F.lit("\x00"), F.coalesce(F.col(text_col), F.lit(""))))


def _small(df: DataFrame) -> DataFrame:
    """A staged table, broadcast if it is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _agreeing(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _beside(all_words: Column, at: Column, reach: int) -> tuple[Column, Column]:
    """The words before place ``at``, nearest first, and after it."""
    left = F.reverse(F.slice(all_words, F.greatest(at - reach + 1, F.lit(1)), F.least(at, F.lit(reach))))
    return left, F.slice(all_words, at + 2, F.lit(reach))


def item_words(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, number, pos, n, term, left, right): every word of every item, staged.

    An item is named by its id as a string; a null id is the empty name.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.xxhash64(F.col(text_col), F.col(item_col)).alias("number"), words(F.col(text_col)).alias("words"),
    ).dropDuplicates(["item", "words"])
    placed = items.select("item", "number", "words", F.posexplode("words").alias("pos", "term"))
    left, right = _beside(F.col("words"), F.col("pos"), WINDOW - 1)
    return stage(
        placed.select("item", "number", "pos", F.size("words").alias("n"), "term", left.alias("left"), right.alias("right")),
        "benchmark-words",
    )


def anchors(docs: DataFrame, text_col: str, placed: DataFrame, window: int) -> DataFrame:
    """The words of ``placed`` that are the rarest of a window, staged."""
    terms = _small(stage(placed.select("term").distinct(), "benchmark-terms"))
    counted = (
        docs.select(F.explode(words(F.col(text_col))).alias("term"))
        .join(terms, "term")
        .groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    )
    weighed = placed.join(counted, "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    ahead = Window.partitionBy("item", "number").orderBy("pos").rowsBetween(0, window - 1)
    starts = (F.col("pos") == 0) | (F.col("pos") + window <= F.col("n"))
    rarest = weighed.select(
        "item", "number", "pos", F.min(F.struct("postings", "pos")).over(ahead)["pos"].alias("anchor"),
        starts.alias("is_start"), F.min("postings").over(ahead).alias("found"),
    ).where("is_start AND found > 0")  # a window with a term that the corpus lacks occurs nowhere
    chosen = rarest.select("item", "number", F.col("anchor").alias("pos")).distinct()
    return stage(placed.join(chosen, ["item", "number", "pos"]), "anchors")


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
    window: int = WINDOW, near: int = NEAR,
) -> DataFrame:
    """(key, item, first, last, exact): places of documents that match an item.

    If ``exact``, the words ``first`` to ``last`` are consecutive words of the item, and of at
    least one whole window; every word of every occurrence of a window is in such a range.
    Otherwise ``near`` of the window's words, the anchor among them, stand within its reach
    in any order. An item of fewer words than a window is one window.
    """
    placed = item_words(benchmark, item_col, item_text_col)
    chosen = anchors(docs, text_col, placed, window)
    reach = window - 1
    theirs = chosen.select(
        "item", "pos", "n", "term", F.slice("left", 1, reach).alias("item_left"), F.slice("right", 1, reach).alias("item_right")
    ).withColumnRenamed("pos", "item_pos")
    terms = _small(stage(chosen.select("term").distinct(), "anchor-terms"))

    text = docs.select(_key(id_col, text_col).alias("key"), words(F.col(text_col)).alias("words"))
    left, right = _beside(F.col("words"), F.col("pos"), reach)
    postings = stage(
        text.select("key", "words", F.posexplode("words").alias("pos", "term"))
        .join(terms, "term")
        .select("term", "key", "pos", left.alias("left"), right.alias("right")),
        "postings",
    )
    met = postings.join(_small(theirs), "term").withColumns(
        {
            "to_left": _agreeing(F.col("left"), F.col("item_left")),
            "to_right": _agreeing(F.col("right"), F.col("item_right")),
            "shared": F.size(F.array_intersect(F.concat("left", "right"), F.concat("item_left", "item_right"))) + 1,
        }
    )
    exact = F.col("to_left") + F.col("to_right") + 1 >= F.least(F.lit(window), F.col("n"))
    return met.where(exact | (F.col("shared") >= near)).select(
        "key", "item", F.when(exact, F.col("pos") - F.col("to_left")).otherwise(F.col("pos")).alias("first"),
        F.when(exact, F.col("pos") + F.col("to_right")).otherwise(F.col("pos")).alias("last"), exact.alias("exact"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
    window: int = WINDOW, near: int = NEAR,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, items, near_items.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` has the names of
    the items with one, sorted, and ``near_items`` those with a proximity match only. A null
    text has no words. Rows that share id and text have the same result. Other columns are
    left behind.
    """
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col, window, near)
    before = Window.partitionBy("key").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max(F.when(F.col("exact"), F.col("last"))).over(before), F.lit(-1))
    new = F.greatest(F.col("last") - F.greatest(F.col("first") - 1, seen), F.lit(0))
    by_text = (
        found.withColumn("new", F.when(F.col("exact"), new).otherwise(0))
        .groupBy("key")
        .agg(
            F.sum("new").alias("n_hit"), F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item")))).alias("items"),
            F.array_sort(F.collect_set(F.when(~F.col("exact"), F.col("item")))).alias("near_items"),
        )
    )
    none = F.array().cast("array<string>")
    return (
        docs.select(
            F.col(id_col), _key(id_col, text_col).alias("key"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(_WORD)).cast("long").alias("n_words"),
        )
        .join(by_text, "key", "left")
        .select(
            id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"),
            F.array_except(F.coalesce("near_items", none), F.coalesce("items", none)).alias("near_items"),
        )
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
    hit = stage(found.where("exact").select(F.col("key").alias("_contaminated")).distinct(), "contaminated")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_ROWS else hit
    return docs.join(hit, _key(id_col, text_col) == F.col("_contaminated"), "left_anti")
