"""Tokenizing and row-local term counting."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The stop-word list.
STOP_WORDS = (
    "", "a", "all", "and", "any", "are", "is", "in", "of", "on",
    "or", "our", "so", "this", "the", "that", "to", "we", "it", "for",
)


def terms(text: Column | str, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Lower-cased words of ``text`` in order, repeats kept.

    Words are runs of ASCII letters, digits and underscores. Stop words go first, then
    underscores are deleted (the only punctuation such a word can hold), then words of
    one character go, so ``_the_`` stays as ``the``.
    """
    text = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(text), r"\W+")
    kept = F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*stop_words))
    # Few texts hold an underscore; the others are done in one pass over their words.
    cleaned = F.filter(
        F.transform(
            F.filter(words, lambda w: ~w.isin(*stop_words)), lambda w: F.translate(w, "_", "")
        ),
        lambda w: F.length(w) > 1,
    )
    return F.when(F.contains(text, F.lit("_")), cleaned).otherwise(kept)


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct terms of a search string, cut by the same expression as the texts."""
    row = spark.range(1).select(F.array_distinct(terms(F.lit(query))).alias("terms")).first()
    return row.terms


def run_ends(ordered: Column) -> Column:
    """0-based positions of the last of each run of equal values in a sorted array."""
    following = F.concat(
        F.slice(ordered, F.lit(2), F.size(ordered)), F.array(F.lit(None).cast("string"))
    )
    last = F.zip_with(ordered, F.slice(following, F.lit(1), F.size(ordered)), lambda a, b: ~a.eqNullSafe(b))
    return F.filter(F.transform(last, lambda ends, i: F.when(ends, i)), lambda i: i.isNotNull())


def run_lengths(ordered: Column, ends: Column) -> Column:
    """ARRAY<STRUCT<term, n>> of a sorted array, given its ``run_ends``."""
    # No lambda looks into the arrays themselves: should the optimizer put their expressions
    # in place of the columns, they are still evaluated per row, not per element.
    before = F.slice(F.concat(F.array(F.lit(-1)), ends), F.lit(1), F.size(ends))
    return F.arrays_zip(
        F.array_distinct(ordered).alias("term"),
        F.zip_with(ends, before, lambda a, b: a - b).alias("n"),
    )
