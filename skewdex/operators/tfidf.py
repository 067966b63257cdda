"""TF-IDF of documents within groups.

``scope`` names the columns of the group (a corpus of its own), ``doc`` those of the
document inside it. An empty scope makes the whole input one corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import run_ends, run_lengths, terms
from ..sources.staging import stage
from .joins import BROADCAST_ROWS, lookup_join
from .ordered import first_rows

TOP_TERMS = 500
# Terms of a lookup that are pushed to the scan as a list.
ASKED_TERMS = 1000
_SCOPE = "_scope"
_ROW = "_row"


def tokenize(docs: DataFrame, doc: list[str], text: str = "text") -> DataFrame:
    """One row per kept word: ``doc``, its position among the kept words, and the term."""
    # Outer, as an inner one would cut every text twice, once just to see if it has words.
    return docs.select(*doc, F.posexplode_outer(terms(text)).alias("pos", "term")).where(
        F.col("term").isNotNull()
    )


def last_listed(listing: DataFrame, key: list[str], position: str) -> DataFrame:
    """Keep the row listed last under each key."""
    return first_rows(listing, key, [f"-{position}"], 1, "_rn").drop("_rn")


def term_counts(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key``, ``n_terms`` and ``counts`` ARRAY<STRUCT<term, n>>: one row per document.

    A document is one row, so its terms are counted inside the row without any shuffle.
    Documents whose text is null are dropped; those with no kept term stay, as they count
    in the size of the corpus.
    """
    return (
        docs.where(F.col(text).isNotNull())
        .select(*key, F.sort_array(terms(text)).alias("_terms"))
        .withColumn("_ends", run_ends(F.col("_terms")))
        .select(
            *key,
            F.size("_terms").alias("n_terms"),
            run_lengths(F.col("_terms"), F.col("_ends")).alias("counts"),
        )
    )


def _flat(counts: DataFrame, key: list[str]) -> DataFrame:
    return counts.select(*key, "n_terms", F.inline_outer("counts")).where(F.col("term").isNotNull())


def term_frequency(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key``, ``term``, ``n`` and ``tf`` = n / all kept terms of the document."""
    return _flat(term_counts(docs, key, text), key).select(
        *key, "term", "n", (F.col("n") / F.col("n_terms")).alias("tf")
    )


def document_frequency(counts: DataFrame, scope: list[str]) -> DataFrame:
    """``scope``, ``term`` and ``df``: documents of the scope that hold the term."""
    return (
        counts.select(*scope, F.explode("counts.term").alias("term"))
        .groupBy(*scope, "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def inverse_document_frequency(counts: DataFrame, scope: list[str]) -> DataFrame:
    """``scope``, ``term``, ``df``, ``n_docs`` and ``idf`` = ln(n_docs / (1 + df)).

    Not clamped: 0 for a term in all documents but one, negative for a term in all.
    ``counts`` should be staged, as it is read for both counts.
    """
    sizes = counts.groupBy(*scope).agg(F.count(F.lit(1)).alias("n_docs"))
    return lookup_join(document_frequency(counts, scope), sizes, scope, "n_docs").select(
        *scope, "term", "df", "n_docs",
        F.log(F.col("n_docs") / (F.lit(1.0) + F.col("df"))).alias("idf"),
    )


def idf(docs: DataFrame, scope: list[str], doc: list[str], text: str = "text") -> DataFrame:
    """``inverse_document_frequency`` straight from the texts."""
    counts = stage(term_counts(_scoped(docs, scope), [_SCOPE, *doc], text), "counts")
    return inverse_document_frequency(counts, [_SCOPE]).select(
        *_unscoped(scope), "term", "df", "n_docs", "idf"
    )


def _scoped(docs: DataFrame, scope: list[str]) -> DataFrame:
    """The scope as one value: in a struct, a null equals a null, so it is a group like others."""
    return docs.withColumn(_SCOPE, F.struct(*scope) if scope else F.lit(0))


def _unscoped(scope: list[str]) -> list[Column]:
    return [F.col(f"{_SCOPE}.{name}") for name in scope]


def top_terms(weights: DataFrame, key: list[str], k: int | None) -> DataFrame:
    """The ``k`` heaviest terms per key; equal weights go by term."""
    if k is None:
        return weights
    return first_rows(weights, key, ["-weight", "term"], k, "_rn").drop("_rn")


def tfidf(
    docs: DataFrame,
    scope: list[str],
    doc: list[str],
    text: str = "text",
    top: int | None = TOP_TERMS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``scope``, ``doc``, ``term`` and ``weight`` = tf * idf, the ``top`` heaviest per document.

    ``doc`` tells the documents of a scope apart; without ``top`` all terms are kept. The
    texts are read and cut once.
    """
    counts = term_counts(_scoped(docs, scope), [_SCOPE, *doc], text)
    return _tfidf(counts, scope, doc, top, broadcast_rows)


def tfidf_of_counts(
    counts: DataFrame, scope: list[str], doc: list[str], top: int | None = TOP_TERMS,
    broadcast_rows: int = BROADCAST_ROWS, layout: tuple[str | None, int] | None = None,
) -> DataFrame:
    """``tfidf`` of documents whose terms are counted already (``n_terms``, ``counts``).

    ``layout`` names a column and a number of partitions: documents are weighed and ranked in
    the partition that the column's hash gives, and their rows stay there. With None for the
    column they are dealt out to that number of partitions.
    """
    place = [layout[0]] if layout and layout[0] else []
    counts = _scoped(counts, scope).select(_SCOPE, *doc, *place, "n_terms", "counts")
    return _tfidf(counts, scope, doc, top, broadcast_rows, place, layout[1] if layout else None)


def _tfidf(
    counts: DataFrame, scope: list[str], doc: list[str], top: int | None, broadcast_rows: int,
    place: list[str] | None = None, n: int | None = None,
) -> DataFrame:
    """The counts, an array per document, are staged under a document number.

    They are spread by that number, or by ``place``, before they are unrolled, so the terms
    looked up by broadcast stay where their document is and the ranking needs no further
    shuffle. Spread by number, only the number is sorted with the terms, and the document's
    own columns come back by a join on it. Spread by ``place`` they go along, as a join on
    more than the place would move all terms once more.
    """
    place = place or []
    by = place or [_ROW]
    counts = stage(counts.withColumn(_ROW, F.monotonically_increasing_id()), "counts", packed=True)
    rates = stage(inverse_document_frequency(counts, [_SCOPE]), "idf", packed=True)
    row, named = [*place, _ROW], counts.select(_ROW, *_unscoped(scope), *doc)
    taken = [_SCOPE, *doc] if place else [_SCOPE]
    spread = counts.select(*row, *taken, "n_terms", "counts").repartition(*([n] if n else []), *by)
    weights = lookup_join(
        _flat(spread, [*row, *taken]), rates.select(_SCOPE, "term", "df", "idf"), [_SCOPE, "term"], "df",
        rows=broadcast_rows, spread_by=by, spread_n=n,
    ).select(*row, *taken, "term", (F.col("n") / F.col("n_terms") * F.col("idf")).alias("weight"))
    best = top_terms(weights, row, top)
    if place:
        return best.select(*_unscoped(scope), *doc, "term", "weight")
    return best.join(named.repartition(n, _ROW) if n else named, _ROW).select(*scope, *doc, "term", "weight")


def group_tfidf(docs: DataFrame, group: list[str], text: str = "text", top: int | None = TOP_TERMS) -> DataFrame:
    """TF-IDF of each group taken as one document in a corpus of one.

    Every idf is then ln(1/2). Joining the texts by a space adds no term, so the counts of
    the documents are added up instead and no group text is ever put together.
    """
    counts = stage(term_counts(_scoped(docs, group), [_SCOPE], text), "counts")
    sizes = counts.groupBy(_SCOPE).agg(
        F.sum("n_terms").alias("n_all"), F.count(F.lit(1)).alias("n_docs")
    )
    per_term = (
        counts.select(_SCOPE, F.inline("counts"))
        .groupBy(_SCOPE, "term")
        .agg(F.sum("n").alias("n"))
    )
    weights = lookup_join(per_term, sizes, [_SCOPE], "n_docs").select(
        _SCOPE, "term",
        (F.col("n") / F.col("n_all") * F.log(F.lit(1) / (F.lit(1.0) + 1))).alias("weight"),
    )
    return top_terms(weights, [_SCOPE], top).select(*_unscoped(group), "term", "weight")


def signature_words(index: DataFrame, key: list[str], k: int) -> DataFrame:
    """The ``k`` heaviest terms of every document of an index, with their place."""
    return first_rows(index, key, ["-weight", "term"], k, "place").select(
        *key, "place", "term", "weight"
    )


def signature_words_of(index: DataFrame, doc: dict[str, object]) -> DataFrame:
    """All terms of one document, heaviest first; the key reaches the scan as a filter."""
    for name, value in doc.items():
        index = index.where(F.col(name) == F.lit(value))
    return index.select("term", "weight").orderBy(F.desc("weight"), "term")


def term_weights(asked: DataFrame, index: DataFrame, on: list[str]) -> DataFrame:
    """Weight of each asked (document, term), 0.0 where the index has none.

    The asked pairs are unique on ``on``; each meets at most one index row, so no key is hot.
    ``on`` has ``term``. Up to ``ASKED_TERMS`` different terms reach the index scan as a
    filter, so that only their row groups are read; more of them are joined.
    """
    terms = asked.select("term").distinct()
    found = [r["term"] for r in terms.limit(ASKED_TERMS + 1).collect()]
    if len(found) <= ASKED_TERMS:
        index = index.where(F.col("term").isin(found))
    return asked.join(index.select(*on, "weight"), on, "left").withColumn(
        "weight", F.coalesce("weight", F.lit(0.0))
    )
