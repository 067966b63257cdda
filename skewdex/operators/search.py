"""Keyword search over the index: best documents per group, best groups first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import query_terms
from ..sources.staging import stage
from .joins import BROADCAST_ROW_BYTES, BROADCAST_ROWS, lookup_join
from .ordered import first_rows

MIN_SCORE = 0.001
TITLE_WIDTH = 60
GROUP_WIDTH = 132


def match_terms(index: DataFrame, query: str | DataFrame) -> DataFrame:
    """Index rows whose term is in the query: a text, or a table with a column ``term``.

    The terms of a text reach the Parquet scan as a list. A table of terms, which may hold any
    number of them, is a semi-join: sent around if it is small, and otherwise shuffled, with
    a Bloom filter of its terms on the index scan, so that only rows that may match move
    (from ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold`` on).
    """
    if isinstance(query, DataFrame):
        # A comparison, not a null test, lets Spark take the table for a filter of the scan.
        terms = query.where(F.col("term") > "").select("term").distinct()
        return index.join(terms, "term", "left_semi")
    return index.where(F.col("term").isin(query_terms(index.sparkSession, query)))


def match_many_terms(index: DataFrame, asked: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``match_terms`` for a table, without a shuffle of all the index.

    Up to ``rows`` terms are sent around. More of them meet the terms of the index, each once
    with its number of rows: what is sent around then are the commonest of these, asked or not,
    so that only rows of rare terms are shuffled.
    """
    terms = stage(asked.where(F.col("term") > "").select("term").distinct(), "asked")
    told = terms.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("term")).alias("longest")).first()
    if told.n <= rows and (told.longest or 0) <= BROADCAST_ROW_BYTES:
        return index.join(F.broadcast(terms), "term", "left_semi")
    present = index.where(F.col("term").isNotNull())
    known = present.groupBy("term").agg(F.count(F.lit(1)).alias("_n")).join(terms.withColumn("_asked", F.lit(True)), "term", "left")
    met = lookup_join(present, stage(known, "known"), ["term"], "_n", rows=rows)
    return met.where("_asked").select(*index.columns)


def similarity(
    index: DataFrame,
    query: str | DataFrame,
    key: list[str],
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``key`` and ``similarity_level``: sum of the matching weights, above ``min_score``.

    Weights are added up as decimals of 18 places, so the order of addition cannot split a
    tie or move a sum over the threshold.
    """
    matched = match_many_terms(index, query) if isinstance(query, DataFrame) else match_terms(index, query)
    return (
        matched
        .groupBy(*key)
        .agg(_exact_sum("weight").alias("similarity_level"))
        .where(F.col("similarity_level") > min_score)
    )


def _exact_sum(value: str) -> Column:
    return F.sum(F.col(value).cast("decimal(38,18)")).cast("double")


def rank_in_group(scores: DataFrame, group: str, k: int | None) -> DataFrame:
    """RANK by score inside the group as ``topN``, kept up to ``k``, ties included."""
    return first_rows(scores, [group], ["-similarity_level"], k, "topN", ties=True)


def search(
    index: DataFrame,
    query: str | DataFrame,
    group: str = "bookshelf_url",
    doc: str = "ebook_id",
    title: str = "ebook_title",
    k: int | None = 2,
    min_score: float = MIN_SCORE,
    limit: int | None = 10,
    total: str = "topk",
    group_prefix: str = "",
    title_width: int | None = TITLE_WIDTH,
    group_width: int | None = GROUP_WIDTH,
    digits: int | None = None,
) -> DataFrame:
    """``bookshelf``, ``title`` and ``similarity_level`` of the best documents, best groups first.

    A group's level is the sum over its kept documents (``total="topk"``) or over all its
    matching documents (``total="all"``, which shows the group's name in full). Without
    ``k`` all matching documents are kept. ``title_width`` and ``group_width`` cut what is
    shown; None shows all of it. With ``digits`` levels are rounded before they are ranked,
    after the threshold: sums that differ by less are ties. With a ``limit`` the rows come
    with their ``place``, from 1.
    """
    if total not in ("topk", "all"):
        raise ValueError(f"total must be 'topk' or 'all', not {total!r}")
    scores = similarity(index, query, [group, doc, title], min_score)
    if digits is not None:
        scores = scores.withColumn("similarity_level", F.round("similarity_level", digits))
    kept = rank_in_group(scores, group, k)
    # Added up by a grouped aggregate, not a window: no group is gathered in one task.
    levels = (kept if total == "topk" else scores).groupBy(F.col(group).alias("_group")).agg(
        _exact_sum("similarity_level").alias("_level")
    )
    ranked = kept.join(levels, F.col(group).eqNullSafe(F.col("_group")))
    if digits is not None:
        ranked = ranked.withColumn("_level", F.round("_level", digits))
    order = [F.desc("_level"), F.col(group), F.col("topN"), F.col(doc)]
    ordered = ranked.orderBy(*order)
    name = F.substr(group, F.lit(len(group_prefix) + 1)) if total == "topk" else F.col(group)
    shown = [
        (F.left(name, F.lit(group_width)) if total == "topk" and group_width is not None else name).alias("bookshelf"),
        (F.col(title) if title_width is None else F.left(title, F.lit(title_width))).alias("title"),
        F.col("similarity_level"),
    ]
    if limit is None:
        return ordered.select(*shown)
    # A window over the few rows of the limit.
    place = F.row_number().over(Window.orderBy(*order))
    return ordered.limit(limit).select(*shown, place.alias("place"))
