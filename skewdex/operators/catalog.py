"""The listing of groups and their documents: nested and flat form, limits, lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import BROADCAST_ROWS
from .ordered import first_rows

SHELF_SCHEMA = "pos long, url string, ebooks array<struct<id: int, title: string>>"


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str = SHELF_SCHEMA, slices: int = 34) -> DataFrame:
    """A small collection held by the caller as a DataFrame of a fixed number of partitions."""
    return spark.createDataFrame(list(rows), schema).repartition(slices)


def limit_groups(shelves: DataFrame, n: int, position: str = "pos") -> DataFrame:
    """The first ``n`` groups of a nested catalog in listing order."""
    return shelves.orderBy(position).limit(n)


def limit_per_group(shelves: DataFrame, n: int, docs: str = "ebooks") -> DataFrame:
    """The first ``n`` documents of every group of a nested catalog; empty groups stay."""
    return shelves.withColumn(docs, F.slice(docs, 1, n))


def limit_listed_groups(listing: DataFrame, n: int, position: str) -> DataFrame:
    """The rows of the first ``n`` groups of a flat listing, told apart by ``position``.

    A group without documents counts if the listing has a row for it (see ``pages.catalog``).
    """
    first = listing.select(position).distinct().orderBy(position).limit(n)
    # It has n rows by the limit.
    return listing.join(F.broadcast(first) if n <= BROADCAST_ROWS else first, position, "left_semi")


def limit_listed_docs(listing: DataFrame, n: int, group: list[str], position: str) -> DataFrame:
    """The first ``n`` rows by ``position`` of every group of a flat listing."""
    return first_rows(listing, group, [position], n, "_rn").drop("_rn")


def flatten(shelves: DataFrame) -> DataFrame:
    """One row per listed document of a nested catalog; empty groups give none."""
    return shelves.select(
        F.col("pos").alias("shelf_pos"), F.col("url").alias("bookshelf_url"),
        F.posexplode("ebooks").alias("ebook_pos", "_e"),
    ).select(
        "shelf_pos", "bookshelf_url", "ebook_pos",
        F.col("_e.id").alias("ebook_id"), F.col("_e.title").alias("ebook_title"),
    )


def nest(listing: DataFrame) -> DataFrame:
    """A flat listing with one row per group; its documents, in order, as an array.

    A row without a document makes an empty group. A group's array holds numbers and titles
    only and is a single value by definition; work on texts should stay on the flat form, and
    a long group can be written as several lines (see ``catalog_text.write_listing``).
    """
    entry = F.struct("ebook_pos", F.col("ebook_id").alias("id"), F.col("ebook_title").alias("title"))
    return (
        listing.groupBy(F.col("shelf_pos").alias("pos"), F.col("bookshelf_url").alias("url"))
        .agg(F.array_sort(F.collect_list(F.when(F.col("ebook_id").isNotNull(), entry))).alias("_all"))
        .select("pos", "url", F.transform("_all", lambda e: F.struct(e.id.alias("id"), e.title.alias("title"))).alias("ebooks"))
    )


def dictionary_lookup(rows: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of the entry of their key, null where there is none.

    ``entries`` has one row per key. Spark sends a small dictionary around, and splits hot
    keys of a large one (adaptive skew join).
    """
    return rows.join(entries, key, "left")
