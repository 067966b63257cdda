"""The catalog as a text file: one group per line, ``url%%%id!!!title##id!!!title``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import rank_all

# The separators of the format.
URL_SEPARATOR = "%%%"
DOC_SEPARATOR = "##"
TITLE_SEPARATOR = "!!!"


# A number and what follows it: where a document begins.
_DOC = rf"(?=-?[0-9]+{TITLE_SEPARATOR})"
# What a title and a url must not hold. A title may end in signs of the separator that comes next.
_BROKEN_TITLE = rf"[\r\n]|{URL_SEPARATOR}|{DOC_SEPARATOR}+[^#]|{TITLE_SEPARATOR}"
_BROKEN_URL = rf"[\r\n]|{URL_SEPARATOR}"


def encode(shelves: DataFrame) -> DataFrame:
    """``value``: the line of each (url, ebooks).

    A group without documents is written as one that has neither number nor title. Nothing is escaped, and what is written is read back as it was. What the format can't
    hold raises: a null url, number or title, an empty title, a line end, and a separator
    within a url or title. Signs of a separator at either end of a value are held.
    """

    def held(value: Column, what: str, least: int, broken: str) -> Column:
        fits = value.isNotNull() & ~value.rlike(broken) & (F.length(value) >= least)
        return F.when(fits, value).otherwise(F.raise_error(F.concat(F.lit(f"the catalog can't hold this {what}: "), F.coalesce(value, F.lit("null")))).cast("string"))

    docs = F.transform(
        F.coalesce("ebooks", F.array()),
        lambda e: F.concat(held(e.id.cast("string"), "number", 1, r"[^-0-9]"), F.lit(TITLE_SEPARATOR), held(e.title, "title", 1, _BROKEN_TITLE)),
    )
    listed = F.when(F.size(docs) > 0, F.array_join(docs, DOC_SEPARATOR)).otherwise(TITLE_SEPARATOR)
    return shelves.select(F.concat(held(F.col("url"), "url", 0, _BROKEN_URL), F.lit(URL_SEPARATOR), listed).alias("value"))


def decode(lines: DataFrame, id_type: str = "int") -> DataFrame:
    """``url`` and ``ebooks`` of each line of ``value``; a malformed line is dropped whole.

    Malformed: no part after the url, a document without a number, a number that is none, or
    an empty title. Parts beyond the second are ignored.
    """
    # The url ends before a document, or the sign that there is none, so a sign of the separator may be its last.
    head = rf"(?s)\A(.*?){URL_SEPARATOR}({_DOC}.*|{TITLE_SEPARATOR})\z"
    listed = F.get(F.split(F.regexp_extract("value", head, 2), URL_SEPARATOR), 0)
    docs = F.transform(
        F.when(listed != TITLE_SEPARATOR, F.split(listed, DOC_SEPARATOR + _DOC)).otherwise(F.array().cast("array<string>")),
        lambda e: F.struct(
            F.get(F.split(e, TITLE_SEPARATOR), 0).try_cast(id_type).alias("id"),
            F.get(F.split(e, TITLE_SEPARATOR), 1).alias("title"),
        ),
    )
    return lines.where(F.col("value").rlike(head)).select(F.regexp_extract("value", head, 1).alias("url"), docs.alias("ebooks")).where(
        F.forall("ebooks", lambda e: e.id.isNotNull() & F.coalesce((e.title != "") & ~e.title.rlike(rf"{DOC_SEPARATOR}+[^#]"), F.lit(False)))
    )


def write_catalog(shelves: DataFrame, path: str) -> None:
    """Save as text. A file that is there is not overwritten."""
    encode(shelves).write.mode("errorifexists").text(path)


def write_listing(listing: DataFrame, path: str, per_line: int = 10_000) -> None:
    """Save a flat listing (as ``catalog.flatten`` gives it), a group in lines of ``per_line`` documents.

    No group is gathered, however long: its documents are numbered by a sort of the whole
    listing, a line holds those of one share of the numbers, and nothing more meets in one
    task. All lines of a group have its url; ``read_listing`` puts them in order.
    """
    numbered = rank_all(listing.where(F.col("ebook_id").isNotNull()), ["shelf_pos", "bookshelf_url"], ["ebook_pos"], "_place")
    entry = F.struct("_place", F.col("ebook_id").alias("id"), F.col("ebook_title").alias("title"))
    lines = (
        numbered.groupBy("shelf_pos", "bookshelf_url", F.expr(f"(_place - 1) div {per_line}").alias("part"))
        .agg(F.array_sort(F.collect_list(entry)).alias("all"))  # at most ``per_line`` of them
    )
    shelves = lines.select(
        F.concat_ws("|", "shelf_pos", "part", "bookshelf_url").alias("url"),
        F.transform("all", lambda e: F.struct(e.id.alias("id"), e.title.alias("title"))).alias("ebooks"),
    )
    encode(shelves).write.mode("errorifexists").text(path)


def read_listing(spark: SparkSession, path: str, id_type: str = "int") -> DataFrame:
    """The listing ``write_listing`` saved: shelf_pos, bookshelf_url, part, place, ebook_id, ebook_title.

    ``part`` and ``place`` order the documents of a group.
    """
    head = F.split("url", r"\|", 3)
    return decode(spark.read.text(path), id_type).select(
        F.get(head, 0).cast("long").alias("shelf_pos"), F.get(head, 2).alias("bookshelf_url"),
        F.get(head, 1).cast("long").alias("part"), F.posexplode("ebooks").alias("place", "e"),
    ).select("shelf_pos", "bookshelf_url", "part", "place", F.col("e.id").alias("ebook_id"), F.col("e.title").alias("ebook_title"))


def read_catalog(spark: SparkSession, path: str, id_type: str = "int") -> DataFrame:
    """Read the saved text."""
    return decode(spark.read.text(path), id_type)
