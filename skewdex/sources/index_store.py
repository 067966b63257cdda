"""The index table in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import PACKED, stage, tidy

INDEX_SCHEMA = "bookshelf_url string, ebook_id int, ebook_title string, term string, weight double"
DEFAULT_DIRECTORY = "tfidfIndex"


#: Tells documents of one group and number apart by their titles.
KEY = "ebook_key"
DOCUMENT = ("bookshelf_url", "ebook_id")
TITLE = "ebook_title"


def index_path(directory: str = DEFAULT_DIRECTORY) -> str:
    return f"{directory.rstrip('/')}/books"


def titles_path(directory: str = DEFAULT_DIRECTORY) -> str:
    return f"{directory.rstrip('/')}/titles"


def with_key(rows: DataFrame) -> DataFrame:
    """``rows`` with the 64 bits that stand for group, number and title."""
    return rows.withColumn(KEY, F.xxhash64(*DOCUMENT, TITLE))


def titles_of(rows: DataFrame) -> DataFrame:
    """The documents of ``rows`` (with their key) and their titles, each once."""
    # No aggregate of a string: Spark would sort all rows with their titles for it.
    return rows.select(*DOCUMENT, KEY, TITLE).distinct()


def no_clash(titles: DataFrame) -> None:
    """Raises if two titles of one group and number have the same key. ``titles`` should be staged."""
    clash = titles.groupBy(*DOCUMENT, KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if clash:
        raise ValueError(f"two titles have the same key: {clash}")


def attach_titles(terms: DataFrame, titles: DataFrame) -> DataFrame:
    """The index rows of both tables as one table, without the key. A null group or number is one like others.

    Titles are never sent around: in a merge by document, its rows come together, so that
    what is written of them next has a title packed once, and not once in each of their places.
    """
    t, d = terms.alias("t"), titles.hint("merge").alias("d")
    met = F.col(f"t.{KEY}") == F.col(f"d.{KEY}")
    for name in DOCUMENT:
        met = met & F.col(f"t.{name}").eqNullSafe(F.col(f"d.{name}"))
    return t.join(d, met).select(*[f"t.{name}" for name in DOCUMENT], f"d.{TITLE}", "t.term", "t.weight")


def write_index(
    index: DataFrame,
    directory: str = DEFAULT_DIRECTORY,
    sort_by: tuple[str, ...] = ("term", "ebook_id"),
    titles: DataFrame | None = None,
) -> None:
    """Replace the index in ``directory``.

    A title is stored once per document, in a table of its own, and not with each of its
    terms. With ``titles`` (as of ``titles_of``) the rows of ``index`` have the key, and no title.

    Rows are laid out by ranges of term, and of document within a frequent term, so that a
    search, which filters by term, finds them in a few files and skips the others by their
    statistics. With no ``sort_by`` rows stay where they are.
    """
    index, titles = _parted(index, titles)
    with tidy(index.sparkSession):
        titles.write.mode("overwrite").option("compression", PACKED).parquet(titles_path(directory))
    no_clash(index.sparkSession.read.schema(titles.schema).parquet(titles_path(directory)))
    if sort_by:
        index = index.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    with tidy(index.sparkSession):
        index.write.mode("overwrite").option("compression", PACKED).option("parquet.bloom.filter.enabled#term", "true").parquet(
            index_path(directory)
        )


def _parted(index: DataFrame, titles: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    if titles is not None:
        return index, titles
    index = with_key(index)
    return index.drop(TITLE), titles_of(index)


def write_groups(
    index: DataFrame, directory: str = DEFAULT_DIRECTORY, group: str = "bookshelf_url",
    sort_by: tuple[str, ...] = ("term", "ebook_id"), titles: DataFrame | None = None,
) -> None:
    """Put the groups of ``index`` into an index kept by group: theirs are replaced, all others stay.

    A folder to a group, so a filter by group reads its own files only. Rows are laid out by
    ranges of group and term: a large group is many tasks' work, and a small one is one file.
    A folder can't tell an empty name from none: both raise. ``titles`` as in ``write_index``.
    """
    name = F.when(F.col(group) != "", F.col(group)).otherwise(F.raise_error(F.lit("a group must have a name")).cast("string"))
    index, titles = _parted(index, titles)
    index = index.withColumn(group, name)
    # A group without rows is not replaced, so its titles stay, too.
    kept = titles.join(index.select(group).distinct(), group, "left_semi")
    titles = stage(kept, "titles")
    no_clash(titles)
    _by_group(titles.repartitionByRange(group, *DOCUMENT).sortWithinPartitions(group, *DOCUMENT), group, titles_path(directory))
    _by_group(index.repartitionByRange(group, *sort_by).sortWithinPartitions(group, *sort_by), group, index_path(directory))


def _by_group(laid: DataFrame, group: str, path: str) -> None:
    with tidy(laid.sparkSession):
        laid.write.mode("overwrite").option("compression", PACKED).option("partitionOverwriteMode", "dynamic").option(
            "parquet.bloom.filter.enabled#term", "true"
        ).partitionBy(group).parquet(path)


def write_index_table(index: DataFrame, table: str, buckets: int, by: tuple[str, ...] = ("bookshelf_url", "ebook_id")) -> None:
    """Replace a catalog table that holds the index bucketed by document.

    Sums and ranks per document then need no shuffle on the bucket columns.
    """
    index.write.mode("overwrite").option("compression", PACKED).bucketBy(buckets, *by).sortBy(*by).format("parquet").saveAsTable(table)


def read_index(spark: SparkSession, directory: str = DEFAULT_DIRECTORY, schema: str = INDEX_SCHEMA) -> DataFrame:
    """The index with its declared schema; no file is opened to infer one. A filter on terms reaches their scan."""
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
    named = [f"{name} {kinds[name]}" for name in DOCUMENT]
    terms = spark.read.schema(", ".join([*named, f"{KEY} long", f"term {kinds['term']}", f"weight {kinds['weight']}"])).parquet(index_path(directory))
    titles = spark.read.schema(", ".join([*named, f"{KEY} long", f"{TITLE} {kinds[TITLE]}"])).parquet(titles_path(directory))
    return attach_titles(terms, titles).select(*kinds)


def write_normalized(index: DataFrame, directory: str, key: tuple[str, ...] = ("bookshelf_url", "ebook_id"), title: str = "ebook_title") -> None:
    """The index as two tables: documents with their titles, and terms by document number."""
    root = directory.rstrip("/")
    # Each title once before one is taken: Spark sorts what an aggregate takes strings of. Staged,
    # as it would else make one aggregate of both.
    titles = stage(index.select(*key, title).distinct(), "titles")
    titles.groupBy(*key).agg(F.any_value(title).alias(title)).write.mode("overwrite").option("compression", PACKED).parquet(f"{root}/ebooks")
    index.drop(title).sortWithinPartitions("term").write.mode("overwrite").option("compression", PACKED).parquet(f"{root}/terms")


def read_normalized(spark: SparkSession, directory: str, schema: str = INDEX_SCHEMA, key: tuple[str, ...] = ("bookshelf_url", "ebook_id"), title: str = "ebook_title") -> DataFrame:
    """The index ``write_normalized`` saved, as one table again; a filter on terms reaches their scan."""
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
    root = directory.rstrip("/")
    terms = spark.read.schema(", ".join(f"{c} {k}" for c, k in kinds.items() if c != title)).parquet(f"{root}/terms")
    docs = spark.read.schema(", ".join(f"{c} {kinds[c]}" for c in (*key, title))).parquet(f"{root}/ebooks")
    return terms.join(docs, list(key)).select(*kinds)


def as_maps(index: DataFrame, key: list[str]) -> DataFrame:
    """One row per document with its ``terms`` as a map from term to weight.

    A document has no more terms than the index keeps for it.
    """
    entries = F.collect_list(F.struct("term", "weight"))
    return index.groupBy(*key).agg(F.map_from_entries(entries).alias("terms"))
