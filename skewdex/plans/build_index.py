"""The two jobs: build the index of a listed library, and search it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import END_MARKERS, START_MARKERS, body
from ..operators.catalog import limit_listed_docs, limit_listed_groups
from ..operators.packing import PACK_BINS, PARTITIONS, assign_bins, hash_places
from ..operators.pages import FILE_ROOT, FILE_SUFFIXES, resolve_urls
from ..operators.search import search
from ..operators.tfidf import TOP_TERMS, last_listed, term_counts, tfidf_of_counts
from ..sources.index_store import (
    DEFAULT_DIRECTORY, INDEX_SCHEMA, KEY, attach_titles, no_clash, read_index, titles_of, with_key, write_groups, write_index,
)
from ..sources.staging import stage, temporary_tables

# Fixed value: the query that is asked if none is given.
DEFAULT_QUERY = "how to cook dinner for forty large human people"
# Text in a bin or partition where their number isn't given: a few tasks' worth of counts.
SHARE_BYTES = 4 << 30
SHELF, DOC, TITLE = "bookshelf_url", "ebook_id", "ebook_title"


def strip_boilerplate(
    docs: DataFrame,
    text: str = "text",
    start: tuple[str, ...] = START_MARKERS,
    end: tuple[str, ...] = END_MARKERS,
    joiner: str = "",
) -> DataFrame:
    """``docs`` with ``text`` cut to its body; documents without one go."""
    # Generated, not just projected: the filter would otherwise be pushed below, and every
    # body cut once to test it and again to use it.
    cut = F.explode_outer(F.array(body(text, start, end, joiner))).alias(text)
    return docs.select(*[c for c in docs.columns if c != text], cut).where(F.col(text) != "")


def index_library(
    listing: DataFrame,
    lengths: DataFrame | None,
    texts: DataFrame,
    mode: str = "skew",
    n: int | None = None,
    max_groups: int | None = None,
    max_per_group: int | None = None,
    start: tuple[str, ...] = START_MARKERS,
    end: tuple[str, ...] = END_MARKERS,
    top: int | None = TOP_TERMS,
    root: str = FILE_ROOT,
    suffixes: tuple[str, ...] = FILE_SUFFIXES,
    share_bytes: int = SHARE_BYTES,
) -> DataFrame:
    """The index rows of a listed library, as ``index_tables`` makes them, with their titles."""
    return attach_titles(*index_tables(
        listing, lengths, texts, mode, n, max_groups, max_per_group, start, end, top, root, suffixes, share_bytes
    ))


def index_tables(
    listing: DataFrame,
    lengths: DataFrame | None,
    texts: DataFrame,
    mode: str = "skew",
    n: int | None = None,
    max_groups: int | None = None,
    max_per_group: int | None = None,
    start: tuple[str, ...] = START_MARKERS,
    end: tuple[str, ...] = END_MARKERS,
    top: int | None = TOP_TERMS,
    root: str = FILE_ROOT,
    suffixes: tuple[str, ...] = FILE_SUFFIXES,
    share_bytes: int = SHARE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The index of a listed library as terms by document, and documents with their titles.

    A title may be as long as a text: it goes along with no term, only its key does.

    ``listing``: shelf_pos, bookshelf_url, ebook_pos, ebook_id, ebook_title; ``lengths``: url,
    length; ``texts``: url, text, one row per url. A document's url is the first of its
    candidates under ``root`` with a known length; with no ``lengths``, the listing itself
    has ``url`` and ``length``. Rows without an ebook_id stand for groups without documents:
    they count in ``max_groups``.

    Each text is cut to its body and counted where it is read, once, however often it is
    listed; what moves are the counts, once. ``mode`` says to where they are moved, to be
    weighed and ranked there: by document ("skew"), packed by group into ``n`` bins of even
    size ("pack"; a group above a fair share is divided), or dealt out to ``n`` partitions
    ("partition"). Without ``n`` there are 16 bins or 228 partitions, and more if there are
    more than ``share_bytes`` of text for each.
    """
    if mode not in ("skew", "pack", "partition"):
        raise ValueError(f"mode must be 'skew', 'pack' or 'partition', not {mode!r}")
    if max_groups is not None:
        listing = limit_listed_groups(listing, max_groups, "shelf_pos")
    listing = listing.where(F.col(DOC).isNotNull())
    if max_per_group is not None:
        listing = limit_listed_docs(listing, max_per_group, ["shelf_pos"], "ebook_pos")
    located = listing if lengths is None else resolve_urls(listing, lengths, DOC, root, suffixes)
    resolved = last_listed(
        located.withColumn("_at", F.struct("shelf_pos", "ebook_pos")), [SHELF, DOC, TITLE], "_at"
    ).select(SHELF, DOC, TITLE, "url", F.col("length").cast("long").alias("length"))
    # Staged, so that its size is known before the counts are joined.
    resolved = stage(with_key(resolved), "listing", packed=True)
    titles = titles_of(resolved)
    no_clash(resolved)  # a listed document comes once, under its last place
    resolved = resolved.drop(TITLE)
    counts = body_counts(texts, start, end)  # used once: staged with the listing's columns, to be weighed
    docs, layout = resolved.join(counts, "url"), None
    if mode != "skew" and n is None:
        total = resolved.agg(F.sum("length")).first()[0] or 0
        n = max(PACK_BINS if mode == "pack" else PARTITIONS, -(-total // share_bytes))
    if mode == "pack":
        # The bins go by the listing, whose rows are narrow; a bin is a partition of the weighing.
        placed, bins = assign_bins(resolved, [SHELF], "length", n, split_by=[DOC, KEY])
        # A row for each bin.
        placed = placed.join(F.broadcast(hash_places(listing.sparkSession, bins)), "bin")
        docs, layout = placed.join(counts, "url"), ("place", bins)
    elif mode == "partition":
        layout = (None, n)
    return tfidf_of_counts(docs, [SHELF], [DOC, KEY], top, layout=layout).select(SHELF, DOC, KEY, "term", "weight"), titles


def body_counts(
    texts: DataFrame, start: tuple[str, ...] = START_MARKERS, end: tuple[str, ...] = END_MARKERS
) -> DataFrame:
    """``url``, ``n_terms`` and ``counts`` of the body of each text, without any shuffle."""
    present = texts.where(F.col("text") != "").select("url", "text")
    return term_counts(strip_boilerplate(present, "text", start, end), ["url"])


def build_index(
    listing: DataFrame,
    lengths: DataFrame | None,
    texts: DataFrame,
    directory: str = DEFAULT_DIRECTORY,
    **options,
) -> None:
    """Build the index (see ``index_library``) and replace the one in ``directory``."""
    with temporary_tables(listing.sparkSession):
        # Staged, as the layout by ranges reads its input twice, to sample it and to move it.
        index, titles = index_tables(listing, lengths, texts, **options)
        write_index(stage(index, "index", packed=True), directory, titles=titles)


def replace_groups(
    listing: DataFrame,
    lengths: DataFrame | None,
    texts: DataFrame,
    directory: str = DEFAULT_DIRECTORY,
    **options,
) -> None:
    """Build the index of the listed groups and put it in the place of theirs in an index by group.

    A group's weights depend on its own documents only, so nothing else is read or written.
    """
    with temporary_tables(listing.sparkSession):
        index, titles = index_tables(listing, lengths, texts, **options)
        write_groups(stage(index, "index", packed=True), directory, SHELF, titles=titles)


def search_index(
    spark: SparkSession,
    query: str | DataFrame = DEFAULT_QUERY,
    directory: str = DEFAULT_DIRECTORY,
    schema: str = INDEX_SCHEMA,
    groups: list[str] | None = None,
    **options,
) -> DataFrame:
    """Answer a query from the saved index, of some ``groups`` only if given (options as in ``search``)."""
    index = read_index(spark, directory, schema)
    return search(index if groups is None else index.where(F.col(SHELF).isin(groups)), query, **options)
