
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewdex.functions.lines import END_MARKERS, START_MARKERS, starts_with_any
from skewdex.functions.text import STOP_WORDS
from skewdex.operators import catalog as cat
from skewdex.operators import markers, ordered, packing, pages, search, tfidf
from skewdex.plans.build_index import build_index, replace_groups, search_index, strip_boilerplate
from skewdex.sources import catalog_text, index_store
from skewdex.sources import texts as texts_of
from skewdex.sources.staging import materialize, shared_root, stage
from skewdex.sources.tables import read_spread
from skewdex.sources.texts import attach_texts, decode_text

QUERY = "thon whou erst nicht le"
ASKED = ("thon", "whou", "erst", "nicht", "le")
SMALL_START = ("The and attion", "Nicht aulich", "En laleen")
SMALL_END = ("Licensed under", "Released under")
INDEX_ROWS = "bookshelf_url string, ebook_id bigint, ebook_title string, term string, weight double"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_spread(spark, f"{sf}/documents.parquet").withColumn(
        "title", F.substring_index("text", "\n", 1)
    )


def _weight(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumn("weight", F.round("weight", digits))


def _run_path(spark: SparkSession, sf: str, name: str) -> str:
    """A path that is the same for one table folder within one application."""
    run = hashlib.md5(f"{spark.sparkContext.applicationId} {sf}".encode()).hexdigest()
    return f"{shared_root(spark)}/{name}-{run}"


# -- text and TF-IDF ---------------------------------------------------------------------


def tokenize_documents(spark, sf):
    return tfidf.tokenize(_docs(spark, sf), ["doc_id"])


def term_frequency(spark, sf):
    return tfidf.term_frequency(_docs(spark, sf), ["doc_id"]).select(
        "doc_id", "term", F.col("n").cast("long").alias("n"), F.round("tf", 6).alias("tf")
    )


def document_frequency_idf(spark, sf):
    return tfidf.idf(_docs(spark, sf), ["source"], ["doc_id"]).withColumn("idf", F.round("idf", 6))


def tfidf_index(spark, sf):
    return _weight(tfidf.tfidf(_docs(spark, sf), ["source"], ["doc_id", "title"]))


def tfidf_by_lang(spark, sf):
    return _weight(tfidf.tfidf(_docs(spark, sf), ["lang"], ["doc_id"]))


def tfidf_whole_corpus(spark, sf):
    return _weight(tfidf.tfidf(_docs(spark, sf), [], ["doc_id"]))


def tfidf_group_as_document(spark, sf):
    return _weight(tfidf.group_tfidf(_docs(spark, sf), ["source"]))


def dedupe_last_wins(spark, sf):
    return tfidf.last_listed(_t(spark, sf, "conversations"), ["conv_id", "role"], "turn")


def _saved_index(spark, sf) -> DataFrame:
    """The index over ``source``, built by the first query that needs it and then read."""

    def built():
        return tfidf.tfidf(_docs(spark, sf), ["source"], ["doc_id", "title"]).select(
            F.col("source").alias("bookshelf_url"), F.col("doc_id").alias("ebook_id"),
            F.col("title").alias("ebook_title"), "term", "weight",
        )

    return materialize(spark, _run_path(spark, sf, "saved-index"), built)


def signature_words(spark, sf):
    return _weight(
        tfidf.signature_words(_saved_index(spark, sf), ["bookshelf_url", "ebook_id"], 5)
    )


def term_weight_lookup(spark, sf):
    asked = _t(spark, sf, "documents").select(
        F.col("source").alias("bookshelf_url"), F.col("doc_id").alias("ebook_id"),
        F.explode(F.lit(list(ASKED))).alias("term"),
    )
    return _weight(
        tfidf.term_weights(asked, _saved_index(spark, sf), ["bookshelf_url", "ebook_id", "term"])
    )


# -- search ------------------------------------------------------------------------------


def _level(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity_level", F.round("similarity_level", 6))


def search_top_books(spark, sf):
    return _level(search.search(_saved_index(spark, sf), QUERY, digits=9))


def search_total_all(spark, sf):
    return _level(search.search(_saved_index(spark, sf), QUERY, k=3, total="all", digits=9))


def search_every_group(spark, sf):
    return _level(search.search(_saved_index(spark, sf), QUERY, limit=None, group_prefix="src", digits=9))


def similarity_scores(spark, sf):
    return search.similarity(
        _saved_index(spark, sf), QUERY, ["bookshelf_url", "ebook_id", "ebook_title"]
    ).withColumn("similarity_level", F.round("similarity_level", 6))


def search_whole_groups(spark, sf):
    """Every matching document with its rank, however many a group has."""
    return _level(search.search(_saved_index(spark, sf), QUERY, k=None, limit=None, total="all", digits=9))


def search_term_table(spark, sf):
    """A query of very many terms: all that the conversations hold, as a table."""
    asked = tfidf.tokenize(_t(spark, sf, "conversations"), ["conv_id", "turn"]).select("term")
    return search.similarity(_saved_index(spark, sf), asked, ["bookshelf_url", "ebook_id"]).withColumn(
        "similarity_level", F.round("similarity_level", 6)
    )


def rank_whole_groups(spark, sf):
    """RANK of all lines within three groups; a group has most of its rows in ties."""
    lines = _t(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return ordered.first_rows(lines, ["l_returnflag"], ["-l_quantity"], None, "place", ties=True)


def rank_first_5000(spark, sf):
    lines = _t(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = ["-l_extendedprice", "l_orderkey", "l_linenumber"]
    return ordered.first_rows(lines, ["l_returnflag"], order, 5000, "place")


def search_normalized_index(spark, sf):
    """The same search on an index kept as two tables, terms without titles."""
    directory = _run_path(spark, sf, "normalized")
    index_store.write_normalized(_saved_index(spark, sf), directory)
    return _level(search.search(index_store.read_normalized(spark, directory, INDEX_ROWS), QUERY, digits=9))


def search_bucketed_index(spark, sf):
    """The same search on a catalog table that is bucketed by document."""
    table = _run_path(spark, sf, "x").rpartition("/")[2].replace("-", "_")
    index_store.write_index_table(_saved_index(spark, sf), table, 8)
    return _level(search.search(spark.table(table), QUERY, digits=9))


# -- packing -----------------------------------------------------------------------------


def _line_brands(spark, sf) -> DataFrame:
    parts = _t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return _t(spark, sf, "lineitem").select("l_partkey", "l_quantity").join(parts, "l_partkey")


def _brand_bins(spark, sf) -> DataFrame:
    sizes = _line_brands(spark, sf).groupBy("p_brand").agg(F.sum("l_quantity").cast("long").alias("size"))
    return packing.pack_n_bins(sizes, ["p_brand"], "size", 4)


def _suppliers(spark, sf) -> DataFrame:
    return _t(spark, sf, "supplier").select(
        "s_nationkey", "s_suppkey", F.floor(F.abs("s_acctbal")).cast("long").alias("size")
    )


def skew_profile_lang(spark, sf):
    return _profile(packing.skew_profile(_t(spark, sf, "documents"), ["lang"]))


def skew_profile_users(spark, sf):
    return _profile(packing.skew_profile(_t(spark, sf, "events"), ["user_id"]))


def _profile(df: DataFrame) -> DataFrame:
    return df.withColumn("stddev_rows", F.round("stddev_rows", 6)).withColumn(
        "max_over_mean", F.round("max_over_mean", 6)
    )


def pack_n_bins(spark, sf):
    return _brand_bins(spark, sf)


def pack_n_bins_users(spark, sf):
    sizes = _t(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("size"))
    return packing.pack_n_bins(sizes, ["user_id"], "size", 16)


def pack_n_bins_per_nation(spark, sf):
    return packing.pack_n_bins(_suppliers(spark, sf), ["s_suppkey"], "size", 3, ["s_nationkey"])


def pack_max_capacity(spark, sf):
    return packing.pack_max_capacity(_suppliers(spark, sf), ["s_suppkey"], "size", 15000, ["s_nationkey"])


def pack_as_listed(spark, sf):
    return packing.pack_max_capacity(
        _suppliers(spark, sf), ["s_suppkey"], "size", 15000, ["s_nationkey"], listed_by="s_suppkey"
    )


def _order_sizes(spark, sf) -> DataFrame:
    return _t(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("size"))


def pack_n_bins_level(spark, sf):
    """The 100 heaviest orders by first fit, all others levelling the bins."""
    return packing.pack_n_bins(_order_sizes(spark, sf), ["o_orderkey"], "size", 16, exact=100)


def pack_level_balance(spark, sf):
    """How even the bins are, per nation of the customers."""
    sizes = _t(spark, sf, "customer").select("c_nationkey", "c_custkey", F.floor(F.abs("c_acctbal")).cast("long").alias("size"))
    bins = packing.bin_stats(packing.pack_n_bins(sizes, ["c_custkey"], "size", 4, ["c_nationkey"], exact=5), "size", ["c_nationkey"])
    return bins.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("n_items").alias("n_items"), F.sum("bin_size").alias("total"),
        F.max("bin_size").alias("largest"), F.round(F.max("bin_size") * 4 / F.sum("bin_size"), 6).alias("max_over_mean"),
    )


def pack_max_capacity_fill(spark, sf):
    """Orders in bins of 2,000,000, most of them in parallel: every order, and whether its bin is within that."""
    packed = stage(packing.pack_max_capacity(_order_sizes(spark, sf), ["o_orderkey"], "size", 2_000_000, exact=50), "packed")
    within = packing.bin_stats(packed, "size").select("bin", (F.col("bin_size") <= 2_000_000).alias("within"))
    return packed.join(within, "bin").select("o_orderkey", "size", "within")


def bin_lookup(spark, sf):
    return packing.bin_lookup(
        _t(spark, sf, "part").select("p_partkey", "p_brand"), stage(_brand_bins(spark, sf), "bins"),
        ["p_brand"], "size", strict=True,
    )


def bin_stats(spark, sf):
    return packing.bin_stats(_brand_bins(spark, sf), "size")


def bin_count(spark, sf):
    packed = packing.pack_max_capacity(_suppliers(spark, sf), ["s_suppkey"], "size", 15000, ["s_nationkey"])
    return packing.n_bins(packed, ["s_nationkey"])


def repartition_packed(spark, sf):
    lines = _line_brands(spark, sf).withColumn("size", F.col("l_quantity").cast("long"))
    rows = packing.repartition_packed(lines, ["p_brand"], "size", 4)
    return rows.groupBy(F.spark_partition_id().alias("pid")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("l_quantity").alias("sum_qty"),
        F.countDistinct("p_brand").alias("n_brands"),
    )


def repartition_packed_split(spark, sf):
    rows = packing.repartition_packed(
        _t(spark, sf, "documents"), ["lang"], "n_chars", 8, split_by=["doc_id"]
    )
    return rows.groupBy(F.spark_partition_id().alias("pid")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("sum_chars"), F.countDistinct("lang").alias("n_langs")
    )


def repartition_builtin(spark, sf):
    rows = packing.rebalance(_t(spark, sf, "lineitem"), ["l_partkey"], "l_quantity", "partition", 16)
    return rows.select(F.spark_partition_id().alias("pid")).agg(
        F.countDistinct("pid").alias("n_parts"), F.count(F.lit(1)).alias("n_rows")
    )


# -- pages -------------------------------------------------------------------------------


def _pages(spark, sf) -> DataFrame:
    return read_spread(spark, f"{sf}/pages.parquet")


def extract_links(spark, sf):
    return pages.links(_pages(spark, sf), ["page_id"])


def filter_links(spark, sf):
    found = pages.links(_pages(spark, sf), ["page_id"])
    kept = pages.group_links(found, pattern="/[a-z]+", denied=("/and", "/the", "/to"))
    return kept.select("page_id", "pos", "href", pages.absolute("href", "https://example.org").alias("url"))


def _listed(spark, sf) -> DataFrame:
    """Documents as a library: ten numbers to a group, fifty groups to an index page."""
    title = F.concat(F.lit('T <"&'), "title")
    return _docs(spark, sf).select(
        "doc_id", F.trim(F.regexp_replace(title, r"[ \t\r\n]+", " ")).alias("title"),
        F.expr("doc_id div 10").alias("shelf"),
    )


def _listed_pages(spark, sf) -> tuple[DataFrame, DataFrame]:
    # A page has ten or fifty anchors at the most, by the division of a unique number.
    written = F.col("title")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("é", "&eacute;"), ("ü", "&#252;"), ("ñ", "&#xF1;")):
        written = F.replace(written, F.lit(char), F.lit(entity))
    anchor = F.concat(
        F.lit('<li><a class="x" title="ebook:'), "doc_id", F.lit('" href="/ebooks/'), "doc_id",
        F.lit('"><i>'), written, F.lit("</i></a> <a href='/wiki/Main_Page' title='Main'>top</a></li>"),
    )
    shelves = _listed(spark, sf).groupBy("shelf").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", anchor.alias("a")))), lambda x: x.a), "").alias("html")
    )
    link = F.concat(F.lit('<a href="/wiki/S'), "shelf", F.lit('_(Bookshelf)">s</a><a href="/wiki/Special:Search">?</a>'))
    index = shelves.select("shelf", link.alias("a")).groupBy(F.expr("shelf div 50").alias("page_no")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("shelf", "a"))), lambda x: x.a), "").alias("html")
    )
    url = F.concat(F.lit("https://example.org/wiki/S"), "shelf", F.lit("_(Bookshelf)"))
    return index, shelves.select(url.alias("url"), "html")


def typed_anchors(spark, sf):
    return pages.typed_anchors(_listed_pages(spark, sf)[1], ["url"])


def build_catalog(spark, sf):
    index, shelf_pages = _listed_pages(spark, sf)
    listing = pages.catalog(index, shelf_pages, base="https://example.org")
    return listing.select("shelf_pos", "bookshelf_url", "ebook_pos", "ebook_id", "ebook_title")


def build_catalog_stored(spark, sf):
    """The listing from the stored pages alone, with one index page that links all shelves."""
    index, shelf_pages = _listed_pages(spark, sf)
    # An address of which there is one page, as long as the library has shelves.
    whole = index.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "html"))), lambda p: p.html), "").alias("html"))
    return pages.build_catalog(
        shelf_pages.unionByName(whole.select(F.lit("https://example.org/index").alias("url"), "html")),
        ("https://example.org/none", "https://example.org/index"), base="https://example.org",
    )


def build_catalog_all_stored(spark, sf):
    """The listing from the stored pages alone, with every index page under an address of its own."""
    index, shelf_pages = _listed_pages(spark, sf)
    stored = index.select(F.concat(F.lit("https://example.org/index/"), "page_no").alias("url"), "html", "page_no")
    return pages.build_catalog(
        shelf_pages.unionByName(stored.select("url", "html")), stored.select("url", "page_no"), base="https://example.org"
    )


def candidate_urls(spark, sf):
    return pages.candidate_urls(_t(spark, sf, "documents").select("doc_id"), "doc_id", root="http://files")


def _lengths(spark, sf) -> DataFrame:
    """Files in store: what there is of a document depends on its language and length."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    there = (
        F.when(F.col("priority") == 0, F.col("lang") == "en")
        .when(F.col("priority") == 1, F.col("n_chars") > 1000)
        .otherwise(F.col("lang").isin("fr", "en"))
    )
    return (
        pages.candidate_urls(docs, "doc_id", root="http://files").where(there)
        .select("url", (F.col("n_chars") + F.col("priority")).alias("length"))
    )


def first_available(spark, sf):
    listing = _t(spark, sf, "documents").select("doc_id")
    candidates = pages.candidate_urls(listing, "doc_id", root="http://files")
    return pages.first_available(candidates, _lengths(spark, sf), "doc_id")


def group_text_size(spark, sf):
    resolved = _t(spark, sf, "documents").select("source", F.col("n_chars").alias("length"))
    return pages.group_sizes(resolved, ["source"])


def attach_stored_texts(spark, sf):
    listing = _t(spark, sf, "labels").select(
        "doc_id", "quality", F.concat(F.lit("u"), "doc_id").alias("url")
    )
    texts = _t(spark, sf, "documents").select(F.concat(F.lit("u"), "doc_id").alias("url"), "text")
    return attach_texts(listing, texts).select("doc_id", "quality", "url", "text")


# -- bodies ------------------------------------------------------------------------------


def strip_by_markers(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "text")
    return strip_boilerplate(docs, "text", SMALL_START, SMALL_END, joiner="|")


def _wrapped(text) -> F.Column:
    return F.concat(
        F.lit("Title\n\n*** START OF THIS PROJECT GUTENBERG EBOOK ***\n"), text,
        F.lit("\nEnd of Project Gutenberg's book\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\ntail\n"),
    )


def strip_wrapped(spark, sf):
    docs = _docs(spark, sf).select("doc_id", _wrapped(F.col("text")).alias("text"))
    return strip_boilerplate(docs)


def marker_lines(spark, sf):
    lines = _docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(starts_with_any("line", SMALL_START + SMALL_END))


def _many_markers(spark, sf) -> DataFrame:
    """A marker for each line of the documents: its first 4 to 16 characters, by its place."""
    lines = _docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", "line", F.left("line", F.col("doc_id") % 13 + 4).alias("marker"))


def marker_lines_many(spark, sf):
    """Lines with the longest of very many markers that begins them."""
    marked = _many_markers(spark, sf)
    lines = marked.select("doc_id", "line_no", F.substr("line", F.lit(1)).alias("line"))
    return markers.marked_lines(lines, ["doc_id", "line_no"], "line", marked.where(F.length("marker") > 6).select("marker"))


def strip_by_many_markers(spark, sf):
    """Bodies between lines that begin like some line of a benchmark item or of a message."""
    docs = _docs(spark, sf).select("doc_id", "text")
    start = _t(spark, sf, "benchmark").select(F.left("text", F.lit(4)).alias("marker"))
    end = _t(spark, sf, "conversations").select(F.left("text", F.col("turn") % 3 + 5).alias("marker"))
    return markers.bodies_between(docs, ["doc_id"], "text", start, end, joiner="|")


def decode_latin1(spark, sf):
    """Every text as the bytes of its UTF-8, read as Latin-1: any bytes decode, one character each."""
    files = _t(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return decode_text(files).select("doc_id", F.length("text").alias("n_chars"), F.md5(F.encode("text", "ISO-8859-1")).alias("md5"))


# -- catalog and storage -----------------------------------------------------------------


def _flat_listing(spark, sf) -> DataFrame:
    return _t(spark, sf, "documents").select(
        F.col("source").alias("bookshelf_url"),
        F.substring("source", 4, 9).cast("long").alias("shelf_pos"),
        F.col("doc_id").alias("ebook_id"),
    )


def limit_groups(spark, sf):
    return cat.limit_listed_groups(_flat_listing(spark, sf), 3, "shelf_pos")


def limit_per_group(spark, sf):
    return cat.limit_listed_docs(_flat_listing(spark, sf), 5, ["shelf_pos"], "ebook_id")


def _holdable(title: str) -> F.Column:
    """All that the catalog text can't hold, replaced; signs of separators at the end stay."""
    return F.regexp_replace(F.regexp_replace(title, "%%%|!!!", "-"), "##+([^#])", "-$1")


def catalog_codec_roundtrip(spark, sf):
    listing = _listed(spark, sf).select(
        F.col("shelf").alias("shelf_pos"), F.concat(F.lit("u"), "shelf").alias("bookshelf_url"),
        F.col("doc_id").alias("ebook_pos"), F.col("doc_id").alias("ebook_id"),
        _holdable("title").alias("ebook_title"),
    )
    path = _run_path(spark, sf, f"catalog-{uuid.uuid4().hex}")
    catalog_text.write_catalog(cat.nest(listing), path)
    read = catalog_text.read_catalog(spark, path, "bigint")
    return cat.flatten(read.withColumn("pos", F.substring("url", 2, 12).cast("long")))


def catalog_long_group(spark, sf):
    """All documents as one group, written in lines of a thousand and put in order again."""
    listing = _listed(spark, sf).select(
        F.lit(7).alias("shelf_pos"), F.lit("all").alias("bookshelf_url"), F.col("doc_id").alias("ebook_pos"),
        F.col("doc_id").alias("ebook_id"), _holdable("title").alias("ebook_title"),
    )
    path = _run_path(spark, sf, f"listing-{uuid.uuid4().hex}")
    catalog_text.write_listing(listing, path, per_line=1000)
    read = catalog_text.read_listing(spark, path, "bigint")
    return read.select(
        "shelf_pos", "bookshelf_url", (F.col("part") * 1000 + F.col("place")).alias("ebook_pos"), "ebook_id", "ebook_title"
    )


def rows_in_memory(spark, sf):
    """The nations, held by the caller, as a table of 34 slices, each with its customers."""
    held = [(r.n_nationkey, r.n_name) for r in _t(spark, sf, "nation").collect()]  # 25 of them
    nations = cat.from_rows(spark, held, "c_nationkey int, n_name string")
    return _t(spark, sf, "customer").join(nations, "c_nationkey").groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"))


def materialize_roundtrip(spark, sf):
    path = _run_path(spark, sf, "orders")

    def built():
        return _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")

    materialize(spark, path, built)
    return materialize(spark, path, built)


def index_roundtrip(spark, sf):
    directory = _run_path(spark, sf, "index")
    index_store.write_index(_saved_index(spark, sf), directory)
    return _weight(index_store.read_index(spark, directory, INDEX_ROWS))


def index_as_maps(spark, sf):
    maps = index_store.as_maps(_saved_index(spark, sf), ["bookshelf_url", "ebook_id", "ebook_title"])
    return _weight(
        maps.select("bookshelf_url", "ebook_id", "ebook_title", F.explode("terms").alias("term", "weight"))
    )


def dictionary_lookup(spark, sf):
    entries = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return cat.dictionary_lookup(_t(spark, sf, "events").select("event_id", "user_id"), entries, "user_id")


# -- jobs --------------------------------------------------------------------------------


def _library(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents as listing, file lengths and wrapped texts; some are listed twice."""
    docs = _docs(spark, sf)
    once = docs.select(
        F.substring("source", 4, 9).cast("long").alias("shelf_pos"),
        F.col("source").alias("bookshelf_url"), F.col("doc_id").alias("ebook_pos"),
        F.col("doc_id").alias("ebook_id"), F.col("title").alias("ebook_title"), "n_chars",
    )
    again = once.where("n_chars > 1000").withColumn("ebook_pos", F.col("ebook_pos") + (1 << 40))
    urls = pages.candidate_urls(docs.select("doc_id", "n_chars", "text"), "doc_id").where("priority = 1")
    listing = once.unionByName(again).drop("n_chars")
    return (
        listing,
        urls.select("url", F.col("n_chars").alias("length")),
        urls.select("url", _wrapped(F.col("text")).alias("text")),
    )


def _built(spark, sf, mode) -> DataFrame:
    directory = _run_path(spark, sf, f"library-{mode}")
    build_index(*_library(spark, sf), directory=directory, mode=mode)
    return index_store.read_index(spark, directory, INDEX_ROWS)


def build_index_skew(spark, sf):
    return _weight(_built(spark, sf, "skew"))


def build_index_pack(spark, sf):
    return _weight(_built(spark, sf, "pack"))


def build_index_partition(spark, sf):
    return _weight(_built(spark, sf, "partition"))


def build_index_files(spark, sf):
    """The index from stored files: every text a file of its own, whose address and length are the store's."""
    listing, _, _ = _library(spark, sf)
    directory = _run_path(spark, sf, f"files-{uuid.uuid4().hex}")
    texts = _docs(spark, sf).select("doc_id", _wrapped(F.col("text")).alias("value")).where("value <> ''")
    name = F.concat(F.lit("doc_id="), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    stored = texts.select(name.alias("name"), F.concat("value", F.lit("\n")).alias("content"))
    files = texts_of.read_files(spark, *texts_of.write_files(stored, f"{directory}/texts"))
    number = F.regexp_extract("url", r"doc_id=(-?\d*)\.txt$", 1).try_cast("long")
    stored = files.select("url", "length", number.alias("ebook_id"))
    build_index(listing.join(stored, "ebook_id"), None, texts_of.decode_text(files, charset="UTF-8"), directory=directory)
    return _weight(index_store.read_index(spark, directory, INDEX_ROWS))


def replace_index_group(spark, sf):
    """An index by group in which the longest group has drafts of titles, and is then built anew."""
    listing, lengths, texts = _library(spark, sf)
    directory = _run_path(spark, sf, f"by-group-{uuid.uuid4().hex}")
    longest = listing.groupBy("bookshelf_url").count().orderBy(F.desc("count"), "bookshelf_url").first()[0]
    of_longest = F.col("bookshelf_url") == longest
    drafts = listing.withColumn("ebook_title", F.when(of_longest, F.lit("draft")).otherwise(F.col("ebook_title")))
    replace_groups(drafts, lengths, texts, directory=directory)
    replace_groups(listing.where(of_longest), lengths, texts, directory=directory)
    return _weight(index_store.read_index(spark, directory, INDEX_ROWS))


def build_and_search(spark, sf):
    directory = _run_path(spark, sf, "searched")
    build_index(*_library(spark, sf), directory=directory)
    return _level(search_index(spark, QUERY, directory, INDEX_ROWS, digits=9))


def build_index_limits(spark, sf):
    """The first three groups and five documents of each; the first group has no documents."""
    listing, lengths, texts = _library(spark, sf)
    none = spark.range(1).select(F.lit(-1).cast("long").alias("shelf_pos"), F.lit("empty").alias("bookshelf_url"))
    directory = _run_path(spark, sf, "limited")
    build_index(
        listing.unionByName(none, allowMissingColumns=True), lengths, texts, directory=directory, max_groups=4, max_per_group=5
    )
    return _weight(index_store.read_index(spark, directory, INDEX_ROWS))


# -- SQL ---------------------------------------------------------------------------------


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql_terms(text: str) -> str:
    return (
        rf"list_filter(list_transform(list_filter(string_split_regex(lower({text}), '\W+'), "
        rf"lambda w: w NOT IN ({_quoted(STOP_WORDS)})), "
        rf"lambda w: regexp_replace(trim(w), '[[:punct:]]', '', 'g')), lambda w: length(w) > 1)"
    )


_TITLE = "split_part(text, chr(10), 1)"


def _sql_index(scope: str, doc: str, text: str = "text", title: str | None = None, source: str = "documents") -> str:
    """CTEs that end in ``idx``: scope, doc, [title,] term, weight."""
    extra = f", {title} AS title" if title else ""
    t = ", title" if title else ""
    return f"""
    corpus AS (SELECT {scope} AS scope, {doc} AS doc{extra}, {_sql_terms(text)} AS ts FROM {source}),
    words AS (SELECT scope, doc{t}, len(ts) AS n_terms, unnest(ts) AS term FROM corpus),
    tf AS (SELECT scope, doc{t}, n_terms, term, count(*) AS n FROM words GROUP BY ALL),
    dfs AS (SELECT scope, term, count(*) AS df FROM tf GROUP BY ALL),
    sizes AS (SELECT scope, count(*) AS n_docs FROM corpus GROUP BY ALL),
    idx AS (
      SELECT scope, doc{t}, term, n / n_terms * ln(n_docs / (1.0 + df)) AS weight
      FROM tf JOIN dfs USING (scope, term) JOIN sizes USING (scope)
      QUALIFY row_number() OVER (PARTITION BY scope, doc{t} ORDER BY weight DESC, term) <= 500)"""


_SAVED = "WITH" + _sql_index("source", "doc_id", title=_TITLE)
_LIBRARY = "WITH" + _sql_index(
    "source", "doc_id", "replace(text, chr(10), '')", _TITLE, "(SELECT * FROM documents WHERE text <> '')"
)
_INDEX_OUT = (
    " SELECT scope AS bookshelf_url, doc AS ebook_id, title AS ebook_title, term, "
    "round(weight, 6) AS weight FROM idx"
)


_SUM = "sum(weight::DECIMAL(38, 18))::DOUBLE"


def _sql_search(index: str, k: int, total: str, limit: str, prefix: int = 0) -> str:
    level = (
        "sum(similarity_level) FILTER (topN <= {k})" if total == "topk" else "sum(similarity_level)"
    ).format(k=k)
    return f"""{index},
    scores AS (SELECT scope, doc, title, round({_SUM}, 9) AS similarity_level FROM idx
      WHERE term IN ({_quoted(ASKED)}) GROUP BY ALL HAVING {_SUM} > 0.001),
    ranked AS (SELECT *, rank() OVER (PARTITION BY scope ORDER BY similarity_level DESC) AS topN FROM scores),
    levels AS (SELECT scope, round({level}, 9) AS level FROM ranked GROUP BY scope)
    SELECT scope[{prefix + 1}:] AS bookshelf, title[:60] AS title, round(similarity_level, 6) AS similarity_level
      {", place" if limit else ""}
    FROM (SELECT *, (row_number() OVER (ORDER BY level DESC, scope, topN, doc))::INTEGER AS place
          FROM ranked JOIN levels USING (scope) WHERE topN <= {k} ORDER BY place {limit})"""


def _sql_pack(items: str, capacity: str | None, nbins: int | None, order: str = "size DESC, item DESC") -> str:
    """CTEs that end in ``packed``: grp, item, size, bin. ``items``: SELECT grp, item, size."""
    cap = capacity or "max(size) OVER (PARTITION BY grp)"
    full = "false" if nbins is None else f"len(loads) >= {nbins}"
    return f"""WITH RECURSIVE items AS (
      SELECT *, {cap} AS cap, row_number() OVER (PARTITION BY grp ORDER BY {order}) AS rn FROM ({items})),
    fold AS (
      SELECT DISTINCT grp, 0::BIGINT AS rn, []::BIGINT[] AS loads, 0::BIGINT AS slot FROM items
      UNION ALL
      SELECT grp, rn, CASE WHEN slot > len(loads) THEN list_append(loads, size)
        ELSE list_transform(loads, lambda l, i: CASE WHEN i = slot THEN l + size ELSE l END) END, slot
      FROM (SELECT f.grp, i.rn, f.loads, i.size,
          coalesce(nullif(list_position(list_transform(f.loads, lambda l: l + i.size <= i.cap), true), 0),
            CASE WHEN {full.replace('loads', 'f.loads')} THEN list_position(f.loads, list_min(f.loads))
            ELSE len(f.loads) + 1 END)::BIGINT AS slot
        FROM fold f JOIN items i ON i.grp = f.grp AND i.rn = f.rn + 1)),
    packed AS (SELECT grp, item, size, (slot - 1)::INTEGER AS bin FROM fold JOIN items USING (grp, rn))"""


_BRANDS = _sql_pack(
    "SELECT 0 AS grp, p_brand AS item, sum(l_quantity)::BIGINT AS size "
    "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand", None, 4,
)
# Documents with the part of their language: as many parts as it has eighths of all characters, by CRC-32.
_PARTED = """SELECT doc_id, lang, n_chars, CASE WHEN total * 8 > alls THEN crc % ceil(total / share)::BIGINT ELSE 0 END AS part
    FROM (SELECT *, sum(n_chars) OVER (PARTITION BY lang) AS total, sum(n_chars) OVER () AS alls, ceil(sum(n_chars) OVER () / 8) AS share,
        xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) AS crc
      FROM documents, (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS crcs))"""
_LANG_PARTS = f"SELECT 0 AS grp, lang || ':' || part AS item, lang, part, sum(n_chars)::BIGINT AS size FROM ({_PARTED}) GROUP BY lang, part"


def _sql_level(items: str, nbins: int, exact: int) -> str:
    """CTEs that end in ``levelled``: grp, item, size, bin. ``items``: SELECT grp, item, size."""
    order = "PARTITION BY grp ORDER BY size DESC, item DESC"
    heavy = f"SELECT * FROM ({items}) QUALIFY row_number() OVER ({order}) <= {exact}"
    return f"""{_sql_pack(heavy, None, nbins)},
    tail AS (SELECT grp, item, size, sum(size) OVER ({order}) - size AS st
      FROM (SELECT *, row_number() OVER ({order}) AS rn FROM ({items})) WHERE rn > {exact}),
    totals AS (SELECT grp, sum(size) AS alls FROM tail GROUP BY grp),
    loads AS (SELECT grp, bin::INTEGER AS bin, coalesce(l, 0) AS load FROM totals, range({nbins}) AS b(bin)
      LEFT JOIN (SELECT grp AS g, bin AS used, sum(size) AS l FROM packed GROUP BY ALL) ON g = grp AND used = bin),
    ranks AS (SELECT *, row_number() OVER w AS k, sum(load) OVER w AS s FROM loads JOIN totals USING (grp)
      WINDOW w AS (PARTITION BY grp ORDER BY load, bin)),
    level AS (SELECT grp, max(k) AS kk, arg_max(s, k) AS filled FROM ranks WHERE load * k < alls + s OR k = 1 GROUP BY grp),
    rooms AS (SELECT grp, bin, kk, room, sum(room) OVER (PARTITION BY grp ORDER BY k) AS hi
      FROM (SELECT *, 2 * (alls + filled - kk * load) AS room FROM ranks JOIN level USING (grp) WHERE k <= kk)),
    levelled AS (SELECT grp, item, size, bin FROM packed UNION ALL
      SELECT tail.grp, item, size, bin FROM tail JOIN rooms ON rooms.grp = tail.grp
        AND (2 * st + size) * kk >= hi - room AND (2 * st + size) * kk < hi)"""


_ORDERS = "SELECT 0 AS grp, o_orderkey AS item, floor(o_totalprice)::BIGINT AS size FROM orders"
_CUSTOMERS = "SELECT c_nationkey AS grp, c_custkey AS item, floor(abs(c_acctbal))::BIGINT AS size FROM customer"
_SUPPLIERS = "SELECT s_nationkey AS grp, s_suppkey AS item, floor(abs(s_acctbal))::BIGINT AS size FROM supplier"
_NATION_OUT = " SELECT grp AS s_nationkey, item AS s_suppkey, size, bin FROM packed"

_SEEN = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g')"
_LINKS = rf"""WITH tags AS (SELECT page_id, regexp_extract_all({_SEEN}, '(?is)<a\s((?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1) AS tags FROM pages),
    tag AS (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS pos FROM tags),
    links AS (SELECT page_id, pos::INTEGER AS pos, replace(replace(replace(replace(replace(replace(
        coalesce(nullif(regexp_extract(tag, '(?is)(?:^|[\s"''])href\s*=\s*"([^"]*)"', 1), ''),
          nullif(regexp_extract(tag, '(?is)(?:^|[\s"''])href\s*=\s*''([^'']*)''', 1), ''),
          regexp_extract(tag, '(?is)(?:^|[\s"''])href\s*=\s*([^\s"''>]+)', 1)),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS href
      FROM tag WHERE regexp_matches(tag, '(?is)(?:^|[\s"''])href\s*=\s*\S'))"""

_LISTED = rf"""SELECT doc_id, doc_id // 10 AS shelf,
    trim(regexp_replace('T <"&' || {_TITLE}, '[ \t\r\n]+', ' ', 'g')) AS title FROM documents"""

_PATH = """array_to_string(string_split(left(doc_id::VARCHAR, length(doc_id::VARCHAR) - 1), ''), '/')"""
_CANDIDATES = f"""(SELECT doc_id, lang, n_chars, priority::INTEGER AS priority,
    'http://files/' || CASE WHEN doc_id < 10 THEN '' ELSE {_PATH} END || '/' || doc_id || '/' || doc_id || suffix AS url
    FROM documents, (VALUES (0, '.txt'), (1, '-8.txt'), (2, '-0.txt')) AS s(priority, suffix))"""


def _sql_body(text: str, start, end, joiner: str) -> str:
    def marked(lines, markers):
        return (
            f"list_position(list_transform({lines}, lambda l: "
            + " OR ".join(f"starts_with(l, {_quoted([m])})" for m in dict.fromkeys(markers)) + "), true)"
        )

    return f"""WITH split AS (SELECT doc_id, string_split(rtrim({text}, chr(10)), chr(10)) AS lines FROM documents),
    opened AS (SELECT doc_id, lines[mark + 1:] AS lines FROM (SELECT *, {marked('lines', start)} AS mark FROM split) WHERE mark > 0),
    closed AS (SELECT doc_id, CASE WHEN mark > 0 THEN lines[:mark - 1] ELSE lines END AS lines
      FROM (SELECT *, {marked('lines', end)} AS mark FROM opened))
    SELECT doc_id, array_to_string(lines, '{joiner}') AS text FROM closed
    WHERE array_to_string(lines, '{joiner}') <> ''"""


_WRAPPED = (
    "'Title' || chr(10) || chr(10) || '*** START OF THIS PROJECT GUTENBERG EBOOK ***' || chr(10) || text || chr(10) || "
    "'End of Project Gutenberg''s book' || chr(10) || 'tail'"
)


def _sql_profile(table: str, key: str) -> str:
    return f"""SELECT count(*) AS n_groups, min(n) AS min_rows, max(n) AS max_rows,
      round(stddev_pop(n), 6) AS stddev_rows, round(max(n) / avg(n), 6) AS max_over_mean
      FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""


_SQL = {
    "tokenize_documents": f"""SELECT doc_id, (generate_subscripts(ts, 1) - 1)::INTEGER AS pos, unnest(ts) AS term
        FROM (SELECT doc_id, {_sql_terms('text')} AS ts FROM documents)""",
    "term_frequency": f"""WITH {_sql_index('0', 'doc_id')}
        SELECT doc AS doc_id, term, n, round(n / n_terms, 6) AS tf FROM tf""",
    "document_frequency_idf": f"""WITH {_sql_index('source', 'doc_id')}
        SELECT scope AS source, term, df, n_docs, round(ln(n_docs / (1.0 + df)), 6) AS idf
        FROM dfs JOIN sizes USING (scope)""",
    "tfidf_index": _SAVED + " SELECT scope AS source, doc AS doc_id, title, term, round(weight, 6) AS weight FROM idx",
    "tfidf_by_lang": f"""WITH {_sql_index('lang', 'doc_id')}
        SELECT scope AS lang, doc AS doc_id, term, round(weight, 6) AS weight FROM idx""",
    "tfidf_whole_corpus": f"""WITH {_sql_index('0', 'doc_id')}
        SELECT doc AS doc_id, term, round(weight, 6) AS weight FROM idx""",
    "tfidf_group_as_document": f"""WITH words AS (SELECT source, unnest({_sql_terms('text')}) AS term FROM documents),
        n AS (SELECT source, term, count(*) AS n FROM words GROUP BY ALL),
        w AS (SELECT source, term, n / sum(n) OVER (PARTITION BY source) * ln(0.5) AS weight FROM n)
        SELECT source, term, round(weight, 6) AS weight FROM w
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY weight DESC, term) <= 500""",
    "dedupe_last_wins": """SELECT * FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) = 1""",
    "signature_words": _SAVED + """ SELECT scope AS bookshelf_url, doc AS ebook_id, term, round(weight, 6) AS weight,
        (row_number() OVER (PARTITION BY scope, doc ORDER BY weight DESC, term))::INTEGER AS place
        FROM idx QUALIFY place <= 5""",
    "term_weight_lookup": _SAVED + f""" SELECT source AS bookshelf_url, doc_id AS ebook_id, a.term,
        round(coalesce(weight, 0.0), 6) AS weight
        FROM (SELECT source, doc_id, unnest([{_quoted(ASKED)}]) AS term FROM documents) a
        LEFT JOIN idx ON scope = source AND doc = doc_id AND idx.term = a.term""",
    "search_top_books": _sql_search(_SAVED, 2, "topk", "LIMIT 10"),
    "search_total_all": _sql_search(_SAVED, 3, "all", "LIMIT 10"),
    "search_normalized_index": _sql_search(_SAVED, 2, "topk", "LIMIT 10"),
    "search_bucketed_index": _sql_search(_SAVED, 2, "topk", "LIMIT 10"),
    "search_every_group": _sql_search(_SAVED, 2, "topk", "", 3),
    "search_whole_groups": _sql_search(_SAVED, 1 << 60, "all", ""),
    "search_term_table": _SAVED + f""", asked AS (SELECT DISTINCT unnest({_sql_terms('text')}) AS term FROM conversations)
        SELECT scope AS bookshelf_url, doc AS ebook_id, round({_SUM}, 6) AS similarity_level
        FROM idx WHERE term IN (SELECT term FROM asked) GROUP BY ALL HAVING {_SUM} > 0.001""",
    "rank_whole_groups": """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity,
        rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS place FROM lineitem""",
    "rank_first_5000": """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place
        FROM lineitem QUALIFY place <= 5000""",
    "similarity_scores": _SAVED + f""" SELECT scope AS bookshelf_url, doc AS ebook_id, title AS ebook_title,
        round({_SUM}, 6) AS similarity_level FROM idx WHERE term IN ({_quoted(ASKED)})
        GROUP BY ALL HAVING {_SUM} > 0.001""",
    "skew_profile_lang": _sql_profile("documents", "lang"),
    "skew_profile_users": _sql_profile("events", "user_id"),
    "pack_n_bins": _BRANDS + " SELECT item AS p_brand, size, bin FROM packed",
    "pack_n_bins_users": _sql_pack(
        "SELECT 0 AS grp, user_id AS item, count(*) AS size FROM events GROUP BY user_id", None, 16
    ) + " SELECT item AS user_id, size, bin FROM packed",
    "pack_n_bins_per_nation": _sql_pack(_SUPPLIERS, None, 3) + _NATION_OUT,
    "pack_max_capacity": _sql_pack(_SUPPLIERS, "15000", None) + _NATION_OUT,
    "pack_as_listed": _sql_pack(_SUPPLIERS, "15000", None, "item") + _NATION_OUT,
    "pack_n_bins_level": _sql_level(_ORDERS, 16, 100) + " SELECT item AS o_orderkey, size, bin FROM levelled",
    "pack_level_balance": _sql_level(_CUSTOMERS, 4, 5) + """ SELECT grp AS c_nationkey, count(*) AS n_bins, sum(n)::BIGINT AS n_items,
        sum(b)::BIGINT AS total, max(b)::BIGINT AS largest, round(max(b) * 4 / sum(b), 6) AS max_over_mean
        FROM (SELECT grp, bin, count(*) AS n, sum(size) AS b FROM levelled GROUP BY ALL) GROUP BY grp""",
    "pack_max_capacity_fill": f"SELECT item AS o_orderkey, size, true AS within FROM ({_ORDERS})",
    "bin_lookup": _BRANDS + " SELECT p_partkey, p_brand, bin FROM part LEFT JOIN packed ON p_brand = item",
    "bin_stats": _BRANDS + """ SELECT bin, count(*) AS n_items, sum(size)::BIGINT AS bin_size, 'Bin#' || bin AS label
        FROM packed GROUP BY bin""",
    "bin_count": _sql_pack(_SUPPLIERS, "15000", None)
    + " SELECT grp AS s_nationkey, (max(bin) + 1)::INTEGER AS n_bins FROM packed GROUP BY grp",
    "repartition_packed": _BRANDS + """ SELECT bin AS pid, count(*) AS n_rows, sum(l_quantity) AS sum_qty,
        count(DISTINCT p_brand) AS n_brands
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN packed ON item = p_brand GROUP BY bin""",
    "repartition_packed_split": _sql_pack(_LANG_PARTS, None, 8, "size DESC, lang DESC, part DESC") + f""", parted AS ({_PARTED})
        SELECT bin AS pid, count(*) AS n_docs, sum(n_chars)::BIGINT AS sum_chars, count(DISTINCT lang) AS n_langs
        FROM parted JOIN packed ON item = lang || ':' || part GROUP BY bin""",
    "repartition_builtin": "SELECT 16::BIGINT AS n_parts, count(*) AS n_rows FROM lineitem",
    "extract_links": _LINKS + " SELECT page_id, pos, href FROM links",
    "filter_links": _LINKS + """ SELECT page_id, pos, href, 'https://example.org' || href AS url FROM links
        WHERE href NOT IN ('/and', '/the', '/to') AND regexp_full_match(href, '/[a-z]+')""",
    "typed_anchors": f"""SELECT 'https://example.org/wiki/S' || shelf || '_(Bookshelf)' AS url,
        (2 * (doc_id % 10))::INTEGER AS pos, doc_id AS ebook_id, title AS ebook_title
        FROM ({_LISTED}) WHERE doc_id >= 10""",
    "build_catalog": f"""SELECT ((shelf // 50) << 32) + 2 * (shelf % 50) AS shelf_pos,
        'https://example.org/wiki/S' || shelf || '_(Bookshelf)' AS bookshelf_url,
        CASE WHEN doc_id >= 10 THEN (2 * (doc_id % 10))::INTEGER END AS ebook_pos, CASE WHEN doc_id >= 10 THEN doc_id END AS ebook_id,
        CASE WHEN doc_id >= 10 THEN title END AS ebook_title FROM ({_LISTED}) WHERE doc_id >= 10 OR doc_id = 0""",
    "build_catalog_stored": f"""SELECT (2::BIGINT << 32) + 2 * shelf AS shelf_pos,
        'https://example.org/wiki/S' || shelf || '_(Bookshelf)' AS bookshelf_url,
        CASE WHEN doc_id >= 10 THEN (2 * (doc_id % 10))::INTEGER END AS ebook_pos, CASE WHEN doc_id >= 10 THEN doc_id END AS ebook_id,
        CASE WHEN doc_id >= 10 THEN title END AS ebook_title FROM ({_LISTED}) WHERE doc_id >= 10 OR doc_id = 0""",
    "build_catalog_all_stored": f"""SELECT ((shelf // 50) << 32) + 2 * (shelf % 50) AS shelf_pos,
        'https://example.org/wiki/S' || shelf || '_(Bookshelf)' AS bookshelf_url,
        CASE WHEN doc_id >= 10 THEN (2 * (doc_id % 10))::INTEGER END AS ebook_pos, CASE WHEN doc_id >= 10 THEN doc_id END AS ebook_id,
        CASE WHEN doc_id >= 10 THEN title END AS ebook_title FROM ({_LISTED}) WHERE doc_id >= 10 OR doc_id = 0""",
    "candidate_urls": f"SELECT doc_id, priority, url FROM {_CANDIDATES}",
    "first_available": f"""SELECT doc_id, url, n_chars + priority AS length FROM {_CANDIDATES}
        WHERE CASE priority WHEN 0 THEN lang = 'en' WHEN 1 THEN n_chars > 1000 ELSE lang IN ('fr', 'en') END
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY priority) = 1""",
    "group_text_size": "SELECT source, count(*) AS n_docs, sum(n_chars)::BIGINT AS total_size FROM documents GROUP BY source",
    "attach_stored_texts": """SELECT doc_id, quality, 'u' || doc_id AS url, text
        FROM labels JOIN documents USING (doc_id) WHERE text <> ''""",
    "strip_by_markers": _sql_body("text", SMALL_START, SMALL_END, "|"),
    "strip_wrapped": _sql_body(_WRAPPED, START_MARKERS, END_MARKERS, ""),
    "marker_lines": f"""SELECT * FROM (SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_no, unnest(ls) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
        WHERE {' OR '.join(f"starts_with(line, '{m}')" for m in SMALL_START + SMALL_END)}""",
    "marker_lines_many": """WITH lines AS (SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_no, unnest(ls) AS line
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
        markers AS (SELECT DISTINCT left(line, doc_id % 13 + 4) AS marker FROM lines WHERE length(left(line, doc_id % 13 + 4)) > 6),
        probes AS (SELECT doc_id, line_no, line, left(line, n) AS marker FROM lines, range(7, 17) AS r(n) WHERE length(line) >= n)
        SELECT doc_id, line_no, line, arg_max(marker, length(marker)) AS marker FROM probes JOIN markers USING (marker) GROUP BY ALL""",
    "strip_by_many_markers": """WITH split AS (SELECT doc_id, string_split(rtrim(text, chr(10)), chr(10)) AS ls FROM documents),
        lines AS (SELECT doc_id, generate_subscripts(ls, 1) AS no, unnest(ls) AS line FROM split),
        opened AS (SELECT doc_id, min(no) AS a FROM lines WHERE EXISTS (FROM benchmark b WHERE starts_with(line, left(b.text, 4))) GROUP BY doc_id),
        ends AS (SELECT DISTINCT left(text, turn % 3 + 5) AS marker FROM conversations),
        closed AS (SELECT doc_id, min(no) AS z FROM lines JOIN opened USING (doc_id)
          WHERE no > a AND (left(line, 5) IN (FROM ends) OR left(line, 6) IN (FROM ends) OR left(line, 7) IN (FROM ends)) GROUP BY doc_id)
        SELECT doc_id, array_to_string(ls[a + 1:coalesce(z - 1, len(ls))], '|') AS text
        FROM split JOIN opened USING (doc_id) LEFT JOIN closed USING (doc_id) WHERE text <> ''""",
    "decode_latin1": "SELECT doc_id, strlen(text)::INTEGER AS n_chars, md5(text) AS md5 FROM documents",
    "limit_groups": """SELECT source AS bookshelf_url, source[4:]::BIGINT AS shelf_pos, doc_id AS ebook_id FROM documents
        WHERE source IN (SELECT DISTINCT source FROM documents ORDER BY source[4:]::BIGINT LIMIT 3)""",
    "limit_per_group": """SELECT source AS bookshelf_url, source[4:]::BIGINT AS shelf_pos, doc_id AS ebook_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5""",
    "catalog_codec_roundtrip": f"""SELECT shelf AS shelf_pos, 'u' || shelf AS bookshelf_url, (doc_id % 10)::INTEGER AS ebook_pos,
        doc_id AS ebook_id, regexp_replace(regexp_replace(title, '%%%|!!!', '-', 'g'), '##+([^#])', '-\\1', 'g') AS ebook_title FROM ({_LISTED})""",
    "catalog_long_group": f"""SELECT 7::BIGINT AS shelf_pos, 'all' AS bookshelf_url, row_number() OVER (ORDER BY doc_id) - 1 AS ebook_pos,
        doc_id AS ebook_id, regexp_replace(regexp_replace(title, '%%%|!!!', '-', 'g'), '##+([^#])', '-\\1', 'g') AS ebook_title FROM ({_LISTED})""",
    "rows_in_memory": "SELECT n_name, count(*) AS n_customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name",
    "materialize_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "index_roundtrip": _SAVED + _INDEX_OUT,
    "index_as_maps": _SAVED + _INDEX_OUT,
    "dictionary_lookup": """SELECT event_id, user_id, c_name, c_mktsegment
        FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "build_index_skew": _LIBRARY + _INDEX_OUT,
    "build_index_pack": _LIBRARY + _INDEX_OUT,
    "build_index_partition": _LIBRARY + _INDEX_OUT,
    "build_index_limits": "WITH first AS (" + """SELECT doc_id FROM documents
          WHERE source IN (SELECT DISTINCT source FROM documents ORDER BY source[4:]::BIGINT LIMIT 3)
          QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5),""" + _sql_index(
        "source", "doc_id", "replace(text, chr(10), '')", _TITLE,
        "(SELECT * FROM documents WHERE text <> '' AND doc_id IN (SELECT doc_id FROM first))",
    ) + _INDEX_OUT,
    "build_index_files": _LIBRARY + _INDEX_OUT,
    "replace_index_group": _LIBRARY + _INDEX_OUT,
    "build_and_search": _sql_search(_LIBRARY, 2, "topk", "LIMIT 10"),
}

_QUERIES = (
    tokenize_documents, term_frequency, document_frequency_idf, tfidf_index, tfidf_by_lang,
    tfidf_whole_corpus, tfidf_group_as_document, dedupe_last_wins, signature_words,
    term_weight_lookup, search_top_books, search_total_all, search_every_group,
    search_whole_groups, search_term_table, rank_whole_groups, rank_first_5000,
    search_normalized_index, search_bucketed_index,
    similarity_scores, skew_profile_lang, skew_profile_users, pack_n_bins, pack_n_bins_users,
    pack_n_bins_per_nation, pack_max_capacity, pack_as_listed,
    pack_n_bins_level, pack_level_balance, pack_max_capacity_fill, bin_lookup, bin_stats,
    bin_count, repartition_packed, repartition_packed_split, repartition_builtin,
    extract_links, filter_links, typed_anchors, build_catalog, build_catalog_stored, build_catalog_all_stored, candidate_urls,
    first_available, group_text_size, attach_stored_texts, strip_by_markers, strip_wrapped,
    marker_lines, marker_lines_many, strip_by_many_markers, decode_latin1, limit_groups, limit_per_group, catalog_codec_roundtrip,
    catalog_long_group, rows_in_memory, materialize_roundtrip, index_roundtrip, index_as_maps, dictionary_lookup,
    build_index_skew, build_index_pack, build_index_partition, build_index_limits,
    build_index_files, replace_index_group, build_and_search,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: index the documents per source, then search it."""
    return build_and_search(spark, "/root/testdata/sf0.001")


def _pipeline_parts() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that subpackage is there."""
    try:
        from skewdex.llm import queries as llm
    except ImportError:  # the folder, or a library that only it needs, is not there
        return {}, {}
    found, sql = {query.__name__: query for query in llm.QUERIES}, dict(llm.ORACLE_SQL)
    try:
        import corpus_pipeline
    except ImportError:
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES} | _pipeline_parts()[0]


def oracle_sql() -> dict[str, str]:
    return dict(_SQL) | _pipeline_parts()[1]
