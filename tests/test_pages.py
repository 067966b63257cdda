import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skewdex.operators import catalog, pages
from skewdex.plans.build_index import build_index, index_library, search_index
from skewdex.sources import catalog_text, index_store, texts
from skewdex.sources.staging import is_saved, materialize, shared_root, stage
from skewdex.sources.tables import read_spread


def _page(spark, html, url="u"):
    return spark.createDataFrame([(url, html)], "url string, html string")


def test_links_in_order_with_repeats(spark):
    html = """<a href="/x">1</a><A class=b HREF='/y?a=1&amp;b=2'>2</A><a name="n">no</a><a href=/z>3
        <!-- <a href="/hidden">c</a> --><a data-href="/d">d</a><a title="a > b" href="/x">4</a><abbr href="/q"></abbr>"""
    assert rows(pages.links(_page(spark, html), ["url"]), "pos", "href") == [
        (0, "/x"), (1, "/y?a=1&b=2"), (3, "/z"), (5, "/x"),
    ]


def test_group_links_match_in_full(spark):
    hrefs = ["/wiki/A_(Bookshelf)", "/wiki/A_(Bookshelf)#x", "/wiki/(Bookshelf)", None,
             "/wiki/Category:Bookshelf", "/x/wiki/B_(Bookshelf)", "/wiki/A_(Bookshelf)"]
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    kept = pages.group_links(df).select(pages.absolute("href").alias("u"))
    assert rows(kept, "u") == [("https://www.gutenberg.org/wiki/A_(Bookshelf)",)] * 2


def test_typed_anchors(spark):
    html = """<a title="ebook:611" href="#">Prester <i>John</i> &amp; co</a><a title="ebook:5">short</a>
        <a title="ebook:x1">no</a><a title="author:77">no</a><a title='ebook:24583'>Two
        lines</a>"""
    got = rows(pages.typed_anchors(_page(spark, html), ["url"]), "ebook_id", "ebook_title")
    assert got == [(611, "Prester John & co"), (24583, "Two lines")]


def test_catalog_keeps_order_and_repeats(spark):
    first, second = pages.INDEX_URLS
    shelf = "https://www.gutenberg.org/wiki/{}_(Bookshelf)".format
    stored = spark.createDataFrame(
        [
            (second, '<a href="/wiki/A_(Bookshelf)">A</a>'),
            (first, '<a href="/wiki/B_(Bookshelf)">B</a><a href="/wiki/Main_Page">m</a><a href="/wiki/A_(Bookshelf)">A</a>'),
            (shelf("A"), '<a title="ebook:10">x</a><a title="ebook:11">y</a>'),
            (shelf("B"), '<a title="ebook:11">y</a>'),
            ("https://elsewhere", '<a title="ebook:99">z</a>'),
        ],
        "url string, html string",
    )
    listing = pages.build_catalog(stored).orderBy("shelf_pos", "ebook_pos")
    got = [(r.bookshelf_url, r.ebook_id) for r in listing.collect()]
    assert got == [(shelf("B"), 11), (shelf("A"), 10), (shelf("A"), 11), (shelf("A"), 10), (shelf("A"), 11)]


def test_candidate_urls(spark):
    df = spark.createDataFrame([(611,), (24583,), (5,)], "ebook_id int")
    got = rows(pages.candidate_urls(df, root="r"), "ebook_id", "priority", "url")
    assert got[3:6] == [(611, 0, "r/6/1/611/611.txt"), (611, 1, "r/6/1/611/611-8.txt"), (611, 2, "r/6/1/611/611-0.txt")]
    assert got[0][2] == "r//5/5.txt" and got[6][2] == "r/2/4/5/8/24583/24583.txt"


def test_first_known_length_wins(spark):
    listing = spark.createDataFrame([("s", 11), ("s", 11), ("s", 22), ("s", 33)], "shelf string, ebook_id int")
    root = pages.FILE_ROOT
    lengths = spark.createDataFrame(
        [(f"{root}/1/11/11-0.txt", 7), (f"{root}/1/11/11-8.txt", 9), (f"{root}/2/22/22.txt", None)],
        "url string, length long",
    )
    resolved = pages.resolve_urls(listing, lengths)
    assert rows(resolved, "ebook_id", "url", "length") == [(11, f"{root}/1/11/11-8.txt", 9)] * 2
    assert rows(pages.group_sizes(resolved, ["shelf"]), "shelf", "n_docs", "total_size") == [("s", 2, 18)]


SHELVES = [(0, "u0", [(1, "A"), (2, "B b"), (3, "C")]), (1, "u1", []), (2, "u2", [(4, "D")])]


def test_limits(spark):
    shelves = catalog.from_rows(spark, SHELVES)
    assert shelves.rdd.getNumPartitions() == 34
    cut = catalog.limit_per_group(catalog.limit_groups(shelves, 2), 2)
    assert [(r.url, [e.id for e in r.ebooks]) for r in cut.orderBy("pos").collect()] == [("u0", [1, 2]), ("u1", [])]
    listing = catalog.flatten(shelves)
    assert rows(listing, "bookshelf_url", "ebook_id") == [("u0", 1), ("u0", 2), ("u0", 3), ("u2", 4)]
    assert rows(catalog.limit_listed_groups(listing, 1, "shelf_pos"), "ebook_id") == [(1,), (2,), (3,)]
    assert rows(catalog.limit_listed_docs(listing, 2, ["shelf_pos"], "ebook_pos"), "ebook_id") == [(1,), (2,), (4,)]
    assert sorted(map(str, catalog.nest(listing).collect())) == sorted(
        map(str, shelves.where("size(ebooks) > 0").collect())
    )


def test_codec_drops_malformed_lines(spark):
    lines = ["u1%%%1!!!A##2!!!B b", "u5%%%7!!!A!!!zz##8!!!B%%%junk", "u2%%%", "u3%%%x!!!A", "u4%%%5!!!", "u6"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {r.url: [(e.id, e.title) for e in r.ebooks] for r in catalog_text.decode(df).collect()}
    assert got == {"u1": [(1, "A"), (2, "B b")], "u5": [(7, "A"), (8, "B")]}


def test_codec_round_trip(spark, tmp_path):
    shelves = catalog.from_rows(spark, [s for s in SHELVES if s[2]], slices=2)
    catalog_text.write_catalog(shelves, str(tmp_path / "c"))
    back = catalog_text.read_catalog(spark, str(tmp_path / "c"))
    assert sorted(map(str, back.collect())) == sorted(map(str, shelves.drop("pos").collect()))


def test_read_through_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "saved")
    assert not is_saved(spark, path)
    assert materialize(spark, path, build).count() == 3
    assert materialize(spark, path, build).count() == 3
    assert len(calls) == 1


def test_staged_tables_lie_in_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5 and root in staged.inputFiles()[0]


def test_stored_files_as_latin1(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("café\n".encode("latin-1"))
    got = texts.decode_text(texts.read_files(spark, str(tmp_path))).collect()
    assert [(r.text, r.length) for r in got] == [("café\n", 5)] and got[0].url.endswith("a.txt")


def test_wrong_url_or_no_content_gives_no_row(spark):
    listing = spark.createDataFrame(
        [(611, "Prester John", "good"), (1, "x", "wrong"), (2, "y", "empty"), (3, "z", "null")],
        "ebook_id int, ebook_title string, url string",
    )
    stored = spark.createDataFrame([("good", "text"), ("empty", ""), ("null", None)], "url string, text string")
    assert rows(texts.attach_texts(listing, stored), "ebook_id", "text") == [(611, "text")]


def test_dictionary(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "i int, k string")
    entries = spark.createDataFrame([("a", 10), ("c", 30)], "k string, v int")
    got = catalog.dictionary_lookup(df, entries, "k")
    assert {r.i: r.v for r in got.collect()} == {1: 10, 2: None, 3: None, 4: 10}


def test_small_tables_are_spread(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(100).coalesce(1).write.parquet(path)
    assert read_spread(spark, path).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def _library(spark):
    shelves = [(0, "s0", [(10, "Ten"), (11, "Eleven"), (10, "Ten")]), (1, "s1", [(12, "Twelve"), (13, "Gone"), (11, "Eleven")])]
    listing = catalog.flatten(catalog.from_rows(spark, shelves))
    root = pages.FILE_ROOT
    bodies = {10: "stew stew pot", 11: "stew garden", 12: "garden rose rose"}
    wrap = "head\nProduced by X\n{}\nEnd of Project Gutenberg\ntail".format
    stored = [(f"{root}/1/{i}/{i}.txt", wrap(b)) for i, b in bodies.items()]
    lengths = spark.createDataFrame([(u, len(t)) for u, t in stored], "url string, length long")
    return listing, lengths, spark.createDataFrame(stored, "url string, text string")


@pytest.mark.parametrize("mode", ["skew", "pack", "partition"])
def test_build_and_search(spark, tmp_path, mode):
    build_index(*_library(spark), directory=str(tmp_path), mode=mode, n=2)
    index = index_store.read_index(spark, str(tmp_path))
    assert rows(index, "bookshelf_url", "ebook_id", "term") == [
        ("s0", 10, "pot"), ("s0", 10, "stew"), ("s0", 11, "garden"), ("s0", 11, "stew"),
        ("s1", 11, "garden"), ("s1", 11, "stew"), ("s1", 12, "garden"), ("s1", 12, "rose"),
    ]
    # Two documents per group: ln(2/2) for a term of one, ln(2/3) for a term of both.
    assert search_index(spark, "stew", str(tmp_path)).count() == 0
    low = search_index(spark, "rose pot", str(tmp_path), min_score=-1.0)
    assert rows(low, "bookshelf", "title") == [("s0", "Ten"), ("s1", "Twelve")]


def test_all_stored_index_pages_are_listed(spark, tmp_path):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'s' AS source", "6L AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = entry.build_catalog_all_stored(spark, str(tmp_path))
    shelves = [((k // 50 << 32) + 2 * (k % 50), f"https://example.org/wiki/S{k}_(Bookshelf)") for k in range(120)]
    assert rows(found.select("shelf_pos", "bookshelf_url").distinct(), "shelf_pos", "bookshelf_url") == shelves
    assert found.count() == 1191  # a shelf without numbers of two digits has one row


def test_build_limits(spark):
    index = index_library(*_library(spark), max_groups=1, max_per_group=1)
    assert rows(index.select("bookshelf_url", "ebook_id").distinct(), "bookshelf_url", "ebook_id") == [("s0", 10)]


def test_index_layouts(spark, tmp_path):
    index = index_library(*_library(spark))
    index_store.write_index_table(index, "bucketed_index", 4)
    back = spark.table("bucketed_index")
    assert rows(back, *index.columns) == rows(index, *index.columns)
    per_doc = back.groupBy("bookshelf_url", "ebook_id").agg(F.sum("weight"))
    assert "Exchange" not in per_doc._jdf.queryExecution().executedPlan().toString()
    index_store.write_normalized(index, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/ebooks").count() == 4
    assert spark.read.parquet(f"{tmp_path}/terms").count() == 8
    maps = index_store.as_maps(index, ["bookshelf_url", "ebook_id"])
    assert maps.count() == 4 and maps.where("ebook_id = 12").first().terms["rose"] == 0.0
