"""Cases in which something could get lost without a word."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skewdex.operators import catalog, packing, pages, search, tfidf
from skewdex.plans.build_index import body_counts, build_index, index_library
from skewdex.sources import catalog_text, index_store, staging, texts


def first_fit(sizes, nbins):
    """Bins of sizes in descending order, item by item."""
    loads, out = [], []
    for size in sizes:
        fit = next((b for b, load in enumerate(loads) if load + size <= sizes[0]), None)
        if fit is None and len(loads) < nbins:
            loads.append(0)
            fit = len(loads) - 1
        fit = loads.index(min(loads)) if fit is None else fit
        loads[fit] += size
        out.append(fit)
    return out


def test_groups_that_differ_by_microseconds_stay_apart(spark):
    start = datetime(2024, 1, 1)
    groups = {start + timedelta(microseconds=300 * g): [9 - g % 3, 5, 5, 2, 2][: 3 + g % 3] for g in range(6)}
    rows = [(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sorted(sizes, reverse=True))]
    got = packing.pack_n_bins(spark.createDataFrame(rows, "g timestamp, i int, s long"), ["i"], "s", 2, ["g"]).collect()
    assert sorted((r.g, r.i) for r in got) == sorted((g, i) for g, i, _ in rows)
    for g, sizes in groups.items():
        mine = sorted(((r.s, r.i, r.bin) for r in got if r.g == g), reverse=True)
        assert [b for *_, b in mine] == first_fit([s for s, *_ in mine], 2)


def test_a_null_group_is_a_group(spark):
    rows = [(None, 1, 5), (None, 2, 5), ("a", 3, 5), ("a", 4, 5)]
    got = packing.pack_n_bins(spark.createDataFrame(rows, "g string, i int, s int"), ["i"], "s", 2, ["g"]).collect()
    assert sorted((str(r.g), r.i, r.bin) for r in got) == [("None", 1, 1), ("None", 2, 0), ("a", 3, 1), ("a", 4, 0)]


def test_sizes_are_whole_numbers(spark):
    with pytest.raises(ValueError, match="whole"):
        packing.pack_n_bins(spark.createDataFrame([(1, 0.9)], "i int, s double"), ["i"], "s", 2)
    with pytest.raises(Exception, match="must not be null"):
        packing.pack_n_bins(spark.createDataFrame([(1, None)], "i int, s long"), ["i"], "s", 2).collect()


def test_the_threshold_is_on_the_exact_sum(spark):
    rows = [("g", 1, "t", "cook", 0.0010000003), ("g", 2, "t", "cook", 0.001), ("g", 3, "t", "cook", 0.0004), ("g", 3, "t", "dinner", 0.0006000000000003)]
    index = spark.createDataFrame(rows, index_store.INDEX_SCHEMA)
    got = search.similarity(index, "cook dinner", ["ebook_id"]).collect()
    assert sorted(r.ebook_id for r in got) == [1, 3]


def test_widths_and_limits_can_be_left_out(spark):
    rows = [("g" * 200, i, "t" * 100, "cook", 1.0 + i) for i in range(5)]
    index = spark.createDataFrame(rows, index_store.INDEX_SCHEMA)
    cut = search.search(index, "cook", k=None).collect()
    assert [(len(r.bookshelf), len(r.title), r.place) for r in cut] == [(132, 60, i) for i in range(1, 6)]
    whole = search.search(index, "cook", k=None, limit=None, title_width=None, group_width=None).collect()
    assert [(len(r.bookshelf), len(r.title), r.similarity_level) for r in whole] == [(200, 100, 5.0 - i) for i in range(5)]


@pytest.mark.parametrize("title", [None, "", "a##b", "a#####b", "##b", "a!!!b", "!!!", "a%%%b", "a\nb", "a\rb"])
def test_what_the_catalog_can_not_hold_raises(spark, title):
    shelves = spark.createDataFrame([(1, "u", [(1, "A"), (2, title)])], catalog.SHELF_SCHEMA)
    with pytest.raises(Exception, match="can't hold this title"):
        catalog_text.encode(shelves).collect()


@pytest.mark.parametrize("url", [None, "a%%%b", "%%%", "a\nb"])
def test_urls_the_catalog_can_not_hold_raise(spark, url):
    with pytest.raises(Exception, match="can't hold this url"):
        catalog_text.encode(spark.createDataFrame([(1, url, [(1, "A")])], catalog.SHELF_SCHEMA)).collect()


EDGES = ["a#", "a##", "a###", "#", "##", "###", "#a", "a%", "a%%", "%a", "%%", "%", "a!", "a!!", "!a", "!!a", "!", "!!", "1", "-1", "7!!", "a#1!!", "# #", " a "]


@pytest.mark.parametrize("last", ["z", "z##", "!"])
def test_the_catalog_reads_back_what_it_holds(spark, tmp_path, last):
    """Signs of separators at the ends of titles and urls, empty groups, and negative numbers."""
    groups = [(1, "u", [(at, t) for at, t in enumerate(EDGES)] + [(-5, last)]), (2, "u%", [(1, "a")]), (3, "u%%", [(2, "#")])]
    groups += [(4, "%", []), (5, "empty", []), (6, "u%1", []), (7, "", [(3, "x")]), (8, "!!!##", [(1, "##")]), (9, "none", None)]
    groups += [(100 + at, f"{a}{b}", [(at, a), (at + 1, b)]) for at, a in enumerate(EDGES) for b in ("#", "!", "t")]
    catalog_text.write_catalog(spark.createDataFrame(groups, catalog.SHELF_SCHEMA), str(tmp_path / "c"))
    back = catalog_text.read_catalog(spark, str(tmp_path / "c")).collect()
    want = sorted((url, [tuple(d) for d in docs or []]) for _, url, docs in groups)
    assert sorted((r.url, [tuple(e) for e in r.ebooks]) for r in back) == want


def test_a_failed_save_does_not_stand_in_the_way(spark, tmp_path):
    path = str(tmp_path / "saved")
    broken = spark.range(5).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("broken off")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken off"):
        staging.materialize(spark, path, lambda: broken)
    assert not staging.is_saved(spark, path) and os.listdir(tmp_path) == []
    assert staging.materialize(spark, path, lambda: spark.range(5)).count() == 5
    assert os.listdir(tmp_path) == ["saved"]


def test_remains_of_a_lost_save_give_way(spark, tmp_path):
    """A folder without _SUCCESS, as a driver that was lost while it wrote leaves it."""
    os.makedirs(tmp_path / "saved" / "_temporary" / "0")
    spark.range(9).write.parquet(str(tmp_path / "saved" / "part"))
    assert staging.materialize(spark, str(tmp_path / "saved"), lambda: spark.range(4)).count() == 4


def test_one_of_concurrent_builders_wins(spark, tmp_path):
    from threading import Barrier, Thread

    path, ready, got = str(tmp_path / "saved"), Barrier(3), []

    def build(n):
        def builder():
            ready.wait(60)  # all have found that there is no table
            return spark.range(n)

        got.append(sorted(r.id for r in staging.materialize(spark, path, builder).collect()))

    threads = [Thread(target=build, args=(n,)) for n in (3, 4, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert len(got) == 3 and got[0] == got[1] == got[2] == list(range(len(got[0])))
    assert os.listdir(tmp_path) == ["saved"]


def test_a_long_group_is_written_in_lines(spark, tmp_path):
    rows = [(7, "u|x", at, 100 + at, f"T{at}") for at in range(25)] + [(8, "v", 3, 5, "only"), (9, "w", None, None, None)]
    listing = spark.createDataFrame(rows, "shelf_pos long, bookshelf_url string, ebook_pos int, ebook_id int, ebook_title string")
    catalog_text.write_listing(listing, str(tmp_path / "listing"), per_line=10)
    assert spark.read.text(str(tmp_path / "listing")).count() == 4
    got = catalog_text.read_listing(spark, str(tmp_path / "listing")).orderBy("shelf_pos", "part", "place").collect()
    assert [(r.shelf_pos, r.bookshelf_url, r.ebook_id, r.ebook_title) for r in got] == [(s, u, i, t) for s, u, _, i, t in rows if i]


PAGES = [
    ("https://h/i", '<a href="/wiki/A_(Bookshelf)">A</a><a href="/wiki/B_(Bookshelf)">B</a><a href="/wiki/C_(Bookshelf)">C</a>'),
    ("https://h/wiki/A_(Bookshelf)", "no anchors"),
    ("https://h/wiki/B_(Bookshelf)", '<a name="top"><a title="ebook:12">One</a> <a title="ebook:13">Two<a title="ebook:14">Three'),
    ("https://h/wiki/C_(Bookshelf)", """<a data-x='href="/wrong" title="ebook:98"' title='ebook:15'>&eacute;&#233;&#xE9;&apos;&#128512; &amp;lt; &nosuch;</a>"""),
]


def test_groups_without_documents_count(spark):
    listing = pages.build_catalog(spark.createDataFrame(PAGES, "url string, html string"), ("https://h/i",), base="https://h")
    found = sorted((r.shelf_pos % 100, r.ebook_id, r.ebook_title) for r in listing.where("ebook_id is not null").collect())
    assert [(i, t) for _, i, t in found] == [(12, "One"), (13, "Two"), (14, "Three"), (15, "ééé'😀 &lt; &nosuch;")]
    first = catalog.limit_listed_groups(listing, 2, "shelf_pos")
    assert sorted({r.bookshelf_url[-13:-12] for r in first.collect()}) == ["A", "B"]
    nested = {r.url[-13:-12]: [e.id for e in r.ebooks] for r in catalog.nest(listing).collect()}
    assert nested == {"A": [], "B": [12, 13, 14], "C": [15]}


def test_bare_and_odd_links(spark):
    html = """<a href>a</a><a data-x='href="/wrong"' href='/right'>b</a><a HREF = /q?a=1>c</a><abbr href="no">"""
    found = pages.links(spark.createDataFrame([(1, html)], "id int, html string"), ["id"]).collect()
    assert [(r.pos, r.href) for r in found] == [(0, ""), (1, "/right"), (2, "/q?a=1")]


def test_an_index_from_stored_files(spark, tmp_path, plan):
    body = "Title\n*** START OF THIS PROJECT GUTENBERG EBOOK ***\nCook a dinner for {}\nEnd of Project Gutenberg's book\n"
    for at in range(4):
        (tmp_path / "files").mkdir(exist_ok=True)
        (tmp_path / "files" / f"{at}.txt").write_bytes((body.format("kings" * (at + 1)) + "tail é").encode("latin-1"))
    files = texts.decode_text(texts.read_files(spark, str(tmp_path / "files")))
    listing = files.select(
        F.lit(1).cast("long").alias("shelf_pos"), F.lit("s").alias("bookshelf_url"), F.monotonically_increasing_id().alias("ebook_pos"),
        F.regexp_extract("url", r"(\d)\.txt", 1).cast("int").alias("ebook_id"), F.lit("t").alias("ebook_title"), "url", "length",
    )
    build_index(listing, None, files.select("url", "text"), directory=str(tmp_path / "index"), mode="pack", n=2)
    got = index_store.read_index(spark, str(tmp_path / "index")).collect()
    assert {(r.ebook_id, r.term) for r in got} == {(i, t) for i in range(4) for t in ("cook", "dinner", "kings" * (i + 1))}
    assert "Exchange" not in plan(body_counts(files))


def test_all_terms_can_be_kept(spark):
    docs = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(700)))], "d int, text string")
    assert tfidf.tfidf(docs, [], ["d"], top=None).count() == 700
    assert tfidf.tfidf(docs, [], ["d"]).count() == 500


def test_lookup_pushes_its_terms(spark, tmp_path, plan):
    index = spark.createDataFrame([("s", i, "t", f"w{i % 7}", 1.0) for i in range(100)], index_store.INDEX_SCHEMA)
    index_store.write_index(index, str(tmp_path))
    asked = spark.createDataFrame([("s", 3, "w3"), ("s", 3, "w4")], "bookshelf_url string, ebook_id int, term string")
    found = tfidf.term_weights(asked, index_store.read_index(spark, str(tmp_path)), ["bookshelf_url", "ebook_id", "term"])
    assert "In(term, [w3,w4])" in plan(found) or "In(term, [w4,w3])" in plan(found)
    assert sorted((r.term, r.weight) for r in found.collect()) == [("w3", 1.0), ("w4", 0.0)]


def test_tables_of_a_job_go_at_its_end(spark, tmp_path):
    kept = staging.stage(spark.range(3), "kept")
    with staging.temporary_tables(spark):
        inner = staging.stage(spark.range(4), "inner")
        path = inner.inputFiles()[0]
        assert inner.count() == 4
    assert not os.path.exists(path.removeprefix("file://")) and kept.count() == 3


def test_unknown_modes_are_refused(spark):
    listing = spark.createDataFrame([], "shelf_pos long, bookshelf_url string, ebook_pos int, ebook_id int, ebook_title string, url string, length long")
    with pytest.raises(ValueError, match="mode"):
        index_library(listing, None, spark.createDataFrame([], "url string, text string"), mode="other")
