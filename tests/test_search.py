import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from skewdex.operators import search
from skewdex.operators.ranking import keep_first
from skewdex.sources import index_store

ROWS = [
    ("shelf/a", 1, "One", "cook", 0.5), ("shelf/a", 1, "One", "dinner", 0.25),
    ("shelf/a", 2, "Two", "cook", 0.75), ("shelf/a", 3, "Three", "dinner", 0.1),
    ("shelf/a", 4, "Four", "cook", 0.0005),
    ("shelf/b", 5, "Five" * 30, "dinner", 0.9), ("shelf/b", 6, "Six", "other", 5.0),
    ("shelf/c", 7, "Seven", "cook", -0.3),
]
SCHEMA = "bookshelf_url string, ebook_id int, ebook_title string, term string, weight double"


def _index(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _found(df):
    return [(r.bookshelf, r.title[:5], r.similarity_level) for r in df.collect()]


def test_best_documents_of_the_best_groups(spark):
    got = _found(search.search(_index(spark), "cook cook the dinner", group_prefix="shelf/"))
    assert got == [("a", "One", 0.75), ("a", "Two", 0.75), ("b", "FiveF", 0.9)]
    title = search.search(_index(spark), "dinner").where("bookshelf = 'shelf/b'").first().title
    assert len(title) == 60


def test_ties_share_a_rank_and_are_kept(spark):
    assert [r[1] for r in _found(search.search(_index(spark), "cook dinner", k=1))] == ["One", "Two", "FiveF"]
    scores = search.similarity(_index(spark), "cook dinner", ["bookshelf_url", "ebook_id"])
    ranked = search.rank_in_group(scores, "bookshelf_url", 1)
    assert rows(ranked, "ebook_id", "topN") == [(1, 1), (2, 1), (5, 1)]
    assert rows(search.rank_in_group(scores, "bookshelf_url", 3), "ebook_id", "topN") == [(1, 1), (2, 1), (3, 3), (5, 1)]


def test_group_level_over_all_documents(spark):
    index = spark.createDataFrame(
        [("p", 1, "", "x1", 0.5), ("p", 2, "", "x1", 0.4), ("p", 3, "", "x1", 0.3), ("q", 4, "", "x1", 1.0)], SCHEMA
    )
    assert [r.bookshelf for r in search.search(index, "x1", k=1).collect()] == ["q", "p"]
    assert [r.bookshelf for r in search.search(index, "x1", k=1, total="all").collect()] == ["p", "q"]
    unnamed = index.withColumn("bookshelf_url", F.when(F.col("bookshelf_url") == "q", "q"))
    for total in ("topk", "all"):
        assert search.search(unnamed, "x1", k=3, total=total).count() == 4


def test_low_scores_limit_and_empty_query(spark):
    assert search.search(_index(spark), "of the").count() == 0
    assert search.search(_index(spark), "cook dinner", limit=1).count() == 1
    scores = search.similarity(_index(spark), "cook", ["ebook_id"])
    assert rows(scores, "ebook_id") == [(1,), (2,)]  # 0.0005 and the negative one are out


def test_plan_pushes_terms_and_cuts_ranks_early(spark, plan, tmp_path):
    index_store.write_index(_index(spark), str(tmp_path))
    found = search.search(index_store.read_index(spark, str(tmp_path)), "cook dinner")
    text = plan(found)
    assert "In(term, [cook,dinner])" in text
    assert "WindowGroupLimit" in text and "TakeOrderedAndProject" in text
    assert "Window [sum" not in text  # a group's total gathers no group


@pytest.mark.parametrize("number", [F.row_number, F.rank])
def test_first_rows_in_parts(spark, number):
    df = spark.range(0, 4000, 1, 8).select((F.col("id") % 3 == 0).alias("g"), (F.col("id") % 1900).alias("v"), "id")
    order = ["v"] if number is F.rank else ["v", "id"]
    got = keep_first(df, ["g"], order, 1200, "place", number)  # above Spark's own limit
    whole = df.withColumn("place", number().over(Window.partitionBy("g").orderBy(*order))).where("place <= 1200")
    assert rows(got, "g", "id", "place") == rows(whole, "g", "id", "place")


@pytest.mark.parametrize("sent", [100_000, 20, 2])
def test_many_terms_shuffle_rare_ones_only(spark, plan, sent):
    """However many terms are sent around, the rows are those of the semi-join; if all are, none is shuffled."""
    index = spark.range(4000).select(
        (F.col("id") % 50).cast("int").alias("ebook_id"), F.concat(F.lit("t"), F.when(F.col("id") % 4 > 0, F.col("id") % 6).otherwise(F.col("id"))).alias("term"),
        F.when(F.col("id") % 7 > 0, 0.01).alias("weight"),
    ).unionByName(spark.createDataFrame([(1, None, 0.5), (1, "", 0.5)], "ebook_id int, term string, weight double"))
    asked = spark.createDataFrame([(t,) for t in [None, "", "t1", "t1", *[f"t{i}" for i in range(0, 5000, 2)]]], "term string")
    want = search.match_terms(index, asked)
    got = search.match_many_terms(index, asked, sent)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and got.count() > 1500
    if sent > 2500:
        assert "Exchange hashpartitioning(term" not in plan(got).split("BroadcastExchange")[0]
