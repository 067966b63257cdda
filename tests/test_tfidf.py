import math
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skewdex.operators import joins, tfidf
from skewdex.sources.staging import stage

DOCS = [
    ("doc 1", "word1 word1 word2 word3 word4"),
    ("doc 2", "word1 word2 word3 word4 word5"),
    ("doc 3", "word1 word1 word1 word1 word2"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc string, text string")


def test_term_frequency(docs):
    tf = {(r.doc, r.term): r.tf for r in tfidf.term_frequency(docs, ["doc"]).collect()}
    assert tf["doc 1", "word1"] == 0.4
    assert tf["doc 2", "word1"] == 0.2
    assert tf["doc 3", "word1"] == 0.8
    for doc, _ in DOCS:
        assert math.isclose(sum(v for (d, _), v in tf.items() if d == doc), 1.0)


def test_rarest_term_has_the_highest_idf(docs):
    best = tfidf.idf(docs, [], ["doc"]).orderBy(F.desc("idf")).first()
    assert best.term == "word5" and best.df == 1 and best.n_docs == 3


def test_weights(docs):
    got = {(r.doc, r.term): round(r.weight, 6) for r in tfidf.tfidf(docs, [], ["doc"]).collect()}
    assert got == {
        ("doc 1", "word3"): 0, ("doc 1", "word4"): 0,
        ("doc 1", "word2"): -0.057536, ("doc 1", "word1"): -0.115073,
        ("doc 2", "word5"): 0.081093, ("doc 2", "word3"): 0, ("doc 2", "word4"): 0,
        ("doc 2", "word1"): -0.057536, ("doc 2", "word2"): -0.057536,
        ("doc 3", "word2"): -0.057536, ("doc 3", "word1"): -0.230146,
    }


def test_signature_word(docs):
    index = tfidf.tfidf(docs, [], ["doc"])
    assert tfidf.signature_words_of(index, {"doc": "doc 2"}).first().term == "word5"
    first = tfidf.signature_words(index, ["doc"], 1)
    assert dict(rows(first, "doc", "term"))["doc 2"] == "word5"
    assert first.count() == 3


def test_documents_without_terms_count(spark):
    df = spark.createDataFrame(
        [(1, 1, "aa"), (1, 2, "of"), (1, 3, ""), (2, 1, "aa"), (2, 2, None)], "s int, d int, text string"
    )
    got = dict(rows(tfidf.idf(df, ["s"], ["d"]), "s", "idf"))
    assert got == {1: math.log(3 / 2), 2: math.log(1 / 2)}


def test_top_terms_break_ties_by_term(spark):
    words = [f"w{i:04d}" for i in range(700)]
    df = spark.createDataFrame([(1, " ".join(reversed(words)))], "d int, text string")
    kept = [t for (t,) in rows(tfidf.tfidf(df, [], ["d"]), "term")]
    assert kept == words[:500]


def _by_hand(corpus, top=500):
    """corpus: scope -> doc -> words."""
    out = {}
    for scope, docs in corpus.items():
        df = Counter(t for words in docs.values() for t in set(words))
        for doc, words in docs.items():
            weights = {
                t: n / len(words) * math.log(len(docs) / (1.0 + df[t])) for t, n in Counter(words).items()
            }
            for t in sorted(weights, key=lambda t: (-weights[t], t))[:top]:
                out[scope, doc, t] = round(weights[t], 9)
    return out


@pytest.mark.parametrize("broadcast_rows", [10, 100_000])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_hot_scope_and_terms_match_by_hand(spark, broadcast_rows, threshold):
    """Split and whole lookups, with and without broadcast of the cold side."""
    import random

    pick = random.Random(3)
    corpus = defaultdict(dict)
    for doc in range(300):
        scope = "hot" if doc % 2 else f"s{doc % 7}"
        corpus[scope][doc] = ["everywhere"] + [f"w{int(pick.expovariate(0.05))}x" for _ in range(pick.randint(0, 40))]
    df = spark.createDataFrame(
        [(s, d, " ".join(w)) for s, docs in corpus.items() for d, w in docs.items()],
        "s string, d int, text string",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = tfidf.tfidf(df, ["s"], ["d"], top=20, broadcast_rows=broadcast_rows)
        got = {(r.s, r.d, r.term): round(r.weight, 9) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == _by_hand(corpus, 20)


def test_ranking_adds_no_shuffle_of_terms(spark, plan):
    df = spark.createDataFrame([(1, i, f"aa bb w{i}x") for i in range(50)], "s int, d int, text string")
    text = plan(tfidf.tfidf(df, ["s"], ["d"], broadcast_rows=2))
    text = text[text.index("Initial Plan") :] if "Initial Plan" in text else text
    # From the ranking down: the arrays per document are spread, once per branch.
    ranked = text[text.index("Window") :]
    above = ranked[: ranked.index("Generate")]
    assert "Exchange hashpartitioning" not in above
    assert "WindowGroupLimit" in text


def test_group_as_one_document(spark):
    df = spark.createDataFrame([("g", "aa bb"), ("g", "aa"), ("h", "cc")], "g string, text string")
    got = {(r.g, r.term): r.weight for r in tfidf.group_tfidf(df, ["g"]).collect()}
    assert got == pytest.approx(
        {("g", "aa"): 2 / 3 * math.log(0.5), ("g", "bb"): 1 / 3 * math.log(0.5), ("h", "cc"): math.log(0.5)}
    )


def test_last_listing_wins(spark, plan):
    df = spark.createDataFrame([(1, 1, "a"), (1, 5, "b"), (2, 3, "c")], "k int, pos int, text string")
    kept = tfidf.last_listed(df, ["k"], "pos")
    assert rows(kept, "k", "pos", "text") == [(1, 5, "b"), (2, 3, "c")]
    assert plan(kept).count("WindowGroupLimit") >= 2  # cut before the shuffle as well


def test_term_weight_default(spark):
    index = spark.createDataFrame([(1, "aa", 0.5)], "d int, term string, weight double")
    asked = spark.createDataFrame([(1, "aa"), (1, "bb"), (2, "aa")], "d int, term string")
    got = tfidf.term_weights(asked, index, ["d", "term"])
    assert rows(got, "d", "term", "weight") == [(1, "aa", 0.5), (1, "bb", 0.0), (2, "aa", 0.0)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [1, 3, 1000])
@pytest.mark.parametrize("value", ["v", "v" * 2000])
def test_lookup_join_equals_a_plain_join(spark, how, limit, value):
    keys = [None] * 5 + [0] * 60 + [1] * 30 + list(range(2, 12)) + [99]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    right = spark.createDataFrame(
        [(k, f"{value if k % 2 else ''}{k}", max(1, keys.count(k))) for k in range(12)], "k int, v string, n long"
    )
    got = joins.lookup_join(left, stage(right, "right"), ["k"], "n", how, rows=limit)
    want = left.join(right, ["k"], how)
    key = lambda r: (r.i,)
    assert sorted(got.select("k", "i", "v", "n").collect(), key=key) == sorted(
        want.select("k", "i", "v", "n").collect(), key=key
    )


def test_only_narrow_rows_are_broadcast(spark, plan):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = stage(spark.createDataFrame([(1, "x" * 5000, 9), (2, "y", 9)], "k int, v string, n long"), "wide")
    text = plan(joins.lookup_join(left, right, ["k"], "n"))
    assert "Union" in text and "LeftAnti" in text
    assert "Union" not in plan(joins.lookup_join(left, right.where("k = 2"), ["k"], "n"))


def test_null_scope_is_a_group(spark):
    df = spark.createDataFrame(
        [(None, 1, "aa bb"), (None, 2, "aa"), (None, 3, "aa"), ("s", 4, "aa")], "s string, d int, text string"
    )
    want = [(1, "aa", 0.5 * math.log(3 / 4)), (1, "bb", 0.5 * math.log(3 / 2)), (2, "aa", math.log(3 / 4)),
            (3, "aa", math.log(3 / 4)), (4, "aa", math.log(1 / 2))]
    for limit in (1, 1000):
        got = tfidf.tfidf(df, ["s"], ["d"], broadcast_rows=limit)
        assert rows(got, "d", "term", "weight") == want
    assert tfidf.idf(df, ["s"], ["d"]).count() == 3
    assert tfidf.group_tfidf(df, ["s"]).count() == 3
