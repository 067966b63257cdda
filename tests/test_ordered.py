"""Ranks and running sums of large groups, packing in parallel, and joins by many markers."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skewdex.functions.lines import starts_with_any
from skewdex.operators import markers, ordered, packing, search
from skewdex.plans.build_index import strip_boilerplate

ROWS = [(g, i, v) for i, (g, v) in enumerate(
    [("hot", 5)] * 400 + [("hot", None)] * 30 + [("hot", v % 7) for v in range(200)] + [("a", 1), (None, 3), (None, 3), (None, 1), ("b", None)]
)]


@pytest.fixture
def wide(spark):
    """Many parts of a sort, so that groups and ties go over their edges."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def table(spark):
    return spark.createDataFrame(ROWS, "g string, i int, v int").repartition(5)


def ranks(order):
    """(g, i) to (row number, rank), by plain sorting."""
    out, groups = {}, defaultdict(list)
    for g, i, v in ROWS:
        groups[g].append((order(v), i))
    for g, found in groups.items():
        found.sort()
        for at, (key, i) in enumerate(found, 1):
            out[g, i] = (at, 1 + sum(k < key for k, _ in found))
    return out


ASC, DESC = (lambda v: (v is not None, v or 0)), (lambda v: (v is None, -(v or 0)))


@pytest.mark.parametrize(("name", "order"), [("v", ASC), ("-v", DESC)])
@pytest.mark.parametrize("k", [None, 1500, 150])
def test_rank_over_edges(wide, name, order, k):
    want = ranks(order)
    got = ordered.rank_all(table(wide), ["g"], [name], "place", ties=True, k=k).collect()
    assert sorted((str(r.g), r.i, r.place) for r in got) == sorted((str(g), i, p[1]) for (g, i), p in want.items() if k is None or p[1] <= k)
    got = ordered.rank_all(table(wide), ["g"], [name, "i"], "place", k=k).collect()
    assert sorted((str(r.g), r.i, r.place) for r in got) == sorted((str(g), i, p[0]) for (g, i), p in want.items() if k is None or p[0] <= k)


def test_parts_of_the_sort_are_even(wide):
    """One group with most rows, most of them equal: no part holds it."""
    parts = ordered.sorted_parts(table(wide), ["g"], ["v"]).groupBy("_o_part").count()
    assert parts.count() > 15 and parts.agg(F.max("count")).first()[0] < len(ROWS) / 5


def test_no_window_over_a_group(wide, plan):
    """Windows are keyed by the part of the sort, or run over one row per part and group."""
    text = plan(ordered.rank_all(table(wide), ["g"], ["v"], "place", ties=True))
    windows = [line for line in text.splitlines() if "Window [" in line]
    # The number of the part is the first of the keys that rows are dealt by.
    assert windows and all("], [_o_part" in line for line in windows)
    assert "SinglePartition" not in text and "WindowGroupLimit" not in text


def test_which_way_is_taken(spark, plan):
    assert "WindowGroupLimit" in plan(ordered.first_rows(table(spark), ["g"], ["v", "i"], 3, "place"))
    assert "_o_part" in plan(ordered.first_rows(table(spark), ["g"], ["v", "i"], 5000, "place"))
    scores = spark.createDataFrame([("s", i, i % 5 / 10) for i in range(50)], "b string, e int, similarity_level double")
    got = {r.e: r.topN for r in search.rank_in_group(scores, "b", None).collect()}
    assert got == {i: 1 + sum(j % 5 > i % 5 for j in range(50)) for i in range(50)}


def test_rows_that_are_equal_throughout(wide):
    same = wide.createDataFrame([("g", 1)] * 300, "g string, v int").repartition(6)
    got = [r.place for r in ordered.rank_all(same, ["g"], ["v"], "place").collect()]
    assert sorted(got) == list(range(1, 301))
    assert {r.place for r in ordered.rank_all(same, ["g"], ["v"], "place", ties=True).collect()} == {1}


def test_running_sums(wide):
    rows = [(g, i, (i * 37) % 11) for g in ("x", "y") for i in range(150)]
    got = ordered.running(wide.createDataFrame(rows, "g string, i int, v long"), ["g"], ["-v", "i"], "v", "place", "before").collect()
    want = []
    for g in ("x", "y"):
        total = 0
        for at, (v, i) in enumerate(sorted((-v, i) for h, i, v in rows if h == g), 1):
            want.append((g, i, at, total))
            total -= v
    assert sorted((r.g, r.i, r.place, int(r.before)) for r in got) == sorted(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "g string, i int, v long")
    assert ordered.rank_all(none, ["g"], ["v"], "place", ties=True).collect() == []
    assert packing.pack_n_bins(none, ["i"], "v", 3, ["g"], exact=2).collect() == []
    assert packing.pack_max_capacity(none, ["i"], "v", 3, ["g"], exact=2).collect() == []


# -- packing in parallel -----------------------------------------------------------------


def sizes(kind, n, seed=1):
    rng = random.Random(seed)
    make = {
        "varied": lambda: int(rng.paretovariate(1.1) * 100), "equal": lambda: 50, "zero": lambda: 0,
        "large": lambda: rng.randint(501, 999), "mixed": lambda: rng.choice([0, 1, 3, 450, 600, 999, 1000, 1700]),
    }[kind]
    return [(f"g{i % 3}" if i % 7 else None, i, make()) for i in range(n)]


@pytest.mark.parametrize("kind", ["varied", "equal", "zero", "mixed"])
def test_level(spark, kind):
    rows, nbins, exact = sizes(kind, 600), 5, 12
    packed = packing.pack_n_bins(spark.createDataFrame(rows, "g string, i int, s long"), ["i"], "s", nbins, ["g"], exact).collect()
    assert sorted((str(r.g), r.i, r.s) for r in packed) == sorted((str(g), i, s) for g, i, s in rows)
    whole = packing.pack_n_bins(spark.createDataFrame(
        [r for g in {r[0] for r in rows} for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], -r[1]))[:exact]], "g string, i int, s long"
    ), ["i"], "s", nbins, ["g"])
    first = {(r.g, r.i): r.bin for r in whole.collect()}
    assert {(r.g, r.i): r.bin for r in packed if (r.g, r.i) in first} == first
    for g in {r[0] for r in rows}:
        mine = [r for r in packed if r.g == g]
        loads, rest = Counter(), Counter()
        for r in mine:
            loads[r.bin] += r.s
            rest[r.bin] += (r.g, r.i) not in first
        largest = max((r.s for r in mine if (r.g, r.i) not in first), default=0)
        filled = [loads[b] for b in rest if rest[b]]
        assert set(loads) <= set(range(nbins)) and max(filled) - min(filled) <= 2 * largest


@pytest.mark.parametrize("kind", ["varied", "equal", "zero", "large", "mixed"])
def test_fill(spark, kind):
    rows, capacity = sizes(kind, 400), 1000
    packed = packing.pack_max_capacity(spark.createDataFrame(rows, "g string, i int, s long"), ["i"], "s", capacity, ["g"], exact=8).collect()
    assert sorted((str(r.g), r.i, r.s) for r in packed) == sorted((str(g), i, s) for g, i, s in rows)
    for g in {r[0] for r in rows}:
        bins = defaultdict(list)
        for r in packed:
            if r.g == g:
                bins[r.bin].append(r.s)
        assert sorted(bins) == list(range(len(bins)))
        assert all(sum(b) <= capacity or sum(s > 0 for s in b) == 1 for b in bins.values())
        total, over = sum(s for h, _, s in rows if h == g and s <= capacity), sum(h == g and s > capacity for h, _, s in rows)
        assert len(bins) <= over + 2 * -(-total // capacity) + 8


def test_only_the_heaviest_are_folded(spark, monkeypatch):
    seen, fold = [], packing._pack

    def watched(items, *rest):
        seen.append(items.groupBy("g").count().agg(F.max("count")).first()[0] or 0)
        return fold(items, *rest)

    monkeypatch.setattr(packing, "_pack", watched)
    df = spark.createDataFrame(sizes("varied", 500), "g string, i int, s long")
    packing.pack_n_bins(df, ["i"], "s", 4, ["g"], exact=9)
    packing.pack_max_capacity(df, ["i"], "s", 3000, ["g"], exact=9)
    assert len(seen) == 3 and max(seen) <= 9


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, -1)], "i int, s long")
    with pytest.raises(ValueError, match="exact"):
        packing.pack_n_bins(df, ["i"], "s", 2, exact=0)
    with pytest.raises(ValueError, match="listed_by"):
        packing.pack_max_capacity(df, ["i"], "s", 2, listed_by="i", exact=3)
    with pytest.raises(Exception, match="negative"):
        packing.pack_n_bins(df, ["i"], "s", 2, exact=3).collect()


# -- markers -----------------------------------------------------------------------------


def test_longest_marker(spark):
    heads = ["ab", "abc", "abcdefgh", "x", "ab", None, "zz\\E.*"]
    lines = ["abcd", "abcdefghij", "ab", "a", "", None, "xyz", "Ab", "zz\\E.*!", "zzE"]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, line string")
    known = spark.createDataFrame([(h,) for h in heads], "marker string")
    got = {r.k: (r.line, r.marker) for r in markers.marked_lines(df, ["k"], "line", known).collect()}
    want = {k: (t, max((h for h in heads if h and t.startswith(h)), key=len)) for k, t in enumerate(lines) if t and any(h and t.startswith(h) for h in heads)}
    assert got == want
    assert markers.marked_lines(df, ["k"], "line", known.where("false")).collect() == []


def test_fifty_thousand_markers(spark, plan):
    rng = random.Random(2)
    heads = {"".join(rng.choice("abcde") for _ in range(rng.randint(7, 12))) for _ in range(50_000)}
    lines = [h + "!" for h in rng.sample(sorted(heads), 300)] + ["".join(rng.choice("abcde") for _ in range(14)) for _ in range(700)]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, line string")
    found = markers.marked_lines(df, ["k"], "line", spark.createDataFrame([(h,) for h in heads], "marker string"))
    text = plan(found, executed=True)
    assert "NestedLoop" not in text and "Cartesian" not in text
    want = {k: max((t[:n] for n in range(7, 13) if t[:n] in heads), key=len) for k, t in enumerate(lines) if any(t[:n] in heads for n in range(7, 13))}
    assert {r.k: r.marker for r in found.collect()} == want and len(want) > 300


def test_too_many_markers_move_no_lines(spark):
    """Markers that are not sent around meet prefixes; a line is moved by its key only. Keys may repeat or be null."""
    heads = spark.range(100_001).select(F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 6, "0"), F.when(F.col("id") % 2 == 0, "x").otherwise("")).alias("marker"))
    texts = ["m000003 odd", "m000004x even", "m000004 none", "m000004x even", "other", None, "m100000x", "m100001x"]
    keys = [(1, 1), (1, None), (1, 3), (1, None), (None, 5), (None, 6), (None, None), (2, 8)]
    df = spark.createDataFrame([(*k, t) for k, t in zip(keys, texts)], "a int, b int, line string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = markers.marked_lines(df, ["a", "b"], "line", heads)
        text = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
        got = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [block for block in text.split("\n\n") if "Exchange\n" in block and "hashpartitioning(_head" in block]
    assert moved and not any("line#" in block for block in moved)
    want = [(1, 1, "m000003 odd", "m000003"), (1, None, "m000004x even", "m000004x"), (None, None, "m100000x", "m100000x")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and found.columns == ["a", "b", "line", "marker"]


def test_bodies_are_those_of_the_expression(spark):
    start, end = ("** go", "begin", "**"), ("** stop", "end", "**")
    texts = ["a\n** go\nb\nc\nend of it\nd", "begin\nend", "none", None, "", "begin\nx\n\n", "x\n**\n**\ny", "begin", "go\nbegin\n\nb\n** stop", "end\nbegin\nb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string").withColumn("more", F.lit(1))
    tables = [spark.createDataFrame([(m,) for m in ms], "marker string") for ms in (start, end)]
    got = markers.bodies_between(docs, ["k"], "text", *tables, joiner="|")
    want = strip_boilerplate(docs, "text", start, end, "|")
    assert got.columns == docs.columns
    assert sorted((r.k, r.text) for r in got.collect()) == sorted((r.k, r.text) for r in want.collect())
    lines = spark.createDataFrame([(i, t) for i, t in enumerate("** go on|begins|beg|* **|**".split("|"))], "k int, line string")
    marked = {r.k for r in markers.marked_lines(lines, ["k"], "line", tables[0]).collect()}
    assert marked == {r.k for r in lines.where(starts_with_any("line", start)).collect()}


# -- a table of terms --------------------------------------------------------------------


def test_a_table_of_terms_filters_the_scan(spark, plan, tmp_path):
    """Twenty thousand terms: a semi-join whose terms reach the index as a Bloom filter before it is shuffled."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("bookshelf_url"), (F.col("id") % 500).cast("int").alias("ebook_id"),
        F.concat(F.lit("t"), F.col("id") * 7 % 50_000).alias("term"), (F.col("id") % 9 / 100.0).alias("weight"),
    )
    rows.write.parquet(str(tmp_path / "index"))
    spark.range(20_000).select(F.concat(F.lit("t"), F.col("id") * 2).alias("term")).write.parquet(str(tmp_path / "terms"))
    index, terms = spark.read.parquet(str(tmp_path / "index")), spark.read.parquet(str(tmp_path / "terms"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        text = plan(search.match_terms(index, terms))
        got = search.similarity(index, terms, ["ebook_id"]).count()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "LeftSemi" in text and "might_contain" in text
    asked = [f"t{2 * i}" for i in range(20_000)]
    assert got == search.similarity(index.where(F.col("term").isin(asked)), spark.createDataFrame([(t,) for t in asked], "term string"), ["ebook_id"]).count() > 0
