import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skewdex.functions.firstfit import Loads
from skewdex.operators import packing
from skewdex.sources.staging import stage

LETTERS = dict(a=1, b=4, c=9, d=4, e=1, f=5, g=8, h=3, i=2, j=5, k=7, l=3, m=2, n=6)
LETTER_BINS = dict(a=3, b=0, c=0, d=1, e=2, f=2, g=1, h=1, i=0, j=3, k=2, l=3, m=2, n=3)


def one_by_one(sizes, nbins, capacity):
    """The packing rule, item by item."""
    bins, out = [], []
    for size in sizes:
        at = next((b for b, load in enumerate(bins) if load + size <= capacity), None)
        if at is None:
            if nbins is None or len(bins) < nbins:
                bins.append(0)
                at = len(bins) - 1
            else:
                at = min(range(len(bins)), key=lambda b: (bins[b], b))
        bins[at] += size
        out.append(at)
    return out


def largest_first(items):
    return sorted(items, key=lambda kv: (kv[1], kv[0]), reverse=True)


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(list(LETTERS.items()), "item string, size long")


def test_letters_into_four_even_bins(letters):
    packed = packing.pack_n_bins(letters, ["item"], "size", 4)
    assert dict(rows(packed, "item", "bin")) == LETTER_BINS
    stats = packing.bin_stats(packed, "size")
    assert [r[1:] for r in rows(stats, "bin", "label", "bin_size")] == [(f"Bin#{b}", 15) for b in range(4)]
    assert packing.n_bins(packed).first().n_bins == 4


def test_groups_of_people_on_minibuses(spark):
    groups = spark.createDataFrame([(1, 3), (2, 1), (3, 6), (4, 4), (5, 5), (6, 2)], "item int, size int")
    packed = packing.pack_max_capacity(groups, ["item"], "size", 7)
    assert rows(packing.bin_stats(packed, "size"), "bin", "bin_size") == [(0, 7), (1, 7), (2, 7)]
    # As they come, they need four buses.
    listed = packing.pack_max_capacity(groups, ["item"], "size", 7, listed_by="item")
    assert [b for _, b in rows(listed, "item", "bin")] == one_by_one([3, 1, 6, 4, 5, 2], None, 7)
    assert packing.n_bins(listed).first().n_bins == 4


@pytest.mark.parametrize("seed", range(300))
def test_runs_fold_like_single_items(seed):
    pick = random.Random(seed)
    top = pick.choice([1, 2, 5, 30, 1000])
    sizes = sorted((pick.choice([0, 1, top, pick.randint(0, top)]) for _ in range(pick.randint(1, 80))), reverse=True)
    nbins = pick.choice([None, 1, 2, 3, 8])
    capacity = sizes[0] if nbins else pick.randint(1, 2 * top)
    loads, got = Loads(capacity, nbins), []
    for size in sorted(set(sizes), reverse=True):
        for n, bins in loads.place(size, sizes.count(size)):
            got += [bins[i % len(bins)] for i in range(n)]
    assert got == one_by_one(sizes, nbins, capacity)


@pytest.mark.parametrize("nbins,capacity", [(5, None), (None, 300)])
def test_many_groups_at_once(spark, nbins, capacity):
    pick = random.Random(11)
    data = defaultdict(dict)
    for g in range(40):
        for i in range(pick.randint(1, 60)):
            data[g][i] = pick.choice([1, 7, pick.randint(0, 400)])
    # One group holds most items, nearly all of one size.
    data[99] = {i: 3 if i % 50 else 50 for i in range(4000)}
    items = spark.createDataFrame([(g, i, s) for g, d in data.items() for i, s in d.items()], "g int, item int, size long")
    if nbins:
        packed = packing.pack_n_bins(items, ["item"], "size", nbins, ["g"])
    else:
        packed = packing.pack_max_capacity(items, ["item"], "size", capacity, ["g"])
    want = []
    for g, d in data.items():
        order = largest_first(d.items())
        bins = one_by_one([s for _, s in order], nbins, capacity or order[0][1])
        want += [(g, i, s, b) for (i, s), b in zip(order, bins)]
    assert rows(packed, "g", "item", "size", "bin") == sorted(want)


def test_null_group_is_a_group_and_empty_input_gives_none(spark):
    items = spark.createDataFrame([(None, 1, 5), (None, 2, 5), (3, 1, 5)], "g int, item int, size long")
    packed = packing.pack_n_bins(items, ["item"], "size", 2, ["g"])
    assert sorted(r.bin for r in packed.collect()) == [0, 0, 1]
    assert packing.pack_n_bins(items.limit(0), ["item"], "size", 2).count() == 0


def test_lookup(spark, letters):
    packed = stage(packing.pack_n_bins(letters, ["item"], "size", 4), "bins")
    asked = spark.createDataFrame([("a",), ("c",), ("m",), ("?",), (None,)], "item string")
    found = dict(r for r in packing.bin_lookup(asked, packed, ["item"], "size").collect())
    assert found == {"a": 3, "c": 0, "m": 2, "?": None, None: None}
    with pytest.raises(Exception, match="key without a bin"):
        packing.bin_lookup(asked, packed, ["item"], "size", strict=True).collect()
    known = asked.where("item is null or item <> '?'")
    assert packing.bin_lookup(known, packed, ["item"], "size", strict=True).count() == 4


def _skewed(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 37)).alias("key"),
        F.lit(2).alias("size"), "id",
    )


def _layout(df):
    return df.withColumn("pid", F.spark_partition_id()).select("pid", "key", "id").collect()


def test_every_bin_is_a_partition(spark):
    df = _skewed(spark)
    packed = packing.repartition_packed(df, ["key"], "size", 4)
    assert packed.rdd.getNumPartitions() <= 4
    layout = _layout(packed)
    assert sorted(r.id for r in layout) == list(range(3000))
    homes = defaultdict(set)
    for r in layout:
        homes[r.key].add(r.pid)
    assert all(len(pids) == 1 for key, pids in homes.items() if key is not None)
    assert len(homes[None]) == 4  # rows without a key belong to no bin


def test_hot_key_is_divided_on_request(spark):
    layout = _layout(packing.repartition_packed(_skewed(spark), ["key"], "size", 8, split_by=["id"]))
    assert sorted(r.id for r in layout) == list(range(3000))
    per_part = defaultdict(int)
    for r in layout:
        if r.key is not None:
            per_part[r.pid] += 1
    assert len({r.pid for r in layout if r.key == "hot"}) > 1
    assert max(per_part.values()) < 1.5 * sum(per_part.values()) / 8


def test_modes(spark):
    df = _skewed(spark)
    assert packing.rebalance(df, ["key"], "size") is df
    assert packing.rebalance(df, ["key"], "size", "partition", 7).rdd.getNumPartitions() == 7
    assert packing.rebalance(df, ["key"], "size", "pack", 3).rdd.getNumPartitions() == 3
    with pytest.raises(ValueError):
        packing.rebalance(df, ["key"], "size", "other")


def test_profile(spark):
    got = packing.skew_profile(_skewed(spark).where("key is not null"), ["key"]).first()
    assert got.n_groups == 38 and got.max_rows == 1000 and got.max_over_mean > 5


def test_numbering_is_total_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert rows(packing.numbered(df, ["v"]), "v", "_pos") == [(i, i) for i in range(1000)]


def test_negative_sizes_are_refused(spark):
    items = spark.createDataFrame([(1, 5), (2, -1)], "item int, size long")
    with pytest.raises(Exception, match="must not be negative"):
        packing.pack_n_bins(items, ["item"], "size", 2).collect()


def test_fold_needs_no_package_on_the_executors():
    import pickle

    from pyspark import cloudpickle

    from skewdex.functions.firstfit import fold_runs

    by_value = cloudpickle.dumps(fold_runs(2, None))
    assert b"least_loaded" in by_value  # the class itself, not its name, is in the pickle
    assert callable(pickle.loads(by_value))
