"""Size-balanced bins: packing items, looking bins up, and laying rows out by bin.

First-fit decreasing is sequential by nature: where an item goes depends on all larger
ones. What must run in sequence is kept small here. Items are sorted across the cluster
and numbered, and equal sizes are added up into runs, of which a group has fewer than
sqrt(2 * its total size) however many items it has. Only the runs pass through the fold,
one group at a time, as a stream, with the bin loads as its whole state; it gives back
ranges of item numbers, and the items find their bin by a distributed join on their number.

Runs of very many different sizes are still a sequence. With ``exact`` only the heaviest
items of a group go through the fold. The others are laid end to end, by running sums over
the sorted items, and so is the room that the bins have left; an item goes to the bin whose
room it meets. No task sees more of a group than its share of the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.firstfit import SLOTS, fold_runs
from ..sources.staging import stage
from .joins import BROADCAST_ROWS, lookup_join
from .ordered import rank_all, running

# Bins and partitions of the two re-layout modes where none are asked for.
PACK_BINS, PARTITIONS = 16, 228


def numbered(df: DataFrame, order: list, name: str = "_pos") -> DataFrame:
    """Rows numbered from 0 in the given order, which must be total, without a global window.

    The sorted table is staged, so that all later readers see one numbering.
    """
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    part = F.shiftright("_id", 33)
    staged = stage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    # One row per partition of the sort.
    offsets = (
        staged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows"))
        .select("_part", "_offset")
    )
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place)
        .drop("_id", "_part", "_offset")
    )


def whole_size(df: DataFrame, size: str) -> Column:
    """``size`` as BIGINT. Only whole-number types are taken, and a null size raises."""
    kind = df.schema[size].dataType
    if not (isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0):
        raise ValueError(f"sizes must be whole numbers, {size} is {kind.simpleString()}")
    missing = F.raise_error(F.lit(f"{size}: a size must not be null")).cast("long")
    return F.when(F.col(size).isNull(), missing).otherwise(F.col(size).cast("long"))


def _pack(
    items: DataFrame,
    item: list[str],
    size: str,
    group: list[str],
    nbins: int | None,
    capacity: int | None,
    listed_by: str | None,
) -> DataFrame:
    rows = items.select(
        *group, *item, whole_size(items, size).alias(size),
        *([listed_by] if listed_by and listed_by not in (*group, *item, size) else []),
    )
    if listed_by:
        order = [*group, F.col(listed_by)]
    else:
        order = [*group, F.desc(size), *[F.desc(c) for c in item]]
    placed = numbered(rows, order)
    runs = placed.select(*group, F.col(size).alias("_size"), "_pos")
    if listed_by:
        runs = runs.select(*group, "_size", F.lit(1).cast("long").alias("_n"), F.col("_pos").alias("_start"))
    else:
        runs = runs.groupBy(*group, "_size").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_start")
        )
    # A group is told by the number of its first item, so no two groups share a label.
    first = F.min("_start").over(Window.partitionBy(*group)) if group else F.lit(0).cast("long")
    runs = runs.select(first.alias("_group"), "_size", "_n", "_start")
    slots = (
        runs.repartition("_group")
        .sortWithinPartitions("_start")
        .mapInPandas(fold_runs(nbins, capacity), SLOTS)
    )
    turn = F.get("bins", ((F.col("_pos") - F.col("lo")) % F.size("bins")).cast("int"))
    # Every item number is in one range; items and ranges meet on it.
    bins = slots.select("lo", "bins", F.explode(F.sequence("lo", "hi")).alias("_pos")).select("_pos", turn.alias("bin"))
    return placed.join(bins, "_pos").select(*group, *item, size, "bin")


def pack_n_bins(
    items: DataFrame, item: list[str], size: str, nbins: int, group: list[str] | None = None, exact: int | None = None
) -> DataFrame:
    """``group``, ``item``, ``size`` and ``bin``: at most ``nbins`` bins per group.

    Items go by size, largest first (equal sizes by item, descending), into the first bin
    that stays within the size of the largest item; failing that into a new bin, and once
    there are ``nbins`` of them into the smallest.

    With ``exact`` that holds for the ``exact`` heaviest items of a group, and the others
    fill the bins up to one level (see ``_level_off``): a bin that gets any of them ends
    within the size of the heaviest of those of that level.
    """
    if nbins < 1:
        raise ValueError("nbins must be at least 1")
    if exact is None:
        return _pack(items, item, size, group or [], nbins, None, None)
    return _level_off(items, item, size, group or [], nbins, exact)


def pack_max_capacity(
    items: DataFrame,
    item: list[str],
    size: str,
    capacity: int,
    group: list[str] | None = None,
    listed_by: str | None = None,
    exact: int | None = None,
) -> DataFrame:
    """As many bins per group as needed to stay within ``capacity``, first fit.

    An item above the capacity gets a bin of its own. Items go largest first, or, with
    ``listed_by``, in the order of that unique column; listed order has no equal runs to
    add up, so each item is then a step of the fold.

    With ``exact`` the ``exact`` heaviest items of a group go by first fit, and the others
    fill the room that is left and then further bins (see ``_fill_up``).
    """
    if exact is None:
        return _pack(items, item, size, group or [], None, capacity, listed_by)
    if listed_by:
        raise ValueError("listed_by has no heaviest items: leave exact out")
    return _fill_up(items, item, size, group or [], capacity, exact)


_KEY = "_of"


def _heaviest(items: DataFrame, item: list[str], size: str, group: list[str], exact: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The ``exact`` heaviest items of each group, the others, staged, and the items' columns.

    The others have their ``_start``: the size of those of them that come before.
    """
    if exact < 1:
        raise ValueError("exact must be at least 1")
    own = [*group, *item, size]
    rows = items.select((F.struct(*group) if group else F.lit(0)).alias(_KEY), *group, *item, whole_size(items, size).alias(size))
    checked = rows.withColumn(size, F.when(F.col(size) >= 0, F.col(size)).otherwise(F.raise_error(F.lit("a size must not be negative")).cast("long")))
    placed = stage(running(checked, [_KEY], [f"-{size}", *[f"-{c}" for c in item]], size, "_place", "_start"), "placed")
    heavy = placed.where(F.col("_place") <= exact)
    # A row for each group; of it only the rows up to ``exact`` are read.
    held = heavy.groupBy(_KEY).agg(F.sum(F.col(size).cast("decimal(38,0)")).alias("_held"), F.count(F.lit(1)).alias("_n"))
    rest = lookup_join(placed.where(F.col("_place") > exact), stage(held, "held"), [_KEY], "_n")
    return heavy.select(_KEY, *own), rest.select(_KEY, *own, (F.col("_start") - F.col("_held")).cast("decimal(38,0)").alias("_start")), own


def _meet(rest: DataFrame, spans: DataFrame, at: Column) -> DataFrame:
    """``rest`` with the columns of the span of its group, [_lo, _hi), that the place ``at`` lies in.

    A join by ranges: both sides are dealt to the cells of a grid of ``_cell`` wide cells,
    and meet in their cell. ``spans`` has _KEY, _lo, _hi and _cell, the same for all spans
    of a group; there are as many cells as spans.
    """
    cells = F.sequence(F.expr("_lo div _cell"), F.expr("(_hi - 1) div _cell"))
    dealt = stage(spans.where("_hi > _lo").withColumn("_in", F.explode(cells)), "spans")
    few = dealt.count() <= BROADCAST_ROWS
    widths = spans.groupBy(_KEY).agg(F.max("_cell").alias("_cell"), F.max("_hi").alias("_end"))
    placed = rest.join(F.broadcast(widths) if few else widths, _KEY).withColumn("_at", F.least(at, F.col("_end") - 1)).withColumn("_in", F.expr("_at div _cell"))
    dealt = dealt.drop("_cell")
    met = placed.join(F.broadcast(dealt) if few else dealt, [_KEY, "_in"])
    return met.where((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))


def _level_off(items: DataFrame, item: list[str], size: str, group: list[str], nbins: int, exact: int) -> DataFrame:
    """The heaviest items by first fit; the others raise the bins' loads to one level.

    The level is where the room below it, over all bins that are lower, is the size of the
    others. An item goes to the bin in whose room its middle lies, so a bin is off the level
    by no more than half an item at either end of its room.
    """
    heavy, rest, own = _heaviest(items, item, size, group, exact)
    packed = stage(_pack(heavy, [*group, *item], size, [_KEY], nbins, None, None), "packed")
    loads = packed.groupBy(_KEY, "bin").agg(F.sum(F.col(size).cast("decimal(38,0)")).alias("_load"))
    every = packed.select(_KEY).distinct().select(_KEY, F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"))
    total = rest.groupBy(_KEY).agg(F.sum(F.col(size).cast("decimal(38,0)")).alias("_all"))
    # Windows over the bins of a group, which are ``nbins``.
    by_load = Window.partitionBy(_KEY).orderBy("_load", "bin")
    bins = (
        every.join(loads, [_KEY, "bin"], "left").join(total, _KEY)
        .select(_KEY, "bin", F.coalesce("_load", F.lit(0)).cast("decimal(38,0)").alias("_load"), "_all")
        .withColumns({"_k": F.row_number().over(by_load), "_sum": F.sum("_load").over(by_load)})
        # The bins below the level, which is (_all + _sum) / _k of the last of them.
        .where((F.col("_load") * F.col("_k") < F.col("_all") + F.col("_sum")) | (F.col("_k") == 1))
    )
    last = Window.partitionBy(_KEY)
    level = bins.withColumns({"_below": F.max("_k").over(last), "_filled": F.max_by("_sum", "_k").over(last)})
    # Rooms in halves of a _below-th, so that all are whole: the level is (_all + _filled) / _below.
    room = F.lit(2) * (F.col("_all") + F.col("_filled") - F.col("_below") * F.col("_load"))
    ends = F.sum("_room").over(Window.partitionBy(_KEY).orderBy("_k"))
    spans = (
        level.withColumn("_room", room.cast("decimal(38,0)")).withColumn("_hi", ends.cast("decimal(38,0)"))
        .select(_KEY, "bin", "_below", "_all", (F.col("_hi") - F.col("_room")).cast("decimal(38,0)").alias("_lo"), "_hi")
    )
    # Sizes of 0 alone have no room to go by: they go to the lowest bin.
    hi = F.when((F.col("_all") == 0) & (F.col("_lo") == 0), F.greatest("_hi", F.lit(1))).otherwise(F.col("_hi")).cast("decimal(38,0)")
    cell = F.greatest(F.ceil(F.lit(2) * F.col("_below") * F.col("_all") / nbins), F.lit(1)).cast("decimal(38,0)")
    spans = stage(spans.withColumn("_hi", hi).withColumn("_cell", cell), "rooms")
    below = spans.groupBy(_KEY).agg(F.max("_below").alias("_below"))
    middle = ((F.lit(2) * F.col("_start") + F.col(size)) * F.col("_below")).cast("decimal(38,0)")
    wide = lookup_join(rest, stage(below.withColumn("_n", F.lit(1)), "below"), [_KEY], "_n")
    met = _meet(wide.drop("_n"), spans.drop("_below", "_all"), middle)
    return packed.select(*own, "bin").unionByName(met.select(*own, "bin"))


def _fill_up(items: DataFrame, item: list[str], size: str, group: list[str], capacity: int, exact: int) -> DataFrame:
    """The heaviest items by first fit; the others into the room left, and then into new bins.

    Of the others, those above half the capacity get a bin each. The rest are laid end to end
    over the room of all these bins and then over new ones. Those that would cross the end of
    a bin, at most one to a bin, are laid over new bins in a further round. Each is at most
    half a bin, so every round leaves half as much, and the last ``exact`` go by first fit.
    """
    heavy, rest, own = _heaviest(items, item, size, group, exact)
    decimal = "decimal(38,0)"
    packed = stage(_pack(heavy, [*group, *item], size, [_KEY], None, capacity, None).select(_KEY, *own, "bin"), "packed")
    large, small = rest.where(F.col(size) > capacity // 2), rest.where(F.col(size) <= capacity // 2)
    # How many bins a group has, and how much lies in front of its small items.
    opened = packed.groupBy(_KEY).agg((F.max("bin") + 1).cast("long").alias("_next"))
    taken = large.groupBy(_KEY).agg(F.count(F.lit(1)).alias("_large"), F.sum(F.col(size).cast(decimal)).alias("_front"))
    heads = stage(
        opened.join(taken, _KEY, "left").select(
            _KEY, "_next", F.coalesce("_large", F.lit(0)).alias("_large"), F.coalesce("_front", F.lit(0)).cast(decimal).alias("_front"), F.lit(1).alias("_n")
        ), "heads",
    )
    order = [f"-{size}", *[f"-{c}" for c in item]]
    numbered_large = lookup_join(running(large, [_KEY], order, size, "_place", "_before"), heads, [_KEY], "_n")
    parts = [packed, stage(numbered_large.withColumn("bin", F.col("_next") + F.col("_place") - 1).select(_KEY, *own, "bin"), "large")]
    loads = parts[0].unionByName(parts[1]).groupBy(_KEY, "bin").agg(F.sum(F.col(size).cast(decimal)).alias("_load"))
    rooms = loads.select(_KEY, "bin", (F.lit(capacity) - F.col("_load")).cast(decimal).alias("_room")).where("_room > 0")
    rooms = stage(running(rooms, [_KEY], ["bin"], "_room", "_place", "_lo").withColumn("_hi", (F.col("_lo") + F.col("_room")).cast(decimal)), "rooms")
    ends = rooms.groupBy(_KEY).agg(F.max("_hi").alias("_end"), F.count(F.lit(1)).alias("_spans"))
    heads = stage(
        heads.join(ends, _KEY, "left").select(
            _KEY, (F.col("_next") + F.col("_large")).alias("_next"), "_front", "_n",
            F.coalesce("_end", F.lit(0)).cast(decimal).alias("_end"), F.coalesce("_spans", F.lit(1)).alias("_spans"),
        ), "heads",
    )
    at = lookup_join(small, heads, [_KEY], "_n").withColumn("_start", (F.col("_start") - F.col("_front")).cast(decimal))
    cell = F.greatest(F.ceil(F.col("_end") / F.col("_spans")), F.lit(1)).cast(decimal)
    spans = lookup_join(rooms.select(_KEY, "bin", "_lo", "_hi"), heads, [_KEY], "_n").withColumn("_cell", cell).select(_KEY, "bin", "_lo", "_hi", "_cell")
    met = _meet(at.where("_start < _end").select(_KEY, *own, "_start"), stage(spans, "spans"), F.col("_start"))
    into_rooms = met.select(_KEY, *own, F.col("bin").cast("long").alias("bin"), (F.col("_start") + F.col(size) <= F.col("_hi")).alias("_fits"))
    past = at.where("_start >= _end").withColumn("_start", (F.col("_start") - F.col("_end")).cast(decimal))
    tried = stage(into_rooms.unionByName(_over_new_bins(past, own, size, capacity)), "tried")
    while True:
        parts.append(tried.where("_fits").select(_KEY, *own, "bin"))
        left = tried.where("not _fits").select(_KEY, *own)
        tally = tried.groupBy(_KEY).agg(F.max("bin").alias("_last"), F.count_if(~F.col("_fits")).alias("_left"))
        heads = stage(
            heads.join(tally, _KEY, "left").select(
                _KEY, F.greatest("_next", F.col("_last") + 1).alias("_next"), F.coalesce("_left", F.lit(0)).alias("_n")
            ), "heads",
        )
        if (heads.agg(F.max("_n")).first()[0] or 0) <= exact:
            break
        laid = lookup_join(running(left, [_KEY], order, size, "_place", "_start"), heads, [_KEY], "_n")
        tried = stage(_over_new_bins(laid, own, size, capacity), "tried")
    last = _pack(left, [*group, *item], size, [_KEY], None, capacity, None)
    parts.append(lookup_join(last, heads, [_KEY], "_n").withColumn("bin", F.col("bin") + F.col("_next")).select(_KEY, *own, "bin"))
    found = parts[0].withColumn("bin", F.col("bin").cast("long"))
    for part in parts[1:]:
        found = found.unionByName(part)
    # Bins over which only crossing items lay are empty: the others are numbered anew.
    found = stage(found, "packed")
    used = found.groupBy(_KEY, "bin").agg(F.count(F.lit(1)).alias("_n"))
    dense = rank_all(used, [_KEY], ["bin"], "_place").select(_KEY, "bin", "_n", (F.col("_place") - 1).cast("int").alias("_bin"))
    return lookup_join(found, stage(dense, "bins"), [_KEY, "bin"], "_n").select(*own, F.col("_bin").alias("bin"))


def _over_new_bins(laid: DataFrame, own: list[str], size: str, capacity: int) -> DataFrame:
    """_KEY, ``own``, ``bin``, from ``_next`` on by where an item starts, and whether it ``_fits`` into it."""
    wide = max(capacity, 1)
    place = F.expr(f"_start div {wide}")
    return laid.select(
        _KEY, *own, (F.col("_next") + place).alias("bin"), (F.col("_start") - place * F.lit(wide) + F.col(size) <= F.lit(capacity)).alias("_fits")
    )


def bin_stats(packed: DataFrame, size: str, group: list[str] | None = None) -> DataFrame:
    """Per bin its label, number of items and total size; the members are ``packed`` itself."""
    return (
        packed.groupBy(*(group or []), "bin")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sum(size).alias("bin_size"))
        .withColumn("label", F.concat(F.lit("Bin#"), F.col("bin")))
    )


def n_bins(packed: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Number of bins (per group)."""
    return packed.groupBy(*(group or [])).agg((F.max("bin") + 1).alias("n_bins"))


def bin_lookup(
    rows: DataFrame, packed: DataFrame, key: list[str], size: str, strict: bool = False
) -> DataFrame:
    """``rows`` with the ``bin`` of their key, null for an unknown one.

    With ``strict`` an unknown key that is not null raises. ``packed`` should be staged.
    """
    bins = packed.select(*key, F.col(size).alias("_weight"), "bin")
    found = lookup_join(rows, bins, key, "_weight", "left").drop("_weight")
    if not strict:
        return found
    known = F.col("bin").isNotNull()
    for name in key:
        known = known | F.col(name).isNull()
    return found.withColumn(
        "bin", F.when(known, F.col("bin")).otherwise(F.raise_error(F.lit("key without a bin")).cast("int"))
    )


def assign_bins(
    rows: DataFrame,
    key: list[str],
    size: str,
    nbins: int,
    split_by: list[str] | None = None,
) -> tuple[DataFrame, int]:
    """``rows`` with the ``bin`` of their key (null without a key), and the number of bins.

    Keys are packed by their sum of ``size``. One key heavier than a fair share makes its
    bin a straggler: with ``split_by`` (columns that tell its rows apart) such a key is cut
    into parts of about a share each, which are packed on their own. ``rows`` is read more
    than once, by its key and size columns.
    """
    present = F.lit(True)
    for name in key:
        present = present & F.col(name).isNotNull()
    weight, part = "_size", "_share"
    cut = rows.withColumn(part, F.lit(0))
    if split_by:
        sizes = stage(
            rows.where(present).groupBy(*key).agg(F.sum(whole_size(rows, size)).alias(weight)), "sizes"
        )
        share = max(1, -(-(sizes.agg(F.sum(weight)).first()[0] or 0) // nbins))
        heavy = sizes.where(F.col(weight) > share).select(
            *key, weight, F.ceil(F.col(weight) / share).cast("long").alias("_shares")
        )
        cut = lookup_join(rows, heavy, key, weight, "left").withColumn(
            part,
            F.coalesce(F.pmod(F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in split_by])), F.col("_shares")), F.lit(0)).cast("int"),
        ).drop(weight, "_shares")
    unit = [*key, part]
    units = cut.where(present).groupBy(*unit).agg(F.sum(whole_size(rows, size)).alias(weight))
    packed = stage(pack_n_bins(units, unit, weight, nbins), "bins")
    last = packed.agg(F.max("bin")).first()[0]
    return bin_lookup(cut, packed, unit, weight, strict=True).drop(part), (last or 0) + 1


def hash_places(spark: SparkSession, n: int) -> DataFrame:
    """(bin, place): for each of ``n`` bins a number whose hash puts its rows into the bin's own partition of ``n``.

    Rows laid out by ``repartition(n, place)`` are a bin to a partition, in a layout that
    joins, windows and aggregates by ``place`` (and more columns) know for theirs.
    """
    # Some 30 numbers to a bin: that one has none of them is hardly ever so, and then more are tried.
    tried = 30 * n + 100
    while True:
        own = F.pmod(F.hash("place"), F.lit(n)).alias("bin")
        found = spark.range(tried).select(F.col("id").cast("int").alias("place")).groupBy(own).agg(F.min("place").alias("place"))
        found = stage(found, "places")
        if found.count() == n:
            return found
        tried *= 4


def repartition_packed(
    rows: DataFrame,
    key: list[str],
    size: str,
    nbins: int,
    split_by: list[str] | None = None,
) -> DataFrame:
    """``rows`` laid out so that every partition is a bin and holds all rows of its keys.

    A key stays whole however heavy it is, unless ``split_by`` is given (see ``assign_bins``),
    which gives up the one partition per key for keys that would not fit a fair share. Rows
    without a key belong to no bin and are dealt out evenly.
    """
    placed, count = assign_bins(rows, key, size, nbins, split_by)
    anywhere = F.pmod(F.xxhash64(*rows.columns), F.lit(count)).cast("int")
    return placed.repartitionById(count, F.coalesce("bin", anywhere)).drop("bin")


def rebalance(
    rows: DataFrame,
    key: list[str],
    size: str,
    mode: str = "skew",
    n: int | None = None,
    split_by: list[str] | None = None,
) -> DataFrame:
    """``rows`` as they are ("skew"), packed by key ("pack"), or dealt out evenly ("partition")."""
    if mode == "skew":
        return rows
    if mode == "pack":
        return repartition_packed(rows, key, size, PACK_BINS if n is None else n, split_by)
    if mode == "partition":
        return rows.repartition(PARTITIONS if n is None else n)
    raise ValueError(f"mode must be 'skew', 'pack' or 'partition', not {mode!r}")


def skew_profile(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row: number of groups, and least, largest, spread and largest / mean of their row counts."""
    n = F.col("_rows")
    return (
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .agg(
            F.count(n).alias("n_groups"),
            F.min(n).alias("min_rows"),
            F.max(n).alias("max_rows"),
            F.stddev_pop(n).alias("stddev_rows"),
            (F.max(n) / F.avg(n)).alias("max_over_mean"),
        )
    )
