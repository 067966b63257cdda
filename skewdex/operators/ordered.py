"""Ranks and running sums inside groups of any size, without a window over a group.

Rows are sorted across the cluster by group and order, with a tie breaker, so that neither a
large group nor many equal values end up in one range. Windows run inside the parts of that
sort only; what a part has to know of those before it comes from a table of one row per part
and group, which has few more rows than there are parts and groups.

An order is a list of column names; '-' before a name means descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import stage
from .ranking import keep_first

_GROUP, _PART, _TIE, _ROW = "_o_group", "_o_part", "_o_tie", "_o_row"


def columns(order: list[str]) -> list[Column]:
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]


def _names(order: list[str]) -> list[str]:
    return [name.removeprefix("-") for name in order]


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def sorted_parts(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows``, staged in order, with the number of the part of the sort that each is in."""
    told = [f.name for f in rows.schema if _hashable(f.dataType)]
    tied = rows.select(
        # In a struct a null equals a null, so it is a group like others.
        (F.struct(*group) if group else F.lit(0)).alias(_GROUP), "*",
        F.xxhash64(*told).alias(_TIE), F.monotonically_increasing_id().alias(_ROW),
    )
    placed = tied.orderBy(_GROUP, *columns(order), _TIE, _ROW)
    return stage(placed.withColumn(_PART, F.spark_partition_id()), "sorted")


def _before(parts: DataFrame, value: str) -> Column:
    """What the earlier parts of a group have of ``value``; a group has at most a row per part."""
    return F.sum(value).over(Window.partitionBy(_GROUP).orderBy(_PART)) - F.col(value)


def rank_all(
    rows: DataFrame, group: list[str], order: list[str], place: str, ties: bool = False, k: int | None = None
) -> DataFrame:
    """``rows`` with their ``place`` in their group, from 1: ROW_NUMBER, or RANK with ``ties``.

    With ``k``, those up to it; there may be more of them with ``ties``.
    """
    placed, by = sorted_parts(rows, group, order), columns(order)
    inside = Window.partitionBy(_PART, _GROUP)
    if ties:
        local = placed.withColumn(place, F.rank().over(inside.orderBy(*by)).cast("long"))
    else:
        local = placed.withColumn(place, F.row_number().over(inside.orderBy(*by, _TIE, _ROW)).cast("long"))
    if ties:
        key = F.struct(*_names(order))
        parts = local.groupBy(_PART, _GROUP).agg(
            F.count(F.lit(1)).alias("_o_rows"), F.min_by(key, place).alias("_o_first"),
            F.max_by(key, place).alias("_o_last"), F.max(place).alias("_o_at"),
        )
        parts = stage(parts.withColumn("_o_offset", _before(parts, "_o_rows")), "parts")
        # Equal values may go on over the edge of a part: their rank is where they begin.
        seen = parts.select(_GROUP, F.col("_o_first").alias("_o_key"), (F.col("_o_offset") + 1).alias("_o_begin")).unionByName(
            parts.select(_GROUP, F.col("_o_last").alias("_o_key"), (F.col("_o_offset") + F.col("_o_at")).alias("_o_begin"))
        )
        begins = seen.groupBy(_GROUP, F.col("_o_key").alias("_o_first")).agg(F.min("_o_begin").alias("_o_begin"))
        offsets = parts.join(begins, [_GROUP, "_o_first"]).select(_PART, _GROUP, "_o_offset", "_o_begin")
        number = F.when(F.col(place) == 1, F.col("_o_begin")).otherwise(F.col("_o_offset") + F.col(place))
    else:
        parts = placed.groupBy(_PART, _GROUP).agg(F.count(F.lit(1)).alias("_o_rows"))
        offsets = parts.select(_PART, _GROUP, _before(parts, "_o_rows").alias("_o_offset"))
        number = F.col("_o_offset") + F.col(place)
    if k is not None:
        local = local.where(F.col(place) <= k)  # no row comes earlier in its group than in its part
    ranked = local.join(offsets, [_PART, _GROUP]).withColumn(place, number)
    return (ranked if k is None else ranked.where(F.col(place) <= k)).select(*rows.columns, place)


def running(rows: DataFrame, group: list[str], order: list[str], value: str, place: str, before: str) -> DataFrame:
    """``rows`` with their ``place`` in their group, from 1, and the sum of ``value`` ``before`` them, as decimals."""
    exact = F.col(value).cast("decimal(38,0)")
    placed = sorted_parts(rows, group, order)
    inside = Window.partitionBy(_PART, _GROUP).orderBy(*columns(order), _TIE, _ROW)
    local = placed.withColumns({
        place: F.row_number().over(inside).cast("long"),
        before: F.sum(exact).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - exact,
    })
    parts = placed.groupBy(_PART, _GROUP).agg(F.count(F.lit(1)).alias("_o_rows"), F.sum(exact).alias("_o_sum"))
    offsets = parts.select(_PART, _GROUP, _before(parts, "_o_rows").alias("_o_offset"), _before(parts, "_o_sum").alias("_o_start"))
    found = local.join(offsets, [_PART, _GROUP])
    return found.withColumns({
        place: F.col(place) + F.col("_o_offset"), before: (F.col(before) + F.col("_o_start")).cast("decimal(38,0)"),
    }).select(*rows.columns, place, before)


def first_rows(
    rows: DataFrame, group: list[str], order: list[str], k: int | None, place: str, ties: bool = False
) -> DataFrame:
    """The rows whose ``place`` (ROW_NUMBER, or RANK with ``ties``) in their group is at most ``k``.

    For a ``k`` that Spark cuts each partition to before it shuffles, this is a window over
    what is left; for a larger one, or none, no group is gathered and ``place`` is a BIGINT
    (see ``rank_all``).
    """
    limit = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k is not None and k < limit:
        return keep_first(rows, group, columns(order), k, place, F.rank if ties else F.row_number)
    return rank_all(rows, group, order, place, ties, k)
