"""The first rows of every group, without gathering any group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    rows: DataFrame,
    group: list[str],
    order: list[Column | str],
    k: int | None,
    place: str,
    number: Callable[[], Column] = F.row_number,
) -> DataFrame:
    """Rows whose ``number`` (row_number or rank) in their group is at most ``k``, as ``place``.

    Spark cuts each input partition to its own first ``k`` before the shuffle, as long as
    ``k`` is below ``spark.sql.optimizer.windowGroupLimitThreshold``. For a larger ``k``, or
    none, see ``ordered.first_rows``.
    """
    numbered = rows.withColumn(place, number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered if k is None else numbered.where(F.col(place) <= k)
