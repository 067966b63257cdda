"""Lookups into a side that is unique on the join key, safe under hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side has no more rows than this and no wider ones, so it stays within 100 MB;
# both are checked against the data or follow from the choice of its rows.
BROADCAST_ROWS = 100_000
BROADCAST_ROW_BYTES = 1_000


def _width(df: DataFrame) -> Column:
    """Bytes of the values of a row that have no fixed size."""

    def of(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(kind, T.StructType):
            return reduce(Column.__add__, (of(value[f.name], f.dataType) for f in kind), F.lit(0))
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0))
        return F.lit(0)

    return reduce(Column.__add__, (of(F.col(f.name), f.dataType) for f in df.schema), F.lit(0))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    weight: str,
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    spread_by: list[str] | None = None,
    spread_n: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per ``on`` and should be a staged table.

    ``weight`` is a whole-number column of ``right``, the number of ``left`` rows under the
    key or what grows with it. A ``right`` of at most ``rows`` rows is broadcast. A larger
    one is split by weight: the heaviest keys, as many as fit in ``rows``, are broadcast, so
    hot keys are never shuffled; the others meet in an ordinary shuffle join, and each of them
    holds less than 2/rows of the total weight. Rows too wide to broadcast are joined with
    those. If ``left`` is already spread by ``spread_by``, the shuffled rows are brought back
    to that layout (of ``spread_n`` partitions), so that an operator that needs it does not
    move the hot rows.
    """
    narrow = _width(right) <= BROADCAST_ROW_BYTES
    # Keys by the number of binary digits of their weight: at most 64 times two rows.
    digits = F.length(F.bin(F.col(weight)))
    tally = right.groupBy(digits.alias("digits"), narrow.alias("narrow")).agg(F.count(F.lit(1)).alias("n")).collect()
    if sum(t.n for t in tally) <= rows and all(t.narrow for t in tally):
        return left.join(F.broadcast(right), on, how)

    least, fitting = 1 << 62, 0
    for t in sorted((t for t in tally if t.narrow), key=lambda t: -t.digits):
        fitting += t.n
        if fitting > rows:
            break
        least = 1 << (t.digits - 1)
    is_hot = narrow & (F.col(weight) >= least)
    hot = right.where(is_hot)
    parts = [left.join(F.broadcast(hot), on)]
    rest = left
    if how == "left":
        # Rows without a key match nothing; shuffled, they would all land in one task.
        keyless = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
        parts.append(
            left.where(keyless).withColumns(
                {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name not in on}
            )
        )
        rest = left.where(~keyless)
    cold = rest.join(F.broadcast(hot.select(*on)), on, "left_anti").join(right.where(~is_hot), on, how)
    if spread_by:
        cold = cold.repartition(*([spread_n] if spread_n else []), *[F.col(c) for c in spread_by])
    parts.append(cold)
    return reduce(DataFrame.unionByName, parts)
