"""Lines that begin with one of very many markers, and bodies cut out by them.

A few markers are one regular expression (``functions.lines``). Very many are a table: the
prefixes of a line, one for each length that markers have, are looked up in it by equality,
and the longest that is a marker counts. A line that has no marker's first characters, as
many as the shortest has, is not looked up at all, as long as these can be sent around.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .joins import BROADCAST_ROW_BYTES, BROADCAST_ROWS, lookup_join


def marked_lines(
    lines: DataFrame, key: list[str], line: str, markers: DataFrame, marker: str = "marker",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``key``, ``line`` and the longest ``marker`` that begins the line; other lines go.

    ``key`` tells the lines apart. Null markers and null lines match nothing; the empty marker
    matches every line. ``markers`` may hold any number of rows, repeated ones too.
    """
    known = stage(markers.where(F.col(marker).isNotNull()).select(F.col(marker).alias("_head")).distinct(), "markers")
    # As many rows as markers have different lengths.
    tally = known.groupBy(F.length("_head").alias("n")).agg(F.count(F.lit(1)).alias("heads")).orderBy("n").collect()
    lengths = [t.n for t in tally]
    if not lengths:
        return lines.select(*key, line, F.lit(None).cast("string").alias(marker)).where(F.lit(False))
    long_enough = lines.where(F.length(line) >= lengths[0])
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(line))
    heads = F.explode(F.transform(fitting, lambda n: F.left(F.col(line), n))).alias("_head")
    longest = F.max(F.struct(F.length("_head").alias("n"), "_head"))["_head"]
    # A character has four bytes at the most.
    if sum(t.heads for t in tally) <= broadcast_rows and 4 * lengths[-1] <= BROADCAST_ROW_BYTES:
        first = known.select(F.left("_head", F.lit(lengths[0])).alias("_first")).groupBy("_first").agg(F.count(F.lit(1)).alias("_n"))
        begun = long_enough.select(*key, line, F.left(line, F.lit(lengths[0])).alias("_first"))
        begun = lookup_join(begun, stage(first, "markers"), ["_first"], "_n").drop("_first", "_n")
        met = begun.select(*key, line, heads).join(F.broadcast(known), "_head")
        # Only lines that match are grouped; the line itself is the same in all rows of its key.
        return met.groupBy(*key).agg(F.any_value(line).alias(line), longest.alias(marker))
    # Too many to be sent around: what is looked up are prefixes by the key of their line, and
    # the line, which may be long, is moved once, to the longest marker found under its key.
    place = F.struct(*key).alias("_place")  # in a struct a null equals a null
    best = long_enough.select(place, heads).join(known, "_head").groupBy("_place").agg(longest.alias("_longest"))
    found = long_enough.select(place, F.col(line).alias("_line")).join(best, "_place").where(F.startswith("_line", "_longest"))
    return found.groupBy("_place").agg(F.any_value("_line").alias(line), F.any_value("_longest").alias(marker)).select(
        *[F.col("_place")[name].alias(name) for name in key], line, marker
    )


def bodies_between(
    docs: DataFrame, key: list[str], text: str, start: DataFrame, end: DataFrame, marker: str = "marker", joiner: str = ""
) -> DataFrame:
    """``docs`` with ``text`` cut to its body, by tables of markers; documents without one go.

    The body is as in ``functions.lines.body``: the lines after the first that begins with a
    start marker, up to the first after it that begins with an end marker. ``key`` tells the
    documents apart. Empty lines at the end of a text are not lines of it.
    """
    cut = docs.where(F.col(text).isNotNull()).withColumn("_lines", F.split(F.rtrim(text, F.lit("\n")), "\n"))
    lines = cut.select(*key, F.posexplode("_lines").alias("_at", "_line"))
    place = [*key, "_at"]
    opened = marked_lines(lines, place, "_line", start, marker).groupBy(*key).agg(F.min("_at").alias("_start"))
    closed = marked_lines(lines, place, "_line", end, marker).select(*place)
    opened = stage(opened, "opened")
    ends = closed.join(opened, key).where("_at > _start").groupBy(*key).agg(F.min("_at").alias("_end"))
    spans = opened.join(ends, key, "left")
    body = F.slice("_lines", F.col("_start") + 2, F.greatest(F.coalesce("_end", F.size("_lines")) - F.col("_start") - 1, F.lit(0)))
    return (
        cut.join(spans, key).withColumn(text, F.array_join(body, joiner)).where(F.col(text) != "")
        .select(*docs.columns)
    )
