"""Exact duplicates by content hash, with the bytes of equal hashes compared.

Texts are grouped by their 128-bit hash *and* their bytes, so two texts whose hashes collide
stay apart. Copies within a task are one row before anything is shuffled, so a group of
copies of any size sends one text per task. Rows then look their group up by hash and digest;
a hot group there is rows of a few bytes, which Spark's skew join splits.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lower_ascii(text):
    """``text`` with A-Z in lower case and all other characters as they are; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_duplicates(df: DataFrame, id_col: str, text_col: str, keep: str = "min", ignore_case: bool = True) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays, or the largest if ``keep`` is
    ``"max"``. A null text counts as empty, and empty texts are equal. A null id never wins
    against another; if a group has null ids only, they are kept. Rows that share text and
    id are one row given twice: they are kept or dropped together. Other columns are left
    behind.
    """
    best = {"min": F.min, "max": F.max}[keep]
    text = lower_ascii(F.col(text_col)) if ignore_case else F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text")).withColumns(
        {"hash": F.unhex(F.md5("text")), "sha": F.sha2("text", 256)}
    )
    groups = (
        rows.groupBy("hash", "sha", "text")
        .agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .drop("text")
    )
    return (
        rows.select("id", "hash", "sha")
        .join(groups, ["hash", "sha"])
        .select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
        )
    )
