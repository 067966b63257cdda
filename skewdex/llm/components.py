"""Connected components of an undirected graph given by its edges.

Large-star and small-star steps are repeated until nothing changes; each is a grouped
minimum and a join, so a node with very many links is rows, never one task's array. Each
round goes on from a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skewdex.sources.staging import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    Loops and repeated edges are allowed; edges with a null end are left out.
    """
    now = stage(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(),
        "links",
    )
    state = None
    while True:
        # Large star: every larger neighbour of a node is linked to the smallest of them all.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Written, as it is read three times: a plan that has it so often weighs on the driver.
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # Small star: a node and its smaller neighbours are linked to the smallest of those.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen = Observation()
        links = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("print")
        now = stage(links.observe(seen, F.count(F.lit(1)).alias("n"), digest), "links")
        if seen.get == state:
            break
        state = seen.get
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
