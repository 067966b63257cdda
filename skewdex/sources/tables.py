"""Reading input tables with enough tasks for the work that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, dealt out to all cores if its scan has fewer partitions than there are cores.

    A scan has one task per row group at the most, so a small file of one row group would
    be cut by one core. A table that fills the cores is read as it lies.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
