"""Ranks within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def average_ranks(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., value, n_ties, n, rank): rank 1 for the largest value, ties averaged, n the group's size.

    Values are counted first, then cut into ranges over all groups; a rank is the count in the ranges above plus the count above
    within the range, so that no group has to fit in one task. NULL and NaN values must be filtered out before.
    """
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*by, value).agg(F.count("*").alias("n_ties"))
    placed = cut(counted.repartitionByRange(n_parts, *by, value).withColumn("__range", F.spark_partition_id()))
    group = Window.partitionBy(*by)
    ranges = placed.groupBy(*by, "__range").agg(F.sum("n_ties").alias("__in"))
    ranges = ranges.select(
        *by, "__range", F.sum("__in").over(group).alias("n"),
        F.coalesce(F.sum("__in").over(group.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__above"),
    )
    here = Window.partitionBy(*by, "__range").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__before", F.coalesce(F.sum("n_ties").over(here), F.lit(0)))
    rank = F.col("__above") + F.col("__before") + (F.col("n_ties") + 1) / 2
    return local.join(ranges, [*by, "__range"]).select(*by, value, "n_ties", "n", rank.alias("rank"))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with name, the rows' numbers from 1 in the given order: a sort over all partitions, and how many rows stand in those before."""
    placed = cut(df.orderBy(*order).withColumn("__m", F.monotonically_increasing_id()))  # partition and place in it, in one number
    placed = placed.withColumn("__part", F.shiftright("__m", 33)).withColumn("__at", F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    parts = placed.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(parts), "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__m", "__part", "__at", "__before")
