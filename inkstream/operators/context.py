"""Lines of longitudinal context for a digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weeks import weeks_between
from .entities import returning, streaks


def context_lines(hist: DataFrame, now: DataFrame, bank: DataFrame, labels: DataFrame, week: str, gap: int = 4, top: int = 3) -> DataFrame:
    """(section, place, line): entity streaks, returning entities, topic streaks, returning topics; none with under two weeks of history."""
    from pyspark.sql import Window

    enough = hist.agg(F.count_distinct("week").alias("n")).filter("n >= 2").select()
    t = bank.join(labels, "topic_id").withColumn("gap", weeks_between(F.lit(week), F.col("last_week")))
    parts = [
        streaks(hist, now).select(F.lit(1).alias("section"), F.col("n").cast("bigint").alias("k"), F.col("entity").alias("name"), F.format_string("%s: in %d weeks running", "entity", "n").alias("line")),
        returning(hist, now, week).select(F.lit(2), F.col("gap").cast("bigint"), "entity", F.format_string("%s: back after %d weeks", "entity", "gap")),
        t.filter("weeks_seen >= 3").orderBy(F.desc("weeks_seen"), F.desc("label"), "topic_id").limit(top).select(F.lit(3), "weeks_seen", "label", F.format_string("%s: %d weeks", "label", "weeks_seen")),
        t.filter(F.col("gap") >= gap).orderBy(F.desc("gap"), F.desc("label"), "topic_id").limit(top).select(F.lit(4), F.col("gap").cast("bigint"), "label", F.format_string("%s: back after %d weeks", "label", "gap")),
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    w = Window.partitionBy("section").orderBy(F.desc("k"), F.desc("name"), "line")  # at most five lines a section
    return every.crossJoin(F.broadcast(enough)).select("section", F.row_number().over(w).alias("place"), "line")
