"""Entities: extraction, weekly history and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weeks import weeks_between

#: Labels whose entities carry signal.
SIGNAL_LABELS = ("ORG", "PERSON", "PRODUCT", "GPE")
# Forms of the rule-based labels.
RULES = {
    "MONEY": r"[$€£¥]\s?\d[\d,.]*(?:\s(?:million|billion|trillion|Millionen|millions|millones|milhões))?",
    "PERCENT": r"\d[\d,.]*\s?(?:%|percent\b|Prozent\b|процента?\b)",
    "DATE": r"\b(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4})\b",
}


def extract_entities(text: Column, gazetteer: dict[str, str] | None = None) -> Column:
    """array<struct<entity, label>>: rule-based amounts, shares and dates, capitalised names of two words or more, gazetteer names.

    The gazetteer is configuration held in the plan. The last label of an entity wins, as in a map keyed by its text.
    """
    found = [F.transform(F.regexp_extract_all(text, F.lit(rx), 0), _labelled(label)) for label, rx in RULES.items()]
    names = F.regexp_extract_all(text, F.lit(r"\b\p{Lu}[\p{L}\p{M}]+(?: \p{Lu}[\p{L}\p{M}]+)+"), 0)
    parts = [F.transform(names, _labelled("ORG")), *found]
    if gazetteer:
        table = F.array(*[F.struct(F.lit(k).alias("entity"), F.lit(v).alias("label")) for k, v in sorted(gazetteer.items())])
        parts.append(F.filter(table, lambda e: F.contains(text, e["entity"])))
    return F.concat(*parts)


def _labelled(label: str):
    return lambda x: F.struct(F.trim(x).alias("entity"), F.lit(label).alias("label"))


def item_entities(items: DataFrame, gazetteer: dict[str, str] | None = None, body_chars: int = 800) -> DataFrame:
    """(id, entity, label): one row per entity of an item, from its title and the start of its body."""
    text = F.concat_ws(" ", "title", F.substring("body", 1, body_chars))
    each = items.select("id", F.posexplode(extract_entities(text, gazetteer)).alias("pos", "e"))
    return each.groupBy("id", F.col("e.entity").alias("entity")).agg(F.max_by("e.label", "pos").alias("label"))


def signal_entities(entities: DataFrame, sources: DataFrame) -> DataFrame:
    """Entities of a signal label whose lower-cased text is no source's name."""
    names = sources.select(F.lower("source").alias("__s")).distinct()
    return entities.filter(F.col("label").isin(*SIGNAL_LABELS)).join(names, F.lower("entity") == F.col("__s"), "left_anti")


def history(mentions: DataFrame) -> DataFrame:
    """(entity, week, count) from (entity, week) mentions."""
    return mentions.groupBy("entity", "week").agg(F.count("*").alias("count"))


def idf(hist: DataFrame) -> DataFrame:
    """(entity, df, idf): ln((1 + weeks) / (1 + weeks of the entity)); what history lacks gets default_idf()."""
    n = hist.agg(F.count_distinct("week").alias("n"))
    return hist.groupBy("entity").agg(F.count_distinct("week").alias("df")).crossJoin(F.broadcast(n)).select("entity", "df", F.log((1 + F.col("n")) / (1 + F.col("df"))).alias("idf"))


def default_idf(hist: DataFrame) -> DataFrame:
    """One row, (idf): ln(1 + weeks), or ln 2 without history."""
    return hist.agg(F.count_distinct("week").alias("n")).select(F.when(F.col("n") == 0, F.log(F.lit(2.0))).otherwise(F.log(1.0 + F.col("n"))).alias("idf"))


def latest_weeks(df: DataFrame, n: int, column: str = "week") -> DataFrame:
    return df.select(column).distinct().orderBy(F.desc(column)).limit(n)


def velocity(counts: DataFrame, hist: DataFrame, weeks: int = 4) -> DataFrame:
    """(entity, velocity): (count - mean) / max(mean, 1), the mean over the rows there are in the latest weeks, 0 without any."""
    recent = hist.join(F.broadcast(latest_weeks(hist, weeks)), "week", "left_semi").groupBy("entity").agg(F.avg("count").alias("mean"))
    mean = F.coalesce("mean", F.lit(0.0))
    return counts.join(recent, "entity", "left").select("entity", ((F.col("count") - mean) / F.greatest(mean, F.lit(1.0))).alias("velocity"))


def streaks(hist: DataFrame, now: DataFrame, weeks: int = 3, top: int = 5) -> DataFrame:
    """(entity, n): entities of this week that stand in all of the latest weeks; the top by (n, name)."""
    last = latest_weeks(hist, weeks)
    n = hist.join(F.broadcast(last), "week", "left_semi").groupBy("entity").agg(F.count_distinct("week").alias("n")).filter(F.col("n") >= weeks)
    return n.join(now.select("entity").distinct(), "entity", "left_semi").orderBy(F.desc("n"), F.desc("entity")).limit(top)


def returning(hist: DataFrame, now: DataFrame, week: str, lookback: int = 6, gap: int = 4, top: int = 5) -> DataFrame:
    """(entity, last_week, gap): entities of this week last seen at least `gap` weeks ago among the latest other weeks."""
    other = hist.filter(F.col("week") != week)
    seen = other.join(F.broadcast(latest_weeks(other, lookback)), "week", "left_semi").groupBy("entity").agg(F.max("week").alias("last_week"))
    away = seen.join(now.select("entity").distinct(), "entity", "left_semi").withColumn("gap", weeks_between(F.lit(week), F.col("last_week")))
    return away.filter(F.col("gap") >= gap).orderBy(F.desc("gap"), F.desc("entity")).limit(top)


def top_entities(counts: DataFrame, k: int = 5) -> DataFrame:
    """(cluster_id, entity, count, velocity, place): each cluster's first entities by count and velocity."""
    w = Window.partitionBy("cluster_id").orderBy(F.desc("count"), F.desc("velocity"), "entity")
    return counts.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)
