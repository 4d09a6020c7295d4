"""Cluster signals and the weighted score. Inputs are narrow tables; every function is a few joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weeks import weeks_between

# Default weights of the score.
DEFAULT_WEIGHTS = {"coverage": 0.14, "prior": 0.07, "novelty": 0.09, "relevance": 0.20, "entity_signal": 0.06, "trend": 0.05, "richness": 0.06, "coverage_gap": 0.06, "persistence": 0.10, "source_breadth": 0.07, "recency_decay": 0.10}


def minmax(x: Column, by: list[str] | None = None) -> Column:
    """(x - min) / (max - min + 1e-9) over the groups of `by`; equal values give 0."""
    w = Window.partitionBy(*(by or []))
    return (x - F.min(x).over(w)) / (F.max(x).over(w) - F.min(x).over(w) + 1e-9)


def minmax_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """min-max of whole columns by one aggregate row, so that nothing is gathered in one partition."""
    ends = df.agg(*[F.min(c).alias(f"__lo_{c}") for c in columns], *[F.max(c).alias(f"__hi_{c}") for c in columns])
    j = df.crossJoin(F.broadcast(ends))
    return j.select(*[((F.col(c) - F.col(f"__lo_{c}")) / (F.col(f"__hi_{c}") - F.col(f"__lo_{c}") + 1e-9)).alias(c) if c in columns else F.col(c) for c in df.columns])


def clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    x = x if lo is None else F.greatest(x, F.lit(lo))
    return x if hi is None else F.least(x, F.lit(hi))


def coverage(sizes: DataFrame) -> DataFrame:
    """(cluster, coverage): ln(1 + n) / ln(1 + largest n)."""
    top = sizes.agg(F.max("n").alias("top"))
    return sizes.crossJoin(F.broadcast(top)).select("cluster", (F.log1p("n") / F.log1p("top")).alias("coverage"))


def source_signals(members: DataFrame, sources: DataFrame) -> DataFrame:
    """(cluster, prior, source_breadth) from members (cluster, id, source): mean source prior and log1p of distinct sources, min-maxed."""
    dim = sources.groupBy("source").agg(F.max("prior").alias("prior"))
    raw = members.join(dim, "source", "left").groupBy("cluster").agg(F.avg(F.coalesce("prior", F.lit(1.0))).alias("prior"), F.log1p(F.count_distinct("source").cast("double")).alias("source_breadth"))
    return minmax_all(raw, ["prior", "source_breadth"])


def recency(ages: DataFrame, fallback: str = "fresh") -> DataFrame:
    """(cluster, recency_decay) from (cluster, age_days): exp(-least age / 4), min-maxed. A cluster without ages counts as age 0, or
    with fallback 'median' as the median of the others."""
    raw = ages.groupBy("cluster").agg(F.min("age_days").alias("age"))
    if fallback == "median":
        mid = raw.agg(F.percentile("age", F.lit(0.5)).alias("mid"))
        raw = raw.crossJoin(F.broadcast(mid)).select("cluster", F.coalesce("age", "mid", F.lit(0.0)).alias("age"))
    return minmax_all(raw.select("cluster", F.exp(-F.coalesce("age", F.lit(0.0)) / 4).alias("recency_decay")), ["recency_decay"])


def entity_signal(counts: DataFrame, idf: DataFrame, default_idf: DataFrame, key_entities: DataFrame) -> DataFrame:
    """(cluster, entity_signal): sum of count x idf, twice for key entities, min-maxed; entities unknown to history get the default."""
    keys = key_entities.select("entity").distinct().withColumn("key", F.lit(2.0))
    j = counts.join(idf.select("entity", "idf"), "entity", "left").join(keys, "entity", "left").crossJoin(F.broadcast(default_idf.select(F.col("idf").alias("other"))))
    raw = j.groupBy("cluster").agg(F.sum(F.col("count") * F.coalesce("idf", "other") * F.coalesce("key", F.lit(1.0))).alias("entity_signal"))
    return minmax_all(raw, ["entity_signal"])


def trend(counts: DataFrame, velocity: DataFrame, top: int = 5) -> DataFrame:
    """(cluster, trend): mean velocity of the top entities by count, within [-1, 3], min-maxed."""
    w = Window.partitionBy("cluster").orderBy(F.desc("count"), "entity")
    best = counts.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= top).join(velocity, "entity", "left")
    raw = best.groupBy("cluster").agg(clip(F.avg(F.coalesce("velocity", F.lit(0.0))), -1.0, 3.0).alias("trend"))
    return minmax_all(raw, ["trend"])


def richness(labels: DataFrame, idf: DataFrame, default_idf: DataFrame, cohesion: DataFrame) -> DataFrame:
    """(cluster, richness): mean of label diversity / 6, facts (at most 3) / 3, mean idf over the largest, and the cohesion of the
    longest body. labels: (cluster, id, entity, label); cohesion: (cluster, cohesion)."""
    facts = F.least(F.count(F.when(F.col("label").isin("MONEY", "PERCENT", "DATE"), 1)), F.lit(3)) / 3
    j = labels.join(idf.select("entity", "idf"), "entity", "left").crossJoin(F.broadcast(default_idf.select(F.col("idf").alias("other"))))
    parts = j.groupBy("cluster").agg((F.least(F.count_distinct("label"), F.lit(6)) / 6).alias("kinds"), facts.alias("facts"), (F.avg(F.coalesce("idf", "other")) / F.max("other")).alias("rarity"))
    return cohesion.join(parts, "cluster", "left").select("cluster", ((F.coalesce("kinds", F.lit(0.0)) + F.coalesce("facts", F.lit(0.0)) + F.coalesce("rarity", F.lit(0.0)) + F.col("cohesion")) / 4).alias("richness"))


def persistence(matches: DataFrame, bank: DataFrame, week: str) -> DataFrame:
    """(cluster, persistence_rate, persistence) from matches (cluster, topic_id): weeks seen per week since the first, -1 without a
    match; persistence is the rate within [0, 1]."""
    span = F.greatest(weeks_between(F.lit(week), F.col("first_week")), F.lit(1))
    j = matches.join(bank, "topic_id", "left").withColumn("persistence_rate", F.coalesce(F.col("weeks_seen") / span, F.lit(-1.0)))
    return j.select("cluster", "persistence_rate", clip(F.col("persistence_rate"), 0.0, 1.0).alias("persistence"))


def aspect_coverage(scores: DataFrame) -> DataFrame:
    """(aspect, coverage) from (aspect, cluster, score): best score per aspect over the best of all; all 0 if that is 0."""
    best = scores.groupBy("aspect").agg(F.max("score").alias("best"))
    top = best.agg(F.max("best").alias("top"))
    return best.crossJoin(F.broadcast(top)).select("aspect", F.when(F.col("top") > 0, F.col("best") / F.col("top")).otherwise(0.0).alias("coverage"))


def coverage_gap(scores: DataFrame, debt: DataFrame) -> DataFrame:
    """(cluster, coverage_gap): debt of the cluster's best aspect, min-maxed if any is positive."""
    w = Window.partitionBy("cluster").orderBy(F.desc("score"), "aspect")
    best = scores.withColumn("n", F.row_number().over(w)).filter("n = 1").join(debt, "aspect", "left").select("cluster", F.coalesce("debt", F.lit(0.0)).alias("coverage_gap"))
    return minmax_all(best, ["coverage_gap"])


def exclusion(lexical: DataFrame, dense: DataFrame | None = None) -> DataFrame:
    """(cluster, profile_exclusion): best BM25 over exclusions over its maximum, plus the same of the dense lane, min-maxed."""
    lanes = [lexical] if dense is None else [lexical, dense]
    total = None
    for lane in lanes:
        best = lane.groupBy("cluster").agg(F.max("score").alias("s"))
        part = best.crossJoin(F.broadcast(best.agg(F.max("s").alias("top")))).select("cluster", F.when(F.col("top") > 0, F.col("s") / F.col("top")).otherwise(0.0).alias("s"))
        total = part if total is None else total.unionByName(part)
    return minmax_all(total.groupBy("cluster").agg(F.sum("s").alias("profile_exclusion")), ["profile_exclusion"])


def score(signals: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """signals with score, the weighted sum; missing and NaN signals count 0."""
    total = F.lit(0.0)
    for k, w in (weights or DEFAULT_WEIGHTS).items():
        total = total + F.coalesce(F.nanvl(F.col(k), F.lit(0.0)), F.lit(0.0)) * w
    return signals.withColumn("score", total)


def sector_majority(members: DataFrame, sources: DataFrame, order: DataFrame, default: str) -> DataFrame:
    """(cluster, sector): the sector most of a cluster's items come from; ties go to the lower order."""
    dim = sources.groupBy("source").agg(F.max("sector").alias("sector"))
    n = members.join(dim, "source", "left").withColumn("sector", F.coalesce("sector", F.lit(default))).groupBy("cluster", "sector").agg(F.count("*").alias("n")).join(order, "sector", "left")
    w = Window.partitionBy("cluster").orderBy(F.desc("n"), F.col("ord").asc_nulls_last(), "sector")
    return n.withColumn("k", F.row_number().over(w)).filter("k = 1").select("cluster", "sector")


def category(texts: DataFrame, cues: dict[str, list[str]], default: str) -> DataFrame:
    """(id, category) of texts (id, text): the category with most cue occurrences, the first listed on a tie, the default without any.

    The cues are configuration held in the plan.
    """
    from ..functions.text import hit_count

    hits = [(name, sum((hit_count(F.col("text"), c) for c in words), F.lit(0))) for name, words in cues.items()]
    best = F.array_max(F.array(*[F.struct(h.alias("n"), F.lit(-i).alias("o"), F.lit(name).alias("name")) for i, (name, h) in enumerate(hits)]))
    return texts.select("id", F.when(F.coalesce(best["n"], F.lit(0)) > 0, best["name"]).otherwise(default).alias("category"))
