"""Adaptive score weights."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .signals import DEFAULT_WEIGHTS

TUNED = ("coverage", "prior", "novelty", "relevance", "entity_signal", "trend", "richness", "coverage_gap")
RELEVANCE_FLOOR, BLEND_OLD, MIN_WEEKS = 0.20, 0.7, 10


def enforce_floor(weights: dict[str, float], floor: float = RELEVANCE_FLOOR) -> dict[str, float]:
    """Weights with a relevance of at least `floor`, the rest scaled to a sum of 1; the defaults if nothing is left to scale."""
    if weights.get("relevance", 0.0) >= floor:
        total = sum(weights.values())
        return {k: w / total for k, w in weights.items()} if total > 0 and abs(total - 1) > 1e-12 else dict(weights)
    rest = sum(w for k, w in weights.items() if k != "relevance")
    if rest <= 0:
        return dict(DEFAULT_WEIGHTS)
    return {k: floor if k == "relevance" else w * (1 - floor) / rest for k, w in weights.items()}


def floored(weights: DataFrame, floor: float = RELEVANCE_FLOOR) -> DataFrame:
    """(week, term, weight) with the floor applied per week, as enforce_floor does for weights that sum to 1."""
    w = Window.partitionBy("week")
    rel = F.max(F.when(F.col("term") == "relevance", F.col("weight"))).over(w)
    rest = F.sum(F.when(F.col("term") != "relevance", F.col("weight"))).over(w)
    total = F.sum("weight").over(w)
    low = F.coalesce(rel, F.lit(0.0)) < floor
    return weights.withColumn("weight", F.when(~low, F.col("weight") / total).when(F.col("term") == "relevance", F.lit(floor)).otherwise(F.col("weight") * (1 - floor) / rest))


def latest_weights(stored: DataFrame) -> dict[str, float]:
    """The newest stored map with missing terms from the defaults; the defaults if there is none. One row comes to the driver."""
    row = stored.filter("weights is not null").orderBy(F.desc("week"), F.desc("created_at")).limit(1).collect()
    return DEFAULT_WEIGHTS | {k: v for k, v in (row[0]["weights"] if row else {}).items() if k in DEFAULT_WEIGHTS and v is not None}


def one_per_topic(signals: DataFrame) -> DataFrame:
    """One row a week and topic: that with the greatest score, then the greatest coverage."""
    w = Window.partitionBy("week", "topic_id").orderBy(F.desc_nulls_last("score"), F.desc_nulls_last("coverage"), F.desc_nulls_last("relevance"))
    return signals.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def recurrence_labels(signals: DataFrame) -> DataFrame:
    """signals with `recurs`: whether the topic has a later week. Rows of the last week are never labelled as recurring."""
    return signals.withColumn("recurs", (F.max("week").over(Window.partitionBy("topic_id")) > F.col("week")).cast("int"))


def tune(signals: DataFrame, current: dict[str, float], c: float = 1.0) -> dict[str, float] | None:
    """New weights, or None where history is too short, labels are of one class, or no coefficient is positive.

    A logistic regression of the recurrence label on the eight tuned signals; its positive coefficients, in proportion, take the
    tuned terms' share in 0.3 of the blend; the other terms stay. Training runs in the cluster; ten numbers come back.
    """
    rows = recurrence_labels(one_per_topic(signals.filter("topic_id is not null")))
    clean = [F.coalesce(F.nanvl(F.col(s), F.lit(0.0)), F.lit(0.0)).alias(s) for s in TUNED]
    data = rows.select("week", F.col("recurs").cast("double").alias("label"), *clean)
    stat = data.agg(F.count_distinct("week").alias("w"), F.count_distinct("label").alias("l"), F.count("*").alias("n")).collect()[0]
    if stat["w"] < MIN_WEEKS or stat["l"] < 2:
        return None
    x = VectorAssembler(inputCols=list(TUNED), outputCol="features").transform(data)
    model = LogisticRegression(regParam=1.0 / (c * stat["n"]), elasticNetParam=0.0, standardization=False, maxIter=500).fit(x)
    coef = {k: max(0.0, float(v)) for k, v in zip(TUNED, model.coefficients.toArray(), strict=True)}
    if sum(coef.values()) <= 0:
        return None
    share = sum(current[k] for k in TUNED)
    learned = {k: v * share / sum(coef.values()) for k, v in coef.items()}
    new = {k: BLEND_OLD * w + (1 - BLEND_OLD) * learned.get(k, w) for k, w in current.items()}
    total = sum(new.values())
    return enforce_floor({k: w / total for k, w in new.items()})
