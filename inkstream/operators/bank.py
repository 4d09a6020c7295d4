"""The topic bank: match, blend, spawn, decay, prune."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weeks import weeks_between
from .ranking import numbered

ALPHA, MATCH, DECAY, MASS_FLOOR, STALE_WEEKS, TOP_TERMS, DORMANT = 0.7, 0.3, 0.8, 0.05, 12, 200, 4


def match_topics(clusters: DataFrame, topics: DataFrame) -> DataFrame:
    """(cluster, topic_id, sim): each cluster's best topic by cosine of unit vectors (cluster|topic_id, term, weight); least id on a tie.
    A cluster that shares no term with any topic gets the least topic id at 0, as an argmax over zeros does."""
    sims = clusters.join(topics.withColumnRenamed("weight", "tw"), "term").groupBy("cluster", "topic_id").agg(F.round(F.sum(F.col("weight") * F.col("tw")), 9).alias("sim"))
    w = Window.partitionBy("cluster").orderBy(F.desc("sim"), "topic_id")
    best = sims.withColumn("n", F.row_number().over(w)).filter("n = 1 and sim > 0").drop("n")
    first = topics.agg(F.min("topic_id").alias("first")).filter("first is not null")
    every = clusters.select("cluster").distinct().crossJoin(F.broadcast(first))
    return every.join(best, "cluster", "left").select("cluster", F.coalesce("topic_id", "first").alias("topic_id"), F.coalesce("sim", F.lit(0.0)).alias("sim"))


def novelty(matches: DataFrame, bank: DataFrame, week: str) -> DataFrame:
    """(cluster, novelty): 1 - similarity, 0.3 more for a topic asleep DORMANT weeks or longer, within [0, 1]; 1 without a match."""
    j = matches.join(bank.select("topic_id", "last_week"), "topic_id", "left")
    asleep = F.when(weeks_between(F.lit(week), F.col("last_week")) >= DORMANT, 0.3).otherwise(0.0)
    return j.select("cluster", F.when(F.col("topic_id").isNull(), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("sim") + asleep))).alias("novelty"))


def truncate(terms: DataFrame, by: str = "topic_id", top: int = TOP_TERMS) -> DataFrame:
    """Vectors of more than `top` terms keep the largest by |weight| and are normalised anew; others stay as they are."""
    w = Window.partitionBy(by)
    t = terms.withColumn("n", F.count("*").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc(F.abs("weight")), "term"))).filter((F.col("n") <= top) | (F.col("k") <= top))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(w))
    return t.withColumn("weight", F.when(F.col("n") > top, F.col("weight") / norm).otherwise(F.col("weight"))).select(by, "term", "weight")


def blend(old: DataFrame, new: DataFrame, vocabulary: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(topic_id, term, weight): alpha x old over the current vocabulary + (1 - alpha) x new; a topic none of whose terms is in the
    vocabulary takes the new vector. Both sides are (topic_id, term, weight); only topics of `new` come out."""
    from .vectorize import project

    kept = project(old, vocabulary, "topic_id").withColumnRenamed("weight", "o")
    has = kept.select("topic_id").distinct().withColumn("has", F.lit(True))
    j = kept.join(new.select("topic_id").distinct(), "topic_id", "left_semi").join(new.withColumnRenamed("weight", "w"), ["topic_id", "term"], "full").join(has, "topic_id", "left")
    mixed = alpha * F.coalesce("o", F.lit(0.0)) + (1 - alpha) * F.coalesce("w", F.lit(0.0))
    return j.select("topic_id", "term", F.when(F.col("has"), mixed).otherwise(F.coalesce("w", F.lit(0.0))).alias("weight"))


def blend_in_order(old: DataFrame, matched: DataFrame, vocabulary: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """As blend, where several clusters may match a topic: matched (topic_id, place, term, weight) are blended one after the other in
    order of place. The repeated blend of a term is a weighted sum: alpha^k x old + sum of (1 - alpha) alpha^(k - j) x new_j."""
    from .vectorize import project

    places = matched.select("topic_id", "place").distinct().withColumn("j", F.row_number().over(Window.partitionBy("topic_id").orderBy("place"))).withColumn("k", F.count("*").over(Window.partitionBy("topic_id")))
    kept = project(old, vocabulary, "topic_id").withColumnRenamed("weight", "o")
    has = kept.select("topic_id").distinct().withColumn("has", F.lit(True))
    m = matched.join(places, ["topic_id", "place"]).join(has, "topic_id", "left")
    # without an old vector the first cluster's stands for it
    share = F.when(F.col("has") | (F.col("j") > 1), (1 - alpha) * F.pow(F.lit(alpha), F.col("k") - F.col("j"))).otherwise(F.pow(F.lit(alpha), F.col("k") - 1))
    new = m.groupBy("topic_id", "term").agg(F.sum(F.col("weight") * share).alias("w"))
    old_part = kept.join(places.select("topic_id", "k").distinct(), "topic_id").select("topic_id", "term", (F.col("o") * F.pow(F.lit(alpha), "k")).alias("o"))
    return old_part.join(new, ["topic_id", "term"], "full").select("topic_id", "term", (F.coalesce("o", F.lit(0.0)) + F.coalesce("w", F.lit(0.0))).alias("weight"))


def commit(bank: DataFrame, matches: DataFrame, week: str, threshold: float = MATCH) -> tuple[DataFrame, DataFrame]:
    """(bank after the week's clusters, (cluster, topic_id)): matches (cluster, place, topic_id, sim) at or above the threshold add 1 to
    mass and weeks_seen per cluster and set last_week; the others become new topics, numbered on in order of place."""
    hit = matches.filter((F.col("sim") >= threshold) & F.col("topic_id").isNotNull())
    bumps = hit.groupBy("topic_id").agg(F.count("*").alias("n"))
    kept = bank.join(bumps, "topic_id", "left").select(
        "topic_id", (F.col("mass") + F.coalesce("n", F.lit(0))).alias("mass"), "first_week", F.when(F.col("n") > 0, week).otherwise(F.col("last_week")).alias("last_week"), (F.col("weeks_seen") + F.coalesce("n", F.lit(0))).alias("weeks_seen")
    )
    top = bank.agg(F.coalesce(F.max("topic_id"), F.lit(0)).alias("top"))
    fresh = matches.join(hit.select("cluster"), "cluster", "left_anti")
    fresh = numbered(fresh, [F.col("place"), F.col("cluster")], "n")
    fresh = fresh.crossJoin(F.broadcast(top)).select("cluster", (F.col("top") + F.col("n")).alias("topic_id"))
    spawned = fresh.select("topic_id", F.lit(1.0).alias("mass"), F.lit(week).alias("first_week"), F.lit(week).alias("last_week"), F.lit(1).cast("bigint").alias("weeks_seen"))
    return kept.unionByName(spawned), hit.select("cluster", "topic_id").unionByName(fresh)


def decay_and_prune(bank: DataFrame, week: str) -> DataFrame:
    """Mass times DECAY for all; topics unseen for more than STALE_WEEKS weeks, then those under MASS_FLOOR, are dropped."""
    return bank.withColumn("mass", F.col("mass") * DECAY).filter((weeks_between(F.lit(week), F.col("last_week")) <= STALE_WEEKS) & (F.col("mass") >= MASS_FLOOR))


def topic_labels(terms: DataFrame, k: int = 3) -> DataFrame:
    """(topic_id, label): the top terms that are no entities, joined; topic#id without any."""
    w = Window.partitionBy("topic_id").orderBy(F.desc("weight"), "term")
    best = terms.filter(~F.col("term").startswith("ent_")).withColumn("k", F.row_number().over(w)).filter(F.col("k") <= k)
    named = best.groupBy("topic_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "term"))), lambda x: x["term"]), " · ").alias("label"))
    return terms.select("topic_id").distinct().join(named, "topic_id", "left").select("topic_id", F.coalesce("label", F.concat(F.lit("topic#"), F.col("topic_id").cast("string"))).alias("label"))
