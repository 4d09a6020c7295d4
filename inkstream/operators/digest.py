"""The digest's composition: edges, relevance, the scored clusters, and what a run writes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import bank as BK
from . import entities as E
from . import retrieve as R
from . import sentences as SN
from . import signals as S
from . import store as ST
from . import vectorize as V
from .cluster import medoids
from .longitudinal import coverage_debt


def two_lane_edges(items: DataFrame, augmented: float = 0.20, title: float = 0.40) -> DataFrame:
    """Distinct (a, b), a < b: pairs near in the augmented text or, in a vocabulary of its own, in the title alone.
    items: (id, title, text)."""
    lane = lambda text, t: V.cosine_pairs(V.tfidf(items.select("id", F.coalesce(text, F.lit("")).alias("text")), ["id"]), t).select("a", "b")
    return lane(F.col("text"), augmented).unionByName(lane(F.col("title"), title)).distinct()


def relevance(docs: DataFrame, heads: DataFrame, aspects: DataFrame, dense: DataFrame | None = None, profile: str | None = None, scores: DataFrame | None = None) -> DataFrame:
    """(cluster, relevance), min-maxed; scores, if given, are the aspects' BM25 scores (query_id, id, score). With aspects (query_id, text): fused ranks of the medoids over aspects and lanes; dense is
    (query_id, id, score). Without: BM25 of the medoids against the profile text. heads: (cluster, id)."""
    spark = docs.sparkSession
    queries = aspects if profile is None else spark.createDataFrame([(0, profile)], "query_id int, text string")
    ids = heads.select("id")
    lexical = (R.bm25(docs, queries) if scores is None or profile is not None else scores).join(ids, "id", "left_semi")
    if profile is not None:
        raw = lexical.groupBy("id").agg(F.max("score").alias("x"))
    else:
        lanes = [R.ranked(lexical)] + ([R.ranked(dense.join(ids, "id", "left_semi"))] if dense is not None else [])
        raw = R.rrf(lanes).groupBy("id").agg(F.sum("fused").alias("x"))
    all_heads = heads.join(raw, "id", "left").select("cluster", F.coalesce("x", F.lit(0.0)).alias("relevance"))
    return S.minmax_all(all_heads, ["relevance"])


def score_clusters(items: DataFrame, clusters: DataFrame, vectors: DataFrame, entities: DataFrame, hist: DataFrame, sources: DataFrame, aspects: DataFrame, exclusions: DataFrame, bank: DataFrame, topics: DataFrame, ledger: DataFrame, ages: DataFrame, week: str, key_entities: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row a cluster with its medoid, topic match, all signals and the score.

    items (id, source, text); clusters (id, cluster); vectors and topics unit vectors in long form; entities (id, entity, label); ages
    (id, age_days); aspects and exclusions (query_id, text).
    """
    heads = cut(medoids(vectors, clusters).select("cluster", "id"))
    members = clusters.join(items.select("id", "source"), "id")
    docs = items.select("id", "text")
    entities = cut(entities)
    counts = cut(entities.join(clusters, "id").groupBy("cluster", "entity").agg(F.count_distinct("id").alias("count")))
    total = counts.groupBy("entity").agg(F.sum("count").alias("count"))
    idf, other = E.idf(hist), E.default_idf(hist)
    head_vectors = vectors.join(heads, "id").select("cluster", "term", "weight")
    match = cut(BK.match_topics(head_vectors, topics))
    longest = items.join(clusters, "id").groupBy("cluster").agg(F.max_by(F.struct("id", "text"), F.struct(F.length("text"), "id")).alias("d")).select("cluster", F.col("d.id").alias("id"), F.col("d.text").alias("text"))
    cohesion = longest.select("cluster", "id").join(SN.cohesion(longest.select("id", "text")), "id").select("cluster", "cohesion")
    # aspects and exclusions are asked in one pass over the documents
    asked = aspects.select(F.struct(F.lit("a").alias("kind"), F.col("query_id").cast("string").alias("name")).alias("query_id"), "text").unionByName(exclusions.select(F.struct(F.lit("x").alias("kind"), F.col("query_id").cast("string").alias("name")).alias("query_id"), "text"))
    scores = cut(R.bm25(docs, asked).join(heads, "id").select("cluster", "id", "query_id.kind", F.col("query_id.name").alias("aspect"), "score"))
    per_aspect, shut = scores.filter("kind = 'a'").select("cluster", "id", "aspect", "score"), scores.filter("kind = 'x'").select("cluster", "score")
    debt = coverage_debt(ledger).withColumn("aspect", F.col("aspect").cast("string"))
    parts = [
        S.coverage(clusters.groupBy("cluster").agg(F.count("*").alias("n"))),
        S.source_signals(members, sources),
        BK.novelty(match, bank, week),
        relevance(docs, heads, aspects, scores=per_aspect.select(F.col("aspect").alias("query_id"), "id", "score")),
        S.entity_signal(counts, idf, other, key_entities),
        S.trend(counts, E.velocity(total, hist)),
        S.richness(entities.join(clusters, "id").select("cluster", "id", "entity", "label"), idf, other, cohesion),
        S.coverage_gap(per_aspect.select("cluster", "aspect", "score"), debt),
        S.exclusion(shut),
        S.persistence(match.select("cluster", "topic_id"), bank, week),
        S.recency(ages.join(clusters, "id").select("cluster", "age_days")),
    ]
    out = heads.withColumnRenamed("id", "medoid").join(match, "cluster", "left")
    for p in parts:
        out = out.join(cut(p), "cluster", "left")
    return S.score(out, weights)


def persist_signals(stored: DataFrame, scored: DataFrame, week: str) -> DataFrame:
    """cluster_signals with this week's rows: clusters with a topic only; missing signals 0, a missing persistence_rate -1. Several
    clusters of a topic leave the last."""
    names = [c for c in stored.columns if c not in ("week", "topic_id")]
    value: dict[str, Column] = {c: F.coalesce(c, F.lit(-1.0 if c == "persistence_rate" else 0.0)).alias(c) if c in scored.columns else F.lit(-1.0 if c == "persistence_rate" else 0.0).alias(c) for c in names}
    order = F.col("place") if "place" in scored.columns else F.lit(0)
    new = scored.filter("topic_id is not null").select(F.lit(week).alias("week"), F.col("topic_id").cast("bigint").alias("topic_id"), *[value[c] for c in names], order.alias("__seq"))
    return ST.upsert(stored.withColumn("__seq", F.lit(0)), new, ["week", "topic_id"], ["__seq", "score"]).drop("__seq")


def save_digest(clusters: DataFrame, vectors: DataFrame, week: str, summary: str, created_at: str) -> tuple[DataFrame, DataFrame]:
    """(digests row, digest_terms rows) of a week: the summary, and each selected cluster's mean vector in long form.
    clusters: (cluster_no, id)."""
    terms = vectors.join(clusters, "id").groupBy("cluster_no", "term").agg(F.sum("weight").alias("s"))
    size = clusters.groupBy("cluster_no").agg(F.count("*").alias("n"))
    mean = terms.join(size, "cluster_no").select(F.lit(week).alias("week"), "cluster_no", "term", (F.col("s") / F.col("n")).alias("weight"))
    spark = clusters.sparkSession
    return spark.createDataFrame([(week, summary)], "week string, summary string").withColumn("created_at", F.lit(created_at).cast("timestamp")), mean


def archive_links(digests: DataFrame, base: str, n: int = 8) -> DataFrame:
    """(week, url) of the latest weeks' pages."""
    return digests.select("week").distinct().orderBy(F.desc("week")).limit(n).select("week", F.concat(F.lit(base.rstrip("/") + "/"), F.col("week"), F.lit(".html")).alias("url"))
