"""Selection of a diverse top set. MMR runs over the scored clusters of one digest, whose number is checked."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Candidates that a sequential step takes: what one digest can rank. More are an error, never cut off silently.
MAX_CANDIDATES = 20_000


def off_profile(clusters: DataFrame, floor: float = 0.12) -> DataFrame:
    """Clusters that stay: dropped are those with any exclusion and a relevance under the floor."""
    return clusters.filter(~((F.coalesce("profile_exclusion", F.lit(0.0)) > 0) & (F.coalesce("relevance", F.lit(0.0)) < floor)))


def _checked(df: DataFrame) -> DataFrame:
    n = df.limit(MAX_CANDIDATES + 1).count()
    if n > MAX_CANDIDATES:
        raise ValueError(f"over {MAX_CANDIDATES} candidates in one selection")
    return df


def mmr_order(candidates: DataFrame, lam: float = 0.65, k: int | None = None) -> DataFrame:
    """(cluster, score, place): maximal marginal relevance over (cluster, score, vec), starting at the best score.

    Each step takes the greatest lam * score - (1 - lam) * largest cosine to those taken; ties go to the better score, then the id.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "cluster"], ascending=[False, True]).reset_index(drop=True)
        x = np.array(pdf["vec"].tolist(), float)
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        left, near, order = np.ones(len(pdf), bool), np.zeros(len(pdf)), []
        for step in range(len(pdf) if k is None else min(k, len(pdf))):
            gain = np.where(left, lam * pdf["score"].to_numpy(float) - (1 - lam) * near, -np.inf) if step else np.where(np.arange(len(pdf)) == 0, 0.0, -np.inf)
            i = int(np.argmax(gain))
            order.append(i)
            left[i] = False
            sim = x @ x[i]
            near = sim if step == 0 else np.maximum(near, sim)
        return pdf.loc[order, ["cluster", "score"]].assign(place=np.arange(1, len(order) + 1))

    kind = candidates.schema["cluster"].dataType.simpleString()
    return _checked(candidates.select("cluster", F.col("score").cast("double").alias("score"), "vec")).groupBy().applyInPandas(run, f"cluster {kind}, score double, place bigint")


def knee(ordered: DataFrame, least: int = 8, most: int = 40) -> DataFrame:
    """One row (cut): after which place the scores of an ordered list (place from 1, score) fall most, smoothed by 1/4, 1/2, 1/4, within
    [least, most] and the list's length. Neighbours meet by a join on their places, so the list may be of any length."""
    at = lambda df, shift, value, name: df.select((F.col("place") + shift).alias("place"), F.col(value).alias(name))
    d = ordered.select("place", "score").join(at(ordered, -1, "score", "__next"), "place").select("place", (F.col("score") - F.col("__next")).alias("drop"))
    n = d.agg(F.count("*").alias("n"))
    s = d.join(at(d, 1, "drop", "__before"), "place", "left").join(at(d, -1, "drop", "__after"), "place", "left").crossJoin(F.broadcast(n))
    smooth = F.coalesce("__before", F.lit(0.0)) * 0.25 + F.col("drop") * 0.5 + F.coalesce("__after", F.lit(0.0)) * 0.25
    best = s.withColumn("v", F.round(F.when(F.col("n") >= 3, smooth).otherwise(F.col("drop")), 12)).agg(F.max_by("place", F.struct("v", -F.col("place"))).alias("at"))
    total = ordered.agg(F.count("*").alias("total"))
    return best.crossJoin(total).select(F.least(F.greatest(F.coalesce("at", F.lit(0)), F.lit(least)), F.lit(most), F.col("total")).cast("bigint").alias("cut"))


def mmr_dynamic(candidates: DataFrame, lam: float = 0.65, least: int = 8, most: int = 40, keep_relevance: float = 0.15) -> DataFrame:
    """(cluster, score, place): the MMR order up to its knee, and any of the first `most` with enough relevance."""
    order = mmr_order(candidates, lam).join(candidates.select("cluster", "relevance"), "cluster")
    at = knee(order, least, most)
    return order.crossJoin(F.broadcast(at)).filter((F.col("place") <= F.col("cut")) | ((F.col("place") <= most) & (F.col("relevance") >= keep_relevance))).select("cluster", "score", "place")


def greedy_dedup(items: DataFrame) -> DataFrame:
    """Kept (cluster, id) of (cluster, place, pos, id, url, signature): in order of place and pos an item stays if its URL is unseen
    and its signature is empty or unseen among the items kept so far; only kept items count as seen.

    Decided in rounds: an undecided item that comes first at its URL and at its signature stays, and shuts out all that share one of
    them. Nothing before it can matter any more, so this gives the rows of the ordered scan, and no task meets more than a key's rows.
    """

    order = [F.col(c).asc_nulls_last() for c in ("place", "pos", "id", "cluster", "url", "signature")]
    rows = items.select("cluster", "place", "pos", "id", "url", "signature").distinct().orderBy(*order)
    rows = cut(rows.select("cluster", "id", "url", "signature", F.monotonically_increasing_id().alias("n")))
    own = F.array(F.coalesce(F.concat(F.lit("u"), "url"), F.lit("-")), F.when(F.col("signature") != "", F.concat(F.lit("s"), "signature")))
    left = cut(rows.select("n", F.explode(own).alias("key")).filter("key is not null"))
    kept = left.select("n").limit(0)
    while True:
        first = left.groupBy("key").agg(F.min("n").alias("first"))
        won = cut(left.join(first, "key").groupBy("n").agg(F.every(F.col("n") == F.col("first")).alias("ok")).filter("ok").select("n"))
        if won.limit(1).count() == 0:
            break
        kept = cut(kept.unionByName(won))
        # the kept items' own rows hold their keys, so they leave with those they shut out
        decided = left.join(left.join(won, "n", "left_semi").select("key"), "key", "left_semi").select("n").distinct()
        left = cut(left.join(decided, "n", "left_anti"))
    return rows.join(kept, "n", "left_semi").select("cluster", "id")


def distinct_links(items: DataFrame, cap: int = 5) -> DataFrame:
    """First item of each URL in a cluster, in order, at most `cap` a cluster: (cluster, pos, url, link_no)."""
    first = items.withColumn("n", F.row_number().over(Window.partitionBy("cluster", "url").orderBy("pos", "id"))).filter("n = 1")
    no = F.row_number().over(Window.partitionBy("cluster").orderBy("pos", "id"))
    return first.withColumn("link_no", no).filter(F.col("link_no") <= cap).select("cluster", "pos", "url", "link_no")
