"""One ranking per group from scores on different scales: weighted Borda count.

Each score gives competition ranks with averaged ties among the members that have it, turned into points from 1 (best) to 0
(worst) whatever the numbers' range; a missing score gets the mid-rank, 0.5. Weighted points are added, and the sum is sorted
with the identifier as tie-break.

Defined results: NULL and NaN count as missing, as do the `missing` sentinels given per score; infinite values rank as extremes;
a score that one member alone has gives it 0.5. Repeated rows of an identifier count once: the row with the greatest scores,
compared from the first score on. Members of a NULL group are ranked among themselves. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import average_ranks
from ..session import cut

SIGNALS = ("coverage", "prior", "novelty", "relevance", "entity_signal", "trend", "richness", "coverage_gap", "profile_exclusion", "persistence_rate", "persistence", "source_breadth", "recency_decay")
#: A topic without match carries -1 in persistence_rate.
MISSING = {"persistence_rate": -1.0}
#: A larger profile_exclusion is worse.
LOWER_IS_BETTER = ("profile_exclusion",)


def _sum(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def borda(df: DataFrame, group: str, ident: str, scores=SIGNALS, weights: dict[str, float] | None = None, missing: dict[str, float] = MISSING, lower: tuple[str, ...] = LOWER_IS_BETTER) -> DataFrame:
    """(group, ident, points_<score>..., points, place); weights default to 1 each, a weight of 0 leaves a score out."""
    weights = {s: float((weights or {}).get(s, 1.0)) for s in scores}

    def clean(s: str) -> Column:
        x = F.col(s).cast("double")
        x = F.when(F.isnan(x) | (x == F.lit(missing[s]) if s in missing else F.lit(False)), None).otherwise(x)
        return (-x if s in lower else x).alias(s)

    one = df.select(F.col(group), F.col(ident), *[clean(s) for s in scores]).groupBy(group, ident).agg(F.max(F.struct(*scores)).alias("s")).select(group, ident, "s.*")
    one = cut(one)
    key = F.coalesce(F.col(group).cast("string"), F.lit("\u0000none")).alias("__g")
    long = one.select(key, F.explode(F.array(*[F.struct(F.lit(s).alias("__score"), F.col(s).alias("__value")) for s in scores])).alias("v")).select("__g", "v.*").filter("__value is not null")
    ranks = average_ranks(long, ["__g", "__score"], "__value")
    point = F.when(F.col("n") > 1, (F.col("n") - F.col("rank")) / (F.col("n") - 1)).otherwise(F.lit(0.5))
    ranks = ranks.select("__g", "__score", "__value", point.alias("__pt"))
    each = one.select(group, ident, key, F.explode(F.array(*[F.struct(F.lit(s).alias("__score"), F.col(s).alias("__value")) for s in scores])).alias("v")).select(group, ident, "__g", "v.*")
    points = each.join(ranks, ["__g", "__score", "__value"], "left").groupBy(group, ident, "__g").agg(
        *[F.coalesce(F.max(F.when(F.col("__score") == s, F.col("__pt"))), F.lit(0.5)).alias(f"points_{s}") for s in scores]
    )
    points = cut(points.withColumn("points", F.round(_sum([F.col(f"points_{s}") * weights[s] for s in scores]), 9)))  # ranked and numbered below
    place = average_ranks(points.select("__g", "points"), ["__g"], "points")
    # ties by identifier within equal sums: a window over one sum's members only
    tie = F.row_number().over(Window.partitionBy("__g", "points").orderBy(ident))
    placed = points.join(place.select("__g", "points", (F.col("rank") - (F.col("n_ties") + 1) / 2).alias("__first")), ["__g", "points"])
    return placed.select(group, ident, *[f"points_{s}" for s in scores], "points", (F.col("__first") + tie).cast("bigint").alias("place"))
