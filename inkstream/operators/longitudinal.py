"""Weekly metrics over the state tables; each is one set-based query without a loop over weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weeks import weeks_between
from .ranking import average_ranks

COVERED, DEBT_DECAY, DEBT_WEEKS, RESURFACING = 0.4, 0.7, 6, 0.7


def coverage_debt(ledger: DataFrame) -> DataFrame:
    """(aspect, debt): sum of 0.7^age over the latest six weeks in which the aspect's coverage is under 0.4; a missing week counts 0."""
    weeks = ledger.select("week").distinct().orderBy(F.desc("week")).limit(DEBT_WEEKS).withColumn("age", F.row_number().over(Window.orderBy(F.desc("week"))) - 1)
    grid = ledger.select("aspect").distinct().crossJoin(F.broadcast(weeks))
    one = ledger.groupBy("week", "aspect").agg(F.max("coverage").alias("coverage"))
    j = grid.join(one, ["week", "aspect"], "left")
    return j.groupBy("aspect").agg(F.sum(F.when(F.coalesce("coverage", F.lit(0.0)) < COVERED, F.pow(F.lit(DEBT_DECAY), "age")).otherwise(0.0)).alias("debt"))


def debt_burndown(ledger: DataFrame, weeks: int = 12) -> DataFrame:
    """(week, debt): total debt as of each of the latest weeks, over all aspects seen until then."""
    one = ledger.groupBy("week", "aspect").agg(F.max("coverage").alias("coverage"))
    number = ledger.select("week").distinct().withColumn("no", F.row_number().over(Window.orderBy("week")))  # weeks: a few hundred rows
    asked = number.orderBy(F.desc("no")).limit(weeks).select(F.col("week").alias("at"), F.col("no").alias("at_no"))
    first = one.join(F.broadcast(number), "week").groupBy("aspect").agg(F.min("no").alias("since"))
    spans = F.broadcast(asked.join(number, (F.col("no") <= F.col("at_no")) & (F.col("no") > F.col("at_no") - DEBT_WEEKS)))
    grid = first.join(spans, F.col("since") <= F.col("at_no"))
    j = grid.join(one, ["week", "aspect"], "left")
    return j.groupBy(F.col("at").alias("week")).agg(F.sum(F.when(F.coalesce("coverage", F.lit(0.0)) < COVERED, F.pow(F.lit(DEBT_DECAY), F.col("at_no") - F.col("no"))).otherwise(0.0)).alias("debt"))


def completeness(ledger: DataFrame) -> DataFrame:
    """(week, completeness): share of aspects covered."""
    return ledger.groupBy("week").agg(F.avg((F.col("coverage") >= COVERED).cast("double")).alias("completeness"))


def gini(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., gini) of values that are not negative; 0 where all are 0. Ranks come from counts, so groups may be large."""
    v = df.filter(F.col(value).isNotNull())
    r = average_ranks(v, by, value)  # descending ranks: ascending is n + 1 - rank
    s = r.groupBy(*by).agg(F.max("n").alias("n"), F.sum(F.col(value) * F.col("n_ties")).alias("s"), F.sum((F.col("n") + 1 - F.col("rank")) * F.col(value) * F.col("n_ties")).alias("c"))
    return s.select(*by, F.when(F.col("s") == 0, 0.0).otherwise(2 * F.col("c") / (F.col("n") * F.col("s")) - (F.col("n") + 1) / F.col("n")).alias("gini"))


def balance(ledger: DataFrame) -> DataFrame:
    """(week, balance): 1 - Gini of the week's coverages."""
    return gini(ledger, ["week"], "coverage").select("week", (1 - F.col("gini")).alias("balance"))


def topic_maturity(bank: DataFrame, weeks: DataFrame) -> DataFrame:
    """(week, live, mean_weeks_seen, spawned): topics whose life spans the week, and those that began in it. weeks: (week), few rows."""
    j = F.broadcast(weeks.select("week").distinct()).join(bank, F.col("week").between(F.col("first_week"), F.col("last_week")))
    live = j.groupBy("week").agg(F.count("*").alias("live"), F.avg("weeks_seen").alias("mean_weeks_seen"))
    born = bank.groupBy(F.col("first_week").alias("week")).agg(F.count("*").alias("spawned"))
    zero = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return weeks.select("week").distinct().join(live, "week", "left").join(born, "week", "left").select("week", zero("live", 0), zero("mean_weeks_seen", 0.0), zero("spawned", 0))


def recurrence_mix(signals: DataFrame, bank: DataFrame) -> DataFrame:
    """(week, new, ongoing, resurfacing) shares: new without a topic or in its first week, resurfacing at a novelty of 0.7 or more."""
    j = signals.join(bank.select("topic_id", "first_week"), "topic_id", "left")
    kind = F.when(F.col("topic_id").isNull() | F.coalesce(F.col("first_week") == F.col("week"), F.lit(False)), "new").when(F.coalesce(F.nanvl(F.col("novelty"), F.lit(0.0)), F.lit(0.0)) >= RESURFACING, "resurfacing").otherwise("ongoing")
    share = lambda k: F.avg((F.col("kind") == k).cast("double")).alias(k)
    return j.withColumn("kind", kind).groupBy("week").agg(share("new"), share("ongoing"), share("resurfacing"))


def mean_by_week(signals: DataFrame, column: str, name: str) -> DataFrame:
    """(week, name): mean of the values that are neither NULL nor NaN."""
    return signals.groupBy("week").agg(F.avg(F.when(~F.isnan(column), F.col(column))).alias(name))


def vocabulary_growth(hist: DataFrame) -> DataFrame:
    """(week, total, rare, common, ratio): entities known by each week; rare in one week so far, common in max(2, half) of the weeks so
    far. The ratio is infinite with rare and no common ones, 0 with neither."""
    one = hist.select("entity", "week").distinct()
    number = hist.select("week").distinct().withColumn("no", F.row_number().over(Window.orderBy("week")))
    seen = one.join(F.broadcast(number), "week").withColumn("k", F.row_number().over(Window.partitionBy("entity").orderBy("no")))
    # an entity holds count k from its k-th week until the next one: spans joined to weeks, not weeks to all of history
    spans = seen.withColumn("until", F.coalesce(F.lead("no").over(Window.partitionBy("entity").orderBy("no")), F.lit(2**31)))
    per = spans.groupBy("no", "until", "k").agg(F.count("*").alias("n"))
    at = F.broadcast(number.select(F.col("week"), F.col("no").alias("at")))
    j = per.join(at, (F.col("no") <= F.col("at")) & (F.col("until") > F.col("at")))
    rare, common = F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("k") >= F.greatest(F.lit(2), F.ceil(F.col("at") / 2)), F.col("n")).otherwise(0))
    g = j.groupBy("week").agg(F.sum("n").alias("total"), rare.alias("rare"), common.alias("common"))
    return g.withColumn("ratio", F.when(F.col("common") > 0, F.col("rare") / F.col("common")).when(F.col("rare") > 0, F.lit(float("inf"))).otherwise(0.0))


def auc(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """(by..., auc): Mann-Whitney with averaged ties; NULL where a class is missing. Rows without a score are left out."""
    keys = by or ["__all"]
    d = df.withColumn("__all", F.lit(1)) if not by else df
    d = d.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
    ranks = average_ranks(d, keys, score).select(*keys, score, (F.col("n") + 1 - F.col("rank")).alias("up"))
    pos = d.groupBy(*keys, score).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count("*").alias("c"))
    s = pos.join(ranks, [*keys, score]).groupBy(*keys).agg(F.sum("p").alias("p"), F.sum(F.col("c") - F.col("p")).alias("q"), F.sum(F.col("up") * F.col("p")).alias("r"))
    out = s.select(*keys, F.when((F.col("p") > 0) & (F.col("q") > 0), (F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("q"))).alias("auc"))
    return out.drop("__all")


def persistence_auc(signals: DataFrame, weeks: DataFrame) -> DataFrame:
    """(week, auc): of score against recurrence in any later week, over the rows up to each of the given few weeks."""
    from .weights import one_per_topic, recurrence_labels

    rows = recurrence_labels(one_per_topic(signals.filter("topic_id is not null")))
    j = rows.select(F.col("week").alias("of"), "score", "recurs").join(F.broadcast(weeks.select("week").distinct()), F.col("of") <= F.col("week"))
    return auc(j, "score", "recurs", ["week"])


def bank_stats(bank: DataFrame, week: str, mature: int = 3, dormant: int = 4) -> DataFrame:
    """One row: topics, mean weeks seen, mature topics, dormant topics."""
    return bank.agg(
        F.count("*").alias("topics"), F.avg("weeks_seen").alias("mean_weeks_seen"), F.count_if(F.col("weeks_seen") >= mature).alias("mature"), F.count_if(weeks_between(F.lit(week), F.col("last_week")) >= dormant).alias("dormant")
    )


def mean_persistence(signals: DataFrame, null_aware: bool = False) -> DataFrame:
    """(week, persistence): mean rate; NULL counts 0 and the -1 of topics without match counts as a number, unless null_aware."""
    x = F.nanvl(F.col("persistence_rate"), F.lit(None).cast("double"))
    return signals.groupBy("week").agg(F.avg(F.when(x >= 0, x) if null_aware else F.coalesce(x, F.lit(0.0))).alias("persistence"))


def throughput(items: DataFrame, clusters: DataFrame) -> DataFrame:
    """(week, n_items, n_clusters) over the weeks of either (week)-table."""
    a, b = items.groupBy("week").agg(F.count("*").alias("n_items")), clusters.groupBy("week").agg(F.count("*").alias("n_clusters"))
    return a.join(b, "week", "full").select("week", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"))


def weights_history(weights: DataFrame) -> DataFrame:
    """(week, term, weight): the last stored map of each week, a row a term."""
    last = weights.filter("weights is not null").groupBy("week").agg(F.max_by("weights", "created_at").alias("weights"))
    return last.select("week", F.explode("weights").alias("term", "weight"))


def largest_drift(history: DataFrame, defaults: dict[str, float], top: int = 3) -> DataFrame:
    """(term, weight, drift): the terms whose latest weight is farthest from the default."""
    base = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])
    last = history.groupBy("term").agg(F.max_by("weight", "week").alias("weight"))
    return last.withColumn("drift", F.round(F.abs(F.col("weight") - base[F.col("term")]), 9)).filter("drift is not null").orderBy(F.desc("drift"), "term").limit(top)


def ledger_pivot(ledger: DataFrame, aspects: list[str]) -> DataFrame:
    """week and one column per aspect, 0 where it has none."""
    return ledger.groupBy("week").pivot("aspect", aspects).agg(F.max("coverage")).fillna(0.0)


def direction(series: DataFrame, by: list[str]) -> DataFrame:
    """(by..., direction): sign of last minus first value by week."""
    return series.groupBy(*by).agg(F.signum(F.max_by("value", "week") - F.min_by("value", "week")).alias("direction"))


def ema_label(x: Column) -> Column:
    """A number as it is shown: three decimals, inf for infinity."""
    return F.when(x == float("inf"), "inf").otherwise(F.format_string("%.3f", x))


def macro_due(summaries: DataFrame, macros: DataFrame, least: int = 4, use: int = 5, of: int = 8) -> DataFrame:
    """(week, summary): the latest summaries not in the last macro's weeks, `use` of them, or none if fewer than `least` are new."""
    latest = summaries.orderBy(F.desc("week")).limit(of)
    last = macros.orderBy(F.desc("created_at")).limit(1).select(F.explode("weeks").alias("week"))
    new = latest.join(last, "week", "left_anti")
    enough = new.agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return new.crossJoin(F.broadcast(enough.select())).orderBy(F.desc("week")).limit(use).select("week", "summary")


METRICS = {"coverage_completeness": completeness, "coverage_balance": balance, "debt_burndown": debt_burndown}
