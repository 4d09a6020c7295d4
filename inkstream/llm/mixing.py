"""Sources mixed to target weights.

Method: temperature mixing. The mixture's weights are w_i ~ t_i * (s_i / t_i)^a with target shares t, available token shares s and an
exponent a from 0 (the targets) to 1 (the sources as they are). For a token budget, the exponent is bisected to the least one
whose weights no source's repetition limit forbids (or to a wanted entropy); the weights are then realised as a budgeted
permutation: each source's documents, in a seeded random order that starts anew with every repeat, are taken until the running
token count reaches the source's budget. Without a budget, the largest one is taken that the targets themselves allow, so that the
exponent is 0 and shares differ from the targets by less than a document per source.

Sizes are tokens of a public tokenizer, whose file is a parameter. Sums run in two steps over hashed blocks of a source, so a hot
source is never sorted in one task.

Defined results: NULL texts and ids are left out, empty texts have 0 tokens and are taken like others; repeated rows of a document
count once; a source without a target, or a NULL source, is given share 0; a target without documents is reported with 0 and its
share falls to the others; a NULL or negative limit means none may be used. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut

#: Documents that a block of a source's permutation holds in the mean; a block is ordered in one task.
BLOCK_DOCS = 20_000
_ENCODERS: dict[str, object] = {}


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(vocabulary file, pattern) of one of the public tokenizers, where their package is installed; else callers name their own."""
    import public_tokenizers

    return str(public_tokenizers.path(name)), public_tokenizers.PATTERN


def _encoder(path: str, pattern: str):
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(docs: DataFrame, path: str | None = None, pattern: str | None = None, ident: str = "doc_id") -> DataFrame:
    """(ident, source, n_tokens), one row per document; path and pattern: a byte-pair vocabulary file and its word pattern."""
    if path is None or pattern is None:
        path, pattern = tokenizer()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path, pattern)
        for b in batches:
            yield pd.DataFrame({ident: b[ident], "source": b["source"], "n_tokens": np.array([len(enc.encode_ordinary(t)) for t in b["text"]], np.int64)})

    rows = docs.filter(F.col("text").isNotNull() & F.col(ident).isNotNull()).select(F.col(ident).cast("bigint").alias(ident), "source", "text")
    return rows.mapInPandas(count, f"{ident} bigint, source string, n_tokens bigint").groupBy(ident).agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens"))


def entropy(w: np.ndarray) -> float:
    w = w[w > 0]
    return float(-(w * np.log(w)).sum())


def mixture(tokens: dict[str, int], targets: dict[str, tuple[float, int]], budget: int | None = None, want_entropy: float | None = None) -> tuple[dict[str, float], float, int]:
    """(weights, exponent, budget) over the sources that have both tokens and a target; these are as many as there are sources."""
    names = sorted(k for k, n in tokens.items() if n > 0 and k in targets and (targets[k][0] or 0) > 0 and (targets[k][1] or 0) > 0)
    if not names:
        return {}, 0.0, 0
    s = np.array([tokens[k] for k in names], float)
    t = np.array([targets[k][0] for k in names], float)
    reach = s * np.array([targets[k][1] for k in names], float)
    t, share = t / t.sum(), s / s.sum()

    def weights(a: float) -> np.ndarray:
        w = np.exp((1 - a) * np.log(t) + a * np.log(share))
        return w / w.sum()

    if budget is None:
        budget = math.floor((reach / t).min())
    lo, hi = 0.0, 1.0
    fits = lambda a: bool((weights(a) * budget <= reach * (1 + 1e-9)).all()) if want_entropy is None else entropy(weights(a)) <= want_entropy
    if fits(0.0):
        hi = 0.0
    else:
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    w = np.minimum(weights(hi), reach / budget)  # where even the natural shares exceed a limit, the limit holds
    return dict(zip(names, w.tolist(), strict=True)), hi, budget


def chosen(counts: DataFrame, targets: DataFrame, budget: int | None = None, want_entropy: float | None = None, stretch: float | None = None, seed: int = 7, ident: str = "doc_id") -> DataFrame:
    """(ident, source, n_tokens, repeats): documents used at least once; counts should be a checkpoint. stretch: a budget of so many
    times the largest one that the targets themselves allow; over 1, the exponent moves as far as the repetition limits demand."""
    spark = counts.sparkSession
    # one row per configured source: as many as the configuration lists
    have = counts.filter("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("d")).join(targets.select("source").distinct(), "source", "left_semi").collect()
    totals, blocks = {r["source"]: r["n"] for r in have}, {r["source"]: 1 + r["d"] // BLOCK_DOCS for r in have}
    limits = {r["source"]: (r["t"], r["m"]) for r in targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("t"), F.max("max_repeats").alias("m")).collect()}
    if stretch is not None:
        budget = int(stretch * mixture(totals, limits)[2])
    weights, _, budget = mixture(totals, limits, budget, want_entropy)
    goal = spark.createDataFrame([(k, int(round(w * budget)), int(totals[k]), blocks[k]) for k, w in weights.items()], "source string, goal bigint, total bigint, blocks bigint")
    rows = counts.join(broadcast_if_small(goal), "source")
    # every document is used `full` times; the rest of the goal is met by the head of one more permutation
    rows = rows.withColumn("full", F.floor(F.col("goal") / F.col("total"))).withColumn("rest", F.col("goal") - F.col("full") * F.col("total"))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), F.col(ident))).withColumn("block", F.pmod("key", "blocks"))
    sums = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_block").over(before), F.lit(0))).drop("in_block")
    inner = Window.partitionBy("source", "block").orderBy("key", ident).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(broadcast_if_small(sums), ["source", "block"]).withColumn("start", F.col("ahead") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    # the document that the goal falls into is taken if that leaves less than its half too much
    extra = F.when(F.col("start") + F.col("n_tokens") / 2 <= F.col("rest"), 1).otherwise(0)
    return placed.select(ident, "source", "n_tokens", (F.col("full") + F.when(F.col("rest") > 0, extra).otherwise(0)).cast("bigint").alias("repeats")).filter("repeats > 0")


def mix(docs: DataFrame, targets: DataFrame, path: str | None = None, pattern: str | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """(chosen documents with their repeats, shares reached per source)."""
    counts = cut(token_counts(docs, path, pattern))
    picked = cut(chosen(counts, targets, **how))
    used = picked.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("n_docs"), F.max("repeats").alias("most_repeats"))
    have = counts.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    aim = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    all_of = have.join(aim, "source", "full").join(used, "source", "left").select("source", "target_share", "max_repeats", *map(zero, ("available", "n_docs", "tokens", "most_repeats")))
    total = all_of.agg(F.sum("tokens").alias("all_tokens"))
    shares = all_of.crossJoin(F.broadcast(total)).withColumn("share", F.round(F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0), 9)).drop("all_tokens")
    return picked, shares
