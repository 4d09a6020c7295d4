"""Average-linkage clustering in rounds, and medoids."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .graph import components
from .ranking import numbered

#: Numbers in a block of vectors: 2 MB of doubles.
BLOCK_VALUES = 262_144


def average_linkage(ids: DataFrame, sims: DataFrame, min_sim: float = 0.2) -> DataFrame:
    """(id, cluster): exact average linkage cut where the mean similarity of two clusters falls below min_sim.

    ids: (id); sims: (a, b, sim), a < b, every pair of positive similarity that may count; absent pairs are 0. Clusters that are
    each other's nearest neighbours merge in every round, which for average linkage gives the same tree as merging one pair at a
    time. Cluster pairs carry the sum of their similarities, so a merge adds sums; no matrix is ever built. Nearest ties go to the
    pair of the greater hash, in one order for all, so that chains of ties merge in few rounds. A cluster is named by its least id; documents without neighbours are clusters of their own.
    """
    of = cut(ids.select("id", F.col("id").alias("cluster")).distinct())
    pairs = cut(sims.filter("sim > 0").select("a", "b", F.col("sim").alias("s")))
    size = cut(of.groupBy("cluster").agg(F.count("*").alias("n")))
    while True:  # every round merges a pair or ends
        mean = pairs.join(size.select(F.col("cluster").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("cluster").alias("b"), F.col("n").alias("nb")), "b")
        mean = mean.withColumn("m", F.round(F.col("s") / (F.col("na") * F.col("nb")), 12)).filter(F.col("m") >= min_sim)
        both = mean.select("a", "b", "m").unionByName(mean.select(F.col("b").alias("a"), F.col("a").alias("b"), "m"))
        rank = F.struct(F.col("m"), -F.hash(F.least("a", "b"), F.greatest("a", "b")), F.least("a", "b"), F.greatest("a", "b"))
        best = both.groupBy("a").agg(F.max_by("b", rank).alias("b"))
        merge = cut(best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]).filter("a < b"))
        if merge.limit(1).count() == 0:
            break
        into = merge.select(F.col("b").alias("old"), F.col("a").alias("new"))
        of = cut(of.join(into, of["cluster"] == into["old"], "left").select("id", F.coalesce("new", "cluster").alias("cluster")))
        size = cut(of.groupBy("cluster").agg(F.count("*").alias("n")))
        moved = pairs.join(into.select(F.col("old").alias("a"), F.col("new").alias("xa")), "a", "left").join(into.select(F.col("old").alias("b"), F.col("new").alias("xb")), "b", "left")
        moved = moved.select(F.coalesce("xa", "a").alias("a"), F.coalesce("xb", "b").alias("b"), "s").filter("a <> b")
        pairs = cut(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")))
    return of


def cluster_documents(vectors: DataFrame, edges: DataFrame, ids: DataFrame, min_sim: float) -> DataFrame:
    """(id, cluster): average linkage of L2-normalised vectors. Clusters never leave the components of the graph of pairs of min_sim
    or more (a mean reaches min_sim only if a pair does), so similarities are needed within components alone."""
    parts = cut(components(edges))
    inside = vectors.join(parts.select(F.col("node").alias("id"), "component"), "id")
    left, right = inside.select(F.col("id").alias("a"), "component", "term", F.col("weight").alias("wa")), inside.select(F.col("id").alias("b"), "component", "term", F.col("weight").alias("wb"))
    sims = left.join(right, ["component", "term"]).filter("a < b").groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))
    return average_linkage(ids, sims, min_sim)


def _nearest(ka: np.ndarray, a: np.ndarray, kb: np.ndarray, b: np.ndarray, min_sim: float, same: bool) -> tuple[np.ndarray, ...]:
    """(k, other, m, h): of each row of a the nearest of b and of each row of b the nearest of a, from min_sim on, by m and then the
    pair's hash h. A pair is valued once for both of its sides, so both see one order; same: a is b, with k ascending."""
    got = []
    for lo in range(0, len(a), 512):
        m = a[lo : lo + 512] @ b.T
        if same:
            m[np.arange(len(b)) <= np.arange(lo, lo + len(m))[:, None]] = -np.inf
        r, c = np.nonzero(m >= np.maximum(np.minimum(m.max(1)[:, None], m.max(0)), min_sim) - 1e-11)  # more than rounding can part
        x, y, s = ka[lo + r], kb[c], np.round(m[r, c], 12)
        h = np.minimum(x, y).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.maximum(x, y).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)).astype(np.int64)
        k, other, s, h = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([s, s]), np.concatenate([h, h])
        got.append(_best(k[s >= min_sim], other[s >= min_sim], s[s >= min_sim], h[s >= min_sim]))
    return _best(*map(np.concatenate, zip(*got, strict=True)))


def _best(k: np.ndarray, other: np.ndarray, m: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    at = np.lexsort((other, h, m, k))
    at = at[np.append(k[at][1:] != k[at][:-1], True)[: len(at)]]
    return k[at], other[at], m[at], h[at]


def _merge_all(k: np.ndarray, n: np.ndarray, s: np.ndarray, min_sim: float) -> tuple[np.ndarray, np.ndarray]:
    """(old, new): all merges among clusters with k ascending, each to the cluster it ends in."""
    into, live = np.arange(len(k)), np.arange(len(k))
    while len(live):
        mean = s[live] / n[live, None]
        x, y, _, _ = _nearest(live, mean, live, mean, min_sim, True)
        to = np.full(len(k), -1)
        to[x] = y
        x, y = x[(to[y] == x) & (x < y)], y[(to[y] == x) & (x < y)]
        if not len(x):
            break
        s[x] += s[y]
        n[x] += n[y]
        into[y] = x
        to[y] = -1
        live = np.flatnonzero(to >= 0)  # what is near to nothing stays so
    for i in range(len(into)):  # the least comes first
        into[i] = into[into[i]]
    gone = np.flatnonzero(into != np.arange(len(k)))
    return k[gone], k[into[gone]]


def _block(rows: pa.StructScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k, n and s of a block's rows."""
    v = rows.values
    k, n, s = (v.field(c) for c in ("k", "n", "s"))
    return k.to_numpy(), n.to_numpy(zero_copy_only=False).astype(float), s.flatten().to_numpy().reshape(len(v), -1).copy()


def vector_linkage(vectors: DataFrame, min_sim: float = 0.2, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(id, cluster): exact average linkage of vectors by cosine, cut where the mean cosine of two clusters falls below min_sim > 0.

    vectors: (id, v), v an array of numbers. The mean cosine of two clusters is the dot product of their mean unit vectors, so a
    cluster is its size and its sum; there are no pairs to keep. In a round blocks of clusters meet block by block for everyone's
    nearest, and mutual nearest merge, as in average_linkage; clusters with nothing in reach drop out, since a merge brings none
    nearer. Equal vectors are one cluster from the start. Once all are in one block, a task does the remaining rounds. Vectors of
    unlike lengths are in no reach of each other; one without a direction (NULL, or with a NULL or NaN, or all 0) is a cluster of
    its own; of several vectors of an id the least counts. A cluster is named by its least id.
    """
    one = vectors.groupBy("id").agg(F.min("v").alias("v"))
    all_ = cut(one.join(numbered(one.select("id").filter("id is not null"), [F.col("id")], "k"), "id", "left"))
    v = F.transform("v", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    sound = all_.filter("k is not null").withColumn("norm", norm).filter("norm > 0 and norm < double('infinity')").select("k", "v", "norm", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2"))
    classes = sound.groupBy("h1", "h2").agg(F.min("k").alias("k"), F.count("*").alias("n"))
    of = cut(sound.join(classes.select("h1", "h2", F.col("k").alias("cluster")), ["h1", "h2"]).select("k", "cluster"))
    live = sound.join(classes.select("k", "n"), "k").select("k", "n", F.transform("v", lambda x: x.cast("double") / F.col("norm") * F.col("n")).alias("s"))
    size, dim = of.select("cluster").distinct().count(), all_.agg(F.max(F.size("v"))).collect()[0][0]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in b.column("rows"):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merge_all(*_block(rows), min_sim)], ["old", "new"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, x, y in zip(b.column("i"), b.column("j"), b.column("rows"), b.column("others"), strict=True):
                (ka, na, sa), (kb, nb, sb) = _block(x), _block(y)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _nearest(ka, sa / na[:, None], kb, sb / nb[:, None], min_sim, i == j)], ["k", "other", "m", "h"])

    while size > 1:  # every round merges a pair or ends
        n_blocks = ceil(size / max(1, block_values // max(1, dim)))
        placed = live.select(F.size("s").alias("dim"), F.pmod("k", F.lit(n_blocks)).alias("i"), F.struct("k", "n", "s").alias("r")).repartition(n_blocks, "dim", "i")
        blocks = cut(placed.groupBy("dim", "i").agg(F.sort_array(F.collect_list("r")).alias("rows")))
        if alone := blocks.count() == 1:
            into = cut(blocks.select("rows").mapInArrow(finish, "old bigint, new bigint"))
        else:
            met = blocks.hint("shuffle_replicate_nl").join(blocks.select(F.col("dim").alias("d"), F.col("i").alias("j"), F.col("rows").alias("others")), F.expr("dim = d and i <= j"))
            found = met.select("i", "j", "rows", "others").mapInArrow(compare, "k bigint, other bigint, m double, h bigint")
            best = cut(found.groupBy("k").agg(F.max_by("other", F.struct("m", "h", F.least("k", "other"), F.greatest("k", "other"))).alias("other")))
            into = cut(best.join(best.select(F.col("other").alias("k"), F.col("k").alias("other")), ["k", "other"]).filter("k < other").select(F.col("other").alias("old"), F.col("k").alias("new")))
        n_merged = into.count()
        if n_merged:
            of = cut(of.join(into, of["cluster"] == into["old"], "left").select("k", F.coalesce("new", "cluster").alias("cluster")))
        if alone or not n_merged:
            break
        size = best.count() - n_merged
        kept = blocks.select(F.inline("rows")).join(best.select("k"), "k", "left_semi").join(into, F.col("k") == F.col("old"), "left")
        kept = kept.groupBy(F.coalesce("new", "k").alias("k")).agg(F.sum("n").alias("n"), F.collect_list("s").alias("s"))  # a pair at most
        live = kept.select("k", "n", F.when(F.size("s") == 1, F.col("s")[0]).otherwise(F.zip_with(F.col("s")[0], F.try_element_at("s", F.lit(2)), lambda x, y: x + y)).alias("s"))
    named = of.join(all_.select(F.col("k").alias("cluster"), F.col("id").alias("name")), "cluster").select("k", "name")
    return all_.select("id", "k").join(named, "k", "left").select("id", F.coalesce("name", "id").alias("cluster"))


def medoids(vectors: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, id, total): the member with the largest sum of similarities to its cluster, itself included; least id on a tie.

    The sum of a member's similarities is its dot product with the sum of the cluster's vectors, so no pair is formed.
    """
    v = vectors.join(clusters, "id")
    whole = v.groupBy("cluster", "term").agg(F.sum("weight").alias("all"))
    total = v.join(whole, ["cluster", "term"]).groupBy("cluster", "id").agg(F.round(F.sum(F.col("weight") * F.col("all")), 9).alias("total"))
    total = clusters.join(total, ["cluster", "id"], "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
    w = Window.partitionBy("cluster").orderBy(F.desc("total"), "id")
    return total.withColumn("__n", F.row_number().over(w)).filter("__n = 1").select("cluster", "id", "total")
