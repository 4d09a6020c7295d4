"""Lines repeated across one source's texts.

Two lines are the same if their letters, lower-cased, are the same in sequence. Method: every partition keeps a mergeable
heavy-hitter summary per source (Misra-Gries counters over the lines of its rows); the summaries are added up and give the
candidate lines, with an upper bound; where a source's error reaches what makes a line repeated, so that a line could be missed, all
its lines are counted instead; a second pass counts the candidates exactly over distinct ids; the
confirmed lines are then removed by per-source sets that are broadcast when a check of their size allows.

Defined results: NULL and empty bodies have no lines but their items count for the source; lines without letters are never
candidates; repeated rows of an id count once; rows with a NULL id or source are left out; an empty table gives no rows.
Lines are compared by a 64-bit hash of their letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut

#: Counters that a partition keeps for one source, and for all its sources before it hands them on.
COUNTERS = 2_000
COUNTERS_IN_ALL = 2_000_000


def line_keys(body: Column) -> Column:
    """Per line of body (parted by \\n), a hash of its lower-cased letters; NULL for lines without letters."""
    letters = lambda x: F.regexp_replace(F.lower(x), r"[^\p{L}]+", "")
    keys = F.transform(F.split(body, "\n", -1), letters)
    return F.transform(keys, lambda k: F.when(k != "", F.xxhash64(k)))


def _reduce(keys: np.ndarray, counts: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The Misra-Gries step: with more than `room` counters, take the next largest count off all; it adds to the error."""
    if len(keys) <= room:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - room - 1)[len(counts) - room - 1])
    keep = counts > off
    return keys[keep], counts[keep] - off, off


def _summaries(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}  # source -> [keys, counts, error, rows]

        def out() -> pa.RecordBatch:
            source, key, n, err = [], [], [], []
            for s, (k, c, e, rows) in kept.items():
                off = int(rows * share / 5)  # counters this small cannot matter; what they held adds to the error
                k, c, e = k[c > off], c[c > off], e + off
                source += [s] * (len(k) + 1)
                key += [*k.tolist(), None]
                n += [*c.tolist(), 0]
                err += [0] * len(k) + [e]
            kept.clear()
            return pa.RecordBatch.from_pydict({"source": source, "key": key, "n": n, "err": err}, schema=pa.schema([("source", pa.string()), ("key", pa.int64()), ("n", pa.int64()), ("err", pa.int64())]))

        for b in batches:
            enc = b.column("source").dictionary_encode()
            codes, lists = np.asarray(enc.indices), b.column("keys")
            sizes = np.diff(np.asarray(lists.offsets))
            flat, of = np.asarray(lists.flatten()), np.repeat(codes, sizes)
            order = np.lexsort((flat, of))
            flat, of = flat[order], of[order]
            new = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (of[1:] != of[:-1])]) if len(flat) else np.array([], int)
            counts, ukeys, ucodes = np.diff(np.r_[new, len(flat)]), flat[new], of[new]
            rows = np.bincount(codes, minlength=len(enc.dictionary))
            for c, s in enumerate(enc.dictionary.to_pylist()):
                lo, hi = np.searchsorted(ucodes, [c, c + 1])
                k, n, e, r = kept.get(s, (np.array([], np.int64), np.array([], np.int64), 0, 0))
                k, inv = np.unique(np.r_[k, ukeys[lo:hi]], return_inverse=True)
                k, n, off = _reduce(k, np.bincount(inv, np.r_[n, counts[lo:hi]]).astype(np.int64), COUNTERS)
                kept[s] = [k, n, e + off, r + int(rows[c])]
            if sum(len(v[0]) for v in kept.values()) > COUNTERS_IN_ALL:
                yield out()
        yield out()

    return run


def item_counts(items: DataFrame) -> DataFrame:
    """(source, n_items): distinct ids per source, bodies missing or not."""
    return items.filter("id is not null and source is not null").select("source", "id").distinct().groupBy("source").agg(F.count("*").alias("n_items"))


def heavy_lines(items: DataFrame, share: float, least: int) -> DataFrame:
    """Candidate (source, key, n_items): every line that may stand in `least` items and in `share` of its source's items."""
    rows = items.filter("id is not null and source is not null and body is not null").select("source", F.array_distinct(F.filter(line_keys(F.col("body")), lambda k: k.isNotNull())).alias("keys"))
    parts = cut(rows.mapInArrow(_summaries(share), "source string, key bigint, n bigint, err bigint"))
    err = parts.groupBy("source").agg(F.sum("err").alias("err"))
    sums = parts.filter("key is not null").groupBy("source", "key").agg(F.sum("n").alias("n"))
    # a key in no summary has at most err occurrences: where that is enough to be repeated, the source's keys are counted
    known = cut(err.join(item_counts(items), "source"))
    enough = lambda n: (n >= least) & (n >= F.col("n_items") * share)
    loose = cut(known.filter(enough(F.col("err"))).select("source", "n_items"))
    tight = known.filter(~enough(F.col("err")))
    found = sums.join(F.broadcast(tight) if _few(tight) else tight, "source").filter(enough(F.col("n") + F.col("err"))).select("source", "key", "n_items")
    if loose.limit(1).count() == 0:
        return found
    all_keys = rows.select("source", F.explode("keys").alias("key")).join(F.broadcast(loose) if _few(loose) else loose, "source")
    counted = all_keys.groupBy("source", "key").agg(F.count("*").alias("n"), F.max("n_items").alias("n_items")).filter(enough(F.col("n")))
    return found.unionByName(counted.select("source", "key", "n_items"))


def _few(df: DataFrame) -> bool:
    return df.limit(100_001).count() <= 100_000


def repeated_lines(items: DataFrame, share: float = 0.05, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """(places, lines): places (id, source, line_no, key) of the confirmed lines; lines (source, key, n, n_items)."""
    candidates = broadcast_if_small(cut(heavy_lines(items, share, least)))
    lines = items.filter("id is not null and source is not null and body is not null").select("id", "source", F.posexplode(line_keys(F.col("body"))).alias("pos", "key"))
    at = cut(lines.filter("key is not null").join(candidates, ["source", "key"]).select("id", "source", (F.col("pos") + 1).cast("bigint").alias("line_no"), "key", "n_items"))
    # distinct (key, id) first: a hot line's ids are counted in many tasks
    exact = at.select("source", "key", "n_items", "id").distinct().groupBy("source", "key").agg(F.count("*").alias("n"), F.max("n_items").alias("n_items"))
    confirmed = exact.filter((F.col("n") >= least) & (F.col("n") >= F.col("n_items") * share))
    confirmed = cut(confirmed)
    return at.drop("n_items").join(broadcast_if_small(confirmed.select("source", "key")), ["source", "key"], "left_semi"), confirmed


def without_repeated_lines(items: DataFrame, confirmed: DataFrame, column: str = "body") -> DataFrame:
    """items with `<column>_clean`: the text without its source's confirmed lines; NULL stays NULL.

    A source's confirmed lines are a bounded set: each stands in at least `share` of its items.
    """
    sets = confirmed.groupBy(F.col("source").alias("__src")).agg(F.collect_set("key").alias("__keys"))
    sets = broadcast_if_small(cut(sets), 20_000)
    both = F.zip_with(F.split(column, "\n", -1), line_keys(F.col(column)), lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    kept = F.filter(both, lambda p: p["k"].isNull() | ~F.array_contains(F.col("__keys"), p["k"]))
    text = F.when(F.col("__keys").isNull(), F.col(column)).otherwise(F.array_join(F.transform(kept, lambda p: p["x"]), "\n"))
    return items.join(sets, F.col("source") == F.col("__src"), "left").withColumn(f"{column}_clean", text).drop("__src", "__keys")
