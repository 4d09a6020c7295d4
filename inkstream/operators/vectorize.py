"""TF-IDF in long form, and exact cosine joins."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut
from .ranking import numbered

# English stop words of the default vectoriser.
STOP_WORDS = tuple(
    "a about above after again against all also am an and any are as at be because been before being below between both but by can could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not now of off on once only or other our out over own per same she should so some such than that the their them then there these they this those through to too under until up upon very was we were what when where which while who whom why will with within without would you your".split()
)


def terms(text: Column, bigrams: bool = True, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Words of two characters or more without stop words, and pairs of neighbours among those."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), 0), lambda w: ~w.isin(*stop))
    if not bigrams:
        return words
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def tfidf(docs: DataFrame, by: list[str], text: str = "text", min_df: int = 2, group: list[str] | None = None, bigrams: bool = True, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """(by..., term, weight), L2-normalised: (1 + ln tf) (1 + ln((1 + n) / (1 + df))).

    group: columns of `by` within which n and df are counted (each its own corpus); none: one corpus. If no term reaches min_df,
    1 is used. Documents without terms have no rows.
    """
    over = group or []
    tf = docs.select(*by, F.explode(terms(F.col(text), bigrams, stop)).alias("term")).groupBy(*by, "term").agg(F.count("*").alias("tf"))
    n = docs.groupBy(*over).agg(F.count("*").alias("n")) if over else docs.agg(F.count("*").alias("n"))
    df = tf.groupBy(*over, "term").agg(F.count("*").alias("df"))
    top = df.groupBy(*over).agg(F.max("df").alias("top")) if over else df.agg(F.max("df").alias("top"))
    stats = (df.join(top, over) if over else df.crossJoin(F.broadcast(top))).filter(F.col("df") >= F.when(F.col("top") < min_df, 1).otherwise(min_df)).drop("top")
    stats = stats.join(n, over) if over else stats.crossJoin(F.broadcast(n))
    raw = tf.join(stats, [*over, "term"]).withColumn("w", (1 + F.log("tf")) * (1 + F.log((1 + F.col("n")) / (1 + F.col("df")))))
    return raw.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*by)))).select(*by, "term", "weight")


#: Terms of vectors in a block: some 15 MB.
BLOCK_TERMS = 1_250_000


class _Block:
    """Vectors as arrays: ids, n (copies), lengths, and the rows' terms (rarest first) and weights one after another."""

    def __init__(self, rows: pa.StructScalar):
        v = rows.values
        t, w = v.field("terms"), v.field("weights")
        self.ids, self.n = v.field("id"), v.field("n").to_numpy()
        self.size = np.diff(t.offsets.to_numpy())
        self.start = np.cumsum(self.size) - self.size
        self.term, self.weight = t.flatten().to_numpy(), w.flatten().to_numpy()
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        # norm of what stands from a term on to the row's end
        up = np.cumsum(self.weight**2)
        before = np.concatenate([[0.0], up])[self.start]
        total = np.concatenate([[0.0], up])[self.start + self.size] - before
        self.rest = np.sqrt(np.maximum(np.repeat(total + before, self.size) - up + self.weight**2, 0))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _similar(a: _Block, b: _Block, same: bool, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sim) of the rows of a and b with a dot product of `least` or more; of one block (same) every pair once."""
    known = np.unique(b.term)
    at = np.minimum(np.searchsorted(known, a.term), len(known) - 1)
    both, bt = known[at] == a.term, np.searchsorted(known, b.term)
    # a pair's rarest shared term bounds its product by both rests from there: postings by term and falling rest, as far as that reaches
    reach = least - 1e-6
    posted = np.flatnonzero(b.rest >= reach)
    posted = posted[np.lexsort((-b.rest[posted], bt[posted]))]
    key = bt[posted] * 4.0 - b.rest[posted]
    asked = np.flatnonzero(both & (a.rest >= reach))
    lo = np.searchsorted(key, at[asked] * 4.0 - 2)
    hits = np.searchsorted(key, at[asked] * 4.0 - reach / a.rest[asked], "right") - lo
    lo, asked = lo[hits > 0], asked[hits > 0]
    hits = hits[hits > 0]
    rows, posted_row = a.row[asked], b.row[posted]
    step = max(1, min(64, 2_000_000 // len(known)))
    table = np.zeros(step * len(known))
    done, up = 0, np.cumsum(hits)
    while done < len(rows):  # some rows of a at a time, whole rows only
        end = np.searchsorted(rows, rows[done] + step)
        end = min(end, max(np.searchsorted(up, (up[done - 1] if done else 0) + 2_000_000), done + 1))
        end = np.searchsorted(rows, rows[end - 1], "right")
        base, here = rows[done], slice(done, end)
        pair = np.unique(np.repeat(rows[here] - base, hits[here]) * len(b.size) + posted_row[_ranges(lo[here], hits[here])])
        done = end
        i, j = np.divmod(pair, len(b.size))
        if same:
            i, j = i[j > i + base], j[j > i + base]
        if not len(i):
            continue
        last = rows[end - 1]
        mine = slice(a.start[base], a.start[last] + a.size[last])
        cell = ((a.row[mine] - base) * len(known) + at[mine])[both[mine]]
        table[cell] = a.weight[mine][both[mine]]
        for k in range(0, len(i), 200_000):
            x, y = i[k : k + 200_000], j[k : k + 200_000]
            flat = _ranges(b.start[y], b.size[y])
            sim = np.add.reduceat(table[np.repeat(x * len(known), b.size[y]) + bt[flat]] * b.weight[flat], np.cumsum(b.size[y]) - b.size[y])
            yes = sim >= least
            yield x[yes] + base, y[yes], sim[yes]
        table[cell] = 0


def _met(packed: DataFrame, n_terms: int, block_terms: int) -> DataFrame:
    """(i, j, rows, others): every two blocks of the vectors (id, n, terms, weights), i <= j, a pair of blocks a partition."""
    n_blocks = max(1, ceil(n_terms / block_terms))
    placed = packed.select(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("i"), F.struct("id", "n", "terms", "weights").alias("r")).repartitionById(n_blocks, "i")
    blocks = cut(placed.groupBy("i").agg(F.collect_list("r").alias("rows")))
    return blocks.hint("shuffle_replicate_nl").join(blocks.select(F.col("i").alias("j"), F.col("rows").alias("others")), F.expr("i <= j")).select("i", "j", "rows", "others")


def _packed(terms: DataFrame, ranks: DataFrame, weight: Column) -> DataFrame:
    """(id, terms, weights) of (id, term...) with the terms' numbers of ranks (term, no, ...), ascending."""
    t = terms.join(broadcast_if_small(ranks), "term").groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.col("no").cast("int").alias("no"), weight.alias("w")))).alias("t"))
    return t.select("id", F.col("t.no").alias("terms"), F.col("t.w").alias("weights"))


def cosine_pairs(vectors: DataFrame, threshold: float, ident: str = "id", eps: float = 1e-9, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(a, b, sim), a < b: all pairs of L2-normalised vectors with cosine of `threshold` or more, exactly.

    Candidates meet on prefix terms only (Bayardo et al., 2007): with the terms in one global order, rarest first, a pair can reach
    the threshold only if the norms from its rarest shared term on have a product of the threshold or more, so that frequent terms
    are hardly ever looked up. Blocks of vectors meet block by block and candidates are held against the threshold where they are
    found, so none is stored.
    """
    v = vectors.select(F.col(ident).alias("id"), "term", "weight")
    freq = v.groupBy("term").agg(F.count("*").alias("df"))
    ranks = cut(numbered(freq, [F.col("df"), F.col("term")], "no"))
    n_terms = ranks.agg(F.sum("df")).collect()[0][0] or 0
    least, kind = threshold - eps, dict(v.dtypes)["id"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in batches:
            for i, j, x, y in zip(m.column("i"), m.column("j"), m.column("rows"), m.column("others"), strict=True):
                a, b = _Block(x), _Block(y)
                for p, q, sim in _similar(a, b, i == j, least):
                    yield pa.RecordBatch.from_arrays([a.ids.take(pa.array(p)), b.ids.take(pa.array(q)), pa.array(sim)], ["p", "q", "sim"])

    met = _met(_packed(v, ranks.select("term", "no"), F.col("weight")).withColumn("n", F.lit(1).cast("bigint")), n_terms, block_terms)
    return met.mapInArrow(compare, f"p {kind}, q {kind}, sim double").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "sim")


def text_classes(docs: DataFrame, text: str = "text", ident: str = "id") -> DataFrame:
    """(id, rep, n_copies): rep is the least id with exactly the same text."""
    w = docs.select(F.col(ident).alias("id"), F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"))
    c = w.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n_copies"))
    return w.join(c, ["h1", "h2"]).select("id", "rep", "n_copies")


def linked(docs: DataFrame, threshold: float, text: str = "text", ident: str = "id", min_df: int = 2, bigrams: bool = True, stop: tuple[str, ...] = STOP_WORDS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(id, rep, n_links): each document's class and the number of other documents within the threshold, copies counted.

    Weights are tfidf()'s. Copies never meet pair by pair: a class is joined through its least member, links counted where they are
    found, as in cosine_pairs. Documents are shuffled by id as texts; only counts of terms leave a document before its vector is made.
    """
    docs = cut(docs.select(F.col(ident).alias("id"), F.col(text).alias("text")))
    classes = cut(text_classes(docs))
    tf = lambda d: d.repartition("id").select("id", F.explode(terms(F.col("text"), bigrams, stop)).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    df = cut(tf(docs).groupBy("term").agg(F.count("*").alias("df")))
    top, n = df.agg(F.max("df")).collect()[0][0] or 0, docs.count()
    ranks = cut(numbered(df.filter(F.col("df") >= (1 if top < min_df else min_df)), [F.col("df"), F.col("term")], "no"))
    reps = classes.filter("id = rep").select("id", F.col("n_copies").alias("n"))
    raw = _packed(tf(docs.join(reps, "id", "left_semi")), ranks, (1 + F.log("tf")) * (1 + F.log((1 + F.lit(n)) / (1 + F.col("df")))))
    unit = raw.withColumn("norm", F.sqrt(F.aggregate("weights", F.lit(0.0), lambda s, x: s + x * x)))
    packed = unit.join(reps, "id").select("id", "n", "terms", F.transform("weights", lambda x: x / F.col("norm")).alias("weights"))
    least = threshold - 1e-9

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in batches:
            for i, j, x, y in zip(m.column("i"), m.column("j"), m.column("rows"), m.column("others"), strict=True):
                a, b = _Block(x), _Block(y)
                of_a, of_b = np.zeros(len(a.n), np.int64), np.zeros(len(b.n), np.int64)
                for p, q, _ in _similar(a, b, i == j, least):
                    np.add.at(of_a, p, b.n[q])
                    np.add.at(of_b, q, a.n[p])
                yield pa.RecordBatch.from_arrays([a.ids, pa.array(of_a)], ["rep", "n"])
                yield pa.RecordBatch.from_arrays([b.ids, pa.array(of_b)], ["rep", "n"])

    kind = dict(docs.dtypes)["id"]
    links = _met(packed, ranks.agg(F.sum("df")).collect()[0][0] or 0, block_terms).mapInArrow(count, f"rep {kind}, n bigint").groupBy("rep").agg(F.sum("n").alias("n"))
    # a class without a row here has no vector, so its copies have none
    return classes.join(links, "rep", "left").select("id", "rep", F.coalesce(F.col("n") + F.col("n_copies") - 1, F.lit(0)).alias("n_links"))


def project(old: DataFrame, vocabulary: DataFrame, by: str) -> DataFrame:
    """Old vectors (by, term, weight) over the current vocabulary (term), normalised anew; without a common term there is no row."""
    kept = old.join(vocabulary.select("term").distinct(), "term", "left_semi")
    return kept.withColumn("weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(by)))).select(by, "term", "weight")
