"""Passages of held-out evaluation items inside a training corpus.

Method: every task builds an FM-index per shard of its documents (word ids, suffix order, Burrows-Wheeler transform in a wavelet
matrix, sampled suffix positions), searches the items' phrases backward through wavelet ranks, locates the occurrences by walking
to sampled positions, and merges them into spans. Each candidate pair is then checked exactly by aligning the item with that
stretch of the document.

A leak is a stretch with at least `least` of the item's words in order, SEED of them in a row somewhere, where at most `gap` words in a
row are changed, missing or added. Words compare without case, accents, punctuation and spacing. Wording of more than `phrase` words that several items share
does not count.

Defined results: NULL and empty texts on either side give nothing; repeated rows of a document or item come out once; texts of any
length are searched whole; empty tables give no rows. Items are searched in blocks of a fixed size against all documents.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a searched phrase, which a stretch must hold unchanged; words of an index shard; rows between sampled suffix positions.
SEED, SHARD_WORDS, SAMPLE = 4, 1_000_000, 8
#: Items searched at once; their words are broadcast (some 100 words each).
ITEM_BLOCK = 20_000
#: Matched words that one changed, missing or added word costs: a stretch must be mostly the item's own words.
EDIT_COST = 2

def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-cased words without accents of each text."""
    flat = pc.utf8_normalize(pc.utf8_lower(pc.fill_null(texts, "")), form="NFKD")
    flat = pc.replace_substring_regex(flat, r"[\p{M}'’]+", "")
    return pc.split_pattern_regex(flat, r"[^\p{L}\p{N}]+")


class Wavelet:
    """Wavelet matrix over small integers: rank and access in one pass over the bits."""

    def __init__(self, seq: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            b = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(b, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])
        self.base = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            before = ones[i]
            i = np.where((c >> (self.bits - 1 - level)) & 1, zeros + before, i - before)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before position i."""
        return self._down(c, i) - self.base[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and its rank there."""
        c = np.zeros(len(i), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            before = ones[i]
            bit = ones[i + 1] - before
            c = c * 2 + bit
            i = np.where(bit, zeros + before, i - before)
        return c, i - self.base[c]


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions of seq in the order of their suffixes, by prefix doubling over the still equal ones."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    change = np.concatenate([[True], seq[order][1:] != seq[order][:-1]]) if n else np.array([], bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(change, np.arange(n), 0))
    k = 1
    while True:
        same = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(same[rank] > 1)
        if not len(tied):
            break
        nxt = np.where(tied + k < n, rank[np.minimum(tied + k, n - 1)] + 1, 0)
        key = rank[tied] * (n + 2) + nxt
        o = np.argsort(key, kind="stable")
        key, at = key[o], tied[o]
        group = rank[at]
        starts = np.concatenate([[True], group[1:] != group[:-1]])
        first = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = group + np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0)) - first
        k *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Backward search over a sequence of word ids; its last element, 0, stands nowhere else."""

    def __init__(self, seq: np.ndarray, top: int):
        sa = suffix_order(seq)
        self.wavelet = Wavelet(seq[sa - 1].astype(np.int64), top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])[:-1]
        marked = sa % SAMPLE == 0
        self.marks = marked
        self.sampled = np.concatenate([[0], np.cumsum(marked)])
        self.positions = sa[marked]
        self.n = len(seq)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases, one per row."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            lo[live], hi[live] = self.first[c] + self.wavelet.rank(c, lo[live]), self.first[c] + self.wavelet.rank(c, hi[live])
            hi[live] = np.maximum(lo[live], hi[live])
            live = live[hi[live] > lo[live]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled row."""
        out, steps = np.empty(len(rows), np.int64), 0
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            hit = self.marks[at]
            out[live[hit]] = self.positions[self.sampled[at[hit]]] + steps
            live, at = live[~hit], at[~hit]
            if len(live):
                c, r = self.wavelet.access(at)
                at = self.first[c] + r
            steps += 1
        return out


def plan_items(items: list[tuple[int, list[str]]], phrase: int) -> dict:
    """Word ids, seeds and shared positions of a block of items."""
    vocab = {w: i + 2 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    coded = [np.array([vocab[w] for w in ws], np.int64) for _, ws in items]
    grams: dict[tuple, set[int]] = defaultdict(set)
    long: Counter = Counter()
    for k, c in enumerate(coded):
        for i in range(len(c) - SEED + 1):
            grams[tuple(c[i : i + SEED])].add(k)
        long.update({tuple(c[i : i + phrase + 1]) for i in range(len(c) - phrase)})
    shared = []
    for c in coded:
        m = np.zeros(len(c), bool)
        for i in range(len(c) - phrase):
            if long[tuple(c[i : i + phrase + 1])] > 1:
                m[i : i + phrase + 1] = True
        shared.append(m)
    owners = [np.array(sorted(ks), np.int64) for ks in grams.values()]
    return {
        "words": list(vocab), "ids": [i for i, _ in items], "coded": coded, "shared": shared, "own": [np.unique(c[~m]) for c, m in zip(coded, shared, strict=True)],
        "phrases": np.array(list(grams), np.int64).reshape(-1, SEED), "owners": np.concatenate(owners) if owners else np.array([], np.int64), "n_owners": np.array([len(o) for o in owners], np.int64),
    }


def stretch(item: np.ndarray, shared: np.ndarray, text: np.ndarray, gap: int) -> tuple[int, int, int]:
    """(matched words, start, end) of the best stretch of text aligned with item."""
    best, run = (0, 0, 0), None  # run: score, matched, start in text, end in text, end in item
    for b in SequenceMatcher(None, item.tolist(), text.tolist(), autojunk=False).get_matching_blocks():
        if b.size == 0:
            break
        n = int((~shared[b.a : b.a + b.size]).sum())
        edits = max(b.a - run[4], b.b - run[3]) if run else gap + 1
        if run and edits <= gap and run[0] - EDIT_COST * edits > 0:
            run = (run[0] + n - EDIT_COST * edits, run[1] + n, run[2], b.b + b.size, b.a + b.size)
        else:
            run = (n, n, b.b, b.b + b.size, b.a + b.size)
        best = max(best, run[1:4])
    return best


def _search(plan, least: int, gap: int, ident: str):
    schema = pa.schema([(ident, pa.int64()), ("eval_id", pa.int64()), ("n_words", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())])

    def shard(ids: list, lists: list[pa.ListArray]) -> pa.RecordBatch:
        p = plan.value
        words = pa.chunked_array([x.flatten() for x in lists])
        enc = words.combine_chunks().dictionary_encode() if words.num_chunks else pa.array([], pa.string()).dictionary_encode()
        known = pc.fill_null(pc.add(pc.index_in(enc.dictionary, pa.array(p["words"])), 2), 1)
        codes = np.asarray(known)[np.asarray(enc.indices)].astype(np.int64)
        empty = np.asarray(pc.equal(enc.dictionary, ""))[np.asarray(enc.indices)]
        sizes = np.concatenate([np.diff(np.asarray(x.offsets)) for x in lists])
        doc = np.repeat(np.arange(len(sizes)), sizes)[~empty]
        codes = codes[~empty]
        starts = np.searchsorted(doc, np.arange(len(sizes) + 1))
        # other words part the text; a row of them, and the end of each document, counts as one
        edge = np.zeros(len(codes), bool)
        edge[starts[1:-1][starts[1:-1] < len(codes)]] = True
        at = np.arange(len(codes))
        seq, src = np.insert(codes, np.flatnonzero(edge), 1), np.insert(at, np.flatnonzero(edge), -1)
        keep = np.ones(len(seq), bool)
        keep[1:] = (seq[1:] != 1) | (seq[:-1] != 1)
        seq, src = np.append(seq[keep], 0), np.append(src[keep], -1)
        fm = FMIndex(seq, len(p["words"]) + 1)
        lo, hi = fm.search(p["phrases"])
        found = np.flatnonzero(hi > lo)
        rows = np.concatenate([np.arange(lo[f], hi[f]) for f in found]) if len(found) else np.array([], np.int64)
        phrase = np.repeat(found, (hi - lo)[found])
        pos = src[fm.locate(rows)] if len(rows) else rows
        # every item that holds the phrase, at every place of it
        n = p["n_owners"][phrase]
        first = (np.cumsum(p["n_owners"]) - p["n_owners"])[phrase]
        owner = p["owners"][np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(rows) else rows
        pos = np.repeat(pos, n)
        out = defaultdict(list)
        order = np.lexsort((pos, owner))
        spans: dict[tuple[int, int], list[list[int]]] = defaultdict(list)
        for k, x in zip(owner[order].tolist(), pos[order].tolist(), strict=True):
            d, room = int(doc[x]), len(p["coded"][k])
            s = spans[d, k]
            if s and x - s[-1][1] <= room:
                s[-1][1] = x + SEED
            else:
                s.append([x, x + SEED])
        for (d, k), each in spans.items():
            room = len(p["coded"][k])
            best = (0, 0, 0)
            for a, b in each:
                a, b = max(starts[d], a - room), min(starts[d + 1], b + room)
                # its first `least` words can stand no further apart: edits cost EDIT_COST of the words matched before, shared words nothing
                width = least + (least - 2) // EDIT_COST + int(p["shared"][k].sum())
                held = np.concatenate([[0], np.cumsum(np.isin(codes[a:b], p["own"][k]))])
                if (held[width:] - held[:-width] if len(held) > width else held[-1:]).max() < least:
                    continue
                n, s, e = stretch(p["coded"][k], p["shared"][k], codes[a:b], gap)
                best = max(best, (n, int(a + s - starts[d]), int(a + e - starts[d])))
            if best[0] >= least and ids[d] is not None:
                for name, v in zip(schema.names, (ids[d], p["ids"][k], best[0], best[1], best[2] - 1), strict=True):
                    out[name].append(v)
        return pa.RecordBatch.from_pydict({n: out[n] for n in schema.names}, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, size = [], [], 0
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                lists.append(words_of(part.column(1)))
                ids += part.column(0).to_pylist()
                size += len(lists[-1].flatten())
                if size >= SHARD_WORDS:
                    yield shard(ids, lists)
                    ids, lists, size = [], [], 0
        if ids:
            yield shard(ids, lists)

    return run


def leaks(docs: DataFrame, items: DataFrame, least: int = 15, gap: int = 2, phrase: int = 8, ident: str = "doc_id") -> DataFrame:
    """(ident, eval_id, n_words, first_word, last_word): the best stretch of every leaking pair; words are counted from 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).cast("bigint").alias(ident), "text").filter("text is not null")
    schema = f"{ident} bigint, eval_id bigint, n_words bigint, first_word bigint, last_word bigint"
    out, block = None, []

    def flush(block):
        nonlocal out
        ids, texts = zip(*block, strict=True)
        words = [[w for w in ws if w] for ws in words_of(pa.array(texts, pa.string())).to_pylist()]
        plan = spark.sparkContext.broadcast(plan_items(list(zip(ids, words, strict=True)), phrase))
        found = rows.mapInArrow(_search(plan, least, gap, ident), schema)
        out = found if out is None else out.unionByName(found)

    # whole items in blocks; a block of them is what the driver and a task hold at once
    for r in items.select("eval_id", "text").filter("eval_id is not null and text is not null").distinct().orderBy("eval_id").toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == ITEM_BLOCK:
            flush(block)
            block = []
    if block:
        flush(block)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy(ident, "eval_id").agg(F.max(F.struct("n_words", "first_word", "last_word")).alias("b")).select(ident, "eval_id", "b.*")


def removal_spans(found: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(ident, first_word, last_word, n_items): overlapping stretches of a document merged."""
    from pyspark.sql import Window

    w = Window.partitionBy(ident).orderBy("first_word", "last_word")
    before = F.max("last_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("__new", F.when(before.isNull() | (F.col("first_word") > before), 1).otherwise(0))
    return marked.withColumn("__span", F.sum("__new").over(w)).groupBy(ident, "__span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.count_distinct("eval_id").alias("n_items")).drop("__span")
