"""Main text of web pages without menus, notices, teasers and footers.

Method: maximum-scoring subsequence. Every line gets the sum of weights of its words and of its layout (the marks a page's tags left
in the text: bullets, separators, capitals, missing stops); article words weigh positive, page furniture negative. One linear scan
finds the contiguous regions of lines with the greatest total score, where every region costs `REGION`: a page's article may be
parted by furniture, but a line leaves the region, or makes one of its own, only if that gains more than a region costs. With a
single region the scan is the classic best run; pages here have teasers amid the article, which one run would keep.

The weights are a logistic regression over hashed features, fitted on a bounded sample of pages (`SAMPLE_PAGES` of each kind, the
least hashes of the ids) whose lines label themselves: lines repeated throughout a source and set apart from prose are furniture,
as are other stories' titles; paragraphs, and short lines between two paragraphs and list entries of a feed's text, are article. Prefixes of
both stand for lines that were cut.

Defined results: NULL, empty and blank bodies give no rows; repeated rows of an id count once; pages that are nothing but a notice,
and lines of residue, are not page furniture; pages of any length are scanned whole; without pages to learn from no line is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut
from .codes import BLANK, DENSE, DIGIT, LETTER, MARK, STOP, TRAIL, UPPER, characters, joined, mixed, word_hashes
from .repeated_lines import heavy_lines, line_keys
from .residue import FILLER, NOTICES, SLOTS

#: Pages of each kind, and titles, that the weights are learned from; size of the weight table.
SAMPLE_PAGES, SAMPLE_TITLES, TABLE = 3_000, 8_000, 1 << 17
#: Marks of list entries, which in a feed's text are the article's own.
LISTED = ("- ", "– ", "* ")
#: What a region of content costs, in log-odds of a line.
REGION = 2.0
#: Characters that are scored at once.
CHUNK = 500_000

_STOP = re.compile(r"[.!?。！？…][\"'”’»«“」』)\]]*$")
_INNER = re.compile(r"[^\W\d_]{2,}[.!?][\"”’»)]*\s+[\"“«„—–-]?\s?\w|[。！？]\S")
_SLOT, _NOTICE = re.compile("|".join((*SLOTS, *FILLER))), re.compile("|".join(x for x in NOTICES))


def is_prose(line: str) -> bool:
    dense = sum("぀" <= c <= "鿿" for c in line)
    return len(line) + 2 * dense >= 60 and bool(_STOP.search(line) or _INNER.search(line))


class Lines(NamedTuple):
    """The lines of some texts that are not blank, and their features: feature[k] is one of line of[k], each once."""

    text: np.ndarray
    number: np.ndarray
    of: np.ndarray
    feature: np.ndarray


def features(texts: list[str]) -> Lines:
    """Hashed features of every line: words, word pairs and layout, by passes over the code points of all texts."""
    code, bounds = joined(texts)
    kind = characters()[0][code]
    place = np.arange(len(code))
    blank = (kind & BLANK > 0) | (code == 0xA0) | (code == 0x3000) | (code == 0x200B)
    stops = np.flatnonzero(code == 10)
    a, b = np.concatenate([[0], stops[:-1] + 1]), stops
    text = np.searchsorted(bounds, a, "right") - 1
    first_line = np.searchsorted(a, bounds[:-1])
    number = np.arange(len(a)) - first_line[text] + 1
    after = np.minimum.accumulate(np.where(blank, len(code), place)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(blank, -1, place))
    a, b = after[a], before[np.maximum(b - 1, 0)] + 1
    some = a < b
    a, b, text, number = a[some], b[some], text[some], number[some]
    if not len(a):
        return Lines(text, number, np.array([], np.int64), np.array([], np.int64))

    def between(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)])
        return c[b] - c[a]

    lettered = kind & (LETTER | MARK) > 0
    letters, upper = between(kind & LETTER > 0), between(kind & UPPER > 0)
    caps = (letters > 0) & (upper >= 0.7 * letters)
    # tokens: words, numbers, and every other sign by itself
    cls = np.where(lettered, 1, np.where(kind & DIGIT > 0, 2, np.where(blank, 0, 3))).astype(np.int8)
    new = np.concatenate([[True], (cls[1:] != cls[:-1]) | (cls[1:] == 3)])
    edge = np.append(np.flatnonzero(new), len(code))
    start, end = edge[:-1], edge[1:]
    keep = cls[start] > 0
    start, end = start[keep], end[keep]
    line = np.searchsorted(a, start, "right") - 1
    h = word_hashes(code, start, end)
    h[cls[start] == 2] = np.uint64(0x9)
    first = np.concatenate([[True], line[1:] != line[:-1]])
    name = (cls[start] == 1) & (kind[start] & UPPER > 0) & ~caps[line] & ~first
    h[name] = np.uint64(0x4E)
    twice = np.concatenate([[False], name[1:] & name[:-1] & ~first[1:]])
    h, line, start = h[~twice], line[~twice], start[~twice]
    first = np.concatenate([[True], line[1:] != line[:-1]])
    last = np.concatenate([line[1:] != line[:-1], [True]])
    ahead = np.where(first, np.uint64(0x5E), np.concatenate([[np.uint64(0)], h[:-1]]))
    pair = mixed(ahead * np.uint64(0x9E3779B97F4A7C15) + h)
    closing = mixed(h[last] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x24))
    # layout
    n, dense = b - a, between(kind & DENSE > 0)
    wide = n + 2 * dense
    shape = lambda i: np.where(lettered[i], 97, np.where(kind[i] & DIGIT > 0, 57, code[i])).astype(np.int64)
    signs = np.isin(code, [ord(c) for c in "|·•›»>/→"])
    gaps = np.concatenate([[False], blank[1:] & blank[:-1]]) & ~np.concatenate([[False, False], blank[1:-1] & blank[:-2]])[: len(code)]
    solid = np.maximum.accumulate(np.where(kind & TRAIL == 0, place, -1))[b - 1]
    ends = (solid >= a) & (kind[np.maximum(solid, 0)] & STOP > 0)
    written = np.maximum.accumulate(np.where(cls > 0, np.where(cls < 3, place, -1), -1))[b - 1]
    stop = kind & STOP > 0
    told = stop.copy()
    told[2:] &= (kind[1:-1] & LETTER > 0) & (kind[:-2] & LETTER > 0)
    told[:-1] &= kind[1:] & TRAIL > 0
    told |= stop & (code >= 0x3000)
    c = np.concatenate([np.zeros(1, np.int32), np.cumsum(told, dtype=np.int32)])
    inner = (written > a) & (c[np.maximum(written, a)] - c[a] > 0)
    layout = [
        shape(b - 1), shape(a) * 2 + (kind[a] & UPPER > 0), np.floor(np.log2(wide)).astype(np.int64), np.minimum(wide // 40, 10), caps.astype(np.int64), np.minimum(between(signs | gaps), 4),
        inner * 2 + ends, np.zeros(len(a), np.int64),
    ]
    at = np.arange(len(a))
    key = np.concatenate([mixed(h + np.uint64(1)), pair, closing, *[mixed(x.astype(np.uint64) * np.uint64(64) + np.uint64(k + 2)) for k, x in enumerate(layout)]])
    of = np.concatenate([line, line, line[last], *[at] * len(layout)])
    one = np.unique(of.astype(np.int64) * TABLE + (key % np.uint64(TABLE)).astype(np.int64))
    return Lines(text, number, one // TABLE, one % TABLE)


def learn(rows: list[tuple[str, int, float]], epochs: int = 6, rate: float = 0.5, ridge: float = 1e-5) -> np.ndarray:
    """Weights from (line, 1 article or 0 furniture, weight): AdaGrad over small batches, in a fixed order."""
    w, g2 = np.zeros(TABLE), np.full(TABLE, 1e-2)
    feats, kept = [], []
    # some thousand lines at a time: the driver holds their features, not the passes over their characters
    for lo in range(0, len(rows), 2_000):
        lines = features([x[0] for x in rows[lo : lo + 2_000]])
        feats += [x.astype(np.int32) for x in np.split(lines.feature, np.searchsorted(lines.of, np.arange(1, len(lines.text))))] if len(lines.text) else []
        kept += (lines.text + lo).tolist()
    y, c = np.array([rows[k][1] for k in kept], float), np.array([rows[k][2] for k in kept])
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(len(feats))
        for lo in range(0, len(order), 64):
            part = order[lo : lo + 64]
            idx = np.concatenate([feats[i] for i in part])
            own = np.repeat(np.arange(len(part)), [len(feats[i]) for i in part])
            z = np.bincount(own, w[idx], len(part))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * c[part]
            uniq, inv = np.unique(idx, return_inverse=True)
            g = np.bincount(inv, err[own]) + ridge * w[uniq]
            g2[uniq] += g * g
            w[uniq] -= rate * g / np.sqrt(g2[uniq]) / 4
    return w


def labelled(pages: list[tuple[str, str, list[bool]]], titles: list[str]) -> list[tuple[str, int, float]]:
    """(line, label, weight) from (kind, body, repeated flag per line) and other stories' titles."""
    rng = np.random.default_rng(3)
    rows: list[tuple[str, int, float]] = []
    seen: dict[str, int] = {}

    def add(line: str, label: int, weight: float = 1.0, cuts: bool = True) -> None:
        line = line.strip()
        if not line or seen.get(line, 0) >= 8:
            return
        seen[line] = seen.get(line, 0) + 1
        rows.append((line, label, weight))
        if cuts and len(line) > 12 and rng.random() < 0.25:
            rows.append((line[: int(rng.integers(6, len(line)))], label, weight / 2))

    for kind, body, flags in pages:
        lines = [(x.strip(), f) for x, f in zip(body.split("\n"), flags, strict=False) if x.strip()]
        prose = [is_prose(x) and not f for x, f in lines]
        for i, (x, f) in enumerate(lines):
            between = 0 < i < len(lines) - 1 and prose[i - 1] and prose[i + 1]
            if _SLOT.search(x):
                continue
            if f and not between:
                add(x, 0)
            elif prose[i]:
                add(x, 1)
            elif kind != "newsroom" and between and not f and len(x) < 60:
                add(x, 1, 3.0, cuts=False)
            elif kind != "newsroom" and not f and i and x[:2] in LISTED:
                add(x, 1, 3.0)
    for t in titles:
        front, back = ("", "", "• ", "» ", "07.05. ")[int(rng.integers(5))], ("", "", "", " 4 min", " »")[int(rng.integers(5))]
        add(front + t + back, 0)
    return rows


def regions(scores: list[float], cost: float = REGION) -> list[tuple[int, int]]:
    """The disjoint regions [start, end) of the greatest total score, each at a cost, by one scan; the fewest and shortest on a tie."""
    out_score, in_score = 0.0, float("-inf")
    opened: list[bool] = []  # whether the best region that holds line i begins there
    closed: list[bool] = []  # whether it is best to be outside of a region after line i because one has just ended
    for s in scores:
        fresh = out_score - cost
        opened.append(fresh > in_score)
        in_score = max(fresh, in_score) + s
        closed.append(in_score > out_score)
        out_score = max(out_score, in_score)
    found, i = [], len(scores) - 1
    while i >= 0:
        if not closed[i]:
            i -= 1
            continue
        end = i + 1
        while not opened[i]:
            i -= 1
        found.append((i, end))
        i -= 1
    return found[::-1]


def _least(rows: DataFrame, text: str, n: int) -> DataFrame:
    """The n rows with the least id hashes. Rows beyond twice that share of the hash range are left out before they are ordered."""
    total = rows.count()
    if total > 2 * n:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 2.0 * n / total)))
    return rows.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), text).limit(n)


def fit(items: DataFrame, sources: DataFrame) -> np.ndarray:
    """Weights for these items' pages."""
    kinds = sources.filter("source is not null").groupBy("source").agg(F.min("kind").alias("kind"))
    confirmed = cut(heavy_lines(items, 0.05, 3)).groupBy("source").agg(F.collect_set("key").alias("keys"))
    rows = items.filter("id is not null and body is not null").select("id", "source", "body").join(kinds, "source").withColumn("page", F.coalesce(F.col("kind") == "newsroom", F.lit(False)))
    sample = _least(rows.filter("page"), "body", SAMPLE_PAGES).unionByName(_least(rows.filter("not page"), "body", SAMPLE_PAGES))
    sample = sample.join(broadcast_if_small(cut(confirmed), 20_000), "source", "left").select("kind", "body", F.transform(line_keys(F.col("body")), lambda k: F.coalesce(F.array_contains("keys", k), F.lit(False))).alias("flags"))
    titles = _least(items.filter("id is not null and title is not null").select("id", "title"), "title", SAMPLE_TITLES)
    pages = sorted((r["kind"], r["body"], tuple(r["flags"])) for r in sample.collect())
    examples = labelled(pages, sorted(r["title"] for r in titles.collect()))
    return learn(examples) if examples else np.zeros(TABLE)


def boilerplate_lines(items: DataFrame, sources: DataFrame, weights: np.ndarray | None = None, cost: float = REGION) -> DataFrame:
    """(id, line_no) of the non-blank lines of newsroom bodies that are not part of the article."""
    weights = fit(items, sources) if weights is None else weights
    shared = items.sparkSession.sparkContext.broadcast(weights)
    pages = sources.filter("kind = 'newsroom'").select("source").distinct()
    rows = items.filter("id is not null and body is not null").select("id", "source", "body").join(broadcast_if_small(pages), "source", "left_semi").select("id", "body")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            part = np.cumsum(np.asarray(pc.utf8_length(b.column("body")), np.int64)) // CHUNK
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi <= lo:
                    continue
                bodies = b.column("body").slice(lo, hi - lo)
                texts = bodies.to_pylist()
                lines = features(texts)
                scores = np.bincount(lines.of, w[lines.feature], len(lines.text))
                inside = np.zeros(len(scores), bool)
                cuts = np.searchsorted(lines.text, np.arange(len(texts) + 1))
                for k in range(len(texts)):
                    for s, e in regions(scores[cuts[k] : cuts[k + 1]].tolist(), cost):
                        inside[cuts[k] + s : cuts[k] + e] = True
                # residue is no furniture: bodies that are nothing but a notice, and lines that hold slots or filler
                for k in np.flatnonzero(np.bincount(lines.text[~inside], minlength=len(texts)) == np.diff(cuts)):
                    if _NOTICE.search(" ".join(texts[k].lower().split())):
                        inside[cuts[k] : cuts[k + 1]] = True
                for k in np.flatnonzero(pc.or_(pc.match_substring_regex(bodies, "|".join(SLOTS)), pc.match_substring_regex(bodies, FILLER[0]))):
                    at = texts[k].split("\n")
                    for i in range(cuts[k], cuts[k + 1]):
                        inside[i] = inside[i] or bool(_SLOT.search(at[lines.number[i] - 1]))
                bad = np.flatnonzero(~inside)
                if len(bad):
                    yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo).take(pa.array(lines.text[bad])), pa.array(lines.number[bad].astype(np.int64))], ["id", "line_no"])

    return rows.mapInArrow(scan, "id string, line_no bigint").distinct()


def main_text(items: DataFrame, sources: DataFrame) -> DataFrame:
    """(id, main_text): newsroom bodies without their boilerplate lines."""
    bad = boilerplate_lines(items, sources).groupBy("id").agg(F.collect_set("line_no").alias("bad"))  # a page's own lines
    pages = sources.filter("kind = 'newsroom'").select("source").distinct()
    rows = items.filter("id is not null and body is not null").join(pages, "source", "left_semi").select("id", "body").dropDuplicates(["id"])
    kept = F.filter(F.split("body", "\n", -1), lambda x, i: ~F.coalesce(F.array_contains("bad", (i + 1).cast("bigint")), F.lit(False)))
    return rows.join(bad, "id", "left").select("id", F.array_join(kept, "\n").alias("main_text"))
