"""Per-document text statistics, and the documents that are not natural prose.

Method: a vector of statistics per document; per language the mean and covariance of prose, fitted robustly (start at medians, then
concentration steps that keep the nearest part of the documents); the squared Mahalanobis distance of every document and each
statistic's contribution d_j * (S^-1 d)_j to it. A document is not natural prose when its distance is beyond the limit and the
contributions that point away from prose (few sentences, many marks, ...) outweigh the others.

The language is that of the fixed function words found in the text; the label, brought to two letters, decides only where none is
found. Languages with few documents share the fit of all documents.

Defined results: NULL and blank texts have statistics of 0 and are not reported as outliers (texts of symbols or digits without a
letter are judged like others); repeated rows come out once; texts of
any length are measured whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .codes import BLANK, DIGIT, LETTER, MARK, STOP, TRAIL, UPPER, DENSE, characters, joined, runs, word_hashes

# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years where much your way down should because long each just those people too mr how little state good very make world still own see men work",
    "de": "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei soll solle will wir ob könnte",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont la avec ou son aux ses nous comme mais on leur été elle à cette sans après être selon peut pourrait",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está según",
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos seus",
    "ru": "и в не на я что он с по это как а то все она так его но они к у ты из мы за вы же от бы о до для при или если уже был была были есть еще ее их когда после без чем может где со под над",
    "ja": "の に は を た が で て と し れ さ あ る い も す な こ よ り か ま そ う",
}
STATS = ("log_words", "word_length", "symbol_share", "digit_share", "prose_share", "common_share", "upper_share", "sentence_rate", "line_words", "mark_share")
#: Sign of a departure from prose towards lists, tables and junk; 2: either way is one; 0: neither is.
AWAY = {"log_words": 0, "word_length": 2, "symbol_share": 1, "digit_share": 1, "prose_share": -1, "common_share": -1, "upper_share": 1, "sentence_rate": -1, "line_words": -1, "mark_share": 1}
#: Least spread of a statistic, so that none counts for more than its scale because prose hardly varies in it.
FLOOR = {"log_words": 0.5, "word_length": 0.25, "symbol_share": 0.03, "digit_share": 0.03, "prose_share": 0.12, "common_share": 0.15, "upper_share": 0.05, "sentence_rate": 0.25, "line_words": 0.6, "mark_share": 0.15}
#: Characters from which a line with four function words is taken for a sentence without its stop; headlines are shorter.
LONG_LINE = 140
#: Function words that make a long line a sentence.
_FUNCTION_WORDS = "the of and to in for with that der die das und zu von mit de la le les et que el los en do da em no и в на с по".split()
_RUNS_ON = re.compile(r"([^\W\d_]{2})[.!?][\"”’»)]?\s+[\"“«„—–-]?\s?(?=([^\W\d_]{2}))|[。！？]\S")
_LIST_LINE = r"^(?:[-–—•*►▪·+>]|\[.?\]|\(?\w{1,3}[.):])\s|[|;\t].*[|;\t]|^\S+(?:,[^,\s][^,]*){2,}$"
#: Characters that are measured at once.
CHUNK = 500_000

@lru_cache(maxsize=1)
def _known_words() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of all function words, the languages of each as bits, and whether it is one of _FUNCTION_WORDS."""
    of: dict[str, int] = {}
    for k, ws in enumerate(COMMON_WORDS.values()):
        for w in ws.split():
            of[w] = of.get(w, 0) | 1 << k
    words = list(of) + [w for w in _FUNCTION_WORDS if w not in of]
    code = np.array([ord(c) for c in " ".join(words)], np.uint32)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    h = word_hashes(code, start, start + size)
    order = np.argsort(h)
    return h[order], np.array([of.get(w, 0) for w in words])[order], np.array([w in _FUNCTION_WORDS for w in words])[order]


def _measure(texts: list[str]) -> dict[str, np.ndarray]:
    """Counts of each text, by passes over the code points of all of them."""
    code, bounds = joined(texts)
    kinds, _, visible = characters()
    kind = kinds[code]
    lo, hi = bounds[:-1], bounds[1:] - 1

    def between(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)])
        return c[b] - c[a]

    letter = kind & LETTER > 0
    lettered = kind & (LETTER | MARK) > 0
    dense = kind & DENSE > 0
    in_word = lettered | dense
    odd = kind & (LETTER | MARK | BLANK) == 0
    out = {
        "letters": between(in_word, lo, hi), "digits": between(kind & DIGIT > 0, lo, hi), "upper": between(kind & UPPER > 0, lo, hi), "stops": between(kind & STOP > 0, lo, hi),
        "symbols": between(odd & (kind & DIGIT == 0), lo, hi) * (between(visible[code], lo, hi) > 0),
    }
    # words
    start, end = runs(in_word, dense)
    h = word_hashes(code, start, end)
    doc = np.searchsorted(bounds, start, "right") - 1
    known, langs, common = _known_words()
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    is_known = known[at] == h
    out["n"] = np.bincount(doc, minlength=len(texts))
    order = np.lexsort((h, doc))
    first = np.ones(len(order), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = order[first]
    out["nd"] = np.bincount(doc[distinct], minlength=len(texts))
    hit = distinct[is_known[distinct]]
    for k, lang in enumerate(COMMON_WORDS):
        out[f"hits_{lang}"] = np.bincount(doc[hit], (langs[at[hit]] >> k) & 1, len(texts)).astype(np.int64)
    # lines without the spaces around them
    stop = np.flatnonzero(code == 10)
    a, b = np.concatenate([[0], stop[:-1] + 1]), stop
    place = np.arange(len(code))
    ink = code != 32
    after = np.minimum.accumulate(np.where(ink, place, len(code))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(ink, place, -1))
    a, b = after[a], before[np.maximum(b - 1, 0)] + 1
    a, b = a[a < b], b[a < b]
    of = np.searchsorted(bounds, a, "right") - 1
    n = b - a
    out["nl"], out["total"] = np.bincount(of, minlength=len(texts)), np.bincount(of, n, len(texts)).astype(np.int64)
    # a line is prose if it has words enough, few marks, and ends with a stop or goes on after one
    solid = np.maximum.accumulate(np.where(kind & TRAIL == 0, place, -1))[b - 1]
    stops = (solid >= a) & (kind[np.maximum(solid, 0)] & STOP > 0)
    groups = np.zeros(len(code), bool)
    groups[runs(letter)[0]] = True
    eight = np.concatenate([np.zeros(1, np.int32), np.cumsum(dense, dtype=np.int32)])
    eight = np.concatenate([eight[8:] - eight[:-8] == 8, np.zeros(8, bool)])[: len(code)] if len(code) >= 8 else np.zeros(len(code), bool)
    wordy = (between(groups, a, b) >= 5) | ((n >= 8) & (between(eight, a, np.maximum(b - 7, a)) > 0))
    may = wordy & (between(odd, a, b) < 0.25 * n)
    function = np.zeros(len(code), bool)
    function[start[is_known & common[at]]] = True
    prose = may & (stops | ((n >= LONG_LINE) & (between(function, a, b) >= 4)))
    cut_out = lambda i: code[a[i] : b[i]].tobytes().decode("utf-32-le", "surrogatepass")
    for i in np.flatnonzero(may & ~prose):
        prose[i] = bool(_goes_on(cut_out(i)))
    rest = np.flatnonzero(~prose)
    listed = np.array([bool(_LISTED(cut_out(i))) for i in rest], bool)
    out["prose"] = np.bincount(of[prose], n[prose], len(texts)).astype(np.int64)
    out["marked"] = np.bincount(of[rest[listed]], n[rest[listed]], len(texts)).astype(np.int64)
    return out


_LISTED = re.compile(_LIST_LINE, re.ASCII).search


def _goes_on(line: str) -> bool:
    """Whether a sentence ends within the line: two small letters, a stop, and a capital with a small letter, or a stop in dense script."""
    return any(m[1] is None or (m[1].islower() and m[2][0].isupper() and m[2][1].islower()) for m in _RUNS_ON.finditer(line))


def statistics(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(ident, lang_found, <STATS>...), one row per distinct document row; every statistic is a double."""
    counts = ["n", "nd", "nl", "total", "letters", "prose", "marked", "symbols", "digits", "upper", "stops", *[f"hits_{k}" for k in COMMON_WORDS]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # hard-wrapped and quoted lines are put together again: a line that goes on in lower case continues the one before
            flat = pc.replace_substring_regex(pc.fill_null(b.column("__t"), ""), r"\r?\n[>\s]*(\p{Ll})", r" \1")
            part = np.cumsum(np.asarray(pc.utf8_length(flat), np.int64)) // CHUNK
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi > lo:
                    made = _measure(flat.slice(lo, hi - lo).to_pylist())
                    yield pa.RecordBatch.from_arrays([b.column("__id").slice(lo, hi - lo), b.column("__label").slice(lo, hi - lo), *[pa.array(made[c].astype(np.int64)) for c in counts]], ["__id", "__label", *[f"__{c}" for c in counts]])

    rows = docs.select(F.col(ident).alias("__id"), F.col(lang).cast("string").alias("__label"), F.col(text).cast("string").alias("__t"))
    df = rows.mapInArrow(run, f"__id {dict(rows.dtypes)['__id']}, __label string, " + ", ".join(f"__{c} bigint" for c in counts))
    df = df.withColumn("__lang", F.array_max(F.array(*[F.struct(F.col(f"__hits_{k}").alias("n"), F.lit(k).alias("k")) for k in COMMON_WORDS])))
    safe = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    label = F.lower(F.regexp_extract(F.coalesce("__label", F.lit("")), r"^\s*([A-Za-z]{2})(?:[-_].*)?\s*$", 1))
    return df.select(
        F.col("__id").alias(ident),
        F.when(F.col("__lang.n") >= 4, F.col("__lang.k")).when(label.isin(*COMMON_WORDS), label).otherwise("und").alias("lang_found"),
        F.log1p("__n").alias("log_words"),
        F.log1p(safe("__letters", "__n")).alias("word_length"),
        safe("__symbols", "__total").alias("symbol_share"),
        safe("__digits", "__total").alias("digit_share"),
        safe("__prose", "__total").alias("prose_share"),
        F.when(F.col("__nd") > 0, F.col("__lang.n") / F.sqrt("__nd")).otherwise(0.0).alias("common_share"),
        safe("__upper", "__letters").alias("upper_share"),
        F.log((F.col("__stops") + 0.1) / (F.col("__n") + 1)).alias("sentence_rate"),
        F.log1p(safe("__n", "__nl")).alias("line_words"),
        safe("__marked", "__total").alias("mark_share"),
    ).distinct()


def _moments(df: DataFrame) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and cross products by language: a row per language comes to the driver, and languages are few."""
    k = len(STATS)
    aggs = [F.count("*").alias("n"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(STATS)], *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]]
    out = {}
    for r in df.groupBy("lang_found").agg(*aggs).collect():
        c = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        out[r["lang_found"]] = (r["n"], np.array([r[f"s{i}"] for i in range(k)]), c)
    return out


def _fit(moments: dict, least: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and inverse covariance by language, and of all together under ''."""
    if not moments:
        return {}
    floor = np.diag([FLOOR[s] ** 2 for s in STATS])
    whole = tuple(sum(m[i] for m in moments.values()) for i in range(3))
    made = lambda n, s, c: (s / n, np.linalg.inv(c / n - np.outer(s / n, s / n) + floor))
    return {"": made(*whole)} | {k: made(*m) for k, m in moments.items() if m[0] >= least and k != "und"}


def _distances(fits: dict[str, tuple[np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[list(STATS)].to_numpy(float)
            contrib = np.zeros_like(x)
            away = np.zeros(len(b))
            signs = np.array([AWAY[s] for s in STATS])
            lang = b["lang_found"].where(b["lang_found"].isin(fits.keys()), "")
            for k in lang.unique():
                rows = (lang == k).to_numpy()
                mean, inv = fits[k]
                d = x[rows] - mean
                contrib[rows] = d * (d @ inv)
                junk = (np.sign(d) == signs) | (signs == 2)
                away[rows] = (np.maximum(contrib[rows], 0) * np.where(junk, 1, np.where(signs == 0, 0, -1))).sum(1)
            out = b.assign(distance2=contrib.sum(1), away=away)
            for j, s in enumerate(STATS):
                out[f"part_{s}"] = contrib[:, j]
            yield out

    return run


def outliers(docs: DataFrame, keep: float = 0.6, steps: int = 3, limit: float = 58.0, least: int = 100, ident: str = "doc_id") -> DataFrame:
    """(ident, lang_found, <STATS>, distance2, away, part_<stat>..., is_outlier).

    keep: the share of documents that a concentration step keeps as prose; least: documents that a language's own fit needs; limit:
    squared distance beyond which a document is an outlier, set from the prose documents' own distances (the great majority lies
    under a third of it).
    """
    stats = cut(statistics(docs, ident))
    med = stats.groupBy("lang_found").agg(F.count("*").alias("n"), *[F.percentile_approx(s, 0.5, 2000).alias(s) for s in STATS]).collect()
    if not med:
        return _finish(stats, None, limit)
    scale = np.diag([1 / (3 * FLOOR[s]) ** 2 for s in STATS])
    big = max(med, key=lambda r: r["n"])
    fits = {"": (np.array([big[s] for s in STATS]), scale)} | {r["lang_found"]: (np.array([r[s] for s in STATS]), scale) for r in med if r["n"] >= least and r["lang_found"] != "und"}
    for _ in range(steps):
        near = _finish(stats, fits, limit)
        cuts = near.groupBy("lang_found").agg(F.percentile_approx("distance2", keep, 2000).alias("__cut"))
        fits = _fit(_moments(near.join(F.broadcast(cuts), "lang_found").filter("distance2 <= __cut and lang_found <> 'und'")), least) or fits
    return _finish(stats, fits, limit)


def _finish(stats: DataFrame, fits, limit: float) -> DataFrame:
    parts = [f"part_{s}" for s in STATS]
    schema = ", ".join([f"{n} {t}" for n, t in stats.dtypes] + ["distance2 double", "away double"] + [f"{p} double" for p in parts])
    found = stats.mapInPandas(_distances(fits or {"": (np.zeros(len(STATS)), np.eye(len(STATS)))}), schema)
    # every character is a letter, a digit, a symbol or blank
    has_text = (F.col("log_words") > 0) | (F.col("digit_share") > 0) | (F.col("symbol_share") > 0)
    return found.withColumn("is_outlier", has_text & (F.col("distance2") > limit) & (F.col("away") > 0))
