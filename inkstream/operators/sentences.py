"""Sentence-level retrieval within one document: everything happens in the document's own row, and nothing is shuffled."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sentences
from .vectorize import STOP_WORDS

_PART, _WORD, _STOP = re.compile(r"([.!?])\s+", re.ASCII), re.compile(r"\w{2,}"), frozenset(STOP_WORDS)


def split(docs: DataFrame, ident: str = "id", text: str = "text") -> DataFrame:
    """(ident, pos, sentence), pos from 0."""
    return docs.select(ident, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))


def _sentences(text: str | None) -> list[str]:
    """As functions.text.sentences, of one text."""
    return [x for x in (s.strip(" ") for s in _PART.sub("\\1\u0001", text or "").split("\u0001")) if x]


def _vectors(parts: list[str]) -> list[dict[str, float]]:
    """L2-normalised TF-IDF of the parts' words, the parts being the corpus; as vectorize.tfidf."""
    counts = [Counter(w for w in _WORD.findall(p.lower()) if w not in _STOP) for p in parts]
    df = Counter(w for c in counts for w in c)
    out = []
    for c in counts:
        v = {w: (1 + log(k)) * (1 + log((1 + len(parts)) / (1 + df[w]))) for w, k in c.items()}
        norm = sqrt(sum(x * x for x in v.values()))
        out.append({w: x / norm for w, x in v.items()})
    return out


def _dot(a: dict[str, float], b: dict[str, float]) -> float:
    if len(b) < len(a):
        a, b = b, a
    return sum(x * b[w] for w, x in a.items() if w in b)


def cohesion(docs: DataFrame, ident: str = "id", text: str = "text") -> DataFrame:
    """(ident, cohesion): mean cosine of neighbouring sentences over their number less one, words only, each document its own corpus,
    within [0, 1]; 0 with fewer than two sentences. Neighbours that share no word count as 0. One row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column("__t").to_pylist():
                v = _vectors(_sentences(t))
                out.append(min(1.0, sum(map(_dot, v, v[1:])) / (len(v) - 1)) if len(v) > 1 else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(ident), pa.array(out, pa.float64())], [ident, "cohesion"])

    rows = docs.select(ident, F.col(text).alias("__t"))
    return rows.mapInArrow(run, f"{ident} {dict(rows.dtypes)[ident]}, cohesion double")


def best_sentence(docs: DataFrame, query: str, ident: str = "id", title: str = "title", text: str = "text", lam: float = 0.7, head: int = 240) -> DataFrame:
    """(ident, sentence): the sentence with the greatest lam x cosine to the query - (1 - lam) x cosine to the title, the vectors fitted
    on the document's sentences, title and query; the first on a tie. With one sentence or none, the text's first `head` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, t in zip(b.column("__title").to_pylist(), b.column("__t").to_pylist(), strict=True):
                parts = _sentences(t)
                if len(parts) < 2:
                    out.append(None if t is None else t[:head])
                    continue
                *v, own, asked = _vectors([*parts, name or "", query])
                gain = [round(lam * _dot(x, asked) - (1 - lam) * _dot(x, own), 9) for x in v]
                out.append(parts[gain.index(max(gain))])
            yield pa.RecordBatch.from_arrays([b.column(ident), pa.array(out, pa.string())], [ident, "sentence"])

    rows = docs.select(ident, F.col(title).alias("__title"), F.col(text).alias("__t"))
    return rows.mapInArrow(run, f"{ident} {dict(rows.dtypes)[ident]}, sentence string")
