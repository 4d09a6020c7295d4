"""Template residue, filler and error pages in place of content.

Three kinds of text are looked at: whole bodies (digits masked), marked spans (a few characters between signs of a markup, as slots
are), and lines of filler.

Method: every distinct text gets a 64-bit SimHash over its shingles (five words; of a span, five characters); texts that agree in two
of five blocks of the hash meet in one of ten partitioned tables, and are linked when at most `HAMMING` bits differ and the shingle
similarity is 0.8 or more; texts known to be residue carry their label through the connected components of these links. A pair of
similarity 0.8 often differs in more bits, so the labelled texts are then joined exactly to those that the tables missed, on
prefixes of their shingles, until no text is added. An item is residue if its body, or a span in it, carries a label.

Filler comes in any order of its words, which no shingles survive: a line of it is reached from labelled lines by its words, of which
0.8 or more must be among theirs, until no line is added.

Trusted labels: a body that consists of a known notice; a short body that stands, digits masked, in several sources, which articles
do not; a span in a form of unfilled slots; a line with a phrase of filler text.

Defined results: NULL, empty and blank bodies are no cases; repeated rows of an id come out once; texts of any length are hashed
whole; an empty table gives no rows. What comes out does not depend on HAMMING, which only decides how much the tables find first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import broadcast_if_small, cut
from .codes import DIGIT, LETTER, MARK, characters, joined, mixed, stretch_hashes, word_hashes

SHINGLE, SIMILAR, HAMMING = 5, 0.8, 3
#: Bits of the five blocks of a hash; a table's key is two of them.
BLOCKS = (13, 13, 13, 13, 12)
#: A masked text of at most NOTICE_CHARS characters in at least NOTICE_SOURCES sources is residue. Longer texts get no label of their
#: own, but may be reached from labelled ones.
NOTICE_CHARS, NOTICE_SOURCES = 200, 3
#: Words in a row that point to filler; distinct words that a line of filler has; share of the labelled lines that a word of filler
#: stands in, which bounds their number.
FILLER_RUN, FILLER_WORDS, FILLER_SHARE = 5, 8, 0.05

# Forms of unfilled slots and of filler text.
SLOTS = (
    r"\{\{[^{}\n]{1,80}\}\}", r"[$#]\{[^{}\n]{1,80}\}", r"<%[^%\n]{1,80}%>", r"\{%[^%\n]{1,80}%\}", r"%%?[A-Z][A-Z_]{2,}%%?", r"\[\[[^\[\]\n]{1,80}\]\]", r"\*\|[^|\n]{1,80}\|\*", r"@@\w{1,40}@@",
    r"__[A-Z][A-Z_]{2,}__", r"\{[a-z]+(?:_[a-z0-9]+)+\}", r"\[(?:TODO|TBD|TK|FIXME|XX+)\b[^\]\n]{0,60}\]", r"\[[A-Z]{3,}(?: [A-Z]+)+\]", r"\[(?:COMPANY|NAME|TITLE|DATE|CITY|HEADLINE|QUOTE|CAPTION|PLACEHOLDER)\]", r"<<[A-Za-z_ ]{2,40}>>", r"\bXX{3,}\b",
    r"\bTK(?:TK)*\b", r"\[object Object\]", r"\bundefined NaN\b",
)
# Phrases of filler text.
FILLER = (r"(?i:lorem ipsum|dolor sit amet|consectetur adipiscing)",)
# Notices that stand in place of content.
NOTICES = (
    r"^\d{3} (?:not found|bad gateway|service (?:temporarily )?unavailable|forbidden|internal server error|gateway time-?out)\b", r"^(?:page|file) not found\b", r"^page introuvable", r"^seite nicht gefunden", r"^p\S{1,6}gina no encontrada", r"^internal server error\b", r"^gateway time-?out\b", r"^<error><code>",
    r"^traceback \(most recent call", r"^error establishing a database", r"^oops! something went wrong", r"^too many requests", r"^access (?:to this page )?(?:is )?denied", r"^the requested url was rejected", r"^are you a robot\b", r"^checking your browser", r"^sorry, this content is not available in your (?:region|country)",
    r"^session expired", r"^(?:please )?(?:log|sign) in to continue", r"^(?:you need to|please) (?:enable|activate|turn) javascript (?:to run this app|on and reload)", r"^this page requires scripts", r"^es necesario habilitar javascript", r"^vous devez activer javascript", r"^bitte aktivieren sie javascript", r"^upgrade your browser\b",
    r"^loading(?:…|\.\.\.)", r"^hello world! welcome to", r"^this is a test (?:article|post|page)\b",
)


#: A few characters between signs of a markup: what may be a slot.
MARKED = r"\{+%?[^{}\n]{1,80}\}+|[$#]\{[^{}\n]{1,80}\}|<[<%][^<>\n]{1,80}>|%+[A-Za-z_]{3,80}%+|\[\[?[^\[\]\n]{1,80}\]\]?|\*\|[^|\n]{1,80}\|\*|@@\w{1,80}@@|__\w{1,80}__"
_SLOT, _FILLER, _NOTICE, _MARKED = (re.compile(x) for x in ("|".join(SLOTS), "|".join(FILLER), "|".join(NOTICES), MARKED))
#: Characters that are hashed at once.
CHUNK = 500_000


def masked(text: Column) -> Column:
    """Lower case, digits as one mark, everything but letters and that mark as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\p{N}+", " 0 "), r"[^\p{L}\p{M}0]+", " "))


def _masked_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of masked texts, without masking them first, and where each text's words begin (and the last end)."""
    code, bounds = joined(texts)
    kind = characters()[0][code]
    cls = np.where(kind & (LETTER | MARK) > 0, 1, np.where(kind & DIGIT > 0, 2, 0)).astype(np.int8)
    change = np.concatenate([[True], cls[1:] != cls[:-1]])
    start = np.flatnonzero(change & (cls > 0))
    end = np.append(np.flatnonzero(change), len(cls))
    end = end[np.searchsorted(end, start, "right")]
    h = word_hashes(code, start, end)
    h[cls[start] == 2] = np.uint64(0x5BD1E995)
    return h, np.searchsorted(start, bounds)


def _shingles_of(w: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts whose words' hashes are w[off[i]:off[i + 1]], ordered by text and hash, and the text of each;
    a text shorter than a shingle is one shingle."""
    if not len(w):
        return w.astype(np.uint64), np.array([], np.int64)
    padded = np.concatenate([w, np.zeros(SHINGLE, np.uint64)])
    own = np.repeat(np.arange(len(off) - 1), np.diff(off))
    ends, first = off[1:][own], off[:-1][own]
    at = np.arange(len(w)) + off[0]
    h = np.zeros(len(w), np.uint64)
    for j in range(SHINGLE):
        h = mixed(h ^ np.where(at + j < ends, padded[j : j + len(w)], np.uint64(j + 1)))
    keep = (at + SHINGLE <= ends) | (at == first)  # windows that fit, or the only one
    h, own = h[keep], own[keep]
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])])
    return h[new], own[new]


def _distinct_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As _shingles_of, of texts of words parted by spaces."""
    words = pc.split_pattern(pc.fill_null(texts, ""), " ")
    enc = words.flatten().dictionary_encode()
    w = pd.util.hash_array(np.asarray(enc.dictionary.to_pandas(), dtype=object), categorize=False)[np.asarray(enc.indices)] if len(enc) else np.array([], np.uint64)
    return _shingles_of(w, np.asarray(words.offsets) - words.offsets[0].as_py())


def simhashes(texts: pa.Array) -> np.ndarray:
    """64-bit SimHash of the distinct word shingles of each text."""
    return _simhashes(*_distinct_shingles(texts), len(texts))


def _simhashes(h: np.ndarray, own: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint64)
    if not len(h):
        return out
    n = np.bincount(own, minlength=size)
    some = n > 0
    starts = (np.cumsum(n) - n)[some]
    for bit in range(64):
        ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), starts)
        out[some] |= np.where(2 * ones > n[some], np.uint64(1) << np.uint64(bit), np.uint64(0))
    return out


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their SimHash and number of distinct shingles."""
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            part = b.slice(i, 2000)
            h, own = _distinct_shingles(part.column("norm"))
            made = [pa.array(_simhashes(h, own, part.num_rows).view(np.int64)), pa.array(np.bincount(own, minlength=part.num_rows).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, "sim", "n"])


def hashed(texts: DataFrame) -> DataFrame:
    """texts (norm, ...) with sim, the SimHash, and n, the number of distinct shingles."""
    return texts.mapInArrow(_hash_batches, ", ".join(f"{c} {t}" for c, t in [*texts.dtypes, ("sim", "bigint"), ("n", "bigint")]))


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over bodies (id, source, body): hash of the masked text, SimHash, shingles, label, marked spans, words of filler."""
    for b in batches:
        body = pc.fill_null(b.column("body"), "")
        size = np.asarray(pc.utf8_length(body), np.int64)
        part = np.cumsum(size) // CHUNK
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi <= lo:
                continue
            some = body.slice(lo, hi - lo)
            texts = some.to_pylist()
            w, off = _masked_words(texts)
            h = stretch_hashes(mixed(w), off[:-1], off[1:])
            shingle, own = _shingles_of(w, off)
            # a label only for what is no more than a notice
            known = [n <= 2 * NOTICE_CHARS and bool(_NOTICE.search(" ".join(t.lower().split()))) for t, n in zip(texts, size[lo:hi].tolist(), strict=True)]
            may = np.asarray(pc.or_(pc.match_substring_regex(some, "|".join((*SLOTS, MARKED))), pc.match_substring_regex(some, FILLER[0])))
            spans: list[list[str]] = [[]] * len(texts)
            filler: list[list[list[str]]] = [[]] * len(texts)
            for k in np.flatnonzero(may):
                spans[k] = sorted({m[0] for rx in (_SLOT, _MARKED) for m in rx.finditer(texts[k])})
                filler[k] = [_words(x) for x in texts[k].split("\n") if _FILLER.search(x)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(lo, hi - lo), b.column("source").slice(lo, hi - lo), pa.array(h.view(np.int64)), pa.array(_simhashes(shingle, own, len(texts)).view(np.int64)), pa.array(np.bincount(own, minlength=len(texts)).astype(np.int64)), pa.array(size[lo:hi]), pa.array(known), pa.array(spans, pa.list_(pa.string())), pa.array(filler, pa.list_(pa.list_(pa.string())))],
                ["id", "source", "h", "sim", "n", "chars", "known", "spans", "filler"],
            )


def _words(line: str) -> list[str]:
    return sorted(set(re.findall(r"[^\W\d_]+", line.lower())))


def _prefix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, s): the shingles of a text of which a text of similarity SIMILAR has at least one among its own, in order of their hash."""
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            part = b.slice(i, 2000)
            s, own = _distinct_shingles(part.column("norm"))
            n = np.bincount(own, minlength=part.num_rows)
            place = np.arange(len(own)) - (np.cumsum(n) - n)[own]
            keep = place <= (n - np.ceil(SIMILAR * n - 1e-9))[own]
            yield pa.RecordBatch.from_arrays([part.column("h").take(pa.array(own[keep])), pa.array(s[keep].view(np.int64))], ["h", "s"])


def _shingles(c: str) -> Column:
    w = F.split(c, " ")
    n = F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.array_join(F.slice(w, i, F.lit(SHINGLE)), " "))))


def _similar(ends: DataFrame) -> DataFrame:
    """The pairs (a, b) of ends (a, b, na, nb) whose texts have a shingle similarity of SIMILAR or more."""
    ends = ends.select("a", "b", _shingles("na").alias("sa"), _shingles("nb").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return ends.filter(both >= SIMILAR * (F.size("sa") + F.size("sb") - both)).select("a", "b")


#: From (h) to (h, norm): the masked texts themselves, which are only fetched for pairs that meet.
Norms = Callable[[DataFrame], DataFrame]


def _own_norms(texts: DataFrame) -> Norms:
    return lambda hs: texts.join(broadcast_if_small(hs), "h", "left_semi").select("h", "norm")


def near_links(texts: DataFrame, norms: Norms | None = None) -> DataFrame:
    """Verified links (a, b), a < b, between texts (h, sim; or h, norm): few differing bits and shingle similarity of SIMILAR or more.

    Texts with one and the same hash are linked to the least of them; of different hashes, those that meet in a table are compared.
    """
    norms = norms or _own_norms(texts)
    sims = cut((texts if "sim" in texts.columns else hashed(texts)).select("h", "sim"))
    heads = cut(sims.groupBy("sim").agg(F.min("h").alias("head")))
    same = sims.join(heads, "sim").filter("h <> head").select(F.col("head").alias("a"), F.col("h").alias("b"))
    shift, blocks = 0, []
    for width in BLOCKS:
        blocks.append(F.shiftrightunsigned("sim", shift).bitwiseAND(F.lit((1 << width) - 1)))
        shift += width
    keys = [F.struct(F.lit(k).alias("t"), (blocks[i] * 8192 + blocks[j]).alias("key")) for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    tables = heads.select("sim", "head", F.explode(F.array(*keys)).alias("k")).select("sim", "head", "k.t", "k.key")
    # only keys that several hashes share go on
    met = tables.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    tables = tables.join(met, ["t", "key"])
    other = tables.select("t", "key", F.col("sim").alias("sim2"), F.col("head").alias("b"))
    near = tables.withColumnRenamed("head", "a").join(other, ["t", "key"]).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("sim").bitwiseXOR(F.col("sim2"))) <= HAMMING)).select("a", "b")
    pairs = cut(same.unionByName(near).distinct())
    ends = cut(norms(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()))
    return _similar(pairs.join(ends.select(F.col("h").alias("a"), F.col("norm").alias("na")), "a").join(ends.select(F.col("h").alias("b"), F.col("norm").alias("nb")), "b"))


def reached(texts: DataFrame, marked: DataFrame, norms: Norms | None = None) -> DataFrame:
    """(h): marked texts and all that chains of links of similarity SIMILAR or more join to them, whatever their SimHash.

    texts: (h, n), one row a text, n its number of distinct shingles; marked: (h). In every round the texts added last meet the
    others of a size within reach on prefix shingles, and the pairs that meet are compared. Articles link to no notice, so that only
    texts about as short as the marked ones are looked at.
    """
    norms = norms or _own_norms(texts)
    found = last = cut(marked.select("h").distinct())
    while last.limit(1).count():
        new = cut(norms(last))
        sizes = texts.join(broadcast_if_small(last), "h", "left_semi").select("n").distinct().select(F.explode(F.sequence(F.ceil(F.col("n") * SIMILAR - 1e-9), F.floor(F.col("n") / SIMILAR + 1e-9))).alias("n")).distinct()
        rest = texts.select("h", "n").join(broadcast_if_small(cut(sizes)), "n", "left_semi").join(broadcast_if_small(found), "h", "left_anti").select("h")
        rest = cut(norms(cut(rest)))
        of_new = broadcast_if_small(cut(new.mapInArrow(_prefix_batches, "h bigint, s bigint")).withColumnRenamed("h", "a"))
        of_rest = rest.mapInArrow(_prefix_batches, "h bigint, s bigint").withColumnRenamed("h", "b")
        pairs = cut(of_rest.join(of_new, "s").select("a", "b").distinct().join(new.select(F.col("h").alias("a"), F.col("norm").alias("na")), "a"))
        met = rest.select(F.col("h").alias("b"), F.col("norm").alias("nb")).join(broadcast_if_small(pairs, 20_000), "b")
        last = cut(_similar(met).select(F.col("b").alias("h")).distinct())
        found = cut(found.unionByName(last))
    return found


def _labelled(texts: DataFrame, trusted: DataFrame, norms: Norms | None = None) -> DataFrame:
    """(h): texts (h, sim, n) that are trusted, or joined to trusted ones by components of links or by chains of similarity."""
    parts = components(near_links(texts, norms))
    marked = parts.join(trusted.withColumnRenamed("h", "node"), "node", "left_semi").select("component").distinct()
    carried = parts.join(marked, "component", "left_semi").select(F.col("node").alias("h"))
    return reached(texts, trusted.unionByName(carried), norms)


def _filler_words(lines: DataFrame) -> frozenset[str]:
    """Words that stand in at least FILLER_SHARE of lines (line array<string>): their number is bounded by that share."""
    n = lines.count()
    words = lines.select(F.explode("line").alias("w")).groupBy("w").count().filter(F.col("count") >= max(2, FILLER_SHARE * n))
    return frozenset(r["w"] for r in words.collect()) if n else frozenset()


def filler_lines(bodies: DataFrame, trusted: DataFrame) -> DataFrame:
    """(id, line): lines of bodies (id, body) most of whose words are those of trusted lines (line array<string>) or of lines reached
    before; line is the distinct words."""
    found, known = None, _filler_words(trusted)
    while known:
        alternatives = "|".join(map(re.escape, sorted(known, key=lambda w: (-len(w), w))))
        run = rf"(?i)(?:\b(?:{alternatives})\b[^\p{{L}}\p{{N}}]+){{{FILLER_RUN - 1}}}(?:{alternatives})\b"

        def look(batches: Iterator[pa.RecordBatch], run=run, known=known) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, lines = [], []
                hit = b.filter(pc.fill_null(pc.match_substring_regex(b.column("body"), run), False))
                for i, body in zip(hit.column("id").to_pylist(), hit.column("body").to_pylist(), strict=True):
                    for x in body.split("\n"):
                        words = _words(x)
                        if len(words) >= FILLER_WORDS and sum(w in known for w in words) >= SIMILAR * len(words):
                            ids.append(i)
                            lines.append(words)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lines, pa.list_(pa.string()))], ["id", "line"])

        found = cut(bodies.mapInArrow(look, "id string, line array<string>"))
        more = _filler_words(trusted.select("line").unionByName(found.select("line"))) | known
        if more == known:
            break
        known = more
    return found if found is not None else bodies.select("id", F.array().cast("array<string>").alias("line")).limit(0)


def residue(items: DataFrame) -> DataFrame:
    """(id, kind, how): items whose body is or holds residue; kind is `slot` (slots or filler within) or `notice` (nothing but a
    notice), how is `label` where a trusted label stands in the item itself, else `carried`."""
    bodies = items.filter("id is not null and body is not null").select("id", "source", "body").filter(F.col("body").rlike(r"\S"))
    seen = cut(bodies.mapInArrow(_look, "id string, source string, h bigint, sim bigint, n bigint, chars bigint, known boolean, spans array<string>, filler array<array<string>>"))

    # whole bodies: a text's copies within a source are counted once before the sources are
    copies = seen.groupBy("h", "source").agg(F.min("id").alias("rep"), F.min("sim").alias("sim"), F.min("n").alias("n"), F.min("chars").alias("chars"), F.max("known").alias("known"))
    texts = cut(copies.groupBy("h").agg(F.min("rep").alias("rep"), F.min("sim").alias("sim"), F.min("n").alias("n"), F.min("chars").alias("chars"), F.max("known").alias("known"), F.count("source").alias("n_sources")))
    trusted = texts.filter(F.col("known") | ((F.col("n") > 0) & (F.col("chars") <= NOTICE_CHARS) & (F.col("n_sources") >= NOTICE_SOURCES))).select("h")

    def norms(hs: DataFrame) -> DataFrame:
        reps = cut(texts.join(broadcast_if_small(hs), "h", "left_semi").select("h", F.col("rep").alias("id")))
        return bodies.join(broadcast_if_small(reps), "id").select("h", masked(F.col("body")).alias("norm")).dropDuplicates(["h"])

    labelled = _labelled(texts, trusted, norms)
    known = seen.select("id", "h", "known").join(broadcast_if_small(labelled, 400_000), "h", "left_semi").join(broadcast_if_small(trusted).withColumn("own", F.lit(True)), "h", "left")
    notices = known.select("id", F.lit("notice").alias("kind"), F.coalesce("own", F.lit(False)).alias("own"))

    # marked spans: texts of characters
    pairs = cut(seen.select("id", F.explode("spans").alias("span")).withColumn("h", F.xxhash64("span")))
    spans = cut(hashed(pairs.groupBy("h").agg(F.min("span").alias("span")).select("h", "span", F.array_join(F.split("span", ""), " ").alias("norm"))))
    slots = cut(spans.filter(F.col("span").rlike("|".join(SLOTS))).select("h"))
    held = pairs.join(broadcast_if_small(_labelled(spans, slots)), "h", "left_semi").join(broadcast_if_small(slots).withColumn("own", F.lit(True)), "h", "left")
    held = held.select("id", F.lit("slot").alias("kind"), F.coalesce("own", F.lit(False)).alias("own"))

    # lines of filler
    lines = cut(seen.select("id", F.explode("filler").alias("line")))
    filler = lines.select("id", F.lit("slot").alias("kind"), F.lit(True).alias("own")).unionByName(filler_lines(bodies.select("id", "body"), lines).select("id", F.lit("slot").alias("kind"), F.lit(False).alias("own")))

    every = notices.unionByName(held).unionByName(filler).groupBy("id").agg(F.max("kind").alias("kind"), F.max("own").alias("own"))
    return every.select("id", "kind", F.when(F.col("own"), "label").otherwise("carried").alias("how"))


def without_residue(items: DataFrame) -> DataFrame:
    """items without the rows whose body is or holds residue."""
    return items.join(residue(items).select("id"), "id", "left_anti")
