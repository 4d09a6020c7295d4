"""Text decoded with the wrong character encoding: find it, and restore what can be restored.

Method: the corpus' own distinct words that hold characters beyond ASCII are taken as originals; their garbled forms under every
chain of wrong encodings are generated once per word; the tokens of the documents are hash-joined against that table, and what
matches is substituted by its original. A garbled form counts only if its original is more frequent in the corpus than the form
itself (or as frequent, where the form cannot well be a word), which settles the direction.

Tokens are of four kinds: `w`, runs of letters and characters beyond ASCII; `r`, the runs beyond ASCII alone (so that a word never
seen clean is still found by its garbled characters); `g`, character pairs of scripts written without spaces, whose whole garbled
forms are matched by sliding windows of every length that such a form can have; `e`, runs of HTML entities, which are matched with
the escaped forms of runs beyond ASCII.

Some forms are plain letters (one single-byte encoding read as another). Such weak forms count where another form of the same
chain, or a strong one, stands in the same value, or where that is so in most values that hold the token.

Defined results: NULL and empty values have no tokens; repeated rows of an id come out once; texts of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.entities import codepoint2name

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut

# Chains of (encoding of the bytes, encoding they were read with). web1252 is cp1252 whose five gaps pass through;
# entities writes characters beyond ASCII as HTML entities, as pages do that escape what they have read wrongly.
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    *(((("utf-8", d),)) for d in ("latin-1", "web1252", "cp1252", "cp1250", "cp1251", "cp1254", "cp437", "cp850", "cp866", "mac_roman", "koi8_r", "iso8859_2", "iso8859_15", "gbk", "cp932", "big5", "cp949")),
    *(((("cp1252", d),)) for d in ("latin-1", "utf-8", "cp437", "cp850", "cp1250", "cp1251", "mac_roman")),
    *(((("mac_roman", d),)) for d in ("web1252", "cp1252", "latin-1", "utf-8")),
    *(((("cp437", d),)) for d in ("web1252", "latin-1")),
    *(((("cp1251", d),)) for d in ("web1252", "latin-1", "koi8_r", "cp866", "utf-8")),
    *(((("koi8_r", d),)) for d in ("cp1251", "web1252", "latin-1", "utf-8")),
    *(((("cp866", d),)) for d in ("cp1251", "web1252", "latin-1")),
    *(((e, d),) for e in ("cp932", "euc_jp", "gbk") for d in ("web1252", "latin-1", "utf-8")),
    (("utf-8", "web1252"), ("utf-8", "web1252")),
    (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    (("utf-8", "web1252"), ("entities", "ascii")),
    (("utf-8", "latin-1"), ("entities", "ascii")),
)
_GAPS = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
FIELDS = ("title", "body")
_RUN = re.compile(r"[^\x00-\x7F]+")
_WORD = re.compile(r"[A-Za-z]*[^\x00-\x7F][^\x00-\x40\x5B-\x60\x7B-\x7F]*")
_ENTITIES = re.compile("(?:&#?[A-Za-z0-9]+;)+")
#: Runs of Cyrillic, Latin-1 letters or punctuation are words, not dense script.
_PLAIN = re.compile(r"[Ѐ-ԯ -¿‐-‰]+")
_PAIR = re.compile(r"[぀-ヿ㐀-鿿가-힯]{2}")
#: Lengths that the garbled form of a pair can have: up to six bytes read one by one or in pairs, and these read wrongly once more.
#: Forms in dense script itself have the short ones.
WINDOWS, DENSE_WINDOWS = range(3, 19), range(3, 7)
#: Tokens that no writing has: lost and control characters.
_LOST = re.compile("[\u0080-\u009f�]")
#: Token hashes that are sent to the executors to leave other tokens out before the join; beyond this all tokens are joined.
MAX_WANTED = 2_000_000
#: Forms that are sent to every executor for the join with the tokens; the driver holds them several times while it builds the table.
MAX_FORM_BYTES = 32 << 20


def decode(raw: bytes, how: str, errors: str = "replace") -> str:
    if how == "entities":
        return html.unescape(raw.decode("ascii"))
    if how == "web1252":
        return "".join(chr(b) if b in _GAPS else bytes([b]).decode("cp1252") for b in raw)
    return raw.decode(how, errors)


def encode(text: str, how: str) -> bytes:
    if how == "entities":
        return "".join(c if c < "\x80" else f"&{codepoint2name[ord(c)]};" if ord(c) in codepoint2name else f"&#{ord(c)};" for c in text).encode()
    if how == "web1252":
        return b"".join(bytes([ord(c)]) if ord(c) in _GAPS else c.encode("cp1252") for c in text)
    return text.encode(how)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """text after the chain, or None where its first encoding lacks a character."""
    try:
        for enc, dec in chain:
            text = decode(encode(text, enc), dec)
    except UnicodeEncodeError:
        return None
    return text


def ungarble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The exact inverse of the chain, or None where a character was lost."""
    try:
        for enc, dec in reversed(chain):
            text = decode(encode(text, dec), enc, "strict")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None
    return text


def is_strong(form: str, original: str) -> bool:
    """Whether the form cannot well be a word of its own: lost or control characters, or more characters than the original had."""
    return bool(_LOST.search(form)) or len(form) > len(original)


_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[128:] = 2


def words_beyond_ascii(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of every word with a character beyond ASCII, by one pass over the bytes of all texts."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int32)
    if bounds[0] == bounds[-1]:
        return np.array([], np.int64), pa.array([], pa.string())
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kind = _CLASS[data]
    in_word = kind > 0
    filled = bounds[1:] > bounds[:-1]
    starts, ends = in_word.copy(), in_word.copy()
    starts[1:] &= ~in_word[:-1]
    ends[:-1] &= ~in_word[1:]
    first, last = bounds[:-1][filled], bounds[1:][filled] - 1
    starts[first], ends[last] = in_word[first], in_word[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    high = np.concatenate([np.zeros(1, np.int32), np.cumsum(kind == 2, dtype=np.int32)])
    beyond = high[ends] > high[starts]
    starts, ends = starts[beyond], ends[beyond]
    row = np.searchsorted(bounds, starts, "right") - 1
    size = ends - starts
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    raw = data[np.arange(at[-1]) + np.repeat(starts - at[:-1], size)]
    return row, pa.StringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw))


def _tokens_of(word: str) -> list[str]:
    """The tokens of a word, each with its kind before it."""
    if word[0] == "&":
        return ["e" + word]
    out = {"w" + word}
    runs = _RUN.findall(word)
    out.update("r" + r for r in runs)
    for kind, x in [("w", word), *(("r", r) for r in runs)]:
        if " " in x:
            out.update(kind + p for p in x.split(" ") if _RUN.search(p))
    for r in runs:
        if len(r) > 1 and not _PLAIN.fullmatch(r):
            for i in range(len(r) - 1):
                if _PAIR.match(r, i):
                    out.add("g" + r[i : i + 2])
            for k in DENSE_WINDOWS if ord(max(r)) >= 0x2E80 else WINDOWS:
                out.update("g" + r[i : i + k] for i in range(len(r) - k + 1))
    return sorted(out)


def _hashes(tokens: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(tokens, dtype=object), categorize=False) if tokens else np.array([], np.uint64)


def _value_tokens(known: dict[str, list[str]], texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, code, tokens): the distinct tokens of every text, as codes into tokens."""
    row, words = words_beyond_ascii(texts)
    escaped = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, "&#?[A-Za-z0-9]+;"), False))
    if len(escaped):
        found = [_ENTITIES.findall(t) for t in texts.take(pa.array(escaped)).to_pylist()]
        row = np.concatenate([row, np.repeat(escaped, [len(x) for x in found])])
        words = pa.concat_arrays([words, pa.array([x for f in found for x in f], pa.string())])
    enc = words.dictionary_encode()
    codes: dict[str, int] = {}
    lists = []
    if len(known) > 200_000:  # a memo only
        known.clear()
    for w in enc.dictionary.to_pylist():
        made = known.get(w)
        if made is None:
            made = _tokens_of(w)
            if len(w) < 60:
                known[w] = made
        lists.append([codes.setdefault(t, len(codes)) for t in made])
    size = np.array([len(x) for x in lists], np.int64)
    flat = np.array([c for x in lists for c in x], np.int64)
    of = np.asarray(enc.indices)
    pair = np.unique(row.astype(np.int64) << 32 | of) if len(of) else np.array([], np.int64)
    row, of = pair >> 32, pair & 0xFFFFFFFF
    n = size[of] if len(of) else np.array([], np.int64)
    start = np.cumsum(size) - size
    at = np.repeat(start[of] - (np.cumsum(n) - n), n) + np.arange(n.sum()) if len(of) else np.array([], np.int64)
    pair = np.unique(np.repeat(row, n) << 32 | flat[at]) if len(of) else np.array([], np.int64)
    return pair >> 32, pair & 0xFFFFFFFF, list(codes)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 4000):
            yield b.slice(i, 4000)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[str]] = {}
    for b in _parts(batches):
        for field in FIELDS:
            _, code, names = _value_tokens(known, b.column(field))
            t = pa.array(names, pa.string())
            yield pa.RecordBatch.from_arrays([pc.utf8_slice_codeunits(t, 0, 1), pc.utf8_slice_codeunits(t, 1), pa.array(np.bincount(code, minlength=len(names)).astype(np.int64))], ["kind", "token", "n"])


def token_counts(items: DataFrame) -> DataFrame:
    """(kind, token, n): in how many values a token stands, counted per batch before the shuffle."""
    rows = items.filter("id is not null").select(*FIELDS)
    return rows.mapInArrow(_count, "kind string, token string, n bigint").groupBy("kind", "token").agg(F.sum("n").alias("n"))


def tokens(items: DataFrame, wanted=None) -> DataFrame:
    """(id, field, kind, token): distinct tokens of every value; with wanted, a broadcast of sorted token hashes, only tokens whose
    hash is among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for b in _parts(batches):
            for field in FIELDS:
                row, code, names = _value_tokens(known, b.column(field))
                if wanted is not None:
                    keep = np.isin(_hashes(names), wanted.value)[code] if names else np.array([], bool)
                    row, code = row[keep], code[keep]
                if len(row):
                    t = pa.array(names, pa.string()).take(pa.array(code))
                    yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(row)), pa.array([field] * len(row)), pc.utf8_slice_codeunits(t, 0, 1), pc.utf8_slice_codeunits(t, 1)], ["id", "field", "kind", "token"])

    return items.filter("id is not null").select("id", *FIELDS).mapInArrow(run, "id string, field string, kind string, token string")


class _ByCharacter(dict):
    """Garbled form of each character under a chain that reads single bytes; such a chain garbles a text character by character."""

    def __init__(self, chain):
        self.chain = chain

    def __missing__(self, char: str) -> str | None:
        self[char] = form = garble(char, self.chain)
        return form


def _garblers() -> list:
    def of(chain):
        if all(dec not in ("utf-8", "gbk", "cp932", "big5", "cp949") for _, dec in chain):
            made = _ByCharacter(chain)

            def by_character(word: str) -> str | None:
                parts = [made[c] for c in word]
                return None if None in parts else "".join(parts)

            return by_character
        return lambda word: garble(word, chain)

    return [of(c) for c in CHAINS]


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    garblers = _garblers()
    for b in batches:
        out = []
        for kind, word, n in zip(b["kind"], b["token"], b["n"], strict=True):
            if kind == "g" and not _PAIR.fullmatch(word):
                continue
            for c, garbler in enumerate(garblers):
                form = garbler(word)
                if form is not None and CHAINS[c][-1][0] == "entities":
                    if kind == "r":
                        out.append(("e", form, word, c, n, True))
                    continue
                if form is None or form == word or form.isascii() or (kind == "g" and ("�" in form or len(form) < WINDOWS.start)):
                    continue
                out.append((kind, form, word, c, n, kind == "g" or is_strong(form, word)))
        if out:
            yield pd.DataFrame(out, columns=["kind", "token", "original", "chain", "n_original", "strong"])


def garbled_forms(stats: DataFrame) -> DataFrame:
    """(kind, token, original, chain, strong, n, n_original, chains, n_forms_of): forms that stand in the corpus and are rarer than
    their original, or as rare where they are strong."""
    forms = stats.filter(f"kind <> 'g' or token rlike '^{_PAIR.pattern}$'").repartition(int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token").mapInPandas(_forms, "kind string, token string, original string, chain int, n_original bigint, strong boolean")
    # A word has some thirty forms, of which the planner's estimate knows nothing: it would take them for small and send them all
    # through the driver. Lost and control characters need no comparison: they are no writing in any language.
    met = stats.join(forms.hint("shuffle_merge"), ["kind", "token"]).filter((F.col("n_original") > F.col("n")) | (F.col("strong") & (F.col("n_original") == F.col("n"))) | F.col("token").rlike(_LOST.pattern))
    best = met.groupBy("kind", "token", "n").agg(F.max(F.struct("n_original", (-F.col("chain")).alias("minus"), "original")).alias("b"), F.max("strong").alias("strong"), F.array_distinct(F.collect_list("chain")).alias("chains"), F.size(F.collect_set("original")).alias("n_forms_of"))
    return best.select("kind", "token", "n", "b.n_original", "b.original", (-F.col("b.minus")).alias("chain"), "strong", "chains", "n_forms_of")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(b.column("t").to_pylist()).view(np.int64))], ["h"])


def _wanted(forms: DataFrame):
    """The forms' token hashes for every executor, if a count shows that they are few; else None. Tokens may be as long as a text;
    the driver gets their hashes alone."""
    if forms.limit(MAX_WANTED + 1).count() > MAX_WANTED:
        return None
    h = forms.select(F.concat("kind", "token").alias("t")).mapInArrow(_hashed, "h bigint").toArrow().column("h").to_numpy()
    return forms.sparkSession.sparkContext.broadcast(np.sort(h.view(np.uint64)))


def _broadcast_if_light(forms: DataFrame, max_bytes: int = MAX_FORM_BYTES) -> DataFrame:
    """forms, a checkpoint, marked for broadcast when their rows take at most max_bytes, however long the tokens are; beyond that they
    are joined by a shuffle."""
    fixed = 160  # a row's other columns and its place in the table
    took = forms.agg(F.sum(F.octet_length("token") + F.octet_length("original") + 8 * F.size("chains") + fixed)).first()[0] or 0
    return F.broadcast(forms) if took <= max_bytes else forms.hint("shuffle_merge")


def garbled_tokens(items: DataFrame, share: float = 0.5, stats: DataFrame | None = None) -> DataFrame:
    """(id, field, kind, token, original, chain, n_forms_of) of every garbled token of every value; n_forms_of counts the possible originals."""
    stats = cut(token_counts(items)) if stats is None else stats
    forms = cut(garbled_forms(stats))
    occ = tokens(items, _wanted(forms))
    hit = F.struct("kind", "token", "original", "chain", "chains", "strong", "n_forms_of", ((F.length("token") >= 4) & (F.col("n_original") >= 5 * F.col("n"))).alias("long"))
    # a value's own tokens: bounded by its text
    values = occ.join(_broadcast_if_light(forms), ["kind", "token"]).groupBy("id", "field").agg(F.collect_set(hit).alias("hits"))
    # support of weak forms: a strong form in the same value, or a second form of the same chain
    chains = F.flatten(F.transform(F.filter("hits", lambda x: (x["kind"] == "w") & ~x["strong"]), lambda x: x["chains"]))
    values = values.withColumn("backed", F.exists("hits", lambda x: x["strong"]) | (F.size(chains) > F.size(F.array_distinct(chains))))
    hits = cut(values.select("id", "field", "backed", F.explode("hits").alias("h")).select("id", "field", "backed", "h.*"))
    weak = hits.filter("not strong")
    usual = weak.groupBy("kind", "token").agg(F.avg(F.col("backed").cast("int")).alias("usual")).filter(F.col("usual") >= share).select("kind", "token")
    alone = weak.filter(~(F.col("backed") & (F.length("token") > 1)) & ~F.col("long")).join(broadcast_if_small(cut(usual)), ["kind", "token"], "left_semi")
    cols = ["id", "field", "kind", "token", "original", "chain", "n_forms_of"]
    return hits.filter(F.col("strong") | (F.col("backed") & (F.length("token") > 1)) | F.col("long")).select(*cols).unionByName(alone.select(*cols))


def garbled_values(items: DataFrame) -> DataFrame:
    """Distinct (id, field) of the values that hold garbled text, whether or not it can be restored."""
    return garbled_tokens(items).select("id", "field").distinct()


def _substituted(text: str, subs: dict[str, str]) -> tuple[str, list[str]]:
    """text with originals in place of garbled tokens, at the tokens' own bounds, and the words that still hold a garbled one.

    subs: token with its kind before it -> original, or "" where none is verified. A word that was replaced is not looked at again.
    """
    left = []

    def run(m: re.Match) -> str:
        return subs.get("r" + m[0]) or m[0]

    def word(m: re.Match) -> str:
        w = m[0]
        whole = subs.get("w" + w)
        if whole:
            return whole
        parts = re.split("(\u00a0)", w)
        if len(parts) > 1:
            return "".join(p if p == "\u00a0" else _WORD.sub(word, p) for p in parts)
        made = _RUN.sub(run, w)
        if made == w and any(t in subs for t in _tokens_of(w)):
            left.append(w)
        return made

    text = _ENTITIES.sub(lambda m: subs.get("e" + m[0]) or m[0], text)
    return _WORD.sub(word, text), left


def _subs(pairs) -> dict[str, str]:
    return {x["token"]: x["original"] or "" for x in pairs}


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words that no verified original replaces, undone by the value's own chains, with the tokens that must be the corpus' own."""
    for b in batches:
        out = []
        for ident, field, text, subs, chains in zip(b["id"], b["field"], b["text"], b["subs"], b["chains"], strict=True):
            for w in set(_substituted(text, _subs(subs))[1]):
                for c in chains:
                    back = ungarble(w, CHAINS[c])
                    if back and back != w:
                        runs = _RUN.findall(back)
                        dense = [r for r in runs if len(r) > 1 and not _PLAIN.fullmatch(r)]
                        keys = {"r" + r for r in runs if r not in dense} | {"g" + r[i : i + 2] for r in dense for i in range(len(r) - 1) if _PAIR.match(r, i)}
                        out.append((ident, field, w, back, int(c), sorted(keys)))
        if out:
            yield pd.DataFrame(out, columns=["id", "field", "word", "back", "chain", "keys"])


def _restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for text, subs, more in zip(b["text"], b["subs"], b["more"], strict=True):
            verified = _subs(subs) | {"w" + x["word"]: x["back"] for x in (more if more is not None else ())}
            out.append(_substituted(text, verified)[0])
        yield b[["id", "field", "text"]].assign(restored=out)


def restored_values(items: DataFrame) -> DataFrame:
    """(id, field, text, restored): the affected values with the verified originals put in place of the garbled tokens.

    A garbled word whose original the corpus does not hold is undone by the value's own chains where that gives runs or character
    pairs that are the corpus' own. What was lost beyond recovery stays as it is, and so does a form with lost characters that several
    originals may have left; words without a garbled token are never touched.
    """
    stats = cut(token_counts(items))
    hit = garbled_tokens(items, stats=stats)
    sure = (F.col("kind") != "g") & (F.length("token") > 1) & ((F.col("n_forms_of") == 1) | ~F.contains("token", F.lit("\ufffd")))
    sub = F.struct(F.concat("kind", "token").alias("token"), F.when(sure, F.col("original")).alias("original"))
    subs = hit.groupBy("id", "field").agg(F.collect_list(sub).alias("subs"), F.array_sort(F.collect_set("chain")).alias("chains"))  # a value's own tokens: bounded by its text
    value = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS]))
    texts = items.select("id", value.alias("x")).select("id", "x.*").filter("text is not null").join(subs, ["id", "field"])
    texts = cut(texts.dropDuplicates(["id", "field"]))
    tried = texts.mapInPandas(_candidates, "id string, field string, word string, back string, chain int, keys array<string>")
    known = tried.withColumn("key", F.explode_outer("keys")).join(stats.select(F.concat("kind", "token").alias("key"), F.lit(1).alias("there")), "key", "left")
    held = known.groupBy("id", "field", "word", "chain", "back").agg(F.min(F.coalesce("there", F.lit(0))).alias("all_there")).filter("all_there = 1")
    more = held.groupBy("id", "field", "word").agg(F.min_by("back", "chain").alias("back")).groupBy("id", "field").agg(F.collect_list(F.struct("word", "back")).alias("more"))
    return texts.join(more, ["id", "field"], "left").mapInPandas(_restore, "id string, field string, text string, restored string")
