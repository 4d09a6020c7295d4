"""Texts cut off by field limits or in transfer.

Method, in pure SQL: word trigrams are counted inside lines and at their ends over all texts; each value's final trigram is joined
to the counts, and values are flagged whose final trigram is frequent inside texts but almost never ends one. A last word cut in
two is matched as a prefix of the words that follow its neighbours elsewhere.

"Almost never" is a ratio of shares, so that it means the same at every size: the share of line ends that the trigram makes, over the
share of places inside lines that it makes. A rare trigram leans on its last two words, these on the last, this on the shape of its
last character. The ratio is weighed by the odds that a value of this length of this source is cut, which are estimated from the
ratios themselves (texts cut at a field's limit have one length); at even odds and above a value is flagged.

Titles, lines of prose and other lines have ends of their own, since each kind ends differently. Words keep their punctuation, so
that a full stop makes another trigram; numbers, and words that begin with a capital, count as one kind each, and characters of
scripts without spaces are words of their own. A line's first words stand in trigrams with its start. Before the end is looked at,
marks and link texts put after a cut are taken off (they prove nothing by themselves), and so are closing lines repeated throughout
the source, the item's own title in them left aside; lines are read from the end until one stays.

Defined results: NULL and blank values, and values that are nothing but a mark or repeated lines, are not flagged; repeated rows
of an id count once, with their own ends left out of the count; an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut, fence

#: Share of values taken to be cut before anything is known of a length; occurrences that a shorter context counts for; values that
#: the general share counts for at a length.
CUT_SHARE, LEAN, LEAN_LENGTH = 0.04, 3.0, 4.0
#: Lines of a text that are read from its end at a time.
TAIL = 8
#: A line of prose has so many characters, or goes on after the end of a sentence.
PROSE_CHARS, GOES_ON = 160, r"\p{L}[.!?][\"”’»)]*[ \t\u00a0].*\p{L}|。.*\p{L}"

# Marks and link texts that feeds put after a cut.
MARKS = (
    r"(?iu)(?:\s*(?:…|\.{2,}|[\[(]\s*(?:…|\.{2,}|more|mehr|suite|más|mais|\+)\s*[\])]"
    r"|(?:read|continue|see|view|show) (?:more|on|reading|the full (?:story|article))|read the rest|full story|weiter(?:lesen)?|mehr lesen|lire (?:la suite|plus)|leer más|seguir leyendo|leia mais|continuar? lendo|ler mais|читать (?:далее|дальше|полностью)|続きを読む|もっと見る|click here"
    r"|[→»›]+|(?<=\s)>+|&(?:#\d{0,5}|[a-z]{0,6});?))+\s*$"
)
# What every mark has among its last characters.
MAY_BE_MARKED = r"(?iu)[…\])»›→>;&]|\.\.|(?:more|on|reading|story|article|rest|weiter|lesen|suite|plus|más|leyendo|mais|lendo|далее|дальше|полностью|読む|見る|here)$"
#: Characters at a line's end in which marks are looked for.
MARK_CHARS = 120

_CJK = r"぀-ヿ㐀-鿿"
_BLANKS = " \t\r\u00a0"


def _trim(x: Column) -> Column:
    return F.btrim(x, F.lit(_BLANKS))


def _is_prose(x: Column) -> Column:
    return (F.length(x) >= PROSE_CHARS) | x.rlike(GOES_ON)


def _masked_words(x: Column) -> Column:
    """Words of a trimmed line: numbers as 9, runs of words with a capital as N, characters of dense scripts by themselves."""
    name = rf"[\p{{L}}\p{{M}}&&[^{_CJK}]]"
    m = F.regexp_replace(F.regexp_replace(x, r"\p{N}+(?:[.,]\p{N}+)*", "9"), rf"\p{{Lu}}{name}*(?:[\s\u00a0]+\p{{Lu}}{name}*)*", "N")
    dense = (F.octet_length(x) > F.length(x)) & x.rlike(f"[{_CJK}]")
    return F.split(F.when(dense, _trim(F.regexp_replace(m, f"([{_CJK}])", " $1 "))).otherwise(m), "[\\s\u00a0]+")


def _shape(w: str) -> Column:
    """Shape of a word's end: a capital or number, a letter, a stop, another sign."""
    return F.when(F.col(w).isin("N", "9"), "n").when(F.col(w).rlike(r"[\p{L}\p{M}\p{N}]$"), "w").when(F.col(w).rlike(r"[.!?。！？][\"'”’»“」』)]*$"), "s").otherwise("o")


def trigram_counts(items: DataFrame) -> DataFrame:
    """(title, h2, h1, w3, inside, ends, ends_prose) of titles and of lines of bodies: counts of trigrams, by hashes of the first two
    words and of the second, and the third."""
    rows = items.filter("id is not null")
    lines = rows.select(F.lit(True).alias("title"), F.explode(F.split("title", "\n", -1)).alias("x")).unionByName(rows.select(F.lit(False).alias("title"), F.explode(F.split("body", "\n", -1)).alias("x")))
    lines = fence(lines.select("title", _trim(F.col("x")).alias("x"))).filter("x <> ''")
    bare = F.when(F.endswith("x", F.lit("…")) | F.endswith("x", F.lit("..")), F.regexp_replace("x", r"[\s\u00a0]*(?:…|\.{2,})$", "")).otherwise(F.col("x"))
    lines = fence(lines.select("title", bare.alias("x")))
    end = F.when(~F.col("title") & _is_prose(F.col("x")), "§").otherwise("¶")
    words = fence(lines.select("title", F.concat(F.array(F.lit("¶"), F.lit("¶")), _masked_words(F.col("x")), F.array(end)).alias("w")))
    # four shifted copies side by side: compiled code makes the rows, no function is interpreted per word
    shifted = [F.slice("w", F.lit(i), F.size("w") - 3).alias(n) for i, n in enumerate(("a", "b", "w3", "e"), 1)]
    each = words.filter("size(w) > 3").select("title", F.inline(F.arrays_zip(*shifted))).toDF("title", "a", "b", "w3", "e")
    each = each.select("title", F.xxhash64("a", "b").alias("h2"), F.xxhash64("b").alias("h1"), "w3", "e")
    counts = each.groupBy("title", "h2", "h1", "w3").agg(F.count("*").alias("all"), F.count_if(F.col("e") == "¶").alias("ends"), F.count_if(F.col("e") == "§").alias("ends_prose"))
    return counts.select("title", "h2", "h1", "w3", (F.col("all") - F.col("ends") - F.col("ends_prose")).alias("inside"), "ends", "ends_prose")


def _bare(x: Column) -> Column:
    """A line without blanks and marks at its end."""
    head, tail = F.substring(x, F.lit(1), F.greatest(F.length(x) - MARK_CHARS, F.lit(0))), F.right(x, F.lit(MARK_CHARS))
    return F.when(F.right(x, F.lit(12)).rlike(MAY_BE_MARKED), _trim(F.concat(head, F.regexp_replace(tail, MARKS, "")))).otherwise(x)


def contents(items: DataFrame) -> DataFrame:
    """(id, source, field, chars, last): the last line of each value's content, marks and repeated closing lines taken off."""
    rows = items.filter("id is not null").select("id", "source", "title", "body")
    title = rows.select("id", "source", F.lit("title").alias("field"), F.length("title").cast("bigint").alias("chars"), _bare(_trim(F.col("title"))).alias("last"))
    kept = F.filter(F.split("body", "\n", -1), lambda x: _trim(x) != "")
    bodies = fence(rows.filter("body is not null").select("id", "source", "title", F.length("body").cast("bigint").alias("chars"), kept.alias("kept"))).filter("size(kept) > 0")
    n_rows = cut(rows.filter("source is not null").groupBy("source").agg(F.count("*").alias("n_rows")))
    found, at = [title], 0
    while True:
        # lines at, at + 1, ... from the end
        low, high = F.greatest(F.size("kept") - at - TAIL, F.lit(0)), F.greatest(F.size("kept") - at, F.lit(0))
        lines = F.slice("kept", low + 1, high - low)
        part = fence(bodies.select("id", "source", "title", "chars", (low > 0).alias("more"), lines.alias("lines")))
        letters = lambda x: F.regexp_replace(F.lower(F.when(F.length("title") > 0, F.replace(x, F.col("title"), F.lit(""))).otherwise(x)), r"[^\p{L}]+", "")
        keyed = F.transform("lines", lambda x: F.struct(x.alias("x"), letters(x).alias("k")))
        keyed = F.transform(keyed, lambda p: F.struct(p["x"], F.when(p["k"] != "", F.xxhash64(p["k"])).alias("k")))
        part = cut(part.select("id", "source", "chars", "more", keyed.alias("lines")))
        keys = part.filter("source is not null").select("source", F.explode(F.array_distinct(F.transform("lines", lambda p: p["k"]))).alias("key")).filter("key is not null")
        counted = keys.groupBy("source", "key").agg(F.count("*").alias("n")).filter("n >= 3").join(broadcast_if_small(n_rows), "source").filter("n >= 0.05 * n_rows")
        # each set is bounded: its lines stand in a twentieth of the source's items each
        sets = broadcast_if_small(cut(counted.groupBy(F.col("source").alias("__src")).agg(F.collect_set("key").alias("__keys"))), 20_000)
        own = F.filter("lines", lambda p: p["k"].isNull() | ~F.coalesce(F.array_contains(F.col("__keys"), p["k"]), F.lit(False)))
        part = fence(part.join(sets, F.col("source") == F.col("__src"), "left").select("id", "source", "chars", "more", F.transform(own, lambda p: _trim(p["x"])).alias("own")))
        part = fence(part.select("id", "source", "chars", "more", "own", _bare(F.try_element_at("own", F.lit(-1))).alias("last")))
        # where the last line is nothing but marks, the one before
        others = F.try_element_at(F.filter(F.transform("own", _bare), lambda x: x.rlike(r"[\p{L}\p{N}]")), F.lit(-1))
        part = cut(part.select("id", "source", "chars", "more", F.when(F.col("last").rlike(r"[\p{L}\p{N}]"), F.col("last")).otherwise(others).alias("last")))
        found.append(part.filter("last is not null").select("id", "source", F.lit("body").alias("field"), "chars", "last"))
        left = part.filter("last is null and more").select("id").distinct()
        if left.limit(1).count() == 0:
            break
        bodies, at = bodies.join(left, "id", "left_semi"), at + TAIL
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return every.filter(F.col("last").rlike(r"[\p{L}\p{N}]"))


def endings(items: DataFrame) -> DataFrame:
    """(id, source, field, chars, title, prose, rows, h2, h1, w3): the final trigram of each value's content."""
    vals = contents(items).withColumn("title", F.col("field") == "title")
    vals = vals.withColumn("prose", ~F.col("title") & _is_prose(F.col("last")))
    vals = fence(vals.select("id", "source", "field", "chars", "title", "prose", F.concat(F.array(F.lit("¶"), F.lit("¶")), _masked_words(F.col("last"))).alias("w")))
    at = lambda k: F.element_at("w", F.lit(k))
    final = vals.select("id", "source", "field", "chars", "title", "prose", F.xxhash64(at(-3), at(-2)).alias("h2"), F.xxhash64(at(-2)).alias("h1"), at(-1).alias("w3"))
    return final.groupBy("id", "field", "title", "prose", "h2", "h1", "w3").agg(F.count("*").alias("rows"), F.min("source").alias("source"), F.min("chars").alias("chars"))


def _level(counts: DataFrame, asked: DataFrame, context: list[str], name: str) -> DataFrame:
    """asked with the counts of its last word after the context: inside, begun (longer words that the last one begins), and ends."""
    key = [*context, "w3"]
    c = counts.groupBy(*key).agg(*[F.sum(x).alias(x) for x in ("inside", "ends", "ends_prose")]) if name != "n3" else counts
    want = asked.select(*key).distinct()
    exact = want.join(c, key, "left")
    longer = c.join(want.select(*context).distinct(), context, "left_semi").filter(F.length("w3") > 1)
    prefixes = longer.select(*context, (F.col("inside") + F.col("ends") + F.col("ends_prose")).alias("n"), F.explode(F.sequence(F.lit(1), F.length("w3") - 1)).alias("k"), F.col("w3").alias("longer"))
    prefixes = prefixes.select(*context, F.substring("longer", F.lit(1), F.col("k")).alias("w3"), "n").join(want, key, "left_semi")
    begun = prefixes.groupBy(*key).agg(F.sum("n").alias("begun"))
    zero = lambda x: F.coalesce(x, F.lit(0))
    made = exact.join(begun, key, "left").select(*key, (zero("inside") + zero("begun")).alias(name), zero("ends").alias(f"{name}_ends"), zero("ends_prose").alias(f"{name}_ends_prose"))
    return asked.join(made, key)


def truncated(items: DataFrame, cut_share: float = CUT_SHARE, lean: float = LEAN, lean_length: float = LEAN_LENGTH, rounds: int = 3) -> DataFrame:
    """(id, source, field, chars, prose, ratio, odds, is_cut) of every value with content; ratio is the trigram's share of the places
    inside lines over its share of the ends, odds those that the value is cut."""
    counts = cut(trigram_counts(items))
    final = cut(endings(items))
    asked = final.select("title", "h2", "h1", "w3").distinct()
    for name, context in (("n1", ["title"]), ("n2", ["title", "h1"]), ("n3", ["title", "h2", "h1"])):
        asked = cut(_level(counts, asked, context, name))
    shapes = counts.groupBy("title", _shape("w3").alias("shape")).agg(F.sum("inside").alias("n0"), F.sum("ends").alias("n0_ends"), F.sum("ends_prose").alias("n0_ends_prose"))
    all_of = shapes.groupBy("title").agg(F.sum("n0").alias("n"), F.sum("n0_ends").alias("n_ends"), F.sum("n0_ends_prose").alias("n_ends_prose"))
    # at most eight rows, and two
    v = final.join(asked, ["title", "h2", "h1", "w3"]).withColumn("shape", _shape("w3")).join(F.broadcast(shapes), ["title", "shape"]).join(F.broadcast(all_of), "title")
    e = lambda name: F.when(F.col("prose"), F.col(f"{name}_ends_prose")).otherwise(F.col(f"{name}_ends"))
    rate = e("n") / F.greatest(F.col("n"), F.lit(1))
    leaned = rate
    for name in ("n0", "n1", "n2", "n3"):
        own = F.greatest(e(name) - F.col("rows"), F.lit(0))
        leaned = (own + lean * leaned) / (F.col(name) + lean)
    v = cut(v.select("id", "source", "field", "chars", "prose", (rate / leaned).alias("ratio")))
    # how many values of a length are cut, from the values' own odds
    share = F.lit(cut_share)
    for _ in range(rounds):
        odds = v.withColumn("p", F.col("ratio") * share / (1 - share + F.col("ratio") * share)) if _ == 0 else odds
        at = odds.groupBy(F.col("source").alias("__s"), F.col("field").alias("__f"), F.col("chars").alias("__c")).agg(((F.sum("p") + lean_length * cut_share) / (F.count("*") + lean_length)).alias("share"))
        odds = v.join(at, F.col("source").eqNullSafe(F.col("__s")) & (F.col("field") == F.col("__f")) & (F.col("chars") == F.col("__c")))
        odds = cut(odds.withColumn("odds", F.col("ratio") * F.col("share") / (1 - F.col("share"))).withColumn("p", F.col("odds") / (1 + F.col("odds"))))
    return odds.select("id", "source", "field", "chars", "prose", F.round("ratio", 6).alias("ratio"), F.round("odds", 6).alias("odds"), (F.col("odds") >= 1).alias("is_cut"))


def truncation_by_source(items: DataFrame) -> DataFrame:
    """(source, n_items, n_cut, share): how many of a source's items have a cut title or body."""
    n = items.filter("id is not null and source is not null").select("source", "id").distinct().groupBy("source").agg(F.count("*").alias("n_items"))
    c = truncated(items).filter("is_cut").select("source", "id").distinct().groupBy("source").agg(F.count("*").alias("n_cut"))
    return n.join(c, "source", "left").select("source", "n_items", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), F.round(F.coalesce("n_cut", F.lit(0)) / F.col("n_items"), 6).alias("share"))
