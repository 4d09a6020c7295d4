"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(source: Column, url: Column) -> Column:
    """First 16 hex digits of SHA-256 of source|url."""
    return F.substring(F.sha2(F.concat_ws("|", source, url), 256), 1, 16)


def text_hash(text: Column) -> Column:
    """First 16 hex digits of SHA-256 of the text without surrounding white space."""
    return F.substring(F.sha2(F.regexp_replace(text, r"^\s+|\s+$", ""), 256), 1, 16)


def norm(text: Column) -> Column:
    """Lower case; everything but a-z, 0-9 and white space becomes a space; spaces collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " "), r"\s+", " "))


def shingles(text: Column, k: int = 3) -> Column:
    """Distinct character k-grams of the normalised text without spaces; a shorter text is one shingle."""
    s = F.replace(norm(text), F.lit(" "), F.lit(""))
    return F.when(F.length(s) <= k, F.array(s)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substr(s, i, F.lit(k)))))


def without_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def apex(url: Column) -> Column:
    """Last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


def slash_depth(url: Column) -> Column:
    return F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit("")))


def hit_count(text: Column, cue: Column | str) -> Column:
    """Occurrences of cue in text that do not overlap."""
    cue = F.lit(cue) if isinstance(cue, str) else cue
    return F.when(F.length(cue) > 0, ((F.length(text) - F.length(F.replace(text, cue, F.lit("")))) / F.length(cue)).cast("bigint")).otherwise(0)


# What promotional titles carry around their core, in the order in which it is taken off.
TITLE_STRIPS = (
    r"^\s*[\w .&'-]{1,40}?\s+\d{1,2}[/.-]\d{1,2}(?:[/.-]\d{2,4})?\s*[:|–-]\s*",
    r"\[[^\]]*\]",
    r"(?i)[\s:–-]*\b(?:only\s+)?\d+\s+(?:days?|hours?|weeks?)\s+(?:left|to go|remaining)\b.*$",
    r"(?i)[\s:–-]*\b(?:register|sign up|book|save your seat|last chance|early bird)\b.*$",
    r"(?i)^\s*(?:only\s+)?\d+\s+(?:days?|hours?|weeks?)\b\s*",
)


def title_signature(title: Column) -> Column:
    """First eight normalised words of a title without prefix dates, tags, countdowns and promotion tails."""
    t = title
    for strip in TITLE_STRIPS:
        t = F.regexp_replace(t, strip, " ")
    return F.array_join(F.slice(F.split(norm(t), " "), 1, 8), " ")


def augmented(title: Column, body: Column, entities: Column) -> Column:
    """norm(title) norm(body) and one ent_<name> word per entity of an array of names."""
    ents = F.transform(F.array_sort(entities), lambda e: F.concat(F.lit("ent_"), F.replace(F.lower(e), F.lit(" "), F.lit("_"))))
    return F.concat_ws(" ", norm(title), norm(F.coalesce(body, F.lit(""))), F.array_join(ents, " "))


def sentences(text: Column) -> Column:
    """Sentences of a text: parted after . ! or ? with white space following; trimmed, none empty."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def json_object(text: Column, schema: str) -> Column:
    """The outermost {...} of a reply, parsed; NULL where there is none or it does not parse."""
    return F.from_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")), schema)


def labelled_objects(text: Column) -> Column:
    """array<struct<label, descriptor>> of a reply's outermost {...} that maps labels to descriptors; entries that lack one are dropped."""
    found = F.coalesce(json_object(text, "map<string,string>"), F.create_map().cast("map<string,string>"))
    each = F.transform(F.map_entries(found), lambda e: F.struct(F.trim(e["key"]).alias("label"), F.trim(e["value"]).alias("descriptor")))
    return F.filter(each, lambda e: (e["label"] != "") & (F.coalesce(e["descriptor"], F.lit("")) != ""))
