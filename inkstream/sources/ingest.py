"""Landed feeds, mail and newsroom pages as item rows. Fetching stays outside Spark; what it lands is read here."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import apex, host, item_id, slash_depth, without_query
from . import html

#: Characters kept of a body, and of a mail's subject.
BODY_CHARS, SUBJECT_CHARS = 4000, 500

def _per_row(fn, returns):
    @F.pandas_udf(returns)
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*x) for x in zip(*cols, strict=True)])

    return run


def clean_html(col):
    return _per_row(html.clean_html, "string")(col)


def read_feed(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """Landed RSS or Atom files, one row an entry, with the file's path."""
    fields = "title string, link string, description string, summary string, content string, pubDate string, published string, updated string"
    return spark.read.format("xml").option("rowTag", tag).schema(fields).load(path).withColumn("path", F.input_file_name())


def feed_items(entries: DataFrame, now: str) -> DataFrame:
    """Item rows of feed entries (source, title, link, summary, content, published, updated): entries without link or title are left
    out, the body is the cleaned summary or else content, the time is published, updated or now."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    e = entries.select("source", some("title").alias("title"), some(without_query(F.col("link"))).alias("url"), F.coalesce(some(clean_html("summary")), some(clean_html("content")), F.lit("")).alias("body"), F.coalesce(some("published"), some("updated"), F.lit(now)).alias("ts"))
    return _rows(e.filter("title is not null and url is not null"), now)


def _rows(e: DataFrame, now: str) -> DataFrame:
    return e.select(item_id(F.col("source"), F.col("url")).alias("id"), "source", "title", "url", F.substring("body", 1, BODY_CHARS).alias("body"), "ts", F.lit(now).alias("ingested_at"))


def classify_sender(mails: DataFrame, senders: DataFrame, default: str = "mail") -> DataFrame:
    """mails (mail_id, sender, ...) with source: the first configured sender (ord, source, domain) whose domain the address contains.
    The configuration is a few rows."""
    j = mails.join(F.broadcast(senders.select("ord", F.col("source").alias("__s"), "domain")), F.contains(F.lower("sender"), F.col("domain")), "left")
    first = j.groupBy("mail_id").agg(F.min_by("__s", "ord").alias("source"))
    return mails.join(first, "mail_id", "left").withColumn("source", F.coalesce("source", F.lit(default)))


def mail_links(mails: DataFrame, shortest: int = 20, longest: int = 250) -> DataFrame:
    """(mail_id, source, url, title, subject) of mails (mail_id, source, subject, payload): http links whose text is longer than
    `shortest` and shorter than `longest`, the first of each URL."""
    links = _per_row(lambda p: [{"href": a, "text": b} for a, b in html.anchors(html.mail_html(p))], "array<struct<href:string,text:string>>")
    e = mails.select("mail_id", "source", F.substring("subject", 1, SUBJECT_CHARS).alias("subject"), F.posexplode(links("payload")).alias("pos", "a")).select("mail_id", "source", "subject", "pos", F.col("a.href").alias("url"), F.col("a.text").alias("title"))
    e = e.filter(F.col("url").startswith("http") & (F.length("title") > shortest) & (F.length("title") < longest))
    return e.withColumn("n", F.row_number().over(Window.partitionBy("mail_id", "url").orderBy("pos"))).filter("n = 1").drop("n")


def page_links(pages: DataFrame, skip: Sequence[str] = (), hints: Sequence[str] = (), shortest: int = 20, longest: int = 350, top: int = 14) -> DataFrame:
    """(source, url, title, place) of index pages (source, base, html): links of the same apex that look like articles, the top by hint,
    depth, text and url, all descending.

    skip: parts of an href that lead to no article; hints: parts of a URL that suggest one. Both are the caller's configuration, made
    for the pages at hand.
    """
    from urllib.parse import urljoin

    found = _per_row(lambda h, b: [{"href": a, "url": urljoin(b, a), "text": t} for a, t in html.anchors(h)], "array<struct<href:string,url:string,text:string>>")
    e = pages.select("source", "base", F.explode(found("html", "base")).alias("a")).select("source", "base", F.lower("a.href").alias("href"), F.rtrim(without_query(F.col("a.url")), F.lit("/")).alias("url"), F.trim("a.text").alias("title"))
    skipped = F.lit(False)
    for t in skip:
        skipped = skipped | F.contains("href", F.lit(t.lower()))
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*(/.*)?$", 1)
    e = e.filter(~skipped & F.length("title").between(shortest, longest) & (apex(F.col("url")) == apex(F.col("base"))) & (path != "") & (F.col("url") != F.rtrim(F.col("base"), F.lit("/"))) & (host(F.col("url")) != ""))
    one = e.groupBy("source", "url").agg(F.max("title").alias("title"))
    hint = F.lit(False)
    for h in hints:
        hint = hint | F.contains(F.lower("url"), F.lit(h.lower()))
    w = Window.partitionBy("source").orderBy(F.desc(hint), F.desc(slash_depth(F.col("url"))), F.desc("title"), F.desc("url"))
    return one.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)


def state_links(pages: DataFrame, titles: Sequence[str] = ("title",), urls: Sequence[str] = ("url",)) -> DataFrame:
    """(source, url, title) from the pages' embedded JSON state; titles and urls are the keys that the pages use, first match first."""
    found = _per_row(lambda h, b: [{"url": u, "title": t} for u, t in html.state_links(h, b, tuple(titles), tuple(urls))], "array<struct<url:string,title:string>>")
    return pages.select("source", F.explode(found("html", "base")).alias("a")).select("source", "a.url", "a.title").distinct()


def unknown_links(links: DataFrame, items: DataFrame, per_source: int = 6) -> DataFrame:
    """Links whose URL is not stored, the first few of each source."""
    new = links.join(items.select("url").distinct(), "url", "left_anti")
    w = Window.partitionBy("source").orderBy("place", "url")
    return new.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= per_source).drop("n")


def article_items(articles: DataFrame, now: str, blocks: Sequence[str] = ()) -> DataFrame:
    """Item rows of fetched articles (source, url, title, html); blocks: where the pages at hand keep their article, as in
    html.article_body."""
    body = _per_row(lambda h: html.article_body(h, tuple(blocks)), "string")
    return _rows(articles.select("source", "title", "url", body("html").alias("body"), F.lit(now).alias("ts")), now)
