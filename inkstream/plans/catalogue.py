"""Registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import weeks as W
from ..operators import bank as BK
from ..operators import cluster as C
from ..operators import context as CX
from ..operators import digest as D
from ..operators import entities as E
from ..operators import longitudinal as L
from ..operators import retrieve as R
from ..operators import selection as SE
from ..operators import sentences as SN
from ..operators import signals as S
from ..operators import store as ST
from ..operators import vectorize as V
from ..operators import weights as WT
from ..operators.instants import item_instants, noncanonical_instants
from ..session import cut, table
from ..sources import ingest as IG
from . import report as RP

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name, with the SQL that must give the same rows."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@query()
def p2_found(spark, sf_dir):
    return noncanonical_instants(table(spark, sf_dir, "items"), table(spark, sf_dir, "sources"))


# ---------------------------------------------------------------------------------------------------------------------------------
# Queries of the reference's own operators. Tables the data lacks are derived alike in both engines: entity history from events,
# the coverage ledger from line items, clusters and topics from the embeddings' labels.

NOW = "2026-06-28 12:00:00"
WEEK = "2026-W26"


def _items(spark, sf_dir):
    return table(spark, sf_dir, "items")


def _one_item(items):
    """One row an id: the first stored."""
    cols = ("ingested_at", "source", "title", "url", "body", "ts")
    one = items.groupBy("id").agg(F.min(F.struct(*cols)).alias("r"), F.max("used_in_digest").alias("used_in_digest"))
    return one.select("id", *[f"r.{c}" for c in ("source", "title", "url", "body", "ts", "ingested_at")], "used_in_digest")


ITEM1 = "(SELECT id, r.source AS source, r.title AS title, r.url AS url, r.body AS body, r.ts AS ts, r.ingested_at AS ingested_at, used_in_digest FROM (SELECT id, min(struct_pack(ingested_at := ingested_at, source := source, title := title, url := url, body := body, ts := ts)) AS r, max(used_in_digest) AS used_in_digest FROM items GROUP BY id))"
SIG1 = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY week, topic_id ORDER BY score DESC NULLS LAST, coverage DESC NULLS LAST, relevance DESC NULLS LAST) AS rn FROM cluster_signals) WHERE rn = 1)"""
HIST = "(SELECT event_type || '#' || (user_id % 20) AS entity, strftime(ts, '%Y-W%V') AS week, count(*) AS count FROM events GROUP BY ALL)"
LEDGER = "(SELECT week, aspect, n * 1.0 / max(n) OVER (PARTITION BY week) AS coverage FROM (SELECT strftime(l_shipdate, '%Y-W%V') AS week, p_type AS aspect, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))"


def _monday(label: str) -> str:
    d = f"(make_date(try_cast({label}[1:4] AS INT), 1, 4) - CAST(isodow(make_date(try_cast({label}[1:4] AS INT), 1, 4)) - 1 AS INT) + (try_cast({label}[7:8] AS INT) - 1) * 7)"
    return f"(CASE WHEN regexp_full_match({label}, '\\d{{4}}-W\\d{{2}}') AND try_cast({label}[7:8] AS INT) BETWEEN 1 AND 53 AND strftime({d}, '%G-W%V') = {label} THEN {d} END)"


def _between(later: str, earlier: str) -> str:
    return f"coalesce(greatest(0, CAST(floor(date_diff('day', {_monday(earlier)}, {_monday(later)}) / 7.0) AS BIGINT)), 0)"


def _norm_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _hist(spark, sf_dir):
    return E.history(table(spark, sf_dir, "events").select(F.concat(F.col("event_type"), F.lit("#"), (F.col("user_id") % 20).cast("string")).alias("entity"), W.week_key(F.col("ts")).alias("week")))


def _ledger(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    n = j.groupBy(W.week_key(F.col("l_shipdate")).alias("week"), F.col("p_type").alias("aspect")).agg(F.count("*").alias("n"))
    top = n.groupBy("week").agg(F.max("n").alias("top"))
    return n.join(top, "week").select("week", "aspect", (F.col("n") / F.col("top")).alias("coverage"))


def _r(c, n=6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


@query(f"SELECT id, source, url, substring(sha256(source || '|' || url), 1, 16) AS made_id, id = substring(sha256(source || '|' || url), 1, 16) AS same FROM {ITEM1}")
def item_identity(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir))
    made = X.item_id(F.col("source"), F.col("url"))
    return i.select("id", "source", "url", made.alias("made_id"), (F.col("id") == made).alias("same"))


@query(f"SELECT id, {_norm_sql('title')} AS title_norm, md5({_norm_sql('coalesce(body, chr(32))')}) AS body_norm_md5 FROM {ITEM1}")
def norm_text(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir))
    return i.select("id", X.norm(F.col("title")).alias("title_norm"), F.md5(X.norm(F.coalesce("body", F.lit(" ")))).alias("body_norm_md5"))


@query(f"SELECT doc_id, substring(sha256(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), 1, 16) AS h FROM documents")
def profile_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.text_hash(F.col("text")).alias("h"))


@query(f"""SELECT id, array_to_string(list_sort(list_distinct(CASE WHEN length(s) <= 3 THEN [s] ELSE [substring(s, i, 3) for i in range(1, CAST(length(s) AS BIGINT) - 1)] END)), ',') AS grams
FROM (SELECT id, replace({_norm_sql('title')}, ' ', '') AS s FROM {ITEM1})""")
def title_shingles(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", F.array_join(F.array_sort(X.shingles(F.col("title"))), ",").alias("grams"))


def _signature_sql(x: str) -> str:
    for s in X.TITLE_STRIPS:
        x = f"regexp_replace({x}, '{s.replace(chr(39), chr(39) * 2)}', ' ', 'g')"
    return f"array_to_string(string_split({_norm_sql(x)}, ' ')[1:8], ' ')"


@query(f"SELECT id, {_signature_sql('title')} AS signature FROM {ITEM1}")
def title_signature(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", X.title_signature(F.col("title")).alias("signature"))


@query(f"SELECT id, substring(body, 1, 4000) AS body_4000, substring(title, 1, 300) AS title_300 FROM {ITEM1}")
def text_prefix(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", F.substring("body", 1, 4000).alias("body_4000"), F.substring("title", 1, 300).alias("title_300"))


@query(f"SELECT id, split_part(url, '?', 1) AS bare, length(url) - length(replace(url, '/', '')) AS depth, array_to_string(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '.')[-2:], '.') AS apex FROM {ITEM1}")
def url_parts(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", X.without_query(F.col("url")).alias("bare"), X.slash_depth(F.col("url")).cast("bigint").alias("depth"), X.apex(F.col("url")).alias("apex"))


@query(f"SELECT id, CAST((length(t) - length(replace(t, 'launch', ''))) / 6 AS BIGINT) AS launches, CAST((length(t) - length(replace(t, 'a', ''))) AS BIGINT) AS as_ FROM (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(body, '')) AS t FROM {ITEM1})")
def cue_hits(spark, sf_dir):
    t = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit(""))))
    return _one_item(_items(spark, sf_dir)).select("id", X.hit_count(t, "launch").alias("launches"), X.hit_count(t, "a").alias("as_"))


CUES = {"adtech": ["measurement", "programmatic", "bidding", "identity"], "streaming": ["stream", "subscri", "sports"], "retail": ["retail", "commerce", "loyalty"], "audio": ["podcast", "audio"]}


def _category_sql() -> str:
    hits = {k: " + ".join(f"CAST((length(t) - length(replace(t, '{c}', ''))) / {len(c)} AS BIGINT)" for c in v) for k, v in CUES.items()}
    cols = ", ".join(f"{h} AS {k}" for k, h in hits.items())
    best = f"greatest({', '.join(CUES)})"
    return f"SELECT id, CASE WHEN {best} = 0 THEN 'market' {' '.join(f'WHEN {k} = {best} THEN {chr(39)}{k}{chr(39)}' for k in CUES)} END AS category FROM (SELECT id, {cols} FROM (SELECT id, lower(coalesce(title, '') || ' ' || substring(coalesce(body, ''), 1, 300)) AS t FROM {ITEM1}))"


@query(_category_sql())
def item_category(spark, sf_dir):
    t = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.substring(F.coalesce("body", F.lit("")), 1, 300)))
    return S.category(_one_item(_items(spark, sf_dir)).select("id", t.alias("text")), CUES, "market")


@query(f"SELECT i.id, coalesce(s.sector, 'other') AS sector, coalesce(s.prior, 1.0) AS prior FROM {ITEM1} i LEFT JOIN (SELECT source, max(sector) AS sector, max(prior) AS prior FROM sources GROUP BY source) s USING (source)")
def source_sector_default(spark, sf_dir):
    dim = table(spark, sf_dir, "sources").groupBy("source").agg(F.max("sector").alias("sector"), F.max("prior").alias("prior"))
    return _one_item(_items(spark, sf_dir)).join(dim, "source", "left").select("id", F.coalesce("sector", F.lit("other")).alias("sector"), F.coalesce("prior", F.lit(1.0)).alias("prior"))


@query(f"""WITH m AS (SELECT regexp_extract(ingested_at, '^\\d{{4}}-\\d{{2}}') AS cluster, coalesce(s.sector, 'other') AS sector FROM {ITEM1} i LEFT JOIN sources s USING (source)),
n AS (SELECT cluster, sector, count(*) AS n FROM m GROUP BY ALL), o AS (SELECT sector, row_number() OVER (ORDER BY sector) AS ord FROM (SELECT DISTINCT sector FROM sources WHERE sector IS NOT NULL))
SELECT cluster, sector FROM (SELECT cluster, n.sector, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, ord NULLS LAST, n.sector) AS k FROM n LEFT JOIN o USING (sector)) WHERE k = 1""")
def cluster_sector(spark, sf_dir):
    src = table(spark, sf_dir, "sources")
    order = src.filter("sector is not null").select("sector").distinct().withColumn("ord", F.row_number().over(Window.orderBy("sector")))
    return S.sector_majority(_one_item(_items(spark, sf_dir)).select(F.regexp_extract("ingested_at", r"^\d{4}-\d{2}", 0).alias("cluster"), "source"), src, order, "other")


@query("""WITH b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at, url, used_in_digest) AS n FROM items)
SELECT id, source, url, ingested_at FROM b WHERE n = 1 AND source NOT IN (SELECT source FROM sources WHERE kind = 'mail')""")
def insert_or_ignore(spark, sf_dir):
    """The mail sources' items are stored already; all items come in."""
    items, mail = _items(spark, sf_dir), table(spark, sf_dir, "sources").filter("kind = 'mail'").select("source").distinct()
    return ST.insert_or_ignore(items.join(mail, "source", "left_semi"), items, "id", ["ingested_at", "url", "used_in_digest"]).select("id", "source", "url", "ingested_at")


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END DESC, o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def upsert_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return ST.upsert(o.filter("o_orderstatus <> 'O'"), o.filter("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"SELECT id, source, coalesce(used_in_digest, false) OR source IN (SELECT source FROM sources WHERE kind = 'newsroom') AS used_in_digest FROM {ITEM1}")
def mark_used(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir))
    ids = i.join(table(spark, sf_dir, "sources").filter("kind = 'newsroom'").select("source").distinct(), "source", "left_semi")
    return ST.mark_used(i, ids).select("id", "source", "used_in_digest")


@query("""SELECT url, CASE WHEN length(url) % 3 = 0 THEN etag WHEN length(url) % 3 = 1 THEN 'new' ELSE etag END AS etag, CASE WHEN length(url) % 3 = 1 THEN NULL ELSE last_modified END AS last_modified,
CASE WHEN length(url) % 3 = 2 THEN checked_at ELSE TIMESTAMP '2026-07-01 00:00:00' END AS checked_at FROM feed_cache""")
def feed_cache_refresh(spark, sf_dir):
    c = table(spark, sf_dir, "feed_cache")
    k = F.length("url") % 3
    got = c.select("url", F.when(k == 0, 304).when(k == 1, 200).alias("status"), F.when(k == 1, "new").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit("2026-07-01 00:00:00").cast("timestamp_ntz").alias("checked_at"))
    return ST.refresh_validators(c, got)


@query("SELECT s.url, f.etag, f.last_modified FROM (SELECT DISTINCT url FROM sources) s LEFT JOIN feed_cache f USING (url)")
def feed_cache_lookup(spark, sf_dir):
    return table(spark, sf_dir, "sources").select("url").distinct().join(table(spark, sf_dir, "feed_cache"), "url", "left").select("url", "etag", "last_modified")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 7 DAY AND o_orderdate <= TIMESTAMP '2001-07-01 12:00:00'")
def rolling_week_orders(spark, sf_dir):
    """The window over rows whose instants are stored: the orders of a week."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("utc_ms"))
    return ST.rolling_window(o.select("id"), o.withColumn("field", F.lit("ingested_at")), int(datetime.fromisoformat("2001-07-01 12:00:00+00:00").timestamp() * 1000))


@query()
def rolling_week_items(spark, sf_dir):
    items = _items(spark, sf_dir)
    seen = item_instants(items, table(spark, sf_dir, "sources"))
    return ST.rolling_window(items, seen, int(datetime.fromisoformat(NOW + "+00:00").timestamp() * 1000)).select("id", "source", "title").distinct()


@query("SELECT id, source, title, url, ts, ingested_at, used_in_digest, md5(coalesce(body, '')) AS body_md5 FROM items ORDER BY ingested_at DESC, id, used_in_digest")
def export_ordered(spark, sf_dir):
    return _items(spark, sf_dir).orderBy(F.desc("ingested_at"), "id", "used_in_digest").select("id", "source", "title", "url", "ts", "ingested_at", "used_in_digest", F.md5(F.coalesce("body", F.lit(""))).alias("body_md5"))


@query("SELECT id, source, title, url, CAST(NULL AS VARCHAR) AS body, CAST(NULL AS VARCHAR) AS ts, ingested_at, used_in_digest FROM items")
def schema_migration(spark, sf_dir):
    return ST.migrate(_items(spark, sf_dir).select("id", "source", "title", "url", "ingested_at", "used_in_digest"), ST.SCHEMAS["items"])


@query(f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-W%V') AS week, strftime(o_orderdate, '%G-W%V') AS iso_week, strftime(o_orderdate, '%Y-W%W') AS monday_week, dayofweek(o_orderdate) = 0 AND day(o_orderdate) <= 7 AS first_sunday FROM orders""")
def week_keys(spark, sf_dir):
    t = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", W.week_key(t).alias("week"), W.iso_week_key(t).alias("iso_week"), W.monday_week_key(t).alias("monday_week"), W.is_first_sunday(t).alias("first_sunday"))


@query(f"SELECT topic_id, CAST({_monday('first_week')} AS VARCHAR) AS monday, {_between('last_week', 'first_week')} AS span FROM topic_bank")
def week_gaps(spark, sf_dir):
    return table(spark, sf_dir, "topic_bank").select("topic_id", W.week_to_date(F.col("first_week")).cast("string").alias("monday"), W.weeks_between(F.col("last_week"), F.col("first_week")).cast("bigint").alias("span"))


def _age_sql(rows: str) -> str:
    """(id, age) of rows (id, ts), as weeks.rfc822_age_days."""
    rx = W.RFC822.replace("'", "''")
    part = lambda k: f"regexp_extract(ts, '{rx}', {k})"
    zones = " ".join(f"WHEN '{k}' THEN {v}" for k, v in W.RFC822_ZONES.items())
    t = f"try_strptime({part(1)} || ' ' || {part(2)} || ' ' || {part(3)} || ' ' || {part(4)} || CASE WHEN {part(5)} = '' THEN ':00' ELSE {part(5)} END, '%d %b %Y %H:%M:%S')"
    off = f"CASE WHEN regexp_matches({part(6)}, '^[+-]') THEN CAST(substring({part(6)}, 1, 1) || '1' AS INT) * (CAST(substring({part(6)}, 2, 2) AS INT) * 60 + CAST(substring({part(6)}, 4, 2) AS INT)) ELSE 60 * CASE upper({part(6)}) {zones} ELSE 0 END END"
    return f"(SELECT id, CASE WHEN regexp_matches(ts, '{rx}') AND {t} IS NOT NULL THEN greatest(0, (epoch_us(TIMESTAMP '{NOW}') - epoch_us({t}) + CAST({off} AS BIGINT) * 60000000) / 86400000000.0) END AS age FROM {rows})"


@query(f"SELECT id, round(age, 6) AS age FROM {_age_sql(ITEM1)}")
def rfc822_age(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", _r(W.rfc822_age_days(F.col("ts"), F.lit(NOW).cast("timestamp"))).alias("age"))


@query(f"SELECT entity, week, count FROM {HIST}")
def entity_history(spark, sf_dir):
    return _hist(spark, sf_dir)


@query(f"WITH h AS {HIST}, n AS (SELECT count(DISTINCT week) AS n FROM h) SELECT entity, count(DISTINCT week) AS df, round(ln((1 + max(n)) * 1.0 / (1 + count(DISTINCT week))), 6) AS idf FROM h, n GROUP BY entity")
def entity_idf(spark, sf_dir):
    return E.idf(_hist(spark, sf_dir)).select("entity", "df", _r("idf").alias("idf"))


LAST = "(SELECT max(week) FROM h)"


@query(f"""WITH h AS {HIST}, old AS (SELECT * FROM h WHERE week <> {LAST}), r AS (SELECT DISTINCT week FROM old ORDER BY week DESC LIMIT 4), m AS (SELECT entity, avg(count) AS mean FROM old WHERE week IN (SELECT week FROM r) GROUP BY entity)
SELECT h.entity, round((h.count - coalesce(mean, 0)) / greatest(coalesce(mean, 0), 1), 6) AS velocity FROM h LEFT JOIN m USING (entity) WHERE week = {LAST}""")
def entity_velocity(spark, sf_dir):
    h = _hist(spark, sf_dir)
    last = h.agg(F.max("week").alias("week"))
    now, old = h.join(F.broadcast(last), "week", "left_semi"), h.join(F.broadcast(last), "week", "left_anti")
    return E.velocity(now.select("entity", "count"), old).select("entity", _r("velocity").alias("velocity"))


@query(f"""WITH h AS {HIST}, old AS (SELECT * FROM h WHERE week <> {LAST}), r AS (SELECT DISTINCT week FROM old ORDER BY week DESC LIMIT 3)
SELECT entity, count(DISTINCT week) AS n FROM old WHERE week IN (SELECT week FROM r) AND entity IN (SELECT entity FROM h WHERE week = {LAST}) GROUP BY entity HAVING count(DISTINCT week) >= 3 ORDER BY n DESC, entity DESC LIMIT 5""")
def entity_streaks(spark, sf_dir):
    h = _hist(spark, sf_dir)
    last = h.agg(F.max("week").alias("week"))
    return E.streaks(h.join(F.broadcast(last), "week", "left_anti"), h.join(F.broadcast(last), "week", "left_semi"))


@query(f"""WITH h AS (SELECT CAST(topic_id AS VARCHAR) AS entity, week FROM cluster_signals WHERE topic_id IS NOT NULL), o AS (SELECT * FROM h WHERE week <> '{WEEK}'), r AS (SELECT DISTINCT week FROM o ORDER BY week DESC LIMIT 6),
s AS (SELECT entity, max(week) AS last_week FROM o WHERE week IN (SELECT week FROM r) GROUP BY entity)
SELECT entity, last_week, {_between(f"'{WEEK}'", 'last_week')} AS gap FROM s WHERE entity IN (SELECT entity FROM h) AND {_between(f"'{WEEK}'", 'last_week')} >= 4 ORDER BY gap DESC, entity DESC LIMIT 5""")
def returning_entities(spark, sf_dir):
    h = table(spark, sf_dir, "cluster_signals").filter("topic_id is not null").select(F.col("topic_id").cast("string").alias("entity"), "week")
    return E.returning(h, h, WEEK).select("entity", "last_week", F.col("gap").cast("bigint").alias("gap"))


@query(f"SELECT week, aspect, round(coverage, 6) AS coverage FROM {LEDGER}")
def coverage_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir).select("week", "aspect", _r("coverage").alias("coverage"))


@query(f"""WITH l AS {LEDGER}, w AS (SELECT week, row_number() OVER (ORDER BY week DESC) - 1 AS age FROM (SELECT DISTINCT week FROM l) ORDER BY week DESC LIMIT 6)
SELECT aspect, round(sum(CASE WHEN coalesce(coverage, 0) < 0.4 THEN pow(0.7, age) ELSE 0 END), 6) AS debt FROM (SELECT DISTINCT aspect FROM l) CROSS JOIN w LEFT JOIN l USING (week, aspect) GROUP BY aspect""")
def coverage_debt(spark, sf_dir):
    return L.coverage_debt(_ledger(spark, sf_dir)).select("aspect", _r("debt").alias("debt"))


@query(f"""WITH l AS {LEDGER}, n AS (SELECT week, row_number() OVER (ORDER BY week) AS no FROM (SELECT DISTINCT week FROM l)), a AS (SELECT * FROM n ORDER BY no DESC LIMIT 12), f AS (SELECT aspect, min(no) AS since FROM l JOIN n USING (week) GROUP BY aspect)
SELECT a.week, round(sum(CASE WHEN coalesce(l.coverage, 0) < 0.4 THEN pow(0.7, a.no - n.no) ELSE 0 END), 6) AS debt FROM a JOIN n ON n.no <= a.no AND n.no > a.no - 6 JOIN f ON f.since <= a.no LEFT JOIN l ON l.week = n.week AND l.aspect = f.aspect GROUP BY a.week""")
def debt_burndown(spark, sf_dir):
    return L.debt_burndown(_ledger(spark, sf_dir)).select("week", _r("debt").alias("debt"))


@query(f"SELECT week, round(avg(CASE WHEN coverage >= 0.4 THEN 1.0 ELSE 0 END), 6) AS completeness FROM {LEDGER} GROUP BY week")
def coverage_completeness(spark, sf_dir):
    return L.completeness(_ledger(spark, sf_dir)).select("week", _r("completeness").alias("completeness"))


@query(f"""WITH r AS (SELECT week, coverage, row_number() OVER (PARTITION BY week ORDER BY coverage) AS i, count(*) OVER (PARTITION BY week) AS n FROM {LEDGER})
SELECT week, round(1 - (CASE WHEN sum(coverage) = 0 THEN 0 ELSE 2 * sum(i * coverage) / (max(n) * sum(coverage)) - (max(n) + 1.0) / max(n) END), 6) AS balance FROM r GROUP BY week""")
def coverage_balance(spark, sf_dir):
    return L.balance(_ledger(spark, sf_dir)).select("week", _r("balance").alias("balance"))


@query(f"SELECT week, {', '.join(f'round(coalesce(max(coverage) FILTER (aspect = {chr(39)}{a}{chr(39)}), 0), 6) AS {a.lower()}' for a in ('ECONOMY', 'STANDARD', 'PROMO'))} FROM (SELECT week, upper(split_part(aspect, ' ', 1)) AS aspect, coverage FROM {LEDGER}) GROUP BY week")
def ledger_pivot(spark, sf_dir):
    l = _ledger(spark, sf_dir).withColumn("aspect", F.upper(F.split_part("aspect", F.lit(" "), F.lit(1))))
    p = L.ledger_pivot(l, ["ECONOMY", "STANDARD", "PROMO"])
    return p.select("week", *[_r(a).alias(a.lower()) for a in ("ECONOMY", "STANDARD", "PROMO")])


@query("""WITH w AS (SELECT DISTINCT week FROM cluster_signals), l AS (SELECT week, count(*) AS live, avg(weeks_seen) AS m FROM w JOIN topic_bank ON week BETWEEN first_week AND last_week GROUP BY week), b AS (SELECT first_week AS week, count(*) AS spawned FROM topic_bank GROUP BY first_week)
SELECT week, coalesce(live, 0) AS live, round(coalesce(m, 0), 6) AS mean_weeks_seen, coalesce(spawned, 0) AS spawned FROM w LEFT JOIN l USING (week) LEFT JOIN b USING (week)""")
def topic_maturity(spark, sf_dir):
    return L.topic_maturity(table(spark, sf_dir, "topic_bank"), table(spark, sf_dir, "cluster_signals").select("week")).select("week", "live", _r("mean_weeks_seen").alias("mean_weeks_seen"), "spawned")


@query(f"""WITH k AS (SELECT s.week, CASE WHEN s.topic_id IS NULL OR b.first_week = s.week THEN 'new' WHEN coalesce(CASE WHEN isnan(novelty) THEN 0 ELSE novelty END, 0) >= 0.7 THEN 'resurfacing' ELSE 'ongoing' END AS kind FROM {SIG1} s LEFT JOIN topic_bank b USING (topic_id))
SELECT week, round(avg(CASE WHEN kind = 'new' THEN 1.0 ELSE 0 END), 6) AS new, round(avg(CASE WHEN kind = 'ongoing' THEN 1.0 ELSE 0 END), 6) AS ongoing, round(avg(CASE WHEN kind = 'resurfacing' THEN 1.0 ELSE 0 END), 6) AS resurfacing FROM k GROUP BY week""")
def recurrence_mix(spark, sf_dir):
    m = L.recurrence_mix(WT.one_per_topic(table(spark, sf_dir, "cluster_signals")), table(spark, sf_dir, "topic_bank"))
    return m.select("week", *[_r(c).alias(c) for c in ("new", "ongoing", "resurfacing")])


@query("SELECT week, round(avg(CASE WHEN isnan(richness) THEN NULL ELSE richness END), 6) AS richness FROM cluster_signals GROUP BY week")
def richness_trend(spark, sf_dir):
    return L.mean_by_week(table(spark, sf_dir, "cluster_signals"), "richness", "richness").select("week", _r("richness").alias("richness"))


@query(f"""WITH h AS (SELECT DISTINCT entity, week FROM {HIST}), n AS (SELECT week, row_number() OVER (ORDER BY week) AS no FROM (SELECT DISTINCT week FROM h)), c AS (SELECT a.week, a.no, entity, count(*) AS k FROM n a JOIN n b ON b.no <= a.no JOIN h ON h.week = b.week GROUP BY ALL),
g AS (SELECT week, count(*) AS total, count(*) FILTER (k = 1) AS rare, count(*) FILTER (k >= greatest(2, ceil(no / 2.0))) AS common FROM c GROUP BY week)
SELECT week, total, rare, common, CASE WHEN common > 0 THEN round(rare * 1.0 / common, 6) WHEN rare > 0 THEN 1e308 ELSE 0.0 END AS ratio FROM g""")
def vocabulary_growth(spark, sf_dir):
    return L.vocabulary_growth(_hist(spark, sf_dir)).select("week", "total", "rare", "common", _r(F.when(F.col("ratio") == float("inf"), 1e308).otherwise(F.round("ratio", 6)), 6).alias("ratio"))


def _auc_sql(rows: str, by: str) -> str:
    return f"""SELECT {by}, CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN round((sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6) END AS auc FROM (
    SELECT *, rank() OVER (PARTITION BY {by} ORDER BY score) + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS r FROM ({rows}) WHERE score IS NOT NULL AND NOT isnan(score)) GROUP BY {by}"""


@query(_auc_sql(f"SELECT w.week AS wk, s.score, s.y FROM (SELECT week, topic_id, score, CASE WHEN max(week) OVER (PARTITION BY topic_id) > week THEN 1 ELSE 0 END AS y FROM {SIG1} WHERE topic_id IS NOT NULL) s JOIN (SELECT DISTINCT week FROM cluster_signals ORDER BY week DESC LIMIT 12) w ON s.week <= w.week", "wk"))
def persistence_auc(spark, sf_dir):
    s = table(spark, sf_dir, "cluster_signals")
    return L.persistence_auc(s, E.latest_weeks(s, 12)).select(F.col("week").alias("wk"), _r("auc").alias("auc"))


@query(_auc_sql("SELECT o_orderpriority, o_totalprice AS score, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders", "o_orderpriority"))
def label_auc(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_totalprice").alias("score"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return L.auc(o, "score", "y", ["o_orderpriority"]).select("o_orderpriority", _r("auc").alias("auc"))


@query(f"SELECT count(*) AS topics, round(avg(weeks_seen), 6) AS mean_weeks_seen, count(*) FILTER (weeks_seen >= 3) AS mature, count(*) FILTER ({_between(f'{chr(39)}{WEEK}{chr(39)}', 'last_week')} >= 4) AS dormant FROM topic_bank")
def bank_stats(spark, sf_dir):
    return L.bank_stats(table(spark, sf_dir, "topic_bank"), WEEK).withColumn("mean_weeks_seen", _r("mean_weeks_seen"))


@query("SELECT week, round(avg(coalesce(CASE WHEN isnan(persistence_rate) THEN NULL ELSE persistence_rate END, 0)), 6) AS persistence, round(avg(CASE WHEN persistence_rate >= 0 AND NOT isnan(persistence_rate) THEN persistence_rate END), 6) AS known FROM cluster_signals GROUP BY week")
def mean_persistence(spark, sf_dir):
    s = table(spark, sf_dir, "cluster_signals")
    known = L.mean_persistence(s, null_aware=True).withColumnRenamed("persistence", "known")
    return L.mean_persistence(s).join(known, "week").select("week", _r("persistence").alias("persistence"), _r("known").alias("known"))


@query("SELECT coalesce(a.week, b.week) AS week, coalesce(n_items, 0) AS n_items, coalesce(n_clusters, 0) AS n_clusters FROM (SELECT strftime(ts, '%Y-W%W') AS week, count(*) AS n_items FROM events GROUP BY 1) a FULL JOIN (SELECT week, count(*) AS n_clusters FROM cluster_signals GROUP BY 1) b ON a.week = b.week")
def throughput_outer(spark, sf_dir):
    return L.throughput(table(spark, sf_dir, "events").select(W.monday_week_key(F.col("ts")).alias("week")), table(spark, sf_dir, "cluster_signals").select("week"))


@query(f"SELECT count(*) AS items, count(*) FILTER (used_in_digest) AS used, round(100.0 * count(*) FILTER (used_in_digest) / count(*), 6) AS percent FROM {ITEM1}")
def item_totals(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).agg(F.count("*").alias("items"), F.count_if("used_in_digest").alias("used"), _r(100.0 * F.count_if("used_in_digest") / F.count("*")).alias("percent"))


@query("SELECT week, e.key AS term, round(e.value, 6) AS weight FROM (SELECT week, unnest(map_entries(weights)) AS e FROM (SELECT week, arg_max(weights, created_at) AS weights FROM scorer_weights WHERE weights IS NOT NULL GROUP BY week))")
def weights_history(spark, sf_dir):
    return L.weights_history(table(spark, sf_dir, "scorer_weights")).select("week", "term", _r("weight").alias("weight"))


@query("""WITH h AS (SELECT week, unnest(map_entries(weights)) AS e FROM (SELECT week, arg_max(weights, created_at) AS weights FROM scorer_weights GROUP BY week)), w AS (SELECT week, e.key AS term, e.value AS v FROM h)
SELECT week, term, round(CASE WHEN rel >= 0.2 THEN v / t WHEN term = 'relevance' THEN 0.2 ELSE v * 0.8 / rest END, 6) AS weight FROM (SELECT *, coalesce(max(v) FILTER (term = 'relevance') OVER (PARTITION BY week), 0) AS rel, sum(v) FILTER (term <> 'relevance') OVER (PARTITION BY week) AS rest, sum(v) OVER (PARTITION BY week) AS t FROM w)""")
def weight_floor(spark, sf_dir):
    return WT.floored(L.weights_history(table(spark, sf_dir, "scorer_weights"))).select("week", "term", _r("weight").alias("weight"))


_DEFAULTS = ", ".join(f"('{k}', {v})" for k, v in S.DEFAULT_WEIGHTS.items())


@query(f"""WITH h AS (SELECT week, unnest(map_entries(weights)) AS e FROM (SELECT week, arg_max(weights, created_at) AS weights FROM scorer_weights GROUP BY week)), l AS (SELECT e.key AS term, arg_max(e.value, week) AS weight FROM h GROUP BY 1)
SELECT term, round(weight, 6) AS weight, round(abs(weight - d.v), 6) AS drift FROM l JOIN (VALUES {_DEFAULTS}) d(term, v) USING (term) ORDER BY round(abs(weight - d.v), 9) DESC, term LIMIT 3""")
def largest_drift(spark, sf_dir):
    return L.largest_drift(L.weights_history(table(spark, sf_dir, "scorer_weights")), S.DEFAULT_WEIGHTS).select("term", _r("weight").alias("weight"), _r("drift").alias("drift"))


@query("SELECT topic_id, CAST(sign(arg_max(coverage, week) - arg_min(coverage, week)) AS DOUBLE) AS direction FROM " + SIG1 + " WHERE topic_id IS NOT NULL AND coverage IS NOT NULL GROUP BY topic_id")
def topic_direction(spark, sf_dir):
    s = WT.one_per_topic(table(spark, sf_dir, "cluster_signals")).filter("topic_id is not null and coverage is not null")
    return L.direction(s.select("topic_id", "week", F.col("coverage").alias("value")), ["topic_id"])


@query(f"SELECT week, topic_id, CASE WHEN max(week) OVER (PARTITION BY topic_id) > week THEN 1 ELSE 0 END AS recurs FROM {SIG1} WHERE topic_id IS NOT NULL")
def later_occurrence(spark, sf_dir):
    return WT.recurrence_labels(WT.one_per_topic(table(spark, sf_dir, "cluster_signals").filter("topic_id is not null"))).select("week", "topic_id", "recurs")


def _zero(c: str) -> str:
    return f"coalesce(CASE WHEN isnan({c}) THEN 0 ELSE {c} END, 0)"


@query(f"SELECT week, topic_id, {', '.join(f'round(({_zero(c)} - min({_zero(c)}) OVER (PARTITION BY week)) / (max({_zero(c)}) OVER (PARTITION BY week) - min({_zero(c)}) OVER (PARTITION BY week) + 1e-9), 5) AS {c}' for c in ('coverage', 'richness', 'novelty'))} FROM {SIG1}")
def signal_minmax(spark, sf_dir):
    s = WT.one_per_topic(table(spark, sf_dir, "cluster_signals"))
    cols = ("coverage", "richness", "novelty")
    for c in cols:
        s = s.withColumn(c, F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)))
    return s.select("week", "topic_id", *[F.round(S.minmax(F.col(c), ["week"]), 5).alias(c) for c in cols])


@query(f"SELECT week, topic_id, round({' + '.join(f'{_zero(k)} * {v}' for k, v in S.DEFAULT_WEIGHTS.items())}, 5) AS score FROM {SIG1}")
def cluster_score(spark, sf_dir):
    return S.score(WT.one_per_topic(table(spark, sf_dir, "cluster_signals"))).select("week", "topic_id", F.round("score", 5).alias("score"))


@query(f"SELECT week, topic_id FROM {SIG1} WHERE NOT (coalesce(profile_exclusion, 0) > 0 AND coalesce(relevance, 0) < 0.12)")
def off_profile_filter(spark, sf_dir):
    return SE.off_profile(WT.one_per_topic(table(spark, sf_dir, "cluster_signals"))).select("week", "topic_id")


@query(f"SELECT topic_id, round(mass * 0.8, 6) AS mass, last_week FROM topic_bank WHERE {_between(f'{chr(39)}{WEEK}{chr(39)}', 'last_week')} <= 12 AND mass * 0.8 >= 0.05")
def bank_decay_prune(spark, sf_dir):
    return BK.decay_and_prune(table(spark, sf_dir, "topic_bank"), WEEK).select("topic_id", _r("mass").alias("mass"), "last_week")


@query(f"""WITH m AS (SELECT topic_id AS cluster, topic_id AS place, topic_id, CASE WHEN topic_id % 3 = 0 THEN 0.1 ELSE 0.9 END AS sim FROM topic_bank), t AS (SELECT max(topic_id) AS top FROM topic_bank)
SELECT topic_id, round(mass + CASE WHEN topic_id % 3 = 0 THEN 0 ELSE 1 END, 6) AS mass, CASE WHEN topic_id % 3 = 0 THEN last_week ELSE '{WEEK}' END AS last_week, weeks_seen + CASE WHEN topic_id % 3 = 0 THEN 0 ELSE 1 END AS weeks_seen FROM topic_bank
UNION ALL SELECT top + row_number() OVER (ORDER BY topic_id), 1.0, '{WEEK}', 1 FROM topic_bank, t WHERE topic_id % 3 = 0""")
def bank_match_or_spawn(spark, sf_dir):
    b = table(spark, sf_dir, "topic_bank")
    m = b.select(F.col("topic_id").alias("cluster"), F.col("topic_id").alias("place"), "topic_id", F.when(F.col("topic_id") % 3 == 0, 0.1).otherwise(0.9).alias("sim"))
    return BK.commit(b, m, WEEK)[0].select("topic_id", _r("mass").alias("mass"), "last_week", "weeks_seen")


@query("SELECT key AS k, count(*) AS n, round(avg(value), 6) AS mean FROM (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS key, value FROM events) GROUP BY key")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select(X.json_object(F.col("props"), "k bigint")["k"].alias("k"), "value").groupBy("k").agg(F.count("*").alias("n"), _r(F.avg("value")).alias("mean"))


def _tfidf_sql(rows: str, min_df: int = 2, bigrams: bool = True, by: str = "id", group: str = "") -> str:
    """CTEs tok, v: (by, term, weight) of rows (by, text), as vectorize.tfidf."""
    stop = ", ".join(f"'{w}'" for w in V.STOP_WORDS)
    g, gj = (f"{group}, ", f"USING ({group}, term)") if group else ("", "USING (term)")
    pairs = " || CASE WHEN len(w) > 1 THEN [w[i] || ' ' || w[i + 1] for i in range(1, CAST(len(w) AS BIGINT))] ELSE [] END" if bigrams else ""
    return f"""src AS ({rows}), tok AS (SELECT {by}, unnest(w{pairs}) AS term FROM (SELECT {by}, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({stop})) AS w FROM src)),
    tf AS (SELECT {by}, term, count(*) AS tf FROM tok GROUP BY ALL), df AS (SELECT {g}term, count(*) AS df FROM tf GROUP BY ALL), nn AS (SELECT {g}count(*) AS n FROM src {'GROUP BY ' + group if group else ''}),
    raw AS (SELECT {by}, term, (1 + ln(tf)) * (1 + ln((1 + n) * 1.0 / (1 + df))) AS w FROM tf JOIN df {gj} JOIN nn {'USING (' + group + ')' if group else 'ON true'} WHERE df >= {min_df}),
    v AS (SELECT {by}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {by})) AS weight FROM raw)"""


@query(f"WITH {_tfidf_sql(f'SELECT id, title AS text FROM {ITEM1}')} SELECT id, term, round(weight, 6) AS weight FROM v")
def tfidf_titles(spark, sf_dir):
    d = _one_item(_items(spark, sf_dir)).select("id", F.coalesce("title", F.lit("")).alias("text"))
    return V.tfidf(d, ["id"]).select("id", "term", _r("weight").alias("weight"))


@query(f"""WITH {_tfidf_sql('SELECT doc_id AS id, text FROM documents')} SELECT id, count(*) AS n_terms, round(sum(weight), 4) AS total FROM v GROUP BY id""")
def tfidf_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return V.tfidf(d, ["id"]).groupBy("id").agg(F.count("*").alias("n_terms"), F.round(F.sum("weight"), 4).alias("total"))


@query(f"""WITH {_tfidf_sql(f"SELECT id, coalesce(title, '') AS text FROM {ITEM1}")}, c AS (SELECT id, text, min(id) OVER (PARTITION BY text) AS rep FROM src), vr AS (SELECT v.* FROM v JOIN c USING (id)),
p AS (SELECT a.id AS a, b.id AS b FROM vr a JOIN vr b USING (term) WHERE a.id <> b.id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.7 - 1e-9)
SELECT c.id, c.rep, count(p.b) AS n_links FROM c LEFT JOIN p ON p.a = c.id GROUP BY ALL""")
def title_links(spark, sf_dir):
    d = _one_item(_items(spark, sf_dir)).select("id", F.coalesce("title", F.lit("")).alias("text"))
    return V.linked(d, 0.7)


def _vectors(spark, sf_dir):
    """(id, term, weight): unit embeddings in long form."""
    e = table(spark, sf_dir, "embeddings")
    n = F.sqrt(R.dot(F.col("embedding"), F.col("embedding")))
    return e.select(F.col("vec_id").alias("id"), n.alias("n"), F.posexplode("embedding").alias("pos", "x")).select("id", F.format_string("d%02d", "pos").alias("term"), (F.col("x") / F.col("n")).alias("weight"))


@query()
def average_linkage(spark, sf_dir):
    """Average linkage of the embeddings, cut at a mean cosine of 0.2: (id, cluster)."""
    return C.vector_linkage(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 0.2)


@query(f"""WITH {_tfidf_sql(f"SELECT id, coalesce(title, '') AS text FROM {ITEM1}")}, k AS (SELECT id, source AS cluster FROM {ITEM1}), a AS (SELECT cluster, term, sum(weight) AS s FROM v JOIN k USING (id) GROUP BY ALL),
t AS (SELECT k.cluster, k.id, coalesce(round(sum(weight * s), 9), 0) AS total FROM k LEFT JOIN (v JOIN k k2 USING (id) JOIN a ON a.cluster = k2.cluster AND a.term = v.term) x ON x.id = k.id GROUP BY ALL)
SELECT cluster, id, round(total, 5) AS total FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY total DESC, id) AS n FROM t) WHERE n = 1""")
def source_medoids(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir))
    v = V.tfidf(i.select("id", F.coalesce("title", F.lit("")).alias("text")), ["id"])
    return C.medoids(v, i.select("id", F.col("source").alias("cluster"))).select("cluster", "id", F.round("total", 5).alias("total"))


def _queries8(spark, sf_dir):
    return table(spark, sf_dir, "eval_items").filter("eval_id % 20 = 0").select(F.col("eval_id").alias("query_id"), "text")


COS = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / sqrt(list_sum(list_transform(a.embedding, lambda z: CAST(z AS DOUBLE) * CAST(z AS DOUBLE))) * list_sum(list_transform(b.embedding, lambda z: CAST(z AS DOUBLE) * CAST(z AS DOUBLE))))"


def _bm25_sql() -> str:
    norm = _norm_sql("text")
    return f"""tok AS (SELECT doc_id AS id, list_filter(string_split({norm}, ' '), lambda w: w <> '') AS w FROM documents), dl AS (SELECT id, len(w) AS dl FROM tok), corpus AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM tok) GROUP BY ALL), df AS (SELECT term, count(*) AS df, ln(max(n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM tf, corpus GROUP BY term),
    idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM df) ELSE raw END AS idf FROM df),
    q AS (SELECT query_id, term, count(*) AS qf FROM (SELECT eval_id AS query_id, unnest(list_filter(string_split({norm}, ' '), lambda w: w <> '')) AS term FROM eval_items WHERE eval_id % 20 = 0) GROUP BY ALL),
    s AS (SELECT query_id, id, sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM tf JOIN q USING (term) JOIN idf USING (term) JOIN dl USING (id), corpus GROUP BY ALL)"""


@query(f"WITH {_bm25_sql()} SELECT query_id, id, round(score, 4) AS score FROM s")
def bm25_scores(spark, sf_dir):
    """Items whose id is divisible by 20 as queries, against all documents."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return R.bm25(d, _queries8(spark, sf_dir)).select("query_id", "id", F.round("score", 4).alias("score"))


@query(f"WITH {_bm25_sql()}, r AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rk FROM s) SELECT query_id, id, round(sum(1.0 / (60 + rk)), 6) AS fused FROM r WHERE rk <= 100 GROUP BY ALL")
def rrf_lexical(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return R.rrf([R.ranked(R.bm25(d, _queries8(spark, sf_dir)), 100)]).select("query_id", "id", _r("fused").alias("fused"))


@query(f"WITH {_bm25_sql()}, b AS (SELECT query_id, max(score) AS best FROM s GROUP BY query_id) SELECT query_id AS aspect, round(best / (SELECT max(best) FROM b), 5) AS coverage FROM b")
def aspect_coverage(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    s = R.bm25(d, _queries8(spark, sf_dir)).select(F.col("query_id").alias("aspect"), F.col("id").alias("cluster"), "score")
    return S.aspect_coverage(s).select("aspect", F.round("coverage", 5).alias("coverage"))


@query(f"""WITH {_bm25_sql()}, b AS (SELECT id, max(score) AS m FROM s GROUP BY id), p AS (SELECT id, m / (SELECT max(m) FROM b) AS x FROM b) SELECT id AS cluster, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER () + 1e-9), 4) AS profile_exclusion FROM p""")
def exclusion_signal(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    s = R.bm25(d, _queries8(spark, sf_dir)).select(F.col("id").alias("cluster"), "score")
    return S.exclusion(s).select("cluster", F.round("profile_exclusion", 4).alias("profile_exclusion"))


@query(f"SELECT query_id, id, round(score, 4) AS score FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, {COS} AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY round({COS}, 9) DESC, b.vec_id) AS rk FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0) WHERE rk <= 10")
def dense_topk(spark, sf_dir):
    """Vectors whose id is divisible by 20 as queries, against all vectors."""
    e = table(spark, sf_dir, "embeddings")
    s = R.dense_scores(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("e")), e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")))
    return R.ranked(s, 10).select("query_id", "id", F.round("score", 4).alias("score"))


@query(f"""WITH {_bm25_sql()}, l AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rk FROM s),
d AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rk FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, {COS} AS score FROM embeddings a, embeddings b WHERE a.vec_id IN (SELECT eval_id FROM eval_items WHERE eval_id % 20 = 0) AND b.vec_id IN (SELECT doc_id FROM documents)))
SELECT query_id, id, round(sum(1.0 / (60 + rk)), 6) AS fused FROM (SELECT * FROM l WHERE rk <= 100 UNION ALL SELECT * FROM d WHERE rk <= 100) GROUP BY ALL""")
def rrf_hybrid(spark, sf_dir):
    """Both lanes over the documents: the vector of a document, and of a query, is the one of its number."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("e"))
    asked = e.join(_queries8(spark, sf_dir).select(F.col("query_id").alias("id")), "id", "left_semi").select(F.col("id").alias("query_id"), F.col("e").alias("q"))
    dense = R.dense_scores(e.join(d.select("id"), "id", "left_semi"), asked)
    return R.rrf([R.ranked(R.bm25(d, _queries8(spark, sf_dir)), 100), R.ranked(dense, 100)]).select("query_id", "id", _r("fused").alias("fused"))


def _topic_terms(spark, sf_dir):
    """Topics of the embeddings' labels: mean vectors, of unit length."""
    v = _vectors(spark, sf_dir).join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("topic_id")), "id")
    m = v.groupBy("topic_id", "term").agg(F.avg("weight").alias("w"))
    return m.select("topic_id", "term", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("topic_id")))).alias("weight"))


_VEC = "x AS (SELECT vec_id AS id, label AS topic_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings), v AS (SELECT id, topic_id, pos, x / sqrt(sum(CAST(x AS DOUBLE) * x) OVER (PARTITION BY id)) AS weight FROM x), m AS (SELECT topic_id, pos, avg(weight) AS w FROM v GROUP BY ALL), t AS (SELECT topic_id, pos, w / sqrt(sum(w * w) OVER (PARTITION BY topic_id)) AS weight FROM m)"


@query(f"""WITH {_VEC}, s AS (SELECT v.id AS cluster, t.topic_id, round(sum(v.weight * t.weight), 9) AS sim FROM v JOIN t USING (pos) GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sim DESC, topic_id) AS n FROM s)
SELECT cluster, CAST(topic_id AS BIGINT) AS topic_id, round(sim, 4) AS sim, round(greatest(0, least(1, 1 - sim + CASE WHEN {_between(f"'{WEEK}'", 'last_week')} >= 4 THEN 0.3 ELSE 0 END)), 4) AS novelty FROM b LEFT JOIN topic_bank USING (topic_id) WHERE n = 1""")
def topic_match_novelty(spark, sf_dir):
    m = BK.match_topics(_vectors(spark, sf_dir).withColumnRenamed("id", "cluster"), _topic_terms(spark, sf_dir))
    return m.join(BK.novelty(m, table(spark, sf_dir, "topic_bank"), WEEK), "cluster").select("cluster", "topic_id", F.round("sim", 4).alias("sim"), F.round("novelty", 4).alias("novelty"))


@query(f"""WITH {_VEC}, o AS (SELECT topic_id, pos, weight / sqrt(sum(weight * weight) OVER (PARTITION BY topic_id)) AS o FROM t WHERE pos < 48), n AS (SELECT topic_id, pos, weight AS w FROM v WHERE id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))
SELECT CAST(coalesce(o.topic_id, n.topic_id) AS BIGINT) AS topic_id, 'd' || lpad(CAST(coalesce(o.pos, n.pos) AS VARCHAR), 2, '0') AS term, round(0.7 * coalesce(o, 0) + 0.3 * coalesce(w, 0), 5) AS weight FROM o FULL JOIN n ON o.topic_id = n.topic_id AND o.pos = n.pos""")
def bank_blend(spark, sf_dir):
    """Each label's first vector blended into its topic; the current vocabulary is the first 48 dimensions."""
    t = _topic_terms(spark, sf_dir)
    first = table(spark, sf_dir, "embeddings").groupBy(F.col("label").cast("bigint").alias("topic_id")).agg(F.min("vec_id").alias("id"))
    new = _vectors(spark, sf_dir).join(first, "id").select("topic_id", "term", "weight")
    return BK.blend(t, new, t.filter("term < 'd48'").select("term")).select("topic_id", "term", F.round("weight", 5).alias("weight"))


@query(f"WITH {_VEC}, r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY abs(weight) DESC, pos) AS k FROM t) SELECT CAST(topic_id AS BIGINT) AS topic_id, 'd' || lpad(CAST(pos AS VARCHAR), 2, '0') AS term, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY topic_id)), 5) AS weight FROM r WHERE k <= 20")
def centroid_truncate(spark, sf_dir):
    return BK.truncate(_topic_terms(spark, sf_dir), top=20).select("topic_id", "term", F.round("weight", 5).alias("weight"))


@query(f"WITH {_VEC}, r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, pos) AS k FROM t) SELECT CAST(topic_id AS BIGINT) AS topic_id, string_agg('d' || lpad(CAST(pos AS VARCHAR), 2, '0'), ' · ' ORDER BY k) AS label FROM r WHERE k <= 3 GROUP BY topic_id")
def topic_labels(spark, sf_dir):
    return BK.topic_labels(_topic_terms(spark, sf_dir))


@query(f"WITH k AS (SELECT source AS cluster, count(*) AS n, count(DISTINCT url) AS u FROM {ITEM1} GROUP BY source) SELECT cluster, round(ln(1 + n) / ln(1 + (SELECT max(n) FROM k)), 6) AS coverage FROM k")
def coverage_signal(spark, sf_dir):
    return S.coverage(_one_item(_items(spark, sf_dir)).groupBy(F.col("source").alias("cluster")).agg(F.count("*").alias("n"))).select("cluster", _r("coverage").alias("coverage"))


@query(f"""WITH m AS (SELECT substring(id, 1, 2) AS cluster, i.source, coalesce(s.prior, 1.0) AS prior FROM {ITEM1} i LEFT JOIN sources s USING (source)), r AS (SELECT cluster, avg(prior) AS p, ln(1 + count(DISTINCT source)) AS b FROM m GROUP BY cluster)
SELECT cluster, round((p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER () + 1e-9), 5) AS prior, round((b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER () + 1e-9), 5) AS source_breadth FROM r""")
def source_signals(spark, sf_dir):
    m = _one_item(_items(spark, sf_dir)).select(F.substring("id", 1, 2).alias("cluster"), "id", "source")
    return S.source_signals(m, table(spark, sf_dir, "sources")).select("cluster", F.round("prior", 5).alias("prior"), F.round("source_breadth", 5).alias("source_breadth"))


@query(f"""WITH r AS (SELECT substring(id, 1, 2) AS cluster, min(age) AS age FROM {_age_sql(ITEM1)} GROUP BY 1), x AS (SELECT cluster, exp(-coalesce(age, (SELECT median(age) FROM r), 0) / 4) AS x FROM r)
SELECT cluster, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER () + 1e-9), 5) AS recency_decay FROM x""")
def recency_signal(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir))
    ages = i.select(F.substring("id", 1, 2).alias("cluster"), W.rfc822_age_days(F.col("ts"), F.lit(NOW).cast("timestamp")).alias("age_days"))
    return S.recency(ages, "median").select("cluster", F.round("recency_decay", 5).alias("recency_decay"))


@query(f"""WITH h AS {HIST}, m AS (SELECT week AS cluster, entity, count FROM h), n AS (SELECT count(DISTINCT week) AS n FROM h), i AS (SELECT entity, ln((1 + max(n)) * 1.0 / (1 + count(DISTINCT week))) AS idf FROM h, n GROUP BY entity), r AS (SELECT cluster, sum(count * idf * CASE WHEN entity LIKE 'click%' THEN 2 ELSE 1 END) AS x FROM m JOIN i USING (entity) GROUP BY cluster)
SELECT cluster, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER () + 1e-9), 5) AS entity_signal FROM r""")
def entity_signal(spark, sf_dir):
    h = _hist(spark, sf_dir)
    keys = h.filter("entity like 'click%'").select("entity")
    return S.entity_signal(h.withColumnRenamed("week", "cluster"), E.idf(h), E.default_idf(h), keys).select("cluster", F.round("entity_signal", 5).alias("entity_signal"))


@query(f"SELECT s.week, s.topic_id, round(CASE WHEN b.topic_id IS NULL THEN -1 ELSE weeks_seen * 1.0 / greatest({_between(f'{chr(39)}{WEEK}{chr(39)}', 'first_week')}, 1) END, 6) AS persistence_rate FROM {SIG1} s LEFT JOIN topic_bank b USING (topic_id)")
def persistence_signal(spark, sf_dir):
    s = WT.one_per_topic(table(spark, sf_dir, "cluster_signals"))
    m = s.select(F.struct("week", "topic_id").alias("cluster"), "topic_id")
    return S.persistence(m, table(spark, sf_dir, "topic_bank"), WEEK).select("cluster.week", "cluster.topic_id", _r("persistence_rate").alias("persistence_rate"))


@query(f"SELECT cluster, pos, url, link_no FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY pos, id) AS link_no FROM (SELECT source AS cluster, ingested_at AS pos, url, id, row_number() OVER (PARTITION BY source, url ORDER BY ingested_at, id) AS n FROM {ITEM1}) WHERE n = 1) WHERE link_no <= 5")
def distinct_links(spark, sf_dir):
    i = _one_item(_items(spark, sf_dir)).select(F.col("source").alias("cluster"), F.col("ingested_at").alias("pos"), "url", "id")
    return SE.distinct_links(i)


@query(f"""WITH RECURSIVE o AS (SELECT row_number() OVER (ORDER BY ingested_at, id) AS n, source AS cluster, id, hash(url) AS u, CASE WHEN sig <> '' THEN hash(sig) END AS s FROM (SELECT *, {_signature_sql('title')} AS sig FROM {ITEM1})),
r(n, us, ss, kept) AS (SELECT 0::BIGINT, []::UBIGINT[], []::UBIGINT[], false UNION ALL
SELECT o.n, CASE WHEN k THEN list_append(us, o.u) ELSE us END, CASE WHEN k AND o.s IS NOT NULL THEN list_append(ss, o.s) ELSE ss END, k FROM (SELECT r.*, o.*, NOT list_contains(us, o.u) AND (o.s IS NULL OR NOT list_contains(ss, o.s)) AS k FROM r JOIN o ON o.n = r.n + 1) AS x(rn, us, ss, kept, n, cluster, id, u, s, k), LATERAL (SELECT x.n, x.u, x.s) AS o(n, u, s))
SELECT cluster, id FROM o JOIN r USING (n) WHERE kept""")
def greedy_dedup(spark, sf_dir):
    """All items in order of arrival as one selection."""
    i = _one_item(_items(spark, sf_dir))
    return SE.greedy_dedup(i.select(F.col("source").alias("cluster"), F.col("ingested_at").alias("place"), F.lit(0).alias("pos"), "id", "url", X.title_signature(F.col("title")).alias("signature")))


def _candidates(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("cluster"), F.round(1 / (1 + F.col("vec_id") / 50), 6).alias("score"), ((F.col("vec_id") % 7) / 20).alias("relevance"), F.col("embedding").alias("vec"))


def _mmr_sql(steps: str) -> str:
    """CTE m: (cluster, score, relevance, place) in MMR order up to `steps`."""
    gain = "CASE WHEN step = 0 THEN score ELSE 0.65 * score - 0.35 * near END"
    return f"""c AS (SELECT vec_id AS cluster, round(1 / (1 + vec_id / 50.0), 6) AS score, (vec_id % 7) / 20.0 AS relevance FROM embeddings),
    sim AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, {COS} AS s FROM embeddings a, embeddings b),
    r AS (SELECT 0 AS step, cluster, score, CAST(-2 AS DOUBLE) AS near, CAST(NULL AS INT) AS place FROM c UNION ALL
    SELECT step + 1, cluster, score, greatest(near, s), CASE WHEN cluster = pick THEN step + 1 ELSE place END FROM (SELECT *, first_value(cluster) OVER (ORDER BY place IS NULL DESC, {gain} DESC, score DESC, cluster) AS pick FROM r WHERE step < {steps}) x JOIN sim ON a = cluster AND b = pick),
    m AS (SELECT cluster, score, relevance, CAST(r.place AS BIGINT) AS place FROM r JOIN c USING (cluster, score) WHERE r.step = {steps} AND r.place IS NOT NULL)"""


@query(f"WITH RECURSIVE {_mmr_sql('15')} SELECT cluster, score, place FROM m")
def mmr_fixed(spark, sf_dir):
    return SE.mmr_order(_candidates(spark, sf_dir), k=15)


@query(f"""WITH RECURSIVE {_mmr_sql('(SELECT count(*) FROM embeddings)')}, d AS (SELECT place, score - lead(score) OVER (ORDER BY place) AS d FROM m), e AS (SELECT * FROM d WHERE d IS NOT NULL),
s AS (SELECT place, round(coalesce(lag(d) OVER (ORDER BY place), 0) * 0.25 + d * 0.5 + coalesce(lead(d) OVER (ORDER BY place), 0) * 0.25, 12) AS v FROM e), k AS (SELECT least(greatest((SELECT place FROM s ORDER BY v DESC, place LIMIT 1), 8), 40) AS cut)
SELECT cluster, score, place FROM m, k WHERE place <= cut OR (place <= 40 AND relevance >= 0.15)""")
def mmr_dynamic(spark, sf_dir):
    return SE.mmr_dynamic(_candidates(spark, sf_dir))


@query("""WITH o AS (SELECT row_number() OVER (ORDER BY mass DESC, topic_id) AS place, mass AS score FROM topic_bank), d AS (SELECT place, score - lead(score) OVER (ORDER BY place) AS d FROM o), e AS (SELECT * FROM d WHERE d IS NOT NULL),
s AS (SELECT place, round(coalesce(lag(d) OVER (ORDER BY place), 0) * 0.25 + d * 0.5 + coalesce(lead(d) OVER (ORDER BY place), 0) * 0.25, 12) AS v FROM e)
SELECT CAST(least(greatest((SELECT place FROM s ORDER BY v DESC, place LIMIT 1), 8), 40, (SELECT count(*) FROM o)) AS BIGINT) AS cut""")
def knee_cut(spark, sf_dir):
    o = table(spark, sf_dir, "topic_bank").select(F.row_number().over(Window.orderBy(F.desc("mass"), "topic_id")).alias("place"), F.col("mass").alias("score"))
    return SE.knee(o)


@query(f"""WITH s AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS text FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS a FROM documents)),
{_tfidf_sql('SELECT * FROM s', 1, False, 'doc_id, pos', 'doc_id')}, n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), c AS (SELECT a.doc_id, sum(a.weight * b.weight) AS t FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.term = b.term AND b.pos = a.pos + 1 GROUP BY a.doc_id)
SELECT d.doc_id AS id, round(CASE WHEN n > 1 THEN least(1.0, coalesce(t, 0) / (n - 1)) ELSE 0 END, 5) AS cohesion FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""")
def lexical_cohesion(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return SN.cohesion(d).select("id", F.round("cohesion", 5).alias("cohesion"))


_ASKED = "streaming subscribers and advertising measurement"


@query(f"""WITH s0 AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS text FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS a FROM documents)),
many AS (SELECT doc_id FROM s0 GROUP BY doc_id HAVING count(*) > 1), s AS (SELECT * FROM s0 WHERE doc_id IN (SELECT doc_id FROM many) UNION ALL SELECT doc_id, -1, coalesce(title, '') FROM documents JOIN many USING (doc_id) UNION ALL SELECT doc_id, -2, '{_ASKED}' FROM many),
{_tfidf_sql('SELECT * FROM s', 1, False, 'doc_id, pos', 'doc_id')}, m AS (SELECT v.doc_id, v.pos, sum(v.weight * (0.7 * coalesce(q.weight, 0) - 0.3 * coalesce(t.weight, 0))) AS m FROM v LEFT JOIN v q ON q.doc_id = v.doc_id AND q.term = v.term AND q.pos = -2 LEFT JOIN v t ON t.doc_id = v.doc_id AND t.term = v.term AND t.pos = -1 WHERE v.pos >= 0 GROUP BY ALL),
b AS (SELECT s0.doc_id, s0.text, row_number() OVER (PARTITION BY s0.doc_id ORDER BY round(coalesce(m, 0), 9) DESC, s0.pos) AS k FROM s0 JOIN many USING (doc_id) LEFT JOIN m USING (doc_id, pos))
SELECT d.doc_id AS id, coalesce(b.text, substring(d.text, 1, 240)) AS sentence FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id AND k = 1""")
def sentence_mmr(spark, sf_dir):
    return SN.best_sentence(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "title", "text"), _ASKED)


@query()
def item_entities(spark, sf_dir):
    e = E.item_entities(_one_item(_items(spark, sf_dir)))
    return E.signal_entities(e, table(spark, sf_dir, "sources"))


@query()
def tuned_weights(spark, sf_dir):
    w = WT.tune(table(spark, sf_dir, "cluster_signals"), WT.latest_weights(table(spark, sf_dir, "scorer_weights")))
    return spark.createDataFrame(sorted((w or {}).items()), "term string, weight double")


@query(f"""WITH h AS (SELECT DISTINCT CAST(topic_id AS VARCHAR) AS entity, week FROM cluster_signals WHERE topic_id IS NOT NULL), w AS (SELECT DISTINCT week FROM h ORDER BY week DESC LIMIT 3), now AS (SELECT DISTINCT entity FROM h WHERE week >= '2026-W20'),
a AS (SELECT entity AS name, count(*) AS k FROM h WHERE week IN (SELECT week FROM w) AND entity IN (SELECT entity FROM now) GROUP BY entity HAVING count(*) >= 3 ORDER BY k DESC, name DESC LIMIT 5),
o AS (SELECT * FROM h WHERE week <> '{WEEK}'), r AS (SELECT DISTINCT week FROM o ORDER BY week DESC LIMIT 6), l AS (SELECT entity AS name, max(week) AS last_week FROM o WHERE week IN (SELECT week FROM r) GROUP BY entity),
b AS (SELECT name, {_between(f"'{WEEK}'", 'last_week')} AS k FROM l WHERE name IN (SELECT entity FROM now) AND {_between(f"'{WEEK}'", 'last_week')} >= 4 ORDER BY k DESC, name DESC LIMIT 5),
t AS (SELECT topic_id, 'topic#' || topic_id AS name, weeks_seen, {_between(f"'{WEEK}'", 'last_week')} AS gap FROM topic_bank),
c AS (SELECT name, weeks_seen AS k FROM t WHERE weeks_seen >= 3 ORDER BY weeks_seen DESC, name DESC, topic_id LIMIT 3), d AS (SELECT name, gap AS k FROM t WHERE gap >= 4 ORDER BY gap DESC, name DESC, topic_id LIMIT 3),
u AS (SELECT 1 AS section, k, name, name || ': in ' || k || ' weeks running' AS line FROM a UNION ALL SELECT 2, k, name, name || ': back after ' || k || ' weeks' FROM b UNION ALL SELECT 3, k, name, name || ': ' || k || ' weeks' FROM c UNION ALL SELECT 4, k, name, name || ': back after ' || k || ' weeks' FROM d)
SELECT CAST(section AS INT) AS section, CAST(row_number() OVER (PARTITION BY section ORDER BY k DESC, name DESC, line) AS INT) AS place, line FROM u WHERE (SELECT count(DISTINCT week) FROM h) >= 2""")
def longitudinal_lines(spark, sf_dir):
    s = table(spark, sf_dir, "cluster_signals").filter("topic_id is not null").select(F.col("topic_id").cast("string").alias("entity"), "week")
    b = table(spark, sf_dir, "topic_bank")
    return CX.context_lines(E.history(s), s.filter(F.col("week") >= "2026-W20"), b, b.select("topic_id", F.concat(F.lit("topic#"), F.col("topic_id").cast("string")).alias("label")), WEEK)


@query()
def metric_report(spark, sf_dir):
    """The report's eight metrics in long form: (metric, week, name, value)."""
    tables = {"coverage_ledger": _ledger(spark, sf_dir), "topic_bank": table(spark, sf_dir, "topic_bank"), "cluster_signals": table(spark, sf_dir, "cluster_signals"), "entity_history": _hist(spark, sf_dir)}
    rows = [(m, w, k, float(x) if x is not None else None) for m, weeks in RP.metric_report(tables).items() for w, v in weeks.items() if isinstance(v, dict) for k, x in v.items()]
    return spark.createDataFrame(rows, "metric string, week string, name string, value double")


_LINES = """(SELECT doc_id, generate_subscripts(a, 1) - 1 AS no, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))"""


@query(f"SELECT doc_id, no, trim(regexp_replace(line, '^\\s*[-*•]\\s+', '')) AS bullet FROM {_LINES} WHERE regexp_matches(line, '^\\s*[-*•]\\s+\\S')")
def bullets(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    return RP.bullets(lines, "line").select("doc_id", F.col("no").cast("bigint").alias("no"), F.trim("bullet").alias("bullet"))


def _spotlight(spark, sf_dir):
    """A spotlight text per sector order, written from the sources table: headings and picks as a reply would have them."""
    s = table(spark, sf_dir, "sources").filter("sector is not null").select("sector", "source", F.row_number().over(Window.partitionBy("sector").orderBy("source")).alias("n"))
    head = s.filter("n = 1").select("sector", F.lit(0).alias("n"), F.concat(F.lit("## "), F.upper("sector")).alias("line")).unionByName(s.filter("n = 1").select("sector", F.lit(1).alias("n"), F.lit("### Market").alias("line")))
    lines = head.unionByName(s.select("sector", (F.col("n") + 1).alias("n"), F.concat(F.lit("- C"), (F.col("n") % 3 + 1).cast("string"), F.lit(": "), F.col("source")).alias("line")))
    return lines.select(F.lit("doc").alias("doc"), F.row_number().over(Window.orderBy("sector", "n")).alias("no"), "line")  # some fifty lines


@query("""WITH s AS (SELECT sector, source, row_number() OVER (PARTITION BY sector ORDER BY source) AS n FROM sources WHERE sector IS NOT NULL), p AS (SELECT 'C' || (n % 3 + 1) AS label, source AS pick, sector, row_number() OVER (PARTITION BY n % 3 ORDER BY sector, n) AS k FROM s)
SELECT label, pick, sector, 'market' AS category FROM p WHERE k = 1""")
def spotlight_picks(spark, sf_dir):
    sectors = [r[0] for r in table(spark, sf_dir, "sources").filter("sector is not null").select("sector").distinct().collect()]  # configuration
    lines = RP.carried_headings(_spotlight(spark, sf_dir), "doc", "no", "line", sectors, ["market"])
    return RP.picks(lines, "doc", "no", "line").select("label", "pick", "sector", "category")


@query("SELECT 'doc' AS doc, row_number() OVER (ORDER BY sector) AS section, upper(sector) AS title, count(*) + 1 AS n_lines FROM sources WHERE sector IS NOT NULL GROUP BY sector")
def spotlight_sections(spark, sf_dir):
    return RP.sections(_spotlight(spark, sf_dir), "doc", "no", "line").select("doc", F.col("section").cast("bigint").alias("section"), "title", "n_lines")


@query("""WITH k AS (SELECT *, row_number() OVER (ORDER BY coalesce(o, 99), score DESC NULLS LAST, week, topic_id) AS no FROM (SELECT week, topic_id, score, topic_id % 5 AS o FROM """ + SIG1 + """ WHERE topic_id IS NOT NULL)) SELECT 'C' || no AS label, week, topic_id FROM k""")
def cluster_numbering(spark, sf_dir):
    s = WT.one_per_topic(table(spark, sf_dir, "cluster_signals").filter("topic_id is not null"))
    sectors = spark.createDataFrame([(f"s{i}", i) for i in range(5)], "sector string, ord int")
    c = s.select(F.struct("week", "topic_id").alias("cluster"), F.concat(F.lit("s"), (F.col("topic_id") % 5).cast("string")).alias("sector"), F.lit("market").alias("category"), "score")
    return RP.number_clusters(c, sectors, spark.createDataFrame([("market", 0)], "category string, ord int")).select("label", "cluster.week", "cluster.topic_id")


@query()
def streaming_ingest(spark, sf_dir):
    """The items table as a stream of files, ingested once: (id, source, url) of the first row of each id."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    from ..streaming import ingest as IN

    root = f"{checkpoint_dir(spark)}/ingest-{uuid4().hex}"
    IN.ingest(IN.item_stream(spark, _stream_path(sf_dir, "items")), f"{root}/items", f"{root}/state").awaitTermination()
    return spark.read.schema(ST.SCHEMAS["items"]).parquet(f"{root}/items").select("id", "source", "url")


SQL["streaming_ingest"] = f"SELECT id, source, url FROM {ITEM1}"


@query()
def page_links(spark, sf_dir):
    """Index pages written from each newsroom's items, and the article links found on them."""
    i = _one_item(_items(spark, sf_dir)).filter("url is not null and title is not null").join(table(spark, sf_dir, "sources").filter("kind = 'newsroom'").select("source", F.col("url").alias("base")), "source")
    shelf = F.substring("id", 1, 3)  # a newsroom's items on index pages of some dozens at most
    a = F.concat(F.lit('<a href="'), F.col("url"), F.lit('?ref=index">'), F.replace("title", F.lit("<"), F.lit("")), F.lit("</a>"))
    pages = i.groupBy("source", "base", shelf.alias("shelf")).agg(F.concat(F.lit("<html><nav><a href='/about'>About this newsroom and its people</a></nav>"), F.array_join(F.sort_array(F.collect_list(a)), "\n"), F.lit("</html>")).alias("html"))
    return IG.page_links(pages, skip=("/about",))


@query(f"""WITH n AS (SELECT id, source, url FROM {ITEM1} WHERE source IN (SELECT source FROM sources WHERE kind = 'newsroom')), s AS (SELECT DISTINCT url FROM n WHERE substring(id, 1, 1) < '8')
SELECT source, url, n FROM (SELECT source, url, row_number() OVER (PARTITION BY source ORDER BY place, url) AS n FROM (SELECT source, url, length(url) AS place FROM n WHERE url NOT IN (SELECT url FROM s))) WHERE n <= 6""")
def unknown_links(spark, sf_dir):
    """Newsroom links of which the first half is stored; the shortest unknown ones of each source."""
    n = _one_item(_items(spark, sf_dir)).join(table(spark, sf_dir, "sources").filter("kind = 'newsroom'").select("source").distinct(), "source", "left_semi").select("id", "source", "url", F.length("url").alias("place"))
    new = IG.unknown_links(n, n.filter("substring(id, 1, 1) < '8'"))
    return new.select("source", "url", F.row_number().over(Window.partitionBy("source").orderBy("place", "url")).alias("n"))


@query(f"""WITH h AS {HIST}, v AS (SELECT week AS cluster_id, entity, count, count * 1.0 / length(entity) AS velocity FROM h)
SELECT cluster_id, entity, count, round(velocity, 6) AS velocity, place FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY count DESC, velocity DESC, entity) AS place FROM v) WHERE place <= 5""")
def top_entities(spark, sf_dir):
    h = _hist(spark, sf_dir).select(F.col("week").alias("cluster_id"), "entity", "count", (F.col("count") / F.length("entity")).alias("velocity"))
    return E.top_entities(h).select("cluster_id", "entity", "count", _r("velocity").alias("velocity"), "place")


@query(f"""SELECT id, {_norm_sql('title')} || ' ' || {_norm_sql("coalesce(body, '')")} || ' ' || 'ent_' || replace(lower(source), ' ', '_') AS text FROM {ITEM1}""")
def augmented_text(spark, sf_dir):
    return _one_item(_items(spark, sf_dir)).select("id", X.augmented(F.col("title"), F.col("body"), F.array("source")).alias("text"))


@query("SELECT event_id, 'k' AS label, CAST(json_extract(props, '$.k') AS VARCHAR) AS descriptor FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def reply_salvage(spark, sf_dir):
    """Objects in the midst of prose: the events' properties as a reply would give them."""
    reply = F.concat(F.lit("Here you are:\n"), F.col("props"), F.lit("\nThat is all."))
    return table(spark, sf_dir, "events").select("event_id", F.explode(X.labelled_objects(reply)).alias("e")).select("event_id", "e.label", "e.descriptor").filter("label = 'k'")


@query("""SELECT source AS aspect, kind AS descriptor, 'new' AS profile_hash FROM sources
UNION ALL SELECT source, 'kept', 'old' FROM sources WHERE false""")
def aspect_cache_refresh(spark, sf_dir):
    """Aspects derived from a former profile are replaced as a whole."""
    s = table(spark, sf_dir, "sources")
    cache = s.select(F.col("source").alias("aspect"), F.lit("kept").alias("descriptor"), F.when(F.length("source") % 2 == 0, "new").otherwise("old").alias("profile_hash"))
    return ST.refreshed(cache, s.select(F.col("source").alias("aspect"), F.col("kind").alias("descriptor")), "new")


@query("""WITH s AS (SELECT sector, source, row_number() OVER (PARTITION BY sector ORDER BY source) AS n FROM sources WHERE sector IS NOT NULL), p AS (SELECT 'C' || (n % 3 + 1) AS label, source AS pick, row_number() OVER (PARTITION BY n % 3 ORDER BY sector, n) AS k FROM s)
SELECT label, pick, 'cluster of ' || label AS cluster FROM p WHERE k = 1 AND label IN ('C1', 'C3')""")
def spotlight_clusters(spark, sf_dir):
    """Spotlight picks joined to the clusters C1 and C3; a pick of another label drops out."""
    clusters = spark.createDataFrame([(c, f"cluster of {c}") for c in ("C1", "C3", "C9")], "label string, cluster string")
    return RP.picked_clusters(spotlight_picks(spark, sf_dir), clusters).select("label", "pick", "cluster")


def _stream_path(sf_dir: str, name: str) -> str:
    """A folder that a stream can read: the table's own, or the one file of it by a pattern."""
    import os

    return f"{sf_dir}/{name}.parquet" if os.path.isdir(f"{sf_dir}/{name}.parquet") else f"{sf_dir}/{name}.parque[t]"


def _event_stream(spark, sf_dir):
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(_stream_path(sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT strftime(date_trunc('week', ts), '%Y-W%V') AS week, event_type, count(*) AS count FROM events GROUP BY ALL")
def streaming_weekly_counts(spark, sf_dir):
    """Events as a stream of files, counted by week; what the last batch leaves."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    from ..streaming import ingest as IN

    root = f"{checkpoint_dir(spark)}/weekly-{uuid4().hex}"
    counts = IN.weekly_counts(_event_stream(spark, sf_dir), "ts", ["event_type"])
    counts.writeStream.outputMode("complete").foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("SELECT DISTINCT user_id FROM events")
def streaming_distinct_users(spark, sf_dir):
    """The first event of every user within a delay longer than the stream."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    from ..streaming import ingest as IN

    root = f"{checkpoint_dir(spark)}/distinct-{uuid4().hex}"
    users = IN.distinct_within(_event_stream(spark, sf_dir).select("user_id", "ts"), "user_id", "ts", "400 days").select("user_id")
    users.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id bigint").parquet(f"{root}/out")


@query("SELECT week, 'https://pages.example/' || week || '.html' AS url FROM (SELECT DISTINCT week FROM cluster_signals ORDER BY week DESC LIMIT 8)")
def archive_links(spark, sf_dir):
    return D.archive_links(table(spark, sf_dir, "cluster_signals"), "https://pages.example/")


@query(f"SELECT week, topic_id, coalesce(score, 0) AS score, coalesce(trend, 0) AS trend, coalesce(persistence_rate, -1) AS persistence_rate FROM {SIG1} WHERE topic_id IS NOT NULL AND week = (SELECT max(week) FROM cluster_signals)")
def persist_signals(spark, sf_dir):
    """The last week's clusters written to an empty table."""
    s = WT.one_per_topic(table(spark, sf_dir, "cluster_signals"))
    last = s.agg(F.max("week").alias("week"))
    new = s.join(F.broadcast(last), "week", "left_semi").drop("week")
    week = last.collect()[0]["week"] or ""
    return D.persist_signals(spark.createDataFrame([], ST.SCHEMAS["cluster_signals"]), new, week).select("week", "topic_id", "score", "trend", "persistence_rate")


@query()
def score_clusters(spark, sf_dir):
    """All signals of 256 mixed clusters, against stored topics, a history of the items' own entities and a ledger of the aspects."""
    i = cut(_one_item(_items(spark, sf_dir)).withColumn("text", F.concat_ws(" ", "title", "body")))
    clusters = i.select("id", F.substring("id", 1, 2).alias("cluster"))
    v = cut(V.tfidf(i.select("id", F.coalesce("title", F.lit("")).alias("text")), ["id"]))
    topics = cut(C.medoids(v, i.select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("cluster"))).join(v, "id").select((F.col("cluster") + 1).alias("topic_id"), "term", "weight"))
    ages = i.select("id", W.rfc822_age_days(F.col("ts"), F.lit(NOW).cast("timestamp")).alias("age_days"))
    entities = cut(E.item_entities(i))
    hist = cut(E.history(entities.select("entity", F.concat(F.lit("2026-W"), (F.pmod(F.xxhash64("id"), F.lit(8)) + 10).cast("string")).alias("week"))))
    asked = lambda k: table(spark, sf_dir, "eval_items").filter(f"eval_id % 20 = {k}").select(F.col("eval_id").alias("query_id"), "text")
    parts = table(spark, sf_dir, "lineitem").groupBy(W.week_key(F.col("l_shipdate")).alias("week"), (F.col("l_partkey") % 12 * 20).cast("string").alias("aspect")).agg(F.count("*").alias("n"))
    ledger = cut(parts.join(parts.groupBy("week").agg(F.max("n").alias("top")), "week").select("week", "aspect", (F.col("n") / F.col("top")).alias("coverage")))
    keys = entities.filter(F.col("entity").startswith("Ostrava")).select("entity")
    out = D.score_clusters(i.select("id", "source", "text"), clusters, v, entities, hist, table(spark, sf_dir, "sources").withColumn("prior", F.round(0.5 + F.length("source") % 7 / 10, 1)), asked(0), asked(10), table(spark, sf_dir, "topic_bank"), topics, ledger, ages, WEEK, keys)
    return out.select("cluster", "medoid", "topic_id", *[F.round(c, 6).alias(c) for c in (*S.DEFAULT_WEIGHTS, "score")])
