"""A directory of Parquet tables on any file system: keyed writes, windows, export, lock."""

from __future__ import annotations

import os
import time
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The tables' columns.
SCHEMAS = {
    "items": "id string, source string, title string, url string, body string, ts string, ingested_at string, used_in_digest boolean",
    "digests": "week string, summary string, created_at timestamp",
    "digest_terms": "week string, cluster_no bigint, term string, weight double",
    "feed_cache": "url string, etag string, last_modified string, checked_at timestamp",
    "entity_history": "entity string, week string, count bigint",
    "macro_trends": "month string, summary string, weeks array<string>, created_at timestamp",
    "profile_aspects": "aspect string, descriptor string, profile_hash string, created_at timestamp",
    "profile_exclusions": "aspect string, descriptor string, profile_hash string, created_at timestamp",
    "coverage_ledger": "week string, aspect string, coverage double",
    "topic_bank": "topic_id bigint, mass double, first_week string, last_week string, weeks_seen bigint",
    "topic_terms": "topic_id bigint, term string, weight double",
    "cluster_signals": "week string, topic_id bigint, coverage double, prior double, novelty double, relevance double, entity_signal double, trend double, richness double, coverage_gap double, profile_exclusion double, persistence_rate double, persistence double, source_breadth double, recency_decay double, score double",
    "scorer_weights": "week string, weights map<string,double>, created_at timestamp",
}


def insert_or_ignore(stored: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of batch to append: the first of each key in the given order, and only keys that are not stored."""
    first = batch.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__n = 1").drop("__n")
    return first.join(stored.select(key), key, "left_anti")


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """stored with batch written over it: the last row of each key in the given order wins."""
    both = stored.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("__new"), *[F.desc(o) for o in order])
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__new")


def mark_used(items: DataFrame, ids: DataFrame) -> DataFrame:
    """items with used_in_digest set for the given ids."""
    hit = ids.select("id").distinct().withColumn("__hit", F.lit(True))
    return items.join(hit, "id", "left").withColumn("used_in_digest", F.coalesce(F.col("__hit") | F.col("used_in_digest"), F.col("__hit"), F.lit(False))).drop("__hit")


def refresh_validators(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """feed_cache after a fetch (url, status, etag, last_modified, checked_at): status 304 keeps the old validators; a NULL status
    means the fetch failed and leaves its row alone."""
    new = fetched.filter("status is not null").select(F.col("url"), F.col("status"), F.col("etag").alias("__e"), F.col("last_modified").alias("__l"), F.col("checked_at").alias("__c"))
    kept = F.col("status").isNull() | (F.col("status") == 304)
    j = cache.join(new, "url", "full")
    return j.select("url", F.when(kept, F.col("etag")).otherwise(F.col("__e")).alias("etag"), F.when(kept, F.col("last_modified")).otherwise(F.col("__l")).alias("last_modified"), F.coalesce("__c", "checked_at").alias("checked_at"))


def fresh_or_none(cache: DataFrame, profile_hash: str) -> DataFrame:
    """Derived rows if the table is not empty and all carry the current hash, else none: then they are to be derived anew."""
    state = cache.agg(F.count("*").alias("n"), F.count_if(~F.col("profile_hash").eqNullSafe(profile_hash)).alias("stale"))
    return cache.crossJoin(F.broadcast(state.filter("n > 0 and stale = 0").select())).select(*cache.columns)  # one row or none


def refreshed(cache: DataFrame, derived: DataFrame, profile_hash: str) -> DataFrame:
    """The cache as it is if fresh_or_none keeps it, else the newly derived rows (without profile_hash) alone, under the current hash."""
    kept = fresh_or_none(cache, profile_hash)
    none = kept.agg(F.count("*").alias("n")).filter("n = 0").select()
    return kept.unionByName(derived.withColumn("profile_hash", F.lit(profile_hash)).crossJoin(F.broadcast(none)), allowMissingColumns=True)


def migrate(df: DataFrame, schema: str) -> DataFrame:
    """df with the columns of schema that it lacks, as NULL, and in the schema's order; other columns are kept behind."""
    empty = df.sparkSession.createDataFrame([], schema)
    both = empty.unionByName(df, allowMissingColumns=True)
    return both.select(*empty.columns, *[c for c in df.columns if c not in empty.columns])


def rolling_window(items: DataFrame, instants: DataFrame, now_ms: int, days: int = 7) -> DataFrame:
    """Items ingested in the last `days` days before now, by instant; used items stay in."""
    recent = instants.filter((F.col("field") == "ingested_at") & (F.col("utc_ms") >= now_ms - days * 86_400_000) & (F.col("utc_ms") <= now_ms)).select("id").distinct()
    return items.join(recent, "id", "left_semi")


def _on(spark: SparkSession, path: str):
    """(file system, path): a path on whatever file system Hadoop knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small text file; with overwrite=False an error if it is there."""
    fs, p = _on(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Names of a table's marks, oldest first: an empty file for each whole version, named by its number and its folder."""
    fs, p = _on(spark, f"{root}/{name}/_versions")
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table's latest version, or an empty one of its schema; columns added later come out as NULL."""
    marks = _versions(spark, root, name)
    if not marks:
        return spark.createDataFrame([], SCHEMAS[name])
    return migrate(spark.read.option("mergeSchema", True).parquet(f"{root}/{name}/{marks[-1].split('-', 1)[1]}"), SCHEMAS[name])


def swap(df: DataFrame, root: str, name: str) -> None:
    """Write a table as a new version, then mark it: creating the mark is one step on every file system, so that a reader finds the
    former version or the new one. The version before stays for those who read it; older ones are removed."""
    spark, folder = df.sparkSession, f"data_{uuid4().hex}"
    df.write.parquet(f"{root}/{name}/{folder}")
    marks = _versions(spark, root, name)
    number = int(marks[-1].split("-", 1)[0]) + 1 if marks else 1
    write_text(spark, f"{root}/{name}/_versions/{number:012d}-{folder}", "", overwrite=False)
    for old in marks[:-1]:
        for gone in (f"{root}/{name}/_versions/{old}", f"{root}/{name}/{old.split('-', 1)[1]}"):
            fs, p = _on(spark, gone)
            fs.delete(p, True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One object a line, characters beyond ASCII as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


@contextmanager
def pipeline_lock(spark: SparkSession, path: str, ttl: float = 1800.0):
    """Exclusive lock file: refused while younger than ttl seconds, else taken over; released whatever happens. Whoever creates the
    file holds the lock, so of two that come at once one gets an error."""
    fs, p = _on(spark, path)
    if fs.exists(p):
        age = time.time() - fs.getFileStatus(p).getModificationTime() / 1000
        if age < ttl:
            raise RuntimeError(f"locked {age:.0f} s ago: {path}")
        fs.delete(p, False)
    write_text(spark, path, str(os.getpid()), overwrite=False)
    try:
        yield
    finally:
        fs.delete(p, False)
