"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from .boilerplate import boilerplate_lines, main_text
from .encoding import garbled_values, restored_values
from .fusion import LOWER_IS_BETTER, MISSING, SIGNALS, borda
from .leaks import leaks, removal_spans
from .mixing import mix
from .quality import outliers
from .repeated_lines import repeated_lines, without_repeated_lines
from .residue import residue, without_residue
from .truncation import truncated, truncation_by_source

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


@query(
    """
    WITH lines AS (
      SELECT id, source, pos AS line_no, regexp_replace(lower(arr[pos]), '[^\\p{L}]+', '', 'g') AS k
      FROM (SELECT id, source, string_split(body, chr(10)) AS arr FROM items WHERE body IS NOT NULL AND id IS NOT NULL AND source IS NOT NULL), unnest(range(1, len(arr) + 1)) AS t(pos)),
    n AS (SELECT source, count(DISTINCT id) AS n_items FROM items GROUP BY source),
    hot AS (SELECT source, k FROM lines JOIN n USING (source) WHERE k <> '' GROUP BY source, k, n_items HAVING count(DISTINCT id) >= 3 AND count(DISTINCT id) >= 0.05 * n_items)
    SELECT DISTINCT id, line_no FROM lines JOIN hot USING (source, k)
    """
)
def p7_found(spark, sf_dir):
    return repeated_lines(table(spark, sf_dir, "items"))[0].select("id", "line_no").distinct()


@query()
def p7_cleaned(spark, sf_dir):
    items = table(spark, sf_dir, "items")
    return without_repeated_lines(items, repeated_lines(items)[1]).select("id", "body_clean").distinct()


def _borda_sql() -> str:
    scores = ", ".join(SIGNALS)
    clean = ", ".join(f"CASE WHEN isnan({s}){f' OR {s} = {MISSING[s]}' if s in MISSING else ''} THEN NULL ELSE {'-' if s in LOWER_IS_BETTER else ''}{s} END AS {s}" for s in SIGNALS)
    one = ", ".join(f"s.{s} AS {s}" for s in SIGNALS)
    # DuckDB sorts NULL above numbers inside structs; a NULL is written as the least number to be the least here
    packed = ", ".join(f"{s} := coalesce({s}, '-infinity'::DOUBLE)" for s in SIGNALS)
    back = ", ".join(f"nullif(s.{s}, '-infinity'::DOUBLE) AS {s}" for s in SIGNALS)
    pts = ", ".join(
        f"CASE WHEN {s} IS NULL OR count({s}) OVER (PARTITION BY week) = 1 THEN 0.5 ELSE (count({s}) OVER (PARTITION BY week) - (rank() OVER (PARTITION BY week ORDER BY {s} DESC NULLS LAST) + (count(*) OVER (PARTITION BY week, {s}) - 1) / 2.0)) / (count({s}) OVER (PARTITION BY week) - 1) END AS points_{s}"
        for s in SIGNALS
    )
    total = " + ".join(f"points_{s}" for s in SIGNALS)
    return f"""
    WITH c AS (SELECT week, topic_id, {clean} FROM cluster_signals),
    m AS (SELECT week, topic_id, max(struct_pack({packed})) AS s FROM c GROUP BY week, topic_id),
    o AS (SELECT week, topic_id, {back} FROM m),
    p AS (SELECT week, topic_id, {pts} FROM o),
    t AS (SELECT week, topic_id, round({total}, 9) AS points FROM p)
    SELECT week, topic_id, points, row_number() OVER (PARTITION BY week ORDER BY points DESC, topic_id) AS place FROM t
    """


@query(_borda_sql())
def p3_ranking(spark, sf_dir):
    return borda(table(spark, sf_dir, "cluster_signals"), "week", "topic_id").select("week", "topic_id", "points", "place")


@query()
def p1_found(spark, sf_dir):
    return garbled_values(table(spark, sf_dir, "items"))


@query()
def p1_restored(spark, sf_dir):
    return restored_values(table(spark, sf_dir, "items"))


@query()
def p10_found(spark, sf_dir):
    return outliers(table(spark, sf_dir, "documents")).filter("is_outlier").select("doc_id").distinct()


@query()
def p10_statistics(spark, sf_dir):
    return outliers(table(spark, sf_dir, "documents"))


@query()
def p8_found(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "eval_id")


@query()
def p8_spans(spark, sf_dir):
    return removal_spans(leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")))


@query()
def p6_found(spark, sf_dir):
    return residue(table(spark, sf_dir, "items")).select("id")


@query()
def p6_clean_items(spark, sf_dir):
    return without_residue(table(spark, sf_dir, "items")).select("id", "source").distinct()


@query()
def p4_found(spark, sf_dir):
    return truncated(table(spark, sf_dir, "items")).filter("is_cut").select("id", "field").distinct()


@query()
def p4_by_source(spark, sf_dir):
    return truncation_by_source(table(spark, sf_dir, "items"))


@query()
def p9_repeats(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


@query()
def p9_shares(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


@query()
def p9_tempered(spark, sf_dir):
    """Shares under a budget of twice what the targets allow: the exponent moves from them to the sources' own shares."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), stretch=2.0)[1]


@query()
def p5_found(spark, sf_dir):
    return boilerplate_lines(table(spark, sf_dir, "items"), table(spark, sf_dir, "sources"))


@query()
def p5_main_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "items"), table(spark, sf_dir, "sources"))
