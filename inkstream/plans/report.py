"""Digest text and reports: small, selected results brought to the driver and written as text or HTML."""

from __future__ import annotations

import html
import json
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import longitudinal as L
from ..operators.ranking import numbered
from ..operators.store import write_text


def number_clusters(clusters: DataFrame, sectors: DataFrame, categories: DataFrame) -> DataFrame:
    """(label, cluster, ...): C1..Cn by sector order, category order, score descending, id."""
    j = clusters.join(sectors.select("sector", F.col("ord").alias("__s")), "sector", "left").join(categories.select("category", F.col("ord").alias("__c")), "category", "left")
    order = [F.col("__s").asc_nulls_last(), F.col("__c").asc_nulls_last(), F.desc("score"), F.col("cluster")]
    return numbered(j, order, "no").withColumn("label", F.concat(F.lit("C"), F.col("no").cast("string"))).drop("__s", "__c")


def cluster_blocks(numbered: DataFrame, items: DataFrame, head: int = 5) -> DataFrame:
    """(no, block): one text block a cluster with its sources and titles; items: (cluster, pos, source, title)."""
    top = items.withColumn("n", F.row_number().over(Window.partitionBy("cluster").orderBy("pos"))).filter(F.col("n") <= head)
    b = top.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_set(F.upper("source"))), ", ").alias("sources"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "title"))), lambda x: F.concat(F.lit("- "), x["title"])), "\n").alias("titles"))
    return numbered.join(b, "cluster", "left").select("no", F.concat_ws("\n", F.concat_ws(" ", F.concat(F.lit("["), F.col("label"), F.lit("]")), "sector", "category", F.concat(F.lit("("), F.coalesce("sources", F.lit("")), F.lit(")"))), F.coalesce("titles", F.lit(""))).alias("block"))


def carried_headings(lines: DataFrame, doc: str, no: str, text: str, sectors: list[str], categories: list[str]) -> DataFrame:
    """(doc, no, text, sector, category): ## lines set the sector and clear the category, ### lines set the category, names compared
    without case; an unknown name carries NULL on."""
    pick = lambda level, names: F.when(F.lower(F.trim(F.regexp_extract(text, rf"^{level}\s*([^#].*)$", 1))).isin(*[n.lower() for n in names]), F.lower(F.trim(F.regexp_extract(text, rf"^{level}\s*([^#].*)$", 1))))
    is2, is3 = F.col(text).rlike(r"^##\s*[^#]"), F.col(text).rlike(r"^###\s*[^#]")
    w = Window.partitionBy(doc).orderBy(no)
    head2 = F.last(F.when(is2, F.struct(pick("##", sectors).alias("v"), F.col(no).alias("at"))), ignorenulls=True).over(w)
    head3 = F.last(F.when(is2 | is3, F.struct(F.when(is3, pick("###", categories)).alias("v"))), ignorenulls=True).over(w)
    return lines.select(doc, no, text, head2["v"].alias("sector"), head3["v"].alias("category"))


def picks(lines: DataFrame, doc: str, no: str, text: str) -> DataFrame:
    """First `- Cn: text` line of each cluster label under a known sector and category: (doc, no, label, pick, sector, category)."""
    label, rest = F.regexp_extract(text, r"^\s*[-*•]\s*(C\d+)\s*:\s*(.+)$", 1), F.trim(F.regexp_extract(text, r"^\s*[-*•]\s*(C\d+)\s*:\s*(.+)$", 2))
    p = lines.select(doc, no, label.alias("label"), rest.alias("pick"), "sector", "category").filter("label <> '' and sector is not null and category is not null")
    return p.withColumn("__n", F.row_number().over(Window.partitionBy(doc, "label").orderBy(no))).filter("__n = 1").drop("__n")


def picked_clusters(picked: DataFrame, numbered_clusters: DataFrame) -> DataFrame:
    """Picks (label, ...) with their clusters (label, cluster): labels that no cluster has drop out."""
    return picked.join(numbered_clusters.select("label", "cluster"), "label")


def sections(lines: DataFrame, doc: str, no: str, text: str) -> DataFrame:
    """(doc, section, title, n_lines): text parted at ## lines; what stands before the first has a NULL title."""
    head = F.col(text).rlike(r"^##\s*[^#]")
    s = lines.withColumn("section", F.sum(head.cast("int")).over(Window.partitionBy(doc).orderBy(no)))
    return s.groupBy(doc, "section").agg(F.max(F.when(head, F.trim(F.regexp_replace(text, r"^##\s*", "")))).alias("title"), F.count_if(~head).alias("n_lines"))


def bullets(lines: DataFrame, text: str) -> DataFrame:
    """Lines that begin with -, * or •, without the mark."""
    return lines.filter(F.col(text).rlike(r"^\s*[-*•]\s+\S")).withColumn("bullet", F.regexp_replace(text, r"^\s*[-*•]\s+", ""))


def show(x: float | None) -> str:
    return "" if x is None else "inf" if math.isinf(x) else f"{x:.3f}"


def sparkline(values: list, width: int = 160, height: int = 32) -> str:
    """An SVG line of the finite numbers; empty with fewer than two."""
    v = [float(x) for x in values if isinstance(x, (int, float)) and not isinstance(x, bool) and math.isfinite(x)]
    if len(v) < 2:
        return f'<svg width="{width}" height="{height}"></svg>'
    lo, span = min(v), (max(v) - min(v)) or 1.0
    pts = " ".join(f"{i * width / (len(v) - 1):.1f},{height - (x - lo) / span * height:.1f}" for i, x in enumerate(v))
    return f'<svg width="{width}" height="{height}"><polyline fill="none" stroke="currentColor" points="{pts}"/></svg>'


def metric_report(tables: dict[str, DataFrame], weeks: int = 12) -> dict:
    """{metric: {week: {name: value}}} of the latest weeks; a metric that fails gives its error, one without weeks is marked."""
    last = lambda df: df.select("week").distinct().orderBy(F.desc("week")).limit(weeks)
    t = tables
    plan = {
        "coverage_completeness": lambda: L.completeness(t["coverage_ledger"]),
        "coverage_balance": lambda: L.balance(t["coverage_ledger"]),
        "debt_burndown": lambda: L.debt_burndown(t["coverage_ledger"], weeks),
        "topic_maturity": lambda: L.topic_maturity(t["topic_bank"], last(t["cluster_signals"])),
        "recurrence_mix": lambda: L.recurrence_mix(t["cluster_signals"], t["topic_bank"]),
        "richness_trend": lambda: L.mean_by_week(t["cluster_signals"], "richness", "richness"),
        "vocabulary_growth": lambda: L.vocabulary_growth(t["entity_history"]),
        "persistence_auc": lambda: L.persistence_auc(t["cluster_signals"], last(t["cluster_signals"])),
    }
    out: dict = {}
    for name, make in plan.items():
        try:
            rows = make().orderBy(F.desc("week")).limit(weeks).collect()
            out[name] = {r["week"]: {k: r[k] for k in r.asDict() if k != "week"} for r in reversed(rows)} or {"insufficient_history": True}
        except Exception as e:  # one metric's failure leaves the others
            out[name] = {"error": f"{type(e).__name__}: {str(e)[:200]}"}
    return out


def as_text(report: dict) -> str:
    line = lambda v: ", ".join(f"{k} {show(x) if isinstance(x, float) else x}" for k, x in v.items())
    return "\n".join(f"{m}\n" + "\n".join(f"  {w}: {line(v) if isinstance(v, dict) else v}" for w, v in weeks.items()) for m, weeks in report.items())


def as_html(report: dict, title: str = "Coverage") -> str:
    rows = []
    for m, weeks in report.items():
        series = [next((x for x in v.values() if isinstance(x, (int, float))), None) for v in weeks.values() if isinstance(v, dict)]
        rows.append(f"<tr><td>{html.escape(m)}</td><td>{sparkline(series)}</td><td><pre>{html.escape(json.dumps(weeks, ensure_ascii=False, default=str)[:2000])}</pre></td></tr>")
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><table>{''.join(rows)}</table>"


def digest_html(week: str, picked: list[dict]) -> str:
    """A digest page of picks (sector, category, title, url), grouped in the given order."""
    out, sector = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(week)}</title><h1>{html.escape(week)}</h1>"], None
    for p in picked:
        if p["sector"] != sector:
            sector = p["sector"]
            out.append(f"<h2>{html.escape(sector)}</h2>")
        out.append(f'<p>{html.escape(p["category"])}: <a href="{html.escape(p["url"])}">{html.escape(p["title"])}</a></p>')
    return "".join(out)


def write_page(spark: SparkSession, text: str, folder: str, week: str) -> list[str]:
    """The page as latest and under its week, on any file system."""
    names = [f"{folder}/latest.html", f"{folder}/{week}.html"]
    for n in names:
        write_text(spark, n, text)
    return names


def main(argv: list[str] | None = None) -> None:
    """python -m inkstream.plans.report STORE [--weeks N] [--metric NAME] [--format text|json|html]"""
    import argparse

    from ..operators.store import read
    from ..session import get_spark

    p = argparse.ArgumentParser()
    p.add_argument("store")
    p.add_argument("--weeks", type=int, default=12)
    p.add_argument("--metric")
    p.add_argument("--format", choices=("text", "json", "html"), default="text")
    a = p.parse_args(argv)
    spark = get_spark("report")
    report = metric_report({n: read(spark, a.store, n) for n in ("coverage_ledger", "topic_bank", "cluster_signals", "entity_history")}, a.weeks)
    report = {a.metric: report[a.metric]} if a.metric else report
    print({"text": as_text, "html": as_html, "json": lambda r: json.dumps(r, ensure_ascii=False, default=str)}[a.format](report))


if __name__ == "__main__":
    main()
