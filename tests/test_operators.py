import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstream.functions import text as X
from inkstream.operators import bank as BK
from inkstream.operators import cluster as C
from inkstream.operators import entities as E
from inkstream.operators import graph as G
from inkstream.operators import longitudinal as L
from inkstream.operators import ranking as RK
from inkstream.operators import retrieve as R
from inkstream.operators import selection as SE
from inkstream.operators import signals as S
from inkstream.operators import store as ST
from inkstream.operators import vectorize as V
from inkstream.operators import weights as WT
from inkstream.operators.graph import components
from inkstream.operators.instants import noncanonical_instants
from inkstream.operators.ranking import average_ranks
from inkstream.plans import export as EX
from inkstream.plans import report as RP
from inkstream.session import cut


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_or_ignore_twice(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, n int")
    stored = spark.createDataFrame([], "id string, n int")
    first = ST.insert_or_ignore(stored, batch, "id", ["n"])
    assert rows(first) == [("a", 1), ("b", 3)]
    assert ST.insert_or_ignore(first, batch, "id", ["n"]).count() == 0


def test_upsert_and_cache(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "k string, v int, seq int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2)], "k string, v int, seq int")
    assert rows(ST.upsert(old, new, ["k"], ["seq"])) == [("a", 1, 0), ("b", 3, 2)]
    asp = spark.createDataFrame([("x", "h1"), ("y", "h1")], "aspect string, profile_hash string")
    assert ST.fresh_or_none(asp, "h1").count() == 2 and ST.fresh_or_none(asp, "h2").count() == 0 and ST.fresh_or_none(asp.limit(0), "h1").count() == 0


def test_store_and_lock(spark, tmp_path):
    root = str(tmp_path)
    assert ST.read(spark, root, "topic_bank").count() == 0
    for n in (1, 2):
        ST.swap(spark.createDataFrame([(n, 1.0)], "topic_id bigint, mass double"), root, "topic_bank")
    assert [r["topic_id"] for r in ST.read(spark, root, "topic_bank").collect()] == [2]
    held = ST.read(spark, root, "topic_bank")  # a reader of the version before
    ST.swap(spark.createDataFrame([(3, 1.0)], "topic_id bigint, mass double"), root, "topic_bank")
    assert [r["topic_id"] for r in held.collect()] == [2] and [r["topic_id"] for r in ST.read(spark, root, "topic_bank").collect()] == [3]
    ST.swap(ST.read(spark, root, "topic_bank"), root, "topic_bank")  # from the table itself
    assert ST.read(spark, root, "topic_bank").count() == 1 and len(list((tmp_path / "topic_bank").glob("data_*"))) == 2
    lock = str(tmp_path / "lock")
    with ST.pipeline_lock(spark, lock):
        with pytest.raises(RuntimeError), ST.pipeline_lock(spark, lock):
            pass
        with ST.pipeline_lock(spark, lock, ttl=-1):  # taken over when too old
            pass
    with ST.pipeline_lock(spark, lock):
        pass


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y"\nz', None), ("é", "", 1)], "id string, t string, n int")
    ST.write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "c"))
    assert {r["id"]: r["t"] for r in back.collect()}["a"] == 'x "y"\nz'
    ST.write_json(df, str(tmp_path / "j"))
    assert any("é" in x.read_text() for x in (tmp_path / "j").glob("*.json")) and spark.read.json(str(tmp_path / "j")).count() == 2


def test_numbered_over_partitions(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("(id * 37) % 1000 AS x", "'n' AS n0")
    got = {r["x"]: r["no"] for r in RK.numbered(df, [F.desc("x")], "no").collect()}
    assert got == {x: 1000 - x for x in range(1000)}
    assert RK.numbered(df.limit(0), [F.col("x")], "no").count() == 0


@pytest.mark.parametrize("scores", [[], [1.0], [5.0, 4.0], [9.0, 8.9, 2.0, 1.9, 1.8], [float(50 - i - 10 * (i > 20)) for i in range(45)]])
def test_knee_against_loop(spark, scores):
    d = [a - b for a, b in zip(scores, scores[1:], strict=False)]
    v = [round(0.25 * (d[i - 1] if i else 0) + 0.5 * x + 0.25 * (d[i + 1] if i + 1 < len(d) else 0), 12) for i, x in enumerate(d)] if len(d) >= 3 else d
    at = v.index(max(v)) + 1 if v else 0
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores, 1)], "place bigint, score double")
    assert SE.knee(df).collect()[0]["cut"] == min(max(at, 8), 40, len(scores))


def test_refreshed_cache(spark):
    cache = spark.createDataFrame([("a", "d", "h1")], "aspect string, descriptor string, profile_hash string")
    new = spark.createDataFrame([("b", "e")], "aspect string, descriptor string")
    assert [r["aspect"] for r in ST.refreshed(cache, new, "h1").collect()] == ["a"] and [(r["aspect"], r["profile_hash"]) for r in ST.refreshed(cache, new, "h2").collect()] == [("b", "h2")]
    assert ST.refreshed(cache.limit(0), new, "h1").count() == 1


def test_reports_are_written(spark, tmp_path):
    lines = [{"sector": "a & b", "category": "c", "title": "t <x>", "url": "http://u"}, {"sector": "a & b", "category": "d", "title": "t2", "url": "http://v"}]
    page = RP.digest_html("2026-W01", lines)
    assert page.count("<h2>") == 1 and "t &lt;x&gt;" in page
    assert [open(n, encoding="utf-8").read() for n in RP.write_page(spark, page, str(tmp_path / "web"), "2026-W01")] == [page, page]
    items = spark.createDataFrame([("k", i, f"s{i % 2}", f"title {i}") for i in range(7)], "cluster string, pos int, source string, title string")
    n = spark.createDataFrame([("k", 1, "C1", "news", "market")], "cluster string, no int, label string, sector string, category string")
    block = RP.cluster_blocks(n, items).collect()[0]["block"]
    assert block.startswith("[C1] news market (S0, S1)") and block.count("- title") == 5


def test_small_core_functions(spark):
    t = spark.createDataFrame([("T one", "B  two", ["Acme Co", "x"])], "t string, b string, e array<string>")
    assert t.select(X.augmented(F.col("t"), F.col("b"), F.col("e")).alias("a")).collect()[0]["a"] == "t one b two ent_acme_co ent_x"
    reply = spark.createDataFrame([('So: {"a": "b", "": "c", "d": "", "e": null} bye',), ("none",), (None,)], "r string")
    assert [r[0] for r in reply.select(X.labelled_objects(F.col("r"))).collect()] == [[("a", "b")], [], []]
    many = spark.createDataFrame([("c", f"e{i}", i % 3, float(i)) for i in range(8)], "cluster_id string, entity string, count int, velocity double")
    assert [r["entity"] for r in E.top_entities(many).orderBy("place").collect()] == ["e5", "e2", "e7", "e4", "e1"]


def test_components_of_a_long_chain(spark):
    n = 300
    got = G.components(spark.createDataFrame([(i, i + 1) for i in range(n)], "a int, b int"))
    assert got.count() == n + 1 and got.agg(F.max("component")).collect()[0][0] == 0


def test_cluster_documents_against_average_linkage(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["red fox jumps", "red fox sleeps", "blue whale swims", "blue whale dives", "alone here"])], "id int, text string")
    v = V.tfidf(docs, ["id"], min_df=1, bigrams=False)
    edges = V.cosine_pairs(v, 0.2).select("a", "b")
    got = {r["id"]: r["cluster"] for r in C.cluster_documents(v, edges, docs.select("id"), 0.2).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_coverage_gap_of_text_aspects(spark):
    scores = spark.createDataFrame([("k1", "alpha", 2.0), ("k1", "beta", 1.0), ("k2", "beta", 3.0)], "cluster string, aspect string, score double")
    debt = spark.createDataFrame([("alpha", 0.5), ("beta", 1.5)], "aspect string, debt double")
    assert {r["cluster"]: round(r["coverage_gap"], 6) for r in S.coverage_gap(scores, debt).collect()} == {"k1": 0.0, "k2": 1.0}


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7), (None, 3)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = dict(rows(components(spark.createDataFrame(edges, "a int, b int"))))
    assert got == {n: find(n) for n in parent}


def test_average_ranks(spark):
    rng = random.Random(1)
    data = [(g, float(rng.randrange(6))) for g in "ab" for _ in range(20)]
    got = {(r["g"], r["v"]): (r["rank"], r["n"]) for r in average_ranks(spark.createDataFrame(data, "g string, v double"), ["g"], "v").collect()}
    for g, v in set(data):
        vs = [x for h, x in data if h == g]
        assert got[g, v] == (sum(x > v for x in vs) + (vs.count(v) + 1) / 2, 20)


def naive_linkage(sim, t):
    groups = [[i] for i in range(len(sim))]
    while len(groups) > 1:
        m, a, b = max((np.mean([[sim[i][j] for j in y] for i in x]), -i1, -i2) for i1, x in enumerate(groups) for i2, y in enumerate(groups) if i1 < i2)
        if m < t:
            break
        groups[-a] += groups.pop(-b)
    return sorted(tuple(sorted(g)) for g in groups)


@pytest.mark.parametrize("seed", [0, 1])
def test_average_linkage_against_naive(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.abs(rng.normal(size=(14, 6))) * (rng.random((14, 6)) < 0.5)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    sim = x @ x.T
    pairs = [(i, j, float(sim[i, j])) for i in range(14) for j in range(i + 1, 14)]
    got = C.average_linkage(spark.range(14), spark.createDataFrame(pairs, "a bigint, b bigint, sim double"), 0.4)
    groups: dict = {}
    for i, c in rows(got):
        groups.setdefault(c, []).append(i)
    assert sorted(tuple(sorted(g)) for g in groups.values()) == naive_linkage(sim, 0.4)


@pytest.mark.parametrize("block_values", [C.BLOCK_VALUES, 60])
def test_vector_linkage_against_naive(spark, block_values):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 5)) + 0.4  # cosines of either sign
    x[30:] = x[:10]  # copies
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    data = [(i, [float(f) for f in v]) for i, v in enumerate(x)] + [(40, None), (41, [0.0] * 5), (42, [1.0, None, 0.0, 0.0, 0.0]), (43, [float("nan")] * 5), (44, [1.0]), (None, [1.0] * 5)]
    data += [(0, [9.0] * 5)]  # the least of an id's vectors counts
    got = C.vector_linkage(spark.createDataFrame(data, "id bigint, v array<double>"), 0.5, block_values).collect()
    assert len(got) == 46
    groups: dict = {}
    for i, c in got:
        groups.setdefault(c, []).append(i)
    assert all(c == min(g) for c, g in groups.items() if c is not None)
    own = {40, 41, 42, 43, 44, None}
    assert all(groups[i] == [i] for i in own)
    assert sorted(tuple(sorted(g)) for c, g in groups.items() if c not in own) == naive_linkage(y @ y.T, 0.5)
    assert C.vector_linkage(spark.createDataFrame([], "id string, v array<float>")).count() == 0


def test_average_linkage_query_of_two_thousand_vectors(spark, tmp_path):
    import pandas as pd

    from inkstream.plans import catalogue

    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 64)).astype("float32")
    pd.DataFrame({"vec_id": range(2000), "embedding": list(x)}).to_parquet(tmp_path / "embeddings.parquet")
    began = time.time()
    got = catalogue.QUERIES["average_linkage"](spark, str(tmp_path)).collect()
    assert len(got) == 2000 and 1 < len({r["cluster"] for r in got}) < 2000
    assert time.time() - began < 60  # a nested loop of rows, in one task


def test_average_linkage_query_counts_negative_cosines(spark, tmp_path):
    import pandas as pd

    from inkstream.plans import catalogue

    turn = [0, 60, -63]  # cosines 0.5, 0.45 and -0.54: the third is no part of the first two
    pd.DataFrame({"vec_id": range(3), "embedding": [[math.cos(math.radians(a)), math.sin(math.radians(a))] for a in turn]}).to_parquet(tmp_path / "embeddings.parquet")
    assert rows(catalogue.QUERIES["average_linkage"](spark, str(tmp_path))) == [(0, 0), (1, 0), (2, 2)]


def test_tfidf_unit_length_and_pairs(spark):
    texts = ["red apple pie", "red apple tart", "green pear", "green pear", "", "the and of", None]
    d = cut(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    v = V.tfidf(d, ["id"])
    norms = v.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert norms and all(abs(r["n"] - 1) < 1e-9 for r in norms)
    vec: dict = {}
    for r in v.collect():
        vec.setdefault(r["id"], {})[r["term"]] = r["weight"]
    brute = {(a, b) for a in vec for b in vec if a < b and sum(w * vec[b].get(t, 0) for t, w in vec[a].items()) >= 0.3 - 1e-9}
    assert {(r["a"], r["b"]) for r in V.cosine_pairs(v, 0.3).collect()} == brute
    assert V.tfidf(d.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("block_terms", [V.BLOCK_TERMS, 150])
def test_links_against_brute_force(spark, block_terms):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["wants", "to", "pause", "price", "list", "weekend", "breaks", f"maker{rng.randrange(9)}"]) for _ in range(rng.randrange(9))) for _ in range(90)]
    texts += texts[:12] + [None, "the and of", "single words here"]
    d = cut(spark.createDataFrame([(f"k{i:03d}", t) for i, t in enumerate(texts)], "id string, text string"))
    vec: dict = {}
    for r in V.tfidf(d, ["id"]).collect():
        vec.setdefault(r["id"], {})[r["term"]] = r["weight"]
    dot = lambda a, b: sum(w * vec[b].get(t, 0.0) for t, w in vec[a].items())
    brute = {(a, b): dot(a, b) for a in vec for b in vec if a < b and dot(a, b) >= 0.6 - 1e-9}
    got = {(r["a"], r["b"]): r["sim"] for r in V.cosine_pairs(V.tfidf(d, ["id"]), 0.6, block_terms=block_terms).collect()}
    assert got.keys() == brute.keys() and all(abs(got[p] - s) < 1e-9 for p, s in brute.items())
    n_links = {(r["id"]): (r["rep"], r["n_links"]) for r in V.linked(d, 0.6, block_terms=block_terms).collect()}
    ids = [f"k{i:03d}" for i in range(len(texts))]
    assert n_links == {k: (ids[texts.index(t)], sum(k in p for p in brute)) for k, t in zip(ids, texts, strict=True)}
    assert V.linked(d.limit(0), 0.6).count() == 0


def test_candidates_of_links_are_not_stored(spark, tmp_path):
    """Titles of few templates: most candidates fall below the threshold, and their number grows with the square of the titles."""
    import pandas as pd

    rng = random.Random(4)
    words = [[f"{c}{i}x" for i in range(30)] for c in "abcdef"]
    pd.DataFrame({"id": range(6000), "text": [" ".join(rng.choice(w) for w in words) for _ in range(6000)]}).to_parquet(tmp_path / "d.parquet")
    d = cut(spark.read.parquet(str(tmp_path / "d.parquet")))
    store = spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return sum(store.executorList(False).apply(i).totalShuffleWrite() for i in range(store.executorList(False).size()))

    before = written()
    V.linked(d, 0.7, bigrams=False).collect()
    assert 0 < written() - before < 5_000_000  # 2.4 million pairs share a term of their prefixes



def test_bm25_against_loop(spark):
    docs, query = ["a b b c", "b c d", "d d e", "a"], "b d d zz"
    got = {r["id"]: r["score"] for r in R.bm25(spark.createDataFrame(list(enumerate(docs)), "id int, text string"), spark.createDataFrame([(1, query)], "query_id int, text string")).collect()}
    toks = [x.split() for x in docs]
    n, avg = len(docs), sum(map(len, toks)) / len(docs)
    raw = {t: math.log(n - df + 0.5) - math.log(df + 0.5) for t in {w for x in toks for w in x} for df in [sum(t in x for x in toks)]}
    idf = {t: v if v >= 0 else 0.25 * sum(raw.values()) / len(raw) for t, v in raw.items()}
    for i, x in enumerate(toks):
        want = sum(idf.get(t, 0) * x.count(t) * 2.5 / (x.count(t) + 1.5 * (0.25 + 0.75 * len(x) / avg)) for t in query.split())
        assert abs(got.get(i, 0.0) - want) < 1e-9


def test_minmax_and_gini_and_auc(spark):
    assert [r["x"] for r in S.minmax_all(spark.createDataFrame([(3.0,)] * 3, "x double"), ["x"]).collect()] == [0, 0, 0]
    g = L.gini(spark.createDataFrame([("w", 0.2), ("w", 0.4), ("w", 0.4)], "week string, v double"), ["week"], "v").collect()[0]["gini"]
    assert abs(g - 0.133333) < 1e-6
    auc = lambda s, y: L.auc(spark.createDataFrame(list(zip(s, y, strict=True)), "s double, y int"), "s", "y").collect()[0]["auc"]
    assert auc([0.1, 0.4, 0.35, 0.8], [0, 0, 1, 1]) == 0.75 and auc([0.5, 0.5], [0, 1]) == 0.5 and auc([0.5], [1]) is None


def test_debt(spark):
    led = spark.createDataFrame([("2025-W03", "a", 0.5), ("2025-W02", "a", 0.1), ("2025-W01", "b", 0.9)], "week string, aspect string, coverage double")
    got = dict(rows(L.coverage_debt(led)))
    assert abs(got["a"] - 1.19) < 1e-9


def test_greedy_dedup_registers_only_kept(spark):
    d = [(1, 0, 0, "A", "u1", "s1"), (1, 0, 1, "B", "u1", "s2"), (2, 1, 0, "C", "u2", "s2"), (2, 1, 1, "D", "u3", "")]
    got = SE.greedy_dedup(spark.createDataFrame(d, "cluster int, place int, pos int, id string, url string, signature string"))
    assert [r[1] for r in rows(got)] == ["A", "C", "D"]


def test_off_profile_and_mmr(spark):
    d = spark.createDataFrame([(1, 0.5, 0.05), (2, 0.05, 0.11), (3, 0.0, 0.05), (4, 0.9, 0.12)], "c int, profile_exclusion double, relevance double")
    assert [r[0] for r in rows(SE.off_profile(d))] == [3, 4]
    c = spark.createDataFrame([(1, 1.0, 0.0, [1.0, 0.0]), (2, 0.9, 0.0, [1.0, 0.0]), (3, 0.5, 0.2, [0.0, 1.0])], "cluster int, score double, relevance double, vec array<double>")
    assert [r["cluster"] for r in SE.mmr_order(c).orderBy("place").collect()] == [1, 3, 2]
    assert SE.mmr_dynamic(c).count() == 3  # fewer candidates than the least cut: all stay


def test_blend_in_order_equals_fold(spark):
    old = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8)], "topic_id int, term string, weight double")
    m = [(1, 1, "a", 1.0), (1, 2, "c", 1.0)]
    got = {r["term"]: r["weight"] for r in BK.blend_in_order(old, spark.createDataFrame(m, "topic_id int, place int, term string, weight double"), spark.createDataFrame([("a",), ("b",), ("c",)], "term string")).collect()}
    v = {"a": 0.6, "b": 0.8}
    for _, _, t, w in m:
        v = {k: 0.7 * v.get(k, 0) + 0.3 * (w if k == t else 0) for k in {*v, t}}
    assert all(abs(got[k] - v[k]) < 1e-12 for k in v)


def test_truncate_leaves_short_vectors(spark):
    t = spark.createDataFrame([(1, f"t{i}", 0.5) for i in range(150)], "topic_id int, term string, weight double")
    assert rows(BK.truncate(t)) == rows(t)


def test_weight_floor():
    got = WT.enforce_floor({"relevance": 0.10} | {f"k{i}": 0.09 for i in range(10)})
    assert abs(got["relevance"] - 0.20) < 1e-12 and all(abs(v - 0.08) < 1e-12 for k, v in got.items() if k != "relevance")


def test_instants_of_items(spark):
    items = spark.createDataFrame([("1", "s", "2025-01-01 10:00", "2025-01-01T10:00:00.000000+00:00", 9), ("1", "s", "2025-01-01 10:00", "2025-01-01T10:00:00.000000+00:00", 9), ("2", "none", "2025-01-01 10:00", None, 1), ("3", None, " ", "x", 1)], "id string, source string, ts string, ingested_at string, zone int")
    src = spark.createDataFrame([("s", "Asia/Tokyo", "UTC", "ja-JP"), ("s", "Asia/Tokyo", "UTC", "ja-JP")], "source string, home_zone string, ingest_zone string, locale string")
    assert rows(noncanonical_instants(items, src)) == [("1", "ts", "2025-01-01T01:00:00.000Z"), ("2", "ts", "invalid"), ("3", "ingested_at", "invalid")]
    assert noncanonical_instants(items.limit(0), src).count() == 0


def test_two_lanes_and_digest(spark):
    from inkstream.operators import digest as D

    d = spark.createDataFrame([("a", "red apple pie", "red apple pie"), ("b", "red apple pie", "green pear"), ("c", "blue sky", "green pear"), ("d", None, None)], "id string, title string, text string")
    assert rows(D.two_lane_edges(d)) == [("a", "b"), ("b", "c")]
    v = V.tfidf(cut(d.select("id", F.coalesce("text", F.lit("")).alias("text"))), ["id"])
    head, terms = D.save_digest(spark.createDataFrame([(1, "b"), (1, "c")], "cluster_no int, id string"), v, "2026-W01", "s", "2026-01-01 00:00:00")
    assert head.count() == 1 and {r["term"] for r in terms.collect()} == {"green", "pear", "green pear"}
    stored = spark.createDataFrame([], ST.SCHEMAS["cluster_signals"])
    scored = spark.createDataFrame([(1, 0.5, 1), (1, 0.4, 2), (None, 0.9, 3)], "topic_id bigint, score double, place int")
    got = D.persist_signals(stored, scored, "2026-W01").collect()
    assert [(r["topic_id"], r["score"], r["persistence_rate"], r["trend"]) for r in got] == [(1, 0.4, -1.0, 0.0)]


def test_greedy_dedup_without_cap_equals_loop(spark, monkeypatch):
    monkeypatch.setattr(SE, "MAX_CANDIDATES", 10)
    rng = np.random.default_rng(3)
    d = [(int(rng.integers(4)), int(rng.integers(9)), int(rng.integers(9)), f"i{k}", None if k % 17 == 0 else f"u{rng.integers(60)}", (None, "", f"s{rng.integers(60)}")[min(2, int(rng.integers(5)))]) for k in range(150)]
    urls, sigs, want = set(), set(), []
    for r in sorted(d, key=lambda r: (r[1], r[2], r[3])):
        if r[4] not in urls and (not r[5] or r[5] not in sigs):
            urls.add(r[4])
            sigs.add(r[5])
            want.append((r[0], r[3]))
    got = SE.greedy_dedup(spark.createDataFrame(d, "cluster int, place int, pos int, id string, url string, signature string"))
    assert rows(got) == sorted(want, key=str)


def test_export_of_a_store(spark, tmp_path):
    root = str(tmp_path / "store")
    ST.swap(spark.createDataFrame([("2026-W01", {"relevance": 0.5}, None)], ST.SCHEMAS["scorer_weights"]), root, "scorer_weights")
    ST.swap(spark.createDataFrame([(f"i{k}", "s", "t", "u", "b", None, f"2026-01-0{k}", False) for k in (1, 3, 2)], ST.SCHEMAS["items"]), root, "items")
    made = EX.export(spark, root, str(tmp_path / "out"), ["items", "scorer_weights", "digests"])
    assert [r["id"] for r in spark.read.option("header", True).csv(made[0]).collect()] == ["i3", "i2", "i1"]
    assert spark.read.option("header", True).option("escape", '"').csv(made[1]).collect()[0]["weights"] == '{"relevance":0.5}'
    assert spark.read.json(EX.export(spark, root, str(tmp_path / "out"), ["items"], "json")[0]).count() == 3
