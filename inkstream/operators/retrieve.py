"""BM25, dense retrieval and reciprocal rank fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm
from ..session import broadcast_if_small, cut

K1, B, EPSILON, RRF_K = 1.5, 0.75, 0.25, 60


def _words(text: Column) -> Column:
    return F.filter(F.split(norm(text), " "), lambda w: w != "")


def bm25(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, score) of docs (id, text) that share a word with queries (query_id, text); all others score 0.

    Okapi with k1 1.5 and b 0.75; negative idf is replaced by 0.25 times the mean idf; a query's repeated words count repeatedly.
    Of the documents' words only the distinct ones travel, for their counts, and the asked ones, for their frequencies.
    """
    tokens = docs.select("id", _words(F.col("text")).alias("w"))
    # one pass for the documents of each word and, under no word, their number and length
    every = F.explode(F.array_append(F.array_distinct("w"), F.lit(None).cast("string")))
    counts = cut(tokens.select(F.size("w").alias("dl"), every.alias("term")).groupBy("term").agg(F.count("*").alias("df"), F.sum("dl").alias("dl")))
    corpus = counts.filter("term is null").select(F.col("df").alias("n"), (F.col("dl") / F.col("df")).alias("avgdl"))
    df = counts.filter("term is not null").select("term", "df").crossJoin(F.broadcast(corpus))
    df = df.withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = df.agg(F.avg("raw").alias("mean"))
    asked = cut(queries.select("query_id", F.explode(_words(F.col("text"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qf")))
    terms = broadcast_if_small(asked.select("term").distinct())
    idf = df.join(terms, "term", "left_semi").crossJoin(F.broadcast(mean)).select("term", "avgdl", F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw")).alias("idf"))
    tf = tokens.select("id", F.size("w").alias("dl"), F.explode("w").alias("term")).join(terms, "term", "left_semi").groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))
    hit = tf.join(broadcast_if_small(cut(idf)), "term").join(broadcast_if_small(asked), "term")
    part = F.col("qf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return hit.groupBy("query_id", "id").agg(F.sum(part).alias("score"))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def dense_scores(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, score): cosine of embeddings; queries (query_id, q) are a stated set, met by all docs (id, e) block by block."""
    return docs.crossJoin(broadcast_if_small(queries, 20_000)).select("query_id", "id", cosine(F.col("e"), F.col("q")).alias("score"))


def ranked(scores: DataFrame, top: int | None = None) -> DataFrame:
    """scores with rank by descending score within query, ids parting ties."""
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    out = scores.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top) if top else out


def rrf(lanes: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """(query_id, id, fused): the sum of 1 / (k + rank) over lanes of (query_id, id, rank)."""
    both = lanes[0].select("query_id", "id", "rank")
    for lane in lanes[1:]:
        both = both.unionByName(lane.select("query_id", "id", "rank"))
    return both.groupBy("query_id", "id").agg(F.sum(1 / (k + F.col("rank"))).alias("fused"))
