"""Incremental ingestion and weekly counts as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.weeks import week_key
from ..operators.store import SCHEMAS, insert_or_ignore


def item_stream(spark: SparkSession, path: str) -> DataFrame:
    """New item files of a folder."""
    return spark.readStream.schema(SCHEMAS["items"]).parquet(path)


def stored_items(spark: SparkSession, store: str) -> DataFrame:
    """The items stored so far, on whatever file system; none where nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(SCHEMAS["items"]).parquet(store) if there else spark.createDataFrame([], SCHEMAS["items"])


def ingest(stream: DataFrame, store: str, checkpoint: str):
    """Append the items of a stream whose id is not stored yet, batch by batch; returns the running query.

    A batch that is run again after a failure finds its own rows stored and adds nothing twice.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        insert_or_ignore(stored_items(spark, store), df, "id", ["ingested_at", "url"]).write.mode("append").parquet(store)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_within(stream: DataFrame, ident: str, time: str, delay: str = "7 days") -> DataFrame:
    """Rows of a stream whose id has not come within the delay: state is dropped as the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([ident])


def weekly_counts(events: DataFrame, time: str, by: list[str], delay: str = "7 days") -> DataFrame:
    """(week, by..., count) over Monday-aligned weeks; late rows count until the watermark closes their week."""
    weekly = events.withWatermark(time, delay).groupBy(F.window(time, "7 days", startTime="4 days"), *by).agg(F.count("*").alias("count"))
    return weekly.select(week_key(F.col("window.start")).alias("week"), *by, "count")
