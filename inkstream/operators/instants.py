"""Item time columns as UTC instants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import normalise

#: Time column of an item and the zone column of its source that applies where the text has no zone.
TIME_FIELDS = {"ts": "home_zone", "ingested_at": "ingest_zone"}


def item_instants(items: DataFrame, sources: DataFrame) -> DataFrame:
    """(id, field, raw, utc, utc_ms, canonical) of every time value of every item row that is neither NULL nor blank.

    Items of a source that `sources` lacks keep their zoned values; their zoneless ones come out as `invalid`. Repeated source rows count once.
    `sources` is configuration: one narrow row per source. The join is left to Spark, which broadcasts it when its size allows.
    """
    dim = sources.groupBy(F.col("source").alias("__src")).agg(*[F.min(z).alias(z) for z in TIME_FIELDS.values()], F.min("locale").alias("locale"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in TIME_FIELDS]))
    long = items.select("id", F.col("source").alias("__s"), each.alias("v")).select("id", "__s", "v.field", "v.raw").filter(F.col("raw").rlike(r"[^\s ]"))
    long = long.join(dim, F.col("__s") == F.col("__src"), "left")
    zone = F.when(F.col("field") == "ts", F.col("home_zone")).otherwise(F.col("ingest_zone"))
    return normalise(long.withColumn("zone", zone), "raw", "zone", "locale").select("id", "field", "raw", "utc", "utc_ms", "canonical")


def noncanonical_instants(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct (id, field, utc) of the values not already written as YYYY-MM-DDTHH:MM:SS.ffffff+00:00."""
    return item_instants(items, sources).filter(~F.col("canonical")).select("id", "field", "utc").distinct()
