"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the least node of each connected part; nodes without edges do not appear.

    Alternates large-star and small-star steps, which settle in a number of rounds that grows with the logarithm of the parts' size
    and never gather a part in one task. Self-loops and NULLs are left out.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    e = cut(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every neighbour above u goes to the least of u and its neighbours
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(m, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: u and its neighbours below go to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        nxt = cut(small)
        same = nxt.exceptAll(e).limit(1).count() == 0 and e.exceptAll(nxt).limit(1).count() == 0
        e = nxt
        if same:
            break
    leaf = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = e.select(F.col("v").alias("node")).distinct().join(leaf.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    return leaf.unionByName(roots)


