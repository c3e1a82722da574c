"""Connected components over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import remove, shared_folder, stored


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component: the smallest id reachable) for nodes (id) and edges (a, b).

    Edges alone are rewritten, and their ends move to smaller ids each round: a node hands its larger neighbours to its
    smallest one, then its smaller neighbours are joined below the least of them. Rounds grow with the logarithm of the longest path;
    each is a stage table that the next one replaces, and the driver sees a count and a sum.
    """
    spark = nodes.sparkSession
    now = stored(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(), "edges")
    seen = None
    while True:
        ends = now.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionAll(now.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        low = ends.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        handed = ends.filter("m > n").join(low, "n").select(F.col("m").alias("hi"), F.col("low").alias("lo")).distinct()
        least = handed.groupBy("hi").agg(F.min("lo").alias("low"))
        kept = handed.join(least, "hi")
        after = stored(kept.select("hi", F.col("low").alias("lo")).unionAll(kept.filter("lo <> low").select(F.col("lo").alias("hi"), F.col("low").alias("lo"))).distinct(), "edges")
        mark = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        for path in {f.rsplit("/", 1)[0] for f in now.inputFiles() if shared_folder(spark).removeprefix("file://") in f}:
            remove(spark, path)
        now = after
        if mark == seen:
            break
        seen = mark
    return nodes.select("id").join(now.withColumnRenamed("hi", "id"), "id", "left").select("id", F.coalesce("lo", "id").alias("component"))
