"""Connected components of links, by alternating stars over tables in the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, written


def local_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n-1 the smallest node that links (a[i], b[i]) reach, inside one task."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b: long) that is not its component's smallest node.

    Large stars and small stars alternate until nothing changes, a number of rounds that grows with the
    logarithm of the longest path. Each round is a table in the shared folder, so a lost executor costs a task, not the lineage;
    the driver sees a count and a sum. Nulls and links of a node to itself are dropped; repeats change nothing.
    """
    spark = links.sparkSession
    edges = links.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    now, path = written(edges, "links")
    seen = None
    while True:
        both = now.select(F.col("v").alias("x"), F.col("u").alias("y")).unionAll(now.select(F.col("u").alias("x"), F.col("v").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*").filter("v <> u").distinct()
        after, new_path = written(small, "links")
        mark = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        remove(spark, path)
        now, path = after, new_path
        if mark == seen:
            return now.select(F.col("v").alias("node"), F.col("u").alias("component"))
        seen = mark
