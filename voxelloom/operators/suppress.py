"""Greedy suppression: seams between windows, and priorities between classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

BOX = ("det_id", "class", "x1", "y1", "x2", "y2", "score")


def greedy(df: DataFrame, keys: list[str], order: list[Column], drops: Callable[[Column, Column], Column]) -> DataFrame:
    """The rows that no earlier kept row of their group drops, in the order of order, as one row each with all columns.

    drops(kept, current) says whether a kept row drops the current one. A group is a slice (or a class of it), so its
    array is bounded by what fits a slice. order must end with a unique column, which makes ties defined.
    """
    sort_names = [f"_s{i}" for i in range(len(order))]
    item = F.struct(*[o.alias(n) for o, n in zip(order, sort_names, strict=True)], *[F.col(c) for c in df.columns if c not in keys])
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("a"))
    kept = F.aggregate("a", F.slice("a", 1, 0), lambda acc, c: F.when(F.exists(acc, lambda k: drops(k, c)), acc).otherwise(F.concat(acc, F.array(c))))
    return rows.select(*keys, F.explode(kept).alias("r")).select(*keys, "r.*").drop(*sort_names)


def on_seam(start: Column, size: int, step: int, window: int) -> Column:
    """Whether the truncated coordinate lies in a band about an overlap of neighbouring windows."""
    band, at = window - step + 64, F.floor(start).cast("bigint") + 32  # coordinates are not below zero, so floor truncates
    if band <= step:
        q = F.floor(at / step)
        return (q >= 1) & (q * step < size) & (F.pmod(at, F.lit(step)) < band)
    if size <= step:
        return F.lit(False)
    return F.exists(F.sequence(F.lit(step), F.lit(size - 1), F.lit(step)), lambda r: (at >= r) & (at < r + band))


def flag_seams(df: DataFrame, width: int, height: int, xsize: int, ysize: int, step: int) -> DataFrame:
    return df.withColumn("on_seam", on_seam(F.col("x1"), width, step, xsize) | on_seam(F.col("y1"), height, step, ysize))


def seam_suppress(df: DataFrame, keys: list[str], width: int, height: int, xsize: int, ysize: int, step: int, threshold: float = 0.5) -> DataFrame:
    """Off-seam rows as they are, and on-seam rows by descending score unless a kept one covers over threshold of them.

    Widths count both end pixels. Ties of score go to the smaller det_id.
    """
    flagged = flag_seams(df, width, height, xsize, ysize, step)
    kept = greedy(flagged.filter("on_seam"), keys, [-F.col("score"), F.col("det_id")], lambda k, c: G.share_of(c, k, 1.0) > threshold)
    return flagged.filter("not on_seam").unionByName(kept)


def priority_suppress(df: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a slice by priority, then score, then class and det_id, unless a kept one overlaps too much.

    Too much is an IoU over 0.35 or a share of either box over 0.70. A class that classes lacks has no priority and
    its rows are left out.
    """
    ranked = df.join(F.broadcast(classes.select("class", "priority")), "class")

    def drops(k: Column, c: Column) -> Column:
        return (G.intersection(k, c) > 0) & ((G.iou(k, c) > 0.35) | (G.share_of(c, k) > 0.70) | (G.share_of(k, c) > 0.70))

    return greedy(ranked, keys, [-F.col("priority"), -F.col("score"), F.col("class"), F.col("det_id")], drops).drop("priority")
