"""Quality metrics of slices and tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import importable

#: A tile fails above either.
MAX_DRIFT, MAX_LOGIC = 10, 0.15


def confidence(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("detection_count"), F.avg("score").alias("avg_conf"), F.median("score").alias("median_conf"), F.avg((F.col("score") < 0.6).cast("double")).alias("low_conf_ratio"))


def miss_ratio(spots: DataFrame, hits: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """1 - hits / spots per image; 0 without spots, 1 with spots and no boxes."""
    n = lambda d, name: d.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    all_ = spots.select(*keys).unionByName(boxes.select(*keys)).distinct()
    out = all_.join(n(spots, "spots"), keys, "left").join(n(hits, "hits"), keys, "left").fillna(0, ["spots", "hits"])
    return out.withColumn("miss_ratio", missed())


def missed() -> Column:
    """The share of spots that are not hits; 0 without spots."""
    return F.when(F.col("spots") == 0, 0.0).otherwise(1 - F.try_divide(F.col("hits"), F.col("spots")))


def seeded_sample(boxes: DataFrame, keys: list[str], n: int = 50, seed: int = 42) -> DataFrame:
    """At most n boxes of each slice (the operator samples): those of the smallest keyed products, alike in any engine."""
    mixed = (F.col("det_id") * 7919 + seed * 104729) % 1000003
    return boxes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(mixed, "det_id"))).filter(F.col("_r") <= n).drop("_r")


def channel_logic(boxes: DataFrame, means: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, checks, logic_mismatch_rate, yellow_balance): is each class's color there?

    means has det_id, m1, m2 of the boxes' two channels; images the keys with mean1, mean2. A channel is present where a box's mean
    is over 1.2 times the image's. Red needs the first, green the second, yellow both.
    """
    return logic_rates(boxes.join(means, "det_id").join(images, keys), keys)


def logic_rates(b: DataFrame, keys: list[str]) -> DataFrame:
    """channel_logic from rows that hold a box's class and means and its image's means."""
    b = b.withColumns({"s1": F.col("m1") / (F.col("mean1") + 1e-6), "s2": F.col("m2") / (F.col("mean2") + 1e-6)})
    one, two, color = F.col("s1") > 1.2, F.col("s2") > 1.2, F.col("class") % 3
    b = b.withColumn("ok", F.when(color == 0, one).when(color == 1, two).otherwise(one & two))
    return b.groupBy(*keys).agg(F.count(F.lit(1)).alias("checks"), F.avg((~F.col("ok")).cast("double")).alias("logic_mismatch_rate"), F.coalesce(F.avg(F.when((color == 2) & F.col("ok"), F.col("s1") / (F.col("s2") + 1e-6))), F.lit(0.0)).alias("yellow_balance"))


def tile_rollup(slices: DataFrame, tile: str = "tile_no") -> DataFrame:
    """A row a tile from its slices' metrics; a column that is not there counts 0, NaN counts as missing, and a tile fails on drift or logic errors, unrounded."""
    clean = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) if c in slices.columns else F.lit(None).cast("double")
    mean = lambda c, name: F.coalesce(F.avg(clean(c)), F.lit(0.0)).alias(name)
    out = slices.groupBy(tile).agg(
        F.sum("detection_count").cast("bigint").alias("total_cells"), mean("c1_avg_conf", "avg_confidence"), mean("c1_sharpness", "avg_sharpness"),
        F.coalesce(F.max(clean("c1_drift")), F.lit(0.0)).alias("max_drift"), mean("logic_mismatch_rate", "avg_logic_error"), F.count(F.lit(1)).alias("total_layers"),
    )
    return out.withColumn("qc_status", F.when((F.col("max_drift") > MAX_DRIFT) | (F.col("avg_logic_error") > MAX_LOGIC), "FAIL").otherwise("PASS"))


def shift_between(before: np.ndarray, now: np.ndarray) -> float:
    """Length of the shift at the highest phase correlation of two images of one shape."""
    if before.shape != now.shape or before.var() <= 1e-5:
        return 0.0
    cross = np.fft.rfft2(before.astype(np.float32)) * np.conj(np.fft.rfft2(now.astype(np.float32)))
    surface = np.fft.irfft2(cross / np.maximum(np.abs(cross), 1e-12), s=now.shape)
    peak = np.array(np.unravel_index(surface.argmax(), surface.shape), dtype=float)
    size = np.array(surface.shape)
    peak = np.where(peak > size / 2, peak - size, peak)
    return float(np.hypot(*peak))


def drift(images: DataFrame, keys: list[str], least_mean: float = 100.0) -> DataFrame:
    """(keys, z, drift): each slice against the one before it; images has height, width and data (little-endian 16-bit)."""
    w = Window.partitionBy(*keys).orderBy("z")
    importable(images.sparkSession)
    pairs = images.withColumns({"_data": F.lag("data").over(w), "_h": F.lag("height").over(w), "_w": F.lag("width").over(w)})

    @F.pandas_udf("double")
    def shift(h: pd.Series, w: pd.Series, data: pd.Series, h0: pd.Series, w0: pd.Series, before: pd.Series) -> pd.Series:
        out = []
        for a, b, d, c, e, p in zip(h, w, data, h0, w0, before, strict=True):
            now = np.frombuffer(d, "<u2").reshape(int(a), int(b))
            out.append(0.0 if p is None or now.mean() <= least_mean else shift_between(np.frombuffer(p, "<u2").reshape(int(c), int(e)), now))
        return pd.Series(out)

    return pairs.select(*keys, "z", shift("height", "width", "data", "_h", "_w", "_data").alias("drift"))
