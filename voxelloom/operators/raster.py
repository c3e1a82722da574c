"""Images in long form: rows (image keys, y, x, value). Stretch, windows, filters, resizing, box means.

Spark takes a table of pixels for as small as the files it was made from, so joins with pixels are merge joins by hint: pixels are never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G


def percentile_stretch(px: DataFrame, keys: list[str], value: str, low: float = 0.1, high: float = 99.9, every: int = 10) -> DataFrame:
    """Values as 0 to 255 between two percentiles of every tenth row and column; the limits are one row an image."""
    sample = px.filter((F.col("y") % every == 0) & (F.col("x") % every == 0))
    limits = sample.groupBy(*keys).agg(F.expr(f"percentile({value}, {low / 100}D)").alias("lo"), F.expr(f"percentile({value}, {high / 100}D)").alias("hi"), F.max(value).alias("most"))
    scaled = (F.least(F.greatest(F.col(value).cast("double"), F.col("lo")), F.col("hi")) - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(255.0)
    flat = (F.col("most") == 0) | (F.col("hi") <= F.col("lo"))
    return px.hint("merge").join(limits, keys).withColumn("stretched", F.when(flat, 0).otherwise(F.floor(F.when(~flat, scaled))).cast("int")).drop("lo", "hi", "most")


def compose(c1: DataFrame, c2: DataFrame, keys: list[str]) -> DataFrame:
    """Both channels over the first one's pixels; a missing pixel of the second is 0."""
    return c1.withColumnRenamed("v", "c1").hint("merge").join(c2.withColumnRenamed("v", "c2"), [*keys, "y", "x"], "left").withColumn("c2", F.coalesce("c2", F.lit(0)))


def sliding_windows(sizes: DataFrame, xsize: int, ysize: int, step: int) -> DataFrame:
    """(image keys, wx, wy, x_end, y_end) of each window, x outer; sizes has height and width. The last may be cut off."""

    def padded(n: str, size: int) -> Column:
        n = F.col(n)
        return F.when((n - size) % step == 0, n).otherwise(n - n % step + size)

    w = sizes.withColumns({"_pw": padded("width", xsize), "_ph": padded("height", ysize)})
    w = w.withColumn("wx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pw") - 1, F.lit(step).cast("bigint"))))
    w = w.withColumn("wy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_ph") - 1, F.lit(step).cast("bigint"))))
    return w.withColumns({"x_end": F.least(F.col("wx") + xsize, "_pw"), "y_end": F.least(F.col("wy") + ysize, "_ph")}).drop("_pw", "_ph")


def not_blank(px: DataFrame, windows: DataFrame, keys: list[str], value: str, xsize: int, ysize: int, step: int, least: int = 10) -> DataFrame:
    """Windows with a value of least or more: each bright pixel names the few windows over it by arithmetic, and tasks merge theirs first."""

    def over(n: str, size: int) -> Column:
        first = F.greatest(F.lit(0), F.ceil((F.col(n) - size + 1) / step))
        return F.transform(F.sequence(first.cast("bigint"), F.floor(F.col(n) / step).cast("bigint")), lambda k: k * step)

    named = px.filter(F.col(value) >= least).select(*keys, F.explode(over("x", xsize)).alias("wx"), over("y", ysize).alias("wys")).distinct()
    lit = named.select(*keys, "wx", F.explode("wys").alias("wy")).distinct()
    return windows.join(lit, [*keys, "wx", "wy"], "left_semi")


def laplacian_variance(px: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Population variance of the cross-shaped Laplacian; beyond a border the row next to it is mirrored."""

    def both(axis: list[str], order: str) -> Column:
        w = Window.partitionBy(*axis).orderBy(order)
        before, after = F.lag(value).over(w), F.lead(value).over(w)
        return F.coalesce(before, after, value) + F.coalesce(after, before, value)

    lap = px.withColumn("_v", both([*keys, "x"], "y")).withColumn("_h", both([*keys, "y"], "x"))
    return lap.groupBy(*keys).agg(F.var_pop(F.col("_v") + F.col("_h") - 4 * F.col(value)).alias("sharpness"))


def local_maxima(px: DataFrame, keys: list[str], value: str, reach: int = 2, above: Column | None = None) -> DataFrame:
    """Pixels that equal the largest within reach of them, above a level if given."""
    wx = Window.partitionBy(*keys, "y").orderBy("x").rangeBetween(-reach, reach)
    wy = Window.partitionBy(*keys, "x").orderBy("y").rangeBetween(-reach, reach)
    out = px.withColumn("_m", F.max(value).over(wx)).withColumn("_m", F.max("_m").over(wy)).filter(F.col(value) == F.col("_m")).drop("_m")
    return out.filter(above) if above is not None else out


def saturation(px: DataFrame, keys: list[str], value: str, limit: int) -> DataFrame:
    return px.groupBy(*keys).agg(F.avg((F.col(value) > limit).cast("double")).alias("saturation_ratio"), F.avg(value).alias("mean_intensity"))


def resize_nearest(px: DataFrame, sizes: DataFrame, keys: list[str], edge: int = 512) -> DataFrame:
    """Nearest pixels at a scale that makes the longest side edge; sizes (keys, height, width) has a row an image."""
    scale = F.lit(float(edge)) / F.greatest("height", "width")
    grid = sizes.withColumn("scale", scale).withColumns({"h": F.greatest(F.floor(F.col("height") * F.col("scale")), F.lit(1)), "w": F.greatest(F.floor(F.col("width") * F.col("scale")), F.lit(1))})
    grid = grid.withColumn("ny", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("h") - 1))).withColumn("nx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("w") - 1)))
    at = lambda n, size: F.least(F.floor(F.col(n) / F.col("scale")), F.col(size) - 1)
    grid = grid.withColumns({"y": at("ny", "height"), "x": at("nx", "width")}).select(*keys, "ny", "nx", "y", "x")
    return grid.join(px.hint("merge"), [*keys, "y", "x"]).drop("y", "x").withColumnsRenamed({"ny": "y", "nx": "x"})


def box_mean(boxes: DataFrame, px: DataFrame, sizes: DataFrame, keys: list[str], box_id: str = "det_id") -> DataFrame:
    """Mean over three planes, the first of them empty, of each box's pixels: boxes are cut to whole pixels and to the image.

    Boxes are spread over the rows that they touch, so the join is on image and row, and a range of x remains.
    """
    cut = lambda c, size: F.least(F.greatest(F.col(c).cast("bigint"), F.lit(0)), F.col(size))
    b = boxes.join(sizes, keys).select(*keys, box_id, *[cut(c, s).alias(f"_{c}") for c, s in (("x1", "width"), ("x2", "width"), ("y1", "height"), ("y2", "height"))])
    rows = b.filter("_x2 > _x1 and _y2 > _y1").withColumn("y", F.explode(F.sequence("_y1", F.col("_y2") - 1)))
    sums = rows.join(px.hint("merge"), [*keys, "y"]).filter("x >= _x1 and x < _x2").groupBy(box_id).agg((F.sum(F.col("c1") + F.col("c2")) / (3 * F.count(F.lit(1)))).alias("mean"))
    return boxes.select(box_id).join(sums, box_id, "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))


def peaks_in_boxes(peaks: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Peaks that any box of their image holds, borders included."""
    b = boxes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct("x1", "y1", "x2", "y2").alias("_b"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return peaks.join(b, same & G.contains(F.col("_b"), F.col("x"), F.col("y")), "left_semi")
