"""From tile to global coordinates: extents, shift, clip in depth, ownership of overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extents(layout: DataFrame, tile_size: int, slices: int, halve_z: bool = False) -> DataFrame:
    """One row: x_min, y_min, width, height, depth, z_start."""
    out = layout.agg(
        F.min("abs_x").alias("x_min"), F.min("abs_y").alias("y_min"),
        (F.max("abs_x") - F.min("abs_x") + tile_size).alias("width"), (F.max("abs_y") - F.min("abs_y") + tile_size).alias("height"),
        (F.lit(slices) - F.max("abs_z") + F.min("abs_z")).alias("depth"), F.max("abs_z").alias("z_start"),
    )
    if halve_z:  # every second slice is kept; the tiles' offsets in depth stay as the layout has them
        out = out.withColumn("depth", F.floor((F.col("depth") + 1) / 2))
    return out


def placed_tiles(layout: DataFrame, tile_size: int, slices: int, halve_z: bool = False) -> DataFrame:
    """Each tile's shift, and the offsets of its left and upper neighbours (null where there is none). A row a tile."""
    e = extents(layout, tile_size, slices, halve_z)
    left = layout.select("row", (F.col("col") + 1).alias("col"), F.col("abs_x").alias("left_x"), F.col("abs_y").alias("left_y"))
    upper = layout.select((F.col("row") + 1).alias("row"), "col", F.col("abs_x").alias("upper_x"), F.col("abs_y").alias("upper_y"))
    t = layout.join(left, ["row", "col"], "left").join(upper, ["row", "col"], "left").crossJoin(F.broadcast(e))  # one row
    shift = lambda c, low: (F.col(c) - F.col(low)).alias(c)
    return t.select("tile_no", shift("abs_x", "x_min"), shift("abs_y", "y_min"), (F.col("z_start") - F.col("abs_z")).alias("z0"), "depth", shift("left_x", "x_min"), shift("left_y", "y_min"), shift("upper_x", "x_min"), shift("upper_y", "y_min"))


def globalise(detections: DataFrame, layout: DataFrame, tile_size: int, slices: int, halve_z: bool = False) -> DataFrame:
    """Detections of slices that all tiles have, in global coordinates, z from 1 on; the tile's placing stays on the row.

    halve_z says that every second slice was kept, which halves the depth.

    Tiles that the layout lacks are left out. The layout is broadcast only if Spark finds it small.
    """
    d = detections.join(placed_tiles(layout, tile_size, slices, halve_z), "tile_no")
    d = d.filter((F.col("z") - 1 >= F.col("z0")) & (F.col("z") - 1 < F.col("z0") + F.col("depth")))
    moved = {c: F.col(c) + F.col("abs_x") for c in ("x1", "x2")} | {c: F.col(c) + F.col("abs_y") for c in ("y1", "y2")} | {"z": F.col("z") - F.col("z0")}
    return d.withColumns(moved)


def _inside(c: Column, a: str, b: str, size: int) -> Column:
    """Whether c lies in what two tiles share along an axis; false without the second (greatest and least pass over nulls)."""
    return F.col(b).isNotNull() & (c >= F.greatest(a, b)) & (c < F.least(a, b) + size)


def owned(placed: DataFrame, tile_size: int) -> DataFrame:
    """Rows whose floored centre lies in no overlap with the left or the upper neighbour, which owns those."""
    cx, cy = F.floor((F.col("x1") + F.col("x2")) / 2), F.floor((F.col("y1") + F.col("y2")) / 2)
    hit = [F.coalesce(_inside(cx, "abs_x", f"{n}_x", tile_size) & _inside(cy, "abs_y", f"{n}_y", tile_size), F.lit(False)) for n in ("left", "upper")]
    return placed.filter(~(hit[0] | hit[1]))


def centroids(df: DataFrame) -> DataFrame:
    return df.withColumns({"cx": (F.col("x1") + F.col("x2")) / 2, "cy": (F.col("y1") + F.col("y2")) / 2})


def downsample_z(df: DataFrame) -> DataFrame:
    """Every second slice, from the first on, renumbered."""
    return df.filter((F.col("z") - 1) % 2 == 0).withColumn("z", F.floor((F.col("z") - 1) / 2) + 1)
