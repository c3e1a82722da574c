"""Statistics, centroids, nearest sources, drawing geometry, and the sinks of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def statistics(df: DataFrame, classes: DataFrame) -> DataFrame:
    """(group, category, count, percentage) by class, color and type; categories without rows count 0.

    Rows of a class that classes lacks are in no category and not in the total; unknown gives them.
    """
    domain = classes.select(F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.col(c).alias("category")) for g, c in (("Class", "name"), ("Color", "color"), ("Type", "type"))])).alias("d")).select("d.*").distinct()
    named = df.groupBy("class").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(classes), "class")
    sets = named.groupingSets([["name"], ["color"], ["type"]], "name", "color", "type").agg(F.sum("n").alias("n"), F.grouping("name").alias("gn"), F.grouping("color").alias("gc"))
    rows = sets.select(F.when(F.col("gn") == 0, "Class").when(F.col("gc") == 0, "Color").otherwise("Type").alias("group"), F.coalesce("name", "color", "type").alias("category"), "n")
    out = domain.join(rows, ["group", "category"], "left").select("group", "category", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"))
    total = F.sum(F.when(F.col("group") == "Class", F.col("count"))).over(Window.partitionBy())  # over the few categories
    return out.withColumn("percentage", F.coalesce(F.try_divide(F.col("count") * F.lit(100.0), total), F.lit(0.0)))


def unknown(df: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows whose class the dimension lacks, which statistics leave out: a run writes them apart."""
    return df.join(F.broadcast(classes.select("class")), "class", "left_anti")


def per_class(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Centroids with their class's name, C and the number where it has none; write_per_class puts each file in the order of z."""
    named = df.join(F.broadcast(classes.select("class", F.col("name").alias("class_name"))), "class", "left").withColumn("class_name", F.coalesce("class_name", F.concat(F.lit("C"), F.col("class"))))
    return named.select("class_name", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"), "z", "score", "tile_no", "det_id", *[c for c in ("slice_name", "tile_name") if c in df.columns])


def write_per_class(df: DataFrame, path: str) -> None:
    """A folder of CSV files for each class, each file in the order of z; a class may be split over tasks by depth."""
    df.repartitionByRange("class_name", "z").sortWithinPartitions("class_name", "z", "det_id").write.mode("overwrite").partitionBy("class_name").option("header", True).csv(path)


def write_boxes(df: DataFrame, path: str) -> None:
    """Linked boxes in global coordinates with the tile and slice that each came from."""
    df.select("x1", "y1", "x2", "y2", "score", "mean", "class", "z", "tile_name", "slice_name").write.mode("overwrite").option("header", True).csv(path)


def write_statistics(df: DataFrame, path: str) -> None:
    """The statistics' eleven rows, percentages to two places."""
    rows = df.select(F.col("group").alias("Group"), F.col("category").alias("Category"), F.col("count").alias("Count"), F.round("percentage", 2).alias("Percentage(%)"))
    rows.coalesce(1).sortWithinPartitions("Group", "Category").write.mode("overwrite").option("header", True).csv(path)


def write_quality(df: DataFrame, path: str) -> None:
    """A folder of quality tables for each tile, a row a slice in the order of z; what a slice lacks is empty."""
    order = ["tile_name", "z", "detection_count", *sorted(c for c in df.columns if c not in ("tile_name", "z", "detection_count"))]
    df.select(order).repartition("tile_name").sortWithinPartitions("tile_name", "z").write.mode("overwrite").partitionBy("tile_name").option("header", True).csv(path)


def project_summary(tiles: DataFrame) -> DataFrame:
    """A tile roll-up under its file's names, rounded; the status is judged before."""
    rounded = (("avg_confidence", "Avg_Confidence", 3), ("avg_sharpness", "Avg_Sharpness", 2), ("max_drift", "Max_Drift_px", 2), ("avg_logic_error", "Avg_Logic_Error", 4))
    return tiles.select(F.col("tile_name").alias("Tile_Name"), F.col("total_cells").alias("Total_Cells"), *[F.round(c, n).alias(name) for c, name, n in rounded], F.col("total_layers").alias("Total_Layers"), F.col("qc_status").alias("QC_Status"))


def write_summary(tiles: DataFrame, path: str) -> None:
    """The project's summary, a row a tile in the order of names."""
    project_summary(tiles).orderBy("Tile_Name").write.mode("overwrite").option("header", True).csv(path)


def write_centroids(df: DataFrame, path: str) -> None:
    df.select(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"), "z", "score", "class", "mean").write.mode("overwrite").option("header", True).csv(path)


def nearest(left: DataFrame, right: DataFrame, reach: float, cell: float) -> DataFrame:
    """(left_id, right_id, d2): the nearest right point within reach in (x, y, 10 z), ties to the smaller id; null without one.

    Points meet in grid cells: a left point looks into the cells that its reach touches, two an axis at most if a cell is
    twice the reach or more. Where left's rows come from right's, their sources are better carried along than searched.
    """
    at = lambda c: F.floor(F.col(c) / cell)
    near = lambda c, n: F.explode(F.sequence(F.floor((F.col(c) - reach) / cell), F.floor((F.col(c) + reach) / cell))).alias(n)
    a = left.select("id", "x", "y", (F.col("z") * 10).alias("w"))
    a = a.select("id", "x", "y", "w", near("x", "gx")).select("id", "x", "y", "w", "gx", near("y", "gy")).select("id", "x", "y", "w", "gx", "gy", near("w", "gz"))
    b = right.select(F.col("id").alias("right_id"), F.col("x").alias("bx"), F.col("y").alias("by"), (F.col("z") * 10).alias("bw"))
    b = b.withColumns({"gx": at("bx"), "gy": at("by"), "gz": F.floor(F.col("bw") / cell)})
    sq: Column = (F.col("x") - F.col("bx")) ** 2 + (F.col("y") - F.col("by")) ** 2 + (F.col("w") - F.col("bw")) ** 2
    best = a.join(b, ["gx", "gy", "gz"]).withColumn("d2", sq).filter(F.col("d2") <= reach * reach).groupBy(F.col("id").alias("left_id")).agg(F.min(F.struct("d2", "right_id")).alias("m"))
    return left.select(F.col("id").alias("left_id")).join(best, "left_id", "left").select("left_id", "m.right_id", "m.d2")


def grid_from_names(names: DataFrame, left_to_right: bool = True, top_to_bottom: bool = True) -> DataFrame:
    """(name, row, col) from names in the order of pos: keys are the first and the last six characters, numbered as they first appear.

    Columns from right to left, or rows from the bottom up, are numbered by their keys from the last to the first.
    """
    keys = names.withColumns({"row_key": F.substring("name", 1, 6), "col_key": F.expr("right(name, 6)")})

    def numbered(key: str, out: str, as_met: bool) -> DataFrame:
        first = keys.groupBy(key).agg(F.min("pos").alias("at"))
        order = F.col("at").asc() if as_met else F.col(key).desc()
        return first.withColumn(out, F.row_number().over(Window.partitionBy().orderBy(order)) - 1).drop("at")  # a row a grid line

    return keys.join(numbered("row_key", "row", top_to_bottom), "row_key").join(numbered("col_key", "col", left_to_right), "col_key").select("name", "row", "col")


def dashes(df: DataFrame, length: int = 8) -> DataFrame:
    """(det_id, side, k, sx, sy, ex, ey): the drawn pieces of each box's sides; neuron sides are one solid piece.

    A glia side of len pixels has max(1, floor(len / length)) pieces, of which those of even number are drawn; ends are cut to whole pixels.
    """
    corners = [("x1", "y1", "x2", "y1"), ("x2", "y1", "x2", "y2"), ("x2", "y2", "x1", "y2"), ("x1", "y2", "x1", "y1")]
    sides = F.array(*[F.struct(F.lit(i).alias("side"), *[F.col(c).cast("bigint").alias(n) for c, n in zip(s, ("ax", "ay", "bx", "by"), strict=True)]) for i, s in enumerate(corners)])
    d = df.select("det_id", "class", F.explode(sides).alias("s")).select("det_id", "class", "s.*")
    n = F.when(F.col("class") < 3, F.greatest(F.lit(1), F.floor((F.abs(F.col("bx") - F.col("ax")) + F.abs(F.col("by") - F.col("ay"))) / length))).otherwise(1).cast("bigint")
    d = d.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(2).cast("bigint"))))
    part = lambda a, b, k: (F.col(a) + (F.col(b) - F.col(a)) * k / F.col("n")).cast("bigint")
    return d.select("det_id", "side", "k", part("ax", "bx", F.col("k")).alias("sx"), part("ay", "by", F.col("k")).alias("sy"), part("ax", "bx", F.col("k") + 1).alias("ex"), part("ay", "by", F.col("k") + 1).alias("ey"))


def unfinished(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done.select(*keys).distinct(), keys, "left_anti")


def tile_range(tiles: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Tiles by their 1-based place in the order of names, both ends included; null or 0 is the whole side. A row a tile."""
    at = F.row_number().over(Window.partitionBy().orderBy("tile_name"))
    return tiles.withColumn("_n", at).filter((F.col("_n") >= (start or 1)) & (F.lit(True) if not end else F.col("_n") <= end)).drop("_n")


def sampled_frames(df: DataFrame, step: int, count: int) -> DataFrame:
    return df.filter((F.col("z") - 1) % step < count)
