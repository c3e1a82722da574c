"""The whole run as stage tables: folders of slices to linked boxes, statistics, quality and files."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Settings, dim_class
from ..operators import images, linker, qc, report, stitch, suppress
from ..operators.detector import Detector
from ..sources import tiles
from ..storage import fingerprint, listed, run_metadata, settings_key, stage, write_text

LOG = logging.getLogger("voxelloom")
#: Bits of a det_id that number a slice's boxes and a tile's slices; the tile's number takes the rest.
BOX_BITS, SLICE_BITS = 22, 18


def suppressed(detections: DataFrame, settings: Settings, tile: str = "tile_no") -> DataFrame:
    """Detections of each slice after seams, class by class, then priorities."""
    size = settings.tile_size
    kept = suppress.seam_suppress(detections, [tile, "z", "class"], size, size, settings.xsize, settings.ysize, settings.step)
    return suppress.priority_suppress(kept.drop("on_seam"), dim_class(detections.sparkSession, settings.classes), [tile, "z"])


def global_boxes(detections: DataFrame, layout: DataFrame, settings: Settings, slices: int) -> DataFrame:
    """Boxes in global coordinates that their tile owns, with what they carry of their source."""
    placed = stitch.owned(stitch.globalise(detections, layout, settings.tile_size, slices, settings.downsample_z), settings.tile_size)
    carried = [c for c in ("tile_name", "slice_name") if c in detections.columns]
    return placed.select("det_id", "tile_no", "z", "class", "x1", "y1", "x2", "y2", "score", "mean", *carried)


def numbered(detections: DataFrame) -> DataFrame:
    """det_id for each box, by tile, slice and place in the slice; raises where one of the three is too large for its bits."""
    place = F.row_number().over(Window.partitionBy("tile_no", "z").orderBy("class", F.desc("score"), "x1", "y1", "x2", "y2")).cast("bigint")
    fits = (place < 1 << BOX_BITS) & (F.col("z") < 1 << SLICE_BITS) & (F.col("tile_no") < 1 << 63 - BOX_BITS - SLICE_BITS)
    number = F.shiftleft("tile_no", BOX_BITS + SLICE_BITS) + F.shiftleft(F.col("z").cast("bigint"), BOX_BITS) + place
    return detections.withColumn("det_id", F.when(fits, number).otherwise(F.raise_error(F.lit("a tile, slice or box number is out of range"))))


def run(spark: SparkSession, detections: DataFrame, layout: DataFrame, settings: Settings, slices: int, out: str) -> DataFrame:
    """Stage tables under out, keyed by the settings and the inputs; stages that are there whole are not made again. Returns the statistics."""
    root = f"{out}/{settings_key(settings)}-{fingerprint(detections, layout, str(slices))}"
    kept = stage(lambda: suppressed(detections, settings), spark, f"{root}/detections")
    boxes = stage(lambda: global_boxes(kept, layout, settings, slices), spark, f"{root}/boxes")
    linked = stage(lambda: linked_boxes(boxes, settings), spark, f"{root}/linked")
    return stage(lambda: report.statistics(linked, dim_class(spark, settings.classes)), spark, f"{root}/statistics")


def linked_boxes(boxes: DataFrame, settings: Settings) -> DataFrame:
    """The boxes that stand for their tracks, or all boxes if tracks are not wanted."""
    return linker.link(boxes, settings.link_overlap, settings.link_gap, settings.min_layers) if settings.merge_z else boxes


def project(spark: SparkSession, settings: Settings, load: Callable[[], Detector], first: str, second: str | None, out: str) -> dict[str, str]:
    """A run from the channels' folders and the layout file in the first to every file; returns their paths by name.

    Images are one row a slice throughout. Tiles whose results are there for these settings and these folders are not detected
    again, and later stages that are there whole are not made again.
    """
    began = time.time()
    tiles.check_paths(spark, first, second)
    names = tiles.leaf_folders(spark, first)
    if not names or names == [(first.rstrip("/").rsplit("/", 1)[1], first.rstrip("/"))]:
        raise ValueError(f"no tiles in {first}")
    path = tiles.layout_path(spark, first)
    layout = tiles.layout(spark, path)
    slices = tiles.layout_size(spark, path).first()["slices"]
    seen = str([(name, [row[0].rsplit("/", 1)[1:] + list(row[2:]) for row in listed(spark, folder)]) for name, folder in names])
    root = f"{out}/stages/{settings_key(settings)}-{fingerprint(seen, str(slices))}"
    write_text(spark, f"{out}/runtime_config.json", run_metadata(settings))
    LOG.info("%d tiles, %d slices, stages at %s", len(names), slices, root)

    wanted = report.tile_range(spark.createDataFrame(names, "tile_name string, folder string"), settings.start_id, settings.end_id)
    one = tiles.slices(spark, first).join(F.broadcast(wanted.select("tile_name")), "tile_name", "left_semi")
    if settings.downsample_z:
        one = stitch.downsample_z(one)
    pixels = images.two_channels(one, tiles.second_channel(spark, second) if second else None, tiles.decode_tiff)
    found = images.detect(pixels, load, settings.xsize, settings.ysize, settings.step, settings.conf_thresh, settings.nms_iou, settings.low_percentile, settings.high_percentile)
    found = numbered(found.join(layout.select("tile_name", "tile_no"), "tile_name"))
    kept = stage(lambda: suppressed(found, settings), spark, f"{root}/detections")
    measured = stage(lambda: images.measured(pixels, kept, settings.run_qc), spark, f"{root}/results", "tile_name")
    results = measured.select(F.col("tile_name").cast("string").alias("tile_name"), F.col("stem").alias("slice_name"), "z", F.explode("boxes").alias("b")).select("tile_name", "slice_name", "z", "b.*")
    results = results.join(layout.select("tile_name", "tile_no"), "tile_name")
    boxes = stage(lambda: global_boxes(results, layout, settings, slices), spark, f"{root}/boxes")
    linked = stage(lambda: linked_boxes(boxes, settings), spark, f"{root}/linked")
    classes = dim_class(spark, settings.classes)
    statistics = stage(lambda: report.statistics(linked, classes), spark, f"{root}/statistics")
    files = {n: f"{out}/{n}" for n in ("global_bboxes.csv", "global_centroids.csv", "cell_centroids", "global_summary_statistics.csv", "unknown_classes.csv")}
    report.write_boxes(linked, files["global_bboxes.csv"])
    report.write_centroids(linked, files["global_centroids.csv"])
    report.write_per_class(report.per_class(linked, classes), files["cell_centroids"])
    report.write_statistics(statistics, files["global_summary_statistics.csv"])
    report.write_boxes(report.unknown(linked, classes), files["unknown_classes.csv"])
    if settings.run_qc:
        quality = stage(lambda: images.slice_quality(measured.withColumn("tile_name", F.col("tile_name").cast("string"))), spark, f"{root}/quality")
        files |= {n: f"{out}/{n}" for n in ("qc_metrics", "Global_Project_Summary.csv")}
        report.write_quality(quality, files["qc_metrics"])
        report.write_summary(qc.tile_rollup(quality, "tile_name"), files["Global_Project_Summary.csv"])
    if settings.visualize:
        drawn = results.filter((F.col("z") - 1) % settings.sample_step < settings.sample_count)
        files["visualization_tile"] = f"{out}/visualization_tile"
        report.dashes(drawn).write.mode("overwrite").parquet(files["visualization_tile"])
    LOG.info("done in %.2f minutes", (time.time() - began) / 60)
    return files | {"runtime_config.json": f"{out}/runtime_config.json"}
