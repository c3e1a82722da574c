"""The detector's interface: anything that maps a window's pixels to boxes, loaded once in each Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..storage import importable

Boxes = list[tuple[float, float, float, float, float, int]]
#: Of a window, the least score and the overlap above which the model itself drops the weaker of two boxes.
Detector = Callable[[np.ndarray, float, float], Boxes]


def bright_blocks(level: int = 200, edge: int = 16) -> Detector:
    """A stand-in without weights: blocks of edge pixels whose mean is over level, class 0, score their mean / 255."""

    def detect(image: np.ndarray, conf: float = 0.0, iou: float = 1.0) -> Boxes:
        out: Boxes = []
        for y in range(0, image.shape[0] - edge + 1, edge):
            for x in range(0, image.shape[1] - edge + 1, edge):
                m = float(image[y : y + edge, x : x + edge].mean())
                if m > level and m / 255 >= conf:  # blocks never overlap, so iou drops none
                    out.append((float(x), float(y), float(x + edge), float(y + edge), m / 255, 0))
        return out

    return detect


def detect(windows: DataFrame, load: Callable[[], Detector], conf_thresh: float = 0.4, nms_iou: float = 0.45) -> DataFrame:
    """Boxes of windows (tile_no, z, wx, wy, height, width, data: 8-bit pixels), shifted by the window's origin.

    load runs once for each task, so a model's weights are read there and never shipped with rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for b in batches:
            out = []
            for tile, z, wx, wy, h, w, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for x1, y1, x2, y2, score, label in model(np.frombuffer(data, np.uint8).reshape(h, w), conf_thresh, nms_iou):
                    if score >= conf_thresh:
                        out.append((tile, z, x1 + wx, y1 + wy, x2 + wx, y2 + wy, score, label))
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 5, pa.int64()]
            names = ["tile_no", "z", "x1", "y1", "x2", "y2", "score", "class"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 8, kinds, strict=True)], names)

    columns = windows.select("tile_no", "z", "wx", "wy", "height", "width", "data")
    importable(windows.sparkSession)
    return columns.mapInArrow(run, "tile_no bigint, z bigint, x1 double, y1 double, x2 double, y2 double, score double, class bigint")
