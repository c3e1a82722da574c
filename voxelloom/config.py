"""Settings, the class dimension, and where stages write."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Class id, name, color, type, priority in cross-class suppression.
CLASSES = [
    (0, "red glia", "red", "glia", 2),
    (1, "green glia", "green", "glia", 2),
    (2, "yellow glia", "yellow", "glia", 3),
    (3, "red neuron", "red", "neuron", 0),
    (4, "green neuron", "green", "neuron", 0),
    (5, "yellow neuron", "yellow", "neuron", 1),
]


@dataclass(frozen=True)
class Settings:
    """Thresholds and sizes; defaults are those of the usual two-channel run."""

    conf_thresh: float = 0.4
    nms_iou: float = 0.45
    xsize: int = 512
    ysize: int = 512
    step: int = 384
    tile_size: int = 2048
    start_id: int | None = None
    end_id: int | None = None
    link_overlap: float = 0.4
    link_gap: int = 3
    min_layers: int = 2
    downsample_z: bool = False
    run_qc: bool = True
    visualize: bool = False
    sample_step: int = 100
    sample_count: int = 20
    low_percentile: float = 0.1
    high_percentile: float = 99.9
    merge_z: bool = True
    classes: tuple[tuple, ...] = tuple(CLASSES)
    paths: dict[str, str] = field(default_factory=dict)


#: Keys of the configuration file and the setting that each gives.
KEYS = {
    "conf_thresh": "conf_thresh", "tHRESHOLD": "conf_thresh", "nms_iou": "nms_iou", "mINIOU": "nms_iou",
    "xsize": "xsize", "ysize": "ysize", "step": "step", "tILESIZE": "tile_size", "sTARTID": "start_id", "eNDID": "end_id",
    "overlapThresh": "link_overlap", "z_distance_limit": "link_gap", "dOWNSAMPLE_Z_2X": "downsample_z",
    "rUN_QC": "run_qc", "vISUALIZE_TILE": "visualize", "mERGEZ": "merge_z",
    "vISUALIZATIONSAMPLESTEP": "sample_step", "vISUALIZATIONSAMPLECOUNT": "sample_count",
    "dOWNSAMPLE_PERCENTILE_LOW": "low_percentile", "dOWNSAMPLE_PERCENTILE_HIGH": "high_percentile",
}


def load_config(path: str) -> Settings:
    """Settings from a JSON file, its sections flattened; a key that is null or absent keeps the default.

    labels_to_names, colors_map and type_map give the classes by their numbers; priorities go with the names. Paths that are
    texts, the model's among them, are kept by their keys.
    """
    flat: dict[str, Any] = {}

    def walk(node: dict[str, Any]) -> None:
        for k, v in node.items():
            if isinstance(v, dict):
                walk(v)
            else:
                flat.setdefault(k, v)

    data = json.loads(Path(path).read_text())
    names, colors, types = (data.pop(k, None) or {} for k in ("labels_to_names", "colors_map", "type_map"))
    walk({k: v for k, v in data.items() if k != "bgr_colors"})
    found = {KEYS[k]: v for k, v in reversed(flat.items()) if k in KEYS and v is not None}
    paths = {k: v for k, v in flat.items() if isinstance(v, str)}
    if names:
        priority = {name: p for _, name, _, _, p in CLASSES}
        found["classes"] = tuple((int(i), name, colors.get(i), types.get(i), priority.get(name)) for i, name in sorted(names.items(), key=lambda x: int(x[0])))
    return Settings(**found, paths=paths)


def dim_class(spark: SparkSession, classes: tuple[tuple, ...] = tuple(CLASSES)) -> DataFrame:
    """The classes, six unless the settings say otherwise; a handful, so it may be broadcast."""
    return spark.createDataFrame(list(classes), "class bigint, name string, color string, type string, priority bigint")
