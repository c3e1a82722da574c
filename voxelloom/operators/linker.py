"""Greedy linking of boxes through depth."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.graph import components
from ..storage import importable, stored

#: Edge of the grid cells that candidates are joined on.
CELL = 64.0


def candidates(df: DataFrame, threshold: float, gap: int, cell: float = CELL) -> DataFrame:
    """(a, b): boxes of one class, b one to gap layers deeper, that overlap above threshold.

    A box goes to every cell that it touches; the join is on class, cell and depth, so no side is ever broadcast against a range.
    """
    cells = lambda low, high: F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    spread = df.select("det_id", "class", "z", F.struct("x1", "y1", "x2", "y2").alias("box"), F.explode(cells("x1", "x2")).alias("gx"), cells("y1", "y2").alias("gys"))
    spread = spread.select("det_id", "class", "z", "box", "gx", F.explode("gys").alias("gy"))
    a = spread.select(F.col("det_id").alias("a"), "class", "gx", "gy", F.col("box").alias("box_a"), F.explode(F.sequence(F.col("z") + 1, F.col("z") + gap)).alias("z"))
    b = spread.select(F.col("det_id").alias("b"), "class", "gx", "gy", "z", F.col("box").alias("box_b"))
    return a.join(b, ["class", "gx", "gy", "z"]).filter(G.link_overlap(F.col("box_a"), F.col("box_b")) > threshold).select("a", "b").distinct()


def link_rows(rows: Iterable[tuple], threshold: float, gap: int, min_layers: int) -> list[int]:
    """ords of the boxes that stand for their tracks, of rows (ord, z, class, x1, y1, x2, y2, score) in the order of ord.

    Layer by layer each open track, in the order of its start, claims the free box of its class that overlaps it most above
    threshold (the first of equals); boxes that none claims start tracks. A track ends once its last box lies more
    than gap layers back. Tracks of min_layers boxes give their best box, the earliest of equals.
    """
    layers: defaultdict[int, list[tuple]] = defaultdict(list)
    for r in rows:
        layers[r[1]].append(r)
    out: list[int] = []
    open_: list[list[tuple]] = []

    def close(track: list[tuple]) -> None:
        if len(track) >= min_layers:
            out.append(max(track, key=lambda r: (r[7], -r[1]))[0])

    for z in sorted(layers):
        still = []
        for t in open_:
            if z - t[-1][1] > gap:
                close(t)
            else:
                still.append(t)
        free = sorted(layers[z])
        box = np.array([r[3:7] for r in free], dtype=float)
        size = np.maximum(0, box[:, 2] - box[:, 0]) * np.maximum(0, box[:, 3] - box[:, 1])
        classes = np.array([r[2] for r in free])
        taken = np.zeros(len(free), bool)
        for t in still:
            x1, y1, x2, y2 = t[-1][3:7]
            own = max(0.0, x2 - x1) * max(0.0, y2 - y1)
            inter = np.maximum(0, np.minimum(x2, box[:, 2]) - np.maximum(x1, box[:, 0])) * np.maximum(0, np.minimum(y2, box[:, 3]) - np.maximum(y1, box[:, 1]))
            best = np.maximum.reduce([inter / (own + size - inter + 1e-6), inter / (own + 1e-6), inter / (size + 1e-6)])
            best[taken | (classes != t[0][2])] = -1
            k = int(best.argmax())
            if best[k] > threshold:
                taken[k] = True
                t.append(free[k])
        open_ = still + [[r] for r, gone in zip(free, taken, strict=True) if not gone]
    for t in open_:
        close(t)
    return out


def link(df: DataFrame, threshold: float, gap: int, min_layers: int) -> DataFrame:
    """The rows of df that stand for tracks of min_layers boxes or more.

    df has det_id, which is unique, tile_no, class, z, the box and its score. Claims follow candidate pairs only, so each component
    of the candidate graph is linked by itself, in the order of z, group (glia first), tile and det_id. A component's rows are
    what one task holds. The pairs are made once and stored; df is read three times, so it is best a table.
    """
    names = ["det_id", "tile_no", "z", "class", "x1", "y1", "x2", "y2", "score"]
    boxes = df.select("det_id", *[F.col(c).cast("long").alias(c) for c in names[1:4]], *names[4:])
    pairs = stored(candidates(df, threshold, gap), "pairs")
    touched = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    comp = components(touched, pairs).withColumnRenamed("id", "det_id")

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(n).to_pylist() for n in names), strict=True), key=lambda r: (r[2], r[3] >= 3, r[1], r[0]))
        places = link_rows([(i, *r[2:]) for i, r in enumerate(rows)], threshold, gap, min_layers)
        return pa.table({"det_id": pa.array([rows[i][0] for i in places], pa.int64())})

    importable(df.sparkSession)
    linked = boxes.join(comp, "det_id").groupBy("component").applyInArrow(run, "det_id long")
    if min_layers <= 1:
        linked = linked.unionByName(boxes.join(touched.withColumnRenamed("id", "det_id"), "det_id", "left_anti").select("det_id"))
    return df.join(linked, "det_id", "left_semi")
