"""Arrays against the long forms, and a whole run over generated tiles, from folders to every file."""

import csv
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from voxelloom.config import Settings, load_config
from voxelloom.operators import detector, images, qc, raster, report
from voxelloom.plans import fixture as X
from voxelloom.plans import queries, run
from voxelloom.sources import tiles

DATA = "/root/testdata/sf0.001"
KEYS = ["tile_no", "z"]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_arrays_equal_the_long_forms(spark):
    px = X.pixels(spark, DATA)
    long = rows(raster.local_maxima(px, KEYS, "c1").select(*KEYS, "y", "x", "c1"))
    assert rows(queries.local_maxima(spark, DATA).select(*KEYS, "y", "x", "c1")) == long
    sharp = {tuple(r[:2]): r[2] for r in raster.laplacian_variance(px, KEYS, "c1").select(*KEYS, "sharpness").collect()}
    got = {tuple(r[:2]): r[2] for r in queries.laplacian_var(spark, DATA).select(*KEYS, "sharpness").collect()}
    assert got.keys() == sharp.keys() and all(abs(got[k] - sharp[k]) < 1e-2 for k in got)
    flat = queries.by_number(images.each(X.slices(spark, DATA), "y long, x long, v long", lambda a, b, bits: [(y, x, int(v)) for (y, x), v in np.ndenumerate(images.stretch(a))]))
    assert rows(flat.select(*KEYS, "y", "x", "v")) == rows(raster.percentile_stretch(px, KEYS, "c1").select(*KEYS, "y", "x", F.col("stretched").cast("long")))


def test_edges_of_arrays():
    eight = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert images.stretch(eight) is eight and not images.stretch(np.full((20, 20), 7, np.uint16)).any()
    assert list(images.starts(2048, 512, 384)) == [0, 384, 768, 1152, 1536, 1920] and len(images.starts(2000, 512, 384)) == 7
    wide = images.aligned(np.ones((2, 9), np.uint16), np.zeros((4, 4), np.uint16))
    assert wide.sum() == 8 and not images.aligned(None, eight).any()
    assert images.small(np.zeros((1024, 256))).shape == (512, 128) and images.small(np.zeros((10, 20))).shape == (256, 512)
    flat = np.full((8, 8), 500, np.uint16)
    assert images.metrics(flat, 16, np.zeros((0, 4)), np.zeros(0))[:5] == [500.0, 0.0, 0.0, 0.0, 0.0]
    spot = flat.copy()
    spot[3, 3] = 9000
    assert images.metrics(spot, 16, np.zeros((0, 4)), np.zeros(0))[3:5] == [1.0, 1.0]
    assert images.metrics(spot, 16, np.array([[3.0, 3.0, 3.0, 3.0]]), np.array([0.5]))[3:] == [1.0, 0.0, 0.5, 0.5, 1.0]
    assert images.logic(flat, flat, np.zeros((0, 4)), np.zeros(0)) == (None, None)
    assert images.box_means(flat, flat, np.array([[1.9, 1.9, 3.9, 3.9], [9.0, 9.0, 12.0, 12.0]])) == [1000 / 3, 0.0]


def logic_by_hand(one, two, boxes, classes):
    errors, yellow = [], []
    for (x1, y1, x2, y2), c in zip(boxes.astype(int), classes, strict=True):
        a, b = one[y1:y2, x1:x2].mean() / (one.mean() + 1e-6), two[y1:y2, x1:x2].mean() / (two.mean() + 1e-6)
        need = [a > 1.2] if c in (0, 3) else [b > 1.2] if c in (1, 4) else [a > 1.2, b > 1.2]
        errors.append(not all(need))
        if c in (2, 5) and all(need):
            yellow.append(a / (b + 1e-6))
    return round(float(np.mean(errors)), 3), round(float(np.mean(yellow)), 2) if yellow else 0.0


def test_logic_of_colors():
    rng = np.random.default_rng(1)
    one, two = rng.integers(0, 100, (64, 64)).astype(np.uint16), rng.integers(0, 100, (64, 64)).astype(np.uint16)
    one[:20], two[:, :20] = 900, 800
    at = rng.integers(0, 50, (40, 2))
    boxes, classes = np.hstack([at, at + rng.integers(3, 12, (40, 2))]).astype(float), rng.integers(0, 6, 40)
    assert images.logic(one, two, boxes, classes) == logic_by_hand(one, two, boxes, classes)


@pytest.mark.parametrize("kind", [1, 8, 32773, 5])
def test_packed_tiffs(kind):
    image = (np.arange(600, dtype=np.uint16).reshape(20, 30) // 7 * 257).astype(np.uint16)
    plain = tiles.encode_tiff(image)
    raw = image.tobytes()

    def lzw(data):
        bits = "".join(f"{c:0{w}b}" for c, w in codes(data))
        return int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")

    def codes(data):
        table, width, now = {bytes([k]): k for k in range(256)}, 9, b""
        yield 256, 9
        size = 258
        for byte in data:
            more = now + bytes([byte])
            if more in table:
                now = more
                continue
            yield table[now], width
            table[more] = size
            size += 1
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
            now = bytes([byte])
        yield table[now], width
        yield 257, width

    packed = {1: raw, 8: zlib.compress(raw), 5: lzw(raw), 32773: b"".join(bytes([len(raw[k : k + 100]) - 1]) + raw[k : k + 100] for k in range(0, len(raw), 100))}[kind]
    directory = plain[8 + len(raw) :]
    directory = directory.replace(b"\x03\x01\x04\x00\x01\x00\x00\x00\x01\x00\x00\x00", b"\x03\x01\x04\x00\x01\x00\x00\x00" + kind.to_bytes(4, "little"))
    directory = directory.replace(len(raw).to_bytes(4, "little"), len(packed).to_bytes(4, "little"))
    data = plain[:4] + (8 + len(packed)).to_bytes(4, "little") + packed + directory
    assert np.array_equal(tiles.decode_tiff(data), image)
    assert tiles.decode_tiff(data[: len(data) // 2]) is None


def made_project(root):
    """Two tiles side by side, five slices each: bright blocks that go through depth, one broken slice, one without a second channel."""
    rng = np.random.default_rng(0)
    for t in range(2):
        for c in ("c1", "c2"):
            (root / c / f"t_{t}").mkdir(parents=True)
        for k in range(5):
            one, two = (rng.integers(20, 60, (64, 64)).astype(np.uint16) for _ in range(2))
            one[16:32, 16:32] = two[16:32, 16:32] = 4000
            (root / "c1" / f"t_{t}" / f"s{k}.tiff").write_bytes(tiles.encode_tiff(one) if (t, k) != (0, 2) else b"broken")
            if (t, k) != (1, 4):
                (root / "c2" / f"t_{t}" / f"s{k}.TIF").write_bytes(tiles.encode_tiff(two))
    (root / "c1" / "xml_import.xml").write_text('<?xml version="1.0"?><T><dimensions stack_rows="1" stack_columns="2" stack_slices="5"/><STACKS><Stack ROW="0" COL="0" ABS_H="0" ABS_V="0" ABS_D="0" DIR_NAME="t_0"/><Stack ROW="0" COL="1" ABS_H="56" ABS_V="0" ABS_D="0" DIR_NAME="t_1"/></STACKS></T>')


def read(folder):
    out = []
    for p in sorted(folder.rglob("*.csv")):
        if p.is_file():
            with p.open() as f:
                out += list(csv.DictReader(f))
    return out


def test_a_whole_run(spark, tmp_path):
    made_project(tmp_path)
    settings = Settings(xsize=32, ysize=32, step=32, tile_size=64, run_qc=True, visualize=True)
    root = f"file://{tmp_path}"
    assert [n for n, _ in tiles.leaf_folders(spark, f"{root}/c1")] == ["t_0", "t_1"]
    files = run.project(spark, settings, lambda: detector.bright_blocks(100, 16), f"{root}/c1", f"{root}/c2", f"{root}/out")
    out = tmp_path / "out"
    boxes = read(out / "global_bboxes.csv")
    assert len(boxes) == 2 and {(b["tile_name"], float(b["x1"]), float(b["y1"])) for b in boxes} == {("t_0", 16.0, 16.0), ("t_1", 72.0, 16.0)}
    assert all(abs(float(b["mean"]) - 8000 / 3) < 1e-6 for b in boxes) and {b["slice_name"] for b in boxes} <= {f"s{k}" for k in range(5)}
    assert len(read(out / "global_centroids.csv")) == 2 and len(read(out / "cell_centroids")) == 2 and not read(out / "unknown_classes.csv")
    stats = {(r["Group"], r["Category"]): (r["Count"], r["Percentage(%)"]) for r in read(out / "global_summary_statistics.csv")}
    assert stats["Class", "red glia"] == ("2", "100.0") and stats["Type", "neuron"] == ("0", "0.0") and len(stats) == 11
    quality = read(out / "qc_metrics")
    assert len(quality) == 9  # the broken slice has no row, and the others keep their places
    assert sorted(int(q["z"]) for q in quality) == [1, 1, 2, 2, 3, 4, 4, 5, 5] and all(float(q["c1_mean_intensity"]) > 200 for q in quality)
    assert sorted(q["logic_mismatch_rate"] for q in quality) == [""] + ["0.0"] * 8  # nothing is found without the second channel
    summary = read(out / "Global_Project_Summary.csv")
    assert [(s["Tile_Name"], s["Total_Cells"], s["Total_Layers"], s["QC_Status"]) for s in summary] == [("t_0", "4", "4", "PASS"), ("t_1", "4", "5", "PASS")]
    assert "settings" in json.loads((out / "runtime_config.json").read_text()) and spark.read.parquet(files["visualization_tile"]).count() == 8 * 4
    back = tiles.global_boxes(spark, files["global_bboxes.csv"])
    assert back.count() == 2 and back.columns[-2:] == ["tile_name", "slice_name"]
    stages = sorted(p.name for p in (out / "stages").iterdir())
    run.project(spark, settings, lambda: detector.bright_blocks(100, 16), f"{root}/c1", f"{root}/c2", f"{root}/out")
    assert sorted(p.name for p in (out / "stages").iterdir()) == stages and len(read(out / "global_bboxes.csv")) == 2
    alone = run.project(spark, Settings(conf_thresh=0.3, xsize=32, ysize=32, step=32, tile_size=64, run_qc=False, merge_z=False, start_id=1, end_id=1, downsample_z=True), lambda: detector.bright_blocks(60, 16), f"{root}/c1", f"{root}/none", f"{root}/out2")
    assert len(read(tmp_path / "out2" / "global_bboxes.csv")) == 2 and "qc_metrics" not in alone  # slices 0 and 4; 2 is broken
    with pytest.raises(FileNotFoundError):
        run.project(spark, settings, detector.bright_blocks, f"{root}/none", None, f"{root}/out3")


def test_drift_of_shifted_slices(spark):
    base = np.random.default_rng(3).integers(200, 4000, (64, 64)).astype("<u2")
    data = [("t", str(k), k + 1, 64, 64, 16, np.roll(base, (3 * k, 4 * k), (0, 1)).tobytes(), (base // 100).tobytes()) for k in range(3)]
    boxes = spark.createDataFrame([], "tile_name string, z int, det_id long, x1 double, y1 double, x2 double, y2 double, score double, class long")
    got = rows(images.slice_quality(images.measured(spark.createDataFrame(data, images.IMAGES), boxes, True, 64)).select("z", "c1_drift", "c2_drift", "detection_count", "logic_mismatch_rate"))
    assert got == [(1, 0.0, 0.0, 0, None), (2, 5.0, 0.0, 0, None), (3, 5.0, 0.0, 0, None)]
    whole = qc.tile_rollup(spark.createDataFrame([("t", 3)], "tile_no string, detection_count int")).first()
    assert (whole.total_cells, whole.avg_confidence, whole.max_drift, whole.qc_status) == (3, 0.0, 0.0, "PASS")


def test_readers_and_settings(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a_result.csv").write_text("s1,1,2,3,4,red glia,0.5,7.5,3.0\nshort,1\ns2,5,6,7,8,green glia,0.6,7.5,3.0\n")
    assert tiles.single_tile(spark, f"file://{tmp_path}/r").count() == 2 and tiles.single_tile(spark, f"file://{tmp_path}").count() == 0
    assert [(r.z, len(r.boxes)) for r in tiles.cached_detections(spark, f"file://{tmp_path}/r").collect()] == [(3, 2)]
    (tmp_path / "c.json").write_text(json.dumps({"labels_to_names": {"1": "green glia", "0": "red glia"}, "colors_map": {"0": "red"}, "type_map": {"0": "glia"}, "bgr_colors": {"red": [0, 0, 255]}, "p": {"mERGEZ": False}, "vISUALIZATIONSAMPLESTEP": 7, "dOWNSAMPLE_PERCENTILE_LOW": 0.5, "model_path": "m.pt"}))
    s = load_config(str(tmp_path / "c.json"))
    assert s.classes == ((0, "red glia", "red", "glia", 2), (1, "green glia", None, None, 2)) and (s.merge_z, s.sample_step, s.low_percentile, s.paths) == (False, 7, 0.5, {"model_path": "m.pt"})
    names = spark.createDataFrame([(0, "row001_col001"), (1, "row002_col000"), (2, "row001_col000")], "pos long, name string")
    assert {r.name: (r.row, r.col) for r in report.grid_from_names(names, False, False).collect()} == {"row001_col001": (1, 0), "row002_col000": (0, 1), "row001_col000": (1, 1)}


def test_long_forms_equal_the_arrays(spark):
    px, boxes = X.pixels(spark, DATA), X.image_boxes(spark, DATA)
    long = raster.compose(px.select(*KEYS, "y", "x", F.col("c1").alias("v")), px.filter("c2 > 500").select(*KEYS, "y", "x", F.col("c2").alias("v")), KEYS)
    assert rows(long.select(*KEYS, "y", "x", "c1", "c2")) == rows(queries.channel_compose(spark, DATA))
    assert rows(raster.resize_nearest(px, X.images(px), KEYS, 20).select(*KEYS, "y", "x", "c1")) == rows(queries.resize_nearest(spark, DATA))
    means = dict(rows(queries.box_mean(spark, DATA)))
    got = dict(rows(raster.box_mean(boxes, px, X.images(px), KEYS).select("det_id", "mean")))
    assert got.keys() == means.keys() and all(abs(got[k] - means[k]) < 1e-6 for k in got) and 0.0 in means.values()


ARRAYS = ["channel_logic", "tile_qc_rollup", "box_mean", "resize_nearest", "channel_compose", "miss_ratio", "peaks_in_boxes_semi", "percentile_stretch"]


@pytest.mark.parametrize("name", ARRAYS)
def test_images_stay_one_row_a_slice(spark, name):
    """Pixels as rows look as small to Spark as the files they come from, and were broadcast; one small file was one task."""
    df = queries.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(" not in plan and "RepartitionByExpression" in plan


def test_long_forms_never_broadcast_pixels(spark):
    px = X.pixels(spark, DATA)
    v = px.select(*KEYS, "y", "x", F.col("c1").alias("v"))
    for df in (raster.compose(v, v, KEYS), raster.resize_nearest(px, X.images(px), KEYS, 20), raster.percentile_stretch(px, KEYS, "c1"), raster.box_mean(X.image_boxes(spark, DATA), px, X.images(px), KEYS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = [b[: b.index("Scan parquet")] for b in plan.split("BroadcastExchange")[1:]]
        assert "SortMergeJoin" in plan and not any("explode(" in b.split("HashAggregate")[0] for b in below)


def test_sums_of_boxes():
    image = np.random.default_rng(3).integers(0, 60_000, (7, 9)).astype(np.uint16)
    boxes = np.array([[0, 0, 9, 7], [1.9, 2.9, 4.9, 5.9], [-3, -3, 2, 2], [8, 6, 50, 50], [5, 5, 5, 9], [6, 6, 2, 2], [np.nan, 0, 3, 3], [-9, -9, -1, -1]])
    total, n = images.box_sums(image, boxes)
    want = [image, image[2:5, 1:4], image[:2, :2], image[6:, 8:], image[:0], image[:0], image[:3, :3], image[:0]]
    assert total.tolist() == [int(w.sum(dtype=np.int64)) for w in want] and n.tolist() == [w.size for w in want]
