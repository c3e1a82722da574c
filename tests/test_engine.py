"""The detection engine: hand-made edges, brute force, and both engines on the whole small tables."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom import storage
from voxelloom.config import Settings, dim_class, load_config
from voxelloom.functions.graph import components
from voxelloom.operators import detector, linker, qc, report, stitch, suppress
from voxelloom.plans import oracle, queries, run
from voxelloom.sources import tiles
from voxelloom.streaming.tiles import follow

DATA = "/root/testdata/sf0.001"
BOX = "det_id long, tile_no long, z long, class long, x1 double, y1 double, x2 double, y2 double, score double"


def frame(spark, rows):
    return spark.createDataFrame(rows, BOX)


def ids(df):
    return sorted(r.det_id for r in df.select("det_id").collect())


def test_seam_edges(spark):
    rows = [(i, 0, 1, 0, float(x), 0.0, x + 5.0, 5.0, 0.5) for i, x in enumerate((351, 352, 543, 544))]
    got = {r.det_id: r.on_seam for r in suppress.flag_seams(frame(spark, rows), 2048, 2048, 512, 512, 384).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False}
    forms = [suppress.on_seam(F.col("x1"), 2048, 384, w) for w in (512, 700)]  # the closed form and the general one
    assert frame(spark, rows).select(*forms).count() == 4


def test_seam_suppression_is_strict_and_counts_end_pixels(spark):
    rows = [(1, 0, 1, 0, 400.0, 0.0, 409.0, 9.0, 0.9), (2, 0, 1, 0, 405.0, 0.0, 414.0, 9.0, 0.8), (3, 0, 1, 0, 404.0, 0.0, 413.0, 9.0, 0.7)]
    assert ids(suppress.seam_suppress(frame(spark, rows), ["tile_no", "z", "class"], 2048, 2048, 512, 512, 384)) == [1, 2]


def test_priority_and_ties(spark):
    rows = [
        (1, 0, 1, 3, 0.0, 0.0, 10.0, 10.0, 0.9), (2, 0, 1, 2, 0.0, 0.0, 10.0, 10.0, 0.1),  # yellow glia wins
        (3, 0, 1, 0, 50.0, 0.0, 60.0, 10.0, 0.5), (4, 0, 1, 0, 50.0, 0.0, 60.0, 10.0, 0.5),  # equal: the smaller id
        (5, 0, 1, 0, 100.0, 0.0, 110.0, 10.0, 0.5), (6, 0, 1, 1, 110.0, 0.0, 120.0, 10.0, 0.5),  # touching edges
        (7, 0, 2, 9, 0.0, 0.0, 10.0, 10.0, 0.9), (8, 0, 3, 0, 5.0, 5.0, 5.0, 9.0, 0.4),  # unknown class; no area
    ]
    df = suppress.priority_suppress(frame(spark, rows), dim_class(spark), ["tile_no", "z"])
    assert ids(df) == [2, 3, 5, 6, 8]
    again = suppress.priority_suppress(df.select(*[c.split()[0] for c in BOX.split(", ")]), dim_class(spark), ["tile_no", "z"])
    assert ids(again) == ids(df)


def test_ownership_edges(spark):
    layout = spark.createDataFrame([(0, 0, 0, 0, 0, 0), (1, 0, 1, 80, 0, 0)], "tile_no long, row long, col long, abs_x long, abs_y long, abs_z long")
    rows = [(1, 1, 1, 0, 18.0, 0.0, 21.0, 5.0, 0.5), (2, 1, 1, 0, 20.0, 0.0, 20.0, 5.0, 0.5), (3, 0, 1, 0, 90.0, 0.0, 95.0, 5.0, 0.5), (4, 7, 1, 0, 0.0, 0.0, 5.0, 5.0, 0.5)]
    placed = stitch.globalise(frame(spark, rows), layout, 100, 5)
    assert ids(stitch.owned(placed, 100)) == [2, 3]


def overlap(a, b):
    """The largest of IoU and either share, of boxes x1, y1, x2, y2."""
    size = lambda r: max(0.0, r[2] - r[0]) * max(0.0, r[3] - r[1])
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    return max(inter / (size(a) + size(b) - inter + 1e-6), inter / (size(a) + 1e-6), inter / (size(b) + 1e-6))


def tracks_of(rows, threshold, gap, least):
    """det_ids that stand for tracks, by plain loops over all boxes; rows are det_id, tile, z, class, box, score."""
    rows = sorted(rows, key=lambda r: (r[2], r[3] > 2, r[1], r[0]))
    tracks, free = [], set(range(len(rows)))
    for z in range(min(r[2] for r in rows), max(r[2] for r in rows) + 1):
        layer = [i for i, r in enumerate(rows) if r[2] == z]
        for t in tracks:
            last = rows[t[-1]]
            if z - last[2] > gap:
                continue
            best = None
            for i in layer:
                if i in free and rows[i][3] == last[3]:
                    v = overlap(last[4:8], rows[i][4:8])
                    if v > threshold and (best is None or v > best[0]):
                        best = v, i
            if best:
                t.append(best[1])
                free.discard(best[1])
        for i in layer:
            if i in free:
                free.discard(i)
                tracks.append([i])
    out = []
    for t in tracks:
        if len(t) >= least:
            top = max(rows[i][8] for i in t)
            out.append(next(rows[i][0] for i in t if rows[i][8] == top))
    return sorted(out)


@pytest.mark.parametrize("seed", [2, 3, 4])
def test_linker_equals_plain_loops(spark, seed):
    random.seed(seed)
    rows = []
    for i in range(300):
        x, y = random.randrange(0, 150), random.randrange(0, 150)
        rows.append((1000 - i, random.randrange(3), random.randrange(1, 13), random.randrange(0, 6), float(x), float(y), x + 20.0, y + 20.0, random.randrange(50, 60) / 100))
    df = spark.createDataFrame(rows, "det_id long, tile_no long, z long, class long, x1 double, y1 double, x2 double, y2 double, score double")
    for least in (1, 2):
        assert ids(linker.link(df, 0.3, 3, least)) == tracks_of(rows, 0.3, 3, least)


def test_components_of_long_paths(spark):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(500, 400), (450, 500), (600, 600)]
    got = {r.id: r.component for r in components(spark.createDataFrame([(i,) for i in [*range(n + 1), 400, 450, 500, 600, 700]], "id long"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[500] == got[450] == 400 and got[600] == 600 and got[700] == 700


def test_linker_gap_and_single_layer():
    box = (0.0, 0.0, 10.0, 10.0)
    assert linker.link_rows([(1, 1, 0, *box, 0.5), (2, 4, 0, *box, 0.9)], 0.4, 3, 2) == [2]
    assert linker.link_rows([(1, 1, 0, *box, 0.5), (2, 5, 0, *box, 0.9)], 0.4, 3, 2) == []
    assert linker.link_rows([(1, 1, 0, *box, 0.5), (2, 2, 1, *box, 0.9)], 0.4, 3, 2) == []
    assert linker.link_rows([(1, 1, 0, *box, 0.5), (2, 2, 0, *box, 0.5)], 0.4, 3, 2) == [1]


def test_statistics_keep_empty_categories(spark):
    out = report.statistics(frame(spark, [(1, 0, 1, 0, 0.0, 0.0, 1.0, 1.0, 0.5)]), dim_class(spark))
    got = {(r["group"], r["category"]): (r["count"], r["percentage"]) for r in out.collect()}
    assert len(got) == 11 and got["Class", "red glia"] == (1, 100.0) and got["Color", "green"] == (0, 0.0)


def test_rollup_skips_nan(spark):
    df = spark.createDataFrame([(0, 3, 0.5, 10.0, float("nan"), 0.1), (0, 2, None, 20.0, 11.0, 0.1)], "tile_no long, detection_count long, c1_avg_conf double, c1_sharpness double, c1_drift double, logic_mismatch_rate double")
    r = qc.tile_rollup(df).first()
    assert (r.total_cells, r.avg_confidence, r.avg_sharpness, r.max_drift, r.qc_status) == (5, 0.5, 15.0, 11.0, "FAIL")


def test_drift_finds_whole_shifts():
    a = np.random.default_rng(0).integers(100, 4000, (64, 64)).astype(float)
    assert qc.shift_between(a, np.roll(a, (3, -4), (0, 1))) == 5.0 and qc.shift_between(a, a) == 0.0
    assert qc.shift_between(np.ones((4, 4)), np.ones((4, 4))) == 0.0


def test_tiff_folders(spark, tmp_path):
    image = np.arange(48, dtype=np.uint16).reshape(6, 8)
    for tile in ("t_a", "t_b"):
        (tmp_path / "c1" / tile).mkdir(parents=True)
        for k in range(3):
            (tmp_path / "c1" / tile / f"s{k}.tiff").write_bytes(tiles.encode_tiff(image + k) if k != 1 else b"broken")
    got = {(r.tile_name, r.z): r for r in tiles.decoded(tiles.slices(spark, str(tmp_path / "c1"))).collect()}
    assert len(got) == 6 and got["t_a", 2].data is None and got["t_b", 3].height == 6
    assert np.array_equal(np.frombuffer(got["t_b", 3].data, "<u2").reshape(6, 8), image + 2)
    assert tiles.tiles(spark, str(tmp_path / "c1")).count() == 2


def test_layout_file(spark, tmp_path):
    (tmp_path / "xml_import.xml").write_text('<?xml version="1.0"?><T><dimensions stack_rows="1" stack_columns="2" stack_slices="9"/><STACKS><Stack ROW="0" COL="1" ABS_H="-5" ABS_V="2" ABS_D="1" DIR_NAME="a/b"/><Stack ROW="0" COL="0" ABS_H="0" ABS_V="0" ABS_D="0" DIR_NAME="a/c"/></STACKS></T>')
    path = tiles.layout_path(spark, f"file://{tmp_path}")
    assert sorted((r.tile_name, r.abs_x) for r in tiles.layout(spark, path).collect()) == [("b", -5), ("c", 0)]
    assert tiles.layout_size(spark, path).first().slices == 9
    with pytest.raises(FileNotFoundError):
        tiles.layout_path(spark, f"file://{tmp_path}/none")


def test_results_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t_result.csv").write_text("s1,1,2,3,4,red glia,0.5,7.5,3.0\n")
    assert tiles.tile_results(spark, str(tmp_path / "in")).first().z == 3
    follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), lambda df: df.filter("score > 0.4")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_config_and_stages(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": {"conf_thresh": 0.3, "step": 100, "sTARTID": null}, "out": "x"}')
    s = load_config(str(tmp_path / "c.json"))
    assert (s.conf_thresh, s.step, s.start_id, s.paths) == (0.3, 100, None, {"out": "x"})
    assert storage.settings_key(s) != storage.settings_key(Settings()) and "started" in storage.run_metadata(s)


def test_run_resumes_for_the_same_inputs_alone(spark, tmp_path):
    from voxelloom.plans import fixture as X

    det, layout = X.detections(spark, DATA), X.layout(spark, DATA)
    first = run.run(spark, det, layout, queries.SETTINGS, X.SLICES, f"file://{tmp_path}").collect()
    made = {p.name for p in tmp_path.iterdir()}
    again = run.run(spark, X.detections(spark, DATA), X.layout(spark, DATA), queries.SETTINGS, X.SLICES, f"file://{tmp_path}").collect()
    assert sorted(first) == sorted(again) and sum(r["count"] for r in first if r["group"] == "Class") > 0 and {p.name for p in tmp_path.iterdir()} == made
    fewer = run.run(spark, det.filter("z < 4"), layout, queries.SETTINGS, X.SLICES, f"file://{tmp_path}").collect()
    assert sorted(fewer) != sorted(first) and len({p.name for p in tmp_path.iterdir()}) == 2 * len(made)


def test_detector_shifts_boxes(spark):
    w = spark.createDataFrame([(1, 2, 10, 20, 8, 8, bytes([250] * 64))], "tile_no long, z long, wx long, wy long, height int, width int, data binary")
    r = detector.detect(w, lambda: detector.bright_blocks(200, 8)).collect()
    assert [(b.x1, b.y1, b.x2, b.y2) for b in r] == [(10.0, 20.0, 18.0, 28.0)]


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = queries.queries()[name](spark, DATA).toPandas(), con.execute(oracle.oracle_sql()[name]).fetchdf()
    rows = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
