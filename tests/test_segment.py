import numpy as np

from slideloom.operators import labels as L, morph, segment as G

POINTS = "img int, id int, x double, y double"


def test_masked_sides_add_up(spark):
    px = spark.createDataFrame([(1, 0, y, x, y * 10 + x) for y in range(8) for x in range(8)], "img int, c int, y bigint, x bigint, v bigint")
    mask = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (1, 1, 1)], "img int, my bigint, mx bigint")
    on, off = G.masked(px, mask, 4), G.masked(px, mask, 4, inside=False)
    assert on.count() == 32 and off.count() == 32 and on.where("y < 4 and x >= 4").count() == 0


def test_values_rounding_and_edges(spark):
    px = spark.createDataFrame([(1, y, x, y * 10 + x) for y in range(4) for x in range(4)] + [(1, 0, 0, -5)], "img int, y bigint, x bigint, v bigint")
    pts = spark.createDataFrame([(1, 0, 0.5, 1.5), (1, 1, 2.5, 2.5), (1, 2, -9.0, 99.0), (2, 3, 1.0, 1.0)], POINTS)
    assert {r.id: r.v for r in G.values_at(pts, px, 4, 4).collect()} == {0: 20, 1: 22, 2: 30, 3: None}


def test_interior_is_strict(spark):
    pts = spark.createDataFrame([(1, 0, 2.0, 5.0), (1, 1, 2.1, 5.0), (1, 2, 8.0, 5.0)], POINTS)
    assert [r.id for r in G.interior(pts, 2.0, 10.0, 10.0).collect()] == [1]


def test_points_in_windows(spark):
    rng = np.random.default_rng(0)
    pts = [(1, k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(0, 100, (200, 2)))]
    win = [(1, f"w{k}", *map(int, sorted(rng.integers(0, 100, 2))), *map(int, sorted(rng.integers(0, 100, 2)))) for k in range(9)]
    df = spark.createDataFrame([(i, n, a, c, b, d) for i, n, a, b, c, d in win], "img int, window_id string, y0 int, x0 int, y1 int, x1 int")
    got = {(r.id, r.window_id) for r in G.in_windows(spark.createDataFrame(pts, POINTS), df, 16).collect()}
    assert got == {(k, n) for _, k, x, y in pts for _, n, a, b, c, d in win if a <= y < b and c <= x < d}


def test_windows_on_many_bins_are_not_broadcast(spark):
    """Two windows of a million bins each, which an estimate holds for two rows."""
    pts = spark.createDataFrame([(1, 0, 3.5, 4.0), (1, 1, 1000.0, 2.0), (2, 2, 0.0, 0.0)], POINTS)
    win = spark.range(1, 3).selectExpr("cast(id as int) as img", "'w' as window_id", "0 as y0", "0 as x0", "1000 as y1", "1000 as x1")
    got = G.in_windows(pts, win, 1)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, 0, "w"), (2, 2, "w")]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_last_run(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 5, 6, 7, 7)] + [("b", 3)], "k string, n int")
    assert sorted(map(tuple, G.last_runs(df, ["k"], "n").collect())) == [("a", 5, 7), ("b", 3, 3)]


def test_same_labels(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, (9, 9)), rng.integers(0, 4, (9, 9))
    runs = lambda m: L.spans(spark.createDataFrame([(1, y, x, int(m[y, x])) for y in range(9) for x in range(9)], "img int, y bigint, x bigint, label bigint"))
    assert {r.label: r.n for r in G.same_label_overlap(runs(a), runs(b)).collect()} == {k: int(((a == k) & (b == k)).sum()) for k in (1, 2, 3) if ((a == k) & (b == k)).any()}


def test_cell_tables(spark):
    image = np.zeros((40, 40), int)
    image[4:8, 4:8], image[20:26, 18:24], image[30, 30], image[34:38, 2:6] = 9, 9, 9, 9
    px = spark.createDataFrame([(1, y, x, int(image[y, x])) for y in range(40) for x in range(40)], "img int, y bigint, x bigint, v bigint")
    mask = spark.createDataFrame([(1, y, x) for y in range(10) for x in range(10) if y < 8], "img int, my bigint, mx bigint")
    nuclei, cells = G.cell_tables(px, mask, 4, morph.threshold_objects(0), 1.0, tile=16, halo=12, min_um2=10.0, expand_px=2)
    small = {r.cell_id: r for r in nuclei.collect()}
    assert {k: (r.x_px, r.y_px, r.nucleus_area_um2) for k, r in small.items()} == {1: (5.5, 5.5, 16.0), 2: (20.5, 22.5, 36.0)}
    big = {r.cell_id: r for r in cells.collect()}
    assert set(big) == {1, 2} and all(big[k].area_um2 > small[k].nucleus_area_um2 and big[k].nc_ratio < 1 for k in big)


def test_roi_tiles(spark):
    import zlib

    lab = spark.createDataFrame([(1, y, x, 5) for y in range(10, 13) for x in range(20, 23)], "img int, y bigint, x bigint, label bigint")
    win = spark.createDataFrame([(1, "R", 11, 21, 19, 29)], "img int, roi_id string, y0 int, wx0 int, y1 int, wx1 int")
    row = G.roi_tiles(lab, win, 8).collect()[0]
    a = np.frombuffer(zlib.decompress(row.data), "<u4").reshape(8, 8)
    assert (row.roi_id, row.ty, row.tx) == ("R", 0, 0) and a.sum() == 20 and (a[:2, :2] == 5).all()
