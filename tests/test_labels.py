import math

import numpy as np
import pytest

from slideloom.operators import graph, labels as L, morph
from slideloom.operators.regions import filled, painted
from slideloom.plans import images


def raster(spark, a, name="label"):
    return spark.createDataFrame([(1, int(y), int(x), int(a[y, x])) for y in range(a.shape[0]) for x in range(a.shape[1])], f"img int, y bigint, x bigint, {name} bigint")


def pieces(mask, diagonal=True):
    out, n = np.zeros(mask.shape, int), 0
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (diagonal or not (a and b))]
    for y, x in zip(*np.nonzero(mask)):
        if out[y, x]:
            continue
        n += 1
        stack = [(y, x)]
        out[y, x] = n
        while stack:
            p, q = stack.pop()
            for a, b in steps:
                u, v = p + a, q + b
                if 0 <= u < mask.shape[0] and 0 <= v < mask.shape[1] and mask[u, v] and not out[u, v]:
                    out[u, v] = n
                    stack.append((u, v))
    return out


@pytest.fixture(scope="module")
def two():
    rng = np.random.default_rng(1)
    return np.kron(rng.integers(0, 5, (6, 6)), np.ones((3, 4), int)), rng.integers(0, 4, (18, 24))


def test_spans_stats_and_overlap(spark, two, monkeypatch):
    monkeypatch.setattr(L, "BIN", 5)
    a, b = two
    sa, sb = L.spans(raster(spark, a)), L.spans(raster(spark, b))
    back = {(r.y, r.x): r.label for r in L.pixels_of(sa).collect()}
    assert back == {(y, x): a[y, x] for y, x in zip(*np.nonzero(a))}
    stats = {r.label: (r.n, r.cx, r.cy) for r in L.label_stats(sa).collect()}
    for k in range(1, 5):
        y, x = np.nonzero(a == k)
        assert stats[k] == (len(y), round(x.mean(), 6), round(y.mean(), 6))
    shared = {(r.a, r.b): r.n for r in L.overlap(sa, sb).collect()}
    assert shared == {(i, j): n for i in range(1, 5) for j in range(1, 4) if (n := int(((a == i) & (b == j)).sum()))}
    for r in L.iou(sa, sb).collect():
        assert r.iou == round(r.n / ((a == r.a) | (b == r.b)).sum(), 6)


def test_one_span_centroid(spark):
    df = spark.createDataFrame([(1, 0, x, 7) for x in (2, 3, 4, 4)], "img int, y bigint, x bigint, label bigint")
    assert L.label_stats(L.spans(df)).select("n", "cx", "cy").collect() == [(3, 3.0, 0.0)]


@pytest.mark.parametrize("diagonal", [True, False])
def test_components_and_holes(spark, diagonal):
    rng = np.random.default_rng(2)
    mask = rng.random((20, 30)) < 0.45
    df = raster(spark, mask.astype(int)).where("label = 1").select("img", "y", "x")
    out = np.zeros(mask.shape, int)
    for r in L.pixels_of(L.foreground_components(df, diagonal)).collect():
        out[r.y, r.x] = r.label
    assert (out == pieces(mask, diagonal)).all()
    if diagonal:
        got = {(r.y, r.x) for r in L.holes(df, 20, 30, 3).collect()}
        back = pieces(~mask, False)
        want = set()
        for k in range(1, back.max() + 1):
            y, x = np.nonzero(back == k)
            if len(y) <= 3 and y.min() > 0 and y.max() < 19 and x.min() > 0 and x.max() < 29:
                want |= set(zip(y.tolist(), x.tolist()))
        assert got == want
        big = pieces(mask)
        kept = sum(n for n in np.bincount(big.ravel())[1:] if n >= 4)
        assert sum(r.x1 - r.x0 for r in L.without_small(df, 4).collect()) == kept


def test_graph_of_a_long_path_and_a_star(spark):
    n = 400
    nodes = spark.range(n + 60)
    edges = [((k * 7) % n, ((k + 1) * 7) % n) for k in range(n - 1)] + [(n + 10, n + k) for k in range(50)] + [(5, 5), (5, 99_999)]
    roots = {r.id: r.root for r in graph.components(nodes, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {roots[k] for k in range(n)} == {0} and {roots[n + k] for k in range(50)} == {n} and roots[n + 55] == n + 55


def test_dilation_and_expansion(spark):
    a = np.zeros((9, 11), int)
    a[4, 4], a[4, 8] = 1, 2
    runs = L.spans(raster(spark, a))
    grown = {(r.label, r.y, r.x) for r in L.pixels_of(L.dilated(runs, 2, 9, 11)).collect()}
    assert grown == {(k, y, x) for k, cx in ((1, 4), (2, 8)) for y in range(9) for x in range(11) if abs(y - 4) + abs(x - cx) <= 2}
    out = {(r.y, r.x): r.label for r in L.expanded(runs, 2, 9, 11).collect()}
    assert out[4, 6] == 1 and out[4, 7] == 2 and (4, 1) not in out and out[3, 3] == 1


def test_borders_crops_and_numbers(spark):
    a = np.zeros((6, 6), int)
    a[0, 1], a[2:4, 2:4], a[5, 5] = 1, 5, 9
    runs = L.spans(raster(spark, a))
    assert {r.label for r in L.drop_border(runs, 0, 0, 6, 6).collect()} == {5}
    window = spark.createDataFrame([(1, "R", 0, 0, 3, 6)], "img int, roi_id string, y0 int, wx0 int, y1 int, wx1 int")
    assert [(r.label, r.n_crop, r.n_whole) for r in L.cut_labels(runs, window).collect()] == [(5, 2, 4)]
    assert {(r.label, r.new_label) for r in L.relabelled(L.label_stats(runs), L.F.col("label") != 5).collect()} == {(1, 1), (9, 2)}


def test_folding_chains(spark):
    a = np.zeros((12, 12), int)
    a[1:9, 1:9], a[3:6, 3:6], a[4, 4], a[11, 11] = 3, 2, 1, 4
    roots = {r.label: r.root for r in L.folded(L.spans(raster(spark, a)), 2, 0.9, 12, 12).collect()}
    assert roots[4] == 4 and roots[3] == 3 and roots[2] == 3 and roots[1] in (2, 3) and roots[1] == 3


def test_distance_transform(spark):
    rng = np.random.default_rng(3)
    inside = rng.random((14, 17)) < 0.8
    df = raster(spark, inside.astype(int)).selectExpr("img", "y", "x", "label = 1 as inside")
    out = {(r.y, r.x): r.d for r in morph.distance_transform(df).collect()}
    zy, zx = np.nonzero(~inside)
    for y in range(14):
        for x in range(17):
            assert abs(out[y, x] - math.sqrt(((zy - y) ** 2 + (zx - x) ** 2).min())) < 1e-5
    all_in = df.selectExpr("img", "y", "x", "true as inside")
    assert {r.d for r in morph.distance_transform(all_in).collect()} == {None}


def test_watershed_and_prediction_do_not_depend_on_tiles(spark):
    rng = np.random.default_rng(4)
    e = rng.integers(0, 50, (20, 20))
    rows = [(1, y, x, float(e[y, x]), 1 if (y, x) == (3, 3) else 2 if (y, x) == (15, 16) else 0, True) for y in range(20) for x in range(20)]
    df = spark.createDataFrame(rows, "img int, y bigint, x bigint, elevation double, marker bigint, inside boolean")
    whole = {(r.y, r.x): r.label for r in morph.watershed(df, 20, 0).collect()}
    assert len(whole) == 400 and whole[3, 3] == 1 and whole[15, 16] == 2
    tiled = {(r.y, r.x): r.label for r in morph.watershed(df, 10, 20).collect()}
    assert tiled == whole
    mask = np.kron(rng.random((5, 5)) < 0.4, np.ones((4, 4)))
    px = raster(spark, (mask * 9).astype(int), "v")
    one = morph.predicted(px, 40, 0, morph.threshold_objects(0)).groupBy("label").count()
    many = morph.predicted(px, 10, 20, morph.threshold_objects(0)).groupBy("label").count()
    assert sorted(r["count"] for r in one.collect()) == sorted(r["count"] for r in many.collect())


def test_propagation_keeps_its_reach_on_tiles_smaller_than_the_image(spark):
    rng = np.random.default_rng(8)
    side, grow = 48, 3
    e, nuclei = rng.random((side, side)), np.zeros((side, side), int)
    for k in range(40):
        y, x = rng.integers(0, side - 1, 2)
        nuclei[y : y + 2, x : x + 2] = k + 1
    inside = rng.random((side, side)) < 0.9
    rows = [(1, y, x, float(e[y, x]), int(nuclei[y, x]), bool(inside[y, x])) for y in range(side) for x in range(side)]
    df = spark.createDataFrame(rows, "img int, y bigint, x bigint, elevation double, marker bigint, inside boolean")
    whole, tiled = ({(r.y, r.x): r.label for r in morph.propagated(df, tile, grow, 0.5).collect()} for tile in (side, 8))
    assert tiled == whole
    at = np.argwhere(nuclei > 0)
    d = {(y, x): math.sqrt(((at - (y, x)) ** 2).sum(1).min()) for y in range(side) for x in range(side)}
    assert all(whole[y, x] == nuclei[y, x] for y, x in at)
    assert all(d[p] <= grow for p in whole) and any(d[p] > grow for p in d) and any(d[p] > 2 for p in whole)
    # The distance counts: between two nuclei on a plain the border is in the middle, wherever the growth began.
    plain = [(1, 0, x, 0.5 - x / 1000, 1 if x == 0 else 2 if x == 9 else 0, True) for x in range(10)]
    plain = spark.createDataFrame(plain, "img int, y bigint, x bigint, elevation double, marker bigint, inside boolean")
    assert [r.label for r in morph.propagated(plain, 16, 6, 0.5).orderBy("x").collect()] == [1] * 5 + [2] * 5


def test_polygons_fill_pixels(spark):
    ring = [(1.0, 1.0), (9.0, 1.0), (9.0, 7.0), (1.0, 7.0)]
    hole = [(3.5, 2.5), (6.5, 2.5), (6.5, 5.5), (3.5, 5.5)]
    shapes = spark.createDataFrame([("i", 2, [ring, hole], 2), ("i", 1, [[(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)]], 1)], "image string, shape_id bigint, rings array<array<struct<x:double,y:double>>>, o int")
    own = {(r.y, r.x): r.shape_id for r in painted(filled(shapes, 1.0, "o", False), "o").collect()}
    cleared = {(r.y, r.x): r.shape_id for r in painted(filled(shapes, 1.0, "o", True), "o", "ring").collect()}
    assert own[4, 4] == 1 and (4, 4) not in cleared and own[6, 8] == cleared[6, 8] == 2 and own[0, 0] == 1 and (8, 8) not in own


def winding(side):
    """A single path of pixels that fills a square back and forth, and a dot."""
    a = np.zeros((side, side + 2), bool)
    a[::2, :side] = True
    for k, y in enumerate(range(1, side - 1, 2)):
        a[y, side - 1 if k % 2 == 0 else 0] = True
    a[0, side + 1] = True
    return a


@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("tile", [4, 7, 512])
def test_pieces_do_not_depend_on_tiles(spark, monkeypatch, diagonal, tile):
    monkeypatch.setattr(L, "TILE", tile)
    mask = np.random.default_rng(5).random((19, 26)) < 0.5
    out = np.zeros(mask.shape, int)
    for r in L.pixels_of(L.foreground_components(raster(spark, mask.astype(int)).where("label = 1").select("img", "y", "x"), diagonal)).collect():
        out[r.y, r.x] = r.label
    assert (out == pieces(mask, diagonal)).all()


def test_a_winding_piece_takes_no_rounds_of_joins(spark):
    mask = winding(61)
    df = raster(spark, mask.astype(int)).where("label = 1").select("img", "y", "x")
    spark.sparkContext.setJobGroup("winding", "")
    got = {(r.label, r.n) for r in L.label_stats(L.foreground_components(df)).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("winding"))
    spark.sparkContext.setJobGroup("none", "")
    assert got == {(1, int(mask.sum()) - 1), (2, 1)}
    assert jobs <= 25


def test_small_pieces_beside_a_winding_one(spark):
    mask = winding(61)
    df = raster(spark, mask.astype(int)).where("label = 1").select("img", "y", "x")
    spark.sparkContext.setJobGroup("small", "")
    got = [(r.y, r.x0, r.x1) for r in L.without_small(df, 4).collect()]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("small"))
    spark.sparkContext.setJobGroup("none", "")
    assert sum(b - a for _, a, b in got) == int(mask.sum()) - 1 and (0, 62, 63) not in {(y, a, b) for y, a, b in got}
    assert jobs <= 30


@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("tile", [4, 7, 512])
def test_sizes_of_pieces_do_not_depend_on_tiles(spark, monkeypatch, diagonal, tile):
    monkeypatch.setattr(L, "TILE", tile)
    mask = np.random.default_rng(6).random((19, 26)) < 0.45
    n = pieces(mask, diagonal)
    size, first = np.bincount(n.ravel()), {k: tuple(map(int, np.argwhere(n == k)[0])) for k in range(1, n.max() + 1)}
    df = raster(spark, mask.astype(int)).where("label = 1")
    got = L.span_pieces(L.spans(df), diagonal).collect()
    assert sum(r.x1 - r.x0 for r in got) == mask.sum()
    assert all(r.size == size[n[r.y, r.x0]] and (r.root.y, r.root.x0) == first[n[r.y, r.x0]] for r in got)
    kept = {(r.y, x): r.label for r in L.without_small(df.select("img", "y", "x"), 4, diagonal).collect() for x in range(r.x0, r.x1)}
    assert kept == {(y, x): n[y, x] for y, x in np.argwhere(mask) if size[n[y, x]] >= 4}


def test_small_pieces_within_tiles_start_no_graph(spark, folder):
    spark.sparkContext.setJobGroup("within", "")
    images.small_objects_removed(spark, folder).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("within"))
    spark.sparkContext.setJobGroup("none", "")
    assert jobs <= 12
