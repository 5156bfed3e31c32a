import math
import random

import numpy as np
import pytest

from slideloom.operators import near as N

POINTS = "image string, id bigint, x double, y double, tx string"
SHAPES = "image string, id bigint, rings array<array<struct<x:double,y:double>>>, kind string"


def odd(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def brute(points, shapes, r):
    out, good = set(), {(i, k, x, y) for i, k, x, y, _ in points if None not in (i, k, x, y) and math.isfinite(x) and math.isfinite(y)}
    for i, a, x, y in good:
        out |= {(i, "cell", a, b) for j, b, u, v in good if i == j and a < b and (x - u) ** 2 + (y - v) ** 2 <= r * r}
        for j, s, rings, _ in shapes:
            if i == j and rings and len(rings[0]) >= 3 and odd(x, y, rings[0]) and not any(len(h) >= 3 and odd(x, y, h) for h in rings[1:]):
                out.add((i, "shape", a, s))
    return out


def found(spark, points, shapes, r, **more):
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(shapes, SHAPES)
    return [tuple(x) for x in N.near(p, s, r, **more).collect()]


def star(rnd, cx, cy, size, n=9):
    return [(cx + size * rnd.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), cy + size * rnd.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]


@pytest.mark.parametrize("leaf_points", [8, 100_000])
def test_against_brute_force(spark, leaf_points):
    rnd = random.Random(leaf_points)
    points = [(rnd.choice("ab"), k, rnd.uniform(-600, 900), rnd.uniform(0, 700), "t") for k in range(500)]
    points += [("a", 1000 + k, 300 + rnd.uniform(0, 9), 255 + rnd.uniform(0, 3), "t") for k in range(60)]  # a hot tile, across a border
    points += points[:20] + [("a", 2000, None, 1.0, ""), ("a", 2001, float("nan"), 1.0, ""), (None, 2002, 1.0, 1.0, ""), ("a", None, 1.0, 1.0, ""), ("c", 1, 2e3, 5.0, "")]
    shapes = []
    for k in range(25):
        cx, cy = rnd.uniform(-500, 800), rnd.uniform(0, 700)
        outer = star(rnd, cx, cy, 150)
        shapes.append((rnd.choice("ab"), 9000 + k, [outer + outer[:1] * (k % 2), star(rnd, cx, cy, 40)] if k % 3 else [outer], ""))
    shapes += [("a", 9100, None, ""), ("a", 9101, [], ""), ("a", 9102, [[(0.0, 0.0), (9.0, 9.0)]], ""), (None, 9103, [star(rnd, 0, 0, 99)], "")]
    shapes += shapes[:2]
    out = found(spark, points, shapes, 4.0, leaf_points=leaf_points)
    assert len(out) == len(set(out)) and set(out) == brute(points, shapes, 4.0)


def test_equal_places_and_exact_distance(spark):
    points = [("a", k, 5.0, 5.0, "") for k in range(50)] + [("a", 99, 9.0, 5.0, ""), ("a", 100, 13.0001, 5.0, "")]
    out = found(spark, points, [], 4.0, leaf_points=10)
    assert set(out) == brute(points, [], 4.0) and len(out) == 50 * 49 // 2 + 50


def test_empty(spark):
    assert found(spark, [], [], 4.0) == []
    assert found(spark, [("a", 1, 1.0, 1.0, "")], [], 4.0) == []


def test_tree_recursion_alone():
    rng = np.random.default_rng(3)
    for n in (1, 2, 13, 500):
        x, y = rng.uniform(0, 60, n), rng.uniform(0, 60, n)
        own = rng.random(n) < 0.7
        i, j = N.close_pairs(x, y, own, 5.0)
        want = {(a, b) for a in range(n) for b in range(a + 1, n) if (own[a] or own[b]) and (x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2 <= 25}
        assert {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)


def test_regions_only(spark):
    rnd = random.Random(9)
    points = [("a", k, rnd.uniform(0, 400), rnd.uniform(0, 400), "") for k in range(150)]
    shapes = [("a", 500 + k, [star(rnd, rnd.uniform(0, 400), rnd.uniform(0, 400), 120)], "") for k in range(6)]
    want = {x for x in brute(points, shapes, 0.0) if x[1] == "shape"}
    assert set(found(spark, points, shapes, -1.0, leaf_points=20)) == want

def test_pairs_certainly_near_are_taken_whole(monkeypatch):
    """Points of one small patch are all near one another; no distance is needed to know."""
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 2, 400), rng.uniform(0, 2, 400)
    monkeypatch.setattr(np, "nonzero", None)  # the test of single points
    i, j = N.close_pairs(x, y, np.ones(400, bool), 4.0)
    assert len(i) == 400 * 399 // 2 == len(set(zip(i.tolist(), j.tolist())))


@pytest.mark.parametrize("leaf_points", [30, 200])
def test_shapes_of_very_many_edges(spark, leaf_points, monkeypatch):
    """Edges beyond the limit are cut into parts, each with a task of its own, and give the same rows."""
    rnd = random.Random(leaf_points)
    points = [("a", k, rnd.uniform(0, 300), rnd.uniform(0, 300), "") for k in range(250)]
    shapes = [("a", 500 + k, [star(rnd, 150, 150, 140, 900), star(rnd, 150, 150, 40, 300)][: 1 + k % 2], "") for k in range(3)]
    shapes += [("a", 600, [star(rnd, 60, 60, 50)], "")]
    parts = []
    within = N._within_many_edges
    monkeypatch.setattr(N, "_within_many_edges", lambda p, e, n: parts.append((p, e, n)) or within(p, e, n))
    out = found(spark, points, shapes, 4.0, leaf_points=leaf_points)
    assert len(out) == len(set(out)) and set(out) == brute(points, shapes, 4.0) and parts
    _, edges, n = parts[0]
    cut = edges.join(n, N._LEAF).selectExpr("*", "pmod(xxhash64(id, ring, x, y, x2, y2), parts) as part").groupBy(*N._LEAF, "part").count()
    assert cut.agg({"count": "max"}).first()[0] <= 2 * leaf_points


def group_sizes(spark, points, leaf_points):
    tree = N._QuadTree(points, leaf_points, 4.0)
    return [r["count"] for r in N._point_rows(tree, 4.0).groupBy(*N._TASK).count().collect()], tree


def test_hot_tile_is_bounded(spark):
    """A hot tile's tasks hold two blocks at most, or a leaf and its few neighbours; repeats don't count."""
    spread = spark.range(8000).selectExpr("'a' as image", "id", "id % 90 * 1.4D as x", "id div 90 * 1.4D as y")
    sizes, _ = group_sizes(spark, spread, 50)
    assert max(sizes) <= 500  # 8,000 and more in the first block before
    same = spark.range(600).selectExpr("'a' as image", "id", "5.0D as x", "5.0D as y")
    sizes, _ = group_sizes(spark, same, 50)
    assert max(sizes) <= 200
    again = spark.range(20000).selectExpr("'a' as image", "id % 3 as id", "5.0D + id % 3 as x", "5.0D as y")
    sizes, tree = group_sizes(spark, again, 50)
    assert sizes == [3] and tree.points.count() == 3


def test_hot_border_of_a_large_leaf(spark):
    """Leaves of any size and blocks meet across tile borders, each pair once."""
    rnd = random.Random(4)
    points = [("a", k, 127.9 - rnd.uniform(0, 0.5), rnd.uniform(0, 40), "t") for k in range(150)]
    points += [("a", 500 + k, 128.0 + rnd.uniform(0, 3), 10 + rnd.uniform(0, 0.2), "t") for k in range(80)]
    points += [("a", 1000 + k, 128 + rnd.uniform(0, 300), rnd.uniform(0, 120), "t") for k in range(25)]
    out = found(spark, points, [], 4.0, leaf_points=30)
    assert len(out) == len(set(out)) and set(out) == brute(points, [], 4.0)
