import itertools
import math
import random

import numpy as np

from slideloom.operators import score as C, spatial as S
from slideloom.operators.labels import spans


def points(spark, rows):
    return spark.createDataFrame([("f", k, float(x), float(y)) for k, (x, y) in enumerate(rows)], "img string, id bigint, x double, y double")


def greedy(ref, ours, r, k=3):
    edges = []
    for i, (x, y) in enumerate(ref):
        near = sorted((math.hypot(x - u, y - v), j) for j, (u, v) in enumerate(ours) if math.hypot(x - u, y - v) <= r)[:k]
        edges += [(d, i, j) for d, j in near]
    a, b, out = set(), set(), set()
    for d, i, j in sorted(edges):
        if i not in a and j not in b:
            a.add(i), b.add(j), out.add((i, j))
    return out


def test_greedy_is_sequential_greedy(spark):
    rnd = random.Random(1)
    ref = [(rnd.randrange(20), rnd.randrange(20)) for _ in range(60)]  # whole numbers: many ties
    ours = [(rnd.randrange(20), rnd.randrange(20)) for _ in range(50)]
    got = {(r.ref, r.ours) for r in S.matched(points(spark, ref), points(spark, ours), 3.0, ["img"]).collect()}
    assert got == greedy(ref, ours, 3.0)


def test_within_and_neighbours(spark):
    rnd = random.Random(2)
    ps = [(rnd.uniform(-30, 30), rnd.uniform(-30, 30)) for _ in range(80)]
    df = points(spark, ps).union(spark.createDataFrame([("f", 500, None, 1.0), ("f", 501, float("nan"), 1.0)], "img string, id bigint, x double, y double"))
    want = {(i, j) for i in range(80) for j in range(80) if math.dist(ps[i], ps[j]) <= 7}
    assert {(r.a, r.b) for r in S.within(df, df, 7.0, ["img"]).collect()} == want
    n = {r.id: r.neighbours for r in S.neighbours(df, 7.0, ["img"]).collect()}
    assert n[500] == n[501] == 0 and all(n[i] == sum(a == i for a, _ in want) - 1 for i in range(80))


def test_distance_to_edges(spark):
    shape = spark.createDataFrame([("f", 1, [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]])], "img string, shape_id bigint, rings array<array<struct<x:double,y:double>>>")
    ps = [(5, 5), (5, 1), (12, 5), (-3, -4), (30, 30)]
    d = {r.id: r.d for r in S.boundary_distance(points(spark, ps), S.segments(shape, ["img"]), 6.0, ["img"]).collect()}
    assert d == {0: 5.0, 1: 1.0, 2: 2.0, 3: 5.0}


def test_shift_is_found_and_chance_is_lower(spark):
    rnd = random.Random(3)
    ref = [(rnd.uniform(0, 200), rnd.uniform(0, 200)) for _ in range(60)]
    ours = [(x + 12, y - 8) for x, y in ref]
    best = S.best_shift(S.shift_votes(points(spark, ref), points(spark, ours), 20.0, 4.0, ["img"]), ["img"]).collect()[0]
    assert (best.dx, best.dy) == (3, -2) and best.votes >= 60
    shifts = spark.createDataFrame([(1, 40.0, 3.0), (2, -35.0, 20.0)], "shift int, dx double, dy double")
    assert S.chance_rate(points(spark, ref), points(spark, ref), 4.0, shifts, ["img"]).collect()[0].rate < 0.5


def test_assignment_against_all_ways():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, m = rng.integers(1, 5, 2).tolist()
        gains = np.where(rng.random((n, m)) < 0.6, rng.integers(1, 9, (n, m)).astype(float), 0.0)
        rows, columns = np.nonzero(gains)
        keep = C.best_assignment(rows, columns, gains[rows, columns])
        assert len(set(rows[keep])) == len(keep) == len(set(columns[keep]))
        wide = np.pad(gains, ((0, 0), (0, n)))  # a row may stay alone
        best = max(sum(wide[i, j] for i, j in enumerate(way)) for way in itertools.permutations(range(m + n), n))
        assert gains[rows[keep], columns[keep]].sum() == best


def test_a_long_group_is_solved():
    """A chain of 100,000 nodes: only pairs are held, and paths stay short."""
    n = 50_000
    rows, columns = np.repeat(np.arange(n), 2), np.minimum(np.arange(2 * n) // 2 + np.arange(2 * n) % 2, n - 1)
    rows, columns = rows[:-1], columns[:-1]
    gains = np.random.default_rng(0).integers(1, 100, len(rows)).astype(float)
    keep = C.best_assignment(rows, columns, gains)
    taken = skipped = 0.0  # the best total of a path's edges, one after another
    for g in gains:
        taken, skipped = skipped + g, max(taken, skipped)
    assert gains[keep].sum() == max(taken, skipped)


def test_settled_pairs_leave_the_total(spark):
    rng = np.random.default_rng(7)
    rows = [("k", int(a), int(b), float(g)) for a, b, g in zip(rng.integers(0, 40, 130), rng.integers(0, 40, 130), rng.integers(1, 30, 130))]
    once = {(a, b): g for _, a, b, g in rows}
    pairs = spark.createDataFrame([("k", a, b, g) for (a, b), g in once.items()], "img string, a int, b int, gain double")
    out = C.assigned(pairs, ["img"]).collect()
    a, b = (np.array(x) for x in zip(*once))
    alone = C.best_assignment(a, b, np.array(list(once.values())))
    assert len({r.a for r in out}) == len(out) == len({r.b for r in out})
    assert sum(r.gain for r in out) == sum(list(once.values())[k] for k in alone)


def test_total_counts_not_single_pairs(spark):
    pairs = spark.createDataFrame([("f", 0, 0, 0.504), ("f", 0, 1, 0.33), ("f", 1, 0, 0.33), ("g", 5, 7, 0.9)], "img string, a int, b int, gain double")
    got = {(r.img, r.a, r.b) for r in C.assigned(pairs, ["img"]).collect()}
    assert got == {("f", 0, 1), ("f", 1, 0), ("g", 5, 7)}


def test_sweep(spark):
    n = lambda k: spark.createDataFrame([("f", k)], "img string, n bigint")
    m = spark.createDataFrame([("f", x) for x in (0.9, 0.55, 0.5, 0.3)], "img string, iou double")
    row = C.sweep(n(4), n(5), m, ["img"], thresholds=(0.5,)).collect()[0]
    assert (row.tp, row.fp, row.fn, row.precision, row.recall, row.f1) == (3, 2, 1, 0.6, 0.75, 0.666667)
    none = C.sweep(n(4), n(5).limit(0), m.limit(0), ["img"], thresholds=(0.5,)).collect()[0]
    assert (none.tp, none.fp, none.fn, none.precision) == (0, 0, 4, 0.0)


def test_points_match_as_many_as_can_be(spark):
    ref, ours = [(0, 0), (4, 0)], [(3, 0), (100, 0), (-4.5, 0)]
    got = {(r.a, r.b) for r in C.match_points(points(spark, ref), points(spark, ours), 5.0, ["img"]).collect()}
    assert got == {(0, 2), (1, 0)}
    row = C.score_points(points(spark, ref), points(spark, ours), 5.0, ["img"]).collect()[0]
    assert (row.tp, row.fp, row.fn) == (2, 1, 0)


def test_outlines_at_the_border(spark):
    px = [(1, y, x, 1) for y in range(2) for x in range(3)] + [(1, y, x, 2) for y in range(4, 7) for x in range(4, 7)]
    runs = spans(spark.createDataFrame(px, "img int, y bigint, x bigint, label bigint"))
    inner = C.score_outlines(runs, runs, (0, 0, 10, 10), (0.5,)).collect()[0]
    pooled = C.score_outlines(runs, runs, None, (0.5,)).collect()[0]
    assert (inner.tp, pooled.tp) == (1, 2)
    s = C.outline_summary(runs, runs).collect()[0]
    assert (s.matched, s.mean_iou, s.split, s.merged, s.count_ratio) == (2, 1.0, 0, 0, 1.0)
