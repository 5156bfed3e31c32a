import random
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("slideloom.llm")

from slideloom.llm import pack as P  # noqa: E402


def kinds(spark, *rows):
    return spark.createDataFrame(list(rows), "container_kind string, capacity_tokens int")


def test_every_item_once_and_none_cut_needlessly(spark):
    rnd = random.Random(4)
    items = [(k, rnd.choice([3, 3, 3, rnd.randrange(1, 64), rnd.randrange(60, 300)]), "clash") for k in range(3000)]
    items += [(5000, None, ""), (5001, 0, ""), (0, items[0][1], "")]
    df = spark.createDataFrame(items, "doc_id bigint, size int, part string")
    out = P.pack(df, kinds(spark, ("s", 64), ("l", 256), ("none", 0), (None, 9))).toPandas()
    for kind, capacity in (("s", 64), ("l", 256)):
        own = out[out.container_kind == kind]
        used = own.groupby("container")["size"].sum()
        assert used.max() <= capacity and set(used.index) == set(range(len(used)))
        assert own.groupby("doc_id")["size"].sum().to_dict() == {k: n * (2 if k == 0 else 1) for k, n, _ in items[:3000]}
        parts = own[own.doc_id != 0].groupby("doc_id")
        for k, n, _ in items[1:3000]:
            mine = parts.get_group(k).sort_values("part")
            assert len(mine) == -(-n // capacity) and list(mine["start"]) == [p * capacity for p in range(len(mine))]
        least = -(-int(own["size"].sum()) // capacity)
        assert len(used) <= least * 1.02 + 1
    assert set(out.container_kind) == {"s", "l"}
    use = {r.container_kind: r for r in P.usage(df, kinds(spark, ("s", 64), ("l", 256))).collect()}
    for kind in "sl":
        own = out[out.container_kind == kind]
        assert use[kind].containers == own["container"].nunique() >= use[kind].least_containers > 0
        assert use[kind].gap == round(use[kind].containers / use[kind].least_containers - 1, 6)


def test_kinds_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(k, 1 + k % 7) for k in range(60)], "doc_id bigint, size int")
    many = kinds(spark, *[(f"k{c}", c) for c in range(5, 12)])
    rows = lambda: {tuple(r) for r in P.pack(df, many).select("container_kind", "doc_id", "part", "start", "size").collect()}
    at_once = rows()
    monkeypatch.setattr(P, "BLOCK_KINDS", 3)
    assert rows() == at_once


def test_price_is_the_best_pattern():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 12, 4))
        most, weights = rng.integers(0, 4, len(sizes)), rng.random(len(sizes))
        grid = np.stack(np.meshgrid(*[np.arange(m + 1) for m in most], indexing="ij"), -1).reshape(-1, len(sizes))
        best = (grid @ weights)[grid @ sizes <= 20].max()
        held, weight = P.price(sizes, most, weights, 20)
        assert held @ sizes <= 20 and (held <= most).all()
        assert abs(weights @ held - best) < 1e-9 and abs(weight - best) < 1e-9


def histograms():
    rng = np.random.default_rng(1)
    yield rng.integers(1, 100, 5000), 128
    yield np.full(1000, 43), 128
    yield np.array([70] * 300 + [58] * 300), 128
    yield np.array([128]), 128
    yield rng.integers(1, 512, 170_000), 512
    yield rng.integers(150, 260, 30_000), 512
    yield rng.integers(1, 2048, 330_000), 2048
    yield np.clip(rng.lognormal(4.5, 1, 300_000).astype(int) + 1, 1, 512), 512
    yield rng.integers(1300, 4096, 200_000), 8192
    yield rng.integers(1500, 8000, 200_000), 8192


def best_fit_alone(s, n, capacity):
    return sum(many for many, _ in P.best_fit(Counter(dict(zip(s.tolist(), n.tolist()))), [], capacity))


@pytest.mark.parametrize("case", range(10))
def test_solutions_hold_the_histogram_and_little_else(case):
    x, capacity = list(histograms())[case]
    s, n = np.unique(x, return_counts=True)
    fitted, placed = best_fit_alone(s, n, capacity), Counter()
    found, bound = P.solve(s, n, capacity)
    for many, pattern in found:
        assert sum(a * b for a, b in pattern) <= capacity
        for a, b in pattern:
            placed[a] += many * b
    assert placed == Counter(dict(zip(s.tolist(), n.tolist())))
    used = sum(many for many, _ in found)
    solution = P.fractional(s, n, capacity, fitted)
    assert bound <= used <= fitted and solution.total <= fitted
    # The amounts cover every group; what best fit's packing has a share in is covered by it.
    share = 1 - solution.amounts.sum() / solution.total
    covered = share * solution.total / fitted + sum(a * solution.program.covered(p) / solution.program.area for a, p in zip(solution.amounts, solution.patterns))
    assert np.min(covered) >= 1 - 1e-9


def test_better_than_best_fit():
    x, capacity = list(histograms())[5]
    s, n = np.unique(x, return_counts=True)
    assert sum(m for m, _ in P.solve(s, n, capacity)[0]) < 0.98 * best_fit_alone(s, n, capacity)


def fewest(items, capacity):
    """Containers that a few items need, by trying all ways."""
    best = [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[k]:
                rest = list(rooms)
                rest.remove(room)
                go(k + 1, [*rest, room - items[k]])
        go(k + 1, [*rooms, capacity - items[k]])

    go(0, [])
    return best[0]


def test_bound_is_below_the_optimum(monkeypatch):
    rnd = random.Random(2)
    for groups in (64, 3):
        monkeypatch.setattr(P, "GROUPS", groups)
        monkeypatch.setattr(P, "LIQUID_SHARE", 0.2)
        for _ in range(80):
            capacity = rnd.choice([10, 20, 33])
            items = sorted((rnd.randrange(1, capacity + 1) for _ in range(rnd.randrange(1, 9))), reverse=True)
            s, n = np.unique(items, return_counts=True)
            found, bound = P.solve(s, n, capacity)
            assert bound <= fewest(items, capacity) <= sum(m for m, _ in found)
            assert P.least(s, n, capacity, P.fractional(s, n, capacity, len(items))) <= fewest(items, capacity) + 1e-9


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, size int")
    assert P.pack(none, kinds(spark, ("s", 8))).count() == 0
    assert P.pack(spark.createDataFrame([(1, 5)], "doc_id bigint, size int"), kinds(spark, ("s", None))).count() == 0
