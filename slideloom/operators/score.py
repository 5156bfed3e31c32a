"""Optimal assignment and accuracy of labels and points.

The assignment that maximises a total falls apart into the connected groups of the pairs
that may be matched. Pairs that some best assignment surely holds are settled in rounds of
joins first, which breaks groups up; each group left is solved exactly in its own task over
its pairs alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from slideloom.operators.graph import components
from slideloom.operators.labels import drop_border, iou, label_stats
from slideloom.operators.spatial import chance_rate, within
from slideloom.session import checkpointed

THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9)
#: Rounds in which pairs are settled at most; what then is left is solved all the same.
SETTLING_ROUNDS = 6


def best_assignment(rows: np.ndarray, columns: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Indices of the pairs of greatest total gain that share no row and no column.

    Shortest augmenting paths with potentials over the pairs given, each row with a column of
    its own for staying alone. Time follows the pairs near a path, memory the pairs.
    """
    order = np.lexsort((columns, rows))
    n, m = (int(v.max(initial=-1)) + 1 for v in (rows, columns))
    starts = np.searchsorted(rows[order], np.arange(n + 1)).tolist()
    at, cost = columns[order].tolist(), (-gains[order]).tolist()
    u = [min([0.0, *cost[starts[i] : starts[i + 1]]]) for i in range(n)]
    v = [0.0] * (m + n)
    row_of, pair_of = [-1] * (m + n), [-1] * (m + n)
    column_of: dict[int, int] = {}
    for free in range(n):
        least: dict[int, float] = {}
        came: dict[int, tuple[int, int]] = {}
        heap: list[tuple[float, int]] = []
        done: list[int] = []
        settled: set[int] = set()
        i, far = free, 0.0
        while True:
            alone = m + i
            for k in (*range(starts[i], starts[i + 1]), -1):
                j, c = (at[k], cost[k]) if k >= 0 else (alone, 0.0)
                if j in settled:
                    continue
                length = far + c - u[i] - v[j]
                if length < least.get(j, np.inf):
                    least[j], came[j] = length, (i, k)
                    heappush(heap, (length, j))
            while True:
                far, j = heappop(heap)
                if j not in settled and far <= least[j]:
                    break
            settled.add(j)
            if row_of[j] < 0:
                break
            done.append(j)
            i = row_of[j]
        u[free] += far
        for k in done:
            u[row_of[k]] += far - least[k]
            v[k] -= far - least[k]
        while True:
            i, k = came[j]
            before = column_of.get(i, -1)
            row_of[j], pair_of[j], column_of[i] = i, k, j
            if i == free:
                break
            j = before
    return order[[k for k in pair_of[:m] if k >= 0]] if m else order[:0]


def _settled(edges: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(pairs that some best assignment holds, the pairs left without their ends).

    A pair is settled where its gain is at least the greatest other gain of one end plus that
    of the other: whatever else an assignment gives the two, it is no less with the pair. Of
    equal gains the smaller numbers count as greater, so that no two settled pairs share an end.
    """
    done: DataFrame | None = None
    for _ in range(SETTLING_ROUNDS):
        ranked = edges
        for side in ("a", "b"):
            w = Window.partitionBy(*keys, side).orderBy(F.desc("gain"), "a", "b")
            ranked = ranked.withColumn(f"_{side}", F.row_number().over(w)).withColumn(f"_n{side}", F.coalesce(F.lead("gain").over(w), F.lit(0.0)))
        sure = ranked.where((F.col("_a") == 1) & (F.col("_b") == 1) & (F.col("gain") >= F.col("_na") + F.col("_nb")))
        now = checkpointed(sure.select(*edges.columns))
        if now.isEmpty():
            break
        done = now if done is None else done.unionByName(now)
        left = edges.join(now.select(*keys, "a"), [*keys, "a"], "left_anti").join(now.select(*keys, "b"), [*keys, "b"], "left_anti")
        edges = checkpointed(left.select(*edges.columns))
    return edges.limit(0) if done is None else done, edges


def assigned(pairs: DataFrame, keys: Sequence[str], gain: str = "gain") -> DataFrame:
    """(keys, a, b, gain): one-to-one pairs of greatest total gain; ``pairs`` has keys, a, b and a gain above 0.

    Groups that share no pair are solved apart; a task holds the pairs of a group that the
    settling rounds have not broken up.
    """
    k = [F.col(c).cast("string") for c in keys]
    node = lambda side: F.concat_ws("\x1f", F.lit(side), *k, F.col(side).cast("string"))
    names = [*keys, "a", "b"]
    given = checkpointed(pairs.select(*names, F.col(gain).cast("double").alias("gain")).where("gain > 0"))
    sure, edges = _settled(given, keys)
    edges = edges.withColumn("_a", node("a")).withColumn("_b", node("b"))
    nodes = edges.select(F.col("_a").alias("id")).unionByName(edges.select(F.col("_b").alias("id"))).distinct()
    roots = components(nodes, edges.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    grouped = edges.join(roots.withColumnRenamed("id", "_a"), "_a").drop("_a", "_b")
    schema = ", ".join(f"`{c}` {grouped.schema[c].dataType.simpleString()}" for c in names) + ", gain double"

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["a", "b"])
        i, j = pd.factorize(group["a"])[0], pd.factorize(group["b"])[0]
        return group.iloc[np.sort(best_assignment(i, j, group["gain"].to_numpy()))][[*names, "gain"]]

    return sure.select(*names, "gain").unionByName(grouped.groupBy("root").applyInPandas(solve, schema))


def sweep(n_gt: DataFrame, n_pred: DataFrame, matches: DataFrame, keys: Sequence[str], value: str = "iou", thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """(keys, threshold, tp, fp, fn, precision, recall, f1).

    ``n_gt`` and ``n_pred`` have keys and n, ``matches`` has keys and the value of each matched
    pair. Divisions by nothing count as divisions by 1.
    """
    both = n_gt.withColumnRenamed("n", "n_gt").join(n_pred.withColumnRenamed("n", "n_pred"), list(keys), "full").fillna(0, ["n_gt", "n_pred"])
    wanted = both.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    hit = matches.withColumn("threshold", F.explode(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col(value) >= t)))
    tp = hit.groupBy(*keys, "threshold").agg(F.count("*").alias("tp"))
    t = wanted.join(tp, [*keys, "threshold"], "left").fillna(0, ["tp"])
    return t.select(*keys, "threshold", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"), *_rates())


def _rates() -> list[Column]:
    p, r = F.col("tp") / F.greatest("n_pred", F.lit(1)), F.col("tp") / F.greatest("n_gt", F.lit(1))
    f1 = 2 * F.col("tp") / F.greatest(F.col("n_gt") + F.col("n_pred"), F.lit(1))
    return [F.round(c, 6).alias(n) for c, n in ((p, "precision"), (r, "recall"), (f1, "f1"))]


def score_outlines(gt: DataFrame, pred: DataFrame, window: tuple[int, int, int, int] | None = None, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Per image and threshold: outlines scored against hand-drawn ones.

    With a window, labels that touch its border are left out on both sides; without one, as
    for pooled scores, they are kept.
    """
    if window:
        gt, pred = drop_border(gt, *window), drop_border(pred, *window)
    found = assigned(iou(gt, pred), ["img"], "iou").withColumnRenamed("gain", "iou")
    count = lambda runs: runs.select("img", "label").distinct().groupBy("img").agg(F.count("*").alias("n"))
    return sweep(count(gt), count(pred), found, ["img"], "iou", thresholds)


def outline_summary(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(img, matched, mean_iou, median_iou, split, merged, count_ratio).

    ``split`` counts hand-drawn labels that several outlines overlap with an IoU of 0.1 or
    more, ``merged`` outlines that overlap several hand-drawn labels so.
    """
    pairs = iou(gt, pred)
    found = assigned(pairs, ["img"], "iou").groupBy("img").agg(F.count("*").alias("matched"), F.round(F.avg("gain"), 6).alias("mean_iou"), F.round(F.median("gain"), 6).alias("median_iou"))
    some = pairs.where("iou >= 0.1")
    many = lambda side, name: some.groupBy("img", side).count().where("count > 1").groupBy("img").agg(F.count("*").alias(name))
    n = lambda runs, name: label_stats(runs).groupBy("img").agg(F.count("*").alias(name))
    out = n(gt, "n_gt").join(n(pred, "n_pred"), "img", "full").join(found, "img", "left").join(many("a", "split"), "img", "left").join(many("b", "merged"), "img", "left")
    ratio = F.round(F.col("n_pred") / F.greatest("n_gt", F.lit(1)), 6)
    return out.fillna(0, ["n_gt", "n_pred", "matched", "split", "merged"]).select("img", "matched", "mean_iou", "median_iou", "split", "merged", ratio.alias("count_ratio"))


def match_points(ref: DataFrame, ours: DataFrame, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b, d): one-to-one pairs within the radius, as many as can be, of least total distance."""
    pairs = within(ref, ours, radius, keys)
    # As in the assignment with a fixed price beyond the radius: one more pair outweighs any distance.
    gains = pairs.withColumn("gain", F.lit(1000.0 * radius) - F.col("d"))
    return assigned(gains, list(keys)).withColumn("d", F.round(F.lit(1000.0 * radius) - F.col("gain"), 6)).drop("gain")


def score_points(ref: DataFrame, ours: DataFrame, radius: float, keys: Sequence[str], shifts: DataFrame | None = None) -> DataFrame:
    """(keys, tp, fp, fn, precision, recall, f1, median_d, chance): points scored against marks.

    ``chance`` is the share of marks that greedy matching finds after shifts, if given. Keys
    without marks have no row, as fields without marks are skipped.
    """
    found = match_points(ref, ours, radius, keys).groupBy(*keys).agg(F.count("*").alias("tp"), F.round(F.median("d"), 6).alias("median_d"))
    n = lambda rows, name: rows.groupBy(*keys).agg(F.count("*").alias(name))
    t = n(ref, "n_gt").join(n(ours, "n_pred"), list(keys), "left").join(found, list(keys), "left").fillna(0, ["n_pred", "tp"])
    out = t.select(*keys, "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"), *_rates(), "median_d")
    return out if shifts is None else out.join(chance_rate(ref, ours, radius, shifts, keys).withColumnRenamed("rate", "chance"), list(keys), "left")


def inner_points(points: DataFrame, held: DataFrame, near_edge: DataFrame, margin: float, keys: Sequence[str]) -> DataFrame:
    """Points of a field (keys, id), from ``held``, farther than ``margin`` from its border.

    ``held`` has the keys and ids inside fields; ``near_edge`` has id and d from boundary_distance.
    """
    inside = points.join(held, [*keys, "id"], "left_semi")
    return inside.join(near_edge.where(F.col("d") <= margin).select(*keys, "id"), [*keys, "id"], "left_anti")
