"""Two segmentations compared, and centres held against reference points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from slideloom.operators.labels import iou, label_stats
from slideloom.operators.segment import same_label_overlap
from slideloom.operators.spatial import chance_rate, matched, neighbours


def centres(runs: DataFrame) -> DataFrame:
    """(img, id, x, y): the centroid of each label."""
    return label_stats(runs).select("img", F.col("label").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y"))


def compare_methods(a: DataFrame, b: DataFrame, radius: float, tight: float, shifts: DataFrame) -> DataFrame:
    """One row per image: how well two segmentations, given as spans, agree (C4).

    Pairs at both radii as shares of either; the chance that shifted centres pair, and the
    margin over it, as shares of b; median IoU of the pairs, the share of it above a half, and
    the median ratio of areas.
    """
    ca, cb = centres(a), centres(b)
    pairs = matched(cb, ca, radius, ["img"])
    close = matched(cb, ca, tight, ["img"]).groupBy("img").agg(F.count("*").alias("pairs_tight"))
    size = lambda runs, n: label_stats(runs).select("img", F.col("label").alias(n), F.col("n").alias(f"area_{n}"))
    shared = iou(a, b).select("img", F.col("a").alias("ours"), F.col("b").alias("ref"), "iou")
    detail = pairs.join(shared, ["img", "ours", "ref"], "left").fillna(0.0, ["iou"]).join(size(a, "ours"), ["img", "ours"]).join(size(b, "ref"), ["img", "ref"])
    agree = detail.groupBy("img").agg(
        F.count("*").alias("pairs"), F.round(F.median("iou"), 6).alias("median_iou"), F.round(F.avg((F.col("iou") > 0.5).cast("int")), 6).alias("share_iou_half"),
        F.round(F.median(F.col("area_ours") / F.col("area_ref")), 6).alias("median_area_ratio"),
    )
    n = lambda c, name: c.groupBy("img").agg(F.count("*").alias(name))
    chance = chance_rate(cb, ca, radius, shifts, ["img"]).withColumnRenamed("rate", "chance")
    out = n(ca, "n_a").join(n(cb, "n_b"), "img").join(agree, "img", "left").join(close, "img", "left").join(chance, "img", "left").fillna(0, ["pairs", "pairs_tight"])
    share = lambda k, m: F.round(F.col(k) / F.col(m), 6)
    return out.select(
        "img", "n_a", "n_b", "pairs", "pairs_tight", share("pairs", "n_a").alias("share_a"), share("pairs", "n_b").alias("share_b"), "chance",
        F.round(F.col("pairs") / F.col("n_b") - F.col("chance"), 6).alias("margin"), "median_iou", "share_iou_half", "median_area_ratio",
    )


def worst_squares(a: DataFrame, b: DataFrame, side: int, least: int = 15, most: int = 3) -> DataFrame:
    """(img, gy, gx, n, median_iou, rank): squares of an image where two segmentations with the same numbers agree least.

    Every cell of ``a`` counts in the square of its centroid, with its IoU with the cell of its
    number in ``b``, 0 where they share nothing. Squares of fewer than ``least`` cells are left out.
    """
    size = label_stats(b).select("img", "label", F.col("n").alias("n_b"))
    cells = label_stats(a).join(size, ["img", "label"], "left").join(same_label_overlap(a, b).withColumnRenamed("n", "shared"), ["img", "label"], "left")
    cells = cells.fillna(0, ["n_b", "shared"]).withColumn("iou", F.round(F.col("shared") / (F.col("n") + F.col("n_b") - F.col("shared")), 6))
    squares = cells.groupBy("img", F.floor(F.col("cy") / side).alias("gy"), F.floor(F.col("cx") / side).alias("gx")).agg(
        F.count("*").alias("n"), F.median("iou").alias("median_iou")
    )
    rank = F.row_number().over(Window.partitionBy("img").orderBy("median_iou", "gy", "gx"))
    return squares.where(F.col("n") >= least).withColumn("rank", rank).where(F.col("rank") <= most)


def reference_matches(ref: DataFrame, ours: DataFrame, radius: float, crowd_radius: float, keys: Sequence[str]) -> DataFrame:
    """(keys, id, x, y, found, ours, d, neighbours): each reference point with its match and its crowd."""
    hit = matched(ref, ours, radius, keys).withColumnRenamed("ref", "id")
    near = neighbours(ref, crowd_radius, keys)
    joined = ref.join(hit, [*keys, "id"], "left").join(near, [*keys, "id"])
    return joined.select(*keys, "id", "x", "y", F.col("ours").isNotNull().alias("found"), "ours", "d", "neighbours")


def reference_rates(matches: DataFrame, chance: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, found_rate, chance, trusted, median_d): trusted where found at least three times as often as by chance."""
    rates = matches.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("found").cast("int")), 6).alias("found_rate"), F.round(F.median("d"), 6).alias("median_d")
    )
    joined = rates.join(chance.withColumnRenamed("rate", "chance"), list(keys), "left")
    return joined.select(*keys, "n", "found_rate", "chance", (F.col("found_rate") >= 3 * F.col("chance")).alias("trusted"), "median_d")
