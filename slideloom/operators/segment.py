"""From pixels to cell tables: masks, tight and grown labels, per-cell values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from slideloom.operators import labels as L, morph
from slideloom.session import checkpointed


def masked(pixels: DataFrame, mask: DataFrame, factor: int, inside: bool = True) -> DataFrame:
    """Pixels on, or with ``inside`` False off, a reduced mask (img, my, mx).

    The mask joins by its place, so that pixels are filtered before anything is aggregated.
    """
    here = pixels.withColumn("my", F.floor(F.col("y") / factor).cast("bigint")).withColumn("mx", F.floor(F.col("x") / factor).cast("bigint"))
    once = mask.select("img", "my", "mx").distinct()
    return here.join(once, ["img", "my", "mx"], "left_semi" if inside else "left_anti").drop("my", "mx")


def same_label_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(img, label, n): the pixels that a label has in both of two rasters with the same numbers.

    Spans meet on their label and row, so that no other pairs are looked at.
    """
    p = a.select("img", "label", "y", F.col("x0").alias("a0"), F.col("x1").alias("a1"))
    q = b.select("img", "label", "y", F.col("x0").alias("b0"), F.col("x1").alias("b1"))
    shared = F.least("a1", "b1") - F.greatest("a0", "b0")
    return p.join(q, ["img", "label", "y"]).where(shared > 0).groupBy("img", "label").agg(F.sum(shared).alias("n"))


def values_at(points: DataFrame, pixels: DataFrame, height: int, width: int, keys: Sequence[str] = ("img",)) -> DataFrame:
    """``points`` (keys, id, x, y) with the value v of the pixel they lie on, rounded half to even and kept inside the image.

    NULL where the image has no such pixel; of repeated pixels the largest value counts.
    """
    at = lambda c, most: F.least(F.greatest(F.bround(c).cast("bigint"), F.lit(0)), F.lit(most - 1))
    placed = points.withColumn("_y", at("y", height)).withColumn("_x", at("x", width))
    once = pixels.groupBy(*keys, F.col("y").alias("_y"), F.col("x").alias("_x")).agg(F.max("v").alias("v"))
    return placed.join(once, [*keys, "_y", "_x"], "left").drop("_y", "_x")


def interior(points: DataFrame, margin: float, height: float, width: float) -> DataFrame:
    """Points farther than ``margin`` from every border; those exactly at it are left out."""
    return points.where((F.col("y") > margin) & (F.col("y") < height - margin) & (F.col("x") > margin) & (F.col("x") < width - margin))


def in_windows(points: DataFrame, windows: DataFrame, bin_size: int = 512, keys: Sequence[str] = ("img",)) -> DataFrame:
    """(keys, id, window_id): points inside windows (window_id, y0, x0, y1, x1), ends left out.

    Windows are laid out on bins, where they meet only points near them. They are never broadcast:
    Spark's estimate doesn't count the bins of a window, so that it holds them for far smaller than they are.
    """
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / bin_size).cast("bigint"), F.floor(F.col(b) / bin_size).cast("bigint"))
    laid = windows.where("y1 > y0 and x1 > x0").withColumn("_by", F.explode(bins("y0", "y1"))).withColumn("_bx", F.explode(bins("x0", "x1")))
    here = points.withColumn("_by", F.floor(F.col("y") / bin_size).cast("bigint")).withColumn("_bx", F.floor(F.col("x") / bin_size).cast("bigint"))
    met = here.select(*keys, "id", "x", "y", "_by", "_bx").join(laid.hint("merge"), [*keys, "_by", "_bx"])
    return met.where("y >= y0 and y < y1 and x >= x0 and x < x1").select(*keys, "id", "window_id")


def last_runs(blocks: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, first, last): the run of consecutive numbers that ends at the largest one.

    A resumed run goes on after ``last``; numbers before ``first`` have a gap after them.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(number))
    island = F.col(number) + F.row_number().over(order)
    runs = blocks.select(*keys, number).distinct().withColumn("_island", island)
    found = runs.groupBy(*keys, "_island").agg(F.min(number).alias("first"), F.max(number).alias("last"))
    return found.groupBy(*keys).agg(F.max_by(F.struct("first", "last"), "last").alias("r")).select(*keys, "r.first", "r.last")


def cell_tables(
    pixels: DataFrame, mask: DataFrame, factor: int, predict: Callable[[np.ndarray], np.ndarray], px_um: float, tile: int = 512, halo: int = 32, min_um2: float = 10.0, expand_px: int = 3
) -> tuple[DataFrame, DataFrame]:
    """(nuclei, cells): one row per kept nucleus, and per cell grown from it.

    Nuclei are predicted by tile, kept if their centroid lies on the mask and they are large
    enough, and numbered anew; cells are the nuclei with the background nearest to them. Both
    have img, cell_id, x_px, y_px, x_um, y_um and area; cells have the share of their nucleus too.
    """
    size = pixels.agg(F.max("y"), F.max("x")).first()
    height, width = int(size[0] or 0) + 1, int(size[1] or 0) + 1
    runs = checkpointed(L.spans(morph.predicted(pixels, tile, halo, predict)))
    inside = L.inside_mask(L.label_stats(runs), mask, float(factor), -(-height // factor), -(-width // factor))
    kept = L.relabelled(inside, F.col("n") * (px_um * px_um) >= min_um2)
    nuclei = checkpointed(runs.join(kept, ["img", "label"]).select("img", F.col("new_label").alias("label"), "y", "x0", "x1"))
    grown = L.spans(L.expanded(nuclei, expand_px, height, width))

    def described(spans: DataFrame, area: str) -> DataFrame:
        s = L.label_stats(spans)
        um = lambda c: F.round(F.col(c) * px_um, 6)
        return s.select("img", F.col("label").alias("cell_id"), F.col("cx").alias("x_px"), F.col("cy").alias("y_px"), um("cx").alias("x_um"), um("cy").alias("y_um"), F.round(F.col("n") * (px_um * px_um), 6).alias(area))

    small, large = described(nuclei, "nucleus_area_um2"), described(grown, "area_um2")
    share = F.round(F.col("nucleus_area_um2") / F.col("area_um2"), 6)
    return small, large.join(small.select("img", "cell_id", "nucleus_area_um2"), ["img", "cell_id"]).withColumn("nc_ratio", share)


def roi_tiles(labels: DataFrame, windows: DataFrame, tile: int) -> DataFrame:
    """(img, roi_id, ty, tx, size, data): each window's labels as compressed tiles, from its own corner (K8)."""
    runs = L.cropped(L.spans(labels), windows)
    corner = windows.select("img", "roi_id", F.col("y0").alias("_y0"), F.col("wx0").alias("_x0"))
    own = L.pixels_of(runs.select(F.struct("img", "roi_id").alias("img"), "label", "y", "x0", "x1"))
    moved = own.select("img.img", "img.roi_id", "label", "y", "x").join(corner, ["img", "roi_id"])
    key = F.concat_ws("\x1f", "img", "roi_id")
    placed = moved.select(key.alias("img"), (F.col("y") - F.col("_y0")).alias("y"), (F.col("x") - F.col("_x0")).alias("x"), "label")
    parts = F.split("img", "\x1f")
    return morph.dense_tiles(placed, tile).select(parts[0].alias("img"), parts[1].alias("roi_id"), "ty", "tx", "size", "data")
