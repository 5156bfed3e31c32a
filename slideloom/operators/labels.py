"""Label rasters as spans: statistics, overlap, borders, growth and folding.

A span is a run of one label in one row: (img, label, y, x0, x1), x1 left out. Background is
label 0 and is dropped first. (D2, A7, A23, J6, J7, J9, J10, J23, J24, P7, P8, P14, R2-R5, B7)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from slideloom.operators.graph import components
from slideloom.operators.morph import by_tile, nearest_labels
from slideloom.session import checkpointed

#: Width of the bins on which spans of a row meet.
BIN = 256
#: Side of the tiles in which spans are joined to pieces by one task.
TILE = 512


def spans(pixels: DataFrame, label: str = "label") -> DataFrame:
    """The spans of labelled pixels (img, y, x, label); repeated pixels count once."""
    once = pixels.where(F.col(label) != 0).select("img", F.col(label).alias("label"), "y", "x").distinct()
    run = F.col("x") - F.row_number().over(Window.partitionBy("img", "label", "y").orderBy("x"))
    return once.withColumn("_run", run).groupBy("img", "label", "y", "_run").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")).drop("_run")


def pixels_of(runs: DataFrame) -> DataFrame:
    """(img, label, y, x): the pixels of spans."""
    return runs.select("img", "label", "y", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"))


def label_stats(runs: DataFrame) -> DataFrame:
    """(img, label, n, cx, cy): pixels and centroid of each label."""
    n = F.col("x1") - F.col("x0")
    return runs.groupBy("img", "label").agg(
        F.sum(n).alias("n"), F.round(F.sum((F.col("x0") + F.col("x1") - 1) * n / 2.0) / F.sum(n), 6).alias("cx"), F.round(F.sum(F.col("y") * n) / F.sum(n), 6).alias("cy")
    )


def _binned(runs: DataFrame) -> DataFrame:
    bins = F.sequence(F.floor(F.col("x0") / BIN).cast("bigint"), F.floor((F.col("x1") - 1) / BIN).cast("bigint"))
    return runs.withColumn("bin", F.explode(bins))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(img, a, b, n): the pixels that labels of two rasters share.

    Spans meet on (row, bin of columns), so that a long row is not compared all with all; a
    pair that meets on several bins counts where its overlap begins.
    """
    p = _binned(a).select("img", "y", "bin", F.col("label").alias("a"), F.col("x0").alias("ax0"), F.col("x1").alias("ax1"))
    q = _binned(b).select("img", "y", "bin", F.col("label").alias("b"), F.col("x0").alias("bx0"), F.col("x1").alias("bx1"))
    begin, end = F.greatest("ax0", "bx0"), F.least("ax1", "bx1")
    met = p.join(q, ["img", "y", "bin"]).where((begin < end) & (F.floor(begin / BIN).cast("bigint") == F.col("bin")))
    return met.groupBy("img", "a", "b").agg(F.sum(end - begin).alias("n"))


def iou(a: DataFrame, b: DataFrame) -> DataFrame:
    """(img, a, b, n, iou): intersection over union of every pair of labels that overlap."""
    size = lambda runs, k: label_stats(runs).select("img", F.col("label").alias(k), F.col("n").alias(f"n_{k}"))
    shared = overlap(a, b).join(size(a, "a"), ["img", "a"]).join(size(b, "b"), ["img", "b"])
    return shared.select("img", "a", "b", "n", F.round(F.col("n") / (F.col("n_a") + F.col("n_b") - F.col("n")), 6).alias("iou"))


def drop_border(runs: DataFrame, y0: int, x0: int, y1: int, x1: int) -> DataFrame:
    """The spans of labels that touch no border of the window [y0, y1) x [x0, x1)."""
    touch = (F.col("y") == y0) | (F.col("y") == y1 - 1) | (F.col("x0") <= x0) | (F.col("x1") >= x1)
    return runs.join(runs.where(touch).select("img", "label").distinct(), ["img", "label"], "left_anti")


def relabelled(stats: DataFrame, keep: Column) -> DataFrame:
    """(img, label, new_label): kept labels numbered from 1 in order, within each image."""
    return stats.where(keep).select("img", "label", F.row_number().over(Window.partitionBy("img").orderBy("label")).alias("new_label"))


def inside_mask(stats: DataFrame, mask: DataFrame, factor: float, height: int, width: int) -> DataFrame:
    """Labels whose centroid lies on a pixel of a reduced mask (img, my, mx)."""
    at = lambda c, most: F.least(F.greatest(F.floor(F.col(c) / F.lit(factor)), F.lit(0)), F.lit(most - 1)).cast("bigint")
    here = stats.withColumn("my", at("cy", height)).withColumn("mx", at("cx", width))
    return here.join(mask.select("img", "my", "mx").distinct(), ["img", "my", "mx"], "left_semi").drop("my", "mx")


def owned(stats: DataFrame, block: int) -> DataFrame:
    """Objects found in several overlapping blocks (by, bx), each kept from the block that holds its centroid."""
    return stats.where((F.floor(F.col("cy") / block) == F.col("by")) & (F.floor(F.col("cx") / block) == F.col("bx")))


def cropped(runs: DataFrame, windows: DataFrame) -> DataFrame:
    """(img, roi_id, label, y, x0, x1): spans cut to each window (y0, wx0, y1, wx1), ends left out.

    Windows are laid out on bins of rows, so that spans meet only windows near them.
    """
    rows = F.sequence(F.floor(F.col("y0") / BIN).cast("bigint"), F.floor((F.col("y1") - 1) / BIN).cast("bigint"))
    near = windows.where("y1 > y0 and wx1 > wx0").withColumn("bin", F.explode(rows))
    joined = runs.withColumn("bin", F.floor(F.col("y") / BIN).cast("bigint")).join(near, ["img", "bin"])
    met = joined.where("y >= y0 and y < y1 and x0 < wx1 and x1 > wx0")
    return met.select("img", "roi_id", "label", "y", F.greatest("x0", "wx0").alias("x0"), F.least("x1", "wx1").alias("x1"))


def cut_labels(runs: DataFrame, windows: DataFrame) -> DataFrame:
    """(img, roi_id, label, n_crop, n_whole): labels that a window holds only in part."""
    n = F.sum(F.col("x1") - F.col("x0"))
    crop = cropped(runs, windows).groupBy("img", "roi_id", "label").agg(n.alias("n_crop"))
    return crop.join(runs.groupBy("img", "label").agg(n.alias("n_whole")), ["img", "label"]).where("n_crop < n_whole")


def merged_runs(runs: DataFrame) -> DataFrame:
    """Spans of the same label and row that touch or overlap made one."""
    w = Window.partitionBy("img", "label", "y").orderBy("x0", "x1")
    before = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("x0") > before), 1).otherwise(0)
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = runs.withColumn("_new", new).withColumn("_island", island)
    return marked.groupBy("img", "label", "y", "_island").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_island")


def dilated(runs: DataFrame, radius: int, height: int, width: int) -> DataFrame:
    """Every label grown by a diamond of ``radius`` within the image; labels may then overlap."""
    grown = runs.withColumn("_dy", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
    wide = F.lit(radius) - F.abs("_dy")
    out = grown.select(
        "img", "label", (F.col("y") + F.col("_dy")).alias("y"), F.greatest(F.col("x0") - wide, F.lit(0)).alias("x0"), F.least(F.col("x1") + wide, F.lit(width)).alias("x1")
    )
    return merged_runs(out.where((F.col("y") >= 0) & (F.col("y") < height)))


def expanded(runs: DataFrame, distance: int, height: int, width: int, tile: int = 512) -> DataFrame:
    """(img, y, x, label): labels with the background at most ``distance`` from them, nearest first.

    Pixels as far from several labels go to the smallest one; labelled pixels keep theirs. A task
    grows the labels of one tile and of the halo around it.
    """
    pixels = pixels_of(runs).select("img", "y", "x", "label")
    grown = by_tile(pixels, tile, distance, ["label"], lambda a: nearest_labels(a, distance), unique=True)
    return grown.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width)).select("img", "y", "x", "label")


def foreground_components(mask: DataFrame, diagonal: bool = True) -> DataFrame:
    """(img, y, x0, x1, label): connected pieces of a mask (img, y, x), numbered by first pixel (R2)."""
    return span_components(spans(mask.withColumn("label", F.lit(1))), diagonal)


def span_components(runs: DataFrame, diagonal: bool = True) -> DataFrame:
    """(img, y, x0, x1, label): connected pieces of the spans of a mask, numbered by first pixel (R2)."""
    return _numbered(span_pieces(runs, diagonal)).select("img", "y", "x0", "x1", "label")


def _numbered(rooted: DataFrame) -> DataFrame:
    """The spans of ``span_pieces`` with a label, their pieces' number within the image."""
    order = rooted.select("root", F.col("root.img").alias("img")).distinct()
    order = order.withColumn("label", F.row_number().over(Window.partitionBy("img").orderBy("root"))).drop("img")
    return rooted.join(order, "root")


def span_pieces(runs: DataFrame, diagonal: bool = True) -> DataFrame:
    """(img, y, x0, x1, root, size): the spans of a mask with the first place and the pixels of their connected piece.

    With ``diagonal`` corners touch too. Spans are cut at tiles and joined within each tile by one
    task, which also adds up their pixels; only the groups that touch over a tile's border go on as
    a graph, so that rounds of joins depend on tiles, not on how far pieces wind within them.
    """
    kind = runs.schema["img"].dataType.simpleString()
    tile_of = lambda c: F.floor(F.col(c) / TILE).cast("bigint")
    cut = runs.select("img", *[F.col(c).cast("bigint").alias(c) for c in ("y", "x0", "x1")]).withColumn("ty", tile_of("y"))
    cut = cut.withColumn("tx", F.explode(F.sequence(tile_of("x0"), F.floor((F.col("x1") - 1) / TILE).cast("bigint"))))
    cut = cut.withColumn("p0", F.greatest("x0", F.col("tx") * TILE)).withColumn("p1", F.least("x1", (F.col("tx") + 1) * TILE))

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["y", "p0"], ignore_index=True)
        y, p0, p1 = (rows[c].to_numpy() for c in ("y", "p0", "p1"))
        root = touching(y, p0, p1, diagonal)
        n = np.zeros(len(root), np.int64)
        np.add.at(n, root, p1 - p0)
        return rows[["img", "y", "x0", "x1", "p0", "p1"]].assign(ry=y[root], rx=p0[root], n=n[root])

    found = cut.groupBy("img", "ty", "tx").applyInPandas(joined, f"img {kind}, y bigint, x0 bigint, x1 bigint, p0 bigint, p1 bigint, ry bigint, rx bigint, n bigint")
    # A group is named by its first place, which is the start of a span or of a part of one.
    parts = checkpointed(found.select("img", "y", "x0", "x1", "p0", "p1", F.struct("img", F.col("ry").alias("y"), F.col("rx").alias("x0")).alias("own"), "n"))
    links = checkpointed(_over_borders(parts, diagonal))
    whole = parts.where("p0 = x0")
    if links.isEmpty():
        return whole.select("img", "y", "x0", "x1", F.col("own").alias("root"), F.col("n").alias("size"))
    nodes = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    merged = components(nodes, links).withColumnRenamed("id", "own")
    sizes = parts.where("y = own.y and p0 = own.x0").join(merged, "own").groupBy("root").agg(F.sum("n").alias("size"))
    merged = checkpointed(merged.join(sizes, "root"))
    return whole.join(merged, "own", "left").select("img", "y", "x0", "x1", F.coalesce("root", "own").alias("root"), F.coalesce("size", "n").alias("size"))


def touching(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, diagonal: bool) -> np.ndarray:
    """The first span that each of one tile's spans is connected with; spans are sorted by row and start, and don't overlap."""
    wide = int(diagonal)
    x0, x1 = x0 - x0.min() + 1, x1 - x0.min() + 1
    row = (y - y.min()) * (x1.max() + 2)
    below = row + x1.max() + 2
    first = np.searchsorted(row + x1, below + x0 - wide, side="right")
    n = np.maximum(np.searchsorted(row + x0, below + x1 + wide, side="left") - first, 0)
    a = np.repeat(np.arange(len(y)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    root = np.arange(len(y))
    while True:  # roots with a smaller neighbour take the smallest, and paths are shortened to their end
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (further := root[root]).tolist() != root.tolist():
            root = further


def _over_borders(parts: DataFrame, diagonal: bool) -> DataFrame:
    """(a, b): groups of different tiles that touch, found from the pixels along the tiles' borders."""
    first, last = F.pmod("p0", F.lit(TILE)) == 0, F.pmod("p1", F.lit(TILE)) == 0
    along = F.pmod("y", F.lit(TILE)).isin(0, TILE - 1)
    none = F.array().cast("array<bigint>")
    ends = F.concat(F.when(first, F.array("p0")).otherwise(none), F.when(last, F.array(F.col("p1") - 1)).otherwise(none))
    rim = parts.select("img", "y", F.explode(F.when(along, F.sequence("p0", F.col("p1") - 1)).otherwise(ends)).alias("x"), "own")
    steps = [(0, 1), (1, 0)] + [(1, 1), (1, -1)] * diagonal
    to = rim.withColumn("_step", F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])))
    to = to.select("img", (F.col("y") + F.col("_step.dy")).alias("y"), (F.col("x") + F.col("_step.dx")).alias("x"), F.col("own").alias("a"), F.col("y").alias("_y"), F.col("x").alias("_x"))
    other = " or ".join(f"floor({c} / {TILE}) <> floor(_{c} / {TILE})" for c in ("y", "x"))
    return to.where(other).join(rim.withColumnRenamed("own", "b"), ["img", "y", "x"]).select("a", "b").distinct()


def background(runs: DataFrame, height: int, width: int) -> DataFrame:
    """The spans between the spans of images of one size, rows without any included."""
    rows = runs.select("img").distinct().withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("y", F.col("y").cast("bigint"))
    order = Window.partitionBy("img", "y").orderBy("x0")
    until = F.coalesce(F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The end of a row closes its last gap.
    ends = rows.select("img", "y", F.lit(width).cast("bigint").alias("x0"), F.lit(width).cast("bigint").alias("x1"))
    gaps = runs.select("img", "y", F.col("x0").cast("bigint").alias("x0"), F.col("x1").cast("bigint").alias("x1")).unionByName(ends)
    return gaps.select("img", "y", until.alias("_from"), F.col("x0").alias("_to")).where("_from < _to").select("img", F.lit(1).alias("label"), "y", F.col("_from").alias("x0"), F.col("_to").alias("x1"))


def without_small(mask: DataFrame, least: int, diagonal: bool = True) -> DataFrame:
    """The spans of pieces of at least ``least`` pixels."""
    pieces = span_pieces(spans(mask.withColumn("label", F.lit(1))), diagonal)
    return _numbered(pieces).where(F.col("size") >= least).select("img", "label", "y", "x0", "x1")


def holes(mask: DataFrame, height: int, width: int, most: int) -> DataFrame:
    """(img, y, x): pixels of holes of at most ``most`` pixels: background pieces off the border."""
    pieces = checkpointed(span_components(background(spans(mask.withColumn("label", F.lit(1))), height, width), diagonal=False))
    edge = (F.col("y") == 0) | (F.col("y") == height - 1) | (F.col("x0") == 0) | (F.col("x1") == width)
    size = pieces.groupBy("img", "label").agg(F.sum(F.col("x1") - F.col("x0")).alias("n"), F.max(edge).alias("edge"))
    small = size.where((F.col("n") <= most) & ~F.col("edge"))
    return pixels_of(pieces.join(small.select("img", "label"), ["img", "label"], "left_semi")).select("img", "y", "x")


def folded(runs: DataFrame, radius: int, threshold: float, height: int, width: int) -> DataFrame:
    """(img, label, root): labels mostly inside another one's dilation, folded into it, chains to the end.

    The best holder of a label is the one with the largest share of it, then the largest, then
    the smallest by number; only a share of at least ``threshold`` counts. Labels fold only into
    larger ones, or equally large ones of smaller number.
    """
    n = lambda k: label_stats(runs).select("img", F.col("label").alias(k), F.col("n").alias(f"n_{k}"))
    held = overlap(runs, dilated(runs, radius, height, width)).where("a <> b").join(n("a"), ["img", "a"]).join(n("b"), ["img", "b"])
    upwards = (F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a")))
    best = held.withColumn("share", F.col("n") / F.col("n_a")).where((F.col("share") >= threshold) & upwards)
    best = best.groupBy("img", "a").agg(F.max_by("b", F.struct("share", "n_b", -F.col("b"))).alias("to"))
    roots = checkpointed(runs.select("img", "label").distinct().join(best.withColumnRenamed("a", "label"), ["img", "label"], "left").select("img", "label", F.coalesce("to", "label").alias("root")))
    while True:  # pointers double: a chain of n labels ends after log2 n rounds
        up = roots.select("img", F.col("label").alias("root"), F.col("root").alias("further"))
        next_ = checkpointed(roots.join(up, ["img", "root"]).select("img", "label", "further", (F.col("root") != F.col("further")).alias("moved")))
        roots = next_.select("img", "label", F.col("further").alias("root"))
        if next_.where("moved").isEmpty():
            break
    return roots


def raster_check(labels: DataFrame) -> DataFrame:
    """(img, n_pixels, n_labels, has_background): what a label raster holds."""
    return labels.groupBy("img").agg(
        F.count("*").alias("n_pixels"), F.countDistinct(F.when(F.col("label") != 0, F.col("label"))).alias("n_labels"), F.max(F.col("label") == 0).alias("has_background")
    )
