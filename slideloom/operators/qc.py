"""Tile statistics, robust outliers and the rules that flag channels."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def robust_z(rows: DataFrame, keys: Sequence[str], value: str, name: str = "z") -> DataFrame:
    """``rows`` with (value - median) / (1.4826 * MAD) within its key.

    NULL and NaN values do not count and have a NULL score; where the MAD is 0 every score is 0.
    """
    number = F.when(~F.isnan(value), F.col(value))
    middle = rows.groupBy(*keys).agg(F.median(number).alias("_median"))
    dev = rows.join(middle, list(keys)) if keys else rows.crossJoin(F.broadcast(middle))  # one row where there is no key
    spread = dev.groupBy(*keys).agg(F.median(F.abs(number - F.col("_median"))).alias("_mad"))
    both = dev.join(spread, list(keys)) if keys else dev.crossJoin(F.broadcast(spread))
    z = F.when(number.isNull(), None).when(F.col("_mad") == 0, 0.0).otherwise((number - F.col("_median")) / (1.4826 * F.col("_mad")))
    return both.withColumn(name, F.round(z, 6)).drop("_median", "_mad")


def tile_values(pixels: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """(keys, ty, tx, n, median, p99_9): linear percentiles of each tile's values."""
    tile = [F.floor(F.col(c) / size).cast("bigint").alias(f"t{c}") for c in ("y", "x")]
    return pixels.groupBy(*keys, *tile).agg(
        F.count("*").alias("n"), F.median("v").alias("median"), F.percentile("v", F.lit(0.999)).alias("p99_9")
    )


def tile_kinds(mask: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """(keys, ty, tx, tissue_fraction, nodata_fraction, kind) from a mask (y, x, tissue, nodata).

    A tile is tissue from half tissue on, background with at most 2 % of both, else mixed.
    """
    tile = [F.floor(F.col(c) / size).cast("bigint").alias(f"t{c}") for c in ("y", "x")]
    share = lambda c: F.avg(F.col(c).cast("int"))
    t = mask.groupBy(*keys, *tile).agg(share("tissue").alias("tissue_fraction"), share("nodata").alias("nodata_fraction"))
    kind = F.when(F.col("tissue_fraction") >= 0.5, "tissue").when((F.col("tissue_fraction") <= 0.02) & (F.col("nodata_fraction") <= 0.02), "background")
    return t.withColumn("kind", kind.otherwise("mixed"))


def seams(tiles: DataFrame, keys: Sequence[str], value: str = "median", least: int = 10) -> DataFrame:
    """(keys, seam): how far background tiles are apart, p90 - p10; NULL of fewer than ten tiles."""
    spread = F.percentile(value, F.lit(0.9)) - F.percentile(value, F.lit(0.1))
    return tiles.groupBy(*keys).agg(F.when(F.count(value) >= least, F.round(spread, 6)).alias("seam"))


def channel_flags(zero_pct: float = 50.0) -> Column:
    """The flags of a channel with columns t50, t99, t99_9, b50, b99, zero, saturated and seam.

    NULL stands for the percentiles of an empty histogram: without background the first four
    rules do not hold, without tissue the seam is held against 2.
    """
    t50, t99, t999, b50, b99 = (F.col(c) for c in ("t50", "t99", "t99_9", "b50", "b99"))
    noise = F.when(b99.isNotNull() & b50.isNotNull(), F.greatest(b99 - b50, F.lit(1)))
    dead = F.coalesce(t999 <= b99 + noise, F.lit(False))
    ratio = F.when(b50.isNotNull(), t99 / F.greatest(b50, F.lit(1)))
    bright = (b50 >= 0.5 * F.when(t50.isNotNull(), F.greatest(t50, F.lit(1)))) & (b50 >= 0.1 * t99)
    flags = F.array(
        F.when(dead, "no usable signal"),
        F.when(~dead & (F.col("zero") > zero_pct) & (b99 <= 0), "many zeros in tissue"),
        F.when(~dead & bright, "bright off-tissue background"),
        F.when(~dead & (ratio < 2), "weak (p99 < 2x background)"),
        F.when(F.col("seam") > F.greatest(F.lit(2.0), 0.25 * F.greatest(t99 - t50, F.lit(1))), "uneven background (possible seams)"),
        F.when(F.col("saturated") > 0.1, "saturated >0.1%"),
    )
    return F.array_join(F.filter(flags, lambda x: x.isNotNull()), "; ")


def tile_flags(
    values: DataFrame, focus: DataFrame, kinds: DataFrame, tissue_top: DataFrame, nuclear: int, keys: Sequence[str], z_flag: float = 3.5, z_aggregate: float = 5.0
) -> DataFrame:
    """(keys, ty, tx, kind, focus_z, nuclear_z, flags, aggregate_channels) of tissue and background tiles.

    Scores are taken over the tissue tiles of an image: ``focus`` of the nuclear channel, its
    medians, and for each other channel the logarithm of p99_9; ``values`` come from
    :func:`tile_values`. A channel flags a tile where that score is above ``z_aggregate`` and
    its p99_9 above ``tissue_top`` (keys, c, top), that of the whole tissue.
    """
    tile = [*keys, "ty", "tx"]
    tissue = kinds.where("kind = 'tissue'").select(*tile)
    own = values.join(tissue, tile)
    nuclei = robust_z(own.where(F.col("c") == nuclear), keys, "median", "nuclear_z").select(*tile, "nuclear_z")
    sharp = robust_z(focus.join(tissue, tile, "left_semi"), keys, "focus", "focus_z").select(*tile, "focus_z")
    others = robust_z(own.where(F.col("c") != nuclear).withColumn("tail", F.log1p("p99_9")), [*keys, "c"], "tail", "aggregate_z").join(tissue_top, [*keys, "c"])
    hits = others.where((F.col("aggregate_z") > z_aggregate) & (F.col("p99_9") > F.col("top")))
    channels = hits_per_tile(hits, tile, name="c").withColumnRenamed("channels", "aggregate_channels")
    flags = F.array(F.when(F.col("focus_z") < -z_flag, "focus"), F.when(F.col("nuclear_z") > z_flag, "fold"))
    shown = kinds.where("kind <> 'mixed'").join(nuclei, tile, "left").join(sharp, tile, "left").join(channels, tile, "left")
    return shown.select(
        *tile, "kind", "focus_z", "nuclear_z", F.array_join(F.filter(flags, lambda x: x.isNotNull()), ";").alias("flags"), F.coalesce("aggregate_channels", F.lit("")).alias("aggregate_channels")
    )


def worst_tiles(tiles: DataFrame, columns: Sequence[str], order: Sequence[str], limit: int = 8) -> DataFrame:
    """The tiles with the largest absolute score in any column; ties go by ``order``."""
    severity = F.greatest(*[F.abs(c) for c in columns]) if len(columns) > 1 else F.abs(columns[0])
    return tiles.withColumn("severity", severity).orderBy(F.desc_nulls_last("severity"), *order).limit(limit)


def hits_per_tile(hits: DataFrame, keys: Sequence[str], channel: str = "c", name: str = "marker") -> DataFrame:
    """(keys, channels): the channels that flag a tile, joined in channel order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(channel).alias("at"), F.col(name).cast("string").alias("name")))), lambda s: s["name"])
    return hits.groupBy(*keys).agg(F.array_join(listed, ";").alias("channels"))


def nodata_pixels(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The places where every channel is exactly 0 (P9, before the size rule)."""
    return pixels.groupBy(*keys, "y", "x").agg(F.max("v").alias("_v")).where("_v = 0").drop("_v")


def analysis_mask(tissue: DataFrame, exclusions: DataFrame, flagged: DataFrame, keys: Sequence[str], bin_size: int = 64) -> DataFrame:
    """Tissue pixels outside exclusions and outside flagged rectangles, ends included (P10).

    Rectangles (y0, x0, y1, x1) are laid out on bins, so that the range test is an equi-join.
    """
    left = tissue.join(exclusions.select(*keys, "y", "x").distinct(), [*keys, "y", "x"], "left_anti")
    span = lambda a, b: F.sequence(F.floor(F.col(a) / bin_size).cast("bigint"), F.floor(F.col(b) / bin_size).cast("bigint"))
    boxes = flagged.withColumn("_by", F.explode(span("y0", "y1"))).withColumn("_bx", F.explode(span("x0", "x1")))
    here = left.withColumn("_by", F.floor(F.col("y") / bin_size).cast("bigint")).withColumn("_bx", F.floor(F.col("x") / bin_size).cast("bigint"))
    a, b = here.alias("a"), boxes.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_by", "_bx"]]
    inside = F.col("a.y").between(F.col("b.y0"), F.col("b.y1")) & F.col("a.x").between(F.col("b.x0"), F.col("b.x1"))
    return a.join(b, [*same, inside], "left_anti").drop("_by", "_bx")


def region_properties(pixels: DataFrame, keys: Sequence[str], px_um: float) -> DataFrame:
    """(keys, area_mm2, centroid_x_um, centroid_y_um, bbox_um): of each region's pixels, rounded half to even."""
    um = lambda c: F.bround(c * px_um).cast("bigint")
    return pixels.groupBy(*keys).agg(
        F.bround(F.count("*") * (px_um * px_um / 1e6), 4).alias("area_mm2"), F.bround(F.avg("x") * px_um, 1).alias("centroid_x_um"), F.bround(F.avg("y") * px_um, 1).alias("centroid_y_um"),
        F.array(um(F.min("y")), um(F.min("x")), um(F.max("y") + 1), um(F.max("x") + 1)).alias("bbox_um"),
    )


def smoothed(image: np.ndarray, sigma: float) -> np.ndarray:
    """A Gaussian of standard deviation ``sigma``, cut at four of them, the image carried on beyond its edges."""
    radius = int(4 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        pad = [(radius, radius) if a == axis else (0, 0) for a in (0, 1)]
        wide = np.pad(image, pad, mode="edge")
        image = sum(w * np.take(wide, range(k, k + image.shape[axis]), axis=axis) for k, w in enumerate(kernel))
    return image


def focus(image: np.ndarray, scale: float) -> float:
    """log10 of the variance of the Laplacian of the smoothed image over ``scale`` (A10)."""
    s = smoothed(image.astype(float) / scale, 1.0)
    e = np.pad(s, 1, mode="symmetric")
    lap = e[:-2, 1:-1] + e[2:, 1:-1] + e[1:-1, :-2] + e[1:-1, 2:] - 4 * s
    return math.log10(lap.var() + 1e-12)


def tile_focus(pixels: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """(keys, ty, tx, focus): the focus score of each tile; places without a pixel count as 0.

    The scale is the tile's own range from percentile 1 to 99, at least 1. A group is one tile
    of at most size x size pixels.
    """
    tile = [F.floor(F.col(c) / size).cast("bigint").alias(f"t{c}") for c in ("y", "x")]
    placed = pixels.groupBy(*keys, "y", "x").agg(F.max("v").alias("v")).select(*keys, *tile, "y", "x", "v")
    head = ", ".join(f"`{k}` {placed.schema[k].dataType.simpleString()}" for k in keys)

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((size, size))
        image[rows["y"] % size, rows["x"] % size] = rows["v"]
        low, high = np.percentile(image, [1, 99])
        out = rows[[*keys, "ty", "tx"]].head(1).copy()
        out["focus"] = round(focus(image, max(high - low, 1.0)), 6)
        return out

    return placed.groupBy(*keys, "ty", "tx").applyInPandas(score, f"{head}, ty bigint, tx bigint, focus double")
