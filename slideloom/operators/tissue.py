"""The tissue of an image: smoothed logarithm, Otsu's threshold, small pieces and small holes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from slideloom.operators.labels import holes, pixels_of, without_small
from slideloom.session import checkpointed

#: Bins between the least and the largest smoothed value for Otsu's threshold.
BINS = 256


def _along(values: DataFrame, line: str, axis: str, sigma: float, length: int) -> DataFrame:
    """``values`` (img, y, x, s) smoothed along an axis: a task holds one line of the reduced raster."""
    radius = int(4 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    kind = values.schema["img"].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = np.zeros(length)
        whole[rows[axis]] = rows["s"]
        wide = np.pad(whole, radius, mode="edge")
        out = pd.DataFrame({axis: np.arange(length), "s": sum(w * wide[k : k + length] for k, w in enumerate(kernel))})
        return out.assign(img=rows["img"].iloc[0], **{line: int(rows[line].iloc[0])})[["img", "y", "x", "s"]]

    return values.groupBy("img", line).applyInPandas(run, f"img {kind}, y bigint, x bigint, s double")


def smoothed(pixels: DataFrame, sigma: float, height: int, width: int) -> DataFrame:
    """(img, y, x, s): the logarithm of 1 + v under a Gaussian, the image carried on beyond its edges.

    Repeated places count with their largest value, missing ones with 0; an image without any
    pixel has no row.
    """
    inside = (F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width)
    once = pixels.where(inside & F.col("v").isNotNull()).groupBy("img", "y", "x").agg(F.log1p(F.max("v").cast("double")).alias("s"))
    return _along(_along(once, "y", "x", sigma, width), "x", "y", sigma, height)


def threshold(values: DataFrame) -> DataFrame:
    """(img, threshold): Otsu's over equal bins of the values (img, s); that of one value is the value."""
    ends = values.groupBy("img").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    wide = (F.col("hi") - F.col("lo")) / BINS
    bin_ = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("s") - F.col("lo")) / wide), F.lit(BINS - 1))).otherwise(0)
    counts = values.join(ends, "img").withColumn("bin", bin_).groupBy("img", "lo", "hi", "bin").agg(F.count("*").cast("double").alias("n"))
    counts = counts.withColumn("at", F.when(F.col("hi") > F.col("lo"), F.col("lo") + (F.col("bin") + 0.5) * wide).otherwise(F.col("lo")))
    up_to, whole = Window.partitionBy("img").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("img")
    s = F.col("n") * F.col("at")
    summed = counts.select(
        "img", "bin", "at", F.sum("n").over(up_to).alias("n1"), F.sum(s).over(up_to).alias("s1"), F.sum("n").over(whole).alias("n"), F.sum(s).over(whole).alias("s")
    )
    n2 = F.col("n") - F.col("n1")
    between = F.when(n2 > 0, F.col("n1") * n2 * (F.col("s1") / F.col("n1") - (F.col("s") - F.col("s1")) / n2) ** 2).otherwise(-1.0)
    return summed.groupBy("img").agg(F.max_by("at", F.struct(between, -F.col("bin"))).alias("threshold"))


def tissue_mask(pixels: DataFrame, sigma: float, small: int, small_holes: int, height: int, width: int) -> tuple[DataFrame, DataFrame]:
    """((img, y, x) of tissue, (img, threshold) in units of v) of a reduced nuclear channel (img, y, x, v).

    The threshold is taken over pixels above 0. Pieces of at most ``small`` pixels go, then
    holes of at most ``small_holes`` are filled; sides count as neighbours, corners do not.
    """
    values = checkpointed(smoothed(pixels, sigma, height, width))
    lit = pixels.where("v > 0").select("img", "y", "x").distinct()
    cut = checkpointed(threshold(values.join(lit, ["img", "y", "x"], "left_semi")))
    bright = values.join(cut, "img").where(F.col("s") > F.col("threshold")).select("img", "y", "x")
    pieces = checkpointed(pixels_of(without_small(bright, small + 1, diagonal=False)).select("img", "y", "x"))
    filled = holes(pieces, height, width, small_holes)
    return pieces.unionByName(filled.select("img", "y", "x")), cut.select("img", F.round(F.expm1("threshold"), 6).alias("threshold"))
