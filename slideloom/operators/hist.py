"""Exact histograms, percentiles read from them, and display ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def bins_of(dtype: Column) -> Column:
    """The number of values of an image type; any type but uint8 and uint16 is an error (P20)."""
    known = F.when(dtype == "uint8", F.lit(256)).when(dtype == "uint16", F.lit(65_536))
    return F.coalesce(known, F.raise_error(F.concat(F.lit("no histogram for "), F.coalesce(dtype, F.lit("NULL")))).cast("int"))


def histogram(pixels: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """(keys, v, n): how often each value stands; partial counts are summed before the shuffle.

    NULL values are left out; histograms of parts may be added up by summing n.
    """
    return pixels.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n"))


def merged(*histograms: DataFrame) -> DataFrame:
    """The histogram of all parts together."""
    first, *rest = histograms
    for h in rest:
        first = first.unionByName(h)
    keys = [c for c in first.columns if c != "n"]
    return first.groupBy(*keys).agg(F.sum("n").alias("n"))


def name_of(q: float) -> str:
    return "p" + f"{q:g}".replace(".", "_")


def percentiles(hist: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(keys, p...): the smallest value whose share of all values up to it reaches q percent.

    Percentile 0 is the first bin even if nothing is in it. A key without rows has none.
    The window runs over the bins of one key, of which there are at most 65,536.
    """
    up_to = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    share = (F.sum("n").over(up_to) / F.sum("n").over(whole)).alias("share")
    shares = hist.select(*keys, "v", share)
    value = [F.min(F.when(F.col("share") >= q / 100.0, F.col("v"))) if q > 0 else F.min(F.lit(0)) for q in qs]
    return shares.groupBy(*keys).agg(*[v.cast("bigint").alias(name_of(q)) for v, q in zip(value, qs)])


def channel_stats(hist: DataFrame, keys: Sequence[str], bins: int = 65_536) -> DataFrame:
    """Per key: percentiles 1, 50, 99 and 99.9, the largest value, and shares of 0 and of the largest possible value."""
    total = F.sum("n")
    part = lambda v: 100.0 * F.sum(F.when(F.col("v") == v, F.col("n")).otherwise(0)) / total
    stats = hist.groupBy(*keys).agg(
        F.max("v").cast("bigint").alias("max"), F.round(part(0), 6).alias("pct_zero"), F.round(part(bins - 1), 6).alias("pct_saturated"), total.alias("n")
    )
    return stats.join(percentiles(hist, keys, (1, 50, 99, 99.9)), list(keys))


def plausibility(stats: DataFrame) -> DataFrame:
    """``stats`` with a column ``problem``: saturated beyond 0.1 %, or no spread between p1 and p99.9; NULL if none."""
    problem = F.concat_ws("; ", F.when(F.col("pct_saturated") > 0.1, "saturated"), F.when(F.col("p99_9") <= F.col("p1"), "no spread"))
    return stats.withColumn("problem", F.nullif(problem, F.lit("")))


def display_range(hist: DataFrame, keys: Sequence[str], low: float = 0.5, high: float = 99.9) -> DataFrame:
    """(keys, display_low, display_high): from the low percentile to the high one, at least 1 apart."""
    p = percentiles(hist, keys, (low, high))
    a, b = F.col(name_of(low)), F.col(name_of(high))
    return p.select(*keys, a.alias("display_low"), F.greatest(b, a + 1).alias("display_high"))


def pooled_display_range(hist: DataFrame, sample: str = "sample", marker: str = "marker", bins: str = "bins") -> DataFrame:
    """Display range per marker over all samples.

    Blank markers are left out. Of a marker with images of different depth only those of the
    depth of its first sample, in the order of names, are pooled.
    """
    named = hist.where(F.trim(marker) != "")
    depth = named.groupBy(marker).agg(F.min_by(bins, F.struct(sample, bins)).alias("_bins"))
    pooled = named.join(depth, marker).where(F.col(bins) == F.col("_bins")).groupBy(marker, "v").agg(F.sum("n").alias("n"))
    return display_range(pooled, [marker])


def normalised(value: Column, low: Column, high: Column, clip: bool = True, gamma: float = 1.0) -> Column:
    """(value - low) / (high - low), clipped to 0..1 and raised to ``gamma``; NULL for an empty range (P5)."""
    x = F.try_divide(value - low, high - low)
    x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))) if clip else x
    return x if gamma == 1.0 else F.pow(x, F.lit(gamma))


def composite(pixels: DataFrame, ranges: DataFrame, place: Sequence[str], channel: str = "c") -> DataFrame:
    """(place, value): the mean of the clipped, normalised values of all channels at a place."""
    joined = pixels.join(ranges, channel)
    value = normalised(F.col("v"), F.col("display_low"), F.col("display_high"))
    return joined.groupBy(*place).agg(F.round(F.avg(value), 6).alias("value"))


def downsampled(pixels: DataFrame, factor: int, height: int, width: int, keys: Sequence[str]) -> DataFrame:
    """(keys, by, bx, mean): block means; a ragged edge of the image is left out."""
    inside = (F.col("y") < height // factor * factor) & (F.col("x") < width // factor * factor)
    by, bx = F.floor(F.col("y") / factor).cast("bigint").alias("by"), F.floor(F.col("x") / factor).cast("bigint").alias("bx")
    return pixels.where(inside).groupBy(*keys, by, bx).agg(F.round(F.avg("v"), 6).alias("mean"))


def otsu(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, threshold): the value up to which the variance between both parts is largest.

    Values of 0 do not count; of equal variances the smallest value is taken. A key with
    fewer than two different values has no row.
    """
    used = hist.where("v > 0")
    up_to, whole = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    s = (F.col("v") * F.col("n")).cast("double")
    summed = used.select(
        *keys, "v", F.sum("n").over(up_to).cast("double").alias("w1"), F.sum(s).over(up_to).alias("s1"), F.sum("n").over(whole).cast("double").alias("w"), F.sum(s).over(whole).alias("s")
    ).where("w1 < w")
    apart = F.col("s1") / F.col("w1") - (F.col("s") - F.col("s1")) / (F.col("w") - F.col("w1"))
    between = F.round(F.col("w1") / F.col("w") * (1 - F.col("w1") / F.col("w")) * apart * apart, 3)
    return summed.withColumn("between", between).groupBy(*keys).agg(F.max_by("v", F.struct("between", -F.col("v"))).cast("bigint").alias("threshold"))
