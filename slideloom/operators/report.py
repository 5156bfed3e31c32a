"""Checks, summaries and provenance of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Levels of a check, the gravest first.
LEVELS = ("fail", "warn", "info", "ok")


def ordered_checks(checks: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """``checks`` (keys, seq, level, text) with a position: gravest first, else as they were made (Q7)."""
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level"))
    return checks.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(rank, "seq")))


def check_summary(checks: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """(keys, fail, warn, info, ok, passed): checks per level, passed without a fail."""
    return checks.groupBy(*keys).agg(*[F.count_if(F.col("level") == x).alias(x) for x in LEVELS], (F.count_if(F.col("level") == "fail") == 0).alias("passed"))


def share_level(flagged: Column, all_: Column, most: float = 0.05) -> Column:
    """The level of a share of flagged tiles: ok of none, warn beyond ``most``, else info."""
    return F.when(flagged == 0, "ok").when(flagged > most * all_, "warn").otherwise("info")


def counts(rows: DataFrame, *columns: str) -> DataFrame:
    """(columns, n): rows per combination."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def head(rows: DataFrame, order: Sequence[Column | str], most: int = 200) -> tuple[DataFrame, int]:
    """The first rows in order, and how many more there are (Q8)."""
    return rows.orderBy(*order).limit(most), max(0, rows.count() - most)


def hashed_sample(rows: DataFrame, key: str, share: float, least: int, seed: int = 0) -> DataFrame:
    """Rows whose key's hash falls below a share, but about ``least`` of them at least (Q1, Q5).

    The choice depends on seed and key only, so it does not change with the partitions.
    """
    n = rows.count()
    part = 1.0 if n == 0 else min(1.0, max(share, least / n))
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) < int(part * 1_000_000))


def method_summary(cells: DataFrame, keys: Sequence[str], area: str, ratio: str | None = None) -> DataFrame:
    """Per method: number, median and quartiles of the area, equivalent diameter, median ratio."""
    q = lambda p: F.round(F.percentile(area, F.lit(p)), 6)
    more = [F.round(F.median(ratio), 6).alias("median_ratio")] if ratio else []
    return cells.groupBy(*keys).agg(
        F.count("*").alias("n"), q(0.5).alias("median_area"), q(0.25).alias("p25"), q(0.75).alias("p75"),
        F.round(2 * F.sqrt(F.median(area) / F.pi()), 6).alias("diameter"), *more,
    )


def density(cells: DataFrame, regions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, area_mm2, per_mm2): cells per region; a region without a known area has no density."""
    n = cells.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.join(regions, list(keys), "left").select(*keys, "n", "area_mm2", F.round(F.try_divide(F.col("n"), F.col("area_mm2")), 6).alias("per_mm2"))


def aligned_ratio(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, a, b, ratio) of two tables by key, NULL where one lacks it."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), list(keys), "full")
    return both.select(*keys, "a", "b", F.round(F.try_divide(F.col("a"), F.col("b")), 6).alias("ratio"))


def match_summary(matches: DataFrame, areas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, median_d, median_ratio, within_quarter): matches with area and reference area."""
    ratio = F.try_divide(F.col("area"), F.col("ref_area"))
    joined = matches.join(areas, [*keys, "ours"]).withColumn("_ratio", ratio)
    return joined.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.median("d"), 6).alias("median_d"), F.round(F.median("_ratio"), 6).alias("median_ratio"),
        F.round(F.avg((F.abs(F.col("_ratio") - 1) <= 0.25).cast("int")), 6).alias("within_quarter"),
    )


def misses(matches: DataFrame, keys: Sequence[str], full: int = 65_535) -> DataFrame:
    """(keys, found, n, median_value, pct_saturated, median_neighbours): found and missed references apart."""
    return matches.groupBy(*keys, "found").agg(
        F.count("*").alias("n"), F.median("value").alias("median_value"), F.round(100 * F.avg((F.col("value") >= full).cast("int")), 6).alias("pct_saturated"),
        F.median("neighbours").alias("median_neighbours"),
    )


def weighted(rows: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """(keys, value): the mean by weight; NULL where the weights add up to nothing."""
    total = F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))
    return rows.groupBy(*keys).agg(F.round(total, 6).alias(value))


def provenance(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_rows, fingerprint): a sum over row hashes, the same in any order of rows."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]))).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum(row).cast("string").alias("fingerprint"))
