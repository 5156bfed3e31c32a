"""Regions of interest: tiles, strata, capped allocation, holdout, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def tile_grid(images: DataFrame, size: int, whole_only: bool) -> DataFrame:
    """(img, y0, x0, y1, x1): tiles of each image (img, h, w); at the edge cut off, or left out with ``whole_only``."""
    last = (lambda c: F.col(c) - size) if whole_only else (lambda c: F.col(c) - 1)
    start = lambda c: F.explode(F.when(last(c) >= 0, F.sequence(F.lit(0), last(c).cast("int"), F.lit(size))).otherwise(F.array().cast("array<int>")))
    grid = images.withColumn("y0", start("h")).withColumn("x0", start("w"))
    return grid.select("img", "y0", "x0", F.least(F.col("y0") + size, F.col("h")).cast("int").alias("y1"), F.least(F.col("x0") + size, F.col("w")).cast("int").alias("x1"))


def tile_cells(cells: DataFrame, size: float, keys: Sequence[str]) -> DataFrame:
    """(keys, y0, x0, n_cells, occupancy): cells per tile and share of its 10 x 10 squares with a cell."""
    t = lambda c: F.floor(F.col(c) / size).cast("bigint")
    part = lambda c: F.least(F.floor((F.col(c) - F.floor(F.col(c) / size) * size) / size * 10), F.lit(9)).cast("int")
    placed = cells.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    placed = placed.select(*keys, (t("y") * int(size)).alias("y0"), (t("x") * int(size)).alias("x0"), (part("y") * 10 + part("x")).alias("_s"))
    squares = placed.groupBy(*keys, "y0", "x0", "_s").agg(F.count("*").alias("n"))  # before tiles meet: at most 100 rows each
    return squares.groupBy(*keys, "y0", "x0").agg(F.sum("n").alias("n_cells"), (F.count("*") / 100.0).alias("occupancy"))


def region_shares(cells: DataFrame, keys: Sequence[str], region: str = "region") -> DataFrame:
    """(keys, region, share): share of each region among the cells of a tile."""
    counts = cells.groupBy(*keys, region).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.select(*keys, region, F.round(F.col("n") / total, 6).alias("share"))


def strata(shares: DataFrame, keys: Sequence[str], focus: str, interface_min: float = 0.25) -> DataFrame:
    """(keys, stratum): ``interface`` where focus and the rest both reach interface_min, else the largest region.

    Equal shares go to the region first by name.
    """
    f = F.coalesce(F.max(F.when(F.col("region") == focus, F.col("share"))), F.lit(0.0))
    top = F.min_by("region", F.struct((-F.col("share")).alias("s"), "region"))
    stratum = F.when((f > 0) & (F.least(f, 1 - f) >= interface_min), "interface").otherwise(top)
    return shares.groupBy(*keys).agg(stratum.alias("stratum"))


def eligible(tiles: DataFrame, min_occupancy: float = 0.6, min_cells: int = 300, exclude_max: float = 0.05) -> DataFrame:
    """Tiles with enough cells and occupancy and little excluded area."""
    excluded = F.coalesce(F.col("excluded"), F.lit(0.0)) if "excluded" in tiles.columns else F.lit(0.0)
    return tiles.where((F.col("occupancy") >= min_occupancy) & (F.col("n_cells") >= min_cells) & (excluded <= exclude_max))


def wanted_number(tiles: DataFrame, keys: Sequence[str], target_cells: int) -> DataFrame:
    """(keys, wanted): how many ROIs hold the target, at the median number of cells; at least one (Q3)."""
    return tiles.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.lit(float(target_cells)) / F.median("n_cells"))).cast("bigint").alias("wanted"))


def allocated(tiles: DataFrame, keys: Sequence[str], order: Sequence[Column | str], wanted: DataFrame) -> DataFrame:
    """The tiles dealt one at a time to the stratum with fewest so far, by name, until ``wanted`` (Q2).

    ``order`` stands for the random order within a stratum. The n-th tile of each stratum comes
    before any stratum's next one, which gives the same in closed form.
    """
    nth = F.row_number().over(Window.partitionBy(*keys, "stratum").orderBy(*order))
    dealt = F.row_number().over(Window.partitionBy(*keys).orderBy("_k", "stratum"))
    return tiles.withColumn("_k", nth).join(wanted, list(keys)).withColumn("_g", dealt).where("_g <= wanted").drop("_k", "_g", "wanted")


def with_roles(chosen: DataFrame, keys: Sequence[str], order: Sequence[Column | str], share: float) -> DataFrame:
    """``chosen`` with role validation or train: a share of each stratum, rounded half to even (Q4).

    A stratum of three or more gets at least one for validation, if the share is not 0.
    """
    n = F.count("*").over(Window.partitionBy(*keys, "stratum"))
    rounded = F.bround(n * F.lit(share)).cast("int")
    held = F.when((rounded == 0) & (n >= 3) & F.lit(share > 0), 1).otherwise(rounded)
    nth = F.row_number().over(Window.partitionBy(*keys, "stratum").orderBy(*order))
    return chosen.withColumn("role", F.when(nth <= held, "validation").otherwise("train"))


def named(chosen: DataFrame, sample: str) -> DataFrame:
    """``chosen`` with roi_id: sample, ``_R`` and the number in reading order, of two digits or more."""
    nth = F.row_number().over(Window.partitionBy(sample).orderBy("y0", "x0")).cast("string")
    return chosen.withColumn("roi_id", F.concat(sample, F.lit("_R"), F.lpad(nth, F.greatest(F.lit(2), F.length(nth)), F.lit("0"))))


def cross_tab(chosen: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, stratum, train, validation): ROIs per stratum and role."""
    count = lambda r: F.sum(F.when(F.col("role") == r, 1).otherwise(0)).alias(r)
    return chosen.groupBy(*keys, "stratum").agg(count("train"), count("validation"))


# Colours of roles in exported outlines.
COLOURS = {"train": (0, 160, 80), "validation": (200, 60, 0)}


def geojson(chosen: DataFrame, sample: str) -> DataFrame:
    """(sample, geojson): a feature collection per sample, closed rings of five points, a colour per role (K5)."""
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    colour = F.when(F.col("role") == "validation", F.array(*map(F.lit, COLOURS["validation"]))).otherwise(F.array(*map(F.lit, COLOURS["train"])))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(F.lit("annotation").alias("objectType"), F.col("roi_id").alias("name"), F.struct(F.col("role").alias("name"), colour.alias("color")).alias("classification")).alias("properties"),
    )
    features = F.array_sort(F.collect_list(F.struct("roi_id", feature.alias("f"))))
    collected = chosen.groupBy(sample).agg(F.transform(features, lambda x: x["f"]).alias("features"))
    return collected.select(sample, F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("geojson"))


def upserted(old: DataFrame, new: DataFrame, proposed: DataFrame, sample: str = "sample_id", roi: str = "roi_id") -> DataFrame:
    """The table of ROIs after a run: rows of the run's samples are replaced (K7).

    Of a sample of this run, an old row stays only if its ROI is still proposed and was not
    made anew; rows of other samples stay. Running the same twice changes nothing more.
    """
    samples = new.select(sample).unionByName(proposed.select(sample)).distinct()
    others = old.join(samples, sample, "left_anti")
    kept = old.join(samples, sample, "left_semi").join(proposed.select(sample, roi).distinct(), [sample, roi], "left_semi").join(new.select(sample, roi), [sample, roi], "left_anti")
    return others.unionByName(kept).unionByName(new)


def stale(old: DataFrame, proposed: DataFrame, sample: str = "sample_id", roi: str = "roi_id") -> DataFrame:
    """Old ROIs of proposed samples that are no longer proposed (K7)."""
    return old.join(proposed.select(sample).distinct(), sample, "left_semi").join(proposed.select(sample, roi), [sample, roi], "left_anti")
