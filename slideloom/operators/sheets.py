"""Sheets: validation, channel matching, marker maps, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from slideloom.functions.text import clean_name, has_space, normal_name, strip
from slideloom.operators.strict_load import FORBIDDEN_IN_ID, ROLES, SPECIES

# Fixed values of the sheets' enumerations.
SEGMENTATION = ("nuclear", "membrane", "")
STATUS = ("ok", "failed", "unconfirmed")
PIXEL_UM = (0.05, 5.0)


def _text(name: str) -> Column:
    return F.coalesce(strip(F.col(name)), F.lit(""))


def tidy_panel(rows: DataFrame) -> DataFrame:
    """A panel sheet with trimmed fields, enumerations in lower case, blank status as ok."""
    columns = {c: _text(c) for c in ("marker", "aliases", "notes") if c in rows.columns}
    columns |= {c: F.lower(_text(c)) for c in ("role", "segmentation") if c in rows.columns}
    tidy = rows.withColumns(columns)
    status = F.lower(_text("status")) if "status" in rows.columns else F.lit("")
    return tidy.withColumn("status", F.when(status == "", "ok").otherwise(status))


def _problems(rows: DataFrame, key: Sequence[str], tests: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per test that holds; a test of NULL does not hold."""
    found = F.filter(F.array(*[F.when(t, F.lit(name)) for name, t in tests]), lambda x: x.isNotNull())
    return rows.select(*key, F.explode(found).alias("problem"))


def panel_problems(rows: DataFrame, key: str, sheet: str) -> DataFrame:
    """(key, sheet, problem): every violation of every row of panel sheets, all at once.

    Markers that are equal after normalisation are duplicates within their sheet.
    """
    tidy = tidy_panel(rows).withColumn("_norm", normal_name(F.col("marker")))
    counts = tidy.where("_norm <> ''").groupBy(sheet, "_norm").agg(F.count("*").alias("_n"))
    joined = tidy.join(counts, [sheet, "_norm"], "left")
    return _problems(joined, [key, sheet], [
        ("marker is empty", F.col("marker") == ""), ("unknown role", ~F.col("role").isin(*ROLES)),
        ("unknown segmentation", ~F.col("segmentation").isin(*SEGMENTATION)), ("unknown status", ~F.col("status").isin(*STATUS)),
        ("duplicate marker", F.col("_n") > 1),
    ])


def panels_without_nucleus(rows: DataFrame, sheet: str) -> DataFrame:
    """Sheets that have no channel for nuclei that is usable."""
    usable = (F.col("segmentation") == "nuclear") & (F.col("status") == "ok")
    return tidy_panel(rows).groupBy(sheet).agg(F.max(usable).alias("_any")).where("not _any").select(sheet)


def sample_problems(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, problem): every violation of every row of a samples sheet.

    A pixel size may be blank; else it is a number from 0.05 to 5. Sample ids are unique.
    """
    tidy = rows.withColumns({c: _text(c) for c in ("sample_id", "image", "species", "panel", "pixel_size_um")})
    counts = tidy.where("sample_id <> ''").groupBy("sample_id").agg(F.count("*").alias("_n"))
    size = F.col("pixel_size_um").try_cast("double")
    sized = F.coalesce(size.between(*PIXEL_UM), F.lit(False))
    return _problems(tidy.join(counts, "sample_id", "left"), key, [
        ("sample_id is empty", F.col("sample_id") == ""), ("sample_id holds space or path signs", has_space(F.col("sample_id")) | F.col("sample_id").rlike(FORBIDDEN_IN_ID)),
        ("image is empty", F.col("image") == ""), ("panel is empty", F.col("panel") == ""), ("unknown species", ~F.lower("species").isin(*SPECIES)),
        ("bad pixel size", (F.col("pixel_size_um") != "") & ~sized), ("duplicate sample_id", F.col("_n") > 1),
    ])


def selected(samples: DataFrame, wanted: DataFrame) -> DataFrame:
    """The samples whose sample_id is wanted (S3)."""
    return samples.join(wanted.select("sample_id").distinct(), "sample_id", "left_semi")


def unknown(samples: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted ids that no sample has; a caller stops if there are any (S3)."""
    return wanted.select("sample_id").distinct().join(samples, "sample_id", "left_anti")


def names_of(panel: DataFrame, row: str = "row") -> DataFrame:
    """(norm, marker, how): what each normalised name or alias means; the first row that has it wins.

    An earlier row's alias comes before a later row's marker; within a row the marker comes first.
    """
    marker = F.array(F.struct(F.lit(0).alias("pos"), F.col("marker").alias("name")))
    aliases = F.transform(F.split(F.coalesce("aliases", F.lit("")), ";"), lambda x, i: F.struct((i + 1).alias("pos"), x.alias("name")))
    names = panel.select(row, "marker", F.explode(F.concat(marker, aliases)).alias("n"))
    names = names.select(row, "marker", "n.pos", normal_name(F.col("n.name")).alias("norm")).where("norm <> ''")
    first = names.groupBy("norm").agg(F.min_by(F.struct("marker", "pos"), F.struct(row, "pos")).alias("f"))
    return first.select("norm", "f.marker", F.when(F.col("f.pos") == 0, "exact").otherwise("alias").alias("how"))


def matched_channels(channels: DataFrame, panel: DataFrame, image: str = "img") -> DataFrame:
    """(img, index, image_name, marker, how): the panel row of each image channel.

    Channels are matched by normalised marker, else by alias. If none of an image's channels
    matches and it has as many as the panel, they are matched by order.
    """
    found = channels.withColumn("norm", normal_name(F.col("image_name"))).join(names_of(panel), "norm", "left")
    none = found.groupBy(image).agg((F.count("marker") == 0).alias("_none"), F.count("*").alias("_n"))
    rows = panel.select((F.row_number().over(Window.orderBy("row")) - 1).alias("index"), F.col("marker").alias("_by_order"))  # a panel has tens of rows
    size = panel.agg(F.count("*").alias("_rows"))
    joined = found.join(none, image).join(rows, "index", "left").crossJoin(F.broadcast(size))
    by_order = F.col("_none") & (F.col("_n") == F.col("_rows"))
    return joined.select(
        image, "index", "image_name", F.when(by_order, F.col("_by_order")).otherwise(F.col("marker")).alias("marker"),
        F.when(by_order, "order").otherwise(F.coalesce("how", F.lit("unmatched"))).alias("how"),
    )


def doubly_matched(matched: DataFrame, image: str = "img") -> DataFrame:
    """(img, marker, n): markers that several channels of an image match; a caller stops if there are any."""
    return matched.where("marker is not null").groupBy(image, "marker").agg(F.count("*").alias("n")).where("n > 1")


def missing_markers(matched: DataFrame, panel: DataFrame, image: str = "img") -> DataFrame:
    """(img, marker): panel markers that no channel of an image has."""
    all_ = matched.select(image).distinct().crossJoin(F.broadcast(panel.select("marker").distinct()))  # a panel has tens of rows
    return all_.join(matched.select(image, "marker"), [image, "marker"], "left_anti")


def channel_table(matched: DataFrame, panel: DataFrame) -> DataFrame:
    """Channels with the panel's columns, blank where there is no match."""
    attributes = ["role", "segmentation", "status", "notes"]
    joined = matched.join(panel.select("marker", *attributes).dropDuplicates(["marker"]), "marker", "left")
    return joined.fillna("", ["marker", *attributes])


def marker_map_lint(map_: DataFrame, used: DataFrame) -> DataFrame:
    """(name, problem): what is wrong with a marker map, and what it and the panels lack of each other.

    ``map_`` has Marker, Marker_orig and Lineage, ``used`` has marker. Names are compared
    without regard to case.
    """
    named = map_.select("Marker", F.lower(strip(F.col("Marker_orig"))).alias("name"), "Lineage")
    twice = named.groupBy("Marker").agg(F.count("*").alias("n")).where("n > 1").select(F.col("Marker").alias("name"), F.lit("duplicate").alias("problem"))
    bad = named.where(clean_name(F.col("Marker")) != F.col("Marker")).select(F.col("Marker").alias("name"), F.lit("bad name").alias("problem"))
    lineage = named.where(~F.col("Lineage").isin(0, 1)).select(F.col("Marker").alias("name"), F.lit("bad lineage").alias("problem"))
    both = named.select("name").distinct().withColumn("m", F.lit(1)).join(
        used.select(F.lower(strip(F.col("marker"))).alias("name")).where("name <> ''").distinct().withColumn("u", F.lit(1)), "name", "full"
    )
    sides = both.where("m is null or u is null").select("name", F.when(F.col("m").isNull(), "not in map").otherwise("unused").alias("problem"))
    return twice.unionByName(bad).unionByName(lineage).unionByName(sides)


def name_collisions(names: DataFrame, column: str) -> DataFrame:
    """(cleaned, n): different names that cleaning makes equal; a caller stops if there are any."""
    cleaned = names.select(clean_name(F.col(column)).alias("cleaned"), column).where(F.col(column).isNotNull()).distinct()
    return cleaned.groupBy("cleaned").agg(F.count("*").alias("n")).where("n > 1")
