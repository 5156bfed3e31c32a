"""Sheets and outlines read from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Names of regions among drawn outlines, in lower case.
REGION_NAMES = ("ground truth", "grouth truth", "groundtruth", "region", "field", "roi")

_GEOMETRY = "type string, coordinates string"
_FEATURE = f"type string, geometry struct<{_GEOMETRY}, geometries array<struct<{_GEOMETRY}>>>, properties struct<objectType: string, name: string, classification: string>"


def read_sheet(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The columns of a CSV sheet as strings; blanks stay blank, missing columns are blank, others are left out.

    Header names count without regard to case and padding.
    """
    rows = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True, nullValue="\x00", emptyValue="")
    there = {c.strip().lower(): c for c in rows.columns}
    return rows.select(*[(F.coalesce(F.trim(F.col(f"`{there[c]}`")), F.lit("")) if c in there else F.lit("")).alias(c) for c in columns])


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Reference cells (x_px, y_px, region, area_px); region and area may be missing."""
    rows = spark.read.csv(path, header=True)
    kinds = {"x_px": "double", "y_px": "double", "region": "string", "area_px": "double"}
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).try_cast(k).alias(c) for c, k in kinds.items()])


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files below 2 GB each."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def _features(text: Column) -> Column:
    """The features of a collection, a list or a single feature, or a bare geometry as a feature of its own."""
    collection = F.from_json(text, f"features array<struct<{_FEATURE}>>")["features"]
    listed = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<struct<{_FEATURE}>>"))
    alone = F.from_json(text, _FEATURE)
    bare = F.from_json(text, f"{_GEOMETRY}, geometries array<struct<{_GEOMETRY}>>")
    single = F.when(alone["geometry"].isNotNull(), F.array(alone)).when(
        bare["coordinates"].isNotNull(),
        F.array(F.struct(F.lit("Feature").alias("type"), bare.alias("geometry"), F.lit(None).cast("struct<objectType:string,name:string,classification:string>").alias("properties"))),
    )
    return F.coalesce(collection, listed, single)


_RING = "array<array<double>>"


def outlines(texts: DataFrame, key: str = "path", text: str = "value") -> DataFrame:
    """(key, shape_id, classification, object_type, name, kind, rings): one row per polygon or point set.

    Polygons of a MultiPolygon and of a collection of geometries each have a row; points have
    one ring that holds them. The class is the classification's name, or the classification
    itself if it is a string, else the name. Files that can't be read give no row.
    """
    rows = texts.select(F.col(key), F.posexplode(_features(F.col(text))).alias("_f", "f"))
    geometry = F.col("f.geometry")
    parts = F.when(geometry["type"] == "GeometryCollection", geometry["geometries"]).otherwise(F.array(F.struct(geometry["type"].alias("type"), geometry["coordinates"].alias("coordinates"))))
    rows = rows.select(key, "_f", "f.properties", F.posexplode(parts).alias("_g", "g"))
    kind, at = F.col("g.type"), F.col("g.coordinates")
    polygons = (
        F.when(kind == "Polygon", F.array(F.from_json(at, f"array<{_RING}>")))
        .when(kind == "MultiPolygon", F.from_json(at, f"array<array<{_RING}>>"))
        .when(kind == "MultiPoint", F.array(F.array(F.from_json(at, _RING))))
        .when(kind == "Point", F.array(F.array(F.array(F.from_json(at, "array<double>")))))
    )
    rows = rows.select(key, "_f", "_g", "properties", F.when(kind.endswith("Point"), "points").otherwise("polygon").alias("kind"), F.posexplode(polygons).alias("_p", "r"))
    name = F.get_json_object("properties.classification", "$.name")
    plain = F.when(~F.col("properties.classification").startswith("{"), F.col("properties.classification"))
    rings = F.transform("r", lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.select(
        key, F.concat_ws(".", "_f", "_g", "_p").alias("shape_id"), F.coalesce(name, plain, "properties.name").alias("classification"),
        F.col("properties.objectType").alias("object_type"), F.col("properties.name").alias("name"), "kind", rings.alias("rings"),
    )


def with_role(shapes: DataFrame, key: str = "path") -> DataFrame:
    """``shapes`` with is_region: a field rather than a cell.

    So named or so classed; or an annotation in a file that has detections; or any outline but
    a detection in a file that has clicked points.
    """
    seen = shapes.groupBy(key).agg(F.max(F.col("object_type") == "detection").alias("_d"), F.max(F.col("kind") == "points").alias("_c"))
    joined = shapes.join(seen, key)
    named = F.lower("classification").isin(*REGION_NAMES) | F.lower("name").isin(*REGION_NAMES)
    kind = F.coalesce(F.col("object_type"), F.lit(""))
    region = F.coalesce(named, F.lit(False)) | (F.coalesce("_d", F.lit(False)) & (kind == "annotation")) | (F.coalesce("_c", F.lit(False)) & (kind != "detection"))
    return joined.withColumn("is_region", region & (F.col("kind") == "polygon")).drop("_d", "_c")
