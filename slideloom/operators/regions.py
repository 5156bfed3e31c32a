"""Cells assigned to drawn regions, with their distance from a region's border."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from slideloom.functions.text import strip
from slideloom.operators.near import near
from slideloom.operators.spatial import boundary_distance, segments
from slideloom.session import checkpointed

NO_REGION = "Unassigned"
#: Side of the bins on which edges meet, and how far beside an edge its sides are looked at, in px.
_EDGE_BIN, _BESIDE = 64.0, 1e-5


def _class(shapes: DataFrame) -> DataFrame:
    """shape_id, image, class of each shape, without regard to case and padding; shapes without one are left out."""
    name = F.initcap(F.lower(strip(F.col("classification"))))
    return shapes.select("shape_id", "image", name.alias("class")).where("class <> ''")


def assigned(cells: DataFrame, shapes: DataFrame, priority: Sequence[str]) -> DataFrame:
    """(image, cellID, region): the class of the shape that holds a cell, or ``Unassigned``.

    Of several classes the later one in ``priority`` counts; classes not in it come before
    all others, by name. A hole only cuts its own shape. Cells are (image, cellID, x_px, y_px);
    a cell exported again has one row, cells without coordinates are unassigned.
    """
    points = cells.select("image", F.col("cellID").alias("id"), F.col("x_px").alias("x"), F.col("y_px").alias("y"))
    outlines = shapes.select("image", F.col("shape_id").alias("id"), "rings")
    held = near(points, outlines, distance=-1.0).where("near_kind = 'shape'")
    held = held.select("image", F.col("id_a").alias("cellID"), F.col("id_b").alias("shape_id")).join(_class(shapes).drop("image"), "shape_id")
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("class"))
    best = held.groupBy("image", "cellID").agg(F.max_by("class", F.struct(rank, "class")).alias("region"))
    once = cells.where("image is not null and cellID is not null").groupBy("image", "cellID").agg(F.count("*").alias("_n")).drop("_n")
    return once.join(best, ["image", "cellID"], "left").select("image", "cellID", F.coalesce("region", F.lit(NO_REGION)).alias("region"))


def one_hot(rows: DataFrame, classes: Sequence[str], column: str = "region") -> DataFrame:
    """``rows`` with a column ``in_CLASS`` of 0 or 1 for each class."""
    return rows.withColumns({f"in_{c}": (F.col(column) == c).cast("tinyint") for c in classes})


def signed_distance(cells: DataFrame, shapes: DataFrame, focus: str, px_um: float, boundary_um: float) -> DataFrame:
    """(image, cellID, signed_um, near_boundary) for cells near a border of the focus class.

    The distance from the nearest edge is positive inside the class and negative outside; it is
    rounded half to even to one place, and the flag is set by the unrounded distance. Cells
    farther away than ``boundary_um`` have no row: they are not near.
    """
    limit = boundary_um / px_um
    mine = shapes.join(_class(shapes).where(F.col("class") == focus).select("shape_id"), "shape_id", "left_semi")
    points = cells.where("not isnan(x_px) and not isnan(y_px)").groupBy("image", "cellID").agg(F.min("x_px").alias("x"), F.min("y_px").alias("y"))
    points = points.withColumnRenamed("cellID", "id")
    d = boundary_distance(points, segments(mine, ["image"]), limit, ["image"])
    inside = near(points, mine.select("image", F.col("shape_id").alias("id"), "rings"), distance=-1.0).where("near_kind = 'shape'")
    inside = inside.select("image", F.col("id_a").alias("id")).distinct().withColumn("_in", F.lit(1))
    um = F.col("d") * px_um * F.when(F.col("_in").isNull(), -1).otherwise(1)
    joined = d.join(inside, ["image", "id"], "left")
    return joined.select(
        "image", F.col("id").alias("cellID"), F.bround(um, 1).alias("signed_um"), (F.abs(um) < boundary_um).cast("tinyint").alias("near_boundary")
    )


def union_border(mine: DataFrame) -> DataFrame:
    """(image, x1, y1, x2, y2): the parts of the edges of shapes that bound the union of the shapes.

    Edges are cut where others of their image cross, touch or end on them; a piece counts if just
    one of the places beside its middle, ``_BESIDE`` px away, lies inside some shape.
    """
    edges = segments(mine, ["image"]).select("image", "x1", "y1", "x2", "y2").where("x1 <> x2 or y1 <> y2").distinct()
    edges = checkpointed(edges.where(" and ".join(f"not isnan({c}) and {c} is not null" for c in ("x1", "y1", "x2", "y2"))))
    bins = [F.sequence(*[F.floor(f(f"{c}1", f"{c}2") / _EDGE_BIN).cast("bigint") for f in (F.least, F.greatest)]) for c in "xy"]
    laid = edges.withColumn("_bx", F.explode(bins[0])).withColumn("_by", F.explode(bins[1]))
    other = laid.withColumnsRenamed({"x1": "u1", "y1": "v1", "x2": "u2", "y2": "v2"})
    met = laid.join(other, ["image", "_bx", "_by"]).where("least(x1, x2) <= greatest(u1, u2) and least(u1, u2) <= greatest(x1, x2) and least(y1, y2) <= greatest(v1, v2) and least(v1, v2) <= greatest(y1, y2)")
    cross = "((x2 - x1) * (v2 - v1) - (y2 - y1) * (u2 - u1))"
    along = lambda u, v: f"((({u}) - x1) * (x2 - x1) + (({v}) - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    at = F.expr(
        f"if(abs({cross}) > 1e-12, array(((u1 - x1) * (v2 - v1) - (v1 - y1) * (u2 - u1)) / {cross}), array({along('u1', 'v1')}, {along('u2', 'v2')}))"
    )
    names = ["image", "x1", "y1", "x2", "y2"]
    cuts = met.withColumn("t", F.explode(at)).where("t > 0 and t < 1").groupBy(*names).agg(F.array_sort(F.collect_set("t")).alias("ts"))
    ts = F.concat(F.array(F.lit(0.0)), F.coalesce("ts", F.array().cast("array<double>")), F.array(F.lit(1.0)))
    pieces = edges.join(cuts, names, "left").withColumn("ts", ts).withColumn("_k", F.explode(F.sequence(F.lit(1), F.size("ts") - 1)))
    pieces = pieces.withColumn("t1", F.get("ts", F.col("_k") - 1)).withColumn("t2", F.get("ts", F.col("_k")))
    place = lambda c, t: F.col(f"{c}1") + F.col(t) * (F.col(f"{c}2") - F.col(f"{c}1"))
    pieces = pieces.select("image", place("x", "t1").alias("x1"), place("y", "t1").alias("y1"), place("x", "t2").alias("x2"), place("y", "t2").alias("y2"))
    pieces = checkpointed(pieces.where("x1 <> x2 or y1 <> y2").distinct().withColumn("piece", F.monotonically_increasing_id()))
    length = F.sqrt(F.expr("(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)"))
    beside = pieces.withColumn("_s", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_e", (2 * F.col("_s") - 1) * _BESIDE / length)
    beside = beside.select(
        "image", (2 * F.col("piece") + F.col("_s")).alias("id"), F.expr("(x1 + x2) / 2 - (y2 - y1) * _e").alias("x"), F.expr("(y1 + y2) / 2 + (x2 - x1) * _e").alias("y")
    )
    held = near(beside, mine.select("image", F.col("shape_id").alias("id"), "rings"), distance=-1.0).where("near_kind = 'shape'")
    sides = held.select("image", "id_a").distinct().groupBy(F.expr("id_a div 2").alias("piece")).agg(F.count("*").alias("_n"))
    return pieces.join(sides.where("_n = 1"), "piece", "left_semi").drop("piece")


def signed_distance_of_all(cells: DataFrame, shapes: DataFrame, focus: str, px_um: float, boundary_um: float) -> DataFrame:
    """(image, cellID, signed_um, near_boundary) for every cell of an image with shapes of the focus class.

    As :func:`signed_distance`, but from the border of the union of the shapes and however far it
    is: cells without a border within reach are looked up again with twice the reach.
    """
    mine = checkpointed(shapes.join(_class(shapes).where(F.col("class") == focus).select("shape_id").distinct(), "shape_id", "left_semi"))
    points = cells.where("image is not null and cellID is not null and not isnan(x_px) and not isnan(y_px) and abs(x_px) < double('inf') and abs(y_px) < double('inf')")
    points = points.groupBy("image", F.col("cellID").alias("id")).agg(F.min("x_px").alias("x"), F.min("y_px").alias("y"))
    border = checkpointed(union_border(mine))
    left = checkpointed(points.join(border.select("image").distinct(), "image", "left_semi"))
    found, limit = [], boundary_um / px_um
    while not left.isEmpty():
        d = checkpointed(boundary_distance(left, border.withColumns({"shape_id": F.lit(0), "ring": F.lit(0)}), limit, ["image"]))
        found.append(d)
        left = checkpointed(left.join(d, ["image", "id"], "left_anti"))
        limit *= 2
    d = reduce(DataFrame.unionByName, found) if found else left.select("image", "id", F.col("x").alias("d"))
    inside = near(points, mine.select("image", F.col("shape_id").alias("id"), "rings"), distance=-1.0).where("near_kind = 'shape'")
    inside = inside.select("image", F.col("id_a").alias("id")).distinct().withColumn("_in", F.lit(1))
    um = F.col("d") * px_um * F.when(F.col("_in").isNull(), -1).otherwise(1)
    return d.join(inside, ["image", "id"], "left").select(
        "image", F.col("id").alias("cellID"), F.bround(um, 1).alias("signed_um"), (F.abs(um) < boundary_um).cast("tinyint").alias("near_boundary")
    )


def filled(shapes: DataFrame, factor: float, order: str, holes_clear: bool) -> DataFrame:
    """(image, y, x0, x1, shape_id): polygons as spans of a raster reduced by ``factor``.

    A pixel belongs to a shape if its centre lies inside the shape by the even-odd rule. With
    ``holes_clear`` a hole also clears what earlier shapes, in ``order``, have there; the row
    then has a NULL shape_id.
    """
    edges = segments(shapes.withColumn("rings", F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] / factor).alias("x"), (p["y"] / factor).alias("y"))))), ["image", order])
    rows = F.sequence(F.ceil(F.least("y1", "y2")).cast("bigint"), (F.ceil(F.greatest("y1", "y2")) - 1).cast("bigint"))
    cross = edges.where(F.ceil(F.least("y1", "y2")) < F.ceil(F.greatest("y1", "y2"))).withColumn("y", F.explode(rows))
    at = F.col("x1") + (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1"))
    by = ["image", order, "shape_id", "y"] + (["ring"] if holes_clear else [])
    xs = cross.withColumn("at", at).groupBy(*by).agg(F.array_sort(F.collect_list("at")).alias("xs"))
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.size("xs") - 1), lambda i: i % 2 == 0), lambda i: F.struct(F.get("xs", i).alias("a"), F.get("xs", i + 1).alias("b")))
    runs = xs.withColumn("_p", F.explode(pairs)).select(*by, F.ceil("_p.a").cast("bigint").alias("x0"), F.ceil("_p.b").cast("bigint").alias("x1")).where("x0 < x1")
    if holes_clear:
        runs = runs.withColumn("shape_id", F.when(F.col("ring") == 0, F.col("shape_id")))
    return runs


def painted(runs: DataFrame, order: str, ring: str | None = None) -> DataFrame:
    """(image, y, x, shape_id): which shape each pixel shows, later ones over earlier ones; cleared pixels are left out."""
    keys = F.struct(order, ring) if ring else F.struct(order)
    pixels = runs.withColumn("x", F.explode(F.sequence("x0", F.col("x1") - 1)))
    return pixels.groupBy("image", "y", "x").agg(F.max_by(F.struct("shape_id"), keys).alias("s")).select("image", "y", "x", "s.shape_id").where("shape_id is not null")


def windows(shapes: DataFrame, pad: int) -> DataFrame:
    """(shape_id, y0, x0, y1, x1): the pixels around the first ring of each shape."""
    first = shapes.where(F.size("rings") > 0).select("shape_id", F.get("rings", F.lit(0)).alias("p")).where(F.size("p") > 0)
    low = lambda c: (F.floor(F.array_min(f"p.{c}")) - pad).cast("bigint")
    high = lambda c: (F.ceil(F.array_max(f"p.{c}")) + pad + 1).cast("bigint")
    return first.select("shape_id", low("y").alias("y0"), low("x").alias("x0"), high("y").alias("y1"), high("x").alias("x1"))

