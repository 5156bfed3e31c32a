"""Queries from pixels to cell tables, and joins of points with pixels and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slideloom.operators import labels, morph, segment
from slideloom.plans.cells import _C, _cells, _P, _points
from slideloom.plans.images import _ONE, PX, _once, pixels
from slideloom.session import table


def masked_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels per channel on and off a reduced mask."""
    px = pixels(spark, folder)
    mask = px.where("v > 60000").selectExpr("img", "y div 8 as my", "x div 8 as mx")
    on = segment.masked(px, mask, 8).withColumn("side", F.lit("in"))
    return on.unionByName(segment.masked(px, mask, 8, inside=False).withColumn("side", F.lit("out"))).groupBy("img", "c", "side").agg(F.count("*").alias("n"), F.max("v").alias("top"))


def same_label_overlap(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return segment.same_label_overlap(labels.spans(_once(px, "label")), labels.spans(_once(px, "label2")))


def reference_values(spark: SparkSession, folder: str) -> DataFrame:
    """The brightest value at the pixel of each point, in the point's own image."""
    points = _points(spark, folder, 0, 1).withColumn("x", (F.col("x") - 900) * 1.2).withColumn("y", (F.col("y") - 900) * 1.2)
    return segment.values_at(points, pixels(spark, folder).select("img", "y", "x", "v"), 256, 256).select("img", "id", "v")


def interior_points(spark: SparkSession, folder: str) -> DataFrame:
    return segment.interior(_points(spark, folder, 0, 1), 900.0, 2000.0, 2000.0).select("img", "id")


def cells_in_rois(spark: SparkSession, folder: str) -> DataFrame:
    """How many cells lie inside each ROI as proposed, against the number it was proposed with."""
    r = table(spark, folder, "rois").groupBy("sample_id", "roi_id", "y0", "x0", "y1", "x1").agg(F.max("n_cells").alias("n_cells"))
    windows = r.select(F.col("sample_id").alias("img"), F.concat_ws("@", "roi_id", "y0", "x0").alias("window_id"), "y0", "x0", "y1", "x1")
    return segment.in_windows(_cells(spark, folder), windows).groupBy("img", "window_id").agg(F.count("*").alias("n"))


def resumable_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The last unbroken run of order numbers of each customer group."""
    o = table(spark, folder, "orders").selectExpr("o_custkey % 97 as grp", "o_orderkey div 64 as block")
    return segment.last_runs(o, ["grp"], "block")


def _segmented(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    px = pixels(spark, folder).withColumn("v", F.when(F.col("v") > 30000, F.col("v")).otherwise(0)).select("img", "y", "x", "v")
    mask = px.selectExpr("img", "y div 8 as my", "x div 8 as mx").where("my % 7 <> 0").distinct()
    return segment.cell_tables(px, mask, 8, morph.threshold_objects(0), 2.0, 64, 16)


def nucleus_table(spark: SparkSession, folder: str) -> DataFrame:
    return _segmented(spark, folder)[0]


def cell_table(spark: SparkSession, folder: str) -> DataFrame:
    return _segmented(spark, folder)[1]


def roi_label_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Label tiles of two windows of each image, and how large they are."""
    px = _once(pixels(spark, folder), "label")
    windows = px.select("img").distinct().selectExpr("img", "inline(array(struct('R01' as roi_id, 0 as y0, 0 as wx0, 100 as y1, 100 as wx1), struct('R02' as roi_id, 50 as y0, 60 as wx0, 200 as y1, 256 as wx1)))")
    return segment.roi_tiles(px, windows, 64).select("img", "roi_id", "ty", "tx", "size", F.length("data").alias("bytes"))


QUERIES = {
    f.__name__: f
    for f in (masked_histogram, same_label_overlap, reference_values, interior_points, cells_in_rois, resumable_blocks, nucleus_table, cell_table, roi_label_tiles)
}

SQL = {
    "masked_histogram": f"""with {PX}, m as (select distinct img, y // 8 as my, x // 8 as mx from px where v > 60000)
        select px.img, c, case when m.img is null then 'out' else 'in' end as side, count(*) as n, max(v) as top from px left join m on m.img = px.img and my = y // 8 and mx = x // 8 group by 1, 2, 3""",
    "same_label_overlap": f"with {_ONE} select img, label, count(*) as n from pa join pb using (img, y, x, label) where label <> 0 group by 1, 2",
    "reference_values": f"""with {PX}, {_P}, s as (select img, id, least(greatest(round_even((y - 900) * 1.2, 0)::bigint, 0), 255) as py, least(greatest(round_even((x - 900) * 1.2, 0)::bigint, 0), 255) as qx from p),
        b as (select img, y, x, max(v) as v from px group by 1, 2, 3) select s.img, id, v from s left join b on b.img = s.img and b.y = py and b.x = qx""",
    "interior_points": f"with {_P} select img, id from p where x > 900 and x < 1100 and y > 900 and y < 1100",
    "cells_in_rois": f"""with {_C}, w as (select distinct sample_id as img, roi_id || '@' || y0 || '@' || x0 as window_id, y0, x0, y1, x1 from rois)
        select c.img, window_id, count(*) as n from c join w on c.img = w.img and y >= y0 and y < y1 and x >= x0 and x < x1 group by 1, 2""",
    "resumable_blocks": """with o as (select distinct o_custkey % 97 as grp, o_orderkey // 64 as block from orders), r as (select *, block + row_number() over (partition by grp order by block desc) as i from o),
        f as (select grp, i, min(block) as first, max(block) as last from r group by 1, 2)
        select grp, first, last from (select *, row_number() over (partition by grp order by last desc) as k from f) where k = 1""",
}
