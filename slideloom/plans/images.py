"""Queries over pixels: histograms, quality flags, labels, masks and scores.

The pixels of an image are read from lineitem: image, channel, row, column, value and two
labels of each are whole-number functions of its keys. Larger tables give more images.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slideloom.operators import compare, graph, hist, labels, morph, qc, report, score
from slideloom.session import table

SIDE = 256


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    """(img, c, y, x, v, label, label2, sample): the pixels as read, places may repeat."""
    t = table(spark, folder, "lineitem")
    return t.selectExpr(
        "l_orderkey div 65536 as img", "l_linenumber - 1 as c", "l_orderkey % 256 as y", "l_partkey % 256 as x", "cast(floor(l_extendedprice) as bigint) % 65536 as v",
        "l_suppkey % 64 as label", "l_partkey % 48 as label2", "l_returnflag as sample",
    )


def _once(px: DataFrame, label: str) -> DataFrame:
    """One label per place of an image."""
    return px.groupBy("img", "y", "x").agg(F.min(label).alias("label"))


PX = """
    px as (select l_orderkey // 65536 as img, l_linenumber - 1 as c, l_orderkey % 256 as y, l_partkey % 256 as x,
                  cast(floor(l_extendedprice) as bigint) % 65536 as v, l_suppkey % 64 as label, l_partkey % 48 as label2,
                  l_returnflag as sample
           from lineitem)"""
_HIST = PX + ", h as (select img, c, v, count(*) as n from px group by 1, 2, 3)"
_CUM = """, cum as (select *, sum(n) over (partition by img, c order by v) / sum(n) over (partition by img, c) as share from h)"""


def _pct(q: float, name: str) -> str:
    return f"cast(min(case when share >= {q / 100.0!r} then v end) as bigint) as {name}"


def channel_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return hist.histogram(pixels(spark, folder), ["img", "c"])


def channel_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    h = hist.histogram(pixels(spark, folder), ["img", "c"])
    return hist.plausibility(hist.channel_stats(h, ["img", "c"]))


def channel_qc_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Tissue is labelled, background is not."""
    px = pixels(spark, folder)
    inside, outside = px.where("label % 4 <> 0"), px.where("label % 4 = 0")
    hi, ho = hist.histogram(inside, ["img", "c"]), hist.histogram(outside, ["img", "c"])
    t = hist.percentiles(hi, ["img", "c"], (50, 99, 99.9)).toDF("img", "c", "t50", "t99", "t99_9")
    b = hist.percentiles(ho, ["img", "c"], (50, 99)).toDF("img", "c", "b50", "b99")
    s = hist.channel_stats(hi, ["img", "c"]).select("img", "c", F.col("pct_zero").alias("zero"), F.col("pct_saturated").alias("saturated"))
    seam = qc.seams(qc.tile_values(outside, 32, ["img", "c"]), ["img", "c"])
    joined = t.join(s, ["img", "c"]).join(b, ["img", "c"], "left").join(seam, ["img", "c"], "left")
    return joined.withColumn("flags", qc.channel_flags()).select("img", "c", "t50", "t99", "t99_9", "b50", "b99", "zero", "saturated", "seam", "flags")


def tile_robust_z(spark: SparkSession, folder: str) -> DataFrame:
    tiles = qc.tile_values(pixels(spark, folder), 32, ["img", "c"])
    return qc.robust_z(tiles, ["img", "c"], "median").select("img", "c", "ty", "tx", "n", "median", F.round("p99_9", 6).alias("p99_9"), "z")


def tile_kinds(spark: SparkSession, folder: str) -> DataFrame:
    mask = pixels(spark, folder).groupBy("img", "y", "x").agg((F.max("label") >= 16).alias("tissue"), (F.max("v") < 2000).alias("nodata"))
    out = qc.tile_kinds(mask, 32, ["img"])
    return out.select("img", "ty", "tx", F.round("tissue_fraction", 6).alias("tissue_fraction"), F.round("nodata_fraction", 6).alias("nodata_fraction"), "kind")


def tile_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles out of focus, folded, or with aggregates; channel 0 is the nuclear one."""
    px = pixels(spark, folder)
    values, focus = qc.tile_values(px, 32, ["img", "c"]), qc.tile_focus(px.where("c = 0"), 32, ["img"])
    top = hist.percentiles(hist.histogram(px.where("label >= 16"), ["img", "c"]), ["img", "c"], (99.9,)).withColumnRenamed("p99_9", "top")
    return qc.tile_flags(values, focus, tile_kinds(spark, folder), top, 0, ["img"])


def flagged_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Which channels have their brightest value of all in each tile."""
    px = pixels(spark, folder)
    tiles, top = qc.tile_values(px, 32, ["img", "c"]), px.groupBy("img", "c").agg(F.percentile("v", F.lit(0.999)).alias("top"))
    hits = tiles.join(top, ["img", "c"]).where("p99_9 >= top").withColumn("marker", F.concat(F.lit("ch"), "c"))
    return qc.hits_per_tile(hits, ["img", "ty", "tx"])


def worst_tiles_topk(spark: SparkSession, folder: str) -> DataFrame:
    tiles = tile_robust_z(spark, folder)
    return qc.worst_tiles(tiles, ["z"], ["img", "c", "ty", "tx"], 8).select("img", "c", "ty", "tx", "z", "severity")


def tile_focus(spark: SparkSession, folder: str) -> DataFrame:
    return qc.tile_focus(pixels(spark, folder), 32, ["img", "c"])


def nodata_pixels(spark: SparkSession, folder: str) -> DataFrame:
    low = pixels(spark, folder).withColumn("v", F.when(F.col("v") < 3000, 0).otherwise(F.col("v")))
    return qc.nodata_pixels(low, ["img"])


def analysis_mask(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).select("img", "y", "x", "label").distinct()
    tissue = px.where("label >= 8").select("img", "y", "x").distinct()
    excluded = px.where("label = 63")
    boxes = tile_kinds(spark, folder).where("tissue_fraction < 0.8").selectExpr("img", "ty * 32 as y0", "tx * 32 as x0", "ty * 32 + 32 as y1", "tx * 32 + 32 as x1")
    return qc.analysis_mask(tissue, excluded, boxes, ["img"])


def region_properties(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).where("label <> 0").select("img", "label", "y", "x").distinct()
    return qc.region_properties(px, ["img", "label"], 0.5).select("img", "label", "area_mm2", "centroid_x_um", "centroid_y_um", F.concat_ws(",", "bbox_um").alias("bbox_um"))


def pooled_display_range(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).withColumn("bins", F.when(F.col("sample") == "R", 256).otherwise(65_536)).withColumn("v", F.col("v") % F.col("bins"))
    h = hist.histogram(px.withColumn("marker", F.concat(F.lit("ch"), "c")), ["sample", "marker", "bins"])
    return hist.pooled_display_range(h)


def membrane_composite(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).groupBy("img", "c", "y", "x").agg(F.min("v").alias("v"))
    ranges = hist.display_range(hist.histogram(px, ["c"]), ["c"])
    return hist.composite(px, ranges, ["img", "y", "x"])


def downsample_mean(spark: SparkSession, folder: str) -> DataFrame:
    return hist.downsampled(pixels(spark, folder), 24, SIDE, SIDE, ["img", "c"])


def otsu_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return hist.otsu(hist.histogram(pixels(spark, folder), ["img", "c"]), ["img", "c"])


def label_spans(spark: SparkSession, folder: str) -> DataFrame:
    return labels.spans(_once(pixels(spark, folder), "label")).select("img", "label", "y", "x0", "x1")


def label_stats(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_stats(labels.spans(_once(pixels(spark, folder), "label")))


def span_label_overlap(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return labels.overlap(labels.spans(_once(px, "label")), labels.spans(_once(px, "label2")))


def label_overlap_iou(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return labels.iou(labels.spans(_once(px, "label")), labels.spans(_once(px, "label2")))


def border_labels_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of blocks of 40 pixels that touch no border of the image."""
    px = pixels(spark, folder).withColumn("label", F.expr("(y div 40) * 8 + x div 40 + 1"))
    return labels.drop_border(labels.spans(_once(px, "label")), 0, 0, SIDE, SIDE).select("img", "label").distinct()


def relabel_dense(spark: SparkSession, folder: str) -> DataFrame:
    stats = label_stats(spark, folder)
    return labels.relabelled(stats, (F.col("n") > 0) & (F.col("cx") > 120))


def cells_in_mask(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    mask = px.where("v < 40000").selectExpr("img", "y div 8 as my", "x div 8 as mx").distinct()
    return labels.inside_mask(label_stats(spark, folder), mask, 8.0, 32, 32)


def roi_cut_cells(spark: SparkSession, folder: str) -> DataFrame:
    runs = labels.spans(_once(pixels(spark, folder), "label"))
    windows = runs.select("img").distinct().selectExpr("img", "inline(array(struct('R01' as roi_id, 0 as y0, 0 as wx0, 100 as y1, 100 as wx1), struct('R02' as roi_id, 50 as y0, 60 as wx0, 200 as y1, 256 as wx1)))")
    return labels.cut_labels(runs, windows)


def dilated_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Every label grown by a diamond."""
    runs = labels.spans(_once(pixels(spark, folder), "label"))
    return labels.label_stats(labels.dilated(runs, 2, SIDE, SIDE)).select("img", "label", "n")


def expanded_labels(spark: SparkSession, folder: str) -> DataFrame:
    """All labels grown into the background only."""
    return labels.expanded(labels.spans(_once(pixels(spark, folder), "label")), 2, SIDE, SIDE)


def components(spark: SparkSession, folder: str) -> DataFrame:
    """Connected pieces of bright pixels, by size."""
    mask = pixels(spark, folder).where("v > 45000").select("img", "y", "x").distinct()
    pieces = labels.foreground_components(mask)
    return pieces.groupBy("img", "label").agg(F.sum(F.col("x1") - F.col("x0")).alias("n"), F.min("y").alias("y0"))


def small_objects_removed(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of the bright pixels; pieces are not numbered, as only their sizes count."""
    mask = pixels(spark, folder).where("v > 45000").selectExpr("img", "y", "x", "1 as label")
    return labels.span_pieces(labels.spans(mask)).where("size >= 4").groupBy("img").agg(F.count("*").alias("spans"), F.sum(F.col("x1") - F.col("x0")).alias("n"))


def filled_holes(spark: SparkSession, folder: str) -> DataFrame:
    mask = pixels(spark, folder).where("v > 9000").select("img", "y", "x").distinct()
    return labels.holes(mask, SIDE, SIDE, 6)


def nested_folded(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).withColumn("label", F.expr("(y div 16) * 16 + x div 16 + 1 + case when x % 16 in (6, 7) and y % 16 in (6, 7) then 1000 else 0 end"))
    return labels.folded(labels.spans(_once(px, "label")), 3, 0.9, SIDE, SIDE)


def distance_to_background(spark: SparkSession, folder: str) -> DataFrame:
    mask = pixels(spark, folder).groupBy("img", "y", "x").agg((F.max("v") > 20000).alias("inside"))
    return morph.distance_transform(mask)


def watershed_cells(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder).groupBy("img", "y", "x").agg(F.min("v").cast("double").alias("elevation"), F.min("label").alias("l"))
    px = px.withColumn("marker", F.when(F.col("l") % 16 == 0, F.col("l") + 1).otherwise(0)).withColumn("inside", F.col("elevation") < 60000)
    # 6 um in pixels of 0.5 um, and the weight are the reference's, for an elevation from 0 to 1.
    grown = morph.propagated(px.drop("l").withColumn("elevation", F.col("elevation") / 65535), 64, 12, 0.5)
    return grown.groupBy("img", "label").agg(F.count("*").alias("n"))


def predicted_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Objects of the stand-in predictor over tiles with halo."""
    px = pixels(spark, folder).withColumn("v", F.when(F.col("v") > 45000, F.col("v")).otherwise(0))
    return morph.predicted(px, 64, 16, morph.threshold_objects(0)).groupBy("img", "label").agg(F.count("*").alias("n"))


def dense_label_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return morph.dense_tiles(_once(pixels(spark, folder), "label"), 64).select("img", "ty", "tx", "size", F.length("data").alias("bytes"))


def raster_check(spark: SparkSession, folder: str) -> DataFrame:
    return labels.raster_check(pixels(spark, folder))


def f1_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Found pairs counted at each threshold; the pairs are those of each label's largest overlap."""
    shared = label_overlap_iou(spark, folder)
    best = shared.withColumn("r", F.row_number().over(Window.partitionBy("img", "a").orderBy(F.desc("iou"), "b"))).where("r = 1")
    n = lambda c: shared.groupBy("img").agg(F.countDistinct(c).alias("n"))
    return score.sweep(n("a"), n("b"), best, ["img"], "iou", (0.005, 0.01, 0.02))


def _blocks(px: DataFrame, shift: int) -> DataFrame:
    moved = px.withColumn("label", F.expr(f"((y + {shift}) div 16) * 20 + (x + {shift}) div 16 + 1"))
    return labels.spans(_once(moved, "label"))


def score_outlines(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return score.score_outlines(_blocks(px, 0), _blocks(px, 3), (0, 0, SIDE, SIDE), (0.3, 0.5, 0.7))


def outline_summary(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return score.outline_summary(_blocks(px, 0), _blocks(px, 3))


def _shifts(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values (1, 9.0D, 4.0D), (2, -5.0D, 11.0D), (3, 3.0D, -13.0D) as t(shift, dx, dy)")


def noise_floor(spark: SparkSession, folder: str) -> DataFrame:
    """Two labellings of the same fields held against each other: how well people would agree."""
    px = pixels(spark, folder)
    both = score.score_outlines(_blocks(px, 1), _blocks(px, 2), None, (0.5,))
    return both.select("img", "tp", "fp", "fn", F.col("f1").alias("noise_floor_f1"))


def worst_agreement_squares(spark: SparkSession, folder: str) -> DataFrame:
    """The three squares of each image where labels agree least, of those with fifteen cells or more."""
    px = pixels(spark, folder)
    return compare.worst_squares(_blocks(px, 0), _blocks(px, 3), 64)


def compare_methods(spark: SparkSession, folder: str) -> DataFrame:
    px = pixels(spark, folder)
    return compare.compare_methods(_blocks(px, 0), _blocks(px, 3), 5.0, 2.0, _shifts(spark))


def method_area_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Areas of labels in two rasters side by side, and their ratio."""
    px = pixels(spark, folder)
    a, b = (labels.label_stats(labels.spans(_once(px, c))) for c in ("label", "label2"))
    return report.aligned_ratio(a, b, ["img", "label"], "n")


def method_summary(spark: SparkSession, folder: str) -> DataFrame:
    return report.method_summary(label_stats(spark, folder), ["img"], "n")


def order_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Parts and suppliers linked by lines: how large their connected groups are."""
    t = table(spark, folder, "lineitem").selectExpr("l_partkey * 2 as a", "l_suppkey * 2 + 1 as b").distinct()
    nodes = t.selectExpr("a as id").unionByName(t.selectExpr("b as id")).distinct()
    return graph.components(nodes, t).groupBy("root").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        channel_histogram, channel_percentiles, channel_qc_flags, tile_robust_z, tile_kinds, tile_flags, flagged_channels, worst_tiles_topk, tile_focus, nodata_pixels,
        analysis_mask, region_properties, pooled_display_range, membrane_composite, downsample_mean, otsu_threshold, label_spans, label_stats, span_label_overlap,
        label_overlap_iou, border_labels_dropped, relabel_dense, cells_in_mask, roi_cut_cells, dilated_labels, expanded_labels, components, small_objects_removed,
        filled_holes, nested_folded, distance_to_background, watershed_cells, predicted_objects, dense_label_tiles, raster_check, f1_sweep, score_outlines,
        outline_summary, noise_floor, worst_agreement_squares, compare_methods, method_area_ratio, method_summary, order_groups,
    )
}

_ONE = PX + """,
    pa as (select img, y, x, min(label) as label from px group by 1, 2, 3),
    pb as (select img, y, x, min(label2) as label from px group by 1, 2, 3)"""
_SPANS = _ONE + """,
    runs as (select img, label, y, min(x) as x0, max(x) + 1 as x1
             from (select *, x - row_number() over (partition by img, label, y order by x) as r from pa where label <> 0) group by img, label, y, r)"""
_STATS = _ONE + """,
    st as (select img, label, count(*) as n, round(avg(x), 6) as cx, round(avg(y), 6) as cy from pa where label <> 0 group by 1, 2)"""
_TILES = PX + """,
    t as (select img, c, y // 32 as ty, x // 32 as tx, count(*) as n, median(v) as median, quantile_cont(v, 0.999) as p99_9 from px group by 1, 2, 3, 4),
    m as (select img, c, median(median) as md from t group by 1, 2),
    d as (select t.*, md from t join m using (img, c)),
    s as (select img, c, median(abs(median - md)) as mad from d group by 1, 2),
    z as (select d.img, d.c, ty, tx, n, median, round(p99_9, 6) as p99_9, case when mad = 0 then 0.0 else round((median - md) / (1.4826 * mad), 6) end as z
          from d join s on d.img = s.img and d.c = s.c)"""
_KINDS = PX + """,
    mask as (select img, y, x, max(label) >= 16 as tissue, max(v) < 2000 as nodata from px group by 1, 2, 3),
    k as (select img, y // 32 as ty, x // 32 as tx, avg(tissue::int) as tf, avg(nodata::int) as nf from mask group by 1, 2, 3)"""
_IOU = _ONE + """,
    o as (select a.img, a.label as a, b.label as b, count(*) as n from pa a join pb b using (img, y, x) where a.label <> 0 and b.label <> 0 group by 1, 2, 3),
    na as (select img, label, count(*) as k from pa where label <> 0 group by 1, 2), nb as (select img, label, count(*) as k from pb where label <> 0 group by 1, 2),
    i as (select o.*, round(n / (na.k + nb.k - n), 6) as iou from o join na on o.img = na.img and o.a = na.label join nb on o.img = nb.img and o.b = nb.label)"""
def _components(pixels: str, around: str) -> str:
    """``cc`` (img, y, x, root): the first pixel of each pixel's connected piece, by rounds of neighbours' smallest."""
    return f"""
    nd as ({pixels}), ar as (select * from (values {around}) v(dy, dx)),
    ed as (select a.img * 1099511627776 + a.y * 1048576 + a.x as a, a.img * 1099511627776 + (a.y + dy) * 1048576 + a.x + dx as b from nd a, ar
           where exists (select 1 from nd b where b.img = a.img and b.y = a.y + dy and b.x = a.x + dx)),
    rc(id, root) using key (id) as (
      select img * 1099511627776 + y * 1048576 + x, img * 1099511627776 + y * 1048576 + x from nd
      union select e.b, min(r.root) from rc r join ed e on e.a = r.id join recurring.rc u on u.id = e.b where r.root < u.root group by e.b),
    cc as (select id // 1099511627776 as img, id // 1048576 % 1048576 as y, id % 1048576 as x, root from rc)"""


_EIGHT = "(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)"
_FOUR = "(-1, 0), (0, -1), (0, 1), (1, 0)"
_BRIGHT = "select distinct img, y, x from px where v > 45000"
_FOCUS = PX + """,
    fd as (select img, c, y, x, max(v) as v from px group by 1, 2, 3, 4), ft as (select distinct img, c, y // 32 as ty, x // 32 as tx from fd),
    fg as (select ft.*, ft.ty * 32 + i as y, ft.tx * 32 + j as x, coalesce(fd.v, 0)::double as v
           from ft cross join range(32) a(i) cross join range(32) b(j) left join fd on fd.img = ft.img and fd.c = ft.c and fd.y = ft.ty * 32 + i and fd.x = ft.tx * 32 + j),
    fs as (select img, c, ty, tx, greatest(quantile_cont(v, 0.99) - quantile_cont(v, 0.01), 1.0) as scale from fg group by 1, 2, 3, 4),
    fk as (select list(w order by k) as w from (select k, exp(-0.5 * k * k) / sum(exp(-0.5 * k * k)) over () as w from range(-4, 5) r(k))),
    f1 as (select img, c, ty, tx, y, list(v order by x) as r from fg group by 1, 2, 3, 4, 5),
    f2 as (select img, c, ty, tx, y, unnest(range(1, 33)) as x, unnest(list_transform(range(1, 33), lambda j: list_sum(list_transform(range(1, 10), lambda k: w[k] * r[least(greatest(j + k - 5, 1), 32)])))) as v from f1, fk),
    f3 as (select img, c, ty, tx, x, list(v order by y) as r from f2 group by 1, 2, 3, 4, 5),
    f4 as (select img, c, ty, tx, x, unnest(range(1, 33)) as y, unnest(list_transform(range(1, 33), lambda j: list_sum(list_transform(range(1, 10), lambda k: w[k] * r[least(greatest(j + k - 5, 1), 32)])))) as v from f3, fk),
    f5 as (select *, coalesce(lag(v) over q, v) + coalesce(lead(v) over q, v) + coalesce(lag(v) over p, v) + coalesce(lead(v) over p, v) - 4 * v as lap
           from f4 window p as (partition by img, c, ty, tx, y order by x), q as (partition by img, c, ty, tx, x order by y)),
    fo as (select img, c, ty, tx, round(log10(var_pop(lap / scale) + 1e-12), 6) as focus from f5 join fs using (img, c, ty, tx) group by 1, 2, 3, 4)"""


def _z(rows: str, keys: str, value: str, name: str) -> str:
    """``rows`` with the robust score of a value within keys."""
    return f"""(select * exclude (md_, mad_), case when mad_ = 0 then 0.0 else round(({value} - md_) / (1.4826 * mad_), 6) end as {name}
        from (select *, median(abs({value} - md_)) over (partition by {keys}) as mad_ from (select *, median({value}) over (partition by {keys}) as md_ from {rows})))"""


_KIND = "case when tf >= 0.5 then 'tissue' when tf <= 0.02 and nf <= 0.02 then 'background' else 'mixed' end"
_FLAGS = _FOCUS + _KINDS[len(PX) :] + f""",
    kd as (select img, ty, tx, {_KIND} as kind from k), ti as (select img, ty, tx from kd where kind = 'tissue'),
    va as (select img, c, y // 32 as ty, x // 32 as tx, median(v) as median, quantile_cont(v, 0.999) as p99_9 from px group by 1, 2, 3, 4),
    ow as (select va.* from va join ti using (img, ty, tx)),
    fz as (select * from {_z("(select fo.* from fo join ti using (img, ty, tx) where c = 0)", "img", "focus", "focus_z")}),
    nz as (select * from {_z("(select * from ow where c = 0)", "img", "median", "nuclear_z")}),
    az as (select * from {_z("(select *, ln(1 + p99_9) as tail from ow where c <> 0)", "img, c", "tail", "z")}),
    th as (select img, c, v, count(*) as n from px where label >= 16 group by 1, 2, 3), tc as (select *, sum(n) over (partition by img, c order by v) / sum(n) over (partition by img, c) as share from th),
    tp as (select img, c, min(case when share >= 0.999 then v end) as top from tc group by 1, 2),
    ah as (select img, ty, tx, string_agg(c, ';' order by c) as channels from az join tp using (img, c) where z > 5 and p99_9 > top group by 1, 2, 3)"""
SQL = {
    "channel_histogram": f"with {PX} select img, c, v, count(*) as n from px group by 1, 2, 3",
    "channel_percentiles": f"""with {_HIST}{_CUM},
        p as (select img, c, {_pct(1, "p1")}, {_pct(50, "p50")}, {_pct(99, "p99")}, {_pct(99.9, "p99_9")} from cum group by 1, 2),
        s as (select img, c, max(v) as max, round(100.0 * sum(case when v = 0 then n else 0 end) / sum(n), 6) as pct_zero,
                     round(100.0 * sum(case when v = 65535 then n else 0 end) / sum(n), 6) as pct_saturated, cast(sum(n) as bigint) as n from h group by 1, 2)
        select img, c, max, pct_zero, pct_saturated, n, p1, p50, p99, p99_9,
               nullif(concat_ws('; ', case when pct_saturated > 0.1 then 'saturated' end, case when p99_9 <= p1 then 'no spread' end), '') as problem
        from s join p using (img, c)""",
    "channel_qc_flags": f"""with {PX},
        hi as (select img, c, v, count(*) as n from px where label % 4 <> 0 group by 1, 2, 3), ho as (select img, c, v, count(*) as n from px where label % 4 = 0 group by 1, 2, 3),
        ci as (select *, sum(n) over (partition by img, c order by v) / sum(n) over (partition by img, c) as share from hi),
        co as (select *, sum(n) over (partition by img, c order by v) / sum(n) over (partition by img, c) as share from ho),
        t as (select img, c, {_pct(50, "t50")}, {_pct(99, "t99")}, {_pct(99.9, "t99_9")} from ci group by 1, 2),
        b as (select img, c, {_pct(50, "b50")}, {_pct(99, "b99")} from co group by 1, 2),
        z as (select img, c, round(100.0 * sum(case when v = 0 then n else 0 end) / sum(n), 6) as zero,
                     round(100.0 * sum(case when v = 65535 then n else 0 end) / sum(n), 6) as saturated from hi group by 1, 2),
        tl as (select img, c, y // 32 as ty, x // 32 as tx, median(v) as m from px where label % 4 = 0 group by 1, 2, 3, 4),
        se as (select img, c, case when count(m) >= 10 then round(quantile_cont(m, 0.9) - quantile_cont(m, 0.1), 6) end as seam from tl group by 1, 2),
        j as (select * from t join z using (img, c) left join b using (img, c) left join se using (img, c)),
        k as (select *, coalesce(t99_9 <= b99 + greatest(b99 - b50, 1), false) as dead from j)
        select img, c, t50, t99, t99_9, b50, b99, zero, saturated, seam, concat_ws('; ',
          case when dead then 'no usable signal' end, case when not dead and zero > 50 and b99 <= 0 then 'many zeros in tissue' end,
          case when not dead and b50 >= 0.5 * greatest(t50, 1) and b50 >= 0.1 * t99 then 'bright off-tissue background' end,
          case when not dead and b50 is not null and t99 / greatest(b50, 1) < 2 then 'weak (p99 < 2x background)' end,
          case when seam > greatest(2.0, 0.25 * greatest(t99 - t50, 1)) then 'uneven background (possible seams)' end,
          case when saturated > 0.1 then 'saturated >0.1%' end) as flags from k""",
    "tile_robust_z": f"with {_TILES} select * from z",
    "tile_kinds": f"""with {_KINDS} select img, ty, tx, round(tf, 6) as tissue_fraction, round(nf, 6) as nodata_fraction,
        case when tf >= 0.5 then 'tissue' when tf <= 0.02 and nf <= 0.02 then 'background' else 'mixed' end as kind from k""",
    "tile_focus": f"with {_FOCUS} select * from fo",
    "tile_flags": f"""with {_FLAGS} select img, ty, tx, kind, focus_z, nuclear_z, concat_ws(';', case when focus_z < -3.5 then 'focus' end, case when nuclear_z > 3.5 then 'fold' end) as flags,
        coalesce(channels, '') as aggregate_channels from kd left join fz using (img, ty, tx) left join nz using (img, ty, tx) left join ah using (img, ty, tx) where kind <> 'mixed'""",
    "flagged_channels": f"""with {PX}, t as (select img, c, y // 32 as ty, x // 32 as tx, quantile_cont(v, 0.999) as p from px group by 1, 2, 3, 4), u as (select img, c, quantile_cont(v, 0.999) as top from px group by 1, 2)
        select img, ty, tx, string_agg('ch' || c, ';' order by c) as channels from t join u using (img, c) where p >= top group by 1, 2, 3""",
    "components": f"""with recursive {PX}, {_components(_BRIGHT, _EIGHT)}, p as (select img, root, count(*) as n, min(y) as y0 from cc group by 1, 2)
        select img, row_number() over (partition by img order by root)::int as label, n, y0 from p""",
    "small_objects_removed": f"""with recursive {PX}, {_components(_BRIGHT, _EIGHT)}, p as (select *, count(*) over (partition by root) as k from cc),
        r as (select *, lag(x) over (partition by img, y order by x) as before from p where k >= 4)
        select img, count(*) filter (before is null or before < x - 1) as spans, count(*) as n from r group by 1""",
    "filled_holes": f"""with recursive {PX}, bg as (select i.img, y, x from (select distinct img from px) i cross join range(256) a(y) cross join range(256) b(x)
          where not exists (select 1 from px where px.v > 9000 and px.img = i.img and px.y = a.y and px.x = b.x)),
        re as (select img, y, x, y as v, x as u, 0 as step from bg
          union select re.img, re.y, re.x, bg.y, bg.x, step + 1 from re, (values {_FOUR}) d(dy, dx), bg where step < 6 and bg.img = re.img and bg.y = re.v + dy and bg.x = re.u + dx)
        select img, y, x from re group by 1, 2, 3 having count(distinct v * 256 + u) <= 6 and not bool_or(v in (0, 255) or u in (0, 255))""",
    "order_groups": """with recursive t as (select distinct l_partkey * 2 as a, l_suppkey * 2 + 1 as b from lineitem), e as (select a, b from t union all select b, a from t),
        rc(id, root) using key (id) as (select id, id from (select distinct a as id from e)
          union select e.b, min(r.root) from rc r join e on e.a = r.id join recurring.rc u on u.id = e.b where r.root < u.root group by e.b)
        select root, count(*) as n from rc group by 1""",
    "distance_to_background": f"""with {PX}, m as (select img, y, x, max(v) > 20000 as inside from px group by 1, 2, 3),
        g as (select i.img, y, x, case when m.inside = false then x end as o from (select distinct img from m) i cross join range(256) a(y) cross join range(256) b(x) left join m using (img, y, x)),
        w as (select img, y, x, least(coalesce(x - max(o) over (partition by img, y order by x), 9999), coalesce(min(o) over (partition by img, y order by x desc) - x, 9999)) as g from g)
        select m.img, m.y, m.x, round(sqrt(min((m.y - w.y) ** 2 + w.g ** 2)), 6) as d from m join w on w.img = m.img and w.x = m.x group by 1, 2, 3""",
    "worst_agreement_squares": f"""with {PX}, wa as (select distinct img, y, x, (y // 16) * 20 + x // 16 + 1 as label from px), wb as (select distinct img, y, x, ((y + 3) // 16) * 20 + (x + 3) // 16 + 1 as label from px),
        sa as (select img, label, count(*) as n, round(avg(y), 6) as cy, round(avg(x), 6) as cx from wa group by 1, 2), sb as (select img, label, count(*) as m from wb group by 1, 2),
        sh as (select img, label, count(*) as k from wa join wb using (img, y, x, label) group by 1, 2),
        ce as (select img, floor(cy / 64)::bigint as gy, floor(cx / 64)::bigint as gx, round(coalesce(k, 0) / (n + coalesce(m, 0) - coalesce(k, 0)), 6) as iou from sa left join sb using (img, label) left join sh using (img, label)),
        sq as (select img, gy, gx, count(*) as n, median(iou) as median_iou from ce group by 1, 2, 3 having count(*) >= 15)
        select * from (select *, row_number() over (partition by img order by median_iou, gy, gx)::int as rank from sq) where rank <= 3""",
    "worst_tiles_topk": f"with {_TILES} select img, c, ty, tx, z, abs(z) as severity from z order by abs(z) desc, img, c, ty, tx limit 8",
    "nodata_pixels": f"with {PX} select img, y, x from px group by 1, 2, 3 having max(case when v < 3000 then 0 else v end) = 0",
    "analysis_mask": f"""with {_KINDS}, p as (select distinct img, y, x, label from px), f as (select * from k where round(tf, 6) < 0.8),
        b as (select img, ty * 32 as y0, tx * 32 as x0, ty * 32 + 32 as y1, tx * 32 + 32 as x1 from f)
        select img, y, x from (select distinct img, y, x from p where label >= 8) s
        where not exists (select 1 from p where p.label = 63 and p.img = s.img and p.y = s.y and p.x = s.x)
          and not exists (select 1 from b where b.img = s.img and s.y between b.y0 and b.y1 and s.x between b.x0 and b.x1)""",
    "region_properties": f"""with {PX}, p as (select distinct img, label, y, x from px where label <> 0)
        select img, label, round_even(count(*) * 2.5e-7, 4) as area_mm2, round_even(avg(x) * 0.5, 1) as centroid_x_um, round_even(avg(y) * 0.5, 1) as centroid_y_um,
          concat_ws(',', cast(round_even(min(y) * 0.5, 0) as bigint), cast(round_even(min(x) * 0.5, 0) as bigint), cast(round_even((max(y) + 1) * 0.5, 0) as bigint), cast(round_even((max(x) + 1) * 0.5, 0) as bigint)) as bbox_um
        from p group by 1, 2""",
    "pooled_display_range": f"""with {PX}, q as (select 'ch' || c as marker, sample, case when sample = 'R' then 256 else 65536 end as bins, v from px),
        f as (select marker, min_by(bins, sample) as b from q group by 1),
        h as (select marker, v % bins as v, count(*) as n from q join f using (marker) where bins = b group by 1, 2),
        cum as (select *, sum(n) over (partition by marker order by v) / sum(n) over (partition by marker) as share from h),
        p as (select marker, {_pct(0.5, "lo")}, {_pct(99.9, "hi")} from cum group by 1)
        select marker, lo as display_low, greatest(hi, lo + 1) as display_high from p""",
    "membrane_composite": f"""with {PX}, q as (select img, c, y, x, min(v) as v from px group by 1, 2, 3, 4), h as (select c, v, count(*) as n from q group by 1, 2),
        cum as (select *, sum(n) over (partition by c order by v) / sum(n) over (partition by c) as share from h),
        p as (select c, {_pct(0.5, "lo")}, {_pct(99.9, "hi0")} from cum group by 1), r as (select c, lo, greatest(hi0, lo + 1) as hi from p)
        select img, y, x, round(avg(least(greatest((v - lo) / (hi - lo), 0), 1)), 6) as value from q join r using (c) group by 1, 2, 3""",
    "downsample_mean": f"with {PX} select img, c, y // 24 as by, x // 24 as bx, round(avg(v), 6) as mean from px where y < 240 and x < 240 group by 1, 2, 3, 4",
    "otsu_threshold": f"""with {_HIST},
        u as (select img, c, v, sum(n) over w::double as w1, sum(v * n) over w::double as s1, sum(n) over (partition by img, c)::double as w, sum(v * n) over (partition by img, c)::double as s
              from h where v > 0 window w as (partition by img, c order by v)),
        b as (select img, c, v, round(w1 / w * (1 - w1 / w) * (s1 / w1 - (s - s1) / (w - w1)) * (s1 / w1 - (s - s1) / (w - w1)), 3) as between_ from u where w1 < w)
        select img, c, arg_max(v, struct_pack(a := between_, b := -v)) as threshold from b group by 1, 2""",
    "label_spans": f"with {_SPANS} select * from runs",
    "label_stats": f"with {_STATS} select * from st",
    "span_label_overlap": f"with {_IOU} select * from o",
    "label_overlap_iou": f"with {_IOU} select * from i",
    "border_labels_dropped": f"""with {PX}, p as (select distinct img, y, x, (y // 40) * 8 + x // 40 + 1 as label from px)
        select img, label from p group by 1, 2 having min(y) > 0 and max(y) < 255 and min(x) > 0 and max(x) < 255""",
    "relabel_dense": f"with {_STATS} select img, label, cast(row_number() over (partition by img order by label) as int) as new_label from st where cx > 120",
    "cells_in_mask": f"""with {_STATS}, mask as (select distinct img, y // 8 as my, x // 8 as mx from px where v < 40000)
        select st.* from st where exists (select 1 from mask m where m.img = st.img and m.my = least(floor(cy / 8), 31) and m.mx = least(floor(cx / 8), 31))""",
    "roi_cut_cells": f"""with {_ONE}, w as (select * from (values ('R01', 0, 0, 100, 100), ('R02', 50, 60, 200, 256)) v(roi_id, y0, x0, y1, x1)),
        k as (select img, label, roi_id, count(*) as n_crop from pa, w where label <> 0 and y >= y0 and y < y1 and x >= x0 and x < x1 group by 1, 2, 3),
        a as (select img, label, count(*) as n_whole from pa where label <> 0 group by 1, 2)
        select img, label, roi_id, n_crop, n_whole from k join a using (img, label) where n_crop < n_whole""",
    "dilated_labels": f"""with {_ONE}, d as (select * from (values (-2), (-1), (0), (1), (2)) v(dy), (values (-2), (-1), (0), (1), (2)) u(dx) where abs(dy) + abs(dx) <= 2)
        select img, label, count(*) as n from (select distinct img, label, y + dy as y, x + dx as x from pa, d where label <> 0)
        where y between 0 and 255 and x between 0 and 255 group by 1, 2""",
    "expanded_labels": f"""with {_ONE}, d as (select * from (values (-2), (-1), (0), (1), (2)) v(dy), (values (-2), (-1), (0), (1), (2)) u(dx) where dy * dy + dx * dx <= 4)
        select img, y + dy as y, x + dx as x, min_by(label, struct_pack(a := dy * dy + dx * dx, b := label)) as label from pa, d
        where label <> 0 and y + dy between 0 and 255 and x + dx between 0 and 255 group by 1, 2, 3""",
    "raster_check": f"with {PX} select img, count(*) as n_pixels, count(distinct case when label <> 0 then label end) as n_labels, bool_or(label = 0) as has_background from px group by 1",
    "f1_sweep": f"""with {_IOU}, best as (select * from (select *, row_number() over (partition by img, a order by iou desc, b) as r from i) where r = 1),
        g as (select img, count(distinct a) as ng, count(distinct b) as np from i group by 1), t as (select * from (values (0.005), (0.01), (0.02)) v(threshold)),
        k as (select g.*, t.threshold::double as threshold, (select count(*) from best where best.img = g.img and best.iou >= t.threshold) as tp from g, t)
        select img, threshold, tp, np - tp as fp, ng - tp as fn, round(tp / np, 6) as precision, round(tp / ng, 6) as recall, round(2 * tp / (ng + np), 6) as f1 from k""",
    "method_area_ratio": f"""with {_ONE}, na as (select img, label, count(*) as a from pa where label <> 0 group by 1, 2), nb as (select img, label, count(*) as b from pb where label <> 0 group by 1, 2)
        select img, label, a, b, round(a / b, 6) as ratio from na full join nb using (img, label)""",
    "method_summary": f"""with {_STATS} select img, count(*) as n, round(quantile_cont(n, 0.5), 6) as median_area, round(quantile_cont(n, 0.25), 6) as p25,
        round(quantile_cont(n, 0.75), 6) as p75, round(2 * sqrt(median(n) / pi()), 6) as diameter from st group by 1""",
}
