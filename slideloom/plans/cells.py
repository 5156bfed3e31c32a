"""Queries over cells, drawn shapes and regions of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slideloom.operators import compare, hist, regions, report, rois, score, spatial
from slideloom.session import table
from slideloom.sources import sinks

#: um per pixel assumed for the cell tables, and the priority of classes, later ones first.
PX_UM = 0.5
PRIORITY = ("Normal", "Stroma", "Necrosis", "Tumor")


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    """(img, id, x, y, region): each cell once, at its place, with the region of its latest export."""
    c = table(spark, folder, "cells").where("x_px is not null and y_px is not null and not isnan(x_px) and not isnan(y_px)")
    last = c.groupBy("image", "cellID").agg(F.max(F.struct("exported_at", "region", "x_px", "y_px")).alias("l"))
    region = F.coalesce(F.nullif(F.initcap(F.lower(F.trim("l.region"))), F.lit("")), F.lit("Unassigned"))
    return last.select(F.col("image").alias("img"), F.col("cellID").alias("id"), F.col("l.x_px").alias("x"), F.col("l.y_px").alias("y"), region.alias("region"))


def _points(spark: SparkSession, folder: str, x: int, y: int) -> DataFrame:
    """(img, id, x, y): points of two components of the embeddings, one image per label."""
    at = lambda k: (F.get("embedding", F.lit(k)).cast("double") * 1000 + 1000)
    return table(spark, folder, "embeddings").select(F.col("label").alias("img"), F.col("vec_id").alias("id"), at(x).alias("x"), at(y).alias("y"))


def _shifts(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values (1, 40.0D, 15.0D), (2, -25.0D, 30.0D), (3, 12.0D, -44.0D), (4, -33.0D, -18.0D) as t(shift, dx, dy)")


def radius_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.neighbours(_cells(spark, folder), 10.0, ["img"])


def neighbour_counts(spark: SparkSession, folder: str) -> DataFrame:
    n = radius_neighbours(spark, folder)
    return n.groupBy(F.least("neighbours", F.lit(8)).alias("neighbours")).agg(F.count("*").alias("n"))


def knn3_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = spatial.nearest(_points(spark, folder, 0, 1), _points(spark, folder, 2, 3), 3, 60.0, ["img"])
    return found.withColumn("d", F.round("d", 6))


def nearest_residual(spark: SparkSession, folder: str) -> DataFrame:
    """The median distance of each image's points from the nearest of the other set."""
    one = spatial.nearest(_points(spark, folder, 0, 1), _points(spark, folder, 2, 3), 1, 60.0, ["img"])
    return one.groupBy("img").agg(F.count("*").alias("n"), F.round(F.median("d"), 6).alias("median_d"))


def greedy_match(spark: SparkSession, folder: str) -> DataFrame:
    found = spatial.matched(_points(spark, folder, 0, 1), _points(spark, folder, 2, 3), 60.0, ["img"])
    return found.withColumn("d", F.round("d", 6))


def chance_rate(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.chance_rate(_points(spark, folder, 0, 1), _points(spark, folder, 2, 3), 60.0, _shifts(spark), ["img"])


def best_shift(spark: SparkSession, folder: str) -> DataFrame:
    ref, ours = _points(spark, folder, 0, 1), _points(spark, folder, 2, 3)
    return spatial.best_shift(spatial.shift_votes(ref, ours, 80.0, 10.0, ["img"]), ["img"])


def score_points(spark: SparkSession, folder: str) -> DataFrame:
    return score.score_points(_points(spark, folder, 0, 1), _points(spark, folder, 2, 3), 60.0, ["img"], _shifts(spark))


def reference_found_rate(spark: SparkSession, folder: str) -> DataFrame:
    ref, ours = _points(spark, folder, 0, 1), _points(spark, folder, 2, 3)
    matches = compare.reference_matches(ref, ours, 60.0, 40.0, ["img"])
    return compare.reference_rates(matches, spatial.chance_rate(ref, ours, 60.0, _shifts(spark), ["img"]), ["img"])


def found_by_crowding(spark: SparkSession, folder: str) -> DataFrame:
    """Share of points with another set's point within the radius, by number of neighbours."""
    ref, ours = _points(spark, folder, 0, 1), _points(spark, folder, 2, 3)
    hit = spatial.within(ref, ours, 30.0, ["img"]).select("img", F.col("a").alias("id")).distinct().withColumn("found", F.lit(True))
    crowd = spatial.neighbours(ref, 60.0, ["img"]).join(hit, ["img", "id"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return spatial.found_rate(crowd)


def miss_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    ref, ours = _points(spark, folder, 0, 1), _points(spark, folder, 2, 3)
    hit = spatial.within(ref, ours, 30.0, ["img"]).select("img", F.col("a").alias("id")).distinct().withColumn("found", F.lit(True))
    crowd = spatial.neighbours(ref, 60.0, ["img"]).join(hit, ["img", "id"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return report.misses(crowd.withColumn("value", F.col("id") % 4096), ["img"], 4000)


def score_points_per_field(spark: SparkSession, folder: str) -> DataFrame:
    """Points scored within each field of the plane, those near its border left out on both sides."""
    size, margin = 400.0, 20.0

    def inner(points: DataFrame) -> DataFrame:
        named = points.withColumn("field", F.floor(F.col("x") / size) * 100 + F.floor(F.col("y") / size))
        off = lambda c: F.pmod(F.col(c), F.lit(size))
        return named.where((off("x") > margin) & (off("x") < size - margin) & (off("y") > margin) & (off("y") < size - margin))

    return score.score_points(inner(_points(spark, folder, 0, 1)), inner(_points(spark, folder, 2, 3)), 60.0, ["img", "field"])


def display_script(spark: SparkSession, folder: str) -> DataFrame:
    """The range of distances between cells and the origin, as a script with one line per image."""
    c = _cells(spark, folder).select(F.col("img").alias("marker"), F.floor(F.col("x")).cast("bigint").alias("v"))
    return sinks.display_script(hist.display_range(hist.histogram(c, ["marker"]), ["marker"]))


def point_map(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.point_map(_cells(spark, folder), 500.0, ["img"])


def crowded_squares_topk(spark: SparkSession, folder: str) -> DataFrame:
    return point_map(spark, folder).orderBy(F.desc("n"), "img", "by", "bx").limit(20)


def region_cell_density(spark: SparkSession, folder: str) -> DataFrame:
    """Cells per region of each image, over the area that its squares with cells cover."""
    c = _cells(spark, folder)
    area = c.groupBy("img", "region", F.floor(F.col("x") / 100).alias("a"), F.floor(F.col("y") / 100).alias("b")).count()
    area = area.groupBy("img", "region").agg((F.count("*") * (100 * PX_UM) ** 2 / 1e6).alias("area_mm2"))
    return report.density(c, area, ["img", "region"])


def main_region(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.most_common(_cells(spark, folder), ["img"], "region")


def region_assign(spark: SparkSession, folder: str) -> DataFrame:
    """Each cell's region by the shapes that hold it, with one column per class."""
    found = regions.assigned(table(spark, folder, "cells"), table(spark, folder, "shapes"), PRIORITY)
    return regions.one_hot(found, PRIORITY)


def region_distance(spark: SparkSession, folder: str) -> DataFrame:
    return regions.signed_distance(table(spark, folder, "cells"), table(spark, folder, "shapes"), "Tumor", PX_UM, 25.0)


def region_distance_of_all(spark: SparkSession, folder: str) -> DataFrame:
    """The distance of every cell from the border of all Tumor shapes together."""
    return regions.signed_distance_of_all(table(spark, folder, "cells"), table(spark, folder, "shapes"), "Tumor", PX_UM, 25.0)


def shape_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.ring_centroids(table(spark, folder, "shapes"))


def shape_windows(spark: SparkSession, folder: str) -> DataFrame:
    return regions.windows(table(spark, folder, "shapes"), 2)


def shape_raster(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels of each shape on a raster reduced 16 times, later shapes over earlier ones."""
    shapes = table(spark, folder, "shapes").withColumn("_order", F.col("shape_id"))
    runs = regions.filled(shapes, 16.0, "_order", holes_clear=True)
    shown = regions.painted(runs, "_order", "ring")
    return shown.groupBy("image", "shape_id").agg(F.count("*").alias("n"))


def roi_tiles_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return rois.tile_cells(_cells(spark, folder), 1000.0, ["img"])


def region_mix_stratum(spark: SparkSession, folder: str) -> DataFrame:
    c = _cells(spark, folder).withColumn("y0", F.floor(F.col("y") / 1000).cast("bigint") * 1000).withColumn("x0", F.floor(F.col("x") / 1000).cast("bigint") * 1000)
    return rois.strata(rois.region_shares(c, ["img", "y0", "x0"]), ["img", "y0", "x0"], "Tumor")


def roi_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """ROIs proposed for each image: eligible tiles, dealt over strata, with roles and names."""
    keys = ["img", "y0", "x0"]
    tiles = rois.eligible(roi_tiles_occupancy(spark, folder), 0.5, 200).join(region_mix_stratum(spark, folder), keys)
    wanted = rois.wanted_number(tiles, ["img"], 6000)
    order = [F.expr("(y0 * 7919 + x0 * 104729) % 10007"), "y0", "x0"]
    chosen = rois.allocated(tiles, ["img"], order, wanted)
    return rois.named(rois.with_roles(chosen, ["img"], order, 0.2), "img")


def roi_cross_tab(spark: SparkSession, folder: str) -> DataFrame:
    return rois.cross_tab(roi_allocation(spark, folder), ["img"])


def geojson_export(spark: SparkSession, folder: str) -> DataFrame:
    chosen = roi_allocation(spark, folder).withColumn("y1", F.col("y0") + 1000).withColumn("x1", F.col("x0") + 1000)
    return rois.geojson(chosen, "img")


def roi_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Old ROIs of all samples, with those of one in three proposed and in part made anew."""
    r = table(spark, folder, "rois").groupBy("sample_id", "roi_id").agg(F.max("proposed_at").alias("at"), F.max("n_cells").alias("n_cells"))
    number = F.regexp_extract("roi_id", r"R(\d+)$", 1).cast("int")
    again = r.where(F.length("sample_id") % 2 == 0)
    proposed = again.where(number % 5 != 0).select("sample_id", "roi_id")
    new = again.where(number % 3 == 1).where(number % 5 != 0).withColumn("n_cells", F.col("n_cells") + 1)
    return rois.upserted(r, new, proposed).select("sample_id", "roi_id", "n_cells")


def roi_stale(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "rois").select("sample_id", "roi_id").distinct()
    number = F.regexp_extract("roi_id", r"R(\d+)$", 1).cast("int")
    return rois.stale(r, r.where(number % 5 != 0))


def tile_grid(spark: SparkSession, folder: str) -> DataFrame:
    size = _cells(spark, folder).groupBy("img").agg(F.floor(F.max("y") + 1).cast("int").alias("h"), F.floor(F.max("x") + 1).cast("int").alias("w"))
    clipped = rois.tile_grid(size, 512, whole_only=False).withColumn("kind", F.lit("clipped"))
    return clipped.unionByName(rois.tile_grid(size, 512, whole_only=True).withColumn("kind", F.lit("whole")))


def weighted_share(spark: SparkSession, folder: str) -> DataFrame:
    """The mean tumour share of each sample's ROIs, weighted by their cells."""
    r = table(spark, folder, "rois").where("n_cells is not null and frac_tumor is not null")
    return report.weighted(r, ["sample_id"], "frac_tumor", "n_cells")


def region_counts(spark: SparkSession, folder: str) -> DataFrame:
    return report.counts(_cells(spark, folder), "img", "region")


QUERIES = {
    f.__name__: f
    for f in (
        radius_neighbours, neighbour_counts, knn3_candidates, nearest_residual, greedy_match, chance_rate, best_shift, score_points, score_points_per_field, display_script, reference_found_rate, found_by_crowding,
        miss_diagnostics, point_map, crowded_squares_topk, region_cell_density, main_region, region_assign, region_distance, region_distance_of_all, shape_centroids, shape_windows, shape_raster,
        roi_tiles_occupancy, region_mix_stratum, roi_allocation, roi_cross_tab, geojson_export, roi_upsert, roi_stale, tile_grid, weighted_share, region_counts,
    )
}

_C = """
    c as (select image as img, cellID as id, l.x_px as x, l.y_px as y,
                 coalesce(nullif(upper(substr(trim(l.region), 1, 1)) || lower(substr(trim(l.region), 2)), ''), 'Unassigned') as region
          from (select image, cellID, max(struct_pack(exported_at := exported_at, region := region, x_px := x_px, y_px := y_px)) as l
                from cells where x_px is not null and y_px is not null and not isnan(x_px) and not isnan(y_px) group by 1, 2))"""
_P = """
    p as (select label as img, vec_id as id, embedding[1]::double * 1000 + 1000 as x, embedding[2]::double * 1000 + 1000 as y from embeddings),
    q as (select label as img, vec_id as id, embedding[3]::double * 1000 + 1000 as x, embedding[4]::double * 1000 + 1000 as y from embeddings)"""
_KNN = _P + """,
    e as (select p.img, p.id as ref, q.id as ours, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) as d from p join q on p.img = q.img where (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 3600),
    k as (select *, row_number() over (partition by img, ref order by d, ours) as rank from e)"""
_NEAR = _C + """,
    g as (select *, floor(x / 10)::bigint as gx, floor(y / 10)::bigint as gy from c),
    h as (select img, id, x, y, gx + dx as gx, gy + dy as gy from g, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)),
    m as (select g.img, g.id, count(*) as k from g join h using (img, gx, gy) where g.id <> h.id and (g.x - h.x) ** 2 + (g.y - h.y) ** 2 <= 100 group by 1, 2),
    nb as (select c.img, c.id, coalesce(k, 0) as neighbours from c left join m using (img, id))"""
_CROWD = _P + """,
    hit as (select distinct p.img, p.id from p join q on p.img = q.img where (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 900),
    cr as (select a.img, a.id, count(b.id) as neighbours from p a left join p b on a.img = b.img and a.id <> b.id and (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 3600 group by 1, 2),
    f as (select cr.*, hit.id is not null as found from cr left join hit using (img, id))"""
_EDGES = """
    s as (select shape_id, image, upper(substr(trim(classification), 1, 1)) || lower(substr(trim(classification), 2)) as class, rings from shapes where len(rings[1]) >= 3),
    r as (select shape_id, image, class, ri, rings[ri] as ring from (select *, unnest(range(1, len(rings) + 1)) as ri from s)),
    e as (select shape_id, image, class, ri, ring[i].x as x1, ring[i].y as y1, ring[i % len(ring) + 1].x as x2, ring[i % len(ring) + 1].y as y2
          from (select *, unnest(range(1, len(ring) + 1)) as i from r where len(ring) >= 3)),
    bb as (select shape_id, image, min(x1) as a, max(x1) as b, min(y1) as c, max(y1) as d from e where ri = 1 group by 1, 2),
    cl as (select distinct image, cellID, x_px, y_px from cells where x_px is not null and y_px is not null and not isnan(x_px) and not isnan(y_px)),
    w as (select cl.*, bb.shape_id from cl join bb on cl.image = bb.image and x_px between bb.a and bb.b and y_px between bb.c and bb.d),
    o as (select w.image, cellID, w.shape_id, ri,
                 sum(((y1 > y_px) <> (y2 > y_px) and x_px < (x2 - x1) * (y_px - y1) / (case when y2 = y1 then 1 else y2 - y1 end) + x1)::int) % 2 as odd
          from w join e on w.shape_id = e.shape_id group by 1, 2, 3, 4),
    held as (select image, cellID, shape_id from o group by 1, 2, 3
             having max(case when ri = 1 then odd end) = 1 and coalesce(max(case when ri > 1 then odd end), 0) = 0)"""
_OCC = _C + """,
    sq as (select img, floor(y / 1000)::bigint * 1000 as y0, floor(x / 1000)::bigint * 1000 as x0,
                  least(floor((y - floor(y / 1000) * 1000) / 1000 * 10), 9)::int * 10 + least(floor((x - floor(x / 1000) * 1000) / 1000 * 10), 9)::int as s from c),
    occ as (select img, y0, x0, count(*) as n_cells, count(distinct s) / 100.0 as occupancy from sq group by 1, 2, 3)"""
_STRATA = """,
    sh0 as (select img, floor(y / 1000)::bigint * 1000 as y0, floor(x / 1000)::bigint * 1000 as x0, region, count(*) as n from c group by 1, 2, 3, 4),
    sh as (select *, round(n / sum(n) over (partition by img, y0, x0), 6) as share from sh0),
    fs as (select img, y0, x0, coalesce(max(case when region = 'Tumor' then share end), 0) as f, arg_min(region, struct_pack(a := -share, b := region)) as top from sh group by 1, 2, 3),
    st as (select img, y0, x0, case when f > 0 and least(f, 1 - f) >= 0.25 then 'interface' else top end as stratum from fs)"""
_ALLOC = _OCC + _STRATA + """,
    el as (select occ.*, stratum, (y0 * 7919 + x0 * 104729) % 10007 as r from occ join st using (img, y0, x0) where occupancy >= 0.5 and n_cells >= 200),
    wn as (select img, greatest(1, ceil(6000.0 / median(n_cells)))::bigint as wanted from el group by 1),
    ka as (select *, row_number() over (partition by img, stratum order by r, y0, x0) as k from el),
    ga as (select ka.*, row_number() over (partition by img order by k, stratum) as g from ka),
    ch as (select ga.* from ga join wn using (img) where g <= wanted),
    va as (select *, count(*) over (partition by img, stratum) as ns, row_number() over (partition by img, stratum order by r, y0, x0) as j from ch),
    al as (select img, y0, x0, n_cells, occupancy, stratum,
                  case when j <= (case when round_even(ns * 0.2, 0) = 0 and ns >= 3 then 1 else round_even(ns * 0.2, 0) end) then 'validation' else 'train' end as role,
                  img || '_R' || (case when row_number() over (partition by img order by y0, x0) < 10 then '0' else '' end) || row_number() over (partition by img order by y0, x0) as roi_id
           from va)"""
_UPSERT = """
    r as (select sample_id, roi_id, max(n_cells) as n_cells, regexp_extract(roi_id, 'R(\\d+)$', 1)::int as k from rois group by sample_id, roi_id)"""
_GRID = _C + """,
    z as (select img, floor(max(y) + 1)::int as h, floor(max(x) + 1)::int as w from c group by 1),
    t as (select img, h, w, unnest(range(0, h, 512))::int as y0 from z), u as (select *, unnest(range(0, w, 512))::int as x0 from t)"""


def _greedy(edges: str, keys: str) -> str:
    """``gr``: one-to-one pairs of ``edges``, nearest first: each round takes pairs that are first at both ends."""
    return f"""
    gr as (select *, false as chosen from ({edges}) union all
      select * exclude (a, b, taken), a = 1 and b = 1 as chosen from (
        select *, bool_or(a = 1 and b = 1) over (partition by {keys}, ref) or bool_or(a = 1 and b = 1) over (partition by {keys}, ours) as taken from (
          select * exclude (chosen), row_number() over (partition by {keys}, ref order by d, ref, ours) as a, row_number() over (partition by {keys}, ours order by d, ref, ours) as b
          from gr where not chosen)) where (a = 1 and b = 1) or not taken)"""


_SHIFTS = """,
    sf as (select * from (values (1, 40.0, 15.0), (2, -25.0, 30.0), (3, 12.0, -44.0), (4, -33.0, -18.0)) v(shift, dx, dy)),
    se as (select shift, p.img, p.id as ref, q.id as ours, sqrt((p.x + dx - q.x) ** 2 + (p.y + dy - q.y) ** 2) as d
           from p cross join sf join q on p.img = q.img where (p.x + dx - q.x) ** 2 + (p.y + dy - q.y) ** 2 <= 3600),
    sk as (select * exclude (r) from (select *, row_number() over (partition by img, shift, ref order by d, ours) as r from se) where r <= 3)"""
_SHIFTED = _P + _SHIFTS
_CHANCE = """
    cn as (select img, shift, count(*) as k from gr where chosen group by 1, 2), ca as (select img, shift, count(*) as n from p cross join sf group by 1, 2),
    cr as (select img, round(avg(coalesce(k, 0) / n), 6) as rate from ca left join cn using (img, shift) group by 1)"""
_FEATURE = """'{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[' || string_agg('[' || px || ',' || py || ']', ',' order by i) || ']]},"properties":{"objectType":"annotation","name":"'
    || roi_id || '","classification":{"name":"' || role || '","color":' || case when role = 'validation' then '[200,60,0]' else '[0,160,80]' end || '}}}'"""
SQL = {
    "display_script": f"""with {_C}, h as (select img as marker, floor(x)::bigint as v, count(*) as n from c group by 1, 2),
        cum as (select *, sum(n) over (partition by marker order by v) / sum(n) over (partition by marker) as share from h),
        p as (select marker, min(case when share >= 0.005 then v end) as lo, min(case when share >= 0.999 then v end) as hi from cum group by 1)
        select string_agg('setChannelDisplayRange("' || marker || '", ' || lo || ', ' || greatest(hi, lo + 1) || ')', chr(10) order by marker) as script from p""",
    "radius_neighbours": f"with {_NEAR} select * from nb",
    "neighbour_counts": f"with {_NEAR} select least(neighbours, 8) as neighbours, count(*) as n from nb group by 1",
    "knn3_candidates": f"with {_KNN} select img, ref, ours, round(d, 6) as d, rank::int as rank from k where rank <= 3",
    "nearest_residual": f"with {_KNN} select img, count(*) as n, round(median(d), 6) as median_d from k where rank = 1 group by 1",
    "greedy_match": f"""with recursive {_KNN}, {_greedy("select img, ref, ours, d from k where rank <= 3", "img")} select img, ref, ours, round(d, 6) as d from gr where chosen""",
    "chance_rate": f"""with recursive {_SHIFTED}, {_greedy("select img, shift, ref, ours, d from sk", "img, shift")}, {_CHANCE} select img, rate from cr""",
    "reference_found_rate": f"""with recursive {_KNN}{_SHIFTS}, {_greedy("select img, 0 as shift, ref, ours, d from k where rank <= 3 union all select img, shift, ref, ours, d from sk", "img, shift")},
        {_CHANCE.replace("where chosen", "where chosen and shift > 0")}, m as (select img, ref as id, d from gr where chosen and shift = 0),
        r as (select p.img, count(*) as n, round(avg((m.id is not null)::int), 6) as found_rate, round(median(d), 6) as median_d from p left join m on m.img = p.img and m.id = p.id group by 1)
        select img, n, found_rate, rate as chance, found_rate >= 3 * rate as trusted, median_d from r left join cr using (img)""",
    "geojson_export": f"""with {_ALLOC}, co as (select al.*, i, case when i in (2, 3) then x0 + 1000 else x0 end as px, case when i in (3, 4) then y0 + 1000 else y0 end as py from al cross join range(1, 6) r(i)),
        fe as (select img, roi_id, {_FEATURE} as feature from co group by img, roi_id, role)
        select img, '{{"type":"FeatureCollection","features":[' || string_agg(feature, ',' order by roi_id) || ']}}' as geojson from fe group by 1""",
    "best_shift": f"""with {_P}, v as (select p.img, round_even((q.x - p.x) / 10, 0)::int as dx, round_even((q.y - p.y) / 10, 0)::int as dy, count(*) as votes
        from p join q on p.img = q.img where (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 6400 group by 1, 2, 3)
        select img, dx, dy, votes from (select *, row_number() over (partition by img order by votes desc, dx * dx + dy * dy, dx, dy) as r from v) where r = 1""",
    "found_by_crowding": f"with {_CROWD} select least(neighbours, 8) as neighbours, count(*) as n, round(avg(found::int), 6) as rate from f group by 1",
    "miss_diagnostics": f"""with {_CROWD} select img, found, count(*) as n, median(id % 4096) as median_value, round(100 * avg((id % 4096 >= 4000)::int), 6) as pct_saturated,
        median(neighbours) as median_neighbours from f group by 1, 2""",
    "point_map": f'with {_C} select img, floor(y / 500)::bigint as by, floor(x / 500)::bigint as bx, count(*) as n from c group by 1, 2, 3',
    "crowded_squares_topk": f'with {_C} select img, floor(y / 500)::bigint as by, floor(x / 500)::bigint as bx, count(*) as n from c group by 1, 2, 3 order by n desc, 1, 2, 3 limit 20',
    "region_cell_density": f"""with {_C}, a as (select img, region, count(distinct struct_pack(a := floor(x / 100), b := floor(y / 100))) * 2500.0 / 1e6 as area_mm2 from c group by 1, 2),
        n as (select img, region, count(*) as n from c group by 1, 2) select img, region, n, area_mm2, round(n / area_mm2, 6) as per_mm2 from n join a using (img, region)""",
    "main_region": f"""with {_C}, n as (select img, region, count(*) as n from c group by 1, 2)
        select img, region, n from (select *, row_number() over (partition by img order by n desc, region) as r from n) where r = 1""",
    "region_assign": f"""with {_EDGES}, k as (select held.image, cellID, class, list_position(['Normal', 'Stroma', 'Necrosis', 'Tumor'], class) as p from held join s using (shape_id) where class <> ''),
        b as (select image, cellID, arg_max(class, struct_pack(a := coalesce(p, 0), b := class)) as region from k group by 1, 2),
        f as (select image, cellID, coalesce(region, 'Unassigned') as region from (select distinct image, cellID from cells) left join b using (image, cellID))
        select *, (region = 'Normal')::tinyint as in_Normal, (region = 'Stroma')::tinyint as in_Stroma, (region = 'Necrosis')::tinyint as in_Necrosis, (region = 'Tumor')::tinyint as in_Tumor from f""",
    "region_distance": f"""with {_EDGES}, te as (select * from e where class = 'Tumor'),
        cand as (select cl.image, cellID, x_px as x, y_px as y, x1, y1, x2 - x1 as dx, y2 - y1 as dy, (x2 - x1) ** 2 + (y2 - y1) ** 2 as l2 from cl join te on cl.image = te.image
                 and x_px between least(x1, x2) - 50 and greatest(x1, x2) + 50 and y_px between least(y1, y2) - 50 and greatest(y1, y2) + 50),
        tt as (select *, case when l2 = 0 then 0 else least(greatest(((x - x1) * dx + (y - y1) * dy) / l2, 0), 1) end as t from cand),
        dd as (select image, cellID, min(sqrt((x1 + t * dx - x) ** 2 + (y1 + t * dy - y) ** 2)) as d from tt group by 1, 2 having min(sqrt((x1 + t * dx - x) ** 2 + (y1 + t * dy - y) ** 2)) <= 50),
        ins as (select distinct held.image, cellID from held join s using (shape_id) where class = 'Tumor')
        select dd.image, dd.cellID, round_even(d * 0.5 * (case when ins.cellID is null then -1 else 1 end), 1) as signed_um, (d * 0.5 < 25)::tinyint as near_boundary
        from dd left join ins using (image, cellID)""",
    "shape_centroids": "select shape_id, round(avg(p.x), 6) as cx, round(avg(p.y), 6) as cy from (select shape_id, unnest(rings[1]) as p from shapes) group by 1",
    "shape_windows": """select shape_id, (floor(min(p.y)) - 2)::bigint as y0, (floor(min(p.x)) - 2)::bigint as x0, (ceil(max(p.y)) + 3)::bigint as y1, (ceil(max(p.x)) + 3)::bigint as x1
        from (select shape_id, unnest(rings[1]) as p from shapes) group by 1""",
    "roi_tiles_occupancy": f"with {_OCC} select img, y0, x0, n_cells, occupancy::double as occupancy from occ",
    "region_mix_stratum": f"with {_C}{_STRATA} select * from st",
    "roi_allocation": f"with {_ALLOC} select img, y0, x0, n_cells, occupancy::double as occupancy, stratum, role, roi_id from al",
    "roi_cross_tab": f"with {_ALLOC} select img, stratum, count(*) filter (role = 'train') as train, count(*) filter (role = 'validation') as validation from al group by 1, 2",
    "roi_upsert": f"""with {_UPSERT}, ag as (select * from r where length(sample_id) % 2 = 0), nw as (select * from ag where k % 3 = 1 and k % 5 <> 0)
        select sample_id, roi_id, n_cells from r where sample_id not in (select sample_id from ag where k % 5 <> 0)
        union all select sample_id, roi_id, n_cells from ag where k % 5 <> 0 and k % 3 <> 1 union all select sample_id, roi_id, n_cells + 1 from nw""",
    "roi_stale": f"with {_UPSERT} select sample_id, roi_id from r where k % 5 = 0 and sample_id in (select sample_id from r where k % 5 <> 0)",
    "tile_grid": f"""with {_GRID} select img, y0, x0, least(y0 + 512, h)::int as y1, least(x0 + 512, w)::int as x1, 'clipped' as kind from u
        union all select img, y0, x0, y0 + 512, x0 + 512, 'whole' from u where y0 + 512 <= h and x0 + 512 <= w""",
    "weighted_share": "select sample_id, round(sum(frac_tumor * n_cells) / sum(n_cells), 6) as frac_tumor from rois where n_cells is not null and frac_tumor is not null group by 1",
    "region_counts": f"with {_C} select img, region, count(*) as n from c group by 1, 2",
}
