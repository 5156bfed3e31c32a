"""Queries over sheets: validation, channel matching, marker maps, checks, provenance, and streams of counts."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slideloom.operators import report, sheets
from slideloom.session import shared_folder, table
from slideloom.streaming import merge_histograms, stored_histograms


def panel_problems(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.panel_problems(table(spark, folder, "panels"), "panel_row_id", "panel")


def sample_problems(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.sample_problems(table(spark, folder, "samples"), ["sample_id", "image"])


def panels_without_nucleus(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.panels_without_nucleus(table(spark, folder, "panels"), "panel")


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    """(row, marker, aliases, ...): the marker map as a panel; aliases are two other ways to write a name."""
    m = table(spark, folder, "marker_map")  # a fixed, small number of rows
    aliases = F.concat("Marker", F.lit(";"), F.regexp_replace("Marker_orig", "-", "_x"))
    return m.select(
        F.row_number().over(Window.orderBy("Marker")).alias("row"), F.col("Marker_orig").alias("marker"), aliases.alias("aliases"),
        F.lit("lineage").alias("role"), F.lit("").alias("segmentation"), F.lit("ok").alias("status"), F.coalesce("Expected_Expression", F.lit("")).alias("notes"),
    )


def _channels(spark: SparkSession, folder: str) -> DataFrame:
    """(img, index, image_name): the markers of each panel sheet as typed, as channels of an image."""
    p = table(spark, folder, "panels").where("panel is not null and marker is not null")
    return p.select(F.col("panel").alias("img"), (F.row_number().over(Window.partitionBy("panel").orderBy("panel_row_id")) - 1).alias("index"), F.col("marker").alias("image_name"))


def channel_match(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.matched_channels(_channels(spark, folder), _panel(spark, folder))


def channel_table(spark: SparkSession, folder: str) -> DataFrame:
    panel = _panel(spark, folder)
    return sheets.channel_table(sheets.matched_channels(_channels(spark, folder), panel), panel)


def doubly_matched_channels(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.doubly_matched(channel_match(spark, folder))


def unmatched_markers(spark: SparkSession, folder: str) -> DataFrame:
    panel = _panel(spark, folder)
    return sheets.missing_markers(sheets.matched_channels(_channels(spark, folder), panel), panel)


def marker_map_lint(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.marker_map_lint(table(spark, folder, "marker_map"), table(spark, folder, "panels"))


def name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Typed markers that cleaning makes equal."""
    return sheets.name_collisions(table(spark, folder, "panels"), "marker")


def selected_samples(spark: SparkSession, folder: str) -> DataFrame:
    wanted = table(spark, folder, "roi_targets")
    return sheets.selected(table(spark, folder, "samples").where("sample_id is not null"), wanted).groupBy("sample_id").agg(F.count("*").alias("n_rows"))


def unknown_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with cells but without a row of their own that names a panel."""
    wanted = table(spark, folder, "cells").select(F.col("image").alias("sample_id"))
    return sheets.unknown(table(spark, folder, "samples").where("panel is not null and length(sample_id) > 8"), wanted)


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    """(sample_id, seq, level, text): one check per ROI as proposed: no count, few cells, low occupancy, or none of these."""
    r = table(spark, folder, "rois").dropDuplicates()
    level = F.when(F.col("n_cells").isNull(), "fail").when(F.col("n_cells") < 600, "warn").when(F.col("occupancy") < 0.7, "info").otherwise("ok")
    return r.select("sample_id", F.concat("roi_id", F.lit("@"), F.date_format("proposed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("seq"), level.alias("level"), F.col("roi_id").alias("text"))


def check_summary(spark: SparkSession, folder: str) -> DataFrame:
    return report.check_summary(_checks(spark, folder))


def ordered_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All checks of each sample, gravest first."""
    return report.ordered_checks(_checks(spark, folder)).select("sample_id", "seq", "level", "position")


def cell_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return report.provenance(table(spark, folder, "cells"), ["image"])


def sampled_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells per image in a hashed sample of a twentieth of them."""
    keyed = table(spark, folder, "cells").withColumn("key", F.concat_ws("/", "image", "cellID"))
    return report.hashed_sample(keyed, "key", 0.05, 20).groupBy("image").agg(F.count("*").alias("n"))


def streamed_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of lines per supplier kept by a stream that reads the table in micro-batches."""
    lines = f"{folder}/lineitem.parquet*"  # a file or a folder of files
    stream = spark.readStream.schema(table(spark, folder, "lineitem").schema).parquet(lines)
    at = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    pixels = stream.select(F.col("l_suppkey").alias("c"), F.col("l_quantity").cast("bigint").alias("v"))
    merge_histograms(pixels, ["c"], f"{at}/store", f"{at}/state").awaitTermination()
    return stored_histograms(spark, f"{at}/store")


QUERIES = {
    f.__name__: f
    for f in (
        panel_problems, sample_problems, panels_without_nucleus, channel_match, channel_table, doubly_matched_channels, unmatched_markers, marker_map_lint, name_collisions,
        selected_samples, unknown_samples, check_summary, ordered_checks, cell_fingerprints, sampled_cells,
        streamed_histogram,
    )
}

_WS = r"[\s\p{Z}\x1c-\x1f\x85]+"
_STRIP = lambda c: f"coalesce(regexp_replace(regexp_replace({c}, '^{_WS}', ''), '{_WS}$', ''), '')"
_NORM = lambda c: rf"regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]', '', 'g')"
_MATCH = f"""
    pn as (select row_number() over (order by Marker) as row, Marker_orig as marker, Marker || ';' || regexp_replace(Marker_orig, '-', '_x', 'g') as aliases, coalesce(Expected_Expression, '') as notes from marker_map),
    nm as (select row, marker, 0 as pos, marker as name from pn
           union all select row, marker, pos, string_split(aliases, ';')[pos] as name from (select *, unnest(range(1, len(string_split(aliases, ';')) + 1)) as pos from pn)),
    nn as (select *, {_NORM("name")} as norm from nm), nf as (select * from (select *, row_number() over (partition by norm order by row, pos) as k from nn where norm <> '') where k = 1),
    ch as (select panel as img, row_number() over (partition by panel order by panel_row_id) - 1 as index, marker as image_name from panels where panel is not null and marker is not null),
    fo as (select ch.*, nf.marker, case when pos = 0 then 'exact' when pos > 0 then 'alias' end as how from ch left join nf on {_NORM("ch.image_name")} = nf.norm),
    no as (select img, count(marker) = 0 and count(*) = (select count(*) from pn) as by_order from fo group by 1),
    ma as (select fo.img, fo.index, image_name, case when by_order then pn.marker else fo.marker end as marker, case when by_order then 'order' else coalesce(how, 'unmatched') end as how
           from fo join no using (img) left join pn on pn.row - 1 = fo.index)"""
_CHECKS = """
    ck as (select sample_id, roi_id || '@' || strftime(proposed_at, '%Y-%m-%d %H:%M:%S.%f') as seq,
                  case when n_cells is null then 'fail' when n_cells < 600 then 'warn' when occupancy < 0.7 then 'info' else 'ok' end as level from (select distinct * from rois))"""
SQL = {
    "streamed_histogram": "select l_suppkey as c, l_quantity::bigint as v, count(*) as n from lineitem group by 1, 2",
    "panel_problems": f"""with t as (select panel_row_id, panel, {_STRIP("marker")} as marker, lower({_STRIP("role")}) as role, lower({_STRIP("segmentation")}) as segmentation,
          case when {_STRIP("status")} = '' then 'ok' else lower({_STRIP("status")}) end as status from panels),
        d as (select *, {_NORM("marker")} as norm from t), c as (select panel, norm from d where norm <> '' group by 1, 2 having count(*) > 1)
        select panel_row_id, panel, 'marker is empty' as problem from d where marker = '' union all
        select panel_row_id, panel, 'unknown role' from d where role not in ('nuclear', 'lineage', 'state', 'structural', 'exclude') union all
        select panel_row_id, panel, 'unknown segmentation' from d where segmentation not in ('nuclear', 'membrane', '') union all
        select panel_row_id, panel, 'unknown status' from d where status not in ('ok', 'failed', 'unconfirmed') union all
        select panel_row_id, panel, 'duplicate marker' from d join c using (panel, norm)""",
    "sample_problems": f"""with t as (select {_STRIP("sample_id")} as sample_id, {_STRIP("image")} as image, {_STRIP("species")} as species, {_STRIP("panel")} as panel, {_STRIP("pixel_size_um")} as px from samples),
        c as (select sample_id from t where sample_id <> '' group by 1 having count(*) > 1)
        select sample_id, image, 'sample_id is empty' as problem from t where sample_id = '' union all
        select sample_id, image, 'sample_id holds space or path signs' from t where regexp_matches(sample_id, '[\\s/\\\\:*?"<>|]') union all
        select sample_id, image, 'image is empty' from t where image = '' union all select sample_id, image, 'panel is empty' from t where panel = '' union all
        select sample_id, image, 'unknown species' from t where lower(species) not in ('human', 'mouse', 'canine') union all
        select sample_id, image, 'bad pixel size' from t where px <> '' and not coalesce(try_cast(px as double) between 0.05 and 5, false) union all
        select sample_id, image, 'duplicate sample_id' from t join c using (sample_id)""",
    "panels_without_nucleus": f"""select panel from panels group by 1 having not bool_or(lower({_STRIP("segmentation")}) = 'nuclear' and lower({_STRIP("status")}) in ('ok', ''))""",
    "channel_match": f"with {_MATCH} select img, index::int as index, image_name, marker, how from ma",
    "channel_table": f"""with {_MATCH} select coalesce(ma.marker, '') as marker, img, index::int as index, image_name, how, case when pn.marker is null then '' else 'lineage' end as role, '' as segmentation,
        case when pn.marker is null then '' else 'ok' end as status, coalesce(pn.notes, '') as notes from ma left join pn using (marker)""",
    "doubly_matched_channels": f"with {_MATCH} select img, marker, count(*) as n from ma where marker is not null group by 1, 2 having count(*) > 1",
    "unmatched_markers": f"with {_MATCH} select img, pn.marker from (select distinct img from ma), pn where (img, pn.marker) not in (select (img, marker) from ma where marker is not null)",
    "marker_map_lint": f"""with m as (select Marker, lower({_STRIP("Marker_orig")}) as name, Lineage from marker_map), u as (select distinct lower({_STRIP("marker")}) as name from panels where {_STRIP("marker")} <> '')
        select Marker as name, 'duplicate' as problem from m group by 1 having count(*) > 1 union all
        select Marker, 'bad name' from m where not regexp_full_match(Marker, '[A-Za-z0-9_]*') union all select Marker, 'bad lineage' from m where Lineage not in (0, 1) union all
        select name, 'unused' from (select distinct name from m) where name not in (select name from u) union all select name, 'not in map' from u where name not in (select name from m)""",
    "name_collisions": "select cleaned, count(*) as n from (select distinct marker, regexp_replace(marker, '[^A-Za-z0-9_]', '', 'g') as cleaned from panels where marker is not null) group by 1 having count(*) > 1",
    "selected_samples": "select sample_id, count(*) as n_rows from samples where sample_id in (select sample_id from roi_targets) group by 1",
    "unknown_samples": "select distinct image as sample_id from cells where image not in (select sample_id from samples where panel is not null and length(sample_id) > 8)",
    "check_summary": f"""with {_CHECKS} select sample_id, count(*) filter (level = 'fail') as fail, count(*) filter (level = 'warn') as warn, count(*) filter (level = 'info') as info,
        count(*) filter (level = 'ok') as ok, count(*) filter (level = 'fail') = 0 as passed from ck group by 1""",
    "ordered_checks": f"""with {_CHECKS}, o as (select *, row_number() over (partition by sample_id order by list_position(['fail', 'warn', 'info', 'ok'], level), seq)::int as position from ck)
        select sample_id, seq, level, position from o""",
}
