"""Queries of the operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slideloom.llm import draw, markers, mojibake, pack, tokens
from slideloom.session import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return draw.unmet(table(spark, folder, "rois"), table(spark, folder, "roi_targets"))


def p2_draw(spark: SparkSession, folder: str) -> DataFrame:
    return draw.draw(table(spark, folder, "rois"), table(spark, folder, "roi_targets"))


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    return draw.report(table(spark, folder, "rois"), table(spark, folder, "roi_targets"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    found = markers.matched(table(spark, folder, "panels"), table(spark, folder, "marker_map"), "panel_row_id", "marker", "aliases", "Marker", "Marker_orig")
    return found.withColumnRenamed("Marker", "marker")


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return markers.misses(table(spark, folder, "panels"), p3_found(spark, folder), "panel_row_id", "marker")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode(table(spark, folder, "documents"))


def p6_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each text comes back whole from its ids."""
    documents = table(spark, folder, "documents")
    back = tokens.decode(tokens.encode(documents)).withColumnRenamed("text", "back")
    return documents.join(back, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("back")).alias("same"))


def p7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack.pack(tokens.lengths(table(spark, folder, "documents")), table(spark, folder, "container_sizes"))


def p7_usage(spark: SparkSession, folder: str) -> DataFrame:
    return pack.usage(tokens.lengths(table(spark, folder, "documents")), table(spark, folder, "container_sizes"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.repair(table(spark, folder, "documents")).where("garbled").select("doc_id")


def p8_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The garbled texts as restored."""
    return mojibake.repair(table(spark, folder, "documents")).where("garbled").select("doc_id", "restored")


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_draw, p2_report, p3_found, p3_unmatched, p6_ids, p6_round_trip, p7_packing, p7_usage, p8_found, p8_restored)
}
_TARGETS = """
    with last as (
      select sample_id, roi_id, max(struct_pack(p := proposed_at, n := n_cells, s := stratum, r := role)) as l
      from rois group by sample_id, roi_id),
    offered as (
      select sample_id, lower(trim(l.s)) as s, lower(trim(l.r)) as r, count(*) as k, sum(l.n) as cells
      from last where l.n is not null group by 1, 2, 3),
    told as (
      select t.*, coalesce(o.k, 0) as k, coalesce(o.cells, 0) as cells
      from roi_targets t left join offered o
        on o.sample_id = t.sample_id and o.s = lower(trim(t.stratum)) and o.r = lower(trim(t.role)))
"""
SQL = {
    "p2_found": _TARGETS + "select draw_id, stratum, role from told where cells < target_share * target_cells or k < min_rois",
    "p6_round_trip": "select doc_id, true as same from documents",
}
