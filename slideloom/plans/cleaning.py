"""Queries of the general data-cleaning operators: rejects, near places, packed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slideloom.operators.multivalue import split_values
from slideloom.operators.near import cells_near
from slideloom.operators.strict_load import PANEL_COLUMNS, SAMPLE_COLUMNS, load_sheet, rejected
from slideloom.plans.cells import _EDGES
from slideloom.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(table(spark, folder, "sheet_rows"))


def p1_samples_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return load_sheet(table(spark, folder, "sheet_rows"), "samples")


def p1_panels_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return load_sheet(table(spark, folder, "sheet_rows"), "panel")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return cells_near(table(spark, folder, "cells"), table(spark, folder, "shapes"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_values(table(spark, folder, "panels"), "panel_row_id", "aliases", "alias")


def p5_alias_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How often each alias is written, over all rows of all panels."""
    return p5_found(spark, folder).groupBy("alias").agg(F.count("*").alias("n_rows"))


QUERIES = {f.__name__: f for f in (p1_found, p1_samples_loaded, p1_panels_loaded, p4_found, p5_found, p5_alias_counts)}

_WS = r"[\s\p{Z}\x1c-\x1f\x85]"
_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"
_FIELD = '"(?:[^"]|"")*"|[^",]*'
_VALUE = lambda c: f"""{_STRIP(f"case when left({c}, 1) = '\"' then replace({c}[2:-2], '\"\"', '\"') else {c} end")}"""
_NAMED = lambda c: f"case when list_position(header, '{c}') is not null then {_VALUE(f'fields[list_position(header, {c!r})]')} end"
_RECORDS = f"""
    rw as (select *, regexp_replace(coalesce(record, ''), '\\r$', '') as rec from sheet_rows),
    fi as (select *, list_transform(regexp_extract_all(',' || rec, '(?s),(?:{_FIELD})'), lambda f: f[2:]) as fields, regexp_full_match(',' || rec, '(?s)(?:,(?:{_FIELD}))*') as well from rw),
    he as (select sheet_file, list_transform(min_by(fields, struct_pack(a := received_at is null, b := received_at, c := rec_id)), lambda f: lower({_VALUE("f")})) as header
           from fi where line_no = 1 group by 1),
    ju as (select fi.*, header, well and len(fields) = len(header) as fits from fi left join he using (sheet_file) where line_no > 1),
    va as (select *, {_NAMED("species")} as species, {_NAMED("sample_id")} as sample_id, {_NAMED("role")} as role from ju),
    re as (select *, case when not well then 'quoting' when not coalesce(fits, false) then 'column_count'
             when sheet_kind = 'samples' and (lower(species) not in ('human', 'mouse', 'canine') or sample_id = '' or regexp_matches(sample_id, '{_WS}|[/\\\\:*?"<>|]')) then 'value'
             when sheet_kind = 'panel' and lower(role) not in ('nuclear', 'lineage', 'state', 'structural', 'exclude') then 'value' end as reason from va)"""
_NEAR = f"""
    g as (select distinct image, cellID as id, x_px as x, y_px as y, floor(x_px / 4)::bigint as gx, floor(y_px / 4)::bigint as gy
          from cells where image is not null and cellID is not null and isfinite(x_px) and isfinite(y_px)),
    h as (select image, id, x, y, gx + dx as gx, gy + dy as gy from g, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)),
    nr as (select distinct image, 'cell' as near_kind, g.id as id_a, h.id as id_b from g join h using (image, gx, gy) where g.id < h.id and (g.x - h.x) ** 2 + (g.y - h.y) ** 2 <= 16)"""


def _loaded(kind: str, columns: tuple[str, ...]) -> str:
    return f"with {_RECORDS} select rec_id, sheet_file, line_no, " + ", ".join(f"coalesce({_NAMED(c)}, '') as {c}" for c in columns) + f" from re where reason is null and sheet_kind = '{kind}'"


#: p5: no SQL for nested quotes and rules per skeleton; tests hold it against given cases.
SQL = {
    "p1_found": f"with {_RECORDS} select rec_id, reason from re where reason is not null",
    "p1_samples_loaded": _loaded("samples", SAMPLE_COLUMNS),
    "p1_panels_loaded": _loaded("panel", PANEL_COLUMNS),
    "p4_found": f"with {_EDGES}, {_NEAR} select * from nr union all select distinct image, 'shape', cellID, shape_id from held",
}
