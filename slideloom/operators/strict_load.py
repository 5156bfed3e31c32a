"""Strict loading of delimited records with the rejects set apart and diagnosed.

Method: strict load plus anti-join. Every raw record keeps its offset (``rec_id``); only
records that conform to their sheet's header are loaded; the loaded offsets are subtracted
from the raw ones, and only the remainder is diagnosed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slideloom.functions.text import has_space, strip

SAMPLE_COLUMNS = (
    "sample_id", "image", "species", "panel", "condition", "he_image",
    "channel_names", "pixel_size_um", "exclusions", "notes",
)
PANEL_COLUMNS = ("marker", "aliases", "role", "segmentation", "status", "notes")

# Fixed values of the sheets' value checks.
SPECIES = ("human", "mouse", "canine")
ROLES = ("nuclear", "lineage", "state", "structural", "exclude")
FORBIDDEN_IN_ID = r'[/\\:*?"<>|]'

# A text sign that data may hold is escaped before the same sign marks a border.
_SIGN, _KEPT, _BORDER = "\x01", "\x01a", "\x01b"


def _pieces(record: Column) -> Column:
    """The record between two commas, a last carriage return left off, cut at every double quote.

    Pieces at even places lie outside quotes, those at odd places inside. With the commas a
    field's ends look alike everywhere.
    """
    whole = F.coalesce(record, F.lit(""))
    whole = F.when(whole.endswith("\r"), whole.substr(F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return F.split(F.concat(F.lit(","), F.replace(whole, F.lit(_SIGN), F.lit(_KEPT)), F.lit(",")), '"', -1)


def _well_quoted(pieces: Column) -> Column:
    """Whether every quote encloses a whole field or is doubled inside one.

    The lambda names no column: one would be worked out anew for each piece.
    """

    def fits(piece: Column, i: Column) -> Column:
        return (i % 2 == 1) | (piece == "") | (piece.startswith(",") & piece.endswith(","))

    return (F.size(pieces) % 2 == 1) & F.forall(F.transform(pieces, fits), lambda x: x)


def _fields(pieces: Column) -> Column:
    """The fields of a well quoted record, enclosing quotes left off and doubled ones made single."""

    def text(piece: Column, i: Column) -> Column:
        outside = F.when(piece == "", F.lit('"')).otherwise(F.replace(piece, F.lit(","), F.lit(_BORDER)))
        return F.when(i % 2 == 1, piece).otherwise(outside)

    joined = F.array_join(F.transform(pieces, text), "")
    # Without the borders that stand for the commas around the record.
    inner = F.substring(joined, F.lit(len(_BORDER) + 1), F.length(joined) - 2 * len(_BORDER))
    return F.transform(F.split(inner, _BORDER, -1), lambda x: F.replace(x, F.lit(_KEPT), F.lit(_SIGN)))


def _named(name: str) -> Column:
    """The trimmed field under the header ``name``; NULL where the header lacks it."""
    return strip(F.get("fields", (F.array_position("header", name) - 1).cast("int")))


def _value_ok() -> Column:
    """Whether the checked values of a record hold. A column its header lacks is not checked."""
    species, sample, role = _named("species"), _named("sample_id"), _named("role")
    samples = F.coalesce(F.lower(species).isin(*SPECIES), F.lit(True)) & F.coalesce(
        (sample != "") & ~has_space(sample) & ~sample.rlike(FORBIDDEN_IN_ID), F.lit(True)
    )
    panel = F.coalesce(F.lower(role).isin(*ROLES), F.lit(True))
    return F.when(F.col("sheet_kind") == "samples", samples).when(F.col("sheet_kind") == "panel", panel).otherwise(True)


def headers(raw: DataFrame) -> DataFrame:
    """One row per sheet_file: its header names, trimmed and in lower case.

    Of several first lines of a file, the one received first counts (then the smallest rec_id).
    """
    first = raw.where(F.col("line_no") == 1).groupBy("sheet_file").agg(
        F.min_by("record", F.struct(F.col("received_at").isNull(), "received_at", "rec_id")).alias("record")
    )
    names = F.transform(_fields(_pieces(F.col("record"))), lambda x: F.lower(strip(x)))
    return first.select("sheet_file", names.alias("header"))


def _judged(records: DataFrame, raw: DataFrame) -> DataFrame:
    """Records under the header that ``raw`` has for them, with the three tests that a load applies.

    The header of a file is found by an equi-join; it is broadcast where its measured size
    allows, and a file that holds very many rows is split by the adaptive skew join.
    """
    pieces = records.select("rec_id", "sheet_file", "sheet_kind", "line_no", "record", _pieces(F.col("record")).alias("pieces"))
    joined = pieces.join(headers(raw), "sheet_file", "left")
    return (
        joined.withColumn("quoting_ok", _well_quoted(F.col("pieces")))
        .withColumn("fields", _fields(F.col("pieces")))
        .withColumn("count_ok", F.coalesce(F.size("fields") == F.size("header"), F.lit(False)))
        .drop("pieces")
    )


def strict_load(raw: DataFrame) -> DataFrame:
    """The records that conform: rec_id, sheet_file, sheet_kind, line_no, header, fields.

    ``raw`` has rec_id, sheet_file, sheet_kind, line_no, record, received_at; other columns are
    ignored. A NULL record counts as an empty one, a record of a file without a header line
    never conforms, repeated records each load under their own rec_id, an empty table loads
    nothing.
    """
    ok = _judged(raw.where(F.col("line_no") > 1), raw).where(F.col("quoting_ok") & F.col("count_ok")).where(_value_ok())
    return ok.select("rec_id", "sheet_file", "sheet_kind", "line_no", "header", "fields")


def rejected(raw: DataFrame) -> DataFrame:
    """(rec_id, reason) of each record that :func:`strict_load` does not load.

    The loaded offsets are subtracted from the raw ones, and only what remains is diagnosed:
    the first reason that holds of ``quoting``, ``column_count`` and ``value`` is given.
    """
    rest = raw.where(F.col("line_no") > 1).join(strict_load(raw).select("rec_id"), "rec_id", "left_anti")
    remainder = _judged(rest, raw)
    reason = (
        F.when(~F.col("quoting_ok"), "quoting").when(~F.col("count_ok"), "column_count").when(~_value_ok(), "value")
    )
    return remainder.select("rec_id", reason.alias("reason")).where(F.col("reason").isNotNull())


def load_sheet(raw: DataFrame, kind: str) -> DataFrame:
    """The loaded rows of one kind of sheet under the columns of that kind, trimmed.

    A column that a sheet's header lacks is the empty string, as a blank field is.
    """
    columns = SAMPLE_COLUMNS if kind == "samples" else PANEL_COLUMNS
    loaded = strict_load(raw).where(F.col("sheet_kind") == kind)
    return loaded.select("rec_id", "sheet_file", "line_no", *[F.coalesce(_named(c), F.lit("")).alias(c) for c in columns])
