"""Several values packed in one field, made into one row per value.

Method: delimiter skeletons. Runs of ordinary signs are masked, so that fields written alike
share one skeleton; the splitting rule is resolved once per distinct skeleton and joined
back, and the values are cut out by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from slideloom.functions.text import strip
from slideloom.session import checkpointed

# Signs with a meaning of their own; all others are ordinary.
SEPARATORS = ";,|\t\n\r、；，｜"
OPENING = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "„": "“", "「": "」"}
SPACES = "  　"
_SPECIAL = SEPARATORS + SPACES + "/\\[]" + "".join(sorted(set(OPENING) | set(OPENING.values())))
_CLASS = "".join("\\" + c if c in "\\[]|" else c for c in _SPECIAL)
_MASK = "a"
#: Bytes of skeletons and rules that are broadcast at most, about; more are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
_RULE_BYTES = 40

_RULE = "array<struct<start:int,length:int,escape:string>>"


def _closing(skeleton: str, i: int, end: int, listed: bool) -> tuple[int, str]:
    """The place of the quote that closes the one at ``i`` and the escape used; -1 if none does."""
    close, escape, j = OPENING[skeleton[i]], "", i + 1
    while j < end:
        if skeleton[j] == "\\" and j + 1 < end and skeleton[j + 1] in (close, "\\"):
            escape, j = "backslash", j + 2
            continue
        if skeleton[j] == close:
            if close == '"' and not listed and j + 1 < end and skeleton[j + 1] == close:
                escape, j = "doubled", j + 2
                continue
            k = j + 1
            while k < end and skeleton[k] in SPACES:
                k += 1
            if k == end or skeleton[k] in SEPARATORS or _slash(skeleton, k, end):
                return j, escape
        j += 1
    return -1, ""


def _slash(skeleton: str, i: int, end: int) -> bool:
    """Whether a slash at ``i`` parts values: it does only with white space on both sides."""
    return skeleton[i] == "/" and (i == 0 or skeleton[i - 1] in SPACES) and (i + 1 >= end or skeleton[i + 1] in SPACES)


def split_rule(skeleton: str) -> list[tuple[int, int, str]]:
    """(start, length, escape) of each value of a skeleton, in signs of the skeleton.

    A bracketed list of quoted values loses its brackets. A quote counts only where it opens
    at the start of a value and closes at its end; any other quote belongs to the name.
    Separators inside such quotes belong to the value.
    """
    start, end = 0, len(skeleton)
    blank = SPACES + "\t\n\r"
    while start < end and skeleton[start] in blank:
        start += 1
    while end > start and skeleton[end - 1] in blank:
        end -= 1
    listed = end - start >= 2 and skeleton[start] == "[" and skeleton[end - 1] == "]"
    if listed:
        start, end = start + 1, end - 1
    found: list[tuple[int, int, str]] = []
    i = start
    while i < end:
        if skeleton[i] in SEPARATORS or skeleton[i] in SPACES or _slash(skeleton, i, end):
            i += 1
            continue
        if skeleton[i] in OPENING:
            j, escape = _closing(skeleton, i, end, listed)
            if j >= 0:
                found.append((i + 1, j - i - 1, escape))
                i = j + 1
                continue
        j = i
        while j < end and skeleton[j] not in SEPARATORS and not _slash(skeleton, j, end):
            j += 1
        found.append((i, j - i, ""))
        i = j
    return [x for x in found if x[1] > 0]


def _resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rules = [[{"start": a, "length": b, "escape": c} for a, b, c in split_rule(s)] for s in batch["skeleton"]]
        yield pd.DataFrame({"skeleton": batch["skeleton"], "rule": rules})


def split_values(rows: DataFrame, key: str, field: str, value: str) -> DataFrame:
    """One row (key, position, value) per value packed in ``field``, in the order written.

    Positions count from 1; empty values are skipped and take none, repeated values stay.
    NULL, empty and blank fields, and fields of separators only, give no row. The rules of
    the distinct skeletons are broadcast while they take few bytes, else they are joined
    by a shuffle in which a frequent skeleton is split as skewed.
    """
    filled = rows.select(F.col(key).alias("_key"), F.col(field).alias("_field")).where(F.col("_field").isNotNull())
    masked = filled.withColumn("skeleton", F.regexp_replace("_field", f"[^{_CLASS}]+", _MASK))
    rules = checkpointed(masked.select("skeleton").distinct().mapInPandas(_resolve, f"skeleton string, rule {_RULE}"))
    size = rules.agg(F.sum(F.octet_length("skeleton") + _RULE_BYTES * F.size("rule") + _RULE_BYTES)).first()[0]
    few = (size or 0) <= BROADCAST_BYTES
    joined = masked.join(F.broadcast(rules) if few else rules, "skeleton")
    signs = F.regexp_extract_all("_field", F.lit(f"([^{_CLASS}]+|[{_CLASS}])"), F.lit(1))
    # Signs and rule are bound once per field; a column in the inner lambda would be worked out per value.
    bound = F.array(F.struct(signs.alias("signs"), F.col("rule").alias("rule")))

    def text(signs: Column, rule: Column) -> Column:
        raw = F.array_join(F.slice(signs, rule["start"] + 1, rule["length"]), "")
        plain = (
            F.when(rule["escape"] == "doubled", F.replace(raw, F.lit('""'), F.lit('"')))
            .when(rule["escape"] == "backslash", F.regexp_replace(raw, r"\\(.)", "$1"))
            .otherwise(raw)
        )
        return strip(plain)

    values = F.flatten(F.transform(bound, lambda b: F.transform(b["rule"], lambda r: text(b["signs"], r))))
    values = F.filter(values, lambda x: x != "")
    placed = joined.select("_key", F.posexplode(values).alias("_pos", "_value"))
    return placed.select(
        F.col("_key").alias(key), (F.col("_pos") + 1).cast("int").alias("position"), F.col("_value").alias(value)
    )
