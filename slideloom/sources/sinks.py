"""Results written to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException


def write_table(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Parquet under ``path``; the partitions that ``rows`` holds are replaced, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_csv(rows: DataFrame, path: str, order: Sequence[str]) -> None:
    """One CSV file with a header, for a table small enough to be read by people (K1)."""
    rows.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True, emptyValue="", escape='"')


def as_json(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, json): each row as a JSON object, NULL fields kept (K2)."""
    return rows.select(*keys, F.to_json(F.struct(*[F.col(c) for c in rows.columns]), {"ignoreNullFields": "false"}).alias("json"))


def display_script(ranges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, script): a line per marker that sets its display range, in the order of names (K6)."""
    line = F.format_string('setChannelDisplayRange("%s", %s, %s)', F.col("marker"), F.col("display_low").cast("string"), F.col("display_high").cast("string"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("marker", line.alias("line")))), lambda x: x["line"])
    return ranges.groupBy(*keys).agg(F.array_join(lines, "\n").alias("script"))


def read_stage(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """The table that an earlier stage wrote; an error that names the stage if it is not there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"{path} is missing: run stage {stage} first") from e
