"""Session helpers shared by the operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    The folder the cluster names is used as it is. Only where none is set and Spark runs on one
    machine, as in tests, a temporary folder is taken.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("a cluster needs spark.checkpoint.dir, a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` in enough partitions to keep all cores busy with work that takes long per row.

    Only an input of fewer partitions than cores, which is a small one, is moved for it.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(2 * cores) if rows.rdd.getNumPartitions() < cores else rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
