"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from textlake.session import scratch_path

# Fixed value: a word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; Python workers are told where this package lies."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [ROOT, *(path for path in paths if path)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage by a table that every executor can read, so a lost executor repeats single
    tasks only, and later steps do not compute ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
