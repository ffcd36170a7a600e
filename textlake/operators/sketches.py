"""Mergeable summaries: quantiles of real-valued columns and vocabulary sizes, input by input.

A histogram of distinct values is as long as the table where values are real numbers, and exact
distinct counts over several inputs need all their terms. Sketches have a fixed size and a stated
error, and the sketch of a union follows from the sketches of its parts: each input file is
sketched once and stored, and a new file costs its own rows only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a quantile sketch, and the rank error that it keeps to (99 % of all quantiles).
QUANTILE_SIZE, RANK_ERROR = 800, 0.005
#: Logarithm of the size of a distinct-count sketch, and its relative error (two deviations).
DISTINCT_LOG_SIZE, DISTINCT_ERROR = 14, 0.02


def quantile_sketches(
    df: DataFrame, values: Sequence[str], groups: Sequence[str] = (), size: int = QUANTILE_SIZE,
) -> DataFrame:
    """``groups, feature, n, sketch`` of each column of numbers; nulls and NaN do not count."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(f"`{name}`").cast("double").alias("value"))
        for name in values])
    return df.select(*groups, F.inline(entries)).filter(
        F.col("value").isNotNull() & ~F.isnan("value")).groupBy(*groups, "feature").agg(
            F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", size).alias("sketch"))


def merge_quantiles(
    sketches: DataFrame, groups: Sequence[str] = (), size: int = QUANTILE_SIZE,
) -> DataFrame:
    """The sketches of all inputs as one for each group and feature."""
    return sketches.groupBy(*groups, "feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``..., feature, n, share, value``: values at the given shares of each sketch."""
    others = [name for name in sketches.columns if name != "sketch"]
    wanted = F.array(*map(F.lit, shares))
    found = F.arrays_zip(
        wanted.alias("share"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return sketches.select(*others, F.inline(found).alias("share", "value"))


def rank_errors(df: DataFrame, found: DataFrame) -> DataFrame:
    """``feature, share, n, error``: how far the found values are from their place, exactly.

    One aggregate over the rows; ``found`` has a row for each feature and share.
    """
    wanted = found.select("feature", "share", "value").collect()
    counts = df.agg(*[
        F.struct(
            F.lit(row["feature"]).alias("feature"), F.lit(row["share"]).alias("share"),
            F.count(row["feature"]).alias("n"),
            F.count_if(F.col(row["feature"]) < row["value"]).alias("below"),
            F.count_if(F.col(row["feature"]) <= row["value"]).alias("through"),
        ).alias(f"c{i}") for i, row in enumerate(wanted)])
    rows = counts.select(F.inline(F.array(*counts.columns)))
    share = F.col("share")
    return rows.select("feature", "share", "n", F.greatest(
        F.col("below") / F.col("n") - share, share - F.col("through") / F.col("n"),
        F.lit(0.0)).alias("error"))


def vocabulary_sketches(
    df: DataFrame, stages: dict[str, Column], groups: Sequence[str] = (),
) -> DataFrame:
    """``groups, stage, sketch``: the distinct terms of each stage, a column of term arrays each."""
    def of_stage(stage: str) -> Callable[[Column], Column]:
        return lambda term: F.struct(F.lit(stage).alias("stage"), term.alias("term"))

    entries = F.concat(*[
        F.transform(terms, of_stage(stage)) for stage, terms in stages.items()])
    return df.select(*groups, F.inline(entries)).groupBy(*groups, "stage").agg(
        F.hll_sketch_agg("term", DISTINCT_LOG_SIZE).alias("sketch"))


def vocabulary_estimates(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``groups, stage, estimate`` of the union of all inputs."""
    return sketches.groupBy(*groups, "stage").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def _one_form(file: str) -> str:
    """File names as Spark lists them and as rows tell them, in one form."""
    return re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", unquote(file))


def update_by_file(
    spark: SparkSession, files: Sequence[str], read: Callable[[list[str]], DataFrame],
    sketch: Callable[[DataFrame], DataFrame], store: str,
) -> DataFrame:
    """Add the sketches of files that the store does not have; returns the whole store.

    ``read`` gives the rows of some files, ``sketch`` their sketches by the column ``file``. Files
    are known by their names: those that changed under the same name need a new store.
    """
    try:
        known = {row["file"] for row in spark.read.parquet(store).select("file").distinct().collect()}
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        known = set()
    known = set(map(_one_form, known))
    fresh = sorted(file for file in set(files) if _one_form(file) not in known)
    if fresh:
        rows = read(fresh)
        rows = rows.select(*rows.columns, F.col("_metadata.file_path").alias("file"))
        sketch(rows).write.mode("append").parquet(store)
    return spark.read.parquet(store)
