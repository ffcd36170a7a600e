"""Cleaning of article tables: required fields, sentinels, types, timestamps, labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions.labels import binarise
from textlake.functions.text import normalize_text
from textlake.functions.timestamps import parse_mixed

# Column roles and sentinels of the article table.
BOOKKEEPING = ["Unnamed: 0", "inserted_at", "updated_at"]
PROTECTED = ["id", "type", "content", "domain", "authors", "title", "scraped_at"]
REQUIRED = ["id", "type", "content"]
SENTINELS = {"authors": "unknown_author", "title": "no_title"}


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)


def null_only_columns(df: DataFrame, protected: Sequence[str] = PROTECTED) -> list[str]:
    """Unprotected columns without a single value, found with one aggregate over them."""
    candidates = [name for name in df.columns if name not in protected]
    if not candidates:
        return []
    filled = df.agg(*[
        F.coalesce(F.bool_or(_quoted(name).isNotNull()), F.lit(False)).alias(name)
        for name in candidates
    ]).first()
    return [name for name in candidates if not filled[name]]


def drop_null_only_columns(df: DataFrame, protected: Sequence[str] = PROTECTED) -> DataFrame:
    return df.drop(*null_only_columns(df, protected))


def required_columns(df: DataFrame) -> list[str]:
    missing = [name for name in REQUIRED if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return REQUIRED + (["domain"] if "domain" in df.columns else [])


def _complete(df: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [_quoted(n).isNotNull() for n in required_columns(df)])


def drop_missing_required(df: DataFrame) -> DataFrame:
    """Written as IS NOT NULL tests, which reach the parquet scan."""
    return df.filter(_complete(df))


def fill_sentinels(df: DataFrame) -> DataFrame:
    return df.fillna({name: text for name, text in SENTINELS.items() if name in df.columns})


def cast_text(df: DataFrame) -> DataFrame:
    return df.withColumns({
        name: F.col(name).cast("string") for name in ("content", "title") if name in df.columns
    })


def parse_timestamps(df: DataFrame, column: str = "scraped_at") -> DataFrame:
    return df.withColumn(column, parse_mixed(F.col(column)))


def binarise_type(df: DataFrame) -> DataFrame:
    if not isinstance(df.schema["type"].dataType, T.StringType):
        raise ValueError("Column 'type' is not text: the table has already been cleaned")
    return df.withColumn("type", binarise(F.col("type")))


def clean_rows(df: DataFrame) -> DataFrame:
    """The row-wise part of the cleaning: one map-only plan, also usable on a stream."""
    df = cast_text(fill_sentinels(drop_missing_required(drop_bookkeeping(df))))
    if "scraped_at" in df.columns:
        df = parse_timestamps(df).filter(F.col("scraped_at").isNotNull())
    return binarise_type(df)


def initial_cleaning(df: DataFrame) -> DataFrame:
    """Whole cleaning step. Emptiness of columns is judged over the full input table."""
    required_columns(df)
    return clean_rows(drop_null_only_columns(drop_bookkeeping(df)))


def summary_metrics(df: DataFrame) -> list[Column]:
    """Aggregates over the *raw* table: rows in, dropped for either reason, rows out."""
    complete = _complete(df)
    dated = F.lit(True)
    if "scraped_at" in df.columns:
        dated = parse_mixed(F.col("scraped_at")).isNotNull()
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~complete).alias("missing_required"),
        F.count_if(complete & ~dated).alias("invalid_timestamps"),
        F.count_if(complete & dated).alias("rows_out"),
    ]


def clean_summary(df: DataFrame) -> DataFrame:
    return df.agg(*summary_metrics(df)).withColumn(
        "rows_dropped", F.col("rows_in") - F.col("rows_out"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Add ``content_normalized`` and, where there is a title, ``title_normalized``."""
    names = [name for name in ("content", "title") if name in df.columns]
    return df.withColumns({f"{name}_normalized": normalize_text(F.col(name)) for name in names})


def align_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union in the column layout of the first table: extra columns go, missing ones are null."""
    layout = first.schema
    result = first
    for other in others:
        result = result.unionByName(other.select(*[
            (_quoted(f.name) if f.name in other.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]))
    return result
