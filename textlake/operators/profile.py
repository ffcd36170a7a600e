"""Corpus profile: label balance, lengths, sources, artefact counts, nulls.

Quantiles are exact. They are read from ``(group, value, n)`` histograms, so rows are combined
before the shuffle and a group that holds most of the corpus costs no more than its distinct
values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.functions.text import count_dates, count_numbers, count_urls

MISSING_SOURCE = "missing"


def profile_nulls(df: DataFrame) -> DataFrame:
    """``(column_name, rows, nulls)`` for every column, from one aggregate over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[
        F.struct(F.lit(name).alias("column_name"),
                 F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"))
        for name in df.columns
    ]).alias("columns"))
    return counts.select("rows", F.inline("columns")).select("column_name", "rows", "nulls")


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and column types as one row."""
    types = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(types).alias("types"))


def label_distribution(df: DataFrame, label: str = "type") -> DataFrame:
    """Rows and percentage per label, null counted as a label."""
    counts = _with_totals(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label)
    return counts.select(label, "n", (F.col("n") * 100 / F.col("total")).alias("percent"))


def _with_totals(counts: DataFrame, label: str) -> DataFrame:
    """Class counts with ``total`` and ``classes``, their sum and number: a row for each class."""
    return counts.agg(
        F.collect_list(F.struct(label, "n")).alias("rows"), F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("classes")).select(F.inline("rows"), "total", "classes")


def value_histogram(df: DataFrame, value: str, *groups: str) -> DataFrame:
    return df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))


def weighted_stats(value: str = "value") -> list[Column]:
    """Mean, median, 95th percentile and maximum over a ``(value, n)`` histogram."""
    return [
        (F.sum(F.col(value) * F.col("n")) / F.sum("n")).alias("mean"),
        F.percentile(value, F.lit(0.5), F.col("n")).alias("median"),
        F.percentile(value, F.lit(0.95), F.col("n")).alias("p95"),
        F.max(value).alias("maximum"),
    ]


def length_stats(df: DataFrame, length: str, label: str = "type") -> DataFrame:
    """Rows, mean, median, p95 and maximum of a length column per (non-null) label."""
    lengths = value_histogram(df.filter(F.col(label).isNotNull()), length, label)
    return lengths.groupBy(label).agg(F.sum("n").alias("n"), *weighted_stats(length))


def length_histogram(
    df: DataFrame, length: str, label: str = "type", bins: int = 50, clip: float = 0.99,
) -> DataFrame:
    """Equal-width histogram per label after clipping at a percentile; the last bin is closed.

    The windows run over the distinct lengths of a label, not over its rows.
    """
    lengths = value_histogram(df.filter(F.col(label).isNotNull()), length, label)
    same_label = Window.partitionBy(label)
    clipped = lengths.withColumns({
        "lo": F.min(length).over(same_label).cast("double"),
        "hi": F.percentile(length, F.lit(clip), F.col("n")).over(same_label),
    })
    value = F.least(F.col(length).cast("double"), F.col("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width > 0, F.floor((value - F.col("lo")) / width)).otherwise(F.lit(0))
    return (
        clipped.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(label, "bin").agg(
            F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.sum("n").alias("n"))
        .select(
            label, "bin",
            (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
            "n")
    )


def top_sources(
    df: DataFrame, source: str = "domain", label: str = "type", k: int = 10,
) -> DataFrame:
    """The k most frequent sources per label; a missing source counts under its own name."""
    named = df.filter(F.col(label).isNotNull()).withColumn(
        source, F.coalesce(source, F.lit(MISSING_SOURCE)))
    counts = named.groupBy(label, source).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(label).orderBy(F.desc("n"), source)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


ARTEFACTS = {"url_count": count_urls, "date_count": count_dates, "number_count": count_numbers}


def count_artefacts(df: DataFrame, text: str = "content") -> DataFrame:
    return df.withColumns({name: count(F.col(text)) for name, count in ARTEFACTS.items()})


def _long_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    features = list(ARTEFACTS)
    return df.select(*keys, *features).unpivot(
        list(keys), features, "feature", "value",
    ).groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def artefact_stats(df: DataFrame) -> DataFrame:
    """Total, mean, median and p95 of each artefact count over all rows."""
    return _long_counts(df, []).groupBy("feature").agg(
        F.sum(F.col("value") * F.col("n")).alias("total"), *weighted_stats()[:3])


def artefact_by_label(df: DataFrame, label: str = "type") -> DataFrame:
    """Mean and median of each artefact count per label."""
    rows = df.filter(F.col(label).isNotNull())
    return _long_counts(rows, [label]).groupBy(label, "feature").agg(*weighted_stats()[:2])


def class_ratio(df: DataFrame, label: str = "type") -> DataFrame:
    """Negative rows per positive row, the weight of a positive example."""
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    ratio = F.when(positives > 0, negatives / positives).otherwise(
        F.raise_error(F.lit("no positive rows: the class ratio is undefined")))
    return df.agg(
        negatives.alias("negatives"), positives.alias("positives"), ratio.alias("ratio"))


def class_weights(df: DataFrame, label: str = "type") -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = _with_totals(df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("n")), label)
    return counts.select(
        label, "n", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))
