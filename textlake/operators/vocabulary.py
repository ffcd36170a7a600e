"""Vocabularies and term frequencies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.functions.stemming import stem
from textlake.functions.stopwords import ENGLISH
from textlake.session import let_workers_import, scratch_path

#: Terms that a task counts at a time while it looks for heavy ones, and how far this may grow.
COUNTERS, MAX_COUNTERS = 1 << 14, 1 << 22


def term_counts(df: DataFrame, words: Column) -> DataFrame:
    """``(term, n)`` over all rows. Counts are combined per task before the shuffle."""
    return df.select(F.explode(words).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))


def stem_vocabulary(terms: DataFrame, stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """Add ``is_stopword`` and, for the other terms, ``stem``: one stemming per distinct term."""
    is_stopword = F.col("term").isin(*stopwords)
    return terms.select(
        *terms.columns,
        is_stopword.alias("is_stopword"),
        F.when(~is_stopword, stem(F.col("term"))).alias("stem"),
    )


def staged_vocabulary(terms: DataFrame, stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """Distinct ``(stage, term)`` for the raw, stop-word-free and stemmed vocabularies."""
    stemmed = stem_vocabulary(terms.select("term"), stopwords)
    return stemmed.select(F.explode(F.array(
        F.struct(F.lit("raw").alias("stage"), F.col("term")),
        F.when(~F.col("is_stopword"), F.struct(F.lit("no_stop").alias("stage"), F.col("term"))),
        F.when(~F.col("is_stopword"),
               F.struct(F.lit("stemmed").alias("stage"), F.col("stem").alias("term"))),
    )).alias("entry")).filter("entry is not null").select("entry.*").distinct()


def vocabulary_sizes(terms: DataFrame, stopwords: Sequence[str] = ENGLISH) -> DataFrame:
    """Distinct terms at the three stages, from the distinct raw terms."""
    by_stem = stem_vocabulary(terms.select("term"), stopwords).groupBy("stem").agg(
        F.count(F.lit(1)).alias("terms"), F.count_if("is_stopword").alias("stops"))
    return by_stem.agg(
        F.sum("terms").alias("raw"),
        F.sum(F.col("terms") - F.col("stops")).alias("no_stop"),
        F.count("stem").alias("stemmed"),
    ).fillna(0)


def reduction_rates(sizes: DataFrame) -> DataFrame:
    """Percentage lost between stages; 0 where the earlier stage is empty."""

    def rate(before: str, after: str) -> Column:
        lost = (F.col(before) - F.col(after)) * 100 / F.col(before)
        return F.when(F.col(before) > 0, lost).otherwise(F.lit(0.0))

    return sizes.select(
        "raw", "no_stop", "stemmed",
        rate("raw", "no_stop").alias("stop_reduction"),
        rate("no_stop", "stemmed").alias("stem_reduction"),
        rate("raw", "stemmed").alias("total_reduction"),
    )


def top_terms(terms: DataFrame, k: int = 100) -> DataFrame:
    return terms.orderBy(F.desc("n"), "term").limit(k)


def rank_frequency(terms: DataFrame, k: int = 10_000) -> DataFrame:
    """Rank axis over the k most frequent terms; the window sees only those k rows."""
    order = Window.orderBy(F.desc("n"), "term")
    return top_terms(terms, k).select(
        F.row_number().over(order).alias("rank"), "term", "n")


# --- heavy terms at bounded memory ---------------------------------------------------------------


def merged_counts(
    terms: pa.Array, counts: np.ndarray, counters: int,
) -> tuple[pa.Array, np.ndarray, int]:
    """At most ``counters`` terms with counts that are too low by the returned number at most.

    Equal terms are added up; where there are more terms, the count of the first one that has no
    room is taken off all, and terms without a count left are dropped.
    """
    grouped = pa.table({"term": terms, "n": counts}).group_by("term").aggregate([("n", "sum")])
    held, n = grouped["term"].combine_chunks(), grouped["n_sum"].to_numpy()
    if len(n) <= counters:
        return held, n, 0
    off = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
    kept = n > off
    return held.filter(pa.array(kept)), n[kept] - off, off


def _summaries(batches, counters: int):
    """A task's terms with their least counts, and as null term what any count may lack."""
    held, n, lacking = pa.array([], pa.string()), np.zeros(0, np.int64), 0
    for batch in batches:
        seen = pc.value_counts(batch.column("term"))
        held, n, off = merged_counts(
            pa.concat_arrays([held, seen.field("values")]),
            np.concatenate([n, seen.field("counts").to_numpy()]), counters)
        lacking += off
    yield pa.RecordBatch.from_arrays(
        [pa.concat_arrays([held, pa.array([None], pa.string())]),
         pa.array(np.append(n, lacking), pa.int64())], names=["term", "n"])


def heavy_terms(df: DataFrame, words: Column, k: int = 100, counters: int = COUNTERS) -> DataFrame:
    """The ``top_terms`` of all rows, without a count for every term.

    Each task sums up its rows in a fixed number of counters, whose counts are too low by a known
    number at most. Terms that may be among the k most frequent by these bounds are counted
    exactly in a second pass; if terms without a counter may be, or too many others, the first
    pass is repeated with more counters. Beyond MAX_COUNTERS all terms are counted. The words are
    made once and stored, as there are several passes.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    made = scratch_path(spark, "words")
    df.select(words.alias("words")).write.parquet(made)
    terms = spark.read.schema("words array<string>").parquet(made).select(
        F.explode("words").alias("term")).filter(F.col("term").isNotNull())
    while counters <= MAX_COUNTERS:
        path = scratch_path(spark, "heavy-terms")
        terms.mapInArrow(partial(_summaries, counters=counters), "term string, n long").groupBy(
            "term").agg(F.sum("n").alias("n")).write.parquet(path)
        found = spark.read.schema("term string, n long").parquet(path)
        lacking = found.filter(F.col("term").isNull()).agg(F.sum("n")).first()[0] or 0
        least = [row["n"] for row in found.filter(F.col("term").isNotNull()).orderBy(
            F.desc("n")).limit(k).collect()]
        # without anything lacking all counts are exact
        bar = least[-1] if len(least) == k else 0
        possible = found.filter(F.col("term").isNotNull() & (F.col("n") + lacking >= bar))
        if lacking == 0:
            return top_terms(possible, k)
        if lacking < bar and possible.count() <= COUNTERS:
            exact = terms.join(F.broadcast(possible.select("term")), "term").groupBy("term").agg(
                F.count(F.lit(1)).alias("n"))
            return top_terms(exact, k)
        counters *= 4
    return top_terms(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")), k)
