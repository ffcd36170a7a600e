"""Sketches and bounded counters against exact results."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlake.operators import sketches, vocabulary


def test_quantiles_of_merged_files_are_in_place(spark, tmp_path):
    random.seed(1)
    rows = [(i, random.gauss(0, 1), random.random() ** 4 if i % 7 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, a double, b double").withColumn(
        "b", F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(F.col("b")))
    path, store = str(tmp_path / "t"), str(tmp_path / "s")
    read_files = []

    def read(files):
        read_files.append(len(files))
        return spark.read.parquet(*files)

    def make(part):
        return sketches.quantile_sketches(part, ["a", "b"], ["file"])

    for part in range(3):
        df.filter(F.col("id") % 3 == part).repartition(2).write.mode("append").parquet(path)
        files = spark.read.parquet(path).inputFiles()
        found = sketches.update_by_file(spark, files, read, make, store)
    assert read_files == [2, 2, 2]
    again = sketches.update_by_file(spark, files, read, make, store)
    assert len(read_files) == 3 and again.count() == 12
    merged = sketches.merge_quantiles(found)
    assert {r["feature"]: r["n"] for r in merged.collect()} == {
        "a": 20_000, "b": sum(r[2] is not None for r in rows) - (rows[5][2] is not None)}
    values = sketches.quantiles(merged, [0.01, 0.5, 0.99]).collect()
    for row in values:
        held = np.array([r[1 if row["feature"] == "a" else 2] for r in rows if r[0] != 5], float)
        held = held[~np.isnan(held)]
        assert abs((held <= row["value"]).mean() - row["share"]) < 2 * sketches.RANK_ERROR
    errors = sketches.rank_errors(df.filter("id <> 5"), sketches.quantiles(merged, [0.25, 0.75]))
    assert errors.count() == 4 and errors.agg(F.max("error")).first()[0] < 2 * sketches.RANK_ERROR


def test_union_of_inputs_equals_the_sketch_of_all(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("input"), F.array(
            (F.col("id") % 25_000).cast("string"), F.lit("x")).alias("terms"))
    stages = {"all": F.col("terms"), "few": F.slice("terms", 2, 1)}
    parts = sketches.vocabulary_estimates(
        sketches.vocabulary_sketches(df, stages, ["input"])).collect()
    whole = sketches.vocabulary_estimates(sketches.vocabulary_sketches(df, stages)).collect()
    found = {r["stage"]: r["estimate"] for r in parts}
    assert found["few"] == 1 and abs(found["all"] - 25_001) < 0.02 * 25_001
    for row in whole:
        assert row["estimate"] == pytest.approx(found[row["stage"]], rel=0.01)


def test_merged_counts_lack_no_more_than_they_say():
    random.seed(5)
    terms = [f"t{int(random.paretovariate(0.6))}" for _ in range(5000)]
    held, n, lacking = pa.array([], pa.string()), np.zeros(0, np.int64), 0
    for at in range(0, 5000, 100):
        new = pa.array(terms[at:at + 100])
        held, n, off = vocabulary.merged_counts(
            pa.concat_arrays([held, new]), np.append(n, np.ones(100, np.int64)), 40)
        lacking += off
        assert len(held) <= 40
    told = dict(zip(held.to_pylist(), n.tolist()))
    for term in set(terms):
        assert told.get(term, 0) <= terms.count(term) <= told.get(term, 0) + lacking


@pytest.mark.parametrize("counters", [4, 64, 4096])
def test_heavy_terms_are_exact(spark, counters, monkeypatch):
    random.seed(counters)
    texts = [" ".join(f"w{int(random.paretovariate(0.7))}" for _ in range(50)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string").repartition(4)
    words = F.split("t", " ")
    want = vocabulary.top_terms(vocabulary.term_counts(df, words), 10).collect()
    assert vocabulary.heavy_terms(df, words, 10, counters).collect() == want
    monkeypatch.setattr(vocabulary, "MAX_COUNTERS", 8)
    assert vocabulary.heavy_terms(df, words, 10, 4).collect() == want


def test_words_are_made_once(spark):
    """However often the passes are repeated."""
    made = spark.sparkContext.accumulator(0)

    def cut(text):
        made.add(1)
        return text.split(" ")

    texts = [" ".join(f"w{i * j % 61}" for j in range(40)) for i in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    words = F.udf(cut, "array<string>")("t")
    assert vocabulary.heavy_terms(df, words, 10, 4).count() == 10
    assert made.value == len(texts)


def test_no_terms(spark):
    df = spark.createDataFrame([], "t string")
    assert vocabulary.heavy_terms(df, F.split("t", " ")).count() == 0
