"""Keyed counts and row totals of streams against the batch results."""

from pyspark.sql import functions as F

from textlake.operators import cleaning
from textlake.streaming import incremental

SCHEMA = "id string, type string, content string, domain string, scraped_at string"


def arrive(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def size(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_counts_are_kept_between_runs(spark, tmp_path):
    source, store, state = (str(tmp_path / name) for name in ("in", "counts", "state"))
    want = {}
    for texts in (["a b a", "b c"], ["c d", "", None], ["a d"]):
        arrive(spark, [(t,) for t in texts], "text string", source)
        stream = incremental.read_stream(spark, source, "text string")
        incremental.track_term_counts(stream, "text", store, state).awaitTermination()
        for term in " ".join(t or "" for t in texts).split():
            want[term] = want.get(term, 0) + 1
        found = incremental.read_term_counts(spark, store).collect()
        assert {row["term"]: row["n"] for row in found} == want and len(found) == len(want)
    # nothing new: nothing is counted again
    stream = incremental.read_stream(spark, source, "text string")
    incremental.track_term_counts(stream, "text", store, state).awaitTermination()
    assert {r["term"]: r["n"] for r in incremental.read_term_counts(spark, store).collect()} == want


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    source, store, state = (str(tmp_path / name) for name in ("in", "counts", "state"))
    for texts in (["a b"], ["b c"]):
        arrive(spark, [(t,) for t in texts], "text string", source)
        stream = incremental.read_stream(spark, source, "text string")
        incremental.track_term_counts(stream, "text", store, state).awaitTermination()
    before = sorted(map(tuple, incremental.read_term_counts(spark, store).collect()))
    # as after a failure between writing a batch and committing it
    (tmp_path / "state" / "commits" / "1").unlink()
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    stream = incremental.read_stream(spark, source, "text string")
    incremental.track_term_counts(stream, "text", store, state).awaitTermination()
    assert sorted(map(tuple, incremental.read_term_counts(spark, store).collect())) == before


def test_a_batch_writes_its_own_terms_only(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = tmp_path / "terms"
    for texts in ([" ".join(f"w{i}" for i in range(3000))], ["w1 new"], ["new w2 other"]):
        arrive(spark, [(t,) for t in texts], "text string", source)
        stream = incremental.read_stream(spark, source, "text string")
        incremental.track_vocabulary(stream, "text", str(store), state).awaitTermination()
    rows = spark.read.parquet(str(store)).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n")).collect()
    assert {r["batch"]: r["n"] for r in rows} == {0: 3000, 1: 1, 2: 1}
    assert size(store / "batch=2") < size(store / "batch=0") / 5


def test_totals_of_batches_add_up_to_the_summary(spark, tmp_path):
    source, out, state, totals = (
        str(tmp_path / name) for name in ("in", "out", "state", "totals"))
    batches = [
        [("1", "fake", "x", "a", "2020-01-01"), ("2", None, "x", "a", "2020-01-01")],
        [("3", "reliable", "y", "b", "junk"), ("4", "political", "z", "b", "2020/01/03")],
        [("5", "fake", None, "a", "2020-01-01")],
    ]
    for rows in batches:
        arrive(spark, rows, SCHEMA, source)
        stream = incremental.read_stream(
            spark, source, spark.createDataFrame([], SCHEMA).schema)
        incremental.append_cleaned(stream, out, state, totals=totals)
    rows = incremental.read_totals(spark, totals).orderBy("batch").collect()
    assert [r["rows_in"] for r in rows] == [2, 2, 1]
    assert [r["running_rows_out"] for r in rows] == [1, 2, 2]
    whole = spark.createDataFrame([r for batch in batches for r in batch], SCHEMA)
    want = cleaning.clean_summary(whole).first().asDict()
    assert {k: rows[-1][f"running_{k}"] for k in want} == want
    assert spark.read.parquet(out).count() == 2
