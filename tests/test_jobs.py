import pytest
from pyspark.sql import functions as F

from textlake.operators import cleaning, splits
from textlake.plans import jobs
from textlake.sources import writers
from textlake.streaming import incremental

HEADER = "Unnamed: 0,id,type,content,domain,authors,title,scraped_at"


def write_csv(folder, *lines):
    folder.mkdir(exist_ok=True)
    path = folder / "articles.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_clean_and_split(spark, tmp_path):
    source = write_csv(
        tmp_path / "raw",
        '0,001,reliable,"Visit https://example.com, test articles",a.com,Bob,One,2020-01-01',
        '1,2,fake,"Some other\ncontent",b.com,,,2020-01-02T10:00:00',
        '2,3,,"No type",b.com,,,2020-01-02',
    )
    result = jobs.clean_and_split(spark, source, str(tmp_path / "clean"))
    rows = spark.read.parquet(result.processed_path).orderBy("id").collect()
    assert [row["id"] for row in rows] == ["001", "2"]
    assert rows[0]["content_processed"] == "visit urltoken test articl"
    assert rows[0]["content_normalized"].startswith("visit urltoken")
    assert rows[1]["authors"] == "unknown_author"
    assert [row["type"] for row in rows] == [0, 1]
    assert result.summary == {
        "rows_in": 3, "missing_required": 1, "invalid_timestamps": 0, "rows_out": 2}
    sizes = {name: spark.read.parquet(path).count() for name, path in result.split_paths.items()}
    assert sizes == {"train": 1, "val": 0, "test": 1}
    assert "content_processed" in spark.read.parquet(result.split_paths["val"]).columns
    assert result.reduction_rates.first()["raw"] > 0


def test_stratified_job_keeps_balance(spark, tmp_path):
    lines = [
        f"{i},{i},{'reliable' if i < 10 else 'fake'},text {i},x.com,A,T,2020-01-{i + 1:02d}"
        for i in range(20)
    ]
    source = write_csv(tmp_path / "raw", *lines)
    result = jobs.clean_and_split(
        spark, source, str(tmp_path / "clean"), "stratified", split_format="csv")
    for name, n in (("train", 8), ("val", 1), ("test", 1)):
        part = spark.read.option("header", True).csv(result.split_paths[name])
        counts = {r["type"]: r["count"] for r in part.groupBy("type").count().collect()}
        assert counts == {"0": n, "1": n}


def test_job_guards(spark, tmp_path):
    source = write_csv(tmp_path / "raw", "0,1,,text,x.com,A,T,2020-01-01")
    with pytest.raises(ValueError, match="no such way to split"):
        jobs.clean_and_split(spark, "/nowhere.csv", str(tmp_path / "a"), "sideways")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.clean_and_split(spark, str(tmp_path / "none.csv"), str(tmp_path / "b"))
    with pytest.raises(ValueError, match="left no row"):
        jobs.clean_and_split(spark, source, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="no writer"):
        writers.write_table(spark.range(1), str(tmp_path / "d"), "xml")


@pytest.mark.parametrize("method", splits.SPLIT_METHODS)
def test_split_job_is_disjoint_and_complete(spark, tmp_path, method):
    table = spark.range(30).select(
        "id", (F.col("id") % 2).cast("int").alias("type"),
        F.timestamp_seconds(F.col("id") * 1000).alias("scraped_at"))
    source = writers.write_table(table, str(tmp_path / "table"))
    paths = jobs.split_job(spark, source, str(tmp_path / "out"), method)
    ids = [row["id"] for p in paths.values() for row in spark.read.parquet(p).collect()]
    assert sorted(ids) == list(range(30))
    again = jobs.split_job(spark, source, str(tmp_path / "out"), method)
    assert spark.read.parquet(again["train"]).count() == 24


def test_stream_equals_batch(spark, tmp_path):
    columns = "id string, type string, content string, domain string, scraped_at string"
    batches = [
        [("1", "fake", "First TEXT 12", "a", "2020-01-01"), ("2", None, "x", "a", "2020-01-01")],
        [("3", "reliable", "second running text", "b", "junk"),
         ("4", "political", "third running www.a.b", "b", "2020/01/03")],
    ]
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    whole = None
    for rows in batches:
        batch = spark.createDataFrame(rows, columns)
        batch.write.mode("append").parquet(source)
        whole = batch if whole is None else whole.unionByName(batch)
        stream = incremental.read_stream(spark, source, batch.schema)
        incremental.append_cleaned(stream, out, state).awaitTermination()
    streamed = spark.read.parquet(out)
    expected = jobs.prepare_articles(whole)
    assert sorted(map(tuple, streamed.select(expected.columns).collect())) == sorted(
        map(tuple, expected.collect()))


def test_vocabulary_grows_batch_by_batch(spark, tmp_path):
    source, store, state = (str(tmp_path / name) for name in ("in", "terms", "state"))
    for texts in (["a b", "b c"], ["c d"], ["a d"]):
        batch = spark.createDataFrame([(t,) for t in texts], "text string")
        batch.write.mode("append").parquet(source)
        stream = incremental.read_stream(spark, source, batch.schema)
        incremental.track_vocabulary(stream, "text", store, state).awaitTermination()
    found = [row["term"] for row in incremental.read_vocabulary(spark, store).collect()]
    assert sorted(found) == ["a", "b", "c", "d"]
    by_batch = spark.read.parquet(store).groupBy("batch").count().collect()
    assert {row["batch"]: row["count"] for row in by_batch}[0] == 3


def test_corpus_report(spark):
    rows = [
        (str(i), "word " * (i + 1) + "www.a.b 12", "word " * (i + 1), "word", i % 2, f"d{i % 3}")
        for i in range(20)
    ]
    df = spark.createDataFrame(
        rows, "id string, content string, content_normalized string, "
        "content_processed string, type int, domain string")
    report = jobs.corpus_report(df)
    assert report["label_distribution"].filter("type = 1").first()["percent"] == 50.0
    stats = report["length_stats"].filter("type = 0").first()
    assert (stats["mean"], stats["maximum"]) == (1.0, 1)
    assert report["length_histogram"].agg(F.sum("n")).first()[0] == 20
    assert report["top_words_normalized"].first()["term"] == "word"
    assert report["artefact_stats"].filter("feature = 'url_count'").first()["total"] == 20


def test_missing_sources_are_counted(spark):
    from textlake.operators.profile import top_sources

    df = spark.createDataFrame(
        [(0, None), (0, None), (0, "b"), (1, "a")], "type int, domain string")
    rows = {(r["type"], r["domain"]): r["n"] for r in top_sources(df).collect()}
    assert rows == {(0, "missing"): 2, (0, "b"): 1, (1, "a"): 1}


def test_cleaning_keeps_columns_that_only_some_rows_fill(spark):
    df = spark.createDataFrame(
        [("1", "fake", "a", None), ("2", "fake", "b", "x")],
        "id string, type string, content string, tags string")
    assert "tags" in cleaning.initial_cleaning(df).columns


def test_chronological_parts_are_in_time_order(spark, tmp_path):
    table = spark.range(200).select(
        "id", F.timestamp_seconds(F.xxhash64("id") % 100_000).alias("scraped_at")).repartition(5)
    source = writers.write_table(table, str(tmp_path / "table"))
    for path in jobs.split_job(spark, source, str(tmp_path / "out"), "chronological").values():
        times = [r["scraped_at"] for r in spark.read.parquet(path).coalesce(1).collect()]
        files = sorted(spark.read.parquet(path).select(
            F.input_file_name().alias("f"), "scraped_at").groupBy("f").agg(
                F.min("scraped_at"), F.max("scraped_at")).collect())
        bounds = [x for row in files for x in row[1:]]
        assert times and bounds == sorted(bounds)


def test_dates_are_utc_in_any_session_zone(spark):
    from textlake.functions.timestamps import parse_mixed
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2018-01-25 10:00:00", "Fri, 26 Jan 2018 10:00 GMT", "1/25/18", "25.01.2018 5:00 PM",
                 "20180125T101010", "2018-01-25T10:00:00+02:00", "2/1/2018", "never", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(F.unix_seconds(parse_mixed(F.col("t")))).collect()]
        assert got == [1516874400, 1516960800, 1516838400, 1516899600, 1516875010, 1516867200,
                       1517443200, None, None]
        day = df.select(F.unix_seconds(parse_mixed(F.col("t"), day_first=True))).collect()[6][0]
        assert day == 1514851200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_folder_is_shared_or_refused(spark):
    from types import SimpleNamespace

    from textlake import session
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    far = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="executors share"):
        session.shared_folder(far)
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_readers_keep_layouts_and_lines(spark, tmp_path):
    from textlake.sources import readers
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text("id,type,content\n1,fake,hello\n3,real,\n")
    two.write_text("type,id,content\nfake,2,world\n")
    rows = readers.read_articles_csv(spark, [str(one), str(two)]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "fake", "hello"), ("2", "fake", "world"), ("3", "real", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text('a,b\n1,2\n3,4,\n5\n6,"7,8"\n9,10,11\n')
    rows = readers.read_articles_csv(spark, str(bad), skip_bad_lines=True).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "2"), ("5", None), ("6", "7,8")]
    tsv = tmp_path / "s.tsv"
    tsv.write_text('1\ttrue\t"line one\nline two"\n2\tfalse\tplain\n')
    rows = readers.read_statements_tsv(spark, str(tsv), ["id", "statement"]).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "line one\nline two"), ("2", "plain")]
