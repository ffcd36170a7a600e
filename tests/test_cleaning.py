import pytest
from pyspark.sql import functions as F

from textlake.operators import chunks, cleaning

COLUMNS = (
    "`Unnamed: 0` int, id string, inserted_at string, updated_at string, type string, "
    "content string, domain string, authors string, title string, scraped_at string, "
    "all_null string"
)
UNCLEAN = [
    (0, "10", "2023-01-01", "2023-01-01", "reliable", "Some text here.", "example.com", "Alice",
     None, "2023-10-01", None),
    (1, None, "2023-01-02", "2023-01-02", None, "More text.", "test.com", None, "Title B",
     "invalid_date", None),
    (2, "30", "2023-01-03", "2023-01-03", "blog", None, "demo.com", "Charlie", "Title C",
     "2023-10-03", None),
    (3, "40", "2023-01-04", "2023-01-04", "news", "Valid content.", None, None, "Title D",
     "2023-10-04", None),
]


def test_initial_cleaning(spark):
    cleaned = cleaning.initial_cleaning(spark.createDataFrame(UNCLEAN, COLUMNS))
    for gone in ("Unnamed: 0", "inserted_at", "updated_at", "all_null"):
        assert gone not in cleaned.columns
    (row,) = cleaned.collect()
    assert (row["id"], row["type"], row["title"], row["authors"]) == ("10", 0, "no_title", "Alice")
    types = dict(cleaned.dtypes)
    assert types["scraped_at"] == "timestamp" and types["type"] == "int"


def test_summary_counts_each_reason_once(spark):
    rows = [
        ("0", "fake", "a", "x.com", "2020-01-01"), ("1", "fake", "b", "x.com", "not-a-date"),
        ("2", "fake", "c", "x.com", "2020-01-03"), (None, "fake", "d", "x.com", "not-a-date"),
    ]
    df = spark.createDataFrame(
        rows, "id string, type string, content string, domain string, scraped_at string")
    assert tuple(cleaning.clean_summary(df).first()) == (4, 1, 1, 2, 2)
    kept = cleaning.initial_cleaning(df).orderBy("id").collect()
    assert [row["id"] for row in kept] == ["0", "2"]


def test_unknown_types_are_one_and_tables_are_not_cleaned_twice(spark):
    df = spark.createDataFrame(
        [("1", "political", "a"), ("2", "satire", "b")], "id string, type string, content string")
    cleaned = cleaning.initial_cleaning(df)
    assert [row["type"] for row in cleaned.orderBy("id").collect()] == [0, 1]
    with pytest.raises(ValueError, match="already been cleaned"):
        cleaning.initial_cleaning(cleaned)


def test_missing_column_is_reported_before_any_work(spark):
    with pytest.raises(ValueError, match="content"):
        cleaning.initial_cleaning(spark.createDataFrame([("1", "x")], "id string, type string"))


def test_empty_table(spark):
    cleaned = cleaning.initial_cleaning(spark.createDataFrame([], COLUMNS))
    assert cleaned.isEmpty() and "all_null" not in cleaned.columns


def test_align_union_follows_first_layout(spark):
    first = spark.createDataFrame([(1, "a")], "id long, text string")
    second = spark.createDataFrame([("x", 2)], "extra string, id int")
    result = cleaning.align_union(first, second)
    assert result.columns == ["id", "text"]
    assert sorted(map(tuple, result.collect())) == [(1, "a"), (2, None)]


def test_map_chunks(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "val long").repartition(3)
    doubled = chunks.map_chunks(df, lambda pdf: pdf.assign(val=pdf["val"] * 2), "val long")
    assert sorted(row["val"] for row in doubled.collect()) == [2, 4, 6, 8]
    named = chunks.map_chunks_with_terms(
        df, lambda pdf: {"even": {str(v) for v in pdf["val"] if v % 2 == 0}, "all": {"any"}})
    assert sorted(map(tuple, named.collect())) == [("all", "any"), ("even", "2"), ("even", "4")]


def test_na_words_only_apply_where_asked(spark, tmp_path):
    from textlake.sources.readers import read_articles_csv

    (tmp_path / "a.csv").write_text(
        'id,type,content\n007,fake,"line one\nline ""two"", end"\n8,NA,nan\n9,real\n')
    path = str(tmp_path / "a.csv")
    rows = {row["id"]: row for row in read_articles_csv(spark, path).collect()}
    assert rows["007"]["content"] == 'line one\nline "two", end'
    assert rows["8"]["type"] is None and rows["8"]["content"] is None
    assert rows["9"]["content"] is None
    kept = read_articles_csv(spark, path, na_values=[]).filter(F.col("id") == "8").first()
    assert kept["content"] == "nan"


def test_bad_lines_are_skipped(spark, tmp_path):
    from textlake.sources.readers import read_articles_csv

    (tmp_path / "b.csv").write_text("id,type\n1,a\n2,b,c\n3\n")
    rows = read_articles_csv(spark, str(tmp_path / "b.csv"), ["id"], skip_bad_lines=True)
    assert sorted(row["id"] for row in rows.collect()) == ["1", "3"]
    with pytest.raises(ValueError, match="Missing columns"):
        read_articles_csv(spark, str(tmp_path / "b.csv"), ["nope"])


def test_statement_files_are_concatenated(spark, tmp_path):
    from textlake.sources.readers import read_statements_tsv

    fields = "\t".join(["job", "state", "party", "1", "2", "3", "4", "5", "context"])
    for name, label in (("train", "true"), ("valid", "odd")):
        (tmp_path / f"{name}.tsv").write_text(
            f'{name}.json\t{label}\tSays "x" is y\tsubject\tspeaker\t{fields}\n')
    paths = [str(tmp_path / "train.tsv"), str(tmp_path / "valid.tsv")]
    rows = read_statements_tsv(spark, paths).orderBy("id").collect()
    assert [row["label"] for row in rows] == ["true", "odd"]
    assert rows[0]["statement"] == 'Says "x" is y' and rows[0]["pants_fire_counts"] == 5.0
    pruned = read_statements_tsv(spark, paths, ["id", "label", "statement"])
    assert pruned.columns == ["id", "label", "statement"]
