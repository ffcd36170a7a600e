import pytest

from tests.conftest import SF_DIR

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "One two three four five six seven.\nSecond line here.\nThird line here.\nEnd", "en", "a", 5),
        (2, "", "en", "b", 0),
        (3, None, None, None, None),
        (None, "One two three four five six seven.\nSecond line here.\nThird line here.\nEnd", "en", "a", 5),
        (5, long_text, "en", "a", len(long_text)),
        (6, "One two three four five six seven.\nSecond line here.\nThird line here.\nEnd", "en", None, 5),
        (6, "One two three four five six seven.\nSecond line here.\nThird line here.\nEnd", "en", None, 5),
        (8, "   \n\t ", "de", "c", 6),
        (9, "x" * 100_000, "de", "c", 100_000),
        (10, "12345 !!! 😀 é", None, "c", 14),
    ]
    table = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("h", "row", "rep", "sig", "ids", "n_tokens", "lines", "covered", "target", "own"):
        table = table.withColumn(name, table["doc_id"])
    return table


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
