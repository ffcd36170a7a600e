import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from textlake.llm.queries import ORACLE_SQL, QUERIES

WITHOUT_SQL = sorted(set(QUERIES) - set(ORACLE_SQL))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_keeps_what_each_stage_should(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = documents
    counts = [documents.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == documents.columns
        counts.append(kept.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0.7 * counts[0]
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() == counts[4]


def test_pipeline_on_no_documents(spark):
    kept = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF_DIR)
    assert kept.count() == 0
