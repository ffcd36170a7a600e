import random

import public_tokenizers
import pytest

from textlake.llm import tokencount

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tables():
    return tokencount.merges(tokencount.load_model(MODEL))


def by_library(tables, text):
    return len(tables.library.encode(text)) if text else 0


@pytest.mark.parametrize("leftmost", [2, tokencount.LEFTMOST_SYMBOLS])
def test_random_texts(tables, monkeypatch, leftmost):
    monkeypatch.setattr(tokencount, "LEFTMOST_SYMBOLS", leftmost)
    random.seed(5)
    letters = "▁ aabcdething\n\t\x00éß中文😀<s>/0xЖТ é"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 70)))
             for _ in range(2000)]
    counts = tokencount.count_texts(texts, tables, {})
    assert counts == [by_library(tables, text) for text in texts]


@pytest.mark.parametrize("text", [
    " " * 50_000, "a" * 50_000, "abcde" * 10_000, "中文字符测试" * 5_000, "😀" * 9_000,
    "<s></s><unk><0x0A>", "▁", " ", "\n"])
def test_long_runs_and_signs(tables, text):
    assert tokencount.count_texts([text], tables, {}) == [by_library(tables, text)]


def test_groups_and_cache_do_not_change_counts(tables, monkeypatch, small):
    texts = [row["text"] for row in small.select("text").collect()]
    want = [by_library(tables, text) for text in texts]
    monkeypatch.setattr(tokencount, "ROUND_SYMBOLS", 50)
    monkeypatch.setattr(tokencount, "CACHED", 10)
    cache = {}
    got = [n for at in range(0, len(texts), 20)
           for n in tokencount.count_texts(texts[at:at + 20], tables, cache)]
    assert got == want


def test_tables(spark, tables, odd_documents, no_documents):
    rows = tokencount.token_counts(odd_documents, MODEL, limit=100).collect()
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in odd_documents.collect()]
    for row, source in zip(rows, odd_documents.collect()):
        text = source["text"] or ""
        assert row["n_bytes"] == len(text.encode())
        assert row["n_tokens"] == by_library(tables, text)
        assert row["over_limit"] == (row["n_tokens"] > 100)
    assert tokencount.token_counts(no_documents, MODEL).count() == 0
