import hashlib
import random

import public_tokenizers
import pytest

from textlake.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.encoding(bpe.load_ranks(RANKS), PATTERN)


def by_matches(coder, text):
    return [i for m in bpe._whole(PATTERN).finditer(text)
            for i in coder._core_bpe.encode_single_piece(m.group().encode())]


def test_cuts_do_not_change_ids(coder):
    random.seed(3)
    letters = "\x1c\x85  ́ab é'sdll0९ \n\t.!中文  ’😀"
    for _ in range(1500):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 50)))
        want = by_matches(coder, text)
        assert want == bpe.encode(coder, text) == bpe.encode(coder, text, 4)
        assert coder.decode_bytes(want) == text.encode()


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" * 200_000, "ab " * 100_000, "\n1" * 90_000])
def test_long_runs(coder, text):
    ids = bpe.encode(coder, text)
    assert coder.decode_bytes(ids) == text.encode()


def test_tables(spark, coder, odd_documents, no_documents):
    rows = bpe.encode_digests(odd_documents, RANKS, PATTERN).collect()
    assert len(rows) == 10
    texts = {r["doc_id"]: r["text"] or "" for r in odd_documents.collect()}
    for row in rows:
        ids = by_matches(coder, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(
            texts[row["doc_id"]].encode()).hexdigest()
    coded = bpe.encode_table(odd_documents, RANKS, PATTERN)
    back = bpe.decode_table(coded, RANKS, PATTERN).collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)
    assert bpe.encode_digests(no_documents, RANKS, PATTERN).count() == 0
    assert bpe.encode_table(no_documents, RANKS, PATTERN).count() == 0
