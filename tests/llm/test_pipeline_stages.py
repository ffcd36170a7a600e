"""Stages of the pipeline on odd rows, against plain Python; the whole pipeline without a crash."""

import base64
import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from textlake.llm import langid

COLUMNS = corpus_pipeline.COLUMNS


def counted(df):
    return Counter(tuple(row) for row in df.select(df.columns).collect())


@pytest.fixture(scope="module")
def mixed(odd_documents, small):
    """Odd rows beside plain ones, all of the plain ones twice under the same ids."""
    plain = small.filter("doc_id < 40 AND length(text) < 3000").select(COLUMNS)
    return odd_documents.unionByName(plain.unionByName(plain), allowMissingColumns=True)


def test_language(spark, mixed):
    got = counted(corpus_pipeline.identify_language(spark, mixed, ""))
    learned = langid.learn(mixed.filter(~langid.is_held_out(F.col("doc_id"))))
    held = tuple(sorted(learned.items()))
    want = Counter()
    for doc_id, text, _, source, n_chars in mixed.select(COLUMNS).collect():
        lang, _, rejected = langid.classify(text, held)
        if not rejected:
            want[doc_id, text, lang, source, n_chars] += 1
    assert got == want and sum(want.values()) > 20


def test_mixing(spark, mixed):
    rows = mixed.select(COLUMNS)
    got = counted(corpus_pipeline.mix_sources(spark, rows, ""))
    have = counted(rows)
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for (_, text, _, source, _), n in have.items():
        sizes[source] += n * size(text)
        largest[source] = max(largest[source], n * size(text))
    for row, n in got.items():
        assert n <= 3 * have[row]
        taken[row[3]] += n * size(row[1])
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names) if sizes[name]}
    target, left, total = {}, dict(weights), sum(sizes.values())
    while left:
        level = (total - sum(target.values())) / sum(left.values())
        full = [s for s in left if left[s] * level > 3 * sizes[s]]
        target |= {s: 3 * sizes[s] for s in full} if full else {
            s: w * level for s, w in left.items()}
        left = {s: w for s, w in left.items() if s not in full} if full else {}
    for name in weights:
        assert abs(taken[name] - target[name]) <= largest[name], name


def test_tokens(spark, mixed):
    path = public_tokenizers.path(corpus_pipeline.RANK_FILE)
    pairs = (line.split() for line in open(path, "rb") if line.strip())
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for doc_id, text in mixed.select("doc_id", "text").collect():
        ids = plain.encode_ordinary(text or "")
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert counted(corpus_pipeline.encode_tokens(spark, mixed, "")) == want


@pytest.mark.parametrize("empty", [False, True])
def test_whole_pipeline(spark, mixed, tmp_path, empty):
    mixed.limit(0 if empty else 1000).write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert (rows.count() == 0) == empty
