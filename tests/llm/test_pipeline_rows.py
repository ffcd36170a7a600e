import hashlib
import random

import corpus_pipeline
from textlake.llm import setjoin

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each_group(rows):
    """Brute force: every pair of rows compared, the first of each component kept."""
    rows = sorted(rows, key=lambda r: (
        r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest(), r[2], r[3]))
    sets, first = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= setjoin.PERCENT * len(a | sets[j]):
                low, high = sorted((root(i), root(j)))
                first[high] = low
    return sorted(map(str, (r for i, r in enumerate(rows) if first[i] == i)))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    out = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert out.columns == corpus_pipeline.COLUMNS
    return sorted(str(tuple(row)) for row in out.collect())


def test_one_row_of_each_group_with_odd_keys(spark):
    random.seed(3)
    text = lambda: " ".join(random.choice("abcdefghijklmnop") * 3 + str(random.randrange(99))
                            for _ in range(60))
    one, two, three, four = text(), text(), text(), text()
    row = lambda key, t, source="a": (key, t, "en", source, len(t or ""))
    rows = [row(5, one), row(5, one), row(5, one, "b"), row(9, one + " end"), row(None, one),
            row(None, two), row(None, two), row(None, two + " more"), row(7, three), row(7, four),
            row(8, four), row(2, three + " x"), row(None, text()), row(1, ""), row(1, ""),
            row(None, ""), row(12, text()), row(13, " ")]
    assert kept(spark, rows) == one_of_each_group(rows)


def test_one_row_of_each_group_with_plain_keys(spark):
    random.seed(4)
    texts = [" ".join(f"w{random.randrange(500)}" for _ in range(50)) for _ in range(12)]
    rows = [(i, texts[i % 12] + (" tail" if i % 3 else ""), "en", "a", 1) for i in range(40)]
    assert kept(spark, rows) == one_of_each_group(rows)
