import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textlake.llm import setjoin, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def shingle_set(text):
    words = words_of(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """n_shingles and component of each row, comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(rows[a][0]), root(rows[b][0])))
            parent[y] = x
    return sorted((k, len(s), root(k)) for (k, _), s in zip(rows, sets))


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_set_sizes_equal_python_sets():
    random.seed(1)
    texts = ["", None, "  ", "One", "a b c d", "a b c d e", "A b C d E a b c d e", "x" * 5000,
             "é É ß   a b", "a\x0bb\x0cc\td\re\nf", "\x1ca b c d e f"]
    texts += [" ".join(random.choice("abcd") * random.randint(1, 20) for _ in range(
        random.randint(0, 60))) for _ in range(300)]
    sets = list(shingles.shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    sliced = list(shingles.shingle_sets(pa.array(texts).slice(3, 40)))
    assert all((a == b).all() for a, b in zip(sets[3:43], sliced))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 9, 12, 17, 31, 32, 40, 63, 64, 100, 300, 1000])
def test_every_linked_pair_shares_a_signature(size):
    """Sets at the limit, equal and different in size, with some shingles called frequent."""
    random_ = np.random.default_rng(size)
    for _ in range(60):
        base = random_.integers(0, 1 << 63, size, dtype=np.int64).view(np.uint64)
        keep = size - random_.integers(0, max(1, size // 9 + 1))
        new = random_.integers(0, max(1, size // 4 + 1))
        other = np.concatenate([base[:keep], random_.integers(
            0, 1 << 63, new, dtype=np.int64).view(np.uint64)])
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        common = np.sort(base[: size // 2])
        frequent = (common, random_.integers(1, 99, len(common)))
        assert len(np.intersect1d(
            setjoin.signatures(a, frequent), setjoin.signatures(b, frequent)))


def test_sketch_never_above_difference():
    random_ = np.random.default_rng(3)
    for _ in range(300):
        a, b = (np.unique(random_.integers(0, 3000, random_.integers(1, 2500)).astype(np.uint64))
                for _ in range(2))
        table = setjoin.folded([setjoin.sketch(a).tobytes(), setjoin.sketch(b).tobytes()])
        assert np.abs(table[0] - table[1]).sum() <= len(np.setxor1d(a, b))


def edited(words, n):
    words = list(words)
    for _ in range(n):
        words[random.randrange(len(words))] = f"new{random.random()}"
    return words


def test_components_against_all_pairs(spark):
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [random.choice(vocabulary) for _ in range(60)]
    rows = []
    for group in range(25):
        base = [random.choice(vocabulary) for _ in range(random.choice([3, 6, 12, 40, 150, 400]))]
        for _ in range(random.choice([1, 2, 5, 20])):
            rows.append(edited(base, random.randint(0, 1 + len(base) // 60)))
    rows += [[random.choice(vocabulary) for _ in range(30)] + passage for _ in range(80)]
    rows += [passage] * 30
    random.shuffle(rows)
    rows = [(i * 3, " ".join(words)) for i, words in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(setjoin.link_sets(docs)) == brute(rows)


def test_chain_of_copies(spark):
    """Each text links to the next one only."""
    words = [f"t{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[4 * i:4 * i + 60])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(setjoin.link_sets(docs)) == brute(rows)


def test_given_documents(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert result(setjoin.link_sets(small)) == brute(rows)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = setjoin.link_sets(odd_documents).collect()
    assert len(rows) == 10
    component = {r["doc_id"]: r["component_id"] for r in rows}
    assert component == {1: 1, 2: 2, 3: 3, None: 1, 5: 5, 6: 1, 8: 8, 9: 9, 10: 10}
    assert setjoin.link_sets(no_documents).count() == 0


def test_one_key_with_two_texts(spark):
    words = [f"k{i}" for i in range(80)]
    rows = [(5, " ".join(words[:30])), (5, " ".join(words[40:70])),
            (9, " ".join(words[:30])), (3, " ".join(words[40:70]))]
    got = setjoin.link_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {3}
