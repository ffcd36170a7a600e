import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from tests.compare import differences
from textlake.llm import spelling


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


@pytest.fixture(scope="module")
def documents(spark):
    random.seed(11)
    stems = ["abcdefg", "straßeñe", "wordlike", "aaaaaaaa", "çédilleÿ", "banana×"]
    words = []
    for stem in stems:
        for _ in range(40):
            at = random.randrange(len(stem) + 1)
            words.append(random.choice([
                stem, stem[:at] + stem[at + 1:], stem[:at] + random.choice("abéÿ") + stem[at:],
                stem[:at] + random.choice("xyß") + stem[at + 1:]]))
    chain = [("chained", 625), ("chainedx", 125), ("chainexdx", 25), ("chainexdxy", 5)]
    rows = [(i, " ".join(random.choices(words, k=60))) for i in range(120)]
    rows += [(1000 + i, f"{w.upper()}-" * n) for i, (w, n) in enumerate(chain)]
    rows += [(2000, None), (2001, ""), (None, "nokeyword " * 9), (None, None), rows[0], rows[0]]
    return spark.createDataFrame(
        [(key, text, text, 1) for key, text in rows], "doc_id long, text string, word string, n int")


@pytest.mark.parametrize("hot", [1, spelling.HOT_WORDS])
def test_equals_brute_force_and_sql(documents, hot):
    found = spelling.spelling_forms(documents, hot_words=hot)
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == want
    assert any(w == "chainexdxy" and root == "chained" for w, _, root, *_ in want)
    connection = duckdb.connect()
    connection.register("documents", documents.toArrow())
    assert differences(found, connection, spelling.SPELLING_SQL) is None


def test_pairs_are_complete(spark):
    random.seed(4)
    words = sorted({"".join(random.choices("ab", k=random.randint(6, 9))) for _ in range(150)})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    want = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    for hot in (1, 1000):
        pairs = spelling.near_pairs(table, hot).collect()
        assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want


def test_tables_of_words_are_not_broadcast(spark, documents, monkeypatch):
    """Exploded chunks and grams pass for no larger than the stored words they are made of."""
    plans, store = [], spelling.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(spelling, "stored", stored)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    found = spelling.spelling_forms(documents)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    joins = re.findall(r"(BroadcastHash|SortMerge)Join .*?(Inner|LeftOuter)", "\n".join(plans))
    assert len(joins) >= 6 and {kind for kind, _ in joins} == {"SortMerge"}


def test_long_words(spark):
    random.seed(6)
    long = "".join(random.choices("abc", k=20_000))
    words = [long, long[1:], long + "a", long[:10_000] + "z" + long[10_001:], "q" + long[1:],
             long[:9_999] + long[10_000:], long[:66], long[:65], "z" + long[:65], long[:64],
             long[:32] + "z" + long[33:65], long[::-1]]
    want = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    table = spark.createDataFrame([(w,) for w in words], "word string")
    for hot in (2, 1000):
        pairs = spelling.near_pairs(
            table if hot > 2 else table.filter("length(word) < 100"), hot).collect()
        assert {frozenset(p) for p in pairs} == {
            p for p in want if hot > 2 or max(map(len, p)) < 100}
    text = f"{long} {long[1:]} " * 5
    found = spelling.spelling_forms(spark.createDataFrame([(0, text)], "doc_id long, text string"))
    assert sorted(map(len, (r["word"] for r in found.collect()))) == [19_999, 20_000]


def test_empty(no_documents):
    assert spelling.spelling_forms(no_documents).count() == 0


def test_rounds_follow_every_chain():
    for largest in (0, 5, 24, 25, 124, 125, 625, 3125, 10 ** 12):
        steps, n = 0, 5
        while n * 5 <= largest:
            n, steps = n * 5, steps + 1
        assert 2 ** spelling.chain_rounds(largest) >= steps
