from collections import defaultdict

import pytest

from textlake.llm import mixing


def filled(sizes, weights, total, epochs):
    """Targets by the textbook loop."""
    open_, targets = set(sizes), {}
    while True:
        left = total - sum(targets.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > epochs * sizes[s]}
        if not over:
            return targets | share
        targets |= {s: epochs * sizes[s] for s in over}
        open_ -= over


def test_targets_and_takes(spark):
    rows, number = [], 0
    for source, n, words in (("a", 4, 3), ("b", 60, 20), ("c", 40, 5), ("d", 1, 2), (None, 30, 9)):
        for _ in range(n):
            rows.append((number, " ".join(["w"] * (words + number % 3)), source))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(docs).collect()
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(got) == sorted(again)
    sizes, taken = defaultdict(int), defaultdict(int)
    source = {r[0]: r[2] for r in rows}
    for row in got:
        sizes[source[row["doc_id"]]] += row["size"]
        taken[source[row["doc_id"]]] += row["taken"]
        assert row["taken"] <= 3 * row["size"]
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    want = filled(sizes, weights, sum(sizes.values()), 3)
    for row in got:
        name = source[row["doc_id"]]
        assert row["source_size"] == sizes[name]
        assert row["target"] == pytest.approx(want[name])
    for name in sizes:
        assert abs(taken[name] - want[name]) <= 11


def test_mix_repeats_rows(spark, small):
    report = {r["doc_id"]: r["repeats"] for r in mixing.mix_report(small).collect()}
    mixed = defaultdict(int)
    for row in mixing.mix(small).select("doc_id").collect():
        mixed[row["doc_id"]] += 1
    assert {k: n for k, n in report.items() if n} == mixed


def test_odd_rows(odd_documents, no_documents):
    rows = mixing.mix_report(odd_documents).collect()
    assert len(rows) == 10
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 8)} == {0}
    assert mixing.mix(odd_documents).columns == odd_documents.columns
    assert mixing.mix_report(no_documents).count() == 0 == mixing.mix(no_documents).count()
    same = [r["repeats"] for r in rows if r["doc_id"] == 6]
    assert same[0] == same[1]


def test_names_with_dots(spark, small):
    plain = mixing.mix_report(small)
    dotted = small.withColumnsRenamed({"doc_id": "a.id", "text": "a.text", "source": "of.it"})
    options = {"key": "a.id", "text": "a.text", "source": "of.it"}
    assert sorted(mixing.mix_report(dotted, **options).collect()) == sorted(plain.collect())
    assert mixing.mix(dotted, **options).columns == dotted.columns
