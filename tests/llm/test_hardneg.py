import math

import numpy as np
import pytest

from textlake.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int, v string, dims int, part int, of int"


def brute(rows, every=50, positives=5, negatives=3):
    whole = {i: ([math.floor(256 * x) for x in v], label) for i, v, label in rows}
    out = []
    for a, (q, of) in whole.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), b, label)
                  for b, (v, label) in whole.items() if b != a and len(v) == len(q)]
        for less, b, _ in sorted(s for s in scores if s[2] == of)[:positives]:
            inside = sorted(s for s in scores
                            if s[2] != of and -50 * less <= -100 * s[0] <= -95 * less)
            out += [(a, b, rank, c, -less, -n)
                    for rank, (n, c, _) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(*row, "", 0, 0, 0) for row in rows], SCHEMA)


def mined(df, **settings):
    return sorted(map(tuple, hardneg.mine(df, **settings).collect()))


@pytest.fixture(scope="module")
def plain():
    random = np.random.default_rng(8)
    vectors = random.normal(size=(700, 6))
    vectors[200:280] = vectors[200]
    vectors[3] = 0
    labels = random.integers(0, 3, 700)
    labels[::2] = 1
    return [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]


def test_equals_brute_force_in_blocks_of_any_size(spark, plain, monkeypatch):
    want = brute(plain, every=10)
    assert len(want) > 200
    assert mined(made(spark, plain), every=10) == want
    monkeypatch.setattr(hardneg, "RUN_BLOCKS", 4)
    assert mined(made(spark, plain), every=10, block_rows=16, part_anchors=7) == want


def test_odd_rows(spark, plain):
    rows = plain[:120]
    rows += [(1000 + i, [float(i % 5), 1.0, float(-i % 7)], i % 2) for i in range(40)]
    rows += [(2000 + i, [], i % 2) for i in range(4)]
    rows += [(2050, [2.0 ** 21, 3.0], 0), (2051, [2.0 ** 21 + 1, 1.0], 0),
             (2052, [2.0 ** 20, -2.0 ** 22], 1), (2053, [1.5 * 2.0 ** 20, 5.0], 1)]
    odd = [(None, [1.0] * 6, 1), (50, None, 1), (3000, [1.0] * 6, None),
           (3050, [math.nan] + [1.0] * 5, 1), (3100, [math.inf] + [1.0] * 5, 1),
           (3150, [None] + [1.0] * 5, 1), rows[7], rows[50]]
    assert mined(made(spark, rows + odd), every=10) == brute(rows, every=10)


def test_few_rows_and_none(spark, plain):
    assert mined(made(spark, plain).limit(0)) == []
    assert mined(made(spark, [(0, [1.0], 1)])) == []
    assert mined(made(spark, [(0, [1.0], 1), (1, [1.0], 2)])) == []
    few = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2), (3, [0.99], 2)]
    assert mined(made(spark, few)) == brute(few)


def test_a_score_beyond_a_long_is_an_error(spark):
    rows = [(0, [2.0 ** 40], 1), (1, [2.0 ** 40], 1), (2, [1.0], 2)]
    with pytest.raises(Exception, match="exceeds a long"):
        mined(made(spark, rows))


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    random = np.random.default_rng(3)
    centres = random.normal(size=(20, 8)) * 10
    rows = [(i, [float(x) for x in centres[i % 20] + random.normal(size=8) * 0.1], i % 2)
            for i in range(2000)]
    seen = {}
    keep = hardneg.stored
    monkeypatch.setattr(
        hardneg, "stored", lambda df, name: seen.setdefault((name, len(seen)), keep(df, name)))
    assert mined(made(spark, rows), block_rows=32, part_anchors=4) == brute(rows)
    tables = {}
    for (name, _), table in seen.items():
        tables.setdefault(name, []).append(table)
    blocks = tables["blocks"][0]
    for needed, pairs in zip(tables["needed"], tables["pairs"]):
        possible = pairs.join(blocks.select("dims", "label", "run"), ["dims", "label", "run"])
        assert needed.count() < 0.6 * possible.count()


def test_intervals_hold_every_score():
    random = np.random.default_rng(1)
    for _ in range(50):
        queries, block = random.normal(size=(9, 5)) * 99, random.normal(size=(30, 5)) * 99
        low, high = hardneg.score_intervals(queries, block.min(0)[None], block.max(0)[None])
        scores = queries @ block.T
        assert (low[:, 0] <= scores.min(1)).all() and (scores.max(1) <= high[:, 0]).all()
