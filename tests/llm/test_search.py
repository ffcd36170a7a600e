import math

import duckdb
import numpy as np
import pytest

from tests.compare import differences
from textlake.llm import hilbert, impact

SCHEMA = "vec_id long, embedding array<float>, v string, cid int"


def brute(rows, k=20, every=20):
    out = {}
    for i, a in rows.items():
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in rows.items() if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(2)
    made = random.normal(size=(500, 12)).astype(np.float32)
    made[100:180] = made[100]
    made[7] = 0
    rows = [(i, [float(x) for x in made[i]], "", 0) for i in range(500)]
    rows += [(500, None, "", 0), (520, [1.0, None] + [0.0] * 10, "", 0),
             (540, [math.nan] + [0.0] * 11, "", 0), (560, [math.inf] + [0.0] * 11, "", 0),
             (580, [1.0], "", 0), (None, [1.0] * 12, "", 0), rows[33], rows[40]]
    return spark.createDataFrame(rows, SCHEMA), {r[0]: r[1] for r in rows[:500]}


def found(df):
    out = {}
    for row in sorted(df.collect()):
        out.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(out[row["query_id"]])
    return out


def test_impact_is_exact(table):
    df, rows = table
    ints = {i: [math.floor(64 * x) for x in v] for i, v in rows.items()}
    assert found(impact.top_k(df)) == brute(ints)


def test_impact_keeps_large_components(spark):
    random = np.random.default_rng(6)
    made = random.normal(size=(300, 8))
    made[::10] *= 20_000
    made[::30] *= 100
    made[5] = [16_384.0] + [0.0] * 7
    made[20] = [2.0 ** 24 + 1] + [0.0] * 7
    made[25] = [0.0, 2.0 ** 70] + [0.0] * 6
    made[np.arange(300) != 25, 1] = 0
    rows = {i: [float(x) for x in v] for i, v in enumerate(made)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    ints = {i: [math.floor(64 * x) for x in v] for i, v in rows.items()}
    assert found(impact.top_k(df, every=5)) == brute(ints, every=5)


def test_impact_refuses_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds a long"):
        impact.top_k(df).collect()


def test_impact_stops_early_with_the_same_result():
    random = np.random.default_rng(4)
    vectors = np.floor(64 * random.standard_t(3, size=(4000, 32))).astype(np.int64)
    queries = vectors[:50]
    q, v, score = impact.search_block(np.arange(50), queries, np.arange(4000), vectors, 10)
    scores = queries @ vectors.T
    scores[np.arange(50), np.arange(50)] = scores.min() - 1
    for i in range(50):
        want = np.lexsort((np.arange(4000), -scores[i]))[:10]
        assert v[q == i].tolist() == want.tolist()
        assert score[q == i].tolist() == scores[i][want].tolist()


def test_hilbert_finds_all_in_a_small_table(table):
    df, rows = table
    rows = {i: v for i, v in rows.items() if i != 7}
    got, want = found(hilbert.nearest(df)), brute(rows)
    assert got.keys() == want.keys()
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]])


def test_hilbert_windows_have_recall(spark):
    """Small windows on clustered vectors: far fewer comparisons, recall kept."""
    random = np.random.default_rng(5)
    centres = random.normal(size=(60, 16))
    made = (centres[random.integers(60, size=6000)] + 0.25 * random.normal(size=(6000, 16)))
    made /= np.linalg.norm(made, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)],
                               "vec_id long, embedding array<double>")
    got = found(hilbert.nearest(df, every=100, block_rows=200, curves=8))
    scores = made @ made.T
    hits = 0
    for i in range(0, 6000, 100):
        scores[i, i] = -9
        hits += len(set(np.argsort(-scores[i])[:20]) & {j for j, _ in got[i]})
    assert hits / (60 * 20) >= 0.9


@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_hilbert_recall_holds_without_structure(spark, spread):
    """Many blocks of isotropic vectors, of equal and of unequal lengths."""
    random = np.random.default_rng(9)
    made = random.normal(size=(16000, 64))
    made *= (np.exp(spread * random.normal(size=16000)) / np.linalg.norm(made, axis=1))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)],
                               "vec_id long, embedding array<double>")
    got = found(hilbert.nearest(df, every=100, block_rows=128))
    scores = made @ made.T
    hits = 0
    for i in range(0, 16000, 100):
        scores[i, i] = -np.inf
        hits += len(set(np.argsort(-scores[i])[:20]) & {j for j, _ in got[i]})
    assert hits / (160 * 20) >= 0.9


def test_blocks_cover_what_is_asked_but_never_all():
    ranks = np.array([[0, 9], [1, 9], [9, 0], [9, 2]])
    assert hilbert.blocks_needed(ranks, 100, 1.0) == 3
    assert hilbert.blocks_needed(ranks, 100, 0.75) == 2
    assert hilbert.blocks_needed(ranks, 3, 1.0) == 2
    assert hilbert.blocks_needed(np.array([[0]]), 2, 1.0) == 1


@pytest.mark.parametrize("kind, most", [("isotropic", 0.5), ("clustered", 0.2)])
def test_less_than_half_of_all_pairs_are_compared(spark, monkeypatch, kind, most):
    random = np.random.default_rng(13)
    made = random.normal(size=(40_000, 64)).astype(np.float32)
    if kind == "clustered":
        made = (random.normal(size=(300, 64))[random.integers(300, size=40_000)]
                + 0.3 * made).astype(np.float32)
    made /= np.linalg.norm(made, axis=1)[:, None]
    df = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<float>")
    kept = {}
    store = hilbert.stored
    monkeypatch.setattr(
        hilbert, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    got = found(hilbert.nearest(df, every=200))
    read = kept["sought"].selectExpr("sum(size(blocks)) AS n").first()["n"]
    assert read * -(-40_000 // hilbert.BLOCKS) < most * 200 * 40_000
    hits = 0
    for i in range(0, 40_000, 200):
        scores = made.astype(float) @ made[i].astype(float)
        scores[i] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {j for j, _ in got[i]})
    assert hits / (200 * 20) >= 0.9


@pytest.mark.parametrize("search", [hilbert.nearest, impact.top_k])
def test_vectors_of_three_lengths(spark, search):
    random = np.random.default_rng(17)
    rows = {i: [float(x) for x in np.round(random.normal(size=(2, 3, 5)[i % 3]), 2)]
            for i in range(240)}
    ints = rows if search is hilbert.nearest else {
        i: [math.floor(64 * x) for x in v] for i, v in rows.items()}
    want = {}
    for size in (2, 3, 5):
        want |= brute({i: v for i, v in ints.items() if len(v) == size}, every=20)
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = found(search(df))
    assert got.keys() == want.keys()
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
    if search is impact.top_k:
        connection = duckdb.connect()
        connection.register("embeddings", df.toArrow())
        assert differences(search(df), connection, impact.TOP_K_SQL) is None


def test_hilbert_keys_walk_the_grid():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert.hilbert_keys(grid, 3)
    walk = grid[np.argsort(keys)]
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("search", [hilbert.nearest, impact.top_k])
def test_empty_and_tiny(spark, search):
    assert search(spark.createDataFrame([], SCHEMA)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], "", 0), (20, [0.5, 0.5], "", 0)], SCHEMA)
    assert [(r["query_id"], r["vec_id"]) for r in sorted(search(two).collect())] == [(0, 20), (20, 0)]
