"""Exact top-k search by inner product over an impact-ordered index, score at a time.

The rows are dealt into blocks. A block keeps a posting for each non-zero component of its rows,
ordered by impact (the component's size), highest first, and cut into segments. Segments are
added to the scores of a group of queries at once. After a segment, what is left of a row can
change its score by no more than the lengths of its rest and of the query multiplied; a block is
left early only when this proves all but a few rows out of the k best. Those are scored exactly.

Pairs with a vector whose components are too large for these sums are all scored, in whichever
of doubles, 64-bit and unbounded integers is exact for them.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.common import stored
from textlake.llm.vectors import finite_vectors, is_query, matrix

SCALE = 64
BLOCK_ROWS, GROUP_QUERIES = 8192, 512
SEGMENTS = 24
#: Components of this size or more may not add up exactly; their vectors are scored apart.
MAX_IMPACT = 1 << 20


def quantised(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` with components floor(scale * x), as doubles of any size."""
    def whole(x):
        scaled = x * F.lit(float(scale))
        # doubles from 2^53 on are whole numbers, and may be beyond a long
        return F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(
            scaled)

    return finite_vectors(df, key, vector).select("vec_id", F.transform("v", whole).alias("v"))


def segments(vectors: np.ndarray, count: int = SEGMENTS):
    """Postings by descending impact: per segment a list of (dimension, rows, values)."""
    rows, dims = np.nonzero(vectors)
    values = vectors[rows, dims]
    order = np.argsort(-np.abs(values), kind="stable")
    for part in np.array_split(order, count):
        part = part[np.argsort(dims[part], kind="stable")]
        starts = np.flatnonzero(np.diff(dims[part], prepend=-1))
        yield [(dims[own[0]], rows[own], values[own])
               for own in np.split(part, starts[1:]) if len(own)]


def _exact(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores of the pairs (q, v), a bounded number at a time."""
    return np.concatenate([
        np.einsum("ij,ij->i", queries[q[i:i + 65536]], vectors[v[i:i + 65536]])
        for i in range(0, len(q), 65536)] or [np.zeros(0, np.int64)])


def search_block(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of each query's k best rows, by (score, smaller id), without itself."""
    lengths = np.sqrt((queries.astype(float) ** 2).sum(1))
    rest = (vectors.astype(float) ** 2).sum(1)
    # sums stay below 2^24, where single precision counts every integer
    small = np.sqrt(rest.max()) * lengths.max() < 1 << 24
    kind = np.float32 if small else np.float64
    scores = np.zeros((len(ids), len(qids)), kind)
    weights = np.ascontiguousarray(queries.T.astype(kind))
    order = np.argsort(ids)
    at = np.searchsorted(ids[order], qids).clip(0, len(ids) - 1)
    own = ids[order][at] == qids
    scores[order[at[own]], np.flatnonzero(own)] = -np.inf
    few = max(4 * k, len(ids) // 50) * len(qids)
    take = min(k, len(ids))
    possible = np.isfinite(scores)
    for step, segment in enumerate(segments(vectors) if len(ids) > 2 * k else (), 1):
        for dim, rows, values in segment:
            scores[rows] += values.astype(kind)[:, None] * weights[dim]
            rest[rows] -= values.astype(float) ** 2
        if step < SEGMENTS // 3 or step % 2 and step < SEGMENTS:
            continue
        # k real scores of each query: its k-th best score can't be lower than their least
        seen = np.argpartition(scores, len(ids) - take, axis=0)[len(ids) - take:]
        q = np.repeat(np.arange(len(qids)), take)
        real = _exact(queries, vectors, q, seen.T.ravel()).astype(float)
        real[~np.isfinite(scores[seen.T.ravel(), q])] = -np.inf
        least = real.reshape(-1, take).min(1)
        slack = np.sqrt(rest.clip(0))[:, None] * lengths * (1 + 1e-5) + 0.01
        possible = (scores + slack >= least) & np.isfinite(scores)
        if possible.sum() <= few:
            break
    v, q = np.nonzero(possible)
    score = _exact(queries, vectors, q, v)
    order = np.lexsort((ids[v], -score, q))
    v, q, score = v[order], q[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], v[best], score[best]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All scores of whole numbers, exact: 64-bit integers, or Python's where those may overflow."""
    bound = len(queries[0]) * int(np.abs(queries).max()) * int(np.abs(vectors).max())
    if bound < 1 << 53:
        return (queries @ vectors.T).astype(np.int64)
    if bound < 1 << 63:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    unbounded = np.frompyfunc(int, 1, 1)
    return unbounded(queries) @ unbounded(vectors).T


def search_all(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``search_block``, for components of any size and without leaving out a pair."""
    def sizes(rows):
        return [int(x).bit_length() // 10 for x in np.abs(rows).max(1, initial=0)]

    scores = np.zeros((len(qids), len(ids)), np.int64)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    q_sizes, v_sizes = np.array(sizes(queries)), np.array(sizes(vectors))
    # rows of like size together, so that one large vector does not slow down the others
    for q_size in np.unique(q_sizes) if queries.shape[1] else ():
        for v_size in np.unique(v_sizes):
            q, v = np.flatnonzero(q_sizes == q_size), np.flatnonzero(v_sizes == v_size)
            made = _products(queries[q], vectors[v])
            if made.dtype == object:
                beyond = ((made < low) | (made > high)).astype(bool)
                if (beyond & (qids[q][:, None] != ids[v])).any():
                    at, other = np.argwhere(beyond & (qids[q][:, None] != ids[v]))[0]
                    raise ValueError(
                        f"the score of {qids[q[at]]} and {ids[v[other]]} exceeds a long")
                made = np.where(beyond, 0, made).astype(np.int64)  # a query with itself
            scores[np.ix_(q, v)] = made
    out = []
    for at, qid in enumerate(qids):
        rows = np.flatnonzero(ids != qid)
        less = ~scores[at, rows]  # descending, also for the least integer
        if len(rows) > k:
            near = less <= np.partition(less, k - 1)[k - 1]
            rows, less = rows[near], less[near]
        rows = rows[np.lexsort((ids[rows], less))[:k]]
        out.append((np.full(len(rows), at), rows, scores[at, rows]))
    return tuple(np.concatenate(part) for part in zip(*out))


def _search(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    if queries.num_rows and block.num_rows:
        qids, ids = queries["vec_id"].to_numpy(), block["vec_id"].to_numpy()
        asked, vectors = matrix(queries["v"]), matrix(block["v"])
        if not (np.isfinite(asked).all() and np.isfinite(vectors).all()):
            raise ValueError("a scaled component exceeds a double")
        q_large = np.abs(asked).max(1, initial=0) >= MAX_IMPACT
        v_large = np.abs(vectors).max(1, initial=0) >= MAX_IMPACT
        every = np.ones(len(ids), bool)
        for search, q, v in ((search_block, ~q_large, ~v_large), (search_all, ~q_large, v_large),
                             (search_all, q_large, every)):
            if q.any() and v.any():
                kind = np.int64 if search is search_block else float
                at, row, score = search(
                    qids[q], asked[q].astype(kind), ids[v], vectors[v].astype(kind), k)
                for column, part in zip(out, (qids[q][at], ids[v][row], score)):
                    column.append(part)
    return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in out],
                    names=["query_id", "vec_id", "score"])


def top_k(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    every: int = 20, scale: int = SCALE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores over all other rows.

    Components count as floor(scale * x). Queries are the rows whose key is divisible by
    ``every``. Ties go to the smaller key. Rows that ``finite_vectors`` leaves out take no part; a
    zero vector does, with score 0. Vectors of different lengths have no score with each other,
    however long they are. Other columns are not read, whatever their names. Scores are exact for components of any size; one that exceeds
    a long is an error. With fewer than k candidates all are returned; an empty table returns
    nothing.

    The query set is held against all rows in blocks: each pair of a query group and a block is
    one task's work and returns k rows a query.
    """
    rows = stored(quantised(df, key, vector, scale), "quantised")
    asked = rows.filter(is_query(F.col("vec_id"), every))
    n_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    n_groups = max(1, -(-asked.count() // GROUP_QUERIES))
    spread = F.xxhash64("vec_id")
    blocks = rows.withColumn("block", F.pmod(spread, F.lit(n_blocks))).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    every_block = F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))
    groups = asked.select(
        F.col("vec_id").alias("vec_id"), F.col("v").alias("v"),
        F.pmod(spread, F.lit(n_groups)).cast("int").alias("group"),
        F.explode(every_block).alias("block"))
    # vectors of different lengths have no score with each other
    keys = [F.size("v"), "group", "block"]
    found = groups.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(
        partial(_search, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding,
             lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
      FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
