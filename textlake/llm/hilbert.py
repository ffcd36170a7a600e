"""Approximate nearest neighbours by shifted space-filling curves.

Random rotations cut the space into slices of a few dimensions. Each slice is one projection: its
vectors are shifted, laid on a grid and ordered along a Hilbert curve, which is range-partitioned
and cut into blocks of equally many rows. On every curve a query reads the blocks whose centre has
the largest inner product with it; neighbouring blocks are merged to windows, and what the windows
of all curves hold is scored in double precision on the original vectors.

How many blocks of a curve a query reads follows from the table: a bounded sample of the queries is
compared with all rows, and the least number that covers RECALL of the sample's true neighbours
serves all queries. It is always below the number of blocks. Tables of one block are read whole.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.llm.common import stored
from textlake.llm.vectors import finite_vectors, is_query, matrix
from textlake.operators.ranking import global_index

#: Curves, blocks of a curve and least rows of a block; smaller tables than BLOCK_ROWS are one block.
CURVES, BLOCKS, LEAST_ROWS, BLOCK_ROWS = 8, 512, 32, 4096
#: Share of the true neighbours of SAMPLE_QUERIES queries that the windows must cover; above the
#: 0.9 asked for by more than the sample's error.
RECALL, SAMPLE_QUERIES = 0.93, 128
#: Blocks that one task reads, rows of these at most, and queries that it compares with them.
RUN_BLOCKS, RUN_ROWS, TASK_QUERIES = 16, 1 << 16, 4096
#: Dimensions of a projection and bits of the grid in each: together at most 62.
GRID_DIMS, GRID_BITS = 8, 7
#: The grid is fitted to at most this many vectors, which also bound the scores worth returning.
SAMPLE_ROWS = 4096
QUERY_STEP = 256
#: Vectors of more different lengths than this in one table are refused.
MAX_LENGTHS = 64


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (a row of coordinates below 2^bits) along the Hilbert curve.

    The transposed form is computed in place, bit by bit for all rows at once, and its bits are
    then interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.int64(1 << level), np.int64((1 << level) - 1)
        for axis in range(dims):
            inverted = (x[axis] & bit) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inverted, low, swapped)
            if axis:
                x[axis] ^= swapped
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & np.int64(1 << level), np.int64((1 << level) - 1), 0)
    x ^= flip
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            keys = (keys << 1) | ((x[axis] >> level) & 1)
    return keys


def fit_curves(sample: np.ndarray, curves: int, seed: int) -> list[tuple]:
    """Axes, lower edge, width and shift of each curve, from a bounded sample of vectors."""
    size = sample.shape[1]
    dims = min(GRID_DIMS, size)
    made = []
    for number in range(curves):
        rotation, slice_ = divmod(number, max(1, size // dims))
        random = np.random.default_rng((seed, rotation))
        axes = np.linalg.qr(random.normal(size=(size, size)))[0][
            :, slice_ * dims:(slice_ + 1) * dims]
        seen = sample @ axes
        low, high = np.quantile(seen, (0.005, 0.995), axis=0)
        shift = np.random.default_rng((seed, number, 1)).random(dims)
        made.append((axes, low, np.maximum(high - low, 1e-12), shift))
    return made


def curve_keys(projected: np.ndarray, curve: tuple) -> np.ndarray:
    """Hilbert keys of projected vectors; the spread fills half the grid, the shift places it."""
    _, low, width, shift = curve
    place = ((projected - low) / width + shift) / 2
    cells = (place.clip(0, 1 - 1e-9) * (1 << GRID_BITS)).astype(np.int64)
    return hilbert_keys(cells, GRID_BITS)


def blocks_of(keys: np.ndarray, ids: np.ndarray, starts: tuple) -> np.ndarray:
    """The block of each (key, id): that of the last start that is not behind it."""
    first_keys, first_ids = starts
    low = np.searchsorted(first_keys, keys, "left")
    high = np.searchsorted(first_keys, keys, "right")
    for at in np.flatnonzero(high > low):
        low[at] += np.searchsorted(first_ids[low[at]:high[at]], ids[at], "right")
    return (low - 1).clip(0)


class Layout:
    """The curves of a table, where their blocks start, and the centres of the blocks."""

    def __init__(self, curves: list[tuple]):
        self.curves = curves
        self.starts: list[tuple] = []
        self.centres: list[np.ndarray] = []

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [curve_keys(vectors @ curve[0], curve) for curve in self.curves]

    def blocks(self, vectors: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """The block of each vector on every curve; one block where there are no curves."""
        if not self.curves:
            return [np.zeros(len(ids), np.int64)]
        return [blocks_of(keys, ids, starts)
                for keys, starts in zip(self.keys(vectors), self.starts)]

    def order(self, queries: np.ndarray) -> list[np.ndarray]:
        """The blocks of every curve, best first for each query."""
        if not self.curves:
            return [np.zeros((len(queries), 1), np.int64)]
        return [np.argsort(-(queries @ curve[0]) @ centres.T, axis=1, kind="stable")
                for curve, centres in zip(self.curves, self.centres)]


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return matrix(pa.chunked_array([batch.column("v")])).astype(float)


def _keys(batches, layout):
    for batch in batches:
        if batch.num_rows:
            for number, keys in enumerate(layout.keys(_vectors(batch))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, number), pa.int32()), pa.array(keys),
                     batch.column("cid")], names=["curve", "place", "cid"])


def _sums(batches, layout, n_blocks):
    """A task's sums of projected vectors by curve, block and axis, and the numbers of rows."""
    dims = len(layout.curves[0][3])
    total = np.zeros((len(layout.curves), n_blocks, dims + 1))
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _vectors(batch)
        for part, curve, block in zip(
                total, layout.curves, layout.blocks(vectors, batch.column("cid").to_numpy())):
            projected = np.column_stack([vectors @ curve[0], np.ones(len(block))])
            np.add.at(part, block, projected)
    curve, block, axis = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(curve, pa.int32()), pa.array(block, pa.int32()), pa.array(axis, pa.int32()),
         pa.array(total[curve, block, axis])], names=["curve", "block", "axis", "total"])


def _placed(batches, layout, slices):
    """Each row once a curve, with its block, the run of blocks and the slice of that."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("cid").to_numpy()
        for number, block in enumerate(layout.blocks(_vectors(batch), ids)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), number), pa.int32()),
                 pa.array(block // RUN_BLOCKS, pa.int32()),
                 pa.array((ids ^ (ids >> 17)) % slices, pa.int32()), pa.array(block, pa.int32()),
                 batch.column("cid"), batch.column("v")],
                names=["curve", "run", "slice", "block", "cid", "v"])


def _sought(batches, layout, wanted, sample, k):
    """For each query and curve the windows it reads: a row a run, with the blocks in it.

    ``least`` is the k-th best score in the sample, so no neighbour among k has a lower one.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        queries = _vectors(batch)
        least = np.full(len(queries), -np.inf)
        if len(sample) >= k:
            for at in range(0, len(queries), QUERY_STEP):
                own = queries[at:at + QUERY_STEP] @ sample.T
                least[at:at + QUERY_STEP] = np.partition(own, len(sample) - k, axis=1)[
                    :, len(sample) - k]
        for number, order in enumerate(layout.order(queries)):
            chosen = np.sort(order[:, :wanted], axis=1)
            query = np.repeat(np.arange(len(queries)), chosen.shape[1])
            block = chosen.ravel()
            run = block // RUN_BLOCKS
            first = np.flatnonzero(np.append(
                True, (np.diff(run) != 0) | (np.diff(query) != 0)))
            rows = pa.array(query[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), number), pa.int32()), pa.array(run[first], pa.int32()),
                 batch.column("cid").take(rows), batch.column("v").take(rows),
                 pa.array(least[query[first]]),
                 pa.ListArray.from_arrays(
                     pa.array(np.append(first, len(block)), pa.int32()),
                     pa.array(block, pa.int32()))],
                names=["curve", "run", "cid", "v", "least", "blocks"])


def _best_of_all(batches, qids, queries, k):
    """The k best rows of a task for each of a few queries, without the query's own."""
    kept = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, queries.shape[1])))] * len(qids)
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _vectors(batch)
        ids = batch.column("cid").to_numpy()
        best, scores = top_scores(queries, vectors, ids, k + 1)
        for at, qid in enumerate(qids):
            other = ids[best[at]] != qid
            joined = [np.concatenate(both) for both in zip(
                kept[at], (scores[at][other], ids[best[at]][other], vectors[best[at]][other]))]
            order = np.lexsort((joined[1], -joined[0]))[:k]
            kept[at] = tuple(part[order] for part in joined)
    for qid, (scores, ids, vectors) in zip(qids, kept):
        if len(ids):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), qid)), pa.array(ids), pa.array(scores),
                 pa.array(vectors.tolist(), pa.list_(pa.float64()))],
                names=["qid", "cid", "score", "v"])


def blocks_needed(ranks: np.ndarray, blocks: int, recall: float) -> int:
    """The least number of blocks a curve that covers ``recall`` of the pairs, not all blocks.

    ``ranks`` has a row for each pair of a query and a true neighbour: on each curve, how many
    blocks the query prefers to the neighbour's.
    """
    nearest = np.sort(ranks.min(1))
    needed = int(nearest[max(0, int(np.ceil(recall * len(nearest))) - 1)]) + 1
    return max(1, min(needed, blocks - 1))


def top_scores(queries, vectors, ids, k) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each query by (score, smaller id), and their scores."""
    scores = queries @ vectors.T
    k = min(k, len(ids))
    least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
    row, column = np.nonzero(scores >= least)
    # the same sum for a pair wherever it turns up
    exact = np.einsum("ij,ij->i", queries[row], vectors[column])
    order = np.lexsort((ids[column], -exact, row))
    row, column, exact = row[order], column[order], exact[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < k
    return column[best].reshape(-1, k), exact[best].reshape(-1, k)


def _compare(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query among the blocks of this run that it reads."""
    names, out = ["qid", "cids", "scores"], ([], [], [])
    if queries.num_rows and rows.num_rows:
        vectors, asked = matrix(rows["v"]).astype(float), matrix(queries["v"]).astype(float)
        ids, qids = rows["cid"].to_numpy(), queries["cid"].to_numpy()
        least = queries["least"].to_numpy()
        least = least - 1e-9 * np.abs(least)
        lists = queries["blocks"].combine_chunks()
        wanted = lists.flatten().to_numpy()
        query = np.repeat(np.arange(len(qids)), lists.value_lengths().to_numpy())
        block = rows["block"].to_numpy()
        of_block = np.argsort(block, kind="stable")
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for number in np.unique(wanted):
            own = of_block[slice(*np.searchsorted(block[of_block], [number, number + 1]))]
            reads = query[wanted == number]
            for start in range(0, len(reads) if len(own) else 0, QUERY_STEP):
                part = reads[start:start + QUERY_STEP]
                q, v = np.nonzero(asked[part] @ vectors[own].T >= least[part][:, None])
                found.append((part[q], own[v]))
        q, v = map(np.concatenate, zip(*found))
        # the same sum for a pair wherever it turns up
        exact = np.concatenate([
            np.einsum("ij,ij->i", asked[q[i:i + 65536]], vectors[v[i:i + 65536]])
            for i in range(0, len(q), 65536)] or [np.zeros(0)])
        order = np.lexsort((ids[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < k
        q, v, exact = q[best], v[best], exact[best]
        first = np.flatnonzero(np.append(True, np.diff(q) != 0))[:len(q)]
        ends = pa.array(np.append(first, len(q)), pa.int32())
        out = (qids[q[first]], pa.ListArray.from_arrays(ends, pa.array(ids[v])),
               pa.ListArray.from_arrays(ends, pa.array(exact)))
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
    return pa.table([pa.array(part, kind) if isinstance(part, (list, np.ndarray)) else part
                     for part, kind in zip(out, kinds)], names=names)


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """``cid, v, ids``: equal vectors as one, with the k smallest of their ids.

    More ids of one vector can't be among k neighbours. Spark limits each group before its
    shuffle, so a vector that many rows share sends k rows a task.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return (
        vectors.withColumn("place", place).filter(F.col("place") <= k)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("cid"), "v", "ids")
    )


def _fitted(
    classes: DataFrame, rows: int, n_blocks: int, sample: np.ndarray, curves: int, seed: int,
) -> Layout:
    """The curves of a table with the starts and centres of their blocks."""
    layout = Layout(fit_curves(sample, curves, seed))
    placed = global_index(
        classes.select("cid", "v").mapInArrow(
            partial(_keys, layout=layout), "curve int, place long, cid long"),
        "curve", "place", "cid").withColumn("at", F.col("row_index") - F.col("curve") * rows)
    starts = placed.filter(F.col("at") % -(-rows // n_blocks) == 0).select(
        "curve", "place", "cid").orderBy("curve", "place", "cid").collect()
    for number in range(curves):
        own = [(row["place"], row["cid"]) for row in starts if row["curve"] == number]
        layout.starts.append(tuple(np.array(part, np.int64) for part in zip(*own)))
    dims = len(layout.curves[0][3])
    sums = np.zeros((curves, n_blocks, dims + 1))
    for row in classes.select("cid", "v").mapInArrow(
            partial(_sums, layout=layout, n_blocks=n_blocks),
            "curve int, block int, axis int, total double").groupBy("curve", "block", "axis").agg(
                F.sum("total").alias("total")).collect():
        sums[row["curve"], row["block"], row["axis"]] = row["total"]
    layout.centres = [
        part[:len(starts[0]), :-1] / part[:len(starts[0]), -1:]
        for part, starts in zip(sums, layout.starts)]
    return layout


def _nearest_of_length(
    vectors: DataFrame, k: int, every: int, curves: int, block_rows: int, seed: int, recall: float,
) -> DataFrame:
    """``nearest`` among vectors of one length."""
    vectors = stored(vectors, "vectors")
    classes = stored(_classes(vectors, k + 1), "vector-classes")
    asked = vectors.filter(is_query(F.col("vec_id"), every)).join(
        classes.select("cid", F.col("v").alias("w")), F.col("v") == F.col("w")).select(
            F.col("vec_id").alias("query_id"), "cid")
    asked = stored(asked, "queries")
    askers = classes.select("cid", "v").join(asked.select("cid").distinct(), "cid", "left_semi")
    by_hash = (F.xxhash64("cid"), "cid")
    rows = classes.count()
    sample = np.array([row["v"] for row in classes.orderBy(*by_hash).limit(SAMPLE_ROWS).select(
        "v").collect()], float)
    layout, wanted, n_blocks = Layout([]), 1, 1
    if rows > block_rows:
        n_blocks = max(2, min(BLOCKS, rows // LEAST_ROWS))
        layout = _fitted(classes, rows, n_blocks, sample, curves, seed)
        tried = askers.orderBy(*by_hash).limit(SAMPLE_QUERIES).collect()
        qids, queries = [row["cid"] for row in tried], np.array([row["v"] for row in tried], float)
        order = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
        pairs = classes.select("cid", "v").mapInArrow(
            partial(_best_of_all, qids=qids, queries=queries, k=k),
            "qid long, cid long, score double, v array<double>").withColumn(
                "rank", F.row_number().over(order)).filter(
                    F.col("rank") <= k).collect() if tried else []
        if pairs:
            at = {qid: i for i, qid in enumerate(qids)}
            query = np.array([at[row["qid"]] for row in pairs])
            held = layout.blocks(np.array([row["v"] for row in pairs]),
                                 np.array([row["cid"] for row in pairs]))
            ranks = [np.argsort(preferred, axis=1)[query, block]
                     for preferred, block in zip(layout.order(queries), held)]
            wanted = blocks_needed(np.column_stack(ranks), len(layout.centres[0]), recall)

    slices = max(1, -(-RUN_BLOCKS * -(-rows // n_blocks) // RUN_ROWS))
    kind = dict(classes.dtypes)["v"]
    seekers = stored(askers.mapInArrow(
        partial(_sought, layout=layout, wanted=wanted, sample=sample, k=k + 1),
        f"curve int, run int, cid long, v {kind}, least double, blocks array<int>"), "sought")
    # a run that many queries read is compared with a part of them at a time
    parts = stored(seekers.groupBy("curve", "run").agg(
        F.ceil(F.count(F.lit(1)) / TASK_QUERIES).cast("int").alias("parts")), "parts")

    def each(limit):
        return F.explode(F.sequence(F.lit(0), limit - 1))

    seekers = seekers.join(parts, ["curve", "run"]).withColumn(
        "part", F.pmod(F.xxhash64("cid"), "parts").cast("int")).drop("parts").withColumn(
            "slice", each(F.lit(slices)))
    placed = classes.select("cid", "v").mapInArrow(
        partial(_placed, layout=layout, slices=slices),
        f"curve int, run int, slice int, block int, cid long, v {kind}").join(
            parts, ["curve", "run"]).withColumn("part", each(F.col("parts"))).drop("parts")
    keys = ["curve", "run", "part", "slice"]
    found = seekers.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(
        partial(_compare, k=k + 1), "qid long, cids array<long>, scores array<double>")
    hits = F.arrays_zip("cids", "scores")
    merged = found.groupBy("qid").agg(F.flatten(F.collect_list(hits)).alias("hits")).select(
        "qid", F.explode(F.slice(F.array_sort(F.array_distinct(F.transform(
            F.filter("hits", lambda h: h["cids"] != F.col("qid")),
            lambda h: F.struct((-h["scores"]).alias("less"), h["cids"].alias("cid"))))),
            1, k + 1)).alias("hit")).select("qid", "hit.*")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    own = askers.select(F.col("cid").alias("qid"), (-squares).alias("less"), "cid")
    members = merged.unionByName(own).join(classes.select("cid", "ids"), "cid")
    ranked = members.groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list(F.transform(
        "ids", lambda i: F.struct("less", i.alias("vec_id")))))), 1, k + 1).alias("hits"))
    own = asked.join(ranked, F.col("cid") == F.col("qid")).select("query_id", F.slice(F.filter(
        "hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k).alias("hits"))
    return own.select("query_id", F.posexplode("hits").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id",
        (-F.col("hit.less")).alias("score"))


def nearest(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    every: int = 20, curves: int = CURVES, block_rows: int = BLOCK_ROWS, seed: int = 42,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product that are found.

    Queries are the rows whose key is divisible by ``every``; a query is no candidate of its own.
    Ties go to the smaller key. Zero vectors take no part, nor do the rows that
    ``finite_vectors`` leaves out. Vectors of different lengths have no inner product: each length
    is searched on its own. Equal vectors are searched once and all found together. With fewer
    than k candidates all are returned; an empty table returns nothing. Very long vectors only
    cost their memory; other columns are not read, whatever their names.

    Tables of at most ``block_rows`` different vectors are one block, and the result is exact.
    Others are read through ``curves`` curves, as many blocks of each as cover ``recall`` of the
    true neighbours of a sample of the queries, never all.
    """
    vectors = finite_vectors(df, key, vector).filter(F.exists("v", lambda x: x != 0))
    single = T.ArrayType(T.FloatType())
    if df.schema[vector].dataType.simpleString() == single.simpleString():
        vectors = vectors.withColumn("v", F.col("v").cast(single))  # half the bytes to shuffle
    vectors = stored(vectors, "finite")
    lengths = [row[0] for row in vectors.select(F.size("v")).distinct().limit(
        MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    parts = [_nearest_of_length(vectors.filter(F.size("v") == length), k, every, curves,
                                block_rows, seed, recall) for length in sorted(lengths)]
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, parts)
