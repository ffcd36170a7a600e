"""Hard negatives, mined from Hilbert-ordered Parquet blocks through their zone maps.

The rows of each label are ordered along a Hilbert curve of their main directions and written as
Parquet blocks: a row a block, with the vectors as one array and the least and largest value of
each dimension beside it. A search asks for scores inside windows. Interval arithmetic over the
zone maps alone gives the scores that a block can have at all; only blocks whose interval meets a
window of some anchor are read, and each is compared only with the anchors that need it.

An anchor's positives are one such search: the window reaches from the score that its own block
already offers to the top, over the blocks of its label. The windows of its negatives follow from
the scores of the positives, over the blocks of all other labels.

The stated anchors are held against all rows in blocks: the work grows with both.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored
from textlake.llm.hilbert import hilbert_keys
from textlake.operators.ranking import global_index

SCALE = 256
#: Rows of a block (one zone map), blocks of a run (one task), and anchors of a task.
BLOCK_ROWS, RUN_BLOCKS, PART_ANCHORS = 1024, 64, 8192
#: The curve is fitted to at most this many vectors; it decides the order only, never a result.
SAMPLE_ROWS = 1024
GRID_DIMS, GRID_BITS = 4, 14
ANCHOR_STEP, SALTS = 1024, 16

LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_RUN = ["dims", "label", "run"]
_TASK = ["dims", "of", "part", "label", "run"]
_KEYS = "dims int, of long, part long, label long, run long"


def scaled_rows(
    df: DataFrame, key: str, vector: str, label: str, scale: int = SCALE,
) -> DataFrame:
    """``vec_id, label, dims, v``: rows that take part, one per key, components floor(scale * x)."""
    def whole(x: Column) -> Column:
        made = x * F.lit(float(scale))
        # doubles from 2^53 on are whole numbers, and may be beyond a long
        return F.when(F.abs(made) < float(1 << 53), F.floor(made).cast("double")).otherwise(made)

    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double")).alias("v"))
    held = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    ).filter(~odd)
    least = held.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return least.select(
        "vec_id", "row.label", F.size("row.v").alias("dims"),
        F.transform("row.v", whole).alias("v"))


def rows_as_matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(len(column), dims)


# --- order ---------------------------------------------------------------------------------


def fit_curves(sample: list[list[float]]) -> dict[int, tuple]:
    """Centre, main directions, lower edges and widths, for each vector length in the sample."""
    curves = {}
    for dims in {len(v) for v in sample if v}:
        seen = np.array([v for v in sample if len(v) == dims])
        centre = seen.mean(0)
        axes = np.linalg.svd(seen - centre, full_matrices=False)[2][:GRID_DIMS].T
        spread = (seen - centre) @ axes
        low, high = np.quantile(spread, (0.005, 0.995), axis=0)
        curves[dims] = (centre, axes, low, np.maximum(high - low, 1e-12))
    return curves


def _place(batches, curves):
    for batch in batches:
        places = np.zeros(batch.num_rows, np.int64)
        lengths = batch.column("dims").to_numpy()
        for dims in np.unique(lengths):
            if int(dims) in curves:
                centre, axes, low, width = curves[int(dims)]
                own = lengths == dims
                vectors = rows_as_matrix(
                    pa.chunked_array([batch.column("v").filter(pa.array(own))]), int(dims))
                at = (((vectors - centre) @ axes - low) / width).clip(0, 1 - 1e-9)
                places[own] = hilbert_keys((at * (1 << GRID_BITS)).astype(np.int64), GRID_BITS)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(places)], names=[*batch.schema.names, "place"])


# --- exact scores and bounds ---------------------------------------------------------------


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact, as 64-bit integers; LOW where one exceeds them."""
    if not (np.isfinite(queries).all() and np.isfinite(vectors).all()):
        raise ValueError("a scaled component exceeds a double")
    sizes = [int(np.abs(part).max(initial=0)) for part in (queries, vectors)]
    bound = queries.shape[1] * sizes[0] * sizes[1]
    if bound < 1 << 53:
        return (queries @ vectors.T).astype(np.int64)
    if bound < 1 << 63:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    made = whole(queries) @ whole(vectors).T
    beyond = ((made <= LOW) | (made > HIGH)).astype(bool)
    return np.where(beyond, LOW, made).astype(np.int64)


def score_intervals(
    queries: np.ndarray, low: np.ndarray, high: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each query can have in each box, with room for rounding."""
    up, down = queries.clip(min=0), queries.clip(max=0)
    slack = 1e-9 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T) + 0.5
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


# --- blocks --------------------------------------------------------------------------------

_BLOCK = (
    "dims int, label long, run long, block int, ids array<long>, vals array<double>, "
    "low array<double>, high array<double>, seeds array<struct<vec_id: long, least: long>>")


def _pack(key, rows, every, k, block_rows):
    """The blocks of a run, each with its zone map and, for its anchors, the k-th best score here."""
    dims, label, run = (part.as_py() for part in key)
    within = rows["within"].to_numpy()
    order = np.argsort(within)
    ids, block = rows["vec_id"].to_numpy()[order], within[order] // block_rows
    vectors = rows_as_matrix(rows["v"], dims)[order]
    made = []
    for number in np.unique(block):
        own = block == number
        held, v = ids[own], vectors[own]
        at = np.flatnonzero(held % every == 0)
        seeds = []
        for start in range(0, len(at), ANCHOR_STEP):
            asked = at[start:start + ANCHOR_STEP]
            scores = products(v[asked], v)
            scores[np.arange(len(asked)), asked] = LOW
            least = np.full(len(asked), LOW + 1)
            if len(held) > k:
                least = np.partition(scores, len(held) - k, axis=1)[:, len(held) - k]
            seeds += [{"vec_id": int(held[i]), "least": max(int(s), int(LOW) + 1)}
                      for i, s in zip(asked, least)]
        made.append((int(number), held, v.ravel(), v.min(0), v.max(0), seeds))
    columns = list(zip(*made))
    n = len(made)
    return pa.table([
        pa.array([dims] * n, pa.int32()), pa.array([label] * n, pa.int64()),
        pa.array([run] * n, pa.int64()), pa.array(columns[0], pa.int32()),
        pa.array(columns[1], pa.list_(pa.int64())),
        *(pa.array(columns[i], pa.list_(pa.float64())) for i in (2, 3, 4)),
        pa.array(columns[5], pa.list_(pa.struct([("vec_id", pa.int64()), ("least", pa.int64())])))],
        names=["dims", "label", "run", "block", "ids", "vals", "low", "high", "seeds"])


def placed_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place`` on the curve and ``within``, the position among those of the label."""
    sample = rows.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    curves = fit_curves([row["v"] for row in sample])
    placed = rows.mapInArrow(
        partial(_place, curves=curves),
        "vec_id long, label long, dims int, v array<double>, place long")
    indexed = global_index(placed, "dims", "label", "place", "vec_id")
    starts = indexed.groupBy("dims", "label").agg(F.min("row_index").alias("start"))
    return indexed.join(starts, ["dims", "label"]).withColumn(
        "within", F.col("row_index") - F.col("start")).drop("row_index", "start")


def zoned_blocks(placed: DataFrame, every: int, k: int, block_rows: int) -> DataFrame:
    """The written blocks of all rows."""
    runs = placed.select("dims", "label", "vec_id", "v", "within").withColumn(
        "run", F.floor(F.col("within") / (block_rows * RUN_BLOCKS)))
    return stored(runs.groupBy(*_RUN).applyInArrow(
        partial(_pack, every=every, k=k, block_rows=block_rows), _BLOCK), "blocks")


# --- search --------------------------------------------------------------------------------


def _limits(anchors: pa.Table) -> list[np.ndarray]:
    """Lower and upper ends of each anchor's windows, a column a window; none is an empty one."""
    lists = [anchors[name].to_pylist() for name in ("lows", "highs")]
    width = max((len(ends) for ends in lists[0]), default=0)
    ends = [np.full((anchors.num_rows, width), none, np.int64) for none in (HIGH, LOW)]
    for made, values in zip(ends, lists):
        for at, row in enumerate(values):
            made[at, :len(row)] = row
    return ends


def _meets(queries: np.ndarray, ends: list[np.ndarray], zones: pa.Table) -> np.ndarray:
    """Which anchors (rows) need which blocks (columns)."""
    boxes = [rows_as_matrix(zones[name], queries.shape[1]) for name in ("low", "high")]
    least, largest = score_intervals(queries, *boxes)
    met = np.zeros(least.shape, bool)
    for low, high in zip(*(part.T for part in ends)):
        # the ends of all integers are open: scores beyond them are errors, which must be met
        a = np.where(low == LOW + 1, -np.inf, low * (1 - 1e-9 * np.sign(low)))[:, None]
        b = np.where(high == HIGH, np.inf, high * (1 + 1e-9 * np.sign(high)))[:, None]
        met |= (low <= high)[:, None] & (largest >= a) & (least <= b)
    return met


def _needed(key, anchors: pa.Table, zones: pa.Table) -> pa.Table:
    """The blocks of a run that some anchor of a part must read."""
    blocks = zones["block"].to_numpy()
    wanted = np.zeros(len(blocks), bool)
    if anchors.num_rows and len(blocks):
        ends, queries = _limits(anchors), rows_as_matrix(anchors["v"], key[0].as_py())
        for start in range(0, len(queries), ANCHOR_STEP):
            own = slice(start, start + ANCHOR_STEP)
            wanted |= _meets(queries[own], [part[own] for part in ends], zones).any(0)
    blocks = blocks[wanted]
    kinds = [pa.int32()] + [pa.int64()] * 4
    return pa.table(
        [*(pa.array([part.as_py()] * len(blocks), kind) for part, kind in zip(key, kinds)),
         pa.array(blocks, pa.int32())], names=[*_TASK, "block"])


def _best_of(parts: list[np.ndarray], windows: int, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The k best (row, window, less, id) of each row and window in order, and their ranks."""
    row, window, less, ids = parts
    order = np.lexsort((ids, less, row * windows + window))
    parts = [part[order] for part in parts]
    group = parts[0] * windows + parts[1]
    rank = np.arange(len(group)) - np.searchsorted(group, group)
    return [part[rank < k] for part in parts], rank[rank < k]


def _search(
    qids: np.ndarray, queries: np.ndarray, ends: list[np.ndarray], met: np.ndarray,
    blocks: list[tuple[np.ndarray, np.ndarray]], k: int,
) -> list[np.ndarray]:
    """Row, window, ~score and id of the k best rows of the needed blocks in each window.

    Once a window is full, its lower end rises to the k-th score.
    """
    floor, high = ends[0].copy(), ends[1]
    windows = floor.shape[1]
    kept = [np.zeros(0, np.int64)] * 4
    for number, (ids, vectors) in enumerate(blocks):
        asked = np.flatnonzero(met[:, number])
        if not len(asked):
            continue
        scores = products(queries[asked], vectors)
        beyond = np.argwhere(scores == LOW)
        if (qids[asked[beyond[:, 0]]] != ids[beyond[:, 1]]).any():
            raise ValueError(f"a score of {qids[asked[beyond[0, 0]]]} exceeds a long")
        made = [kept]
        for window in range(windows):
            inside = scores >= floor[asked, window][:, None]
            inside &= scores <= high[asked, window][:, None]
            row, column = np.nonzero(inside)
            other = qids[asked[row]] != ids[column]
            row, column = row[other], column[other]
            made.append([asked[row], np.full(len(row), window), ~scores[row, column], ids[column]])
        kept, rank = _best_of(list(map(np.concatenate, zip(*made))), windows, k)
        last = rank == k - 1
        floor[kept[0][last], kept[1][last]] = ~kept[2][last]
    return kept


def _found(key, anchors: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """For each anchor of a part and each window, the k best rows of the blocks it needs."""
    out = [[np.zeros(0, np.int64)] * 4]
    if anchors.num_rows and blocks.num_rows:
        dims = key[0].as_py()
        qids, queries = anchors["vec_id"].to_numpy(), rows_as_matrix(anchors["v"], dims)
        ends = _limits(anchors)
        held = []
        for ids, values in zip(blocks["ids"], blocks["vals"]):
            ids = ids.values.to_numpy()
            held.append((ids, values.values.to_numpy().reshape(len(ids), dims)))
        for start in range(0, len(qids), ANCHOR_STEP):
            own = slice(start, start + ANCHOR_STEP)
            part = [side[own] for side in ends]
            found = _search(
                qids[own], queries[own], part, _meets(queries[own], part, blocks), held, k)
            out.append([qids[own][found[0]], *found[1:]])
    qid, window, less, vec_id = map(np.concatenate, zip(*out))
    starts = np.flatnonzero(np.append(True, qid[1:] != qid[:-1]))[:len(qid)]
    hits = pa.StructArray.from_arrays(
        [pa.array(window, pa.int32()), pa.array(less), pa.array(vec_id)],
        names=["w", "less", "id"])
    return pa.table(
        [pa.array(qid[starts]), pa.ListArray.from_arrays(
            pa.array(np.append(starts, len(qid)), pa.int32()), hits)], names=["vec_id", "hits"])


def search_windows(anchors: DataFrame, blocks: DataFrame, same_label: bool, k: int) -> DataFrame:
    """``vec_id, w, at, id, score``: per anchor and window the k best rows inside the window.

    ``anchors`` has ``dims, of, part, vec_id, v, lows, highs``. An anchor meets the blocks of its
    own label ``of`` or of all others, of vectors as long as its own, and never itself.
    """
    runs = blocks.select(*_RUN).distinct()
    parts = anchors.select("dims", "of", "part").distinct()
    if same_label:
        pairs = parts.join(runs.withColumn("of", F.col("label")), ["dims", "of"])
    else:
        salted = parts.withColumn("salt", F.pmod(F.hash("of", "part"), F.lit(SALTS)))
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        pairs = salted.join(runs.withColumn("salt", every), ["dims", "salt"]).filter(
            F.col("of") != F.col("label"))
    pairs = stored(pairs.select(*_TASK), "pairs")
    askers = anchors.join(pairs, ["dims", "of", "part"])
    zones = blocks.select(*_RUN, "block", "low", "high").join(pairs, _RUN)
    needed = stored(askers.groupBy(*_TASK).cogroup(zones.groupBy(*_TASK)).applyInArrow(
        _needed, f"{_KEYS}, block int"), "needed")
    asked = askers.join(needed.select(*_TASK).distinct(), _TASK, "left_semi")
    read = blocks.drop("seeds").join(needed, [*_RUN, "block"])
    found = asked.groupBy(*_TASK).cogroup(read.groupBy(*_TASK)).applyInArrow(
        partial(_found, k=k),
        "vec_id long, hits array<struct<w: int, less: long, id: long>>")
    merged = found.groupBy("vec_id").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias(
        "hits"))
    windows = F.array_distinct(F.transform("hits", lambda h: h["w"]))
    best = merged.select("vec_id", "hits", F.explode(windows).alias("w")).select(
        "vec_id", "w", F.posexplode(F.slice(F.filter(
            "hits", lambda h: h["w"] == F.col("w")), 1, k)).alias("at", "hit"))
    return best.select(
        "vec_id", "w", "at", "hit.id", F.bitwise_not("hit.less").alias("score"))


def mine(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = SCALE, block_rows: int = BLOCK_ROWS, part_anchors: int = PART_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose key is divisible by ``every``. An anchor's positives are its
    ``positives`` best other rows of its label by inner product of floor(scale * x); for each, the
    ``negatives`` best rows of other labels whose score lies between ``low`` and ``high`` percent
    of the positive's are returned. Ties go to the smaller key; fewer are returned where there
    are fewer, and none where a positive's score is negative.

    Rows with a null key, label or vector, or with null or non-finite components, take no part.
    Of several rows with one key the smallest by label, then vector, does. Vectors of different
    lengths have no score with each other; each length is searched on its own, whatever it is,
    very long ones in smaller numbers a task. Scores are exact for components of any size; one
    that exceeds a long is an error. Other columns are not read, whatever their names. An empty
    table returns nothing.
    """
    placed = stored(placed_rows(scaled_rows(df, key, vector, label, scale)), "placed")
    blocks = zoned_blocks(placed, every, positives, block_rows)
    seeds = blocks.select(F.explode("seeds").alias("seed")).select("seed.*")
    chosen = placed.filter(F.col("vec_id") % every == 0).select(
        "dims", F.col("label").alias("of"), "place", "vec_id", "v")
    anchors = global_index(chosen, "dims", "of", "place", "vec_id").withColumn(
        "part", F.floor(F.col("row_index") / part_anchors)).join(seeds, "vec_id")
    anchors = stored(anchors.select("dims", "of", "part", "vec_id", "v", "least"), "anchors")

    upward = anchors.withColumns({
        "lows": F.array("least"), "highs": F.array(F.lit(int(HIGH)))}).drop("least")
    best = stored(search_windows(upward, blocks, True, positives), "positives")
    positive = F.col("score").cast("decimal(20,0)")
    limits = best.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct(
        "at", F.ceil(positive * low / 100).cast("long").alias("low"),
        F.floor(positive * high / 100).cast("long").alias("high")))).alias("ends"))
    windows = anchors.join(limits, "vec_id").select(
        "dims", "of", "part", "vec_id", "v",
        F.col("ends.low").alias("lows"), F.col("ends.high").alias("highs"))
    hard = search_windows(windows, blocks, False, negatives)
    return hard.select(
        F.col("vec_id").alias("anchor_id"), F.col("w").alias("of"),
        (F.col("at") + 1).cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    ).join(best.select(
        F.col("vec_id").alias("anchor_id"), F.col("at").alias("of"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    ), ["anchor_id", "of"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


HARD_NEGATIVES_SQL = """
WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
