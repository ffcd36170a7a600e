"""Exact order statistics and exact global ranks without a single-task sort.

``fit_cuts`` finds the key that sits at a given position of an ordering. It works like a radix
search: one aggregate counts rows per coarse level of the key, the level value that holds the
position is kept, and only that slice is looked at more finely. Rows are then assigned to
sides of the cut by comparing keys, so wide columns never move.

``global_index`` gives every row its position. Rows are range-partitioned on the full key, so a
hot leading value is spread over tasks by the columns that follow it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.session import shared_folder

# A located slice with at most this many rows is sorted inside one task.
SLICE_ROWS = 100_000
# Larger slices are cut at this many keys of their own, again and again.
PIVOTS = 200


@dataclass(frozen=True)
class Ordering:
    """A total order: ``keys`` ascending. ``levels`` are coarse-to-fine values consistent with it.

    Each level has a bounded number of values within one value of the level before.
    """

    keys: tuple[Column, ...]
    levels: tuple[Column, ...]


@dataclass(frozen=True)
class Cut:
    """Rows of ``stratum`` whose keys are <= ``bound`` lie before the cut.

    ``bound`` is None where no row lies before it.
    """

    stratum: object
    name: str
    bound: tuple | None


def seeded_key(id_column: Column, seed: int) -> Column:
    """Repeatable pseudo-random sort key of a row, independent of partitioning."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), id_column.cast("string")))


def hash_ordering(id_column: Column, seed: int) -> Ordering:
    """Order by the seeded key; levels are two hex digits (256 values) at a time."""
    key = seeded_key(id_column, seed)
    levels = tuple(F.substring(key, start, 2) for start in range(1, 15, 2))
    return Ordering((key, id_column), levels)


def _id_levels(id_column: Column, id_type: T.DataType) -> tuple[Column, ...]:
    if isinstance(id_type, T.IntegralType):
        wide = id_column.cast("long")
        return tuple(F.shiftright(wide, bits) for bits in (48, 32, 16))
    if isinstance(id_type, T.StringType):
        return tuple(F.substring(id_column, start, 2) for start in range(1, 17, 2))
    return ()


def time_ordering(timestamp: Column, id_column: Column, id_type: T.DataType) -> Ordering:
    """Order by time, ties by id; levels go from the day down to the microsecond, then the id."""
    micros = F.unix_micros(timestamp.cast("timestamp"))
    units = (86_400_000_000, 60_000_000, 1_000_000, 1_000)
    levels = tuple(micros - F.pmod(micros, F.lit(unit)) for unit in units)
    return Ordering((micros, id_column), (*levels, micros, *_id_levels(id_column, id_type)))


def _located(rows: Sequence, depth: int, wanted: Mapping) -> dict:
    """For each wanted (stratum, name) -> (prefix, rest), the finer slice that holds it.

    ``rows`` are ``(stratum, level values..., n)``; the result maps to (prefix, rest, n).
    """
    slices: dict = {}
    for row in rows:
        slices.setdefault((row[0], tuple(row[1:depth])), []).append((row[depth], row[depth + 1]))
    found = {}
    for (stratum, name), (prefix, rest) in wanted.items():
        for value, n in sorted(slices[stratum, prefix]):
            if rest <= n:
                found[stratum, name] = (prefix + (value,), rest, n)
                break
            rest -= n
    return found


def _in_slices(keys: DataFrame, prefixes: Sequence[tuple], depth: int) -> DataFrame:
    """Rows in any of the slices ``(stratum, level values)``, which are joined as a small table.

    The slices come from the driver and are sent to all tasks, so the keys are not shuffled by them.
    """
    names = ["_stratum", *(f"_level{i}" for i in range(depth))]
    schema = T.StructType([
        T.StructField(f"_of{i}", keys.schema[name].dataType) for i, name in enumerate(names)])
    wanted = keys.sparkSession.createDataFrame(
        [(stratum, *prefix) for stratum, prefix in prefixes], schema)
    same = reduce(lambda a, b: a & b, [
        F.col(name).eqNullSafe(F.col(f"_of{i}")) for i, name in enumerate(names)])
    return keys.join(F.broadcast(wanted), same, "left_semi")


def _distinct(located: Mapping) -> list[tuple]:
    return list({(stratum, prefix) for (stratum, _), (prefix, _, _) in located.items()})


def _key_by_pivots(rows: DataFrame, key_names: Sequence[str], rest: int) -> tuple:
    """The key of the ``rest``-th row of a slice of any size and any type of key.

    Keys of the slice, picked by hash, cut it into ranges; the rows of each are counted in one
    aggregate, and the range that holds the place is cut again until one task can sort its
    distinct keys.
    """
    key = F.struct(*key_names)
    counted = rows.groupBy(*key_names).agg(F.count(F.lit(1)).alias("_n"))
    while True:
        total = counted.count()
        if total <= SLICE_ROWS:
            order = Window.orderBy(*key_names)
            return tuple(counted.withColumn("_end", F.sum("_n").over(order)).filter(
                F.col("_end") >= rest).orderBy(*key_names).first())[:len(key_names)]
        picked = counted.select(key.alias("key")).orderBy(F.xxhash64(*key_names)).limit(PIVOTS)
        pivots = F.array(*[
            F.struct(*[F.lit(part).alias(name) for name, part in zip(key_names, row["key"])])
            for row in picked.orderBy("key").collect()])
        placed = counted.withColumn(
            "_range", F.size(F.filter(pivots, lambda p: p < key)))
        for row in sorted(placed.groupBy("_range").agg(F.sum("_n").alias("n")).collect()):
            if rest <= row["n"]:
                break
            rest -= row["n"]
        counted = placed.filter(F.col("_range") == row["_range"]).drop("_range")


def fit_cuts(
    df: DataFrame,
    ordering: Ordering,
    positions: Callable[[dict], dict],
    stratum: Column | None = None,
) -> tuple[list[Cut], dict]:
    """Exact cut keys, and the row count of each stratum.

    ``positions`` receives ``{stratum: rows}`` and returns ``{stratum: {cut name: rows before
    the cut}}``. The driver sees level histograms (bounded by the number of level values times
    the number of strata) and one key per cut, never rows. Rows with equal keys fall on the same
    side of a cut.
    """
    depth_max = len(ordering.levels)
    columns = [(F.lit(0) if stratum is None else stratum).alias("_stratum")]
    columns += [level.alias(f"_level{i}") for i, level in enumerate(ordering.levels)]
    columns += [key.alias(f"_key{i}") for i, key in enumerate(ordering.keys)]
    keys = df.select(*columns)
    level_names = [f"_level{i}" for i in range(depth_max)]
    key_names = [f"_key{i}" for i in range(len(ordering.keys))]

    histogram = keys.groupBy("_stratum", "_level0").agg(F.count(F.lit(1)).alias("n")).collect()
    totals: dict = {}
    for row in histogram:
        totals[row[0]] = totals.get(row[0], 0) + row["n"]
    targets = {
        (value, name): rows
        for value, cuts in positions(totals).items() for name, rows in cuts.items()
    }
    wanted = {cut: ((), rows) for cut, rows in targets.items() if rows > 0}
    bounds: dict = {}
    if wanted:
        located = _located(histogram, 1, wanted)
        depth = 1
        while depth < depth_max and any(n > SLICE_ROWS for _, _, n in located.values()):
            finer = (
                _in_slices(keys, _distinct(located), depth)
                .groupBy("_stratum", *level_names[:depth + 1])
                .agg(F.count(F.lit(1)).alias("n")).collect()
            )
            depth += 1
            located = _located(
                finer, depth, {cut: (prefix, rest) for cut, (prefix, rest, _) in located.items()})
        small = {cut: at for cut, at in located.items() if at[2] <= SLICE_ROWS}
        if small:
            bounds = _keys_at(keys, small, level_names[:depth], key_names)
        for (stratum_value, name), (prefix, rest, n) in located.items():
            if n > SLICE_ROWS:
                rows = _in_slices(keys, [(stratum_value, prefix)], depth)
                bounds[stratum_value, name] = _key_by_pivots(rows, key_names, rest)
    return [Cut(value, name, bounds.get((value, name))) for value, name in targets], totals


def _keys_at(
    keys: DataFrame, located: Mapping, levels: Sequence[str], key_names: Sequence[str],
) -> dict:
    """The key at the wanted place of each located slice.

    Rows with equal keys are combined first, so the task that walks a slice sees its distinct
    keys only, however many copies a key has.
    """
    in_slice = Window.partitionBy("_stratum", *levels).orderBy(*key_names)
    counted = (
        _in_slices(keys, _distinct(located), len(levels))
        .groupBy("_stratum", *levels, *key_names).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(in_slice))
    )
    places = F.array(*[F.lit(rest) for rest in sorted({r for _, r, _ in located.values()})])
    held = F.filter(
        places, lambda p: (p <= F.col("_end")) & (p > F.col("_end") - F.col("_n")))
    rows = counted.withColumn("_place", F.explode(held)).collect()
    by_place = {
        (row["_stratum"], tuple(row[name] for name in levels), row["_place"]):
            tuple(row[name] for name in key_names)
        for row in rows
    }
    return {
        cut: by_place[cut[0], prefix, rest] for cut, (prefix, rest, _) in located.items()
    }


def before_cut(keys: Sequence[Column], bound: tuple | None) -> Column:
    """Whether a row's keys are <= the bound, compared column by column."""
    if bound is None:
        return F.lit(False)
    result = keys[-1] <= F.lit(bound[-1])
    for key, value in zip(reversed(keys[:-1]), reversed(bound[:-1])):
        result = (key < F.lit(value)) | ((key == F.lit(value)) & result)
    return result


def assign_by_cuts(
    df: DataFrame, ordering: Ordering, cuts: Sequence[Cut], name: str, last: object,
    stratum: Column | None = None,
) -> DataFrame:
    """Add ``name``: the first cut that a row lies before, else ``last``.

    Without strata this is an expression of the row. With strata the cuts are a table with a row
    for each stratum and joined by it, so their number does not swell the plan. That table comes
    from the driver and is sent to all tasks: a shuffle by stratum would give a task to each class.
    """
    if stratum is None:
        chain = None
        for cut in cuts:
            test = before_cut(ordering.keys, cut.bound)
            chain = (F.when(test, F.lit(cut.name)) if chain is None
                     else chain.when(test, F.lit(cut.name)))
        return df.withColumn(name, F.lit(last) if chain is None else chain.otherwise(F.lit(last)))
    spark = df.sparkSession
    kinds = df.select(*[key.alias(f"k{i}") for i, key in enumerate(ordering.keys)]).schema
    bound = T.StructType([T.StructField(f.name, f.dataType) for f in kinds])
    kind = df.select(stratum.alias("s")).schema["s"].dataType
    schema = T.StructType([
        T.StructField("_of", kind),
        T.StructField("_cuts", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()), T.StructField("bound", bound)])))])
    by_stratum: dict = {}
    for cut in cuts:
        own = by_stratum.setdefault(cut.stratum, [])
        if cut.bound is not None:
            own.append((cut.name, cut.bound))
    table = spark.createDataFrame(list(by_stratum.items()), schema)
    key = F.struct(*[key.alias(f"k{i}") for i, key in enumerate(ordering.keys)])
    joined = df.join(F.broadcast(table), stratum.eqNullSafe(F.col("_of")), "left")
    above = F.filter("_cuts", lambda cut: key <= cut["bound"])
    return joined.withColumn(
        name, F.coalesce(F.get(above, F.lit(0))["name"], F.lit(last))).drop("_of", "_cuts")


def global_index(df: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the given order.

    One range shuffle places and sorts the rows; a checkpoint fixes that placement, so that the
    partition counts and the positions agree even if executors are lost later. Pass narrow
    tables: whatever is in ``df`` is shuffled once.
    """
    spark = df.sparkSession
    shared_folder(spark)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_placed", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_placed", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    offsets, start = [], 0
    for row in sorted(counts.collect()):
        offsets.append((row["_part"], start))
        start += row["n"]
    starts = spark.createDataFrame(offsets, "_part long, _start long")
    local = F.col("_placed").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_part", "_start", "_placed")
    )
