"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source has a weight and may be read ``max_epochs`` times at most. The total is shared by
weight; a source whose share is above its cap is clamped to it, and the excess goes to the others
by weight, again and again until no share is above its cap. A source whose target is ``r`` times
its size takes every document ``floor(r)`` times, and once more those documents that come first
in a seeded order, up to the target.

Only DataFrame operations. No step sorts or collects the documents of a source: the place where
the seeded order is cut is found from histograms of the hash, level by level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.common import WORD, stored
from textlake.operators.ranking import global_index

HASH_BITS = 60
LEVEL_BITS = 10
LEVELS = 2


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(key: Column, text: Column, seed: int) -> Column:
    """60 bits of md5 over seed and key; a row without a key is placed by its text."""
    name = F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.md5(
        F.coalesce(text, F.lit("")))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_weights(sources: DataFrame, cycle: Sequence[float]) -> DataFrame:
    """Add ``weight``: the values of ``cycle`` in turn, by source in code point order, null last."""
    ranked = global_index(
        sources.withColumn("no_source", F.col("source").isNull()), "no_source", "source",
        name="place")
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return ranked.withColumn(
        "weight", F.get(values, F.pmod("place", F.lit(len(cycle))).cast("int")),
    ).drop("no_source", "place")


def fill_targets(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)`` by capped water-filling.

    Each round is one aggregate of two numbers over the sources. Clamping only raises the level
    of the others, so a source once clamped stays so and the rounds end.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["n"] == clamped or row["open"] == 0:
            break
        clamped, level = row["n"], (total - row["held"]) / row["open"]
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _extra_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, cut)``: rows whose hash is <= cut are taken once more.

    Each level splits the located slice of a source into 2^LEVEL_BITS parts and finds the one in
    which the running size passes what is wanted; the last one orders the distinct hashes that
    are left, about a millionth of a source. The row at the cut is taken if half of it fits.
    """
    located = targets.select(
        F.col("source").alias("of"), F.lit(0).cast("long").alias("slice"), "wanted")
    rows = sizes
    for level in range(1, LEVELS + 1):
        part = F.shiftright("h", HASH_BITS - LEVEL_BITS * level)
        held = rows.join(located, F.col("source").eqNullSafe(F.col("of")) & (
            F.shiftright("h", HASH_BITS - LEVEL_BITS * (level - 1)) == F.col("slice")))
        parts = held.groupBy("source", part.alias("part")).agg(
            F.sum("size").alias("n"), F.first("wanted").alias("wanted"))
        order = Window.partitionBy("source").orderBy("part")
        located = stored(
            parts.withColumn("end", F.sum("n").over(order)).filter(
                (F.col("end") >= F.col("wanted")) & (F.col("end") - F.col("n") < F.col("wanted")))
            .select(F.col("source").alias("of"), F.col("part").alias("slice"),
                    (F.col("wanted") - F.col("end") + F.col("n")).alias("wanted")),
            "cut")
    inside = rows.join(located, F.col("source").eqNullSafe(F.col("of")) & (
        F.shiftright("h", HASH_BITS - LEVEL_BITS * LEVELS) == F.col("slice")))
    order = Window.partitionBy("source").orderBy("h")
    fits = (
        inside.groupBy("source", "h").agg(
            F.sum("size").alias("n"), F.first("wanted").alias("wanted"),
            F.first("slice").alias("slice"))
        .withColumn("end", F.sum("n").over(order))
        .withColumn("fits", F.col("end") - F.col("n") / 2 <= F.col("wanted"))
    )
    before = F.shiftleft(F.first("slice"), HASH_BITS - LEVEL_BITS * LEVELS) - 1
    return fits.groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("h"))), before).alias("cut"))


def _named(name: str) -> Column:
    """A column by its name, dots and all."""
    return F.col(f"`{name}`")


def plan_mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_epochs: float = 3.0,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Sizes per document and the plan per source.

    Returns ``(doc_id, source, size, h)`` and ``(source, source_size, weight, target, whole,
    cut)``, both as stored tables. A null text has size 0, a null source is a source of its own.
    Rows with the same key (or, without a key, the same text) share a hash and are taken alike.
    Sources of size 0 have target 0. An empty table gives two empty tables.
    """
    sizes = stored(docs.select(
        _named(key).alias("doc_id"), _named(source).alias("source"),
        n_words(_named(text)).alias("size"),
        seeded_hash(_named(key), _named(text), seed).alias("h")), "sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = stored(source_weights(sources, weights), "weights")
    total = share * float(weighted.agg(F.sum("source_size")).first()[0] or 0)
    targets = fill_targets(weighted, total, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = stored(
        targets.withColumn("whole", F.floor(ratio + F.lit(1e-12)))
        .withColumn("wanted", F.greatest(
            F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))), "targets")
    cuts = _extra_cuts(sizes, targets.filter(F.col("wanted") > 0)).withColumnRenamed("source", "of")
    plan = targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "weight", "target", "whole",
        F.coalesce("cut", F.lit(-1)).alias("cut"))
    return sizes, stored(plan, "plan")


def taken_times(h: Column, whole: Column, cut: Column) -> Column:
    """How often a document is taken."""
    return (whole + F.when(h <= cut, 1).otherwise(0)).cast("long")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_epochs: float = 3.0,
    seed: int = 42,
) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken.

    The plan per source is joined to the rows; the texts are not sorted or grouped. Null keys,
    texts and sources are handled as in ``plan_mix``; other columns pass through whatever their
    names are.
    """
    _, plan = plan_mix(docs, key, text, source, weights, share, max_epochs, seed)
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        _named(source).alias("_of"),
        seeded_hash(_named(key), _named(text), seed).alias("_h"))
    times = taken_times(F.col("_h"), F.col("whole"), F.col("cut"))
    return (
        rows.join(plan, F.col("_of").eqNullSafe(F.col("source")))
        .withColumn("_times", times).filter(F.col("_times") > 0)
        .withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
        .select("row.*")
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken, repeats``, one row per row of ``docs``.

    Nulls, ties and repeated rows count as in ``plan_mix``: a null text has size 0 and takes
    nothing, a null source is one of its own, rows with the same key are taken alike. Texts are
    counted whole. An empty table gives an empty one. Columns other than key, text and source are
    not looked at, so their names cannot clash.
    """
    sizes, plan = plan_mix(docs, **options)
    rows = sizes.withColumnRenamed("source", "_of")
    times = taken_times(F.col("h"), F.col("whole"), F.col("cut"))
    return rows.join(plan, F.col("_of").eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"),
        times.alias("repeats"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS h FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([5.0, 2.0, 1.0])[
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
-- the sources in the order in which they reach their caps, and the level if those before do
o AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, (SELECT sum(source_size) FROM s)::DOUBLE AS total,
    coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0) AS held,
    sum(weight) OVER after AS free, row_number() OVER before AS turn
  FROM s WINDOW
    before AS (ORDER BY source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY source_size / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min((total - held) / free, turn)
        FILTER (weight * ((total - held) / free) <= cap) AS level FROM o),
t AS (
  SELECT source, source_size, least(cap, weight * level) AS target,
    CASE WHEN source_size > 0 THEN floor(least(cap, weight * level) / source_size + 1e-12)
         ELSE 0 END AS whole FROM o, l),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.whole,
    greatest(0, t.target - t.whole * t.source_size) AS wanted,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS place,
    sum(size) OVER (PARTITION BY d.source, h) AS unit
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  (size * (whole + CASE WHEN wanted > 0 AND place - unit / 2 <= wanted THEN 1 ELSE 0 END))::BIGINT
    AS taken FROM r
"""
