"""Line deduplication by overlapping windows of three consecutive lines.

A window is repeated if its three lines occur, in this order, at an earlier place of the table:
in a document with a smaller key, or further up in the same one. The lines that repeated windows
cover are removed; overlapping windows merge because positions are a set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored

WINDOW_LINES = 3


def window_rows(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``doc, pos, a, b``: two 64-bit hashes of each window; windows of blank lines are left out.

    The hashes start from different seeds, so together they tell windows apart at any number.
    The windows of a document are made inside its row.
    """
    lines = F.split(F.col(f"`{text}`"), "\n")
    hashed = docs.filter(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("doc"), lines.alias("lines")).filter(F.size("lines") >= size)
    windows = F.transform(
        F.sequence(F.lit(1), F.size("lines") - F.lit(size - 1)),
        lambda at: F.struct(
            at.alias("pos"), F.array_join(F.slice("lines", at, size), "\n").alias("w")))
    return (
        hashed.select("doc", F.inline(windows))
        .filter(F.trim(F.translate("w", "\n\t\r", "   ")) != "")
        .select("doc", "pos", F.xxhash64("w").alias("a"),
                F.xxhash64(F.lit(size), "w", F.length("w")).alias("b"))
    )


def repeated_positions(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW_LINES,
) -> DataFrame:
    """``doc, covered``: the 1-based positions of each document's removed lines, sorted.

    First places are found by an aggregate that combines before its shuffle, and joined back to
    the windows; a window that a third of all documents hold is split by Spark's skew join.
    """
    windows = stored(window_rows(docs, key, text, size), "windows")
    first = windows.groupBy("a", "b").agg(
        F.min(F.struct("doc", "pos")).alias("first"), F.count(F.lit(1)).alias("n"),
    ).filter("n > 1").select(F.col("a").alias("a1"), F.col("b").alias("b1"), "first")
    later = windows.join(first, (F.col("a") == F.col("a1")) & (F.col("b") == F.col("b1"))).filter(
        F.struct("doc", "pos") != F.col("first"))
    return later.groupBy("doc").agg(F.collect_set("pos").alias("at")).select(
        "doc", F.array_sort(F.array_distinct(F.flatten(F.transform(
            "at", lambda p: F.sequence(p, p + F.lit(size - 1)))))).alias("covered"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW_LINES,
) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, plus ``n_lines`` and ``n_removed``.

    Lines are what stands between newlines, kept exactly. Null and empty texts have no lines to
    remove and stay as they are; a document whose lines are all removed gets the empty text. Rows
    without a key take no part. Rows that share a key count as one place per position: of equal
    windows at equal places none is later, and removals found in one apply to all. Columns called
    ``n_lines`` or ``n_removed`` are replaced, all others pass through.
    """
    names = [name for name in docs.columns if name not in ("n_lines", "n_removed")]
    gone = repeated_positions(docs, key, text, size)
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.col(f"`{key}`").alias("own"), F.split(F.col(f"`{text}`"), "\n").alias("lines"))
    left = F.array_join(F.filter(
        "lines", lambda line, i: ~F.array_contains("covered", i + 1)), "\n")
    joined = rows.join(gone, F.col("own") == F.col("doc"), "left")
    cleaned = F.when(F.col("covered").isNull(), F.col("row")[text]).otherwise(left)
    total = F.when(F.col("row")[text].isNull() | (F.col("row")[text] == ""), 0).otherwise(
        F.size("lines"))
    removed = F.coalesce(F.array_size(F.filter(
        "covered", lambda p: p <= F.size("lines"))), F.lit(0))
    # built as one struct first: the names of ``docs`` may be any, also those used here
    out = F.struct(
        *[(cleaned if name == text else F.col("row")[name]).alias(name) for name in names],
        total.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))
    return joined.select(out.alias("out")).select("out.*")


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, pos, ls[pos] AS line, len(ls) AS n FROM (
    SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos FROM (
      SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
windows AS (
  SELECT doc_id, pos, line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS w
  FROM lines WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS place
  FROM windows WHERE w IS NOT NULL AND trim(translate(w, chr(10) || chr(9) || chr(13), '   ')) <> ''),
covered AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE place > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL) AS text,
         count(c.pos) AS n_removed
  FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.text, '')) END AS text_md5,
  CASE WHEN d.text IS NULL OR d.text = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END
    ::BIGINT AS n_lines,
  coalesce(k.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
