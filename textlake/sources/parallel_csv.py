"""Large CSV and TSV files with quoted line breaks, read by many tasks.

Spark splits a text file into byte ranges at line ends, so the *lines* of one file are read by as
many tasks as it has ranges. What a line means depends on whether it starts inside quotes, which
is settled without reading from the start:

1. each range counts its quotes, one small row a range;
2. the parity of all quotes before a range, a running sum over these rows, tells whether the
   range starts inside a quoted field;
3. each range joins its lines to records, in order, from its first true record start on. A record
   that leaves its range is cut in two or more pieces; the pieces (two a range at most) are put
   together by a small shuffle of their own.

Records never move between tasks. The file is scanned once for the quotes, once for the pieces
(ranges that neither start nor end inside quotes are left out) and once for the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.session import let_workers_import, scratch_path

#: A row for each range of a file of several is fetched and sent to tasks; above this many, read
#: larger ranges.
MAX_RANGES = 1_000_000
QUOTE = '"'

#: Ranges of each file: where they start, and whether they start and end inside quotes.
Ranges = dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]

_PIECE = "file string, start long, part int, first boolean, text string"
# parts of a range that hold pieces: its first lines, its last ones, and those of an open header
_HEAD, _TAIL, _HEADER = 0, 1, 2


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, start, line``: all lines in file order, without their line feed.

    ``start`` is the first byte of the range that a line was read with.
    """
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"))


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit("")))


def quote_parity(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, start, inside, ends_inside, ranges`` of each range of the files."""
    counted = _lines(spark, paths).groupBy("file", "start").agg(
        F.sum(_quotes(F.col("line"))).alias("quotes"))
    of_file = Window.partitionBy("file")
    through = F.sum("quotes").over(of_file.orderBy("start"))
    return counted.select(
        "file", "start", ((through - F.col("quotes")) % 2 == 1).alias("inside"),
        (through % 2 == 1).alias("ends_inside"), F.count(F.lit(1)).over(of_file).alias("ranges"))


def _ranges(spark: SparkSession, paths: Sequence[str]) -> Ranges:
    """The ranges of files that have several, or end inside quotes."""
    rows = quote_parity(spark, paths).filter("ranges > 1 OR ends_inside").limit(
        MAX_RANGES + 1).collect()
    if len(rows) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges; read larger ones")
    by_file: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: r["start"]):
        by_file.setdefault(row["file"], []).append(
            (row["start"], row["inside"], row["ends_inside"]))
    return {file: tuple(map(np.array, zip(*own))) for file, own in by_file.items()}


def _state(ranges: Ranges, file: str, start: int) -> tuple[bool, bool]:
    """Whether a range starts and ends inside quotes."""
    if file not in ranges:
        if start:
            raise ValueError(f"{file} was cut at other places before; fix the size of ranges")
        return False, False
    starts, inside, ends_inside = ranges[file]
    at = int(np.searchsorted(starts, start))
    if at == len(starts) or starts[at] != start:
        raise ValueError(f"{file} was cut at other places before; fix the size of ranges")
    return bool(inside[at]), bool(ends_inside[at])


def _runs(batches, ranges: Ranges) -> Iterator[tuple]:
    """Stretches of lines of one range: file, start, lines, and the state before each line.

    ``inside[i]`` tells whether line i starts inside quotes; the last entry is the state after the
    stretch. A range may come in several stretches, which follow each other.
    """
    at, state = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column("file"), batch.column("start").to_numpy()
        lines, odd = batch.column("line"), batch.column("odd").to_numpy(zero_copy_only=False)
        codes = files.dictionary_encode().indices.to_numpy()
        change = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for first, end in zip([0, *change], [*change, len(starts)]):
            here = (files[int(first)].as_py(), int(starts[first]))
            if here != at:
                at, state = here, _state(ranges, *here)[0]
            inside = np.logical_xor.accumulate(np.append(state, odd[first:end]))
            state = bool(inside[-1])
            yield at, lines.slice(int(first), int(end - first)), inside


def _without_return(text: str) -> str:
    return text[:-1] if text.endswith("\r") else text


def _records(batches, ranges: Ranges, header: bool):
    """The records that lie in one range; headers are left out."""
    at = None
    for here, lines, inside in _runs(batches, ranges):
        if here != at:
            # the first lines may belong to a record of an earlier range: a piece
            at, pending, foreign = here, [], bool(inside[0])
            skip = header and here[1] == 0
        starts, ends = np.flatnonzero(~inside[:-1]), np.flatnonzero(~inside[1:])
        values, out = lines.to_pylist(), []
        if inside[0]:
            if not len(ends):
                pending.extend(() if foreign else values)
                continue
            if not foreign:
                out.append("\n".join([*pending, *values[:int(ends[0]) + 1]]))
            foreign, ends = False, ends[1:]
        for start, end in zip(starts.tolist(), ends.tolist()):
            out.append(values[start] if start == end else "\n".join(values[start:end + 1]))
        pending = values[int(starts[-1]):] if len(starts) > len(ends) else []
        out = [text for text in map(_without_return, out) if text]
        if skip and out:
            out, skip = out[1:], False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["record"])


def _pieces(batches, ranges: Ranges):
    """What each range holds of records that leave it: their rest, and their beginning."""
    def made(here, head, tail, whole_file):
        rows = []
        if head is not None:
            rows.append((*here, _HEAD, False, "\n".join(head)))
        if tail is not None and _state(ranges, *here)[1]:
            part = _HEADER if whole_file else _TAIL
            rows.append((*here, part, True, "\n".join(tail)))
        if rows:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                names=["file", "start", "part", "first", "text"])

    at = None
    for here, lines, inside in _runs(batches, ranges):
        if here != at:
            if at is not None:
                yield from made(at, head, tail, whole_file)
            at, head, tail = here, [] if inside[0] else None, None
            closed, whole_file = not inside[0], here[1] == 0
        starts, ends = np.flatnonzero(~inside[:-1]), np.flatnonzero(~inside[1:])
        if not closed:
            head.extend(lines.slice(0, int(ends[0]) + 1 if len(ends) else len(lines)).to_pylist())
            closed = len(ends) > 0
        if len(starts):
            tail = lines.slice(int(starts[-1])).to_pylist() if inside[-1] else None
        elif tail is not None:
            tail.extend(lines.to_pylist())
        whole_file = whole_file and not len(ends)
    if at is not None:
        yield from made(at, head, tail, whole_file)


def _broken_records(lines: DataFrame, ranges: Ranges, header: bool) -> DataFrame:
    """``record``: the records that lie in several ranges, put together from their pieces."""
    spark = lines.sparkSession
    wanted = {int(start) for starts, *states in ranges.values()
              for start in starts[states[0] | states[1]]}
    if len(wanted) <= 1000:
        lines = lines.filter(F.col("start").isin(sorted(wanted)))
    path = scratch_path(spark, "pieces")
    lines.mapInArrow(partial(_pieces, ranges=ranges), _PIECE).write.parquet(path)
    pieces = spark.read.schema(_PIECE).parquet(path)
    # every record begins with the last piece of a range; numbering reads no text
    order = Window.partitionBy("file").orderBy("start", "part")
    numbered = pieces.select("file", "start", "part", F.sum(
        F.col("first").cast("int")).over(order).alias("number"))
    whole = pieces.join(numbered, ["file", "start", "part"]).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("pieces"))
    if header:
        whole = whole.filter(~F.exists("pieces", lambda p: p["part"] == _HEADER))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    return whole.select(F.regexp_replace(text, "\r$", "").alias("record"))


def with_range_bytes(spark: SparkSession, range_bytes: int) -> SparkSession:
    """A session with the settings of ``spark`` that reads files in ranges of exactly this size."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(min(range_bytes, 4 << 20)))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def read_records(
    spark: SparkSession, paths: str | Sequence[str], header: bool = True,
) -> DataFrame:
    """``record``: the text of each record of the files, in any order, read by all ranges at once.

    Fields may be quoted by double quotes and hold line breaks, separators and doubled quotes. A
    quote elsewhere, in a field that does not start with one, must be one of two. Lines end with a
    line feed, with or without a carriage return before it. Empty lines between records are
    dropped, and so is the first record of each file if it is a header. Where the last quote of a
    file is missing, its last record goes up to the end of the file.

    The files must be cut alike in all scans, which Spark does as long as its settings and the
    number of cores stay as they are; ``with_range_bytes`` makes sure of it. Other cuts are an
    error, never a wrong result.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    let_workers_import(spark)
    ranges = _ranges(spark, paths)
    lines = _lines(spark, paths).withColumn("odd", _quotes(F.col("line")) % 2 == 1)
    records = lines.mapInArrow(partial(_records, ranges=ranges, header=header), "record string")
    if any((inside | ends_inside).any() for _, inside, ends_inside in ranges.values()):
        records = records.unionByName(_broken_records(lines, ranges, header))
    return records


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = ",",
    header: bool = True, corrupt: str | None = None,
) -> DataFrame:
    """The records of the files as columns of ``schema``, by position.

    Missing fields at the end of a record are null; surplus ones are left out. ``corrupt`` names
    the column of the schema that takes records of another length whole.
    """
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE",
               "multiLine": "true", "lineSep": "\n"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = read_records(spark, paths, header).select(
        F.from_csv("record", ddl, options).alias("fields"))
    return parsed.select("fields.*")
