"""Readers with fixed schemas; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.operators.cleaning import align_union
from textlake.sources import parallel_csv

# Column names of the statement files.
STATEMENT_COLUMNS = [
    "id", "label", "statement", "subject", "speaker", "job_title", "state", "party",
    "barely_true_counts", "false_counts", "half_true_counts", "mostly_true_counts",
    "pants_fire_counts", "context",
]
# Words that tabular tools commonly read as a missing value.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

STATEMENT_SCHEMA = T.StructType([
    T.StructField(name, T.DoubleType() if name.endswith("_counts") else T.StringType())
    for name in STATEMENT_COLUMNS
])

#: A file above this size is read in ranges although fields may hold line breaks.
LARGE_FILE_BYTES = 1 << 30

_RECORD = "_odd_record"
_QUOTED = r'"(?:[^"]|"")*"'


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _na_to_null(df: DataFrame, na_values: Sequence[str]) -> DataFrame:
    if not na_values:
        return df
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*na_values), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of the first line, without looking at any data row."""
    first = spark.read.option("header", True).option("sep", sep).option(
        "inferSchema", False).csv(path)
    return first.columns


def has_large_files(
    spark: SparkSession, paths: str | Sequence[str], limit: int | None = None,
) -> bool:
    """Whether a file that can be read in ranges is larger than ``limit``; reads no content."""
    files = spark.read.format("binaryFile").load(
        [paths] if isinstance(paths, str) else list(paths)).select("path", "length")
    packed = F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    largest = files.filter(~packed).agg(F.max("length")).first()[0]
    return (largest or 0) > (LARGE_FILE_BYTES if limit is None else limit)


def read_articles_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    skip_bad_lines: bool = False,
    na_values: Sequence[str] = NA_WORDS,
    multi_line: bool = True,
    in_ranges: bool | None = None,
) -> DataFrame:
    """Article CSV with a header, quoted line breaks and doubled quotes.

    Every column is read as a string, so ids keep leading zeros; later steps cast. ``columns``
    prunes to those names. Several paths may have columns in different orders or of different
    names: each is read by its own header, and they are united by name in the layout of the
    first. Files below one path must have one header; Spark refuses others.

    ``skip_bad_lines`` drops lines with more fields than the header, empty ones included; shorter
    lines are padded with nulls either way.

    Spark's reader gives a file whose fields may hold line breaks to one task. Large files are
    therefore read in ranges by ``parallel_csv``, at the price of a scan or two more;
    ``in_ranges`` decides for all sizes. ``multi_line=False`` is for files without such fields.
    """
    if not isinstance(path, str):
        parts = [read_articles_csv(
            spark, own, columns, skip_bad_lines, na_values, multi_line, in_ranges) for own in path]
        return align_union(*parts)
    names = csv_header(spark, path)
    if in_ranges is None:
        in_ranges = multi_line and has_large_files(spark, path)
    reader = (
        spark.read.schema(string_schema(names + [_RECORD] * skip_bad_lines))
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
    )
    if skip_bad_lines:
        # Spark hands out records of another length; those with more fields have more commas
        df = (parallel_csv.read_delimited(
            spark, path, string_schema([*names, _RECORD]), corrupt=_RECORD) if in_ranges
            else reader.option("columnNameOfCorruptRecord", _RECORD).csv(path))
        commas = F.regexp_count(
            F.regexp_replace(F.col(_RECORD), _QUOTED, ""), F.lit(","))
        df = df.filter(F.col(_RECORD).isNull() | (commas < len(names))).drop(_RECORD)
    elif in_ranges:
        df = parallel_csv.read_delimited(spark, path, string_schema(names))
    else:
        df = reader.option("enforceSchema", False).csv(path)
    if columns is not None:
        missing = [name for name in columns if name not in names]
        if missing:
            raise ValueError(f"Missing columns: {missing}")
        df = df.select(*[F.col(f"`{name}`") for name in columns])
    return _na_to_null(df, na_values)


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below some paths by their header: columns in order, and the files that have them.

    The first line of every file is found in one scan of the lines, and parsed by Spark. Headers
    may hold quoted separators but no line breaks; files without a line are left out.
    """
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value")
    first = lines.filter("start = 0 AND value <> ''").groupBy("file").agg(
        F.min_by("value", "place").alias("header"))
    by_header: dict[str, list[str]] = {}
    for row in first.collect():
        by_header.setdefault(row["header"].rstrip("\r"), []).append(unquote(row["file"]))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for header, files in by_header.items():
        names = spark.createDataFrame([(header,)], "line string").select(F.from_csv(
            "line", ", ".join(f"c{i} string" for i in range(header.count(",") + 1)),
            {"quote": '"', "escape": '"'}).alias("f")).first()["f"]
        layouts.setdefault(tuple(n for n in names if n is not None), []).extend(files)
    return layouts


def read_mixed_csv(
    spark: SparkSession, paths: str | Sequence[str], layout: Sequence[str] | None = None,
    na_values: Sequence[str] = NA_WORDS, in_ranges: bool | None = None,
) -> DataFrame:
    """Article CSVs below some paths whose files may have different headers.

    Files are grouped by header and each group is one scan with its own columns; the groups are
    united by name. ``layout`` names the columns to return, in order: by default all that occur,
    those of the commonest layout first. Columns that a file does not have are null.
    """
    layouts = file_headers(spark, paths)
    if not layouts:
        raise ValueError(f"no file with a header below {paths}")
    order = sorted(layouts, key=lambda names: (-len(layouts[names]), names))
    wanted = list(layout or dict.fromkeys(name for names in order for name in names))
    parts = []
    for names in order:
        files = sorted(layouts[names])
        ranged = has_large_files(spark, files) if in_ranges is None else in_ranges
        schema = string_schema(names)
        rows = parallel_csv.read_delimited(spark, files, schema) if ranged else (
            spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(files))
        parts.append(rows)
    first = parts[0].select(*[
        F.col(f"`{name}`") if name in parts[0].columns else F.lit(None).cast("string").alias(name)
        for name in wanted])
    return _na_to_null(align_union(first, *parts[1:]), na_values)


def read_statements_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    na_values: Sequence[str] = NA_WORDS,
    in_ranges: bool | None = None,
) -> DataFrame:
    """Headerless tab-separated statements; several files are concatenated.

    Quoted fields may hold tabs, line breaks and doubled quotes. Large files are read in ranges,
    as for articles.
    """
    if has_large_files(spark, paths) if in_ranges is None else in_ranges:
        df = parallel_csv.read_delimited(spark, paths, STATEMENT_SCHEMA, "\t", header=False)
        return _na_to_null(df.select(*columns) if columns else df, na_values)
    df = (
        spark.read.schema(STATEMENT_SCHEMA)
        .option("sep", "\t")
        .option("header", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    return _na_to_null(df.select(*columns) if columns else df, na_values)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet table, or an article CSV if the path names one, pruned to ``columns``."""
    if path.rstrip("/").endswith(".csv"):
        return read_articles_csv(spark, path, columns)
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{name}`") for name in columns]) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over all cores: for inputs of few or unsplittable files.

    Costs a shuffle of the rows, so it is the caller's choice.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def first_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The n rows with the smallest key: a repeatable stand-in for 'the first n lines'."""
    return df.orderBy(key).limit(n)
