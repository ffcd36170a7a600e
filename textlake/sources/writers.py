"""Writers. Every write replaces an earlier output and is split over the tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def _csv_ready(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.date_format(f"`{name}`", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").alias(name)
        if kind == "timestamp" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def _writer(df: DataFrame, file_format: str) -> DataFrameWriter:
    if file_format == "parquet":
        return df.write.mode("overwrite").format("parquet")
    if file_format == "csv":
        return (
            _csv_ready(df).write.mode("overwrite").format("csv")
            .option("header", True).option("escape", '"').option("quoteAll", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        )
    raise ValueError(f"no writer for {file_format}")


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write a table as parquet, or as CSV with one header per part file."""
    _writer(df, file_format).save(path)
    return path


def write_splits(
    df: DataFrame, output_dir: str, prefix: str, file_format: str = "parquet",
    order: Sequence[str] = (),
) -> dict[str, str]:
    """Write all splits in one pass over the rows and return a path per split.

    ``order`` names columns by which the rows of each split are put into order over its files,
    at the cost of one range shuffle of the rows.

    The parts are the ``split=...`` directories of ``{output_dir}/{prefix}_splits``. A split
    without rows is written as an empty table.
    """
    root = f"{output_dir.rstrip('/')}/{prefix}_splits" + (".csv" * (file_format == "csv"))
    seen = Observation("splits")
    counted = df.observe(
        seen, *[F.count_if(F.col("split") == split).alias(split) for split in SPLITS])
    if order:
        counted = counted.repartitionByRange("split", *order).sortWithinPartitions("split", *order)
    _writer(counted, file_format).partitionBy("split").save(root)
    paths = {split: f"{root}/split={split}" for split in SPLITS}
    for split, path in paths.items():
        if seen.get[split] == 0:
            write_table(df.drop("split").limit(0), path, file_format)
    return paths


def require_rows(spark: SparkSession, path: str) -> None:
    """Raise if a written parquet table holds no row."""
    if spark.read.parquet(path).isEmpty():
        raise ValueError("cleaning left no row")
