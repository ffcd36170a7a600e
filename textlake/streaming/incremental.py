"""File streams: each new input file is cleaned once; the vocabulary grows batch by batch."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from textlake.functions.text import tokenize
from textlake.operators.cleaning import clean_rows, normalize_columns, summary_metrics
from textlake.operators.tokens import add_processed
from textlake.sources.readers import spread


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the files that appear under a path, with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(file_format).load(path)


def clean_stream(articles: DataFrame) -> DataFrame:
    """The stateless cleaning of the batch job: required fields, types, normalised text.

    Columns without any value are kept: whether a column is empty cannot be known on a stream.
    """
    return add_processed(normalize_columns(clean_rows(articles)))


#: The state of keyed operators is kept outside of the memory of the executors.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
METRICS = "cleaning"
TOTALS = "rows_in long, missing_required long, invalid_timestamps long, rows_out long"


class CleaningTotals(StreamingQueryListener):
    """Writes the row totals that each batch of a cleaning stream observed, keyed by batch.

    A batch owns the directory ``batch=<id>``: run again, it overwrites its own totals.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._ended: set[str] = set()
        self._changed, self._failure = threading.Condition(), None

    def follow(self, query: StreamingQuery, seconds: float = 300) -> None:
        """Wait until the query has ended and its last totals are written; raises what failed."""
        try:
            query.awaitTermination()
            with self._changed:
                if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                    raise TimeoutError(f"the totals of {self._path} are not complete")
        finally:
            self._spark.streams.removeListener(self)
        if self._failure:
            raise self._failure

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(f"{METRICS}:{self._path}")
        if row is None or not row["rows_in"]:
            return
        names = [name.split()[0] for name in TOTALS.split(", ")]
        try:
            self._spark.createDataFrame([tuple(row[name] for name in names)], TOTALS).coalesce(
                1).write.mode("overwrite").parquet(f"{self._path}/batch={progress.batchId}")
        except Exception as error:  # noqa: BLE001, the bus would only log it
            self._failure = error

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass


def append_cleaned(
    articles: DataFrame, output: str, checkpoint: str, spread_rows: bool = True,
    totals: str | None = None,
) -> StreamingQuery:
    """Clean all files that are new since the last run and append them, exactly once.

    ``spread_rows`` deals the rows of each batch over all cores, since a batch of one file would
    be one task. With ``totals`` the row totals of every batch are observed on the way and written
    there; the call then returns after the query has ended.
    """
    spark = articles.sparkSession
    rows, listener = articles, None
    if totals:
        listener = CleaningTotals(spark, totals)
        spark.streams.addListener(listener)
        rows = rows.observe(f"{METRICS}:{totals.rstrip('/')}", *summary_metrics(articles))
    query = (
        clean_stream(spread(rows) if spread_rows else rows).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )
    if listener:
        listener.follow(query)
    return query


def read_totals(spark: SparkSession, totals: str) -> DataFrame:
    """Row totals of each batch and, as ``running_*``, of all batches up to it."""
    rows = spark.read.schema(f"{TOTALS}, batch long").parquet(totals).withColumn(
        "rows_dropped", F.col("rows_in") - F.col("rows_out"))
    names = [name for name in rows.columns if name != "batch"]
    # a row for each batch
    running = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("batch", *names, *[
        F.sum(name).over(running).alias(f"running_{name}") for name in names])


def _start_keyed(stream: DataFrame, mode: str, write, checkpoint: str) -> StreamingQuery:
    """A query whose keyed state lives in the embedded store, with batches given to ``write``."""
    conf = stream.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STATE_STORE)
    try:
        # a query keeps the settings that it was started with
        return (
            stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(name, before)


def track_vocabulary(
    texts: DataFrame, column: str, store: str, checkpoint: str,
) -> StreamingQuery:
    """Append the terms of each batch that earlier batches did not have.

    Which terms are known is keyed state, so a batch reads its own rows only. It owns the
    directory ``batch=<id>``, which it overwrites if it is run again after a failure.
    """
    path = store.rstrip("/")

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    terms = texts.select(F.explode(F.array_distinct(tokenize(F.col(column)))).alias("term"))
    return _start_keyed(terms.dropDuplicates(["term"]), "append", add_batch, checkpoint)


def read_vocabulary(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema("term string, batch long").parquet(store).select("term")


def track_term_counts(
    texts: DataFrame, column: str, store: str, checkpoint: str,
) -> StreamingQuery:
    """Count terms over all batches; each batch writes the new counts of the terms it has.

    The counts are keyed state: a batch combines its rows before they are shuffled, and reads
    neither earlier rows nor earlier counts. ``batch=<id>`` is overwritten if run again.
    """
    path = store.rstrip("/")

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counted = texts.select(F.explode(tokenize(F.col(column))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))
    return _start_keyed(counted, "update", add_batch, checkpoint)


def read_term_counts(spark: SparkSession, store: str) -> DataFrame:
    """``term, n``: the counts after the last batch, the latest of each term."""
    rows = spark.read.schema("term string, n long, batch long").parquet(store)
    return rows.groupBy("term").agg(F.max_by("n", "batch").alias("n"))
