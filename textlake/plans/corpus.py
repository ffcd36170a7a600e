"""The driver's tables seen as article and statement tables.

The tables have no raw dates, missing authors or six-way labels, so these are derived from other
columns of the same rows. Every row of the source table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.functions.text import normalize_text
from textlake.operators.tokens import process_text
from textlake.sources import readers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table whose rows are about to be worked on heavily; a few files are dealt to all cores."""
    rows = table(spark, sf_dir, name)
    few = len(rows.inputFiles()) < spark.sparkContext.defaultParallelism
    return readers.spread(rows) if few else rows


def raw_date(timestamp: Column, kind: Column) -> Column:
    """A timestamp written in one of several layouts, or as junk, depending on ``kind``."""
    return (
        F.when(kind == "view", F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == "signup", F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss'Z'"))
        .when(kind == "purchase", F.date_format(timestamp, "yyyy/MM/dd HH:mm"))
        .when(kind == "click", F.date_format(timestamp, "MMM d, yyyy"))
        .otherwise(F.lit("not-a-date"))
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, content, title, domain, type`` with a numeric label, null where there is none."""
    documents = texts(spark, sf_dir).select(
        "doc_id", F.col("text").alias("content"), _first_sentence("text").alias("title"),
        F.col("source").alias("domain"))
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("type"))
    return documents.join(labels, "doc_id", "left").withColumnRenamed("doc_id", "id")


def _first_sentence(text: str) -> Column:
    return F.nullif(F.regexp_extract(text, r"^[^\n.]*", 0), F.lit(""))


def titled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, title, content``; the title is the start of the text up to a full stop or line end."""
    return texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), _first_sentence("text").alias("title"),
        F.col("text").alias("content"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw article table: text labels, mixed date layouts, missing values, unused columns."""
    documents = texts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    scraped = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"),
        raw_date(F.col("ts"), F.col("event_type")).alias("scraped_at"))
    kind = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "reliable")
        .when(F.col("quality") == 1, "political")
        .when(F.col("toxic") == 0, "unreliable")
        .when(F.col("toxic") == 1, "hate")
    )
    nothing = F.lit(None).cast("string")
    return documents.join(labels, "doc_id", "left").join(scraped, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("Unnamed: 0"),
        F.col("doc_id").cast("string").alias("id"),
        F.nullif("source", F.lit("src7")).alias("domain"),
        kind.alias("type"),
        F.col("text").alias("content"),
        "scraped_at",
        F.col("scraped_at").alias("inserted_at"),
        F.col("scraped_at").alias("updated_at"),
        _first_sentence("text").alias("title"),
        F.when(F.col("lang") != "en", F.concat(F.lit("author "), "lang")).alias("authors"),
        nothing.alias("keywords"),
        F.when(F.col("toxic") == 1, F.col("lang")).alias("tags"),
        nothing.alias("summary"),
    )


# Labels that conversation turns stand for, by position.
TURN_LABELS = [
    "pants-fire", "false", "barely-true", "half-true", "mostly-true", "true", "unsure", None,
]


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as statements with six-way labels, some unknown and some null."""
    labels = F.array(*[F.lit(label).cast("string") for label in TURN_LABELS])
    place = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(TURN_LABELS))).cast("int") + 1
    return texts(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.element_at(labels, place).alias("label"),
        F.col("text").alias("statement"),
        F.col("role").alias("speaker"),
    )


def processed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with normalised and processed text."""
    return labelled_documents(spark, sf_dir).withColumn(
        "content_normalized", normalize_text(F.col("content")),
    ).withColumn("content_processed", process_text(F.col("content_normalized")))


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a prediction made by a fixed rule on the text length."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("label"))
    return documents.join(labels, "doc_id").withColumn(
        "prediction", F.when(F.col("n_chars") < 400, 1).otherwise(0))
