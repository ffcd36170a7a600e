"""A training corpus from raw documents, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` with ``docs`` like the table of documents, and works
on all that its predecessor kept. ``run`` writes the result of each stage to the shared folder
and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm import bpe, langid, lines, mixing, setjoin
from textlake.llm.common import stored, table
from textlake.operators.ranking import global_index

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined, labelled with it; rejected ones go.

    Null and empty texts and texts without a letter have no language and go, as do all where nothing
    is labelled. Whole texts are judged; a tie between languages is a rejection. Rows without an id
    may be learned from. Repeated rows stay repeated, an empty table stays empty, and columns other
    than those of documents are left out, here and in all stages.
    """
    dictionaries = langid.learn(docs.filter(~langid.is_held_out(F.col("doc_id"))))
    found = langid.identify(docs.select(COLUMNS), dictionaries)
    return found.filter(~F.col("lang_rejected")).withColumn("lang", F.col("lang_pred")).select(
        COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated three-line windows; those with nothing left go.

    Null and empty texts have no lines and stay as they are, as do rows without an id. Rows that
    share an id are one place: none of their equal windows is a later one, and what is removed in
    one is removed in all. Texts of any length are looked through whole. An empty table stays empty.
    """
    cleaned = lines.dedup_lines(docs).filter((F.col("n_removed") == 0) | (F.trim(F.translate(
        "text", "\n\t\r", "   ")) != ""))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, rows without id last.

    Rows that share an id are told apart by their texts, and equal rows are duplicates of each
    other: where ids are missing or repeated, rows are linked by their place in the order instead.
    Documents without shingles link with nothing and stay.
    """
    docs = docs.select(COLUMNS)
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        placed = docs.withColumn("row_index", F.col("doc_id"))
    else:
        placed = global_index(
            docs.withColumns({"keyless": F.col("doc_id").isNull(), "digest": F.sha2("text", 256)}),
            "keyless", "doc_id", "digest", "lang", "source", "n_chars")
    groups = setjoin.link_sets(placed.select(F.col("row_index").alias("doc_id"), "text"))
    later = groups.filter("n_shingles > 0 AND component_id < doc_id").select(
        F.col("doc_id").alias("later"))
    return placed.join(later, F.col("row_index") == F.col("later"), "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is one of its own. Null and empty texts have no words and are repeated as often as
    their source's plan says. Rows that share an id, or without ids a text, are taken alike. Texts
    are counted whole; an empty table stays empty.
    """
    return mixing.mix(docs).select(COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document taken.

    One row per row, null ids and repeated rows included. A null text is an empty one. Long texts are
    encoded whole; an empty table gives an empty one.
    """
    return bpe.encode_digests(
        docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near-duplicates", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: Compression, hashes of shingles and merges of bytes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
