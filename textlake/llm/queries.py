"""One query per operator over the given tables, and SQL twins where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm import (
    bpe, chat, hardneg, hilbert, impact, langid, lines, mixing, pii, setjoin, spelling, tokencount, warc,
)
from textlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_hilbert_ann(spark, sf_dir):
    return hilbert.nearest(table(spark, sf_dir, "embeddings"))


@query
def op2_warc(spark, sf_dir):
    """All pages written as seekable bundles and read back through the index."""
    index = warc.write_bundles(warc.mark_revisits(table(spark, sf_dir, "pages")))
    return warc.read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_mixing(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents")).drop("repeats")


@query
def op4_langid(spark, sf_dir):
    """Language of every document, learned from the rows that are not held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = langid.is_held_out(F.col("doc_id"))
    dictionaries = langid.learn(documents.filter(~held_out))
    found = langid.identify(documents.select("doc_id", "text"), dictionaries)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_rejected")


@query
def op5_bpe(spark, sf_dir):
    return bpe.encode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN)


@query
def op6_ngram_join(spark, sf_dir):
    return setjoin.link_sets(table(spark, sf_dir, "documents"))


@query
def op7_impact_topk(spark, sf_dir):
    return impact.top_k(table(spark, sf_dir, "embeddings"))


@query
def op8_pii(spark, sf_dir):
    return pii.pii_report(table(spark, sf_dir, "documents"))


@query
def op9_chat(spark, sf_dir):
    """Preference pairs from all conversations, each against a copy with a shortened reply."""
    pairs = chat.format_preferences(
        chat.shortened_replies(table(spark, sf_dir, "conversations")))
    marked = [F.array_join(F.transform(
        f"{side}_spans", lambda s: F.concat_ws(":", s["a"], s["b"])), ",").alias(f"{side}_spans")
        for side in ("chosen", "rejected")]
    return pairs.select("pair_id", "prompt", "n_prompt_turns", "chosen", "rejected", *marked)


@query
def op10_line_dedup(spark, sf_dir):
    """Every document without its repeated three-line windows; the text as a digest."""
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.md5("text").alias("text_md5"), "n_lines", "n_removed")


@query
def op11_token_counts(spark, sf_dir):
    return tokencount.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of all embeddings; every seventh label is moved on by one first."""
    embeddings = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(embeddings.withColumn("label", moved))


@query
def op13_spelling(spark, sf_dir):
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


ORACLE_SQL["op9_chat"] = chat.PREFERENCE_SQL
ORACLE_SQL["op10_line_dedup"] = lines.LINE_DEDUP_SQL
ORACLE_SQL["op3_mixing"] = mixing.MIX_SQL
ORACLE_SQL["op7_impact_topk"] = impact.TOP_K_SQL
ORACLE_SQL["op2_warc"] = warc.WARC_SQL
ORACLE_SQL["op13_spelling"] = spelling.SPELLING_SQL
ORACLE_SQL["op12_hard_negatives"] = hardneg.HARD_NEGATIVES_SQL
