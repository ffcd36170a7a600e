"""Tokenise, remove stop words, stem: the text columns that features are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.functions.stemming import stem_words
from textlake.functions.stopwords import ENGLISH
from textlake.functions.treebank import treebank_words


def process_tokens(words: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Array of words -> blank-separated stems of the words that are not stop words."""
    return F.array_join(stem_words(T.remove_stopwords(words, stopwords)), " ")


def process_text(normalized: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    return process_tokens(T.split_normalized(normalized), stopwords)


def process_text_words(normalized: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Variant with the word tokeniser, which also splits contracted forms and symbols."""
    return process_tokens(T.tokenize_words(normalized), stopwords)


def process_raw_words(text: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Chain over raw text: Treebank words in lower case, without stop words, stemmed.

    Signs stay, as do the parts of contracted forms that are no stop words.
    """
    return process_tokens(treebank_words(F.lower(text)), stopwords)


def add_processed(
    df: DataFrame, source: str = "content_normalized", target: str = "content_processed",
    stopwords: Sequence[str] = ENGLISH,
) -> DataFrame:
    return df.withColumn(target, process_text(F.col(source), stopwords))


def process_statements(df: DataFrame, column: str = "statement") -> DataFrame:
    """Second-dataset chain: normalise, split on blanks, remove stop words, stem."""
    normalized = T.normalize_text(F.col(column))
    return df.withColumn("content_processed", process_text(normalized))
