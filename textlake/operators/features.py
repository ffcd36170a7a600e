"""Count, TF-IDF, metadata and style features.

Vocabularies are DataFrame aggregates with a fixed tie order and at most ``max_features`` rows,
which is the proven bound behind every broadcast and every model array here. Vectors are made
row by row from the vocabulary, so transforming never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.functions.stopwords import ENGLISH
from textlake.session import scratch_path

# Feature names and vocabulary settings.
METADATA_FEATURES = ["url_count", "number_count", "article_length"]
STYLE_FEATURES = [
    "caps_ratio", "exclamation_density", "question_density",
    "content_word_count", "avg_word_length", "title_content_ratio",
]
EXTRA_FEATURES = {"text": [], "metadata": METADATA_FEATURES, "style": STYLE_FEATURES}
BOW_FEATURES = 10_000
TFIDF_FEATURES, TFIDF_MIN_DF, TFIDF_MAX_DF = 1500, 10, 0.9


# --- scalar features -------------------------------------------------------------


def metadata_features(df: DataFrame) -> DataFrame:
    """URL count, number count and length; either text column stands in for the other."""
    raw = "content" if "content" in df.columns else "content_processed"
    processed = "content_processed" if "content_processed" in df.columns else raw
    return df.withColumns({
        "url_count": T.count_urls(F.col(raw)),
        "number_count": T.count_numbers(F.col(raw)),
        "article_length": T.token_length(F.col(processed)),
    })


def style_features(df: DataFrame) -> DataFrame:
    content, title = F.col("content"), F.col("title")
    return df.withColumns({
        "caps_ratio": T.caps_ratio(content),
        "exclamation_density": T.character_density(content, "!"),
        "question_density": T.character_density(content, "?"),
        "content_word_count": T.token_length(content),
        "avg_word_length": T.avg_word_length(content),
        "title_content_ratio": T.title_content_ratio(title, content),
    })


# --- vocabularies ------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A vocabulary is read several times; the corpus behind it is aggregated once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_terms(text: Column, stopwords: Sequence[str], bigrams: bool) -> Column:
    words = T.remove_stopwords(T.model_words(text), stopwords)
    return T.with_bigrams(words) if bigrams else words


def term_statistics(terms: Column, df: DataFrame, copies: Column | None = None) -> DataFrame:
    """``(term, tf, df)``: occurrences and documents per term, in one aggregate.

    Sorting the terms of a row puts copies side by side, so the first copy of each can be
    flagged in the row and documents are counted without a shuffle by document. ``copies`` says
    how often a row counts.
    """
    entries = (
        df.select(F.sort_array(terms).alias("terms"),
                  (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
        .select("copies", F.explode(F.transform("terms", lambda term, i: F.struct(
            term.alias("term"),
            F.when((i > 0) & (F.get("terms", i - 1) == term), 0).otherwise(1).alias("first"),
        ))).alias("entry"))
    )
    return entries.groupBy("entry.term").agg(
        F.sum("copies").alias("tf"), F.sum(F.col("entry.first") * F.col("copies")).alias("df"))


def bow_vocabulary(
    df: DataFrame, text: str = "content_processed", max_features: int = BOW_FEATURES,
) -> DataFrame:
    """The most frequent words of the corpus: ``(term, tf)``."""
    words = T.model_words(F.col(text))
    counts = df.select(F.explode(words).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("tf"))
    return _stored(counts.orderBy(F.desc("tf"), "term").limit(max_features), "vocabulary")


def tfidf_vocabulary(
    df: DataFrame,
    text: str = "content_processed",
    max_features: int = TFIDF_FEATURES,
    min_df: int = TFIDF_MIN_DF,
    max_df: float = TFIDF_MAX_DF,
    stopwords: Sequence[str] = ENGLISH,
    bigrams: bool = True,
    n_documents: int | None = None,
    copies: str | None = None,
) -> DataFrame:
    """``(term, tf, df, idf)`` of the most frequent words and pairs within the df limits.

    idf is the smoothed form ``ln((1 + rows) / (1 + df)) + 1``. ``copies`` names a column that
    says how often a row counts.
    """
    # every row holds the null term once, so one aggregate also counts the rows
    terms = F.concat(
        document_terms(F.col(text), stopwords, bigrams), F.array(F.lit(None).cast("string")))
    statistics = _stored(term_statistics(
        terms, df, F.col(copies) if copies else None).filter(
        (F.col("df") >= min_df) | F.col("term").isNull()), "terms")
    rows = statistics.filter(F.col("term").isNull()).first()
    n = n_documents if n_documents is not None else rows["tf"] if rows else 0
    kept = statistics.filter(
        F.col("term").isNotNull() & (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n)))
    top = kept.orderBy(F.desc("tf"), "term").limit(max_features)
    return top.withColumn("idf", F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1)


# --- fitted transformers --------------------------------------------------------------


def _sql_strings(words: Sequence[str]) -> str:
    return ", ".join("'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'" for word in words)


def terms_transformer(
    text: str, stopwords: Sequence[str] = (), bigrams: bool = False,
) -> SQLTransformer:
    """The ``terms`` column as a stage that can be saved with a model."""
    pattern = T.MODEL_WORD.replace("\\", "\\\\")
    words = f"regexp_extract_all(lower(coalesce({text}, '')), '{pattern}', 0)"
    if stopwords:
        words = f"filter({words}, w -> w NOT IN ({_sql_strings(stopwords)}))"
    terms = "_words"
    if bigrams:
        terms = (
            "concat(_words, zip_with(slice(_words, 1, greatest(size(_words) - 1, 0)), "
            "slice(_words, 2, greatest(size(_words) - 1, 0)), (a, b) -> concat_ws(' ', a, b)))"
        )
    return SQLTransformer(statement=(
        f"SELECT * EXCEPT (_words), {terms} AS terms "
        f"FROM (SELECT *, {words} AS _words FROM __THIS__)"
    ))


def _require_terms(terms: Sequence[str]) -> None:
    if not terms:
        raise ValueError("The vocabulary is empty")


def bow_transformer(
    vocabulary: DataFrame, text: str = "content_processed", output: str = "text_features",
) -> PipelineModel:
    """Stages that count the vocabulary words of each row."""
    spark_terms = [row["term"] for row in vocabulary.orderBy(F.desc("tf"), "term").collect()]
    _require_terms(spark_terms)
    counter = CountVectorizerModel.from_vocabulary(
        spark_terms, inputCol="terms", outputCol=output)
    return PipelineModel([terms_transformer(text), counter])


def tfidf_transformer(
    vocabulary: DataFrame, text: str = "content_processed", output: str = "text_features",
    stopwords: Sequence[str] = ENGLISH, bigrams: bool = True,
) -> PipelineModel:
    """Stages that weigh the vocabulary terms of each row and scale rows to unit length."""
    rows = vocabulary.orderBy(F.desc("tf"), "term").collect()
    _require_terms(rows)
    counter = CountVectorizerModel.from_vocabulary(
        [row["term"] for row in rows], inputCol="terms", outputCol="_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([row["idf"] for row in rows]),
        inputCol="_counts", outputCol="_weights")
    scale = Normalizer(p=2.0, inputCol="_weights", outputCol=output)
    tidy = SQLTransformer(
        statement="SELECT * EXCEPT (terms, _counts, _weights) FROM __THIS__")
    return PipelineModel([terms_transformer(text, stopwords, bigrams), counter, weigh, scale,
                          tidy])


def nonzero_entries(vector: Column) -> Column:
    """Array of ``(place, value)`` of a vector's non-zero entries, at the cost of these only.

    A sparse vector is read by its own indices; an assembler may also make a dense one.
    """
    parts = F.unwrap_udt(vector)
    sparse = F.zip_with(parts["indices"], parts["values"], lambda i, x: F.struct(
        i.alias("place"), x.alias("value")))
    dense = F.transform(parts["values"], lambda x, i: F.struct(i.alias("place"), x.alias("value")))
    return F.filter(
        F.when(parts["indices"].isNotNull(), sparse).otherwise(dense), lambda e: e["value"] != 0)


def vector_entries(
    df: DataFrame, vocabulary: DataFrame, keys: Sequence[str], vector: str = "text_features",
    value: str = "weight",
) -> DataFrame:
    """Non-zero entries of a feature vector as ``(keys, term, value)`` rows; no shuffle.

    The broadcast table of terms has at most ``max_features`` rows.
    """
    terms = [row["term"] for row in vocabulary.orderBy(F.desc("tf"), "term").collect()]
    names = df.sparkSession.createDataFrame(list(enumerate(terms)), "_place int, term string")
    entries = df.select(*keys, F.explode(nonzero_entries(F.col(vector))).alias("_entry")).select(
        *keys, F.col("_entry.place").alias("_place"), F.col("_entry.value").alias(value))
    return entries.join(F.broadcast(names), "_place").drop("_place")


def feature_stages(
    text_stages: Transformer, feature_set: str, output: str = "features",
) -> list[Transformer]:
    """Text features alone, or with the metadata or style columns of the row appended."""
    if feature_set not in EXTRA_FEATURES:
        raise ValueError(f"Unsupported feature set: {feature_set}")
    return [
        *text_stages.stages,
        VectorAssembler(inputCols=["text_features", *EXTRA_FEATURES[feature_set]], outputCol=output),
    ]
