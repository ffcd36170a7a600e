"""Named queries over the driver's tables, one per operator.

Doubles are rounded to a fixed scale so that sums taken in another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.functions import labels as L
from textlake.functions import text as T
from textlake.functions import unicode as U
from textlake.functions.stopwords import ENGLISH
from textlake.functions.timestamps import parse_mixed
from textlake.functions.treebank import treebank_words
from textlake.operators import (
    chunks,
    cleaning,
    evaluation,
    features,
    models,
    profile,
    ranking,
    sampling,
    splits,
    vocabulary,
)
from textlake.operators import sketches as sketches_of
from textlake.operators.tokens import (
    process_raw_words, process_statements, process_text, process_text_words)
from textlake.plans import corpus, jobs
from textlake.session import scratch_path
from textlake.sources import parallel_csv, readers, writers
from textlake.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[
        F.round(name, places).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ])


def _stamp(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.texts(spark, sf_dir)


def _on_documents(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: _documents(spark, sf_dir).select(
        "doc_id", step(F.col("text")).alias("result"))


def _on_pages(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: corpus.texts(spark, sf_dir, "pages").select(
        "page_id", step(F.concat_ws(" ", "url", "html")).alias("result"))


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_pruned_limit(spark, sf_dir):
    pruned = readers.read_table(spark, f"{sf_dir}/documents.parquet", ["doc_id", "source"])
    return readers.first_rows(pruned, 200, "doc_id")


@query
def csv_round_trip(spark, sf_dir):
    """Documents written as quoted CSV and read back, line breaks and all."""
    path = scratch_path(spark, "articles") + ".csv"
    rows = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"),
        F.col("source").alias("domain"))
    writers.write_table(rows, path, "csv")
    return readers.read_articles_csv(spark, path, na_values=[])


@query
def csv_skip_bad_lines(spark, sf_dir):
    """Lines with a surplus field are skipped, all others are read."""
    path = scratch_path(spark, "lines") + ".csv"
    events = corpus.table(spark, sf_dir, "events").select(
        F.concat_ws(",", "event_id", "event_type", F.when(
            F.col("event_type") == "error", F.lit("broken,line")).when(
            F.col("event_type") == "click", F.lit("surplus,")).otherwise("ok")).alias("value"),
        F.pmod("event_id", F.lit(8)).alias("part"))
    header = spark.range(8).select(
        F.lit("event_id,event_type,state").alias("value"), F.col("id").alias("part"),
        F.lit(0).alias("first"))
    lines = events.withColumn("first", F.lit(1)).unionByName(header)
    # one file, with a header of its own, for each part
    lines.repartition("part").sortWithinPartitions("part", "first").select(
        "value", "part").write.partitionBy("part").text(path)
    return readers.read_articles_csv(spark, f"{path}/part=*", ["event_id", "event_type"], True)


@query
def csv_two_layouts(spark, sf_dir):
    """Two files with their columns in different orders, united by name."""
    rows = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"),
        F.col("source").alias("domain"))
    paths = []
    for half, order in enumerate((["id", "content", "domain"], ["domain", "id", "content"])):
        paths.append(scratch_path(spark, "layout") + ".csv")
        part = rows.filter(F.pmod(F.col("id").cast("long"), F.lit(2)) == half)
        writers.write_table(part.select(order), paths[-1], "csv")
    return readers.read_articles_csv(spark, paths, na_values=[])


@query
def csv_folder_layouts(spark, sf_dir):
    """A folder of CSV files with three layouts, united by name."""
    root = scratch_path(spark, "mixed")
    rows = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"),
        F.col("source").alias("domain"), F.col("lang").alias("the, language"))
    for number, order in enumerate((
            ["id", "content", "domain"], ["domain", "the, language", "id"],
            ["content", "id", "the, language", "domain"])):
        part = rows.filter(F.pmod(F.col("id").cast("long"), F.lit(3)) == number)
        writers.write_table(part.select(*[f"`{c}`" for c in order]), f"{root}/{number}", "csv")
    return readers.read_mixed_csv(spark, f"{root}/*", na_values=[]).withColumnRenamed(
        "the, language", "language")


@query
def tsv_statements(spark, sf_dir):
    """Statements written as headerless TSV and read back by position, pruned to three columns."""
    path = scratch_path(spark, "statements")
    rows = corpus.statements(spark, sf_dir)
    filler = {f.name: F.lit(None).cast(f.dataType) for f in readers.STATEMENT_SCHEMA.fields
              if f.name not in rows.columns}
    rows.withColumns(filler).select(readers.STATEMENT_COLUMNS).write.option(
        "sep", "\t").option("escape", '"').option("quoteAll", True).csv(path)
    return readers.read_statements_tsv(spark, path, ["id", "label", "statement"])


#: Bytes of text of a CSV file that is written by one task and read in ranges.
FILE_BYTES = 128 << 20


def _few_files(rows: DataFrame, text: str) -> tuple[DataFrame, int]:
    """Rows in one part for each FILE_BYTES of text, and the bytes of a range of such a file.

    A file is written by one task, so larger inputs get more files, each of several ranges.
    """
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    dealt = rows.coalesce(1) if size <= FILE_BYTES else rows.repartition(-(-size // FILE_BYTES))
    return dealt, min(FILE_BYTES // 4, max(1 << 14, size // 16))


@query
def csv_parallel_scan(spark, sf_dir):
    """All documents as large CSV files with quoted breaks, read by a task for each range."""
    path = scratch_path(spark, "large-files") + ".csv"
    rows, range_bytes = _few_files(_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat("text", F.lit('\n"'), "source", F.lit('", \t"" \r\n\n')).alias("content"),
        F.col("source").alias("domain")), "content")
    writers.write_table(rows, path, "csv")
    ranged = parallel_csv.with_range_bytes(spark, max(1 << 16, range_bytes))
    return readers.read_articles_csv(ranged, path, na_values=[], in_ranges=True)


@query
def tsv_parallel_scan(spark, sf_dir):
    """Statements as large headerless TSV files with quoted tabs and breaks, read in ranges."""
    path = scratch_path(spark, "large-files")
    rows, range_bytes = _few_files(corpus.statements(spark, sf_dir).withColumn(
        "statement", F.concat("statement", F.lit('\t"\n'))), "statement")
    filler = {f.name: F.lit(None).cast(f.dataType) for f in readers.STATEMENT_SCHEMA.fields
              if f.name not in rows.columns}
    rows.withColumns(filler).select(readers.STATEMENT_COLUMNS).write.option(
        "sep", "\t").option("escape", '"').option("quoteAll", True).option(
            "ignoreTrailingWhiteSpace", False).csv(path)
    ranged = parallel_csv.with_range_bytes(spark, range_bytes)
    return readers.read_statements_tsv(
        ranged, path, ["id", "label", "statement"], in_ranges=True)


@query
def split_files(spark, sf_dir):
    """Orders split by status and written as three parts, read back."""
    split = splits.stratified_split(
        corpus.table(spark, sf_dir, "orders"), "o_orderstatus", id_column="o_orderkey")
    paths = writers.write_splits(split, scratch_path(spark, "splits"), "orders")
    parts = [
        spark.read.parquet(path).withColumn("split", F.lit(split))
        for split, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(
        "split", "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


# --- cleaning ------------------------------------------------------------------------------


@query
def drop_all_null_cols(spark, sf_dir):
    kept = cleaning.drop_null_only_columns(corpus.articles(spark, sf_dir))
    return profile.profile_nulls(kept).select("column_name", "nulls")


@query
def clean_required(spark, sf_dir):
    rows = cleaning.drop_missing_required(corpus.articles(spark, sf_dir))
    return rows.select("id", "type", "domain", F.md5("content").alias("content_md5"))


@query
def clean_fill(spark, sf_dir):
    return cleaning.fill_sentinels(corpus.articles(spark, sf_dir)).select(
        "id", "authors", "title")


@query
def clean_cast(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("title"), F.col("html").alias("content"), "url")
    depth = F.regexp_extract("url", r"/([0-9]+)", 1).try_cast("int").alias("number")
    return cleaning.cast_text(pages).select("title", F.md5("content").alias("md5"), depth)


@query
def parse_timestamps(spark, sf_dir):
    events = corpus.table(spark, sf_dir, "events")
    raw = corpus.raw_date(F.col("ts"), F.col("event_type"))
    return events.select("event_id", _stamp(parse_mixed(raw)).alias("parsed"))


# Layouts that parse_timestamp_forms writes its dates in, and what is left of the instant.
FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "microsecond"), ("yyyy-MM-dd HH:mm:ss'Z'", "second"),
    ("MMM d, yyyy HH:mm", "minute"), ("MMMM d, yyyy HH:mm:ss", "second"),
    ("d MMMM yyyy HH:mm", "minute"), ("dd-MMM-yyyy", "day"),
    ("yyyy/MM/dd HH:mm:ss.SSSSSS", "microsecond"), ("M/d/yyyy h:mm a", "minute"),
    ("yyyy-MM-dd hh:mm a", "minute"), ("dd.MM.yyyy", "day"), ("yyyy.MM.dd", "day"),
    ("yyyyMMdd'T'HHmmss", "second"), ("M/d/yy", "day"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "second"),
    ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "second"), ("MMM d yyyy", "day"), ("'not a date'", None),
]


@query
def parse_timestamp_forms(spark, sf_dir):
    """Every event's instant written in one of many layouts and read back, as UTC."""
    events = corpus.table(spark, sf_dir, "events")
    # numeric dates below the 13th are ambiguous; the one with the day first is kept above it
    form = F.pmod("event_id", F.lit(len(FORMS)))
    layout = None
    for number, (pattern, _) in enumerate(FORMS):
        text = F.date_format("ts", pattern)
        if pattern == "dd.MM.yyyy":
            text = F.when(F.dayofmonth("ts") > 12, text).otherwise(F.date_format("ts", "yyyy.MM.dd"))
        layout = (F.when(form == number, text) if layout is None
                  else layout.when(form == number, text))
    return events.select("event_id", _stamp(parse_mixed(layout)).alias("parsed"))


@query
def invalid_ts_count(spark, sf_dir):
    events = corpus.table(spark, sf_dir, "events")
    raw = corpus.raw_date(F.col("ts"), F.col("event_type"))
    return events.agg(
        F.count_if(parse_mixed(raw).isNull()).alias("invalid"),
        F.count(F.lit(1)).alias("rows"))


@query
def label_binarise(spark, sf_dir):
    rows = corpus.articles(spark, sf_dir).filter(F.col("type").isNotNull())
    return rows.select("id", F.col("type").alias("kind"), L.binarise(F.col("type")).alias("type"))


@query
def label_map_default(spark, sf_dir):
    return corpus.statements(spark, sf_dir).select(
        "id", "label", L.statement_label(F.col("label")).alias("type"))


@query
def label_map_strict(spark, sf_dir):
    return corpus.statements(spark, sf_dir).withColumn(
        "type", L.statement_label_or_null(F.col("label")),
    ).dropna(subset=["type"]).select("id", "label", "type")


@query
def clean_summary(spark, sf_dir):
    return cleaning.clean_summary(corpus.articles(spark, sf_dir))


@query
def align_union(spark, sf_dir):
    documents = _documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), "text", F.col("source").alias("domain"))
    pages = corpus.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("text"), "url")
    benchmark = corpus.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), "text")
    return cleaning.align_union(documents, pages, benchmark).select(
        "id", F.md5("text").alias("text_md5"), "domain")


@query
def initial_cleaning(spark, sf_dir):
    return cleaning.initial_cleaning(corpus.articles(spark, sf_dir)).withColumns({
        "scraped_at": _stamp(F.col("scraped_at")), "content": F.md5("content")})


@query
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(corpus.articles(spark, sf_dir))


@query
def table_shape(spark, sf_dir):
    return profile.table_shape(corpus.articles(spark, sf_dir))


@query
def preview_sample(spark, sf_dir):
    return sampling.preview_sample(corpus.labelled_documents(spark, sf_dir))


# --- text scalars ----------------------------------------------------------------------------

QUERIES["norm_url"] = _on_pages(T.replace_urls)
QUERIES["norm_date"] = _on_documents(lambda text: T.replace_dates(T.fold_ascii(text)))
QUERIES["norm_dash"] = _on_pages(T.blank_dashes)
QUERIES["norm_ascii"] = _on_documents(T.fold_ascii)
QUERIES["norm_email"] = _on_documents(lambda text: T.replace_emails(T.fold_ascii(text)))
QUERIES["norm_number"] = _on_documents(lambda text: T.replace_numbers(T.fold_ascii(text)))
QUERIES["norm_punct"] = _on_documents(T.remove_punctuation)
QUERIES["norm_space"] = _on_pages(T.lower_and_squeeze)
QUERIES["normalize_text"] = _on_documents(T.normalize_text)
QUERIES["tokenize_ws"] = _on_documents(lambda text: F.array_join(T.tokenize(text), "|"))
QUERIES["remove_stopwords"] = _on_documents(
    lambda text: F.array_join(T.remove_stopwords(T.split_normalized(T.normalize_text(text))), " "))
QUERIES["process_text"] = _on_documents(lambda text: process_text(T.normalize_text(text)))
QUERIES["process_text_words"] = _on_documents(
    lambda text: process_text_words(T.normalize_text(text)))
QUERIES["treebank_words"] = _on_documents(lambda text: F.array_join(treebank_words(text), " "))
QUERIES["process_raw_words"] = _on_documents(process_raw_words)
QUERIES["tokenize_words"] = _on_documents(lambda text: F.array_join(T.model_words(text), "|"))
QUERIES["word_bigrams"] = _on_documents(
    lambda text: F.array_join(T.with_bigrams(T.remove_stopwords(T.model_words(text))), "|"))
QUERIES["count_urls"] = _on_pages(T.count_urls)
QUERIES["count_dates"] = _on_documents(T.count_dates)
QUERIES["count_numbers"] = _on_documents(T.count_numbers)
QUERIES["token_length"] = _on_documents(T.token_length)


@query
def repair_encoding(spark, sf_dir):
    """Every text read in a one-byte encoding, once or twice, and repaired: the text itself.

    Every third text is misread as Latin-1, the others in the code page; half of them twice.
    """
    def misread(text: Column, signs: Column) -> Column:
        latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        page = F.translate(latin, "".join(U.SIGNS.values()), "".join(U.SIGNS))
        return F.when(signs, page).otherwise(latin)

    signs, again = F.col("doc_id") % 3 > 0, F.col("doc_id") % 2 == 1
    once = _documents(spark, sf_dir).select(
        "doc_id", misread(F.col("text"), signs).alias("once"), signs.alias("signs"))
    twice = once.select("doc_id", F.when(again, misread(F.col("once"), F.col("signs"))).otherwise(
        F.col("once")).alias("damaged"))
    return twice.select("doc_id", U.repair_encoding(F.col("damaged")).alias("result"))


@query
def normalize_columns(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select(
        "page_id", F.col("html").alias("content"), F.col("url").alias("title"))
    return cleaning.normalize_columns(pages).select(
        "page_id", F.md5("content").alias("content_md5"), "content_normalized",
        "title_normalized")


@query
def process_statements_query(spark, sf_dir):
    return process_statements(corpus.statements(spark, sf_dir)).select("id", "content_processed")


QUERIES["process_statements"] = QUERIES.pop("process_statements_query")


@query
def style_features(spark, sf_dir):
    rows = corpus.titled_documents(spark, sf_dir)
    return _rounded(features.style_features(rows).select("id", *features.STYLE_FEATURES))


# --- vocabulary and profile ------------------------------------------------------------------


def _normalized_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.term_counts(
        _documents(spark, sf_dir), T.split_normalized(T.normalize_text(F.col("text"))))


@query
def stem_vocabulary(spark, sf_dir):
    return vocabulary.stem_vocabulary(_normalized_terms(spark, sf_dir)).filter(
        ~F.col("is_stopword")).select("term", "n", "stem")


@query
def staged_vocabulary(spark, sf_dir):
    return vocabulary.staged_vocabulary(_normalized_terms(spark, sf_dir))


@query
def vocabulary_sizes(spark, sf_dir):
    return vocabulary.vocabulary_sizes(_normalized_terms(spark, sf_dir))


@query
def vocabulary_reduction(spark, sf_dir):
    return _rounded(vocabulary.reduction_rates(vocabulary_sizes(spark, sf_dir)))


@query
def label_distribution(spark, sf_dir):
    return _rounded(profile.label_distribution(corpus.labelled_documents(spark, sf_dir)))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.labelled_documents(spark, sf_dir).select(
        "type", T.token_length(F.col("content")).alias("content_length"))


@query
def length_stats(spark, sf_dir):
    return _rounded(profile.length_stats(_sized(spark, sf_dir), "content_length"))


@query
def length_histogram(spark, sf_dir):
    return _rounded(profile.length_histogram(_sized(spark, sf_dir), "content_length"))


@query
def top_sources(spark, sf_dir):
    rows = corpus.labelled_documents(spark, sf_dir).withColumn(
        "domain", F.nullif("domain", F.lit("src7")))
    return profile.top_sources(rows)


@query
def top_words(spark, sf_dir):
    return vocabulary.top_terms(_normalized_terms(spark, sf_dir))


@query
def heavy_words(spark, sf_dir):
    """The most frequent words found with a fixed number of counters a task."""
    return vocabulary.heavy_terms(
        _documents(spark, sf_dir), T.split_normalized(T.normalize_text(F.col("text"))),
        counters=1024)


@query
def vocabulary_estimates(spark, sf_dir):
    """Sketched vocabulary sizes of three inputs together, against the exact sizes."""
    inputs = ("documents", "conversations", "benchmark")
    words = T.split_normalized(F.col("text"))
    stages = {"raw": words, "no_stop": T.remove_stopwords(words)}
    store = writers.write_table(_texts_of(spark, sf_dir, inputs), scratch_path(spark, "inputs"))
    texts = spark.read.parquet(store)
    sketches = writers.write_table(
        sketches_of.vocabulary_sketches(texts, stages, ["input"]), scratch_path(spark, "sketches"))
    found = sketches_of.vocabulary_estimates(spark.read.parquet(sketches))
    exact = texts.select(F.explode(words).alias("term")).distinct().agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(~F.col("term").isin(*ENGLISH)).alias("no_stop"))
    sizes = exact.select(F.inline(F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.col(stage).alias("n")) for stage in stages])))
    near = F.abs(F.col("estimate") - F.col("n")) <= sketches_of.DISTINCT_ERROR * F.col("n")
    return sizes.join(found, "stage").select("stage", "n", near.alias("within"))


def _texts_of(spark: SparkSession, sf_dir: str, inputs) -> DataFrame:
    parts = None
    for name in inputs:
        part = corpus.texts(spark, sf_dir, name).select(
            F.lit(name).alias("input"), T.normalize_text(F.col("text")).alias("text"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


QUANTILE_SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


@query
def style_quantiles(spark, sf_dir):
    """Quantiles of the style features from sketches of each file, and whether they are in place."""
    rows = features.style_features(corpus.titled_documents(spark, sf_dir).repartition(4))
    path = writers.write_table(rows.select("id", *features.STYLE_FEATURES), scratch_path(
        spark, "style"))
    rows = spark.read.parquet(path)
    found = sketches_of.update_by_file(
        spark, rows.inputFiles(), lambda files: spark.read.parquet(*files),
        lambda part: sketches_of.quantile_sketches(part, features.STYLE_FEATURES, ["file"]),
        scratch_path(spark, "sketches"))
    values = sketches_of.quantiles(sketches_of.merge_quantiles(found), QUANTILE_SHARES)
    errors = sketches_of.rank_errors(rows, values)
    return errors.select(
        "feature", "share", "n", (F.col("error") <= 2 * sketches_of.RANK_ERROR).alias("within"))


@query
def top_words_processed(spark, sf_dir):
    documents = _documents(spark, sf_dir).select(
        process_text(T.normalize_text(F.col("text"))).alias("processed"))
    return vocabulary.top_terms(
        vocabulary.term_counts(documents, T.split_normalized(F.col("processed"))))


@query
def rank_frequency(spark, sf_dir):
    return vocabulary.rank_frequency(_normalized_terms(spark, sf_dir))


def _artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_artefacts(corpus.labelled_documents(spark, sf_dir))


@query
def artefact_stats(spark, sf_dir):
    return _rounded(profile.artefact_stats(_artefacts(spark, sf_dir)))


@query
def artefact_by_label(spark, sf_dir):
    return _rounded(profile.artefact_by_label(_artefacts(spark, sf_dir)))


@query
def class_ratio(spark, sf_dir):
    return _rounded(profile.class_ratio(corpus.labelled_documents(spark, sf_dir)))


@query
def class_weights(spark, sf_dir):
    return _rounded(profile.class_weights(corpus.labelled_documents(spark, sf_dir)))


# --- evaluation ----------------------------------------------------------------------------------


# Event types in code order; any other is 0.
EVENT_KINDS = ["click", "error", "purchase", "signup", "view"]


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(corpus.rule_predictions(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return _confusion(spark, sf_dir)


@query
def classification_report(spark, sf_dir):
    return _rounded(evaluation.classification_report(_confusion(spark, sf_dir), L.LABEL_NAMES))


@query
def f1_scores(spark, sf_dir):
    return _rounded(evaluation.f1_scores(_confusion(spark, sf_dir)))


@query
def accuracy(spark, sf_dir):
    return _rounded(evaluation.accuracy(_confusion(spark, sf_dir)))


@query
def confusion_many_classes(spark, sf_dir):
    """Five event types against a rule whose predictions also lie outside of them."""
    events = corpus.table(spark, sf_dir, "events")
    kinds = F.array(*[F.lit(kind) for kind in EVENT_KINDS])
    rows = events.select(
        F.array_position(kinds, F.col("event_type")).cast("int").alias("label"),
        F.pmod("user_id", F.lit(7)).cast("int").alias("prediction"))
    return evaluation.confusion_matrix(rows)


@query
def report_many_classes(spark, sf_dir):
    return _rounded(evaluation.classification_report(confusion_many_classes(spark, sf_dir)))


# --- order, splits, samples ----------------------------------------------------------------------


@query
def chrono_order(spark, sf_dir):
    keys = corpus.table(spark, sf_dir, "events").select("ts", "event_id")
    return ranking.global_index(keys, "ts", "event_id").select("event_id", "row_index")


@query
def random_split(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "documents").select("doc_id")
    return splits.random_split(rows, id_column="doc_id")


@query
def chronological_split(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return splits.chronological_split(rows, "o_orderdate", "o_orderkey").select(
        "o_orderkey", "split")


@query
def stratified_split(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "events").select("event_id", "event_type")
    return splits.stratified_split(rows, "event_type", id_column="event_id")


@query
def split_counts(spark, sf_dir):
    return splits.split_counts(chronological_split(spark, sf_dir))


@query
def fit_sample(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.fit_sample(rows, 300, id_column="doc_id")


@query
def bootstrap_sample(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sampling.bootstrap_sample(rows, 1500, "quality", id_column="doc_id")


@query
def cv_folds(spark, sf_dir):
    rows = corpus.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sampling.cv_folds(rows, 3, "quality", id_column="doc_id")


# --- set operations and chunks ----------------------------------------------------------------------


@query
def union_all(spark, sf_dir):
    parts = [
        corpus.table(spark, sf_dir, name).select(F.md5("text").alias("text_md5"))
        for name in ("documents", "benchmark", "conversations")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("text_md5").agg(
        F.count(F.lit(1)).alias("copies"))


@query
def union_distinct(spark, sf_dir):
    words = [
        corpus.table(spark, sf_dir, name).select(
            F.explode(T.split_normalized(T.normalize_text(F.col("text")))).alias("term")).distinct()
        for name in ("benchmark", "conversations")
    ]
    return words[0].unionByName(words[1]).distinct()


@query
def map_chunks(spark, sf_dir):
    events = corpus.table(spark, sf_dir, "events").select("event_id", "user_id")

    def double(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(user_id=pdf["user_id"] * 2)

    return chunks.map_chunks(events, double, events.schema)


@query
def map_chunks_with_terms(spark, sf_dir):
    turns = corpus.table(spark, sf_dir, "conversations").select(
        "role", T.normalize_text(F.col("text")).alias("text"))

    def terms(pdf: pd.DataFrame) -> dict[str, set[str]]:
        found: dict[str, set[str]] = {}
        for role, text in zip(pdf["role"], pdf["text"]):
            found.setdefault(role, set()).update(text.split())
        return found

    return chunks.map_chunks_with_terms(turns, terms)


# --- features -------------------------------------------------------------------------------------------


@query
def metadata_features(spark, sf_dir):
    rows = corpus.processed_documents(spark, sf_dir)
    return features.metadata_features(rows).select("id", *features.METADATA_FEATURES)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", "text")


@query
def bow_vocabulary(spark, sf_dir):
    return features.bow_vocabulary(_texts(spark, sf_dir), "text")


@query
def bow_counts(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    words = features.bow_vocabulary(rows, "text")
    counted = features.bow_transformer(words, "text").transform(rows)
    entries = features.vector_entries(counted, words, ["doc_id"], value="n")
    return entries.withColumn("n", F.col("n").cast("long"))


@query
def tfidf_vocabulary(spark, sf_dir):
    return _rounded(features.tfidf_vocabulary(_texts(spark, sf_dir), "text"))


@query
def tfidf_weights(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    words = features.tfidf_vocabulary(rows, "text")
    weighed = features.tfidf_transformer(words, "text").transform(rows)
    return _rounded(features.vector_entries(weighed, words, ["doc_id"]))


@query
def assemble_features(spark, sf_dir):
    """Text vector and metadata of the same row side by side: sizes and sums per row."""
    rows = features.metadata_features(
        _texts(spark, sf_dir).withColumnRenamed("text", "content"))
    words = features.bow_vocabulary(rows, "content")
    stages = features.feature_stages(features.bow_transformer(words, "content"), "metadata")
    for stage in stages:
        rows = stage.transform(rows)
    parts = F.unwrap_udt("features")
    return rows.select(
        "doc_id", F.coalesce(parts["size"], F.size(parts["values"])).alias("width"),
        F.aggregate(parts["values"], F.lit(0.0), lambda a, b: a + b).cast("long").alias("total"))


# --- models ---------------------------------------------------------------------------------------------


def _processed_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Labelled documents, processed once and stored as train, validation and test parts."""
    rows = corpus.processed_documents(spark, sf_dir).filter(F.col("type").isNotNull())
    stored = writers.write_table(rows, scratch_path(spark, "processed"))
    split = splits.stratified_split(spark.read.parquet(stored), "type")
    paths = writers.write_splits(split, scratch_path(spark, "parts"), "documents")
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = _processed_parts(spark, sf_dir)
    return parts["train"], parts["val"]


@query
def model_parts(spark, sf_dir):
    """The labelled rows that the classifiers are trained on and judged by, with their part."""
    parts = None
    for name, part in _processed_parts(spark, sf_dir).items():
        rows = part.select("id", F.col("type").cast("int").alias("type"), F.lit(name).alias("part"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


SMALL_TREES = {"trees": 5, "depth": 4}


@query
def logreg_predictions(spark, sf_dir):
    train, validation = _parts(spark, sf_dir)
    _, tables = jobs.train_logreg_job(train, validation)
    return tables["predictions"].select("id", "type", "prediction")


@query
def gbt_predictions(spark, sf_dir):
    """Boosted trees with the job's own settings: 400 trees of depth 12."""
    train, validation = _parts(spark, sf_dir)
    _, tables = jobs.train_gbt_job(train, validation)
    return tables["predictions"].select("id", "type", "prediction")


@query
def feature_set_comparison(spark, sf_dir):
    train, validation = _parts(spark, sf_dir)
    compared = jobs.compare_logreg_job(train, validation)
    rows = [tables["f1_scores"].withColumn("feature_set", F.lit(feature_set))
            for feature_set, (_, tables) in compared.items()]
    return rows[0].unionByName(rows[1])


@query
def tune_results(spark, sf_dir):
    """The search with the job's own settings; a larger table is drawn as often as it has rows."""
    train, _ = _parts(spark, sf_dir)
    scores, _ = jobs.tune_job(train, n_samples=max(jobs.TUNE_DRAWS, train.count()))
    return scores


#: The jobs with their own settings and draws, whatever the table; they may take hours.
FULL_QUERIES: dict[str, Query] = {}


def full_query(function):
    FULL_QUERIES[function.__name__] = function
    return function


@full_query
def gbt_predictions_full(spark, sf_dir):
    """Boosted trees with the job's own settings: 400 trees of depth 12."""
    train, validation = _parts(spark, sf_dir)
    _, tables = jobs.train_gbt_job(train, validation)
    return tables["predictions"].select("id", "type", "prediction")


@full_query
def tune_results_full(spark, sf_dir):
    """The search with the job's own settings: 15 of the whole grid, 3 folds, 150,000 draws."""
    train, _ = _parts(spark, sf_dir)
    scores, _ = jobs.tune_job(train)
    return scores


def _linear(spark: SparkSession, sf_dir: str):
    train, validation = _parts(spark, sf_dir)
    words = features.bow_vocabulary(train)
    stages = features.feature_stages(features.bow_transformer(words), "text")
    model = models.train_logreg(train, stages)
    terms = model.stages[1].vocabulary
    return model, terms, validation


@query
def top_terms_by_class(spark, sf_dir):
    model, terms, _ = _linear(spark, sf_dir)
    return models.top_terms_by_class(models.coefficient_table(spark, terms, model))


@query
def term_contributions(spark, sf_dir):
    model, _, validation = _linear(spark, sf_dir)
    return models.term_contributions(validation, model, models.feature_names(model), ["id"])


EXPLAINED_TREES = {"trees": 30, "depth": 6}


def _explained(spark: SparkSession, sf_dir: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Contributions to the margins of the validation rows, and the rows with their margins."""
    train, validation = _parts(spark, sf_dir)
    model, tables = jobs.train_gbt_job(train, validation, **EXPLAINED_TREES)
    return models.tree_contributions(validation, model, ["id"], k=k), tables["predictions"]


@query
def tree_contributions(spark, sf_dir):
    """The 15 features that moved each validation row's margin most."""
    return _rounded(_explained(spark, sf_dir, 15)[0].drop("total"))


@query
def tree_contributions_add_up(spark, sf_dir):
    """For every validation row, whether all contributions and the base are its margin."""
    told, scored = _explained(spark, sf_dir, 1 << 30)
    sums = told.groupBy("id").agg(
        (F.sum("contribution") + F.first("base")).alias("sum"), F.max("margin").alias("told"))
    same = (F.abs(F.col("sum") - F.col("margin")) < 1e-9) & (F.col("told") == F.col("margin"))
    return scored.select("id", "type", "margin").join(sums, "id", "left").select(
        "id", "type", F.coalesce(same, F.lit(False)).alias("adds_up"))


@query
def model_facts(spark, sf_dir):
    """Rows of each class that the two classifiers were judged by, and predictions that are none."""
    train, validation = _parts(spark, sf_dir)
    parts = None
    for name, (_, tables) in (
            ("logreg", jobs.train_logreg_job(train, validation)),
            ("gbt", jobs.train_gbt_job(train, validation, **SMALL_TREES))):
        rows = tables["confusion_matrix"].groupBy("label").agg(
            F.sum("n").alias("support"),
            F.sum(F.when(F.col("prediction").isin(0, 1), 0).otherwise(F.col("n"))).alias("odd"))
        rows = rows.select(F.lit(name).alias("model"), "label", "support", "odd")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def cross_domain_report(spark, sf_dir):
    """A pipeline trained on documents, saved, loaded and applied to the statements."""
    model, _, _ = _linear(spark, sf_dir)
    path = models.save_model(model, scratch_path(spark, "model"))
    turns = process_statements(corpus.statements(spark, sf_dir)).withColumn(
        "type", L.statement_label(F.col("label")))
    return jobs.evaluate_job(path, turns)["classification_report"]


# --- jobs and streams ---------------------------------------------------------------------------------


@query
def clean_and_split_job(spark, sf_dir):
    """The whole job: raw CSV in, cleaned table and stratified splits out."""
    source = scratch_path(spark, "raw") + ".csv"
    writers.write_table(corpus.articles(spark, sf_dir), source, "csv")
    result = jobs.clean_and_split(
        spark, source, scratch_path(spark, "cleaned"), split_method="stratified")
    parts = None
    for split, path in result.split_paths.items():
        part = spark.read.parquet(path).select(
            "id", "type", "content_processed", F.lit(split).alias("split"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query
def corpus_report(spark, sf_dir):
    """All tables of the corpus report, in long form: table name and number of rows."""
    rows = corpus.processed_documents(spark, sf_dir)
    tables = jobs.corpus_report(rows)
    counts = None
    for name, table in tables.items():
        count = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = count if counts is None else counts.unionByName(count)
    return counts


@query
def corpus_report_values(spark, sf_dir):
    """The values of the report's tables in long form, one row per table, row and value."""
    rows = corpus.processed_documents(spark, sf_dir)
    parts = None
    for name, table in jobs.corpus_report(rows).items():
        keys = [c for c, _ in table.dtypes if c in ("type", "term", "domain", "bin", "feature")]
        values = [c for c, _ in table.dtypes if c not in keys]
        label = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        part = table.select(label.alias("row"), F.explode(F.array(*[
            F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value"))
            for v in values])).alias("entry")).select(
                F.lit(name).alias("name"), "row", "entry.measure", "entry.value")
        parts = part if parts is None else parts.unionByName(part)
    return _rounded(parts)


def _split_files(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """Dated, labelled orders through the split job; the parts read back."""
    source = scratch_path(spark, "orders")
    writers.write_table(corpus.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("scraped_at"),
        F.col("o_orderstatus").alias("type")), source)
    paths = jobs.split_job(spark, source, scratch_path(spark, "parts"), method)
    parts = None
    for split, path in paths.items():
        part = spark.read.parquet(path).select("id", F.lit(split).alias("split"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query
def split_job_random(spark, sf_dir):
    return _split_files(spark, sf_dir, "random")


@query
def split_job_chronological(spark, sf_dir):
    return _split_files(spark, sf_dir, "chronological")


@query
def split_job_stratified(spark, sf_dir):
    return _split_files(spark, sf_dir, "stratified")


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return incremental.read_stream(spark, f"{sf_dir}/documents*.parquet", documents.schema)


@query
def stream_cleaning(spark, sf_dir):
    """Documents as a file stream through the cleaning step, appended to a table."""
    stream = _document_stream(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("lang") == "en", "reliable").when(F.col("lang") == "fr", "satire")
        .when(F.col("lang") == "de", "political").otherwise("unreliable").alias("type"),
        F.col("text").alias("content"), F.col("source").alias("domain"))
    output = scratch_path(spark, "stream")
    incremental.append_cleaned(stream, output, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(output).select("id", "type", "domain", "content_normalized")


@query
def stream_vocabulary(spark, sf_dir):
    stream = _document_stream(spark, sf_dir).select(T.normalize_text(F.col("text")).alias("text"))
    store = scratch_path(spark, "terms")
    incremental.track_vocabulary(
        stream, "text", store, scratch_path(spark, "state")).awaitTermination()
    return incremental.read_vocabulary(spark, store)


def _files_of_third(spark: SparkSession, sf_dir: str) -> int:
    """Into how many files a third of the documents goes: two, and more with the size of the table."""
    return 2 * -(-corpus.table(spark, sf_dir, "documents").rdd.getNumPartitions() // 6)


@query
def stream_term_counts(spark, sf_dir):
    """Terms of a stream of documents counted in keyed state, a third of the files a batch."""
    source, files = scratch_path(spark, "texts"), _files_of_third(spark, sf_dir)
    writers.write_table(_documents(spark, sf_dir).select(
        T.normalize_text(F.col("text")).alias("text")).repartition(3 * files), source)
    stream = incremental.read_stream(spark, source, "text string", files_per_batch=files)
    store = scratch_path(spark, "counts")
    incremental.track_term_counts(
        stream, "text", store, scratch_path(spark, "state")).awaitTermination()
    return incremental.read_term_counts(spark, store)


@query
def stream_clean_summary(spark, sf_dir):
    """Row totals that a cleaning stream observed batch by batch: the running ones of the last."""
    source, files = scratch_path(spark, "raw"), _files_of_third(spark, sf_dir)
    articles = corpus.articles(spark, sf_dir)
    writers.write_table(articles.repartition(3 * files), source)
    totals = scratch_path(spark, "totals")
    incremental.append_cleaned(
        incremental.read_stream(spark, source, articles.schema, files_per_batch=files),
        scratch_path(spark, "cleaned"), scratch_path(spark, "state"), totals=totals)
    last = incremental.read_totals(spark, totals).orderBy(F.desc("batch")).limit(1)
    names = [name for name in last.columns if name.startswith("running_")]
    return last.select(*[F.col(name).alias(name.removeprefix("running_")) for name in names])
