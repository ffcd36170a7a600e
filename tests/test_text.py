import random

import pytest
from pyspark.sql import functions as F

from textlake.functions import labels as L
from textlake.functions import stemming
from textlake.functions import text as T
from textlake.functions import treebank
from textlake.functions.stemming import stem
from textlake.functions.stopwords import ENGLISH
from textlake.functions.timestamps import parse_mixed
from textlake.functions.treebank import treebank_words
from textlake.operators import cleaning, features, vocabulary
from textlake.operators.tokens import (
    add_processed, process_raw_words, process_text, process_text_words)


def apply(spark, function, *values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [row[0] for row in rows.orderBy("i").select(function(F.col("v"))).collect()]


def test_normalize_text(spark):
    null, day, slashed, url, mail, number, hello = apply(
        spark, T.normalize_text, None, "Today is 2023-10-25.", "Date: 12/12/2022",
        "Visit https://example.com for more info", "Contact test@example.com",
        "I have 100 apples", "HELLO-World!")
    assert null == ""
    assert "datetoken" in day and "datetoken" in slashed
    assert url == "visit urltoken for more info"
    assert mail == "contact emailtoken"
    assert number == "i have numtoken apples"
    assert hello == "hello world"


def test_normalize_text_keeps_symbols_and_mixed_words(spark):
    assert apply(spark, T.normalize_text, "3rd place: $5 + 1,000.50!", "naïve Straße œuvre") == [
        "3rd place $numtoken + numtoken", "naive strasse oeuvre"]


def test_tokenize(spark):
    assert apply(spark, T.tokenize, None, "", "  a b\n c ") == [[], [], ["a", "b", "c"]]
    assert apply(spark, T.tokenize_words, "cannot gotta a$b") == [
        ["can", "not", "got", "ta", "a", "$", "b"]]


def test_stop_words_are_sparks_own(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_remove_stopwords_keeps_repetitions(spark):
    assert apply(spark, lambda v: T.remove_stopwords(T.tokenize(v)), "run the run this dog") == [
        ["run", "run", "dog"]]


# Word and stem pairs of the published sample vocabulary, and of the rules' own examples.
STEMS = """
consign consign  consigned consign  consignment consign  consistency consist  consolatory consolatori
consolingly consol  consorting consort  conspicuously conspicu  conspiracy conspiraci
conspirators conspir  constancy constanc  knackeries knackeri  knavish knavish  kneaded knead
knitting knit  knives knive  knopp knopp  running run  quickly quick  flies fli  dies die
denied deni  agreed agre  owned own  humbled humbl  meeting meet  stating state  itemization item
sensational sensat  traditional tradit  reference refer  colonizer colon  plotted plot
generously generous  generate generat  communism communism  skies sky  dying die  news news
innings inning  proceeding proceed  happy happi  say say  by by  cry cri  hopping hop  hoping hope
relational relat  conditional condit  valenci valenc  hopefulness hope  electriciti electr
adjustment adjust  adoption adopt  controlling control  roll roll  gas gas  this this  kiwis kiwi
gaps gap  ties tie  youth youth  boyish boyish  enjoy enjoy  article articl  dog's dog  'tis tis
"""


def test_stemmer_on_published_pairs(spark):
    words = STEMS.split()
    assert apply(spark, stem, *words[::2]) == words[1::2]


def test_process_columns(spark):
    rows = spark.createDataFrame(
        [("this is a test sentence with running and jumping",)], "content string")
    row = add_processed(cleaning.normalize_columns(rows)).first()
    assert row["content_processed"] == "test sentenc run jump"
    terms = vocabulary.term_counts(rows, T.tokenize(F.col("content")))
    stages = {(r["stage"], r["term"]) for r in vocabulary.staged_vocabulary(terms).collect()}
    assert {("raw", "running"), ("no_stop", "running"), ("stemmed", "run")} <= stages
    assert ("no_stop", "this") not in stages
    assert apply(spark, process_text_words, "running quickly") == ["run quick"]
    assert apply(spark, process_text, "") == [""]


def test_normalize_columns_leaves_raw_text(spark):
    rows = spark.createDataFrame(
        [("Hello World! Visit https://example.com", "My Title 123")],
        "content string, title string")
    row = cleaning.normalize_columns(rows).first()
    assert row["content"] == "Hello World! Visit https://example.com"
    assert row["content_normalized"] == "hello world visit urltoken"
    assert row["title_normalized"] == "my title numtoken"


def test_empty_vocabulary_has_zero_rates(spark):
    rows = spark.createDataFrame([("",)], "content string")
    terms = vocabulary.term_counts(rows, T.tokenize(F.col("content")))
    row = vocabulary.reduction_rates(vocabulary.vocabulary_sizes(terms)).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_counts_respect_unicode_boundaries(spark):
    text = "é12 x 12 b3 ٣٤ 5 2020-01-02"
    assert apply(spark, T.count_numbers, text) == [6]
    assert apply(spark, T.count_dates, text, "é2020-01-02") == [1, 0]
    assert apply(spark, T.count_urls, "www.a.b https://c.d/e x") == [2]
    assert apply(spark, T.token_length, " a b  c", None) == [3, 0]


def test_style_features(spark):
    rows = spark.createDataFrame(
        [(0, "HELLO world!", "Title"), (1, "two words?", None), (2, "", None)],
        "id int, content string, title string")
    a, b, c = features.style_features(rows).orderBy("id").collect()
    assert a["caps_ratio"] == pytest.approx(5 / 13)
    assert a["exclamation_density"] == pytest.approx(1 / 13)
    assert a["content_word_count"] == 2
    assert a["title_content_ratio"] == pytest.approx(5 / 13)
    assert b["question_density"] == pytest.approx(1 / 11)
    assert b["avg_word_length"] == pytest.approx(4.5)
    assert b["title_content_ratio"] == 0
    assert c["avg_word_length"] == 0 and c["content_word_count"] == 0
    assert rows.columns == ["id", "content", "title"]


def test_parse_mixed(spark):
    values = [
        "2018-01-25", "2018-01-25 16:17:44.789555", "2018-01-25T16:17:44Z",
        "2018-01-25 16:17:44+02:00", "2018/01/25", "Jan 5, 2020", "1/25/2018 16:17",
        "not-a-date", "", None, "16:17",
    ]
    parsed = apply(spark, lambda v: F.date_format(parse_mixed(v), "yyyy-MM-dd HH:mm:ss"), *values)
    assert parsed == [
        "2018-01-25 00:00:00", "2018-01-25 16:17:44", "2018-01-25 16:17:44",
        "2018-01-25 14:17:44", "2018-01-25 00:00:00", "2020-01-05 00:00:00",
        "2018-01-25 16:17:00", None, None, None, None,
    ]


def test_statement_labels(spark):
    labels = ["true", "mostly-true", "half-true", "barely-true", "false", "pants-fire", "odd", None]
    assert apply(spark, L.statement_label, *labels) == [0, 0, 0, 1, 1, 1, 1, 1]
    assert apply(spark, L.statement_label_or_null, *labels) == [0, 0, 0, 1, 1, 1, None, None]


def test_treebank_words(spark):
    texts = {
        "They'll save and invest more.": "They 'll save and invest more .",
        "hi, my name can't hello,": "hi , my name ca n't hello ,",
        "Good muffins cost $3.88\nin New York.  Please buy me\ntwo of them.\nThanks.":
            "Good muffins cost $ 3.88 in New York. Please buy me two of them. Thanks .",
        '"I cannot," he said... (1,000 times)--or more!':
            "`` I can not , '' he said ... ( 1,000 times ) -- or more !",
        "'Tis gonna be d'ye know: more'n 5:30": "'T is gon na be d 'ye know : more 'n 5:30",
        "it's John's dogs' and the N'T 'quoted' x": "it 's John 's dogs ' and the N'T 'quoted ' x",
        "a@b.c; 50% & #tag*": "a @ b.c ; 50 % & # tag *",
        "We’re “in” «it»": "We ’ re “ in ” « it »",
        "end.\")": "end . '' )", "wanna": "wan na", "": "", " \n ": "",
    }
    df = spark.createDataFrame([(k,) for k in [*texts, None]], "t string")
    got = {r["t"]: r["w"] for r in df.select("t", treebank_words(F.col("t")).alias("w")).collect()}
    assert got.pop(None) == []
    assert got == {text: words.split() for text, words in texts.items()}


def test_raw_words_are_stemmed(spark):
    assert apply(spark, process_raw_words, "They're NOT running, \"quickly\"!") == [
        "re run , `` quick '' !"]


def test_ends_cover_every_rule():
    """A word without one of the ends can not be changed by any step."""
    suffixes = {*stemming.STEP_2, *stemming.STEP_3, *stemming.STEP_4, *stemming._exceptions(),
                "s", "ied", "ies", "eed", "eedly", "ing", "ingly", "ed", "edly", "y", "e", "ll"}
    assert all(suffix.endswith(stemming.ENDS) for suffix in suffixes)


def test_cheap_tests_leave_no_match_out(spark):
    """Texts that skip a rule or a step come out as if they had gone through all of them."""
    rng = random.Random(3)
    parts = ["cannot", "D'Ye", "wanna ", " 'twas", "''", '"', "``", "“", "’", ".", "...", ",", ":",
             "1", "12-3-2020", "-", "--", "$", "?", "(", "]", "'s ", "N'T ", "word", "é", "Ã©", "ß",
             "a@b.com", "www.x", "http://x.y", "1,000.5", "\n", " ", " ", " ", "running", "日本"]
    df = spark.createDataFrame(
        [("".join(rng.choices(parts, k=rng.randint(0, 9))),) for _ in range(400)] + [(None,)],
        "t string")
    t = F.col("t")
    inner = treebank.squeeze_blanks(treebank.text_or_empty(t))
    for pattern, replacement, _ in treebank.OPENING + treebank.PUNCTUATION:
        inner = F.regexp_replace(inner, pattern, replacement)
    plain = F.concat(F.lit(" "), inner, F.lit(" "))
    for pattern, replacement, *_ in treebank.CLOSING + treebank.CONTRACTED:
        plain = F.regexp_replace(plain, pattern, replacement)
    folded = T.drop_marks(T.fold_letters(T.repair_encoding(t)))
    pairs = {
        "treebank": (treebank_words(t), T.split_normalized(plain)), "fold": (T.fold_ascii(t), folded),
        "dates": (T.replace_dates(t), F.regexp_replace(t, T.DATE, T.DATE_TOKEN)),
        "urls": (T.replace_urls(t), F.regexp_replace(t, "(?U)" + T.URL, T.URL_TOKEN)),
        "emails": (T.replace_emails(t), F.regexp_replace(t, T.EMAIL, T.EMAIL_TOKEN)),
        "numbers": (T.replace_numbers(t), F.regexp_replace(t, T.NUMBER, "$1" + T.NUMBER_TOKEN)),
        "words": (T.model_words(t), F.regexp_extract_all(
            F.lower(T.text_or_empty(t)), F.lit(T.MODEL_WORD), F.lit(0)))}
    wrong = df.select(*[F.count_if(~a.eqNullSafe(b)).alias(name) for name, (a, b) in pairs.items()])
    assert not any(wrong.first())
    stems = df.select(F.explode(treebank_words(F.lower(t))).alias("w")).select(
        F.count_if(stemming.stem(F.col("w")) != stemming._stem_of(F.col("w"))))
    assert stems.first()[0] == 0
