"""Text scalars as native column expressions.

Java's ``\\s``, ``\\w`` and ``\\b`` are ASCII-only unless ``(?U)`` is set, so boundaries and blanks
that must treat accented or non-Latin text like letters say so. Large hand-written character
classes are avoided: they cost ten times as much per character.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlake.functions.stopwords import ENGLISH
from textlake.functions.unicode import drop_marks, fold_letters, let, repair_encoding

# The artefact patterns of the corpus and the words that replace them.
URL = r"https?://\S+|www\.\S+"
DATE = r"\b\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}\b"
WHOLE_NUMBER = r"\b\d+\b"
EMAIL = r"(?<![\w.+])[\w.+]++@\w[\w.]*\.[A-Za-z]{2,}"
# holds wherever a date does, and is looked for much faster
DATE_SIGN = r"\d[-/.]\d{1,2}[-/.]\d"
NUMBER = r"(^|[^\w,.])[+]?(?:\d+(?:[.,]\d+)*|[.,]\d+)\b"
URL_TOKEN, DATE_TOKEN, EMAIL_TOKEN, NUMBER_TOKEN = (
    "URLTOKEN", "DATETOKEN", "EMAILTOKEN", "NUMTOKEN",
)

# With (?U) Java's \\s covers the blanks of all of Unicode; the four separators are added.
_BLANK = r"\s\x1C-\x1F"
TOKEN = rf"(?U)[^{_BLANK}]+"
BLANK = rf"(?U)[{_BLANK}]"
SQUEEZABLE = rf"(?U)[{_BLANK}]{{2,}}|[^\S ]|[\x1C-\x1F]"
_WORD_CHAR = r"[\p{L}\p{N}_]"
MODEL_WORD = r"[\p{L}\p{N}_]{2,}"
# the same for ASCII text, where it is found much faster
ASCII_MODEL_WORD = "[A-Za-z0-9_]{2,}"

# Forms that the Treebank conventions split after their first part.
CONTRACTED = r"\b(can(?=not\b)|gon(?=na\b)|got(?=ta\b)|gim(?=me\b)|lem(?=me\b)|wan(?=na\b))"
SYMBOL = r"([$<>+=`^~|])"


def _unicode_bounds(pattern: str) -> str:
    """The same pattern with word boundaries and digits that see all of Unicode."""
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b").replace(r"\d", r"\p{Nd}")
    return rf"(?<!{_WORD_CHAR}){inner}(?!{_WORD_CHAR})"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


# --- steps of the normaliser -------------------------------------------------


def fold_ascii(text: Column) -> Column:
    """Misread UTF-8 repaired and accented Latin letters folded; other scripts are kept."""
    return let(text, lambda t: F.when(
        t.rlike(r"[^\x00-\x7F]"), drop_marks(fold_letters(repair_encoding(t)))).otherwise(t))


def _replaced_where(
    may_match: Callable[[Column], Column], text: Column, pattern: str, replacement: str,
) -> Column:
    """A replacement that is only tried on texts that pass a much cheaper test it implies."""
    return let(text, lambda t: F.when(
        may_match(t), F.regexp_replace(t, pattern, replacement)).otherwise(t))


def replace_urls(text: Column) -> Column:
    return _replaced_where(
        lambda t: t.contains("://") | t.contains("www."), text, "(?U)" + URL, URL_TOKEN)


def replace_dates(text: Column) -> Column:
    return _replaced_where(lambda t: t.rlike(DATE_SIGN), text, DATE, DATE_TOKEN)


def blank_dashes(text: Column) -> Column:
    return F.regexp_replace(text, "[-/]", " ")


def replace_emails(text: Column) -> Column:
    return _replaced_where(lambda t: t.contains("@"), text, EMAIL, EMAIL_TOKEN)


def replace_numbers(text: Column) -> Column:
    return _replaced_where(lambda t: t.rlike("[0-9]"), text, NUMBER, "$1" + NUMBER_TOKEN)


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{P}", "")


def squeeze_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SQUEEZABLE, " "))


def lower_and_squeeze(text: Column) -> Column:
    """Lower case, every run of blanks or line breaks one space, no blanks at the ends."""
    return squeeze_blanks(F.lower(text))


def normalize_text(text: Column) -> Column:
    """Lower-case text with artefact tokens and no punctuation; null becomes ''.

    Folding comes first so that ASCII word boundaries agree with the letters; dashes are
    blanked before e-mail addresses and numbers are looked for.
    """
    step = replace_urls(fold_ascii(text_or_empty(text)))
    step = blank_dashes(replace_dates(step))
    step = replace_numbers(replace_emails(step))
    return lower_and_squeeze(remove_punctuation(step))


# --- tokens --------------------------------------------------------------------


def split_normalized(text: Column) -> Column:
    """Tokens of text whose blanks are single spaces already, as the normaliser leaves them."""
    return F.array_remove(F.split(text_or_empty(text), " "), "")


def tokenize(text: Column) -> Column:
    """Whitespace tokens; empty or null text gives an empty array."""
    return split_normalized(squeeze_blanks(text_or_empty(text)))


def split_contracted(text: Column) -> Column:
    """``cannot`` -> ``can not`` and the like, in already normalised text."""
    return F.regexp_replace(text, CONTRACTED, "$1 ")


def tokenize_words(text: Column) -> Column:
    """Word tokens: contracted forms split, symbols standing alone."""
    return tokenize(F.regexp_replace(split_contracted(text_or_empty(text)), SYMBOL, " $1 "))


def remove_stopwords(words: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Drop stop words but keep order and repetitions."""
    return F.filter(words, lambda word: ~word.isin(*stopwords))


def model_words(text: Column) -> Column:
    """Lower-case words of at least two word characters."""
    return let(F.lower(text_or_empty(text)), lambda t: F.when(
        t.rlike(r"[^\x00-\x7F]"), F.regexp_extract_all(t, F.lit(MODEL_WORD), F.lit(0)),
    ).otherwise(F.regexp_extract_all(t, F.lit(ASCII_MODEL_WORD), F.lit(0))))


def _followed_by_pairs(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs),
        lambda first, second: F.concat(first, F.lit(" "), second)))


def with_bigrams(words: Column) -> Column:
    """The words followed by each pair of neighbours joined with a blank.

    The array is bound to a lambda variable, so however costly it is, it is computed once.
    """
    return F.flatten(F.transform(F.array(words), _followed_by_pairs))


# --- counts and ratios ---------------------------------------------------------


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(pattern))


def count_urls(text: Column) -> Column:
    return count_matches(text, "(?U)" + URL)


def count_dates(text: Column) -> Column:
    return count_matches(text, _unicode_bounds(DATE))


def count_numbers(text: Column) -> Column:
    return count_matches(text, _unicode_bounds(WHOLE_NUMBER))


def token_length(text: Column) -> Column:
    return count_matches(text, TOKEN)


def _share(count: Column, text: Column) -> Column:
    return count / (F.length(text) + 1)


def _occurrences(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def caps_ratio(text: Column) -> Column:
    text = text_or_empty(text)
    return _share(F.regexp_count(text, F.lit(r"\p{Lu}")), text)


def character_density(text: Column, character: str) -> Column:
    text = text_or_empty(text)
    return _share(_occurrences(text, character), text)


def avg_word_length(text: Column) -> Column:
    text = text_or_empty(text)
    letters = F.length(text) - F.regexp_count(text, F.lit(BLANK))
    words = token_length(text)
    return F.when(words > 0, letters / words).otherwise(F.lit(0.0))


def title_content_ratio(title: Column, content: Column) -> Column:
    return _share(F.length(text_or_empty(title)), text_or_empty(content))
