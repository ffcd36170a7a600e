"""Words and signs of raw text by the conventions of the Penn Treebank, as native expressions.

Quotes become two backticks or two apostrophes, endings such as ``n't`` and ``'ll`` part from their
words, and punctuation stands alone but for full stops inside the text. The text counts as one
sentence: only its last full stop is cut off, so split into sentences first where that matters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlake.functions.text import split_normalized, squeeze_blanks, text_or_empty
from textlake.functions.unicode import let

# The rewriting rules of the convention, in order. The third part names pieces of
# text: a rule can only match where one of them is, and looking for them is much faster.
OPENING = (
    (r"([«“‘„]|`+)", " $1 ", "«“‘„`"),
    (r'^"', " `` ", '"'),
    (r"""([ (\[{<])(?:"|'')""", "$1 `` ", ('"', "''")),
    # an apostrophe before a single letter that is no ending
    (r"'([A-CE-LO-RU-Za-ce-lo-ru-z0-9_])\b", "' $1", "'"),
)
PUNCTUATION = (
    (r"""([^.])\.([\])}>"'»”’ ]*)$""", "$1 . $2 ", "."),
    (r"([:,])([^0-9])", " $1 $2", ":,"),
    (r"([:,])$", " $1 ", ":,"),
    (r"(\.{2,})", " $1 ", ("..",)),
    (r"([;@#$%&?!*])", " $1 ", ";@#$%&?!*"),
    (r"([^'])' ", "$1 ' ", ("' ",)),
    (r"([\]\[(){}<>])", " $1 ", "][(){}<>"),
    (r"--", " -- ", ("--",)),
)
CLOSING = (
    (r"([»”’])", " $1 ", "»”’"),
    (r"""(?:''|")""", " '' ", ("''", '"')),
    (r" {2,}", " ", ("  ",)),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 ", "'"),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 ", "'"),
)
CONTRACTED = (
    (r"(?i)\b(can)(not)\b", " $1 $2 "),
    (r"(?i)\b(d)('ye)\b", " $1 $2 "),
    (r"(?i)\b(gim|lem)(me)\b", " $1 $2 "),
    (r"(?i)\b(gon)(na)\b", " $1 $2 "),
    (r"(?i)\b(got)(ta)\b", " $1 $2 "),
    (r"(?i)\b(more)('n)\b", " $1 $2 "),
    (r"(?i)\b(wan)(na) ", " $1 $2 "),
    (r"(?i) ('t)(is|was)\b", " $1 $2 "),
)
#: One of these is in any lower-case text in which one of the above matches.
CONTRACTED_SIGNS = (
    "cannot", "d'ye", "gimme", "lemme", "gonna", "gotta", "more'n", "wanna", "'tis", "'twas")


def _holds(text: Column, pieces: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(piece) for piece in pieces])


def _rewritten(text: Column, rules: tuple[tuple[str, str, Sequence[str]], ...]) -> Column:
    for pattern, replacement, pieces in rules:
        # the function is called at once, so it sees this round's rule
        text = let(text, lambda t: F.when(
            _holds(t, pieces), F.regexp_replace(t, pattern, replacement)).otherwise(t))
    return text


def _parted(text: Column) -> Column:
    """Contracted forms without a sign between their parts, split."""
    split = text
    for pattern, replacement in CONTRACTED:
        split = F.regexp_replace(split, pattern, replacement)
    return F.when(let(F.lower(text), lambda t: _holds(t, CONTRACTED_SIGNS)), split).otherwise(text)


def treebank_words(text: Column) -> Column:
    """Array of words and signs; null, empty and blank text give an empty array."""
    inner = _rewritten(squeeze_blanks(text_or_empty(text)), OPENING + PUNCTUATION)
    padded = F.concat(F.lit(" "), inner, F.lit(" "))
    return split_normalized(let(_rewritten(padded, CLOSING), _parted))
