"""English Snowball (Porter2) stemming as native array expressions.

Each step maps over the array of words of a row, so nothing is shuffled, no row leaves the
JVM and the cost is linear in the number of tokens. Suffixes are tested first (a byte
comparison); the region conditions, which need a regular expression, are evaluated only for
words that carry the suffix: a suffix lies in a region exactly when the part before it already
contains the prefix that opens the region.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word lists and suffix tables of the published Porter2 rules.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
UNCHANGED_IN_BOTH_NUMBERS = [
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
]
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = {
    suffix: "" for suffix in (
        "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
        "ism", "ate", "iti", "ous", "ive", "ize", "ion",
    )
}
REGION = "[^aeiouy]*[aeiouy]+[^aeiouy]"
OPENS_R1 = f"^(?>gener|commun|arsen|{REGION})"
OPENS_R2 = f"{OPENS_R1}{REGION}"
SHORT_SYLLABLE = "(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
DOUBLE = "(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
LI_ENDING = "[cdeghkmnrt]li$"



def _drop(word: Column, count: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - count)


def _exceptions() -> dict[str, str]:
    both = {form: word for word in UNCHANGED_IN_BOTH_NUMBERS for form in (word, word + "s")}
    return SPECIAL | both


# Ends a word that is already a stem: no suffix rule matches it.
FINISHED = "\x01"


def _prepare(word: Column) -> Column:
    """Finish exceptional words; strip apostrophes and write a consonant y as Y in the others."""
    exceptions = _exceptions()
    looked_up = F.create_map(*[F.lit(x) for pair in exceptions.items() for x in pair])
    bare = F.when(
        word.contains("'"), F.regexp_replace(word, r"^'|'(?:s'?)?$", "")).otherwise(word)
    return (
        F.when(F.length(word) <= 2, F.concat(word, F.lit(FINISHED)))
        .when(word.isin(*exceptions),
              F.concat(F.try_element_at(looked_up, word), F.lit(FINISHED)))
        .when(word.contains("y"),
              F.regexp_replace(F.regexp_replace(bare, "^y", "Y"), "([aeiouy])y", "$1Y"))
        .otherwise(bare)
    )


def _plural(word: Column) -> Column:
    return (
        F.when(~word.endswith("s") & ~word.endswith("ied"), word)
        .when(word.endswith("sses"), _drop(word, 2))
        .when(word.endswith("ied") | word.endswith("ies"),
              F.when(F.length(word) > 4, _drop(word, 2)).otherwise(_drop(word, 1)))
        .when(word.endswith("us") | word.endswith("ss"), word)
        .when(word.rlike("[aeiouy].+s$"), _drop(word, 1))
        .otherwise(word)
    )


def _mended(word: Column) -> Column:
    """Repair what -ed or -ing left behind."""
    return (
        F.when(word.rlike("(?:at|bl|iz)$"), F.concat(word, F.lit("e")))
        .when(word.rlike(DOUBLE), _drop(word, 1))
        .when(word.rlike(SHORT_SYLLABLE) & ~word.rlike(OPENS_R1 + "."),
              F.concat(word, F.lit("e")))
        .otherwise(word)
    )


def _past_and_gerund(word: Column) -> Column:
    def to_ee(size: int) -> Column:
        return F.when(_drop(word, size).rlike(OPENS_R1), _drop(word, size - 2)).otherwise(word)

    def stripped(size: int) -> Column:
        rest = _drop(word, size)
        return F.when(rest.rlike("[aeiouy]"), _mended(rest)).otherwise(word)

    return (
        F.when(~(word.endswith("ed") | word.endswith("ing") | word.endswith("ly")), word)
        .when(word.endswith("eedly"), to_ee(5))
        .when(word.endswith("eed"), to_ee(3))
        .when(word.endswith("ingly"), stripped(5))
        .when(word.endswith("edly"), stripped(4))
        .when(word.endswith("ing"), stripped(3))
        .when(word.endswith("ed"), stripped(2))
        .otherwise(word)
    )


def _final_y(word: Column) -> Column:
    return F.when(
        word.endswith("y") | word.endswith("Y"),
        F.regexp_replace(word, "(.[^aeiouy])[yY]$", "$1i"),
    ).otherwise(word)


def _rewriter(
    table: dict[str, str], opening: str, extra: dict[str, Callable[[Column], Column]],
) -> Callable[[Column], Column]:
    """Step that replaces the longest suffix of the table if it lies inside the region."""
    last_letters = sorted({suffix[-1] for suffix in table})

    def step(word: Column) -> Column:
        chain = F.when(~F.right(word, F.lit(1)).isin(*last_letters), word)
        for suffix in sorted(table, key=len, reverse=True):
            rest = _drop(word, len(suffix))
            allowed = rest.rlike(opening)
            if suffix in extra:
                allowed = extra[suffix](word) & allowed
            chain = chain.when(
                word.endswith(suffix),
                F.when(allowed, F.concat(rest, F.lit(table[suffix]))).otherwise(word),
            )
        return chain.otherwise(word)

    return step


def _final_e_or_l(word: Column) -> Column:
    rest = _drop(word, 1)
    return (
        F.when(word.endswith("e"), F.when(
            rest.rlike(OPENS_R2) | (rest.rlike(OPENS_R1) & ~rest.rlike(SHORT_SYLLABLE)), rest,
        ).otherwise(word))
        .when(word.endswith("ll"), F.when(rest.rlike(OPENS_R2), rest).otherwise(word))
        .otherwise(word)
    )


def _finish(word: Column) -> Column:
    return (
        F.when(word.endswith(FINISHED), _drop(word, 1))
        .when(word.contains("Y"), F.replace(word, F.lit("Y"), F.lit("y")))
        .otherwise(word)
    )


STEPS = [
    _prepare,
    _plural,
    _past_and_gerund,
    _final_y,
    _rewriter(STEP_2, OPENS_R1, {
        "ogi": lambda word: word.endswith("logi"),
        "li": lambda word: word.rlike(LI_ENDING),
    }),
    _rewriter(STEP_3, OPENS_R1, {
        "ative": lambda word: _drop(word, len("ative")).rlike(OPENS_R2),
    }),
    _rewriter(STEP_4, OPENS_R2, {"ion": lambda word: word.rlike("[st]ion$")}),
    _final_e_or_l,
    _finish,
]


#: Words without one of these ends, and without an apostrophe, are their own stems: each rule asks
#: for an ending that has one of them. The frequent ones come first.
ENDS = (
    "e", "s", "y", "ed", "ing", "er", "al", "ion", "ic", "ent", "ant", "li", "ll", "ism", "iti",
    "ful", "ator", "ogi", "nci", FINISHED)


def _may_change(word: Column) -> Column:
    tests = [word.endswith(end) for end in ENDS] + [word.contains(sign) for sign in ("'", "Y")]
    return reduce(lambda a, b: a | b, tests)


def _stem_of(word: Column) -> Column:
    """All steps on one word; each result is bound, so no step is worked out twice."""
    held = F.array(word)
    for step in STEPS:
        held = F.transform(held, step)
    return F.get(held, F.lit(0))


def stem_words(words: Column) -> Column:
    """Stem every word of an array of lower-case words, keeping order and repetitions."""
    return F.transform(words, lambda word: F.when(_may_change(word), _stem_of(word)).otherwise(word))


def stem(word: Column) -> Column:
    """Stem one word."""
    return F.element_at(stem_words(F.array(word)), 1)
