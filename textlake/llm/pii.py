"""Personal data in text, also where it is disguised, with offsets into the source text.

Plain identifiers are found by the base patterns. Then a text that shows signs of disguise is
normalised by small transducers (look-alike letters and digits, invisible characters, digits
spelled as words, "at" and "dot" written out), each of which keeps for every character it writes
the source characters it stands for. Identifiers found in the normal form are mapped back and
added unless they lie within a base span of their kind; one that is partly disguised is added whole
beside the base span of its plain part.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from textlake.llm.endings import ENDINGS

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Equal to the base patterns from the left end of a run of digits, where their matches start;
# later starts in the same run can't match, so long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LONG_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){15}")


def emails(text: str) -> Iterator[Span]:
    """Leftmost e-mail addresses, walking from one @ to the next."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = at + 1  # an @ ends every local part
        at = text.find("@", done)


def ips(text: str) -> Iterator[Span]:
    """Four numbers joined by dots, each at most 255."""
    if not _DOTTED.search(text):
        return
    for found in _IP.finditer(text):
        parts = (part.lstrip("0") for part in found.group().split("."))
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield found.span()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    """16 to 19 digits, single blanks or hyphens between them, that pass the Luhn test."""
    if not _LONG_NUMBER.search(text):
        return
    for found in _CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[Span]:
    """International numbers of 8 to 15 digits."""
    if "+" not in text:
        return
    for found in _PHONE.finditer(text):
        if 8 <= sum(c.isdecimal() for c in found.group()) <= 15:
            yield found.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the plain identifiers of each kind, in code points, end exclusive."""
    return {kind: list(find(text)) for kind, find in FINDERS.items()}


# --- the normal form: a list of (character, first source character, end) --------------------

# Letters that look like plain Latin ones: Cyrillic, Greek, Armenian, small capitals
# and other Latin forms.
LOOK_ALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеорсухіјѕһԁԛԝвкмнтгьпѵӏүԌԚԜѴҮ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαικνρτυχγϲϳ" "օոսհցզյ"
    "ᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀꜱᴛᴜᴠᴡʏᴢ" "ıȷɑɡɩ",
    "ABESIJKMHOPCTYXaeopcyxijshdqwbkmhtrbnvlyGQWVY" "ABEZHIKMNOPTYXoaikvptuxycj" "onuhgqj"
    "abcdeghijklmnoprstuvwyz" "ijagi", strict=True))
# Characters that are not seen.
INVISIBLE = "­​‌‍‎‏⁠﻿"
# Digits and "plus" in words, by language.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
OTHER_WORDS = {"oh": "0", "plus": "+", "más": "+", "dash": "-", "hyphen": "-"}
# Fixed values: "at" and "dot" in words.
AT_WORDS, DOT_WORDS = "at|arobase|arroba", "dot|point|punkt|punto"
#: Shorter runs of spelled digits are left alone, but for those of two that follow a digit or a plus.
MIN_SPELLED = 3

SPELLED = {
    word: str(value) for words in DIGIT_WORDS.values()
    for value, word in enumerate(words.split())} | OTHER_WORDS
_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
_SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:{_WORDS})(?:[\s,.\-]{{1,3}}(?:{_WORDS}|[0-9]+)(?!\w))+", re.I)
_SPELLED_TOKEN = re.compile(rf"{_WORDS}|[0-9]+|[^\w\s]|\s+", re.I)
_BRACKETED = re.compile(
    rf"\s*[\[({{<]\s*(?:(?P<at>{AT_WORDS}|@)|(?P<dot>{DOT_WORDS}|\.))\s*[\])}}>]\s*", re.I)
_LABEL, _NAME = "[A-Za-z0-9-]++", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
# Words of two letters that are no country, and words that are no host; prose has
# "at the dot on" too.
_NO_COUNTRY = "an|du|el|en|et|go|he|hi|if|lo|ob|of|oh|ok|on|or|ou|ox|un|up|we|wo|zu"
_NO_HOST = ("the|a|an|this|that|these|those|each|every|any|one|my|your|his|her|its|our|their|der|die|das|dem|den|"
            "ein|eine|einem|einer|le|la|les|un|une|el|los|las|una|ce|cette|este|esta|and|or|in|on|to|of|at")
_NO_NAME = frozenset(_NO_HOST.split("|"))
_HOST = rf"(?!(?:{_NO_HOST})\s){_LABEL}"
# "at" as a word needs "dot" as a word; @ also goes with full stops.
_SPACED_ADDRESS = re.compile(
    rf"{_NAME}(?:\s+(?:{AT_WORDS})\s+{_HOST}(?P<more>(?:\s+(?:{DOT_WORDS})\s+{_LABEL})*)"
    rf"\s+(?:{DOT_WORDS})\s+(?P<ending>[A-Za-z]{{2,}})(?![A-Za-z0-9-])"
    rf"|\s*@\s*{_LABEL}(?:(?:\s+(?:{DOT_WORDS})\s+|\s*\.){_LABEL})+)", re.I)
_DOT_LABEL = re.compile(rf"\s(?:{DOT_WORDS})\s+({_LABEL})", re.I)
_NO_ENDING = frozenset(_NO_COUNTRY.split("|"))
# "at" as a word before a host with a bracketed dot.
_AT_BEFORE_BRACKETS = re.compile(
    rf"{_NAME}(?P<at>\s+(?:{AT_WORDS})\s+)(?!(?:{_NO_HOST})\s){_LABEL}"
    rf"\s*[\[({{<]\s*(?:{DOT_WORDS}|\.)\s*[\])}}>]\s*[A-Za-z]{{2}}", re.I)
_DIGIT_WORD = "|".join(w for w in sorted(SPELLED, key=len, reverse=True) if SPELLED[w].isdigit())
_IP_PART = rf"(?:[0-9]+|(?:{_DIGIT_WORD})(?:[\s,\-]{{1,3}}(?:{_DIGIT_WORD}|[0-9]+)(?!\w)){{0,2}})"
_SPACED_IP = re.compile(
    rf"(?<!\w){_IP_PART}(?:(?:\s+(?:{DOT_WORDS}|\.)\s+|\.){_IP_PART}){{3}}(?!\w)", re.I)
_IP_TOKEN = re.compile(rf"(?P<dot>\s+(?:{DOT_WORDS}|\.)\s+|\.)|[0-9]+|{_DIGIT_WORD}|[\s,\-]+", re.I)
_SPACED_JOINT = re.compile(
    rf"(?P<at>\s+(?:{AT_WORDS})\s+|\s*@\s*)|(?P<dot>\s+(?:{DOT_WORDS})\s+|\s*\.)", re.I)

@functools.lru_cache(maxsize=4096)
def plain_form(char: str) -> str:
    """The ASCII character that a look-alike stands for; empty for an invisible one."""
    if char < "\u0080":
        return char
    if char in INVISIBLE:
        return ""
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if char in "‐‑‒–—―−":
        return "-"
    if char == "․":
        return "."
    digit = unicodedata.digit(char, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    return folded if len(folded) == 1 and folded < "\u0080" else char


def _changed_chars() -> str:
    """Everything that plain_form changes, as ranges of a character class.

    Such characters end below U+20000.
    """
    ranges: list[list[int]] = []
    for code in range(0x80, 0x20000):
        if plain_form.__wrapped__(chr(code)) != chr(code):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges)


_SIGN_CHARS = re.compile(f"[{_changed_chars()}]")
# What must be in a text that the later transducers change: brackets, blanks at the joints of an
# address, or the words below.
_SIGN_BRACKETS = re.compile(rf"[\[({{<]\s*(?:{AT_WORDS}|@|{DOT_WORDS}|\.)\s*[\])}}>]", re.I)
_SPACED_JOINTS = re.compile(r"\s[@.]|@\s")
_SPACED_STOP = re.compile(r"\s\.\s")
_DOT_WORDS = frozenset(DOT_WORDS.split("|"))
_TOKEN = re.compile(r"\w+")


def lowered(text: str) -> str:
    """Lower case as the patterns ignore it: the dotted capital I is an i."""
    return text.replace("İ", "i").lower()


def shows_signs(text: str) -> bool:
    """Whether a transducer may change a text; never false where one does.

    The words are looked up one by one: a run of spelled digits is a digit word with another one
    or a number behind it.
    """
    if not text.isascii() and _SIGN_CHARS.search(text) or _SIGN_BRACKETS.search(text):
        return True
    if "@" in text and _SPACED_JOINTS.search(text) or _SPACED_STOP.search(text):
        return True
    words = _TOKEN.findall(lowered(text))
    if not _DOT_WORDS.isdisjoint(words):
        return True
    if SPELLED.keys().isdisjoint(words):
        return False
    known = list(map(SPELLED.__contains__, words))
    return any(map(operator.and_, known, map(
        operator.or_, known[1:], map(str.isdecimal, words[1:]))))


class Normal:
    """A text with, for each of its characters, the source characters it stands for."""

    def __init__(self, text: str, starts: list[int], ends: list[int]):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, source: str) -> Normal:
        """First transducer: look-alikes replaced, invisible characters dropped."""
        if source.isascii() or not _SIGN_CHARS.search(source):
            places = list(range(len(source) + 1))
            return cls(source, places[:-1], places[1:])
        chars, starts = [], []
        for place, char in enumerate(source):
            form = plain_form(char)
            if form:
                chars.append(form)
                starts.append(place)
        return cls("".join(chars), starts, [place + 1 for place in starts])

    def rewritten(self, edits: Iterator[tuple[int, int, str]]) -> Normal:
        """Replace disjoint ranges, in order; each new character stands for its whole range."""
        parts, starts, ends, done = [], [], [], 0
        for start, end, new in edits:
            parts += [self.text[done:start], new]
            starts += self.starts[done:start]
            ends += self.ends[done:start]
            first, last = self.starts[start], self.ends[end - 1]
            starts += [first] * len(new)
            ends += [last] * len(new)
            done = end
        if not parts:
            return self
        return Normal("".join([*parts, self.text[done:]]), starts + self.starts[done:],
                      ends + self.ends[done:])

    def source_span(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _follows_digit(text: str, at: int) -> bool:
    """Whether a digit or plus stands before a place, with up to three signs of a number between."""
    before = text[max(0, at - 4):at].rstrip(" ().-")
    return before[-1:] == "+" or before[-1:].isdecimal()


def _spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Second transducer: runs of digits in words become digits; their separators go."""
    for run in _SPELLED_RUN.finditer(text):
        n_digits = sum(token[0].isalnum() for token in _SPELLED_TOKEN.findall(run.group()))
        if n_digits < MIN_SPELLED and not _follows_digit(text, run.start()):
            continue
        for token in _SPELLED_TOKEN.finditer(text, *run.span()):
            word = token.group()
            if word.isdecimal() and word.isascii():
                continue
            yield token.start(), token.end(), SPELLED.get(
                lowered(word), "." if word == "." else "")


def _at_words(text: str) -> Iterator[tuple[int, int, str]]:
    """Third transducer: "at" as a word becomes @ where a bracketed dot follows the host."""
    for found in _AT_BEFORE_BRACKETS.finditer(text):
        yield *found.span("at"), "@"


def _written_signs(text: str) -> Iterator[tuple[int, int, str]]:
    """Fourth transducer: bracketed "at" and "dot" become @ and a full stop."""
    for found in _BRACKETED.finditer(text):
        yield found.start(), found.end(), "@" if found["at"] else "."


def _spaced_ips(text: str) -> Iterator[tuple[int, int, str]]:
    """Fifth transducer: four numbers, in digits or words, joined by "dot" become an address."""
    for address in _SPACED_IP.finditer(text):
        for token in _IP_TOKEN.finditer(text, *address.span()):
            word = token.group()
            if word != "." and not word.isdecimal():
                yield token.start(), token.end(), "." if token["dot"] else SPELLED.get(
                    lowered(word), "")


def _ends_address(ending: str) -> bool:
    ending = lowered(ending)
    if not ending.isascii() or not ending.isalpha():
        return False
    return ending not in _NO_ENDING if len(ending) == 2 else ending in ENDINGS


def _address_end(found: re.Match) -> int | None:
    """Where the longest part with a known ending ends, or else all of it if it has two dot words.

    Addresses with @ need no known ending.
    """
    if found["ending"] is None or _ends_address(found["ending"]):
        return found.end()
    labels = list(_DOT_LABEL.finditer(found.string, *found.span()))
    for label in reversed(labels[:-1]):
        if _ends_address(label[1]):
            return label.end()
    return found.end() if found["more"] else None


def _word_before(text: str, at: int, done: int, letters) -> int:
    while at > done and letters(text[at - 1]):
        at -= 1
    return at


def _name_start(text: str, start: int, done: int) -> int:
    """Start of a name with written dots, such as "jo dot doe", that ends with the name at start."""
    while True:
        blank = _word_before(text, start, done, str.isspace)
        dot = _word_before(text, blank, done, str.isalpha)
        gap = _word_before(text, dot, done, str.isspace)
        name = _word_before(text, gap, done, _LOCAL.__contains__)
        if (blank == start or gap == dot or name == gap or lowered(text[dot:blank]) not in _DOT_WORDS
                or lowered(text[name:gap]) in _NO_NAME):
            return start
        start = name


def _spaced_signs(text: str) -> Iterator[tuple[int, int, str]]:
    """Sixth transducer: at and dot as words of their own, within what reads as an address."""
    at = 0
    while found := _SPACED_ADDRESS.search(text, at):
        end = _address_end(found)
        if end is not None:
            start = _name_start(text, found.start(), at)
            for joint in _SPACED_JOINT.finditer(text, start, end):
                if joint.group() not in ("@", "."):
                    yield joint.start(), joint.end(), "@" if joint["at"] else "."
        at = end or found.end()


def normalise(source: str) -> Normal | None:
    """The normal form, or None for a text that shows no sign of disguise."""
    if not shows_signs(source):
        return None
    form = Normal.of(source)
    form = form.rewritten(_spelled_digits(form.text))
    form = form.rewritten(_at_words(form.text))
    form = form.rewritten(_written_signs(form.text))
    form = form.rewritten(_spaced_ips(form.text))
    return form.rewritten(_spaced_signs(form.text))


def added_spans(source: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that only the normal form shows: those that lie within no base span of the kind."""
    form = normalise(source)
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if form is None:
        return found
    for kind, find in FINDERS.items():
        taken, at = base[kind], 0
        for span in map(form.source_span, find(form.text)):
            while at < len(taken) and taken[at][1] <= span[0]:
                at += 1
            inside = at < len(taken) and taken[at][0] <= span[0] and span[1] <= taken[at][1]
            if not inside and (not found[kind] or found[kind][-1][1] <= span[0]):
                found[kind].append(span)
    return found


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in sorted(spans[kind]))


_NOTHING = {kind: [] for kind in KINDS}


def find_all(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans of a text; none for null."""
    if not text:
        return _NOTHING, _NOTHING
    base = base_spans(text)
    return base, added_spans(text, base)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pii``: every span with kind, place, source text and whether the disguise was undone.

    Map-only, over whole texts. Null and empty texts have no spans. A column called ``pii`` is
    replaced, all others pass through.
    """
    keep = [name for name in docs.columns if name != "pii"]
    rows = docs.select(*[f"`{name}`" for name in keep])
    kind = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
        ("value", pa.string()), ("disguised", pa.bool_())]))

    def run(batches):
        for batch in batches:
            out = []
            for value in batch.column(keep.index(text)):
                source = value.as_py()
                parts = find_all(source)
                out.append(sorted(
                    ({"kind": k, "start": a, "end": b, "value": source[a:b], "disguised": d}
                     for d, part in zip((False, True), parts)
                     for k in KINDS for a, b in part[k]),
                    key=lambda s: (KINDS.index(s["kind"]), s["start"])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, kind)], names=[*keep, "pii"])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        + ["pii array<struct<kind:string,start:int,end:int,value:string,disguised:boolean>>"])
    return rows.mapInArrow(run, schema)


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, one row per row of ``docs``.

    ``n_added`` counts the spans that the normal form adds; ``spans`` lists both sorts. Map-only,
    over whole texts of any length. Null and empty texts have counts of 0, the digest of the empty
    string and empty ``spans``. Null and repeated keys and equal rows are kept as they are; an empty
    table gives an empty one. Columns other than key and text are not looked at, so their names
    cannot clash.
    """
    rows = docs.select(f"`{key}`", f"`{text}`")
    names = [key, *(f"n_{kind}" for kind in KINDS), "n_added", "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            out = []
            for value in batch.column(1):
                base, added = find_all(value.as_py())
                both = {kind: base[kind] + added[kind] for kind in KINDS}
                out.append((
                    *(len(base[kind]) for kind in KINDS), sum(map(len, added.values())),
                    hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(both)))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    kind = dict(rows.dtypes)[key]
    return rows.mapInArrow(run, ", ".join(
        [f"`{key}` {kind}", *(f"n_{k} bigint" for k in KINDS), "n_added bigint",
         "base_sha256 string", "spans string"]))
