"""Repair of text whose UTF-8 bytes were read in a one-byte encoding, and folding to ASCII.

Text that went wrong is made of telltale runs: a letter that is a lead byte of UTF-8, followed by
signs that are its continuation bytes, in Latin-1 or in Windows' Western code page. Each run is
encoded back to its bytes and replaced if these are valid UTF-8; everything else is left alone, so
text that is only partly damaged, or has signs beyond the code page, is repaired too. All of this
is native.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Damage of text that was damaged again is undone this often.
PASSES = 3

# the code page's signs for the bytes 80 to 9F; five of these have none and stay control signs
SIGNS = {
    bytes([code]).decode("cp1252"): chr(code)
    for code in range(0x80, 0xA0) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_NEXT = "\u0080-¿" + "".join(SIGNS)
_LEADS = "Â-ô"
_LONG = rf"[à-ï][{_NEXT}]{{2}}|[ð-ô][{_NEXT}]{{3}}"
# quotation marks, blanks and the like may follow a capital letter in sound text
_RARE = "".join(c for c in map(chr, range(0x80, 0xC0)) if c not in "\u00a0\u00ad«»©®·")
_ALONE = (
    rf"[ÂÃ][{_NEXT}]|[ÄÅÎÏÐÑ]"
    rf"[{_RARE}{''.join(SIGNS)}]|{_LONG}")
_RUN = rf"(?:[Â-ß][{_NEXT}]|{_LONG}){{2,64}}"
DAMAGED = rf"[{_LEADS}][{_NEXT}]"
_PARTS = rf"{_RUN}|{_ALONE}|[^{_LEADS}]+|[{_LEADS}]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repaired_part(part: Column) -> Column:
    suspect = (F.length(part) > 1) & F.substring(part, 1, 1).between("Â", "ô")
    raw = F.encode(F.translate(part, "".join(SIGNS), "".join(SIGNS.values())), "ISO-8859-1")
    sound = let(raw.cast("string"), lambda t: F.when(F.is_valid_utf8(t), t))
    return F.coalesce(F.when(suspect, sound), part)


def _repaired_once(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0))
    return F.when(text.rlike(DAMAGED), F.array_join(F.transform(parts, _repaired_part), "")).otherwise(
        text)


def repair_encoding(text: Column) -> Column:
    """Text with runs of misread UTF-8 undone, also where this happened several times over.

    A lone accented capital and a sign that follows it are only taken for damage where sound
    text hardly has the two together; a run of two or more such pairs always is. Null stays null.
    """
    repaired = text
    for _ in range(PASSES):
        repaired = let(repaired, _repaired_once)
    return F.when(text.rlike(DAMAGED), repaired).otherwise(text)


def _base_letters() -> dict[str, str]:
    """Accented Latin letters whose decomposition leaves exactly one ASCII character."""
    folds = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        plain = [c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128]
        if len(plain) == 1:
            folds[chr(code)] = plain[0]
    return folds


FOLDS = _base_letters() | {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L"}
LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}
_MARKS = "̀-ͯ"


def drop_marks(text: Column) -> Column:
    """Combining marks behind Latin letters removed: decomposed text like composed one."""
    bare = F.regexp_replace(text, f"(?<=[A-Za-z])[{_MARKS}]+", "")
    return F.when(text.rlike(f"[A-Za-z][{_MARKS}]"), bare).otherwise(text)


def fold_letters(text: Column) -> Column:
    """Accented Latin letters to their base letters; other scripts are kept."""
    folded = F.translate(text, "".join(FOLDS), "".join(FOLDS.values()))
    for letter, plain in LIGATURES.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    return folded
