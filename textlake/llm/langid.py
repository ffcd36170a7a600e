"""Language identification by compression.

A dictionary of raw text is made for every language from a bounded sample of labelled rows. A
text belongs to the language whose dictionary lets Zstandard write it in the fewest bytes. Where
the runner-up needs hardly more, the answer is rejected.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.common import stored

UNDETERMINED = "und"
#: Of each language at most SALTS * ROWS_PER_SALT labelled rows are looked at, of each at most
#: SAMPLE_CHARS characters, and DICTIONARY_BYTES bytes go into the dictionary.
SALTS, ROWS_PER_SALT, SAMPLE_CHARS = 32, 6, 8_000
DICTIONARY_BYTES = 64 * 1024
#: More languages than this are refused: the dictionaries are sent to every executor.
MAX_LANGUAGES = 500
LEVEL = 6
#: Texts are compressed in blocks of this size, each against the bare dictionary, so that a long
#: text is judged by the dictionary throughout and not by its own beginning.
BLOCK_BYTES = 2048
#: Stands around each block. The library leaves the last bytes of an input unmatched and does not
#: compress what saves a few bytes only; with this around them, short texts are compared too. It
#: has no letters, so no dictionary knows it.
FILLER = b"01234567890123456789"
#: Relative gap between the two smallest sizes below which an answer is rejected.
MIN_MARGIN = 0.002

_NO_LETTERS = re.compile(r"[\W\d_]+")


def normal_form(text: str) -> str:
    """Lower case, and one blank for each run of anything but letters."""
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang", seed: int = 42,
) -> dict[str, bytes]:
    """Dictionary of each language, from a bounded sample of its labelled rows.

    The sample is spread over salts by a hash of the text, so that no task ranks all rows of a
    language; Spark limits each group before its shuffle. Texts longer than SAMPLE_CHARS are
    sampled by their first SAMPLE_CHARS characters. Rows without language or without a letter are
    not learned from. Equal texts count once. What comes to the driver is cut to about
    DICTIONARY_BYTES and one more text a language.
    """
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.substring(
        F.col(f"`{text}`"), 1, SAMPLE_CHARS).alias("text")).filter(
            F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = F.xxhash64(F.lit(seed), "text")
    salted = rows.withColumn("order", order).withColumn("salt", F.pmod("order", F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("order", "text"))
    sample = salted.withColumn("place", place).filter(F.col("place") <= ROWS_PER_SALT)
    # Signs and digits are one blank in the normal form, and each letter at least one byte of it.
    texts = sample.select("lang", "order", "text").distinct().withColumn(
        "text", F.regexp_replace("text", r"[\p{P}\p{Z}\p{Nd}\p{S}\p{Cc}]+", " "))
    before = F.sum(F.length(F.regexp_replace("text", r"\P{L}", ""))).over(
        Window.partitionBy("lang").orderBy("order", "text").rowsBetween(
            Window.unboundedPreceding, -1))
    needed = texts.withColumn("before", before).filter(
        F.coalesce("before", F.lit(0)) < DICTIONARY_BYTES).drop("before")
    held = stored(needed, "language-sample")
    if held.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    forms: dict[str, list[str]] = {}
    for row in sorted(held.collect()):
        forms.setdefault(row["lang"], []).append(normal_form(row["text"]))
    found = {}
    for name, own in forms.items():
        held, size = [], 0
        for one in (x.encode() for x in own):
            held.append(one)
            size += len(one)
            if size >= DICTIONARY_BYTES:
                break
        found[name] = b" ".join(held)[-DICTIONARY_BYTES:]
    return found


@functools.lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    made = []
    for name, raw in dictionaries:
        if len(raw) < 8:
            raw = raw.ljust(8)  # the library refuses shorter ones
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        made.append((name, zstandard.ZstdCompressor(
            dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)))
    return made


def classify(text: str | None, dictionaries: tuple) -> tuple[str, float, bool]:
    """Language, relative margin (0 to 1) and whether the answer is rejected."""
    form = normal_form(text or "")
    if not dictionaries or not any(map(str.isalpha, form)):
        return UNDETERMINED, 0.0, True
    form = form.encode()
    blocks = [b"%b %b %b" % (FILLER, form[i:i + BLOCK_BYTES], FILLER)
              for i in range(0, len(form), BLOCK_BYTES)]
    sizes = sorted(
        (sum(len(coder.compress(block)) for block in blocks), name)
        for name, coder in _compressors(dictionaries))
    if len(sizes) == 1:
        return sizes[0][1], 1.0, False
    margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
    return sizes[0][1], margin, margin < MIN_MARGIN


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``lang_rejected``. Map-only, over whole texts.

    ``score`` is the relative gap in bytes to the second language. A text that is null or has no
    letter is ``und`` and rejected; ties go to the name that sorts first and are rejected, but
    keep the name. Without any learned language all is ``und``. Columns of the three names are
    replaced, all others pass through.
    """
    added = ("lang_pred", "score", "lang_rejected")
    keep = [name for name in docs.columns if name not in added]
    rows = docs.select(*[f"`{name}`" for name in keep])
    held = tuple(sorted(dictionaries.items()))

    def run(batches):
        for batch in batches:
            found = [classify(value.as_py(), held) for value in batch.column(keep.index(text))]
            names, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=[*keep, *added])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        + ["lang_pred string", "score double", "lang_rejected boolean"])
    return rows.mapInArrow(run, schema)


def is_held_out(key):
    """Rows that nothing is learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
