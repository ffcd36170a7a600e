"""Repair of misread text against Python's codecs."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.functions import unicode as U


def latin(text):
    return text.encode().decode("latin-1")


def page(text):
    return "".join(
        bytes([b]).decode("cp1252") if bytes([b]) and b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
        else chr(b) for b in text.encode())


def applied(spark, function, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = df.select("i", function(F.col("t")).alias("t")).collect()
    return [row["t"] for row in sorted(rows)]


SOUND = [
    "plain", "", "été ’ “quoted” – dash… €5", "Việt Nam", "naïve façade À É Î Ð Ñ Å", "CAFÉ» «ÎLE»",
    "日本語のテキスト", "Привет мир", "Ελληνικά", "emoji 😀🎉", "ÄÖÜ äöü ß", "łódź", "20°C ±5 µm ©2020",
    "tab\tline\nend\r\n", " nbsp", "NIÑO® OTOÑO»", "10 Å·m",
]


@pytest.mark.parametrize("wrong", [latin, page, lambda t: page(page(t)), lambda t: page(latin(t)),
                                   lambda t: latin(latin(latin(t)))])
def test_misread_text_is_repaired(spark, wrong):
    assert applied(spark, U.repair_encoding, [wrong(t) for t in SOUND]) == SOUND


def test_sound_text_is_left_alone(spark):
    random.seed(2)
    # letters of the code page are left out: behind some capitals they do look like damage
    letters = [chr(c) for c in (*range(0x20, 0x7F), *range(0xC0, 0x180))
               if c not in (0xD7, 0xF7) and chr(c) not in U.SIGNS]
    words = ["".join(random.choices(letters, k=random.randint(0, 12))) for _ in range(500)]
    texts = [*SOUND, *words, None]
    assert applied(spark, U.repair_encoding, texts) == texts


def test_parts_of_a_text_are_repaired(spark):
    texts = ["日本 " + page("été") + " sound été", page("’") + "x" + latin("é") + "Ã", "Ã© Â"]
    assert applied(spark, U.repair_encoding, texts) == ["日本 été sound été", "’xéÃ", "é Â"]
    long = page("Привет ’é") * 3000
    assert applied(spark, U.repair_encoding, [long]) == ["Привет ’é" * 3000]


def test_invalid_bytes_stay(spark):
    texts = ["Ã\u0080Ã\u0080x", "à\u0080\u0080", "í \u0080", "ô¿¿¿", "Â"]
    assert applied(spark, U.repair_encoding, texts)[1:] == texts[1:]


def test_folding(spark):
    texts = ["Ã©tÃ© â€™", "Việt", "café", "Cận", "й", "Łódź æther", None]
    assert applied(spark, T.fold_ascii, texts) == [
        "ete ’", "Viet", "cafe", "Can", "й", "Lodz aether", None]


def test_every_letter_with_one_ascii_base_is_folded(spark):
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    for letter, folded in zip(letters, applied(spark, U.fold_letters, letters)):
        plain = [c for c in unicodedata.normalize("NFKD", letter) if ord(c) < 128]
        if len(plain) == 1:
            assert folded == plain[0], letter
