import zstandard
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from textlake.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    held_out = langid.is_held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.learn(docs.filter(~held_out))).filter(held_out)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.99
    rejected = found.agg(F.avg(F.col("lang_rejected").cast("double"))).first()[0]
    assert rejected <= 0.01


def test_odd_rows(odd_documents, no_documents):
    learned = langid.learn(odd_documents)
    assert set(learned) == {"en", "de"}
    assert learned == langid.learn(odd_documents.repartition(5))
    rows = langid.identify(odd_documents, learned).collect()
    assert len(rows) == 10
    for row in rows:
        assert 0 <= row["score"] <= 1
        if row["doc_id"] in (2, 3, 8):
            assert row["lang_pred"] == "und" and row["lang_rejected"]
        else:
            assert row["lang_pred"] in ("en", "de")
    assert langid.learn(no_documents) == {}
    assert langid.identify(no_documents, {}).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd_documents, {}).collect()} == {"und"}


def _plain_answer(text, dictionaries):
    """Language by sizes counted one block and one fresh compressor at a time."""
    form = "".join(c if c.isalnum() and not c.isdecimal() else " " for c in text.lower())
    form = " ".join(form.split()).encode()
    sizes = {}
    for name, raw in dictionaries.items():
        sizes[name] = 0
        for at in range(0, len(form), 2048):
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            block = b"01234567890123456789 " + form[at:at + 2048] + b" 01234567890123456789"
            sizes[name] += len(zstandard.ZstdCompressor(
                level=6, dict_data=known, write_content_size=False, write_checksum=False,
                write_dict_id=False).compress(block))
    best, second = sorted((n, name) for name, n in sizes.items())[:2]
    return best[1], (second[0] - best[0]) / second[0]


def test_answers_equal_plain_counts(small):
    learned = langid.learn(small)
    rows = small.filter("length(text) < 5000").collect()
    assert len(rows) > 100
    for row in rows:
        name, margin, _ = langid.classify(row["text"], tuple(sorted(learned.items())))
        if name != langid.UNDETERMINED:
            best, gap = _plain_answer(row["text"], learned)
            assert abs(gap - margin) < 0.02 and (name == best or gap < 0.005), row["doc_id"]


def test_sample_is_cut_to_the_dictionary(spark, small):
    learned = langid.learn(small)
    plain = {}
    rows = small.filter(r"lang IS NOT NULL AND text RLIKE '\\p{L}'").select("lang", F.substring(
        "text", 1, langid.SAMPLE_CHARS).alias("text")).withColumn(
            "order", F.xxhash64(F.lit(42), "text")).distinct().collect()
    for row in sorted(rows, key=lambda r: (r["lang"], r["order"])):
        plain.setdefault((row["lang"], row["order"] % langid.SALTS), []).append(row)
    for name, raw in learned.items():
        looked = sorted((r["order"], r["text"]) for (lang, _), own in plain.items() if lang == name
                        for r in own[:langid.ROWS_PER_SALT])
        taken = []
        for _, text in looked:
            taken.append(langid.normal_form(text).encode())
            if sum(map(len, taken)) >= langid.DICTIONARY_BYTES:
                break
        assert raw == b" ".join(taken)[-langid.DICTIONARY_BYTES:]
