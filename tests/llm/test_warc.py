import base64
import hashlib
import io

import pyarrow.fs
import pytest
import zstandard

from textlake.llm import warc

SCHEMA = "page_id long, url string, html string, record_id long"


def test_round_trip(spark):
    big = "".join(chr(97 + i * i % 26) for i in range(3_000_000))
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>", 0), (2, None, "<p>é</p>", 0), (3, "u", None, 0),
            (4, "u", "", 0), (5, "u", big, 0), (None, "n", "<p>é</p>", 0), (7, "u", "alone", 0),
            (7, "u", "alone", 0), (8, "u", "\r\n\r\nWARC/1.1\r\n", 0)]
    pages = spark.createDataFrame(rows, SCHEMA)
    index = warc.write_bundles(warc.mark_revisits(pages))
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    found = {(r["page_id"], r["url"]): r for r in got}
    for page_id, url, html, _ in rows:
        row = found[page_id, None if url is None else warc._header_value(url)]
        payload = (html or "").encode()
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = {1: 2, None: 2, 3: 4}.get(page_id)
        assert row["refers_to"] == refers
        assert row["record_type"] == ("response" if refers is None else "revisit")
        assert row["payload"] == (payload if refers is None else None)


def test_bundles_are_plain_zstandard_too(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "word " * (i * 40), 0) for i in range(200)]
    records = warc.mark_revisits(spark.createDataFrame(rows, SCHEMA)).coalesce(1)
    index = warc.write_bundles(records, f"file://{tmp_path}/bundles")
    for bundle in {r["bundle"] for r in index.collect()}:
        system, path = pyarrow.fs.FileSystem.from_uri(bundle)
        raw = system.open_input_file(path).read()
        whole = zstandard.ZstdDecompressor().stream_reader(
            io.BytesIO(raw), read_across_frames=True).read()
        own = [r for r in index.collect() if r["bundle"] == bundle]
        frames = warc.seek_table(system.open_input_file(path))
        assert len(whole) == sum(plain for _, _, plain in frames) == sum(
            r["record_bytes"] for r in own)
        assert max(r["frame"] for r in own) == len(frames) - 1 > 0
    one = warc.read_records(index.filter("record_id = 'urn:page:77'")).collect()
    assert [bytes(r["payload"]).decode() for r in one] == ["word " * 77 * 40]


def test_empty(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.read_records(warc.write_bundles(warc.mark_revisits(pages))).count() == 0


def test_record_ids_are_unique(spark):
    rows = [(7, "u", "alone", 0)] * 3 + [(7, "u", "other", 0), (None, "u", "alone", 0),
            (None, "u", "alone", 0), (None, None, None, 0), (8, "u", "one", 0), (9, "u", "one", 0),
            (6, "v", "alone", 0)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = warc.write_bundles(warc.mark_revisits(pages))
    ids = [r["record_id"] for r in index.collect()]
    assert len(set(ids)) == len(ids) == len(rows)
    assert "urn:page:9" in ids and "urn:revisit:8" in ids and "urn:revisit:6" in ids
    assert sum(one.startswith("urn:page:7:") for one in ids) == 4
    got = {r["record_id"]: r for r in warc.read_records(index).collect()}
    assert set(got) == set(ids)
    assert got["urn:revisit:6"]["refers_to"] == 7
    one = next(i for i in ids if i.startswith("urn:page:7:"))
    assert warc.read_records(index.filter(index["record_id"] == one)).count() == 1


def test_names_of_stores(tmp_path):
    assert warc.shared_file(f"file://{tmp_path}/a")[1] == f"{tmp_path}/a"
    assert warc.shared_file("dbfs:/tmp/a")[1] == "/dbfs/tmp/a"
    with pytest.raises(ValueError, match="viewfs"):
        warc.shared_file("viewfs://x/a")
