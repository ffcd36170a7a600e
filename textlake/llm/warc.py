"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a footer in a skippable frame lists
the sizes of all frames, so any Zstandard tool reads the bundle from front to back and a reader
that knows the footer starts at any frame. An index maps each record identifier to its bundle, its
frame and its place inside the decompressed frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored
from textlake.session import scratch_path

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
#: Frames that a reading task is given.
TASK_FRAMES = 256
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = (
    "record_id string, bundle string, frame bigint, record_offset bigint, record_bytes bigint")
RECORD_SCHEMA = (
    "record_id string, page_id bigint, url string, record_type string, payload binary, "
    "payload_bytes bigint, payload_digest string, refers_to bigint")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(value: str) -> str:
    """A value on one line: controls and blanks are percent-encoded as UTF-8."""
    return "".join(
        "".join(f"%{b:02X}" for b in c.encode()) if c.isspace() or ord(c) < 32 or ord(c) == 127
        else c for c in value)


def record_bytes(
    record_id: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
) -> bytes:
    """One record: a response with its payload, or a revisit without it."""
    kind = "response" if refers_to is None else "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of a record; a response's digest and length are checked against its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    response = fields["WARC-Type"] == "response"
    payload = block.partition(b"\r\n\r\n")[2] if response else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and (base32_sha1(payload) != digest
                     or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    page_id = fields.get("X-Page-ID")
    return {
        "record_id": fields["WARC-Record-ID"].strip("<>"),
        "page_id": None if page_id is None else int(page_id),
        "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload": payload, "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "refers_to": None if refers is None else int(refers.strip("<>").rpartition(":")[2]),
    }


def shared_file(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a file in the shared folder, as Python workers reach it.

    Names that Spark has for a store are translated: s3a and s3n to s3, abfss to abfs, dbfs to its
    mounted folder. Stores that Python cannot open are an error that names the folder.
    """
    scheme, colon, rest = uri.partition(":")
    if scheme == "dbfs":
        uri = "file:///dbfs/" + rest.lstrip("/")
    elif colon:
        uri = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + ":" + rest
    try:
        return pyarrow.fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"bundles can't be kept in {uri}: give write_bundles a folder that "
                         f"Python workers can open ({error})") from error


class _Bundle:
    """One bundle being written: frames, then the footer that lists them."""

    def __init__(self, folder: str):
        self.key, self.records = uuid.uuid4().hex, 0
        self.name = f"{folder}/{self.key}.warc.zst"
        files, path = shared_file(self.name)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.written = 0

    def add_frame(self, data: bytes) -> None:
        frame = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(data)
        self.out.write(frame)
        self.sizes.append((len(frame), len(data)))
        self.written += len(frame)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)))
        self.out.write(table + footer)
        self.out.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """``(offset, bytes, decompressed bytes)`` of each frame, from the footer alone."""
    end = file.size()
    file.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOTER_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(end - 9 - 8 * count)
    sizes = struct.iter_unpack("<II", file.read(8 * count))
    frames, at = [], 0
    for packed, plain in sizes:
        frames.append((at, packed, plain))
        at += packed
    return frames


def _write(folder: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        bundle, frame, size, index = None, [], 0, []

        def flush() -> None:
            nonlocal frame, size
            bundle.add_frame(b"".join(frame))
            frame, size = [], 0

        def rows() -> pa.RecordBatch:
            names = ["record_id", "bundle", "frame", "record_offset", "record_bytes"]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*index)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                bundle = bundle or _Bundle(folder)
                record_id = row["record_id"]
                if row["repeated"]:  # set apart by where it is written
                    record_id += f":{bundle.key}:{bundle.records}"
                bundle.records += 1
                data = record_bytes(record_id, row["page_id"], row["url"],
                                    row["payload"] or b"", row["refers_to"])
                if frame and size + len(data) > FRAME_BYTES:
                    flush()
                index.append((record_id, bundle.name, len(bundle.sizes), size, len(data)))
                frame.append(data)
                size += len(data)
                if bundle.written >= BUNDLE_BYTES:
                    flush()
                    bundle.close()
                    yield rows()
                    bundle, index = None, []
        if bundle is not None:
            if frame:
                flush()
            bundle.close()
            yield rows()
    return run


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: refers_to is null for responses.

    Of the rows with equal payloads of at least ``min_bytes`` bytes, that with the largest page_id
    is the response. Rows that share payload and page_id are the same page and are all written
    alike; rows without page_id revisit, unless all of their group lack one. A null html is an
    empty payload; payloads of any length are hashed whole. An empty table gives an empty one, and
    columns other than page_id, url and html are not looked at.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    repeated = rows.filter(F.octet_length("payload") >= min_bytes).groupBy(
        F.col("same").alias("group")).agg(
            F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).filter(
                "n > 1 AND response_id IS NOT NULL").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    return rows.join(repeated, F.col("same") == F.col("group"), "left").select(
        "page_id", "url", "payload", refers.alias("refers_to"))


def write_bundles(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``page_id, url, payload, refers_to`` rows to bundles; returns the stored index.

    Each task writes bundles of its own under names that no other attempt uses, into a folder that
    all executors share. The index is made of what the successful attempts return, so bundles of
    lost or repeated tasks are never read. A task holds one frame at a time. A record larger than
    a frame has a frame to itself. An empty table gives an empty index and no bundle. Columns other
    than the four are left out.

    Record ids are unique. The response of a page that has one record is ``urn:page:<page_id>``;
    records of a page_id that occurs several times, or of none, add bundle and number. A revisit
    names its response by page, so where that page is repeated, by what their ids begin with.
    """
    folder = folder or scratch_path(records.sparkSession, "bundles")
    records = records.select("page_id", "url", "payload", "refers_to")
    kind = F.when(F.col("refers_to").isNull(), F.lit("urn:page:")).otherwise(F.lit("urn:revisit:"))
    named = records.withColumns({
        "record_id": F.concat(kind, F.coalesce(F.col("page_id").cast("string"), F.lit("none"))),
        "repeated": F.col("page_id").isNull()})
    twice = stored(records.filter("page_id IS NOT NULL").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select(
            F.col("page_id").alias("twice")), "repeated-pages")
    if not twice.isEmpty():
        named = named.join(twice, F.col("page_id") == F.col("twice"), "left").withColumn(
            "repeated", F.col("repeated") | F.col("twice").isNotNull())
    return stored(named.select(
        "record_id", "page_id", "url", "payload", "refers_to", "repeated").mapInArrow(
            _write(folder), INDEX_SCHEMA), "warc-index")


def _read(batches) -> Iterator[pa.RecordBatch]:
    opened, files, table = None, None, []
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(),
             pa.string(), pa.int64()]
    for batch in batches:
        for row in batch.to_pylist():
            if row["bundle"] != opened:
                if files is not None:
                    files.close()
                system, path = shared_file(row["bundle"])
                files, opened = system.open_input_file(path), row["bundle"]
                table = seek_table(files)
            offset, packed, plain = table[row["frame"]]
            files.seek(offset)
            data = zstandard.ZstdDecompressor().decompress(
                files.read(packed), max_output_size=plain)
            found = [parse_record(data[r["at"]:r["at"] + r["n"]]) for r in row["records"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[name] for f in found], kind) for name, kind in zip(names, kinds)],
                names=names)
    if files is not None:
        files.close()


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` names (all of an index, or the rows wanted).

    Each frame that holds a wanted record is read once, by seeking; records are cut out at their
    offsets. A revisit has a null payload and the length and digest of the full one. The tasks are
    as many as the frames ask for: the rows of an index are far smaller than what they name.
    """
    frames = index.groupBy("bundle", "frame").agg(F.collect_list(
        F.struct(F.col("record_offset").alias("at"), F.col("record_bytes").alias("n")),
    ).alias("records"))
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-index.select("bundle", "frame").distinct().count() // TASK_FRAMES))
    return frames.repartition(tasks, "bundle", "frame").sortWithinPartitions(
        "bundle", "frame").mapInArrow(_read, RECORD_SCHEMA)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT html, max(page_id) AS last FROM p GROUP BY html),
five AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::INT) AS v
         FROM p)
SELECT f.page_id, octet_length(encode(f.html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((v[(i // 4) + 1] >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN f.page_id = g.last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.page_id <> g.last THEN g.last END AS refers_to
FROM five f JOIN g ON g.html = f.html
"""
