"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut before they reach the library, at places where the pre-splitting pattern can
never match across: the pieces encode to the same ids as the whole text. This bounds the depth of
the library's regular expression engine and the size of what it works on at once.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

#: Texts up to this length go to the library whole.
PIECE_CHARS = 20_000
#: A rank file above this size is refused, since its bytes are sent to every executor.
MAX_RANK_BYTES = 64 << 20

# No match of the pattern spans these places: between a non-blank and a blank; between a letter
# and what is no letter, and a number and what is no number, in that order. A blank may only join
# what follows it, and an apostrophe what follows it, so both start a piece.
_SAFE = regex.compile(
    r"(?<=[\p{L}\p{N}\p{P}])(?=[ \t\n\r])|(?<=\p{L})(?=[\p{N}\p{P}])|(?<=\p{N})(?=[\p{L}\p{P}])")


def load_ranks(path: str) -> bytes:
    """The bytes of a rank file, on the driver."""
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"rank file above {MAX_RANK_BYTES} bytes: {path}")
    with open(path, "rb") as file:
        return file.read()


@functools.lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file, made once per worker."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        hashlib.sha256(ranks).hexdigest(), pat_str=pattern, special_tokens={},
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs})


@functools.lru_cache(maxsize=4)
def _whole(pattern: str):
    """The pattern for ``regex``, whose own idea of a blank is wider than the library's."""
    return regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe places, each piece about ``limit`` long; joined they are the text.

    Where a run has no safe place (one very long word, or blanks only), the piece gets longer.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(coder: tiktoken.Encoding, text: str, limit: int = PIECE_CHARS) -> list[int]:
    """Ids of a text, each match of the pattern on its own, no special tokens.

    A piece still far above the limit is one long run; it is split by the pattern here, so the
    library only merges bytes and its own matcher never sees it.
    """
    if len(text) <= limit:
        return coder.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text, limit):
        if len(piece) <= 4 * limit:
            ids.extend(coder.encode_ordinary(piece))
        else:
            for match in _whole(coder._pat_str).finditer(piece):
                ids.extend(coder._core_bpe.encode_single_piece(match.group().encode()))
    return ids


def _batches(ranks: bytes, pattern: str, source: str, named: pa.Schema, digests: bool):
    def run(batches):
        coder = encoding(ranks, pattern)
        names = [str(i) for i in range(coder.max_token_value + 1)]
        for batch in batches:
            if not batch.num_rows:
                continue
            out = {"ids": [], "n": [], "ids_sha": [], "bytes_sha": []}
            for value in batch.column(source):
                text = value.as_py() or ""
                ids = encode(coder, text)
                out["n"].append(len(ids))
                if digests:
                    joined = ",".join(map(names.__getitem__, ids))
                    out["ids_sha"].append(hashlib.sha256(joined.encode()).hexdigest())
                    out["bytes_sha"].append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
                else:
                    out["ids"].append(ids)
            own = [name for name in batch.schema.names if name != source] if digests else (
                batch.schema.names)
            columns = [batch.column(name) for name in own]
            columns += [pa.array(out["n"], pa.int64())] + (
                [pa.array(out["ids_sha"]), pa.array(out["bytes_sha"])] if digests
                else [pa.array(out["ids"], pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_arrays(columns, names=named)
    return run


def encode_table(
    docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids",
) -> DataFrame:
    """Add ``n_tokens`` and the ids of each whole text.

    Map-only. A null text is encoded as the empty one: no ids. Columns of the same names are
    replaced; all others pass through.
    """
    keep = [name for name in docs.columns if name not in ("n_tokens", ids)]
    rows = docs.select(*[f"`{name}`" for name in keep])
    names = keep + ["n_tokens", ids]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        + ["n_tokens bigint", f"`{ids}` array<int>"])
    return rows.mapInArrow(_batches(load_ranks(rank_file), pattern, text, names, False), schema)


def encode_digests(
    docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of each text, encoded and decoded again.

    One row per row of ``docs``, null and repeated keys and equal rows included. A null text is an
    empty one: no tokens, both digests those of nothing. Long texts are encoded whole, piece by
    piece. An empty table gives an empty one. Columns other than key and text are not looked at, so
    their names cannot clash.
    """
    rows = docs.select(f"`{key}`", f"`{text}`")
    kind = dict(rows.dtypes)[key]
    return rows.mapInArrow(
        _batches(load_ranks(rank_file), pattern, text,
                 [key, "n_tokens", "ids_sha256", "decoded_sha256"], True),
        f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_table(
    tokens: DataFrame, rank_file: str, pattern: str, ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """Add the raw bytes that the ids stand for; null ids give null.

    Bytes, not a string: a list of ids need not end at a character.
    """
    keep = [name for name in tokens.columns if name != decoded]
    rows = tokens.select(*[f"`{name}`" for name in keep])
    ranks = load_ranks(rank_file)

    def run(batches):
        coder = encoding(ranks, pattern)
        for batch in batches:
            values = [
                None if v is None else coder.decode_bytes(v)
                for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.binary())], names=[*keep, decoded])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        + [f"`{decoded}` binary"])
    return rows.mapInArrow(run, schema)
