"""Sets of hashed word shingles, computed for many texts at once.

A word is a run of anything but ASCII blanks, with A-Z lowered. Five consecutive words are a
shingle; a text of fewer words has one, the whole sequence. Shingles are 64-bit hashes of all
their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
#: Bytes of text that are hashed at once.
CHUNK_BYTES = 2 << 20
#: Longer words are hashed one by one.
LONG_WORD = 256

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_TAIL = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each word, eight bytes at a time. ``data`` has eight spare bytes at its end."""
    eight = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
    hashes = mix(sizes.astype(np.uint64) + _PRIME)
    active = np.flatnonzero(sizes <= LONG_WORD)
    at = 0
    while len(active):
        left = sizes[active] - at
        block = eight[starts[active] + at] & _TAIL[np.minimum(left, 8)]
        hashes[active] = mix((hashes[active] ^ block) * _PRIME)
        at += 8
        active = active[left > 8]
    for word in np.flatnonzero(sizes > LONG_WORD):
        raw = data[starts[word]:starts[word] + sizes[word]].tobytes()
        hashes[word] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return hashes


def _chunk_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a chunk."""
    size = len(data)
    padded = np.full(size + 8, 32, np.uint8)
    padded[:size] = data + (((data - np.uint8(65)) < 26).astype(np.uint8) << 5)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    start, end = ~blank, ~blank
    start[1:] &= blank[:-1] | edge[1:-1]
    end[:-1] &= blank[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    hashes = _word_hashes(padded, starts, np.flatnonzero(end) + 1 - starts)
    first = np.searchsorted(starts, offsets)
    rolled = hashes[:max(0, len(hashes) - SHINGLE_WORDS + 1)].copy()
    for step in range(1, SHINGLE_WORDS):
        rolled = rolled * _PRIME + hashes[step:step + len(rolled)]
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE_WORDS:
            own = np.sort(rolled[a:b - SHINGLE_WORDS + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            whole = np.uint64(b - a)
            for word in hashes[a:b]:
                whole = _fold(whole, word)
            yield np.array([whole] * (b > a), np.uint64)


def _fold(state: np.uint64, word: np.uint64) -> np.uint64:
    return mix(np.array([state ^ _PRIME], np.uint64) * _PRIME + word)[0]


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The set of each text, in order; empty for null and for texts without words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        own = offsets[start:stop + 1]
        yield from _chunk_sets(data[own[0]:own[-1]], own - own[0])
        start = stop
