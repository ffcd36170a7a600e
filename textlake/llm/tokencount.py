"""Token counts of a SentencePiece BPE model by rank-synchronous merging of arrays.

Texts are normalised by the library and cut into pre-tokens where no piece of the vocabulary can
span the cut. The distinct pre-tokens of a batch lie one after the other in arrays of symbols. In
every round each sequence applies its pair of lowest rank, all sequences at the same time, until
no pair is left; what counts are the symbols that survive.

Applying a pair wherever it stands in a sequence equals the one-by-one order unless a piece that
begins or ends with the merged one has a rank as low. Such pairs are applied at their leftmost
place only, and a long sequence that needs this often is finished with a heap.
"""

from __future__ import annotations

import functools
import heapq
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More tokens than this are over the limit.
LIMIT = 4096
#: A model file above this size is refused, since its bytes are sent to every executor.
MAX_MODEL_BYTES = 64 << 20
#: Symbols merged at the same time, and pre-tokens whose counts a worker remembers.
ROUND_SYMBOLS, CACHED = 1 << 21, 1 << 20
#: Longer pre-tokens are not remembered; longer sequences with unsafe pairs go to the heap.
CACHED_CHARS, LEFTMOST_SYMBOLS = 64, 128

# Fixed value: the sign that stands for a blank in normalised texts.
BLANK = "▁"
_NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Merges:
    """A vocabulary as sorted arrays: pairs of symbols with rank and result, and characters."""

    library: sentencepiece.SentencePieceProcessor
    words: re.Pattern
    pairs: np.ndarray       # left * n + right, ascending
    ranks: np.ndarray       # of each pair; 0 is applied first
    results: np.ndarray
    unsafe: np.ndarray      # of each rank
    characters: np.ndarray  # code points that are pieces, ascending
    char_ids: np.ndarray
    joined: np.ndarray      # neighbouring code points inside some piece, first << 21 | second
    n: int

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of neighbouring symbols, or a number beyond all, and the place in the table."""
        keys = left.astype(np.int64) * self.n + right
        at = np.searchsorted(self.pairs, keys).clip(max=len(self.pairs) - 1)
        known = (self.pairs[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], _NONE), at


def load_model(path: str) -> bytes:
    """The bytes of a model file, on the driver."""
    if os.path.getsize(path) > MAX_MODEL_BYTES:
        raise ValueError(f"model file above {MAX_MODEL_BYTES} bytes: {path}")
    with open(path, "rb") as file:
        return file.read()


@functools.lru_cache(maxsize=2)
def merges(model: bytes) -> Merges:
    """The tables of a model, made once per worker."""
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = library.get_piece_size()
    if any(library.is_unused(i) for i in range(size)):
        raise ValueError("models with unused pieces are not supported")
    ids = {
        library.id_to_piece(i): i for i in range(size)
        if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
    scores = sorted({library.get_score(i) for i in ids.values()}, reverse=True)
    by_score = {score: rank for rank, score in enumerate(scores)}
    rank = {piece: by_score[library.get_score(i)] for piece, i in ids.items()}
    unsafe = np.zeros(len(scores), bool)
    pairs, joined = {}, set()
    for piece, own in ids.items():
        joined.update(ord(a) << 21 | ord(b) for a, b in zip(piece, piece[1:]))
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            for part in (left, right):
                if part in ids and rank[part] >= rank[piece]:
                    unsafe[rank[part]] = True
            if left in ids and right in ids:
                pairs[ids[left] * size + ids[right]] = (rank[piece], own)
    held = np.array(sorted(pairs), np.int64)
    values = np.array([pairs[key] for key in held.tolist()], np.int32).reshape(-1, 2)
    single = sorted((ord(piece), own) for piece, own in ids.items() if len(piece) == 1)
    inside = any(BLANK in piece.lstrip(BLANK) for piece in ids)
    words = rf"(?s).+" if inside else rf"{BLANK}*[^{BLANK}]+|{BLANK}+"
    return Merges(
        library, re.compile(words), held, values[:, 0].copy(), values[:, 1].copy(), unsafe,
        np.array([c for c, _ in single], np.int64), np.array([i for _, i in single], np.int64),
        np.array(sorted(joined), np.int64), size)


def _finish_one(symbols: list[int], table: Merges) -> list[int]:
    """The symbols left of one sequence, pair by pair from a heap: lowest rank, then leftmost."""
    after = list(range(1, len(symbols))) + [-1]
    before = list(range(-1, len(symbols) - 1))
    heap: list[tuple] = []

    def offer(lefts: list[int]) -> None:
        a = np.array([symbols[i] for i in lefts], np.int64)
        b = np.array([symbols[after[i]] for i in lefts], np.int64)
        ranks, at = table.rank_of(a, b)
        for i, rank, place in zip(lefts, ranks.tolist(), at.tolist()):
            if rank != _NONE:
                heapq.heappush(heap, (rank, i, after[i], symbols[i], symbols[after[i]], place))

    offer(list(range(len(symbols) - 1)))
    gone = -2
    while heap:
        _, left, right, a, b, place = heapq.heappop(heap)
        if symbols[left] != a or after[left] != right or symbols[right] != b:
            continue
        symbols[left], symbols[right] = int(table.results[place]), gone
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
        offer([i for i in (before[left], left) if i >= 0 and after[i] >= 0])
    return [symbol for symbol in symbols if symbol != gone]


def _merge(symbols: np.ndarray, owner: np.ndarray, table: Merges, add) -> None:
    """Merge sequences (runs of equal ``owner``); ``add(owner, symbols)`` takes what survives."""
    while len(symbols):
        ends = np.append(owner[1:] != owner[:-1], True)
        starts = np.flatnonzero(np.append(True, ends[:-1]))
        ranks, at = table.rank_of(symbols, np.append(symbols[1:], -1))
        ranks[ends] = _NONE
        lowest = np.minimum.reduceat(ranks, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        least = np.repeat(lowest, lengths)
        marked = (ranks == least) & (ranks != _NONE)
        # pairs that overlap: every other one, from the left
        index = np.arange(len(symbols))
        first = marked & ~np.append(False, marked[:-1])
        run = np.maximum.accumulate(np.where(first, index, 0))
        marked &= (index - run) % 2 == 0

        several = np.add.reduceat(marked, starts) > 1
        careful = several & table.unsafe[np.where(lowest == _NONE, 0, lowest)] & (lowest != _NONE)
        slow = careful & (lengths > LEFTMOST_SYMBOLS)
        for number in np.flatnonzero(slow):
            own = slice(starts[number], starts[number] + lengths[number])
            left = np.array(_finish_one(symbols[own].tolist(), table), np.int64)
            add(np.full(len(left), owner[starts[number]]), left)
        if careful.any():
            place = np.where(marked, index, len(symbols))
            leftmost = np.repeat(np.minimum.reduceat(place, starts), lengths)
            marked &= ~np.repeat(careful, lengths) | (index == leftmost)

        done = np.repeat(lowest == _NONE, lengths)
        add(owner[done], symbols[done])
        merged = np.where(marked, table.results[at], symbols)
        keep = ~(done | np.repeat(slow, lengths) | np.append(False, marked[:-1]))
        symbols, owner = merged[keep], owner[keep]


def count_words(words: list[str], table: Merges) -> np.ndarray:
    """Tokens of each pre-token, all of them at the same time."""
    counts = np.zeros(len(words), np.int64)
    lengths = np.array([len(word) for word in words], np.int64)
    if not lengths.sum():
        return counts
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.searchsorted(table.characters, points).clip(max=len(table.characters) - 1)
    known = table.characters[at] == points
    symbols = np.where(known, table.char_ids[at], -1)
    # characters that are no piece become their bytes
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    np.add.at(counts, word[~known], width[~known])
    inside = np.searchsorted(table.joined, (points[:-1] << 21) | points[1:]).clip(
        max=len(table.joined) - 1)
    meet = table.joined[inside] == (points[:-1] << 21) | points[1:]
    meet &= (word[1:] == word[:-1]) & known[1:] & known[:-1]
    sequence = np.cumsum(np.append(0, ~meet))
    word_of = np.zeros(sequence[-1] + 1, np.int64)
    word_of[sequence] = word

    def add(owner: np.ndarray, left: np.ndarray) -> None:
        np.add.at(counts, word_of[owner], 1)

    _merge(symbols[known], sequence[known], table, add)
    return counts


def _groups(words: Iterable[str]) -> Iterator[list[str]]:
    """Pre-tokens in groups of a bounded number of symbols, long ones together."""
    group, size = [], 0
    for word in sorted(words, key=len):
        if group and size + len(word) > ROUND_SYMBOLS:
            yield group
            group, size = [], 0
        group.append(word)
        size += len(word)
    if group:
        yield group


def count_texts(texts: list[str | None], table: Merges, cache: dict[str, int]) -> list[int]:
    """Tokens of each whole text; the counts of short pre-tokens are kept in ``cache``."""
    cut = [table.words.findall(table.library.normalize(text)) if text else [] for text in texts]
    fresh = {word for words in cut for word in words if word not in cache}
    long = {}
    for group in _groups(fresh):
        for word, n in zip(group, count_words(group, table).tolist()):
            (cache if len(word) <= CACHED_CHARS else long)[word] = n
    counts = [sum(cache[word] if word in cache else long[word] for word in words) for words in cut]
    if len(cache) > CACHED:
        cache.clear()
    return counts


def token_counts(
    docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of each whole text, as the library counts them.

    Map-only, one row out for each row in, so ties, repeated rows and null keys stay as they are
    and an empty table gives an empty one. A null text counts like the empty one: no bytes, no
    tokens. Texts of any length are counted whole; a run of characters that the vocabulary cannot
    cut takes some 100 bytes of memory a character. Other columns, of whatever names, are not
    read. No begin, end or special tokens are added, and their strings are ordinary text.
    """
    model = load_model(model_file)
    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
        F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"))

    def run(batches):
        table, cache = merges(model), {}
        for batch in batches:
            counts = count_texts(batch.column("text").to_pylist(), table, cache)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["key", "n_bytes", "n_tokens"])

    kind = source.schema["key"].dataType.simpleString()
    counted = source.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
