"""N-gram Jaccard join by universe partition.

Sets of word shingles link when their Jaccard similarity is at least PERCENT / 100. Two linked
sets x and y differ in at most H = floor((|x| + |y|) * (100 - PERCENT) / (100 + PERCENT)) members.

*Segments.* For each band of set sizes the universe of shingles is hashed into segments. A plain
segment matches if both sets have the same members in it; a deletion segment matches also if one
has one member more: both sets publish their subset and its one-deletion neighbours. If the
segments that both publish are worth more than H together (plain 1, deletion 2), one of them must
match, because a difference of H can't spoil them all.

*Allocation.* How many segments of either sort a band has is chosen by the cost of what is
published and of the subsets that would be empty or too common. A band has some more segments than
its pairs need, and each set leaves out as many of its plain subsets as it may, those first that
most other sets have too: empty ones, then those made of frequent shingles, then small ones.

*Verification.* Sets with a common signature are candidates. In each group of equal signatures
the most popular set is compared with all others (a star, not all pairs); what that leaves in
different components is then compared across them, behind an exact lower bound of the difference.
Every comparison is of the sets themselves.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored
from textlake.llm.graph import connected_components
from textlake.llm.shingles import mix, shingle_sets

PERCENT = 80
#: Sizes l to BAND * l - 1 form a band.
BAND = 2
#: A shingle that more than this share of the texts of a chunk have is reported as frequent; of
#: the frequent ones at most this many, the most frequent, steer which subsets are left out.
FREQUENT_SHARE, FREQUENT_CHUNK, MAX_FREQUENT = 0.002, 2048, 1 << 16
#: Signatures are made for sets of about this many members at once.
BATCH_MEMBERS = 1 << 18
#: Rows whose cells are compared together, pairs laid out at once, and numbers of sketches compared
#: at once.
CROSS_ROWS, PAIR_ROWS, COMPARE_CELLS = 1 << 14, 1 << 17, 1 << 21
#: Rows of a star are held against its strays in cells of this many of either.
CELL_ROWS = 4096
#: What a subset that many sets have is taken to cost, in signatures.
COMMON_COST = 200.0


def most_apart(sizes: int, percent: int = PERCENT) -> int:
    """Largest difference of two linked sets whose sizes add up to ``sizes``."""
    return sizes * (100 - percent) // (100 + percent)


def largest_partner(size: int, percent: int = PERCENT) -> int:
    return size * 100 // percent


class Scheme:
    """The segments of the pairs whose smaller set has a size from ``low`` to ``high``."""

    def __init__(self, low: int, percent: int):
        self.low, self.high, self.percent = low, BAND * low - 1, percent
        self.apart = most_apart(self.high + largest_partner(self.high, percent), percent)
        self.plain, self.deletion = min(self._plans(), key=lambda plan: self._cost(*plan))
        self.worth = self.plain + 2 * self.deletion
        # a deletion segment gets three times the universe of a plain one
        self.parts = self.plain + 3 * self.deletion

    def _plans(self) -> Iterator[tuple[int, int]]:
        for spare in (0.0, 0.06, 0.12, 0.2, 0.3):
            worth = self.apart + 1 + math.ceil(spare * self.apart)
            for deletion in {0, 1, 2, 3, 4, 6, 8, (worth + 1) // 2}:
                if 2 * deletion <= worth + 1:
                    yield max(0, worth - 2 * deletion), deletion

    def _cost(self, plain: int, deletion: int) -> float:
        """Signatures and common subsets that a set in the middle of the band publishes."""
        size = (self.low + self.high) / 2
        share = size / (plain + 3 * deletion)
        own = most_apart(int(size) + largest_partner(int(size), self.percent), self.percent)
        skipped = min(plain, max(0, (plain + 2 * deletion - 1 - own) // 2))
        empty = max(0.0, plain * math.exp(-share) - skipped)
        bare = deletion * math.exp(-3 * share) * (1 + 3 * share)
        return plain - skipped + deletion * (1 + 3 * share) + COMMON_COST * (empty + bare)

    def skips(self, size: int) -> int:
        """How many plain subsets a set may leave out.

        Two sets leave out floor((worth - 1 - H) / 2) at most, with H at least that of the pair;
        so more than the pair's own H is left.
        """
        if size <= self.high:
            partner = largest_partner(size, self.percent)
        else:
            partner = self.high
        apart = most_apart(size + partner, self.percent)
        return min(self.plain, max(0, (self.worth - 1 - apart) // 2))


@functools.lru_cache(maxsize=256)
def scheme(band: int, percent: int = PERCENT) -> Scheme:
    return Scheme(BAND ** band, percent)


def bands_of(size: int, percent: int = PERCENT) -> list[int]:
    """Bands in which a set takes part: its own, and the one below if a partner may be there."""
    own = size.bit_length() - 1 if BAND == 2 else int(math.log(size, BAND) + 1e-9)
    below = scheme(own - 1, percent).high if own else 0
    return [own] + [own - 1] * (own > 0 and below * 100 >= size * percent)


def _band_signatures(
    band: int, sets: list[np.ndarray], docs: np.ndarray, frequent, percent: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets in one band, and the document of each."""
    plan = scheme(band, percent)
    n, rows = plan.plain + plan.deletion, len(sets)
    sizes = np.array([len(s) for s in sets])
    members = np.concatenate(sets)
    row = np.repeat(np.arange(rows), sizes)
    spread = mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    tokens = mix(members + np.uint64(0x5851F42D4C957F2D))
    part = (((spread >> np.uint64(32)) * np.uint64(plan.parts)) >> np.uint64(32)).astype(np.int64)
    # plain segments first; three parts make one deletion segment
    segment = np.where(part < plan.plain, part, plan.plain + (part - plan.plain) // 3)
    cell = row * n + segment
    order = np.argsort(cell, kind="stable")
    filled = np.bincount(cell, minlength=rows * n)
    ends = np.cumsum(filled)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64((band + 1) << 40))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens[order])])
    subset = sums[ends] - sums[ends - filled]
    whole = mix(subset.reshape(rows, n) ^ salt)
    keep = np.ones((rows, n), bool)
    skips = np.array([plan.skips(size) for size in sizes.tolist()])
    if plan.plain and skips.any():
        common, counts = frequent
        rarest = np.zeros(rows * n, np.int64)
        if len(common):
            at = np.searchsorted(common, members).clip(0, len(common) - 1)
            weight = np.where(common[at] == members, counts[at], 0)[order]
            some = filled > 0
            rarest[some] = np.minimum.reduceat(weight, (ends - filled)[some])
        rarest[filled == 0] = 1 << 40
        # costliest first: the rarest shingle of a subset decides, then its size
        cost = ((rarest << 20) + (1 << 20) - np.minimum(filled, 1 << 20)).reshape(rows, n)
        costly = np.argsort(-cost[:, :plan.plain], axis=1, kind="stable")
        left_out = np.arange(plan.plain) < skips[:, None]
        at_row, at_place = np.nonzero(left_out)
        keep[at_row, costly[at_row, at_place]] = False
    found = [whole[keep]]
    owner = [np.broadcast_to(docs[:, None], (rows, n))[keep]]
    if plan.deletion:
        inside = np.flatnonzero(segment >= plan.plain)
        less = subset[cell[inside]] - tokens[inside]
        found.append(mix(less ^ salt[segment[inside]]))
        owner.append(docs[row[inside]])
    return np.concatenate(found), np.concatenate(owner)


def signatures_of(
    sets: list[np.ndarray], docs: np.ndarray, frequent: tuple[np.ndarray, np.ndarray],
    percent: int = PERCENT,
) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of non-empty sets (sorted distinct hashes), and the document of each."""
    by_band: dict[int, list[int]] = {}
    for place, members in enumerate(sets):
        for band in bands_of(len(members), percent):
            by_band.setdefault(band, []).append(place)
    made = [
        _band_signatures(band, [sets[i] for i in places], docs[places], frequent, percent)
        for band, places in by_band.items()]
    if not made:
        return np.zeros(0, np.uint64), docs[:0]
    sigs, owners = zip(*made)
    return np.concatenate(sigs), np.concatenate(owners)


def signatures(
    members: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int = PERCENT,
) -> np.ndarray:
    """All signatures of one set."""
    return np.unique(signatures_of([members], np.zeros(1, np.int64), frequent, percent)[0])


def sketch(members: np.ndarray) -> np.ndarray:
    """Numbers of members by hash, in a power of two of cells near a quarter of the size.

    Cells count up to 255. Half as many cells come from adding neighbours, and the difference of
    two sketches of one length is never above that of the sets.
    """
    bits = max(3, (max(len(members), 1) // 4).bit_length())
    cells = (mix(members ^ np.uint64(0x3C3C3C3C3C3C3C3C)) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=1 << bits), 255).astype(np.uint8)


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as a table, all brought to the shortest length."""
    least = min(map(len, sketches))
    return np.stack([
        np.frombuffer(s, np.uint8).astype(np.int32).reshape(least, -1).sum(1) for s in sketches])


def set_digest(members: np.ndarray) -> bytes:
    """128 bits of the sorted members."""
    return xxhash.xxh3_128_digest(members.tobytes())


# --- passes over the texts -------------------------------------------------------------------

FEATURES = "doc_id bigint, n_shingles bigint, digest binary, sketch binary, shingle bigint, n bigint"


def _frequent(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(np.concatenate(sets))
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[:len(values)])
    counts = np.diff(starts, append=len(values))
    often = counts >= max(8, FREQUENT_SHARE * len(sets))
    return values[starts[often]], counts[often]


def _features(batches) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows of shingles that are frequent in a run of documents."""
    names = ["doc_id", "n_shingles", "digest", "sketch", "shingle", "n"]
    recent: list[np.ndarray] = []

    def common_rows() -> pa.RecordBatch:
        values, counts = _frequent(recent)
        none = [pa.nulls(len(values), kind) for kind in (
            pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        return pa.RecordBatch.from_arrays(
            [*none, pa.array(values.view(np.int64)), pa.array(counts)], names=names)

    for batch in batches:
        sizes, digests, sketches = [], [], []
        for members in shingle_sets(batch.column(1)):
            sizes.append(len(members))
            digests.append(set_digest(members))
            sketches.append(sketch(members).tobytes())
            recent.append(members)
            if len(recent) >= FREQUENT_CHUNK:
                yield common_rows()
                recent.clear()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(sketches, pa.binary()), *(pa.nulls(len(sizes), pa.int64()),) * 2],
            names=names)
    if recent:
        yield common_rows()


def _signature_rows(batches, frequent, percent) -> Iterator[pa.RecordBatch]:
    """``sig, doc`` of each text; of equal sets of a task only the first."""
    seen: set[bytes] = set()
    sets: list[np.ndarray] = []
    docs: list[int] = []
    held = 0

    def flush() -> pa.RecordBatch:
        sig, doc = signatures_of(sets, np.array(docs, np.int64), frequent, percent)
        return pa.RecordBatch.from_arrays(
            [pa.array(sig.view(np.int64)), pa.array(doc)], names=["sig", "doc"])

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for doc, members in zip(ids, shingle_sets(batch.column(1))):
            if doc is None or not len(members):
                continue
            digest = set_digest(members)
            if digest in seen:
                continue
            seen.add(digest)
            sets.append(members)
            docs.append(doc)
            held += len(members)
            if held >= BATCH_MEMBERS:
                yield flush()
                sets, docs, held = [], [], 0
    if sets:
        yield flush()


def _set_rows(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = [s.view(np.int64) for s in shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(members, pa.list_(pa.int64()))], names=["doc", "members"])


def _shared_rows(batches) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and document, those whose signature several documents have.

    Holds one row back between batches, so a signature of any number of documents passes.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, doc = (batch.column(i).to_numpy() for i in (0, 1))
        known = False
        if held is not None:
            sig, doc = np.concatenate([[held[0]], sig]), np.concatenate([[held[1]], doc])
            known = held[2]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
        sig, doc = sig[new], doc[new]
        same = sig[1:] == sig[:-1]
        shared = np.zeros(len(sig), bool)
        shared[1:] |= same
        shared[:-1] |= same
        shared[0] |= known
        held = (sig[-1], doc[-1], bool(shared[-1]))
        out = shared[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sig[:-1][out]), pa.array(doc[:-1][out])], names=["sig", "doc"])
    if held is not None and held[2]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())],
            names=["sig", "doc"])


# --- candidates ------------------------------------------------------------------------------


def _sketches_close(
    a: np.ndarray, b: np.ndarray, sizes: np.ndarray, sketches: list[bytes], percent: int,
) -> np.ndarray:
    """For pairs of rows: whether their sketches allow a link, by lengths of the sketches."""
    lengths = np.array([len(s) for s in sketches])
    place = np.zeros(len(sketches), np.int64)
    tables = {}
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        place[own] = np.arange(len(own))
        tables[length] = np.frombuffer(b"".join(sketches[i] for i in own), np.uint8).reshape(
            len(own), length)
    ok = np.zeros(len(a), bool)
    combined = lengths[a] * (1 << 32) + lengths[b]
    for value in np.unique(combined).tolist():
        la, lb = value >> 32, value & ((1 << 32) - 1)
        least = min(la, lb)
        pairs = np.flatnonzero(combined == value)
        for start in range(0, len(pairs), step := max(1, COMPARE_CELLS // max(la, lb))):
            some = pairs[start:start + step]
            x = tables[la][place[a[some]]].reshape(len(some), least, -1).sum(2, dtype=np.int32)
            y = tables[lb][place[b[some]]].reshape(len(some), least, -1).sum(2, dtype=np.int32)
            most = (sizes[a[some]] + sizes[b[some]]) * (100 - percent) // (100 + percent)
            ok[some] = np.abs(x - y).sum(1) <= most
    return ok


def _distinct_pairs(a, b, docs, sizes, sketches, percent):
    low, high = np.minimum(docs[a], docs[b]), np.maximum(docs[a], docs[b])
    order = np.lexsort((high, low))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
    some = order[new]
    some = some[_sketches_close(a[some], b[some], sizes, sketches, percent)]
    return low[some], high[some]


def _cell_pairs(
    cell: np.ndarray, docs: np.ndarray, components: np.ndarray, stray: np.ndarray,
    sizes: np.ndarray, sketches: list[bytes], percent: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a stray and any other row of the same cell that may link.

    Rows are sorted by cell, so the partners of a row are a range; the ranges of as many strays
    as make PAIR_ROWS pairs are laid out at once.
    """
    left, right = np.flatnonzero(stray), np.flatnonzero(~stray)
    first, last = (np.searchsorted(cell[right], cell[left], side) for side in ("left", "right"))
    counts = last - first
    done = np.cumsum(counts)
    start = 0
    while start < len(left):
        base = done[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(done, base + PAIR_ROWS, "right")))
        n = counts[start:stop]
        a = np.repeat(left[start:stop], n)
        offsets = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        b = right[np.repeat(first[start:stop], n) + offsets]
        ok = (components[a] != components[b]) & (
            np.maximum(sizes[a], sizes[b]) * percent <= np.minimum(sizes[a], sizes[b]) * 100)
        if ok.any():
            yield _distinct_pairs(a[ok], b[ok], docs, sizes, sketches, percent)
        start = stop


def _cross_rows(batches, percent) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows that are sorted by cell, whole cells at a time.

    A cell has a bounded number of rows; they are held until it ends.
    """
    kept: list[tuple] = []
    rows = 0

    def flush():
        parts = [np.concatenate([p[i] for p in kept]) for i in range(7)]
        new = np.zeros(len(parts[0]), bool)
        for column in parts[:3]:
            new[1:] |= column[1:] != column[:-1]
        cell = np.cumsum(new)
        sketches = [s for p in kept for s in p[7]]
        for a, b in _cell_pairs(cell, *parts[3:], sketches, percent):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        part += (batch.column(7).to_pylist(),)
        if rows >= CROSS_ROWS:
            # cut where the last cell that is held ends
            same = np.ones(len(part[0]), bool)
            for i in range(3):
                same &= part[i] == kept[-1][i][-1]
            end = len(same) if same.all() else int(np.argmin(same))
            kept.append(tuple(x[:end] for x in part))
            rows += end
            if end < len(same):
                yield from flush()
                kept, rows = [], 0
            part = tuple(x[end:] for x in part)
        if len(part[0]):
            kept.append(part)
            rows += len(part[0])
    if kept:
        yield from flush()


def _close_rows(batches, percent) -> Iterator[pa.RecordBatch]:
    """Of ``a, b`` with sizes and sketches of both, the pairs that may link."""
    for batch in batches:
        n = batch.num_rows
        sizes = np.concatenate([batch.column(i).to_numpy() for i in (2, 4)])
        sketches = batch.column(3).to_pylist() + batch.column(5).to_pylist()
        at = np.arange(n)
        ok = _sketches_close(at, at + n, sizes, sketches, percent) if n else np.zeros(0, bool)
        yield batch.select([0, 1]).filter(pa.array(ok))


def _allowed(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow a link; exact conditions."""
    a, b = (members.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"n{side}"),
                           F.col("sketch").alias(f"s{side}")) for side in "ab")
    joined = pairs.join(a, "a").join(b, "b").filter(
        F.greatest("na", "nb") * percent <= F.least("na", "nb") * 100)
    return joined.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(
        partial(_close_rows, percent=percent), "a bigint, b bigint").distinct()


def _crossing(
    star: DataFrame, components: DataFrame, members: DataFrame, percent: int,
) -> DataFrame:
    """Candidate pairs that the stars ``(centre, rep)`` have left in different components.

    Two sets with a common signature are in the star of its centre. If they lie apart, one of
    them at least is a stray: not in the centre's component. So strays are held against all rows
    of their star. A star is dealt into cells of bounded numbers of strays and of other rows.
    """
    label = components.select(F.col("node").alias("n1"), F.col("component").alias("c1"))
    centre_label = components.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
    rows = stored(
        star.join(label, F.col("rep") == F.col("n1"), "left")
        .join(centre_label, F.col("centre") == F.col("n2"), "left")
        .select("centre", "rep", F.coalesce("c1", "rep").alias("component"),
                (F.coalesce("c1", "rep") != F.coalesce("c2", "centre")).alias("stray")), "stars")
    dealt = F.ceil(F.greatest(F.lit(1), F.col("n")) / CELL_ROWS).cast("int")
    parts = rows.groupBy(F.col("centre").alias("of")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("stray").cast("int")).alias("s")).filter(
            "s > 0 AND n > 1").select(
                "of", dealt.alias("parts"),
                F.ceil(F.col("s") / CELL_ROWS).cast("int").alias("stray_parts"))
    spread = F.xxhash64("rep")
    number = lambda n: F.pmod(spread, n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    placed = rows.join(parts, F.col("centre") == F.col("of"))
    right = placed.select(
        "centre", number(F.col("parts")).alias("part"),
        F.explode(every(F.col("stray_parts"))).alias("stray_part"), "rep", "component",
        F.lit(False).alias("stray"))
    left = placed.filter("stray").select(
        "centre", F.explode(every(F.col("parts"))).alias("part"),
        number(F.col("stray_parts")).alias("stray_part"), "rep", "component", "stray")
    cells = left.unionByName(right).join(
        members.withColumnRenamed("rep", "of"), F.col("rep") == F.col("of"))
    key = ("centre", "part", "stray_part")
    return cells.select(*key, "rep", "component", "stray", "n_shingles", "sketch").repartition(
        *key).sortWithinPartitions(*key).mapInArrow(
            partial(_cross_rows, percent=percent), "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by comparing the sets."""
    left = sets.select(F.col("doc").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("members").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").filter(
        shared * 100 >= (F.size("x") + F.size("y") - shared) * percent).select("a", "b")


def _sorted_by(df: DataFrame, *names: str) -> DataFrame:
    return df.repartition(names[0]).sortWithinPartitions(*names)


def link_sets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for each row of ``docs``.

    The component is the smallest key that links reach, the row's own included. Equal sets link.
    Null and empty texts, and texts without words, have an empty set and link with nothing. Rows
    with equal keys are one node that has the links of all their texts. Rows without key have the
    component of an equal set that has a key, else null, and link nothing else. Keys are long
    integers. Columns other than key and text are not read.
    """
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    features = stored(rows.mapInArrow(_features, FEATURES), "features")
    sets = features.filter("digest IS NOT NULL")
    top = features.filter("digest IS NULL").groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "shingle").limit(MAX_FREQUENT).orderBy("shingle").collect()
    values = np.array([r["shingle"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(values)
    frequent = (values[order], np.array([r["n"] for r in top], np.int64)[order])

    # equal sets are one class, represented by its smallest key
    classes = sets.filter("n_shingles > 0").groupBy(F.col("digest").alias("class")).agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("class_size"),
        F.first("sketch").alias("class_sketch"))
    placed = stored(
        sets.select("doc_id", "n_shingles", "digest").join(
            classes, F.col("digest") == F.col("class"), "left").select(
                "doc_id", "n_shingles", "rep",
                F.when(F.col("doc_id") == F.col("rep"), F.col("class_sketch")).alias("sketch")),
        "classes")
    members = placed.filter("sketch IS NOT NULL").select(
        "rep", "n_shingles", "sketch").dropDuplicates(["rep", "n_shingles", "sketch"])

    signed = rows.mapInArrow(
        partial(_signature_rows, frequent=frequent, percent=percent), "sig bigint, doc bigint")
    same = _sorted_by(signed, "sig", "doc").mapInArrow(_shared_rows, "sig bigint, doc bigint")
    reps = placed.filter("rep IS NOT NULL").select(F.col("doc_id").alias("of"), "rep").distinct()
    mapped = same.join(reps, F.col("doc") == F.col("of")).select("sig", "rep").distinct()
    shared = stored(mapped, "signatures")
    counts = shared.groupBy(F.col("sig").alias("s")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = stored(shared.join(counts, F.col("sig") == F.col("s")).drop("s"), "groups")
    wanted = groups.select(F.col("rep").alias("wanted")).distinct()
    texts = rows.join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    held = stored(texts.mapInArrow(_set_rows, "doc bigint, members array<bigint>"), "sets")

    popular = groups.groupBy(F.col("rep").alias("of")).agg(F.sum("n").alias("popularity"))
    centres = groups.join(popular, F.col("rep") == F.col("of")).groupBy(F.col("sig").alias("s")).agg(
        F.max(F.struct("popularity", (-F.col("rep")).alias("less"))).alias("top")).select(
            "s", (-F.col("top.less")).alias("centre"))
    star = stored(groups.join(centres, (F.col("sig") == F.col("s")) & (
        F.col("rep") != F.col("centre"))).select("centre", "rep").distinct(), "star")
    pairs = stored(_allowed(star.select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct(),
        members, percent), "pairs")
    links = stored(_verified(pairs, held, percent), "links")
    first = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = _verified(stored(_crossing(star, first, members, percent), "crossing"), held, percent)
    # one key with several sets is one node
    several = reps.groupBy(F.col("of").alias("key")).agg(
        F.min("rep").alias("u"), F.max("rep").alias("top")).filter("u < top")
    tied = reps.join(several, F.col("of") == F.col("key")).select("u", F.col("rep").alias("v"))
    components = connected_components(links.union(more).select(
        F.col("a").alias("u"), F.col("b").alias("v")).union(tied))
    return placed.join(components, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles",
        F.coalesce("component", "rep", "doc_id").alias("component_id"))
