"""Exact substring deduplication with suffix arrays built by external induced sorting.

Removes each byte that a string of `LENGTH` bytes covers which also starts
earlier. Windows pick the least hash among their k-grams as anchor, so equal
strings meet in one shard whatever documents they are from (see `segments`). A
shard's text is suffix-sorted by `induced.sorted_suffixes`, and runs of suffixes
that share `LENGTH` bytes are the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import Scratch
from textweir.llm.induced import sorted_suffixes
from textweir.llm.segments import AGAIN, CHUNK_BYTES, TWICE, again, identified, removed_spans, segment_batch, union

LENGTH = 100
#: Bytes of the k-grams that serve as anchors.
GRAM = 24
#: Bytes of text whose anchors are worked out at once.
PIECE = 1 << 18
#: Ranges of windows by which segments are trimmed.
RANGES = 8
#: Windows of an anchor's distinct segments that are sorted together; they make up about a chunk.
SORTED = 1 << 20
#: Bytes that the queues of a suffix sort hold in memory.
MEMORY = 64 << 20

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_BASES = (0x100000001B3, 0xD6E8FEB86659FD93)
#: Bytes are moved up by one, as 0 ends a sorted text; UTF-8 has no byte above 0xF4. SEPARATOR stands between segments.
SHIFT = bytes((i + 1) % 256 for i in range(256))
SEPARATOR = b"\xf8"


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the `n` k-grams of a byte array."""
    h = np.ndarray((n,), "<u8", data, 0, (1,)) * _M[0]
    h ^= h >> np.uint64(31)
    h += np.ndarray((n,), "<u8", data, 8, (1,))
    h *= _M[1]
    h ^= h >> np.uint64(29)
    h += np.ndarray((n,), "<u8", data, 16, (1,))
    h *= _M[2]
    h ^= h >> np.uint64(32)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


def _power_table(base: int, n: int) -> np.ndarray:
    """The powers 0 to `n` of a base, cut from a table that is kept."""
    return _powers(base, max(PIECE * 2, 1 << n.bit_length()))[: n + 1]


def _sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of k-gram hashes by which `_digests` tells byte strings apart."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _M[2]
    sums = (np.cumsum(values * _power_table(base, len(values))[:-1], dtype=np.uint64) for values, base in zip((hashes, mixed), _BASES, strict=True))
    one, two = (np.concatenate([[np.uint64(0)], x]) for x in sums)
    return one, two


def _digests(sums: tuple[np.ndarray, np.ndarray], first: np.ndarray, grams: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of the strings of so many k-grams that begin at `first`."""
    out = []
    for s, base in zip(sums, _BASES, strict=True):
        d = (s[first + grams] - s[first]) * _power_table(pow(base, -1, 1 << 64), len(s))[first]
        out.append(d ^ (d >> np.uint64(32)))
    return out[0], out[1]


def window_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, digests: bool = True) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, as (anchor, first window, windows, twice, digest, second digest), of texts laid end to end.

    twice tells that the run's bytes may hold the anchor's k-gram twice.
    """
    none, empty = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < length:
        return empty, none, none, none, empty, empty
    hashes, width = gram_hashes(data, len(data) - GRAM + 1), length - GRAM + 1
    least = sliding_least(hashes, width)
    edge = np.full(width - 1, np.iinfo(np.uint64).max, np.uint64)
    chosen = np.flatnonzero(hashes == ~sliding_least(np.concatenate([edge, ~least, edge]), width))  # anchors of any window
    repeats = np.concatenate([[0], np.cumsum(np.append(False, hashes[chosen[1:]] == hashes[chosen[:-1]]))])
    change = np.zeros(len(least) + 1, bool)
    change[1:-1] = least[1:] != least[:-1]
    change[0] = change[-1] = True
    change[starts[starts < len(least)]] = True
    beyond = np.maximum(ends - length + 1, starts)
    change[beyond[beyond <= len(least)]] = True
    first = np.flatnonzero(change[:-1])
    n = np.diff(np.append(first, len(least)))
    doc = np.searchsorted(ends, first, "right")
    inside = first + length <= ends[doc]
    first, n = first[inside], n[inside]
    low, high = np.searchsorted(chosen, first), np.searchsorted(chosen, first + n + width - 1)
    twice = (repeats[high] > repeats[np.minimum(low + 1, high)]).astype(np.int64)
    return least[first], first, n, twice, *(_digests(_sums(hashes), first, n + width - 1) if digests else (empty, empty))


def pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[list[tuple[int, int]], list[bytes], bool]]:
    """The texts of a batch in pieces (row, offset) of about `PIECE` bytes together, which overlap by all but a byte of a window; and whether a text ends with the last."""
    held: list[tuple[int, int]] = []
    parts: list[bytes] = []
    size = 0
    for k in range(batch.num_rows):
        text = batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
        last = max(1, len(text) - length + 1)
        for at in range(0, last, PIECE):
            held.append((k, at))
            parts.append(text[at : at + PIECE + length - 1])
            size += len(parts[-1])
            if size > PIECE:
                yield held, parts, at + PIECE >= last
                held, parts, size = [], [], 0
    if held:
        yield held, parts, True


def _runs(held: list[tuple[int, int]], parts: list[bytes], length: int, digests: bool) -> tuple[np.ndarray, ...]:
    """What `window_runs` finds in some pieces, with the rows and the places in them."""
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    h, first, n, twice, s, t = window_runs(np.frombuffer(b"".join(parts), np.uint8), starts, ends, length, digests)
    part = np.searchsorted(ends, first, "right")
    row, offset = np.array(held).T
    return h, s, t >> np.uint64(32), row[part], first - starts[part] + offset[part], n, twice


def anchors(length: int):
    """The anchors of all segments, without digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = batch.column("ord").to_numpy()
            for held, parts, _ in pieces(batch, length):
                h, _, _, row, _, _, twice = _runs(held, parts, length, False)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(orders[row]), pa.array((twice * TWICE).astype(np.int32))], names=["h", "ord", "flags"])

    return run


def segments(length: int):
    """All segments, with digests; those of a text are told together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, orders = batch.column("uid").to_numpy(), batch.column("ord").to_numpy()
            found: list[tuple[np.ndarray, ...]] = []
            for held, parts, ended in pieces(batch, length):
                found.append(_runs(held, parts, length, True))
                if ended:
                    h, s, t, row, start, n, twice = (np.concatenate(x) for x in zip(*found, strict=True))
                    found = []
                    repeats = again(h, s, t, row.astype(np.uint64))
                    yield segment_batch(h, s, t, uids[row], orders[row], start, n, twice * TWICE + repeats * AGAIN)

    return run


def single_windows(length: int):
    """Places and digests of all windows of some segments of a text."""

    def run(text: bytes, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = length - GRAM + 1
        places = np.concatenate([np.arange(a, a + n) for a, n in sorted(spans)])
        out = []
        for at in range(0, len(text), PIECE):  # the digest of a window doesn't depend on its place
            here = places[np.searchsorted(places, at) : np.searchsorted(places, at + PIECE)]
            if len(here):
                data = np.frombuffer(text[at : at + PIECE + length - 1], np.uint8)
                out.append(_digests(_sums(gram_hashes(data, len(data) - GRAM + 1)), here - at, width))
        w, v = (np.concatenate(x) for x in zip(*out, strict=True))
        return places, w, v

    return run


def trimmed(held: list[tuple[bytes, int, int, int]], anchors: list[int], length: int) -> list[tuple[bytes, int, int, int]]:
    """Segments (bytes, ord, uid, start) without those, and without the ends, that can share no window with another of their anchor.

    Windows are taken by where the anchor's k-gram stands in them, in `RANGES` ranges. All windows of
    a range have a core in common, which another segment has to hold as well.
    """
    sizes = np.array([len(s[0]) for s in held])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    hashes = gram_hashes(np.frombuffer(b"".join(s[0] for s in held) + bytes(GRAM), np.uint8), int(ends[-1]))
    of = np.repeat(np.arange(len(held)), sizes)
    key = np.array(anchors, np.int64).view(np.uint64)
    spots = np.flatnonzero(hashes == key[of])
    spots = spots[spots + GRAM <= ends[of[spots]]]
    once = np.flatnonzero(np.bincount(of[spots], minlength=len(held)) == 1)
    at = np.zeros(len(held), np.int64)
    at[of[spots]] = spots
    rest = length - GRAM
    step = -(-(rest + 1) // RANGES)
    from_, to = begins.copy(), ends.copy()
    from_[once], to[once] = ends[once], begins[once]
    for low in range(0, rest + 1, step):
        high = min(low + step, rest + 1)  # the k-gram stands `low` to `high` - 1 bytes behind the window's start
        start, size = at[once] - low, length - (high - low) + 1
        inside = np.flatnonzero((start >= begins[once]) & (start + size <= ends[once]))
        if not len(inside):
            continue
        rows, start = once[inside], start[inside]
        mixed = key[rows]
        for offset in (*range(0, size - GRAM, GRAM), size - GRAM):
            mixed = (mixed ^ hashes[start + offset]) * _M[1]
            mixed ^= mixed >> np.uint64(29)
        _, inverse, count = np.unique(mixed, return_inverse=True, return_counts=True)
        rows = rows[count[inverse] > 1]
        from_[rows] = np.minimum(from_[rows], np.maximum(at[rows] - high + 1, begins[rows]))
        to[rows] = np.maximum(to[rows], np.minimum(at[rows] - low + length, ends[rows]))
    return [(seg[a:b], order, uid, start + a) for (seg, order, uid, start), a, b in zip(held, (from_ - begins).tolist(), (to - begins).tolist(), strict=True) if b - a >= length]


def repeated_windows(segments: list[tuple[bytes, int, int, int]], length: int, memory: int = MEMORY) -> Iterator[tuple[int, int, int]]:
    """Spans (segment, a, b) covered by windows that also start earlier; segments are (bytes, doc, uid, start).

    Of equal windows the one with the least (doc, uid, start) stays.
    """
    text = np.frombuffer(SEPARATOR.join(s[0].translate(SHIFT) for s in segments) + b"\0", np.uint8)
    sizes = np.array([len(s[0]) for s in segments])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order = np.array(sorted(range(len(segments)), key=lambda k: segments[k][1:]))
    place = np.empty(len(segments), np.int64)  # segments by (doc, uid), in which windows are ordered by start
    key = [segments[k][1:3] for k in order]
    place[order] = np.cumsum([0] + [a != b for a, b in zip(key, key[1:], strict=False)])
    starts = np.array([s[3] for s in segments])
    extra = np.zeros(len(text), bool)

    def settle(group: np.ndarray, rows: np.ndarray) -> None:
        """Mark all but the earliest window of each group."""
        at = rows[:, 0]
        k = np.searchsorted(begins, at, "right") - 1
        inside = at + length <= begins[k] + sizes[k]  # else they share a separator
        group, at, k = group[inside], at[inside], k[inside]
        by = np.lexsort((starts[k] + at - begins[k], place[k], group))
        group, at = group[by], at[by]
        extra[at[1:][group[1:] == group[:-1]]] = True

    rest: list[np.ndarray] = []  # suffixes of the group that the last block left open
    for rows in sorted_suffixes(text, length, memory):
        if not rows[0, 1] >= length and rest:
            tail = np.concatenate(rest)
            settle(np.zeros(len(tail), np.int64), tail)
            rest = []
        heads = np.flatnonzero(rows[:, 1] < length)
        if not len(heads):
            rest.append(rows)
            continue
        if heads[0] and rest:
            tail = np.concatenate([*rest, rows[: heads[0]]])
            settle(np.zeros(len(tail), np.int64), tail)
        inner = rows[heads[0] : heads[-1]]
        group = np.cumsum(inner[:, 1] < length) if len(inner) else np.zeros(0, np.int64)
        many = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        if many.any():
            settle(group[many], inner[many])
        rest = [rows[heads[-1] :]]
    if rest:
        tail = np.concatenate(rest)
        settle(np.zeros(len(tail), np.int64), tail)
    marked = np.flatnonzero(extra)
    if len(marked):
        k = np.searchsorted(begins, marked, "right") - 1
        new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(k) > 0)])
        for a, b in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(marked)), strict=True):
            yield int(k[a]), int(marked[a] - begins[k[a]]), int(marked[b - 1] - begins[k[a]]) + length


def compare(length: int, chunk: int = CHUNK_BYTES, memory: int = MEMORY):
    """Distinct segments in order of h to spans (uid, a, b).

    They are collected, whole anchors at a time, and suffix-sorted together.
    An anchor has `SORTED` windows at most, so what is held is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int, int]] = []
        keys: list[int] = []
        size = 0

        def sort() -> pa.RecordBatch:
            some = trimmed(held, keys, length)
            rows = [(some[k][2], some[k][3] + a, some[k][3] + b) for k, a, b in repeated_windows(some, length, memory)] if some else []
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["uid", "a", "b"])

        for batch in batches:
            for h, seg, order, uid, start in zip(*(batch.column(c).to_pylist() for c in ("h", "seg", "ord", "uid", "start")), strict=True):
                if size > chunk and h != keys[-1]:
                    yield sort()
                    held, keys, size = [], [], 0
                held.append((seg, order, uid, start))
                keys.append(h)
                size += len(seg)
        if held:
            yield sort()

    return run


def deduplicate(docs: DataFrame, length: int = LENGTH, bytes_too: bool = False, hot: int = SORTED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of `docs`.

    With `bytes_too` also `kept`, the bytes that stay (they can break a
    character, as windows are of bytes).

    Null and empty texts have 0 bytes and the digest of nothing. Rows that
    repeat an id are documents of their own, in the order of a fixed row
    number; rows without an id come after all others. Texts of any length are
    read whole, in pieces; of equal strings the earliest stays; an empty table
    gives no rows. Columns other than doc_id and text are not read.
    """
    if length < GRAM + 1:
        raise ValueError(f"length must be above {GRAM}")
    scratch = Scratch(docs.sparkSession, "substrings")
    rows = identified(docs, scratch)
    cut = lambda text, spans: [text[a : a + n + length - 1] for a, n in spans]
    lost = removed_spans(rows, segments(length), cut, compare(length), single_windows(length), scratch, length, counting=anchors(length), hot=hot)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for z, spans in zip(batch.column("z"), batch.column("spans"), strict=True):
                text, gone = unpack(z.as_py()), union(spans.as_py())
                kept = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(text)], strict=True))
                out.append((len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if bytes_too else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("uid"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["uid", "n_removed", "n_spans", "kept_sha256", "kept"])

    changed = scratch.keep(lost.mapInArrow(apply, "uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"), "changed")
    text = F.encode("text", "UTF-8")
    whole = rows.select("uid", "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha256"))
    joined = whole.join(changed, "uid", "left")
    if bytes_too:
        texts = rows.select("uid", F.encode("text", "UTF-8").alias("all"))
        joined = joined.join(texts, "uid").withColumn("kept", F.coalesce("kept", "all"))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *(["kept"] if bytes_too else []),
    )
