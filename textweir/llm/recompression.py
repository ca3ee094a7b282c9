"""Repeated word windows found by recompression.

A text's words become symbols. In each round maximal runs of a symbol get one
name, then symbols are split in left and right ones by a hash, and each
left-right pair gets one name. A name is a 64-bit hash of what it stands for,
so all executors name equal runs and pairs alike without an exchange of
dictionaries, and equal texts get equal symbols but near their ends. How far
a symbol's making looked to either side is carried along, so it is known
exactly which high-level symbols a window of `WINDOW` words determines.

A window's anchor is the least of those symbols; windows that share no symbol
are never compared. Windows with a shared anchor are brought together and
verified word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from textweir.llm.common import Scratch, slices
from textweir.llm.segments import CHUNK_BYTES, HOT, identified, removed_spans, segment_batch, union

WINDOW = 50
ROUNDS = 3
#: Bytes of text whose symbols are worked out at once.
SLICE_BYTES = 1 << 20

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE, _SECOND = 0x100000001B3, 0xD6E8FEB86659FD93


def _name(a: np.ndarray, b: np.ndarray | np.uint64, salt: int) -> np.ndarray:
    h = a * _M1 + b * _M2 + np.uint64(salt)
    h ^= h >> np.uint64(32)
    h *= _M3
    h ^= h >> np.uint64(29)
    h *= _M1
    return h ^ (h >> np.uint64(32))


def recompress(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, with the words [low, high) that determine each.

    `words` are the hashed words of texts laid end to end. What depends on a
    text's end has its bound outside the text.
    """
    sym = words
    doc = np.repeat(np.arange(len(starts)), ends - starts)
    low, high = np.arange(len(words)), np.arange(len(words)) + 1
    for r in range(rounds):
        if not len(sym):
            break
        before, after = starts[doc] - 1, ends[doc] + 1  # bounds that stand for a text's ends
        head = np.ones(len(sym), bool)
        head[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(sym)) - 1
        left, right = np.maximum(first - 1, 0), np.minimum(last + 1, len(sym) - 1)
        new_low = np.where((first > 0) & (doc[left] == doc[first]), low[left], before[first])
        new_high = np.where((last < len(sym) - 1) & (doc[right] == doc[last]), high[right], after[last])
        times = (last - first + 1).astype(np.uint64)
        named = np.where(times > 1, _name(sym[first], times, 4 * r + 1), sym[first])
        sym, doc, low, high, before, after = named, doc[first], new_low, new_high, before[first], after[last]
        is_right = (_name(sym, np.uint64(0), 4 * r + 2) >> np.uint64(63)).astype(bool)
        same = doc[1:] == doc[:-1]
        opens = np.append(~is_right[:-1] & is_right[1:] & same, False)
        closes = np.append(False, opens[:-1])
        keep = np.flatnonzero(~closes)
        nxt, prv = np.minimum(keep + 1, len(sym) - 1), np.maximum(keep - 1, 0)
        paired = opens[keep]
        named = np.where(paired, _name(sym[keep], sym[nxt], 4 * r + 3), sym[keep])
        next_high = np.where((keep < len(sym) - 1) & (doc[nxt] == doc[keep]), high[nxt], after[keep])
        prev_low = np.where((keep > 0) & (doc[prv] == doc[keep]), low[prv], before[keep])
        new_low = np.where(~paired & is_right[keep], prev_low, low[keep])
        new_high = np.where(paired | ~is_right[keep], next_high, high[keep])
        sym, doc, low, high = named, doc[keep], new_low, new_high
    return sym, low, high


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


def _sums(words: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of hashed words by which `_spell` tells word runs apart."""
    return np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(base, len(words))[: len(words)], dtype=np.uint64)])


def _spell(sums: np.ndarray, base: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A digest of each word run [low, high), by content."""
    return (sums[high] - sums[low]) * _powers(pow(base, -1, 1 << 64), len(sums))[low]


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """A hash of each window of hashed words, by content."""
    at = np.arange(len(words) - window + 1)
    return _spell(_sums(words, _BASE), _BASE, at, at + window)


def window_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, as (anchor, first window, windows).

    The anchor of a window is the least among the symbols that it determines,
    by a hash of the words that a symbol's making looked at. So windows share
    an anchor only if they share all those words.
    """
    none = np.zeros(0, np.int64)
    total = len(words)
    if total < window:
        return none.astype(np.uint64), none, none
    sym, low, high = recompress(words, starts, ends, rounds)
    doc = np.repeat(np.arange(len(starts)), ends - starts)[: total - window + 1]
    at = np.arange(total - window + 1)
    inside = at + window <= ends[doc]
    at, doc = at[inside], doc[inside]
    if not len(at):
        return none.astype(np.uint64), none, none
    a = np.cumsum(np.bincount(low + 1, minlength=total + 2))[at]  # symbols that begin before the window
    b = np.cumsum(np.bincount(high, minlength=total + 2))[at + window]  # those that end within or before it
    order = _name(_spell(_sums(words, _BASE), _BASE, np.maximum(low, 0), np.minimum(high, total)), sym, 99)
    least = np.empty(len(at), np.uint64)
    some = b > a
    depth = int((b - a).max()).bit_length() if some.any() else 0
    table, span = order, 1
    wide = np.where(some, b - a, 0)
    for _ in range(depth):
        here = np.flatnonzero((wide >= span) & (wide < 2 * span))
        least[here] = np.minimum(table[a[here]], table[b[here] - span])
        if len(table) <= span:
            break
        table = np.minimum(table[:-span], table[span:])
        span *= 2
    if not some.all():  # a window inside a long run of one word: its own hash is its anchor
        least[~some] = window_hashes(words, window)[at[~some]]
    change = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(change)
    return least[first], at[first], np.diff(np.append(first, len(at)))


def _hashed(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word."""
    both = np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def segments(window: int, rounds: int = ROUNDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            words = [x.as_py().encode("utf-8", "surrogatepass").split() for x in batch.column("text")]
            ends = np.cumsum([len(w) for w in words])
            starts = ends - [len(w) for w in words]
            one, two = _hashed(w for ws in words for w in ws)
            del words
            h, first, n = window_runs(one, starts, ends, window, rounds)
            last = first + n + window - 1
            s, t = _spell(_sums(one, _BASE), _BASE, first, last), _spell(_sums(two, _SECOND), _SECOND, first, last)
            doc = np.searchsorted(ends, first, "right")
            uids, orders = batch.column("uid").to_numpy(), batch.column("ord").to_numpy()
            yield segment_batch(h, s, (t ^ (t >> np.uint64(32))) & np.uint64(0xFFFFFFFF), uids[doc], orders[doc], first - starts[doc], n, np.zeros(len(n), np.int64))

    return run


def single_windows(window: int):
    """Places and digests of all windows of some segments of a text."""

    def run(text: bytes, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one, two = _hashed(text.split())
        at = np.concatenate([np.arange(a, a + n) for a, n in sorted(spans)])
        return at, _spell(_sums(one, _BASE), _BASE, at, at + window), _spell(_sums(two, _SECOND), _SECOND, at, at + window)

    return run


def earlier_windows(segments: list[tuple[bytes, int]], window: int) -> list[np.ndarray]:
    """For each segment (words joined by blanks, doc), which of its windows occur in a segment of a smaller doc."""
    ids: dict[bytes, int] = {}
    words = [np.array([ids.setdefault(w, len(ids)) for w in s.split()], np.int32) for s, _ in segments]
    flat = np.concatenate(words)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    seg = np.repeat(np.arange(len(words)), ends - starts)[: len(flat) - window + 1]
    at = np.arange(len(seg))
    inside = at + window <= ends[seg]
    at, seg = at[inside], seg[inside]
    docs = np.array([d for _, d in segments], np.int64)
    hashed = window_hashes(_name(flat.astype(np.uint64), np.uint64(1), 5), window)[at]
    order = np.lexsort((docs[seg], hashed))
    at, seg, hashed = at[order], seg[order], hashed[order]
    head = np.concatenate([[True], hashed[1:] != hashed[:-1]])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
    later = np.flatnonzero(docs[seg] > docs[seg[lead]])
    views = np.lib.stride_tricks.sliding_window_view(flat, window)
    gone = np.zeros(len(flat), bool)
    for part in range(0, len(later), 1 << 15):
        rows = later[part : part + (1 << 15)]
        equal = (views[at[rows]] == views[at[lead[rows]]]).all(axis=1)
        gone[at[rows[equal]]] = True
        for row in rows[~equal]:  # another window has this hash: compare with all that do
            same = np.flatnonzero(hashed == hashed[row])
            gone[at[row]] = any(docs[seg[k]] < docs[seg[row]] and (views[at[k]] == views[at[row]]).all() for k in same)
    return [gone[a : b - window + 1] for a, b in zip(starts, ends, strict=True)]


def compare(window: int, chunk: int = CHUNK_BYTES):
    """Distinct segments in order of h to spans (uid, a, b) of words.

    Whole anchors are compared at a time; an anchor has `HOT` windows at most,
    so what is held is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int]] = []
        places: list[tuple[int, int]] = []
        size, last = 0, None
        unpack = zstandard.ZstdDecompressor().decompress

        def verified() -> pa.RecordBatch:
            rows = []
            for gone, (uid, start) in zip(earlier_windows(held, window), places, strict=True):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                rows += [(uid, start + a, start + b - 1 + window) for a, b in edges.reshape(-1, 2).tolist()]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["uid", "a", "b"])

        for batch in batches:
            for h, seg, order, uid, start in zip(*(batch.column(c).to_pylist() for c in ("h", "seg", "ord", "uid", "start")), strict=True):
                if size > chunk and h != last:
                    yield verified()
                    held, places, size = [], [], 0
                held.append((unpack(seg), order))
                places.append((uid, start))
                size += len(held[-1][0])
                last = h
        if held:
            yield verified()

    return run


def cut(window: int):
    """Segments packed one by one, as they overlap and the shuffle shrinks."""

    def run(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
        words, pack = text.split(), zstandard.ZstdCompressor(level=1, write_content_size=True).compress
        return [pack(b" ".join(words[a : a + n + window - 1])) for a, n in spans]

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, texts: bool = False, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of `docs`, and with `texts` the kept words as `kept`.

    Null and empty texts have no words. Rows that repeat an id don't remove
    each other's words, as neither id is smaller; a row without an id comes
    after all others. Texts of any length are read whole, one at a time; an
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "recompression")
    rows = identified(docs, scratch)
    lost = removed_spans(rows, segments(window, rounds), cut(window), compare(window), single_windows(window), scratch, window, across=True, hot=hot)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for z, spans in zip(batch.column("z"), batch.column("spans"), strict=True):
                words, gone = unpack(z.as_py()).split(), union(spans.as_py())
                kept = [w for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(words)], strict=True) for w in words[a:b]]
                joined = b" ".join(kept)
                out.append((len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "surrogatepass") if texts else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("uid"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["uid", "n_removed", "kept_sha256", "kept"])

    changed = scratch.keep(lost.mapInArrow(apply, "uid bigint, n_removed bigint, kept_sha256 string, kept string"), "changed")
    plain = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    whole = rows.select("uid", "doc_id", plain.alias("plain")).select(
        "uid",
        "doc_id",
        F.when(F.col("plain") == "", 0).otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("n_words"),
        F.sha2(F.encode("plain", "UTF-8"), 256).alias("whole_sha256"),
        *(["plain"] if texts else []),
    )
    return whole.join(changed, "uid", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *([F.coalesce("kept", "plain").alias("kept")] if texts else []),
    )
