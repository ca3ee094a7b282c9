"""Benchmark decontamination by the q-gram lemma.

A window of `w` characters of a benchmark item that occurs in a document with
at most `k` edits shares at least w + 1 - q(k + 1) of its q-grams with it, all
on k + 1 neighbouring diagonals. Shared q-grams are counted in overlapping
diagonal bands; regions that reach the bound are kept, and each of their
windows is verified by banded alignment.

Documents are streamed once in Arrow batches past an index of the items, so
nothing is shuffled. The items are taken in blocks of bounded size; a
benchmark above one block costs one more pass for each further block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import slices

#: Characters of a window, edits allowed in it, characters of a q-gram (8 to 16).
WINDOW, EDITS, Q = 60, 4, 10
#: Characters of benchmark text that one pass holds in memory.
BLOCK_CHARS = 16_000_000
#: Bytes of document text compared at once, and pairs of equal q-grams expanded at once.
SLICE_BYTES, PAIRS = 1 << 20, 1 << 21

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def normalise(text: str | None) -> str:
    """Lower case, with each run of white space as one blank."""
    return " ".join(text.lower().split()) if text else ""


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _folded(text: str) -> np.ndarray:
    """A byte for each character; equal characters have equal bytes."""
    try:
        return np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        points = _points(text)
        return ((points ^ (points >> 8)) & 0xFF).astype(np.uint8)


def _codes(data: np.ndarray, n: int, q: int) -> np.ndarray:
    """Codes of the `n` q-grams of a byte array that is padded behind."""
    first = np.ndarray((n,), "<u8", data, 0, (1,))
    last = np.ndarray((n,), "<u8", data, q - 8, (1,))
    return first * _M1 + last * _M2


def _runs(points: np.ndarray, n: int) -> np.ndarray:
    """Codes of all runs of `n` characters."""
    codes = np.zeros(max(0, len(points) - n + 1), np.uint64)
    for k in range(n):
        codes = (codes + points[k : k + len(codes)]) * _M1
        codes ^= codes >> np.uint64(29)
    return codes


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The integers of [low, high) for each pair, end to end."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


class _Short:
    """Items of one length that is less than a q-gram's; they are found as they stand."""

    def __init__(self, items: list[int], texts: list[str]):
        self.size = len(texts[items[0]])
        codes = _runs(_points("".join(texts[i] for i in items)), self.size)[:: self.size]
        order = np.argsort(codes, kind="stable")
        self.codes, self.items = codes[order], np.array(items)[order]

    def found(self, texts: list[str], names: list[str], points: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item) of each item that is in a text; `points` are the texts end to end."""
        codes = _runs(points, self.size)
        low = np.searchsorted(self.codes, codes)
        hits = np.flatnonzero(self.codes[np.minimum(low, len(self.codes) - 1)] == codes)
        doc = np.searchsorted(ends, hits, "right")
        inside = hits + self.size <= ends[doc]
        low, doc, hits = low[hits][inside], doc[inside], hits[inside]
        both, first = np.unique(doc * len(self.codes) + low, return_index=True)
        places = hits[first] - np.append(0, ends)[doc[first]]
        beyond = np.searchsorted(self.codes, self.codes[both % len(self.codes)], "right")
        for k, a, b, place in zip((both // len(self.codes)).tolist(), (both % len(self.codes)).tolist(), beyond.tolist(), places.tolist(), strict=True):
            for i in self.items[a:b].tolist():
                if texts[k].startswith(names[i], place) or names[i] in texts[k]:
                    yield k, i


class Index:
    """The q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW, edits: int = EDITS, q: int = Q):
        if not 8 <= q <= 16 or window + 1 - q * (edits + 1) < 1:
            raise ValueError("q must be 8 to 16, and window + 1 - q * (edits + 1) at least 1")
        kept = sorted({(key, normalise(text)) for key, text in items if normalise(text)}, key=lambda x: (str(x[0]), x[1]))
        self.ids, self.texts, self.q = [k for k, _ in kept], [t for _, t in kept], q
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.window = np.minimum(sizes, window)
        self.edits = np.minimum(edits * self.window // window, np.maximum(self.window // q - 1, 0))
        self.least = np.maximum(self.window + 1 - q * (self.edits + 1), 1)
        self.widest = int(edits)
        self.short = [_Short(np.flatnonzero(sizes == n).tolist(), self.texts) for n in np.unique(sizes[sizes < q]).tolist()]
        self.points = [_points(t) for t in self.texts]
        codes, item, at = [], [], []
        for i, text in enumerate(self.texts):
            n = len(text) - q + 1
            if n > 0:
                codes.append(_codes(np.concatenate([_folded(text), np.zeros(16, np.uint8)]), n, q))
                item.append(np.full(n, i))
                at.append(np.arange(n))
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.at = np.concatenate(at)[order] if at else np.zeros(0, np.int64)
        bits = min(26, max(18, int(len(codes)).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[self.codes >> self.shift] = True

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, verified windows, fewest edits) of normalised texts."""
        parts = [_folded(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        found: list[tuple[int, int, int, int]] = []
        if self.short and texts:
            points = np.concatenate([_points(t) for t in texts])
            found = [(k, i, 1, 0) for short in self.short for k, i in short.found(texts, self.texts, points, ends)]
        n = int(ends[-1]) - self.q + 1 if len(parts) else 0
        if n <= 0 or not len(self.codes):
            return found
        codes = _codes(np.concatenate([*parts, np.zeros(16, np.uint8)]), n, self.q)
        hits = np.flatnonzero(self.filter[codes >> self.shift])
        doc = np.searchsorted(ends, hits, "right")
        inside = hits + self.q <= ends[doc]
        hits, doc = hits[inside], doc[inside]
        low, high = np.searchsorted(self.codes, codes[hits], "left"), np.searchsorted(self.codes, codes[hits], "right")
        some = high > low
        hits, doc, low, high = hits[some], doc[some], low[some], high[some]
        starts = ends - [len(p) for p in parts]
        regions = self._regions(texts, hits - starts[doc], doc, low, high, 0, len(self.ids))
        return found + self._verified(texts, regions)

    def _regions(self, texts: list[str], at: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, first: int, last: int) -> np.ndarray:
        """Rows (text, item, band, first window, last window) that meet the bound, for items from `first` to before `last`."""
        empty = np.zeros((0, 5), np.int64)
        counts = high - low
        total = int(counts.sum())
        if not total:
            return empty
        if total > 8 * PAIRS and len(at) > 1 and doc[0] != doc[-1]:  # text by text, as long as there are more
            cut = int(np.searchsorted(doc, (doc[0] + doc[-1] + 1) // 2))
            return np.concatenate([self._regions(texts, at[s], doc[s], low[s], high[s], first, last) for s in (slice(0, cut), slice(cut, None))])
        if total > 8 * PAIRS and last - first > 1:  # then items by items
            mid = (first + last) // 2
            sub = []
            for a, b in ((first, mid), (mid, last)):
                inside = np.concatenate([[0], np.cumsum((self.item >= a) & (self.item < b))])
                some = inside[high] > inside[low]
                if some.any():
                    sub.append(self._regions(texts, at[some], doc[some], low[some], high[some], a, b))
            return np.concatenate(sub) if sub else empty
        if total > 8 * PAIRS:  # one text, one item: the diagonals in ranges
            return self._ranges(texts, at, doc, low, high, first)
        return self._expanded(at, doc, low, high, first, last)

    def _ranges(self, texts: list[str], at: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, i: int) -> np.ndarray:
        """The regions of one text and one item, worked out over ranges of diagonals, so that memory is bounded.

        A band on which the whole item stands without an edit is all there is to know, so it ends the search.
        """
        mine = np.flatnonzero(self.item == i)
        low, high = np.searchsorted(mine, low), np.searchsorted(mine, high)
        keep = high > low
        at, doc, low, high = at[keep], doc[keep], low[keep], high[keep]
        if not len(at):
            return np.zeros((0, 5), np.int64)
        spots, size = self.at[mine], len(self.texts[i])
        step = self.widest + 1
        begin, end = (int(at[0]) - size) // step, int(at[-1]) // step + 1
        width = max(2, PAIRS // (step * min(size, len(at))))  # steps of a range; a diagonal holds as many pairs as the shorter side at most
        group = np.cumsum(np.append(True, np.diff(self.codes[mine].view(np.int64)) != 0)) * (size + 1) + spots  # spots rise within a code
        base = group[low] - spots[low]
        out = []
        for b in range(begin, end + 1, width):
            first, beyond = b * step, (b + width + 1) * step  # and one step more, which the last band needs
            near = np.flatnonzero((at >= first) & (at < beyond + size))
            if not len(near):
                continue
            least, most = np.maximum(at[near] - beyond + 1, 0), np.minimum(at[near] - first, size)
            lo = np.searchsorted(group, base[near] + least)
            hi = np.searchsorted(group, base[near] + most, "right")
            some = hi > lo
            if some.any():
                rows = self._banded(np.repeat(doc[near][some], (hi - lo)[some]), np.full(int((hi - lo)[some].sum()), i), spots[_spread(lo[some], hi[some])], np.repeat(at[near][some], (hi - lo)[some]))
                out.append(rows[(rows[:, 2] >= b) & (rows[:, 2] < b + width)])
                full = out[-1][(out[-1][:, 3] == 0) & (out[-1][:, 4] >= size - int(self.window[i]))][:1]
                if len(full) and not self._edits(_points(texts[int(full[0, 0])]), i, int(full[0, 2]), np.arange(size - int(self.window[i]) + 1)).any():
                    return full
        return np.concatenate(out) if out else np.zeros((0, 5), np.int64)

    def _expanded(self, at: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, first: int, last: int) -> np.ndarray:
        pieces = []
        cuts = np.flatnonzero(np.diff(np.cumsum(high - low) // PAIRS)) + 1
        for part in np.split(np.arange(len(at)), cuts):
            counts = (high - low)[part]
            pair = np.repeat(low[part], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            item = self.item[pair]
            keep = (item >= first) & (item < last)
            pieces.append((np.repeat(doc[part], counts)[keep], item[keep], self.at[pair][keep], np.repeat(at[part], counts)[keep]))
        doc, item, spot, place = (np.concatenate(x) for x in zip(*pieces, strict=True))
        both, inverse, count = np.unique(doc * len(self.ids) + item, return_inverse=True, return_counts=True)
        keep = (count >= self.least[both % len(self.ids)])[inverse]
        return self._banded(doc[keep], item[keep], spot[keep], place[keep])

    def _banded(self, doc: np.ndarray, item: np.ndarray, spot: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rows (text, item, band, first window, last window) that meet the bound; windows that follow each other are one row."""
        if not len(doc):
            return np.zeros((0, 5), np.int64)
        step = self.widest + 1
        band = (place - spot) // step
        band = np.concatenate([band, band - 1])  # a band is two steps wide, and bands overlap by one
        doc, item, spot = (np.concatenate([x, x]) for x in (doc, item, spot))
        order = np.lexsort((spot, band, item, doc))
        doc, item, spot, band = doc[order], item[order], spot[order], band[order]
        change = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(band) != 0)])
        group = np.cumsum(change)
        end = np.arange(len(doc)) + self.least[item] - 1
        ok = end < len(doc)
        held, end = np.flatnonzero(ok), end[ok]
        ok = (group[held] == group[end]) & (spot[end] + self.q - spot[held] <= self.window[item[held]])
        held, end = held[ok], end[ok]
        lo = np.maximum(spot[end] + self.q - self.window[item[held]], 0)
        if not len(held):
            return np.zeros((0, 5), np.int64)
        rows = np.stack([doc[held], item[held], band[held], lo, spot[held]], axis=1)  # in order, as both bounds rise with the spot
        head = np.append(True, (np.diff(rows[:, :3], axis=0) != 0).any(axis=1) | (rows[1:, 3] > rows[:-1, 4] + 1))
        last = np.append(np.flatnonzero(head)[1:], len(rows)) - 1
        return np.concatenate([rows[head, :4], rows[last, 4:]], axis=1)

    def _verified(self, texts: list[str], regions: np.ndarray) -> list[tuple[int, int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if not len(regions):
            return []
        group = np.flatnonzero(np.concatenate([[True], (np.diff(regions[:, :3], axis=0) != 0).any(axis=1)]))
        bands = np.split(regions, group[1:])
        for rows in sorted(bands, key=lambda rows: -int((rows[:, 4] - rows[:, 3]).sum())):
            k, i, band = (int(x) for x in rows[0, :3])
            last = len(self.texts[i]) - int(self.window[i])
            if best.get((k, i)) == (last + 1, 0):
                continue  # no other band can have more windows or fewer edits
            windows = np.unique(np.concatenate([np.arange(lo, min(hi, last) + 1) for lo, hi in rows[:, 3:]]))
            edits = self._edits(_points(texts[k]), i, band, windows)
            good = edits[edits <= self.edits[i]]
            if len(good):
                n, least = best.get((k, i), (0, 1 << 30))
                best[k, i] = max(n, len(good)), min(least, int(good.min()))
        return [(k, i, n, least) for (k, i), (n, least) in best.items()]

    def _edits(self, text: np.ndarray, i: int, band: int, windows: np.ndarray) -> np.ndarray:
        """Fewest edits of each window of item `i` against the text along a band of diagonals."""
        w, k, step = int(self.window[i]), self.widest, self.widest + 1
        width = 2 * step + 2 * k
        pad = w + width + 2
        padded = np.concatenate([np.full(pad, 0xFFFFFFFF, np.uint32), text, np.full(pad, 0xFFFFFFFF, np.uint32)])
        least = np.empty(len(windows), np.int64)
        offsets = np.arange(width)
        for at in range(0, len(windows), 4096):
            u = windows[at : at + 4096]
            base = np.clip(u + band * step - k + pad, 0, len(padded) - pad)
            cost = np.zeros((len(u), width), np.int32)
            for row in range(w):
                chars = padded[(base + row)[:, None] + offsets]
                new = cost + (chars != self.points[i][u + row][:, None])
                new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(new - offsets, axis=1) + offsets
            least[at : at + 4096] = cost.min(axis=1)
        return least


_LAST: dict[str, Index] = {}


def _built(name: str, items: list[tuple[object, str]], window: int, edits: int, q: int) -> Index:
    """The index of a block, made once in each Python worker, which keeps its last one."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Index(items, window, edits, q)
    return _LAST[name]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about `block_chars` characters, dealt by a hash of the id."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, edits: int = EDITS, q: int = Q, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_windows, min_edits) of every document row and every item found in it.

    An item is found if one of its windows of `window` characters (the whole
    item if it is shorter, with edits in proportion) is within `edits` edits of
    a passage of the document; case and white space don't count. n_windows is
    the most windows verified in one band. Null and empty texts match nothing;
    repeated document rows are each compared, repeated items once; texts and
    items of any length are compared whole, in bounded memory; an empty table
    gives no rows; other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    kinds, item_kind = dict(docs.dtypes), dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kinds['doc_id']}, item_id {item_kind}, n_windows bigint, min_edits bigint"
    found = None
    for items in _blocks(benchmark, block_chars):
        shared, name = context.broadcast(items), uuid.uuid4().hex

        def batches(parts: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = _built(name, shared.value, window, edits, q)
            out = None
            for batch in slices(parts, "text", SLICE_BYTES):
                rows = index.matches([normalise(x.as_py()) for x in batch.column("text")])
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                out = pa.RecordBatch.from_arrays(
                    [ids, pa.array([index.ids[r[1]] for r in rows]).cast(types[1]) if rows else pa.array([], types[1]), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                    names=["doc_id", "item_id", "n_windows", "min_edits"],
                )
                yield out

        types = [None, pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()]
        part = docs.select("doc_id", "text").mapInArrow(batches, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, edits: int = EDITS, q: int = Q, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs`, with all their columns, in which `leaks` finds no item."""
    context = docs.sparkSession.sparkContext
    kept = docs
    for items in _blocks(benchmark, block_chars):
        shared, name = context.broadcast(items), uuid.uuid4().hex

        def batches(parts: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = _built(name, shared.value, window, edits, q)
            for batch in slices(parts, "text", SLICE_BYTES):
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in index.matches([normalise(x.as_py()) for x in batch.column("text")])]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(batches, docs.schema)
    return kept
