"""External induced sorting of suffixes, with common-prefix values.

Suffixes are classed as L or S by comparison with their right neighbour. The
leftmost S suffixes (LMS) are sorted by recursion on the string of their
names; scanning them in order induces all L suffixes, and scanning those
downwards induces all S suffixes. A suffix that is scanned pushes its left
neighbour into a priority queue whose priority is the first character and
whose order within a priority is that of arrival, so a queue is a row of
first-in-first-out buckets. Tuples carry a suffix's position and the length
of the prefix it shares with the tuple before it: one more than the least
common prefix among the suffixes scanned in between.

Queues hold a bounded number of bytes in memory and append the rest to files,
and long texts are mapped from disk. On the byte level a bucket is scanned in
NumPy blocks; the levels below, with their large alphabets, group characters
into classes for the queue, or are induced within one list of buckets if that
fits into the memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Rows that are scanned at once.
BLOCK = 1 << 18
#: Bytes of a level below the bytes, for each of its suffixes, by which it is told whether it fits into memory.
ROW = 64


class BucketQueue:
    """First-in-first-out buckets of rows of `width` integers, backed by files beyond `memory` bytes."""

    def __init__(self, folder: str, memory: int, width: int = 2):
        self.folder, self.memory, self.width = tempfile.mkdtemp(dir=folder), memory, width
        self.held: dict[int, list[np.ndarray]] = {}
        self.bytes = 0
        self.spilled: set[int] = set()

    def _path(self, bucket: int) -> str:
        return os.path.join(self.folder, str(bucket))

    def push(self, bucket: int, rows: np.ndarray) -> None:
        self.held.setdefault(bucket, []).append(rows)
        self.bytes += rows.nbytes
        if self.bytes > self.memory:
            for b, parts in self.held.items():
                with open(self._path(b), "ab") as out:
                    for part in parts:
                        out.write(np.ascontiguousarray(part, np.int64).tobytes())
                self.spilled.add(b)
            self.held, self.bytes = {}, 0

    def blocks(self, bucket: int) -> Iterator[np.ndarray]:
        """The rows of a bucket, which is emptied; rows pushed meanwhile are for the next call."""
        parts = self.held.pop(bucket, [])
        self.bytes -= sum(p.nbytes for p in parts)
        if bucket in self.spilled:
            self.spilled.discard(bucket)
            path = self._path(bucket)
            os.rename(path, path + ".read")
            with open(path + ".read", "rb") as rows:
                while data := rows.read(BLOCK * 8 * self.width):
                    yield np.frombuffer(data, np.int64).reshape(-1, self.width)
            os.remove(path + ".read")
        if parts:
            rows = np.concatenate(parts) if len(parts) > 1 else parts[0]
            for at in range(0, len(rows), BLOCK):
                yield rows[at : at + BLOCK]

    def backwards(self, bucket: int) -> Iterator[np.ndarray]:
        """The rows of a bucket from the last to the first, which is emptied; a row's second value becomes that of the row before it here.

        With prefixes shared with the row below, that gives those shared with
        the row above. The first row's is left at 0.
        """
        carried = 0
        for rows in self._backwards(bucket):
            turned = np.stack([rows[:, 0], np.append(carried, rows[:-1, 1])], axis=1)
            carried = int(rows[-1, 1])
            yield turned

    def _backwards(self, bucket: int) -> Iterator[np.ndarray]:
        parts = self.held.pop(bucket, [])
        self.bytes -= sum(p.nbytes for p in parts)
        for part in reversed(parts):
            for end in range(len(part), 0, -BLOCK):
                yield part[max(0, end - BLOCK) : end][::-1]
        if bucket in self.spilled:
            self.spilled.discard(bucket)
            with open(self._path(bucket), "rb") as rows:
                size = 8 * self.width
                end = os.fstat(rows.fileno()).st_size // size
                while end:
                    start = max(0, end - BLOCK)
                    rows.seek(start * size)
                    yield np.frombuffer(rows.read((end - start) * size), np.int64).reshape(-1, self.width)[::-1]
                    end = start
            os.remove(self._path(bucket))

    def __contains__(self, bucket: int) -> bool:
        return bucket in self.held or bucket in self.spilled


def stored(array: np.ndarray, folder: str, memory: int) -> np.ndarray:
    """The array, mapped from a file if it exceeds the memory."""
    if array.nbytes <= memory:
        return array
    handle, path = tempfile.mkstemp(dir=folder)
    os.close(handle)
    mapped = np.memmap(path, array.dtype, "w+", shape=array.shape)
    mapped[:] = array
    return mapped


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour; the last, a sentinel, counts as such."""
    n = len(text)
    steps = np.arange(n - 1)
    differs = text[:-1] != text[1:]
    following = np.minimum.accumulate(np.where(differs, steps, n)[::-1])[::-1]
    types = np.ones(n, bool)
    types[:-1] = text[following] < text[following + 1]  # the sentinel differs from all before it
    return types


def lms_names(text: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order; names are ordered as the substrings are.

    Refines ranks by as many characters at once as a word holds. A substring
    that ends counts as greater than one that goes on, since its last character
    is of type S.
    """
    m = len(lms)
    length = np.append(np.diff(lms) + 1, 1)
    top = int(text.max()) + 1
    bits = top.bit_length()
    at_once = 63 // bits
    rank = np.zeros(m, np.int64)
    active, depth = np.arange(m), 0
    while len(active):
        begin, size = lms[active], length[active]
        word = np.zeros(len(active), np.int64)
        for k in range(depth, depth + at_once):
            char = text[np.minimum(begin + k, len(text) - 1)].astype(np.int64)
            word = (word << bits) | np.where(k < size, char, top)
        order = np.lexsort((word, rank[active])) if depth else np.argsort(word, kind="stable")
        depth += at_once
        active, word, ended = active[order], word[order], size[order] < depth
        before = rank[active]
        first_of_bucket = np.concatenate([[True], before[1:] != before[:-1]])
        first = first_of_bucket | np.concatenate([[True], word[1:] != word[:-1]])
        spot = np.arange(len(active))
        within = spot - np.maximum.accumulate(np.where(first_of_bucket, spot, 0))
        rank[active] = np.maximum.accumulate(np.where(first, before + within, 0))
        alone = first & np.append(first[1:], True)
        active = active[~(ended | alone)]
    return rank


def in_place(text: np.ndarray, types: np.ndarray, seeds: np.ndarray, n_chars: int) -> np.ndarray:
    """Positions of all suffixes in order, induced from the sorted LMS suffixes `seeds` within one list of buckets."""
    n = len(text)
    counts = np.bincount(text, minlength=n_chars)
    ends = np.cumsum(counts)
    by_char = seeds[np.argsort(text[seeds], kind="stable")]
    of_char = np.bincount(text[seeds], minlength=n_chars)
    slots = np.full(n, -1)
    slots[np.arange(len(seeds)) + np.repeat(ends - np.cumsum(of_char), of_char)] = by_char  # at their buckets' ends
    order = slots.tolist()
    for down in (False, True):
        bucket = np.full(n + 1, -1)  # that of the left neighbour if it is of the type to induce; the last is for empty slots
        bucket[1:n] = np.where(types[:-1] == down, text[:-1], -1)
        target = bucket.tolist()
        free = (ends - 1 if down else ends - counts).tolist()
        step = -1 if down else 1
        for i in reversed(order) if down else order:  # filled ahead of where it is read
            c = target[i]
            if c >= 0:
                order[free[c]] = i - 1
                free[c] += step
    return np.array(order, np.int64)


def suffix_order(text: np.ndarray, folder: str, memory: int) -> np.ndarray:
    """Positions of all suffixes in order, for integers of any size; the last one is a unique least sentinel."""
    n = len(text)
    distinct = np.unique(text)
    if len(distinct) == n:
        return np.argsort(text, kind="stable")
    text = np.searchsorted(distinct, text)
    types = s_types(text)
    lms = np.flatnonzero(types[1:] & ~types[:-1]) + 1
    sources = lms[suffix_order(lms_names(text, lms), folder, memory)] if len(lms) > 1 else lms
    if n * ROW <= memory:
        return in_place(text, types, sources, len(distinct))
    per_class = max(1, -(-len(distinct) // 1024))
    chars = text.tolist()
    classes_of = (text // per_class).tolist()
    last = (len(distinct) - 1) // per_class

    def scan(seeds: np.ndarray, down: bool) -> list[int]:
        """Induce one type; `seeds` are sorted suffixes of the other, all of which push."""
        queue = BucketQueue(folder, memory, 1)
        pushed = np.full(n, -1)  # the left neighbour that a suffix pushes
        pushed[1:] = np.where(types[:-1] == down, np.arange(n - 1), -1)
        pushes = pushed.tolist()
        by_char = seeds[np.argsort(text[seeds], kind="stable")]
        present, begin = np.unique(text[by_char], return_index=True)
        groups = dict(zip(present.tolist(), np.split(by_char, begin[1:]), strict=True))
        out: list[int] = []
        later: list[list[int]] = [[] for _ in range(last + 1)]
        waiting = 0
        for k in range(last, -1, -1) if down else range(last + 1):
            here: dict[int, list[int]] = {c: [] for c in range(k * per_class, min((k + 1) * per_class, len(distinct)))}
            for rows in queue.blocks(k):
                for i in rows[:, 0].tolist():
                    here[chars[i]].append(i)
            arrived, later[k] = later[k], []
            waiting -= len(arrived)
            for i in arrived:
                here[chars[i]].append(i)
            before = len(out)
            for c in reversed(here) if down else here:
                bucket = here[c]
                for i in bucket:  # grows while it is read
                    p = pushes[i]
                    if p >= 0:
                        if classes_of[p] == k:
                            here[chars[p]].append(p)
                        else:
                            later[classes_of[p]].append(p)
                out += bucket
                if c in groups:
                    for i in groups[c].tolist():
                        p = pushes[i]
                        if p >= 0:
                            if classes_of[p] == k:
                                here[chars[p]].append(p)
                            else:
                                later[classes_of[p]].append(p)
                            waiting += 1
            waiting += len(out) - before
            if waiting > BLOCK:  # to the disk-backed queue, in order of arrival
                for b, some in enumerate(later):
                    if some:
                        queue.push(b, np.array(some, np.int64)[:, None])
                        later[b] = []
                waiting = 0
        return out

    ell = np.array(scan(sources, False), np.int64)
    ess = np.array([*scan(ell[::-1], True)], np.int64)
    ess = np.append(ess, n - 1)  # the sentinel comes first of all
    both = np.concatenate([ell, ess[::-1]])
    kind = np.concatenate([np.zeros(len(ell), np.int8), np.ones(len(ess), np.int8)])
    return both[np.lexsort((np.arange(n), kind, text[both]))]


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix lengths of suffix pairs of a byte text that is padded by `limit` + 8 bytes, up to `limit`."""
    words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    out = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    for at in range(0, limit, 8):
        x = words[a[active] + at] ^ words[b[active] + at]
        same = x == 0
        out[active[same]] += 8
        rest = x[~same]
        if len(rest):
            out[active[~same]] += np.argmax(rest.view(np.uint8).reshape(-1, 8) != 0, axis=1)
        active = active[same]
        if not len(active):
            break
    return np.minimum(out, limit)


class _Scan:
    """One induction over a byte text: keeps, for each bucket, the least common prefix since its last push."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queue: BucketQueue, limit: int):
        self.text, self.wanted, self.queue, self.limit = text, wanted, queue, limit
        self.since = np.zeros(256, np.int64)  # nothing pushed yet: nothing shared

    def source(self, rows: np.ndarray) -> None:
        """Scan suffixes in order; rows are (position, prefix shared with the suffix scanned before)."""
        at, shared = rows[:, 0], rows[:, 1]
        before = at - 1
        pushing = np.flatnonzero((at > 0) & self.wanted[before])
        lowest = int(shared.min())
        bucket = self.text[before[pushing]]
        for b in np.unique(bucket).tolist():
            spots = pushing[bucket == b]
            least = np.empty(len(spots), np.int64)
            least[0] = min(int(self.since[b]), int(shared[: spots[0] + 1].min()))
            if len(spots) > 1:
                least[1:] = np.minimum.reduceat(shared, np.append(spots[:-1] + 1, spots[-1] + 1) if spots[-1] + 1 < len(shared) else spots[:-1] + 1)[: len(spots) - 1]
                if spots[-1] + 1 >= len(shared):  # the last segment ran to the end: cut it at its push
                    least[-1] = shared[spots[-2] + 1 : spots[-1] + 1].min()
            known = self.since[b] >= 0
            carried = np.minimum(least + 1, self.limit)
            if not known:
                carried[0] = 0
            self.queue.push(b, np.stack([before[spots], carried], axis=1))
            tail = shared[spots[-1] + 1 :]
            self.since[b] = int(tail.min()) if len(tail) else self.limit
        quiet = np.ones(256, bool)
        quiet[np.unique(bucket)] = False
        self.since[quiet & (self.since >= 0)] = np.minimum(self.since[quiet & (self.since >= 0)], lowest)


def sorted_suffixes(text: np.ndarray, limit: int, memory: int = 1 << 27, folder: str | None = None) -> Iterator[np.ndarray]:
    """Blocks of (position, common prefix with the suffix before, up to `limit`) in suffix order.

    `text` holds bytes from 1 to 254 and ends with a 0.
    """
    with tempfile.TemporaryDirectory(dir=folder) as work:
        n = len(text)
        if n == 1:
            yield np.array([[0, 0]])
            return
        types = s_types(text)
        lms = np.flatnonzero(types[1:] & ~types[:-1]) + 1
        lms = lms[suffix_order(lms_names(text, lms), work, memory)] if len(lms) > 1 else lms
        padded = stored(np.concatenate([text, np.zeros(limit + 8, np.uint8)]), work, memory)
        shared = np.append(0, common(padded, lms[:-1], lms[1:], limit))
        seeds = np.split(np.stack([lms, shared], axis=1), np.searchsorted(text[lms], np.arange(1, 256)))

        def joined(rows: np.ndarray, last: int) -> np.ndarray:
            """Rows whose first one states what it shares with the suffix `last`, if any."""
            rows = rows.copy()
            rows[0, 1] = common(padded, np.array([last]), rows[:1, 0], limit)[0] if last >= 0 else 0
            return rows

        pending = BucketQueue(work, memory)
        down_sources = BucketQueue(work, memory)
        results = BucketQueue(work, memory)
        scan = _Scan(text, ~types, pending, limit)
        scan.since[:] = -1
        for c in range(256):
            last = -1
            while c in pending:
                for rows in pending.blocks(c):
                    if last < 0:
                        rows = joined(rows, -1)
                    last = int(rows[-1, 0])
                    down_sources.push(c, rows)
                    results.push(2 * c, rows)
                    scan.source(rows)
            if len(seeds[c]):
                scan.source(joined(seeds[c], last))
        pending_s = BucketQueue(work, memory)
        scan = _Scan(text, types, pending_s, limit)
        scan.since[:] = -1
        for c in range(255, -1, -1):
            last = -1
            while c in pending_s:
                for rows in pending_s.blocks(c):
                    if last < 0:
                        rows = joined(rows, -1)
                    last = int(rows[-1, 0])
                    results.push(2 * c + 1, rows)
                    scan.source(rows)
            for k, rows in enumerate(down_sources.backwards(c)):
                scan.source(rows if k else joined(rows, last))
        yield np.array([[n - 1, 0]])
        for c in range(256):
            last = -1
            for rows in results.blocks(2 * c):
                last = int(rows[-1, 0])
                yield rows
            for k, rows in enumerate(results.backwards(2 * c + 1)):
                yield rows if k else joined(rows, last)
