"""Collocations: phrases whose parts seldom occur without each other, for each language.

Each task counts the runs of up to four words of its shard in a trie of depth
four below the language. A trie is kept as its sorted leaves, front-coded: a
leaf holds the level at which it leaves the one before and the words from
there on; what a node counts is the sum of the leaves below it. Tries of
bounded size are cut into blocks, and a range of paths brings the shards'
blocks together, sorted by their first paths. There they are merged: what lies
before the first path of the next block is final, so that a task holds the
blocks that overlap and no more, however many there are.

In the merged trie the counts of a phrase's first parts stand on the walk to
it. A node that goes on beyond a range's end is counted in parts, which are
added up apart. The counts of last parts come over suffix links: a phrase is
joined to the phrase without its first word, which holds those of its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.llm.common import Scratch

DEPTH = 4
LEAST = 30
#: A candidate goes if a longer one holds it and has so many hundredths of its occurrences.
WITHIN = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"
#: Bytes of text in a shard's trie and of a text that is split at once; leaves of a block and of a merge.
SHARD_BYTES, TEXT_BYTES, BLOCK_LEAVES, MERGE_LEAVES = 4 << 20, 1 << 21, 1 << 15, 1 << 19
#: Bytes of text for each range of paths, ranges at most, and picked paths for each range.
RANGE_BYTES, MOST_RANGES, PICKS = 16 << 20, 1 << 16, 64

#: Ends a piece: a byte that stands in no UTF-8 text.
_END = b"\xff"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_BLOCK = "part int, first array<binary>, leaves binary"
_NODE = "lang string, phrase string, k int, n bigint, l1 bigint, l2 bigint, l3 bigint, whole boolean"

Path = tuple[bytes, ...]


def split(text: bytes) -> bytes:
    """A text in lower case, with a mark after each piece."""
    return text.translate(_LOWER).replace(_END, b" \xff ")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    for batch in batches:
        langs, texts = batch.column("lang").cast(pa.binary()), batch.column("text").cast(pa.binary())
        for lang, text in zip(langs, texts, strict=True):
            yield lang.as_py(), text.as_py()


class Shard:
    """Texts up to a bounded size, of which a trie is made at once."""

    def __init__(self):
        self.texts: list[bytes] = []
        self.langs: list[bytes] = []
        self.ended: list[bool] = []
        self.size = 0

    def add(self, lang: bytes, marked: bytes, end: bool) -> None:
        """A stretch of a text; unless it is the last one, its last words are given again with the next and start no run here."""
        self.texts.append(marked)
        self.langs.append(lang)
        self.ended.append(end)
        self.size += len(marked)

    def leaves(self) -> tuple[list[bytes], pa.Array, np.ndarray, np.ndarray]:
        """Sorted languages and words, the distinct paths as rows of places (0: the path ends) in order, and their counts."""
        lists = pa.compute.ascii_split_whitespace(pa.array(self.texts, pa.binary()).view(pa.string()))
        words, ids = _ranked([lists.flatten().view(pa.binary())])
        sizes = np.diff(lists.offsets.to_numpy())
        ids, text = ids[0], np.repeat(np.arange(len(sizes)), sizes)
        if len(words) and words[0].as_py() == b"":  # what blanks at a text's ends leave
            ids, text, words = ids[ids > 0] - 1, text[ids > 0], words.slice(1)
        ids = ids + np.int32(1)
        if len(words) and words[-1].as_py() == _END:
            ids[ids == len(words)] = 0
            words = words.slice(0, len(words) - 1)
        langs = sorted(set(self.langs))
        place = {x: i for i, x in enumerate(langs)}
        starts = np.ones(len(ids), bool)
        ends = np.cumsum(np.bincount(text, minlength=len(sizes)))
        for i in np.flatnonzero(~np.array(self.ended)):
            starts[max(ends[i] - DEPTH + 1, ends[i - 1] if i else 0) : ends[i]] = False
        lang = np.array([place[x] for x in self.langs], np.int32)[text] if len(text) else np.zeros(0, np.int32)
        at = np.flatnonzero(starts & (ids > 0))
        ids, text = np.r_[ids, np.zeros(DEPTH, ids.dtype)], np.r_[text, np.full(DEPTH, -1)]
        columns = [lang[at], ids[at]]
        for k in range(1, DEPTH):  # the end of a piece or text ends every run
            columns.append(np.where((columns[-1] > 0) & (text[at + k] == text[at]), ids[at + k], 0))
        return langs, words, *_summed(np.stack(columns), np.ones(len(at), np.int64), len(words) + 1, len(langs))


def _ranked(parts: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The sorted distinct values of some arrays, and the places of each array's values among them."""
    coded = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    order = pa.compute.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(pa.array(order)), np.split(rank[coded.indices.to_numpy()], np.cumsum([len(x) for x in parts])[:-1])


def _summed(columns: np.ndarray, counts: np.ndarray, words: int, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns in order (language, then words, with places below `langs` and `words`) with the sums of their counts."""
    n = columns.shape[1]
    if not n:
        return columns, counts
    place, word = int(n).bit_length(), int(max(words, langs)).bit_length()
    if 2 * place + word <= 63 and 2 * word + place <= 63:
        # Sorting numbers that hold parent, word and row is faster than sorting rows by several keys.
        parent, spots = columns[0].astype(np.int64), np.arange(n)
        for column in columns[1:]:
            key = (parent << (word + place)) | (column.astype(np.int64) << place) | spots
            key.sort()
            order, key = key & ((1 << place) - 1), key >> place
            new = np.r_[True, key[1:] != key[:-1]]
            parent = np.empty(n, np.int64)
            parent[order] = np.cumsum(new) - 1
    else:
        order = np.lexsort(columns[::-1])
        new = np.r_[True, (np.diff(columns[:, order], axis=1) != 0).any(axis=0)]
    first = np.flatnonzero(new)
    return columns[:, order[first]], np.add.reduceat(counts[order], first)


def pack(langs: list[bytes], words: pa.Array, rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted leaves as front-coded bytes: an own vocabulary, levels where leaves part, and what comes from there on."""
    n = rows.shape[1]
    if 16 * n > len(words):
        seen = np.zeros(len(words) + 1, bool)
        seen[rows[1:]] = True
        used, local = np.flatnonzero(seen), (np.cumsum(seen) - 1)[rows[1:]]
    else:
        used, local = np.unique(rows[1:], return_inverse=True)
    own = words.take(pa.array(used[used > 0] - 1))
    of_lang, lang = np.unique(rows[0], return_inverse=True)
    columns = [lang.astype(np.int32), *local.reshape(DEPTH, n).astype(np.int32)]
    level, kept = np.full(n, DEPTH, np.uint8), []
    differs = np.zeros(n, bool)
    differs[0] = True
    for k, column in enumerate(columns):
        before = differs.copy()
        differs[1:] |= column[1:] != column[:-1]
        level[differs & ~before] = k
        kept.append(column[differs].tobytes())
    level[0] = 0
    lengths = np.diff(np.frombuffer(own.buffers()[1], np.int32)[: len(own) + 1])
    names = pa.array([langs[i] for i in of_lang.tolist()], pa.binary())
    name_lengths = np.diff(np.frombuffer(names.buffers()[1], np.int32)[: len(names) + 1])
    data = [(a.buffers()[2] or b"") for a in (names, own)]
    parts = [name_lengths.tobytes(), bytes(data[0])[: name_lengths.sum()], lengths.tobytes(), bytes(data[1])[: lengths.sum()], level.tobytes(), *kept, counts.tobytes()]
    sizes = np.array([n, int(used[0] == 0), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))


def _strings(lengths: bytes, data: bytes) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.frombuffer(lengths, np.int32))].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def unpack(data: bytes) -> tuple[list[bytes], pa.Array, np.ndarray, np.ndarray]:
    """The languages, words (from place 1 on), rows and counts that were packed."""
    data = zstandard.ZstdDecompressor().decompress(data)
    head = 8 * (2 + 4 + 1 + DEPTH + 1 + 1)
    n, ends, *sizes = np.frombuffer(data[:head], np.int64).tolist()
    places = np.cumsum([head, *sizes]).tolist()
    names, name_data, lengths, word_data, level, *kept, counts = (data[a:b] for a, b in zip(places, places[1:], strict=False))
    level = np.frombuffer(level, np.uint8)
    rows = np.stack([np.frombuffer(x, np.int32)[np.cumsum(level <= k) - 1] for k, x in enumerate(kept)])
    if not ends:  # place 0 is the end of a path
        rows[1:] += 1
    return _strings(names, name_data).to_pylist(), _strings(lengths, word_data), rows, np.frombuffer(counts, np.int64)


class Words(Sequence):
    """Sorted words of an Arrow array, taken out singly, or all at once where most are looked at."""

    def __init__(self, own: pa.Array, looked_up: int = 0):
        self.own = own.to_pylist() if 64 * looked_up > len(own) else own

    def __len__(self) -> int:
        return len(self.own)

    def __getitem__(self, i: int) -> bytes:
        word = self.own[i]
        return word if isinstance(word, bytes) else word.as_py()


def _path(langs: list[bytes], words: Sequence[bytes], row: np.ndarray) -> Path:
    return (langs[row[0]], *(words[i - 1] for i in row[1:].tolist() if i))


def _lower_bound(bound: Path, langs: list[bytes], words: Sequence[bytes], rows: np.ndarray) -> int:
    """The first of the sorted rows that is not below `bound`."""
    low, high = 0, rows.shape[1]
    for k in range(DEPTH + 1):
        if k >= len(bound):
            return low  # the bound's path ends: its own leaf is the least one
        names, base = (words, 1) if k else (langs, 0)
        place = bisect_left(names, bound[k])
        low, high = low + int(np.searchsorted(rows[k, low:high], place + base, "left")), low + int(np.searchsorted(rows[k, low:high], place + base, "right"))
        if place == len(names) or names[place] != bound[k] or low == high:
            return low
    return low


def _blocks(batches: Iterator[pa.RecordBatch], bounds: list[Path]) -> Iterator[pa.RecordBatch]:
    """Tries of a shard's texts, cut at the bounds of ranges and into blocks of bounded size."""

    def cut(shard: Shard) -> Iterator[pa.RecordBatch]:
        langs, own, rows, counts = shard.leaves()
        words = Words(own, len(bounds))
        ends = [0, *(_lower_bound(b, langs, words, rows) for b in bounds), rows.shape[1]]
        made, held = [], 0
        for part, (start, end) in enumerate(zip(ends, ends[1:], strict=False)):
            for at in range(start, end, BLOCK_LEAVES):
                block = rows[:, at : min(end, at + BLOCK_LEAVES)]
                made.append((part, list(_path(langs, words, block[:, 0])), pack(langs, own, block, counts[at : min(end, at + BLOCK_LEAVES)])))
                held += block.shape[1]
                if held >= MERGE_LEAVES:
                    yield _batch(made, _BLOCK_TYPE)
                    made, held = [], 0
        if made:
            yield _batch(made, _BLOCK_TYPE)

    shard = Shard()
    for lang, text in _texts(batches):
        at, carried = 0, b""
        while at < len(text):
            stop = _blank_after(text, at + TEXT_BYTES)
            marked = carried + split(text[at:stop])
            at = stop
            shard.add(lang, marked, at >= len(text))
            if at < len(text):
                carried = b" ".join([*marked.rsplit(None, DEPTH - 1)[1 - DEPTH :], b""])
            if shard.size >= SHARD_BYTES:
                yield from cut(shard)
                shard = Shard()
    if shard.size:
        yield from cut(shard)


def _blank_after(text: bytes, at: int) -> int:
    """The next blank from `at` on, or the end."""
    return len(text) if at >= len(text) or (found := text.find(b" ", at)) < 0 else found


_BLOCK_TYPE = pa.schema([("part", pa.int32()), ("first", pa.list_(pa.binary())), ("leaves", pa.binary())])
_NODE_TYPE = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), *((c, pa.int64()) for c in ("n", "l1", "l2", "l3")), ("whole", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


class Merge:
    """Merges blocks of sorted leaves that come in the order of their first paths."""

    def __init__(self, least: int):
        self.least = least
        self.held: list[tuple] = []
        self.size = self.settled = 0
        self.low: Path = ()

    def add(self, block: tuple) -> None:
        self.held.append(block)
        self.size += block[2].shape[1]

    def full(self) -> bool:
        return self.size >= max(MERGE_LEAVES, 2 * self.settled)

    def merged(self) -> tuple[list[bytes], pa.Array, np.ndarray, np.ndarray]:
        """The held blocks as one, under one sorted vocabulary."""
        langs = sorted({x for block in self.held for x in block[0]})
        place = {x: i for i, x in enumerate(langs)}
        words, places = _ranked([block[1] for block in self.held])
        rows = []
        for (own_langs, _, block, _), own in zip(self.held, places, strict=True):
            rows.append(np.concatenate([np.array([place[x] for x in own_langs], np.int32)[block[:1]], np.r_[np.int32(0), own + np.int32(1)][block[1:]]]))
        counts = np.concatenate([b[3] for b in self.held])
        self.held = []
        return langs, words, *_summed(np.concatenate(rows, axis=1), counts, len(words) + 1, len(langs))

    def settle(self, high: Path | None, last: bool) -> Iterator[pa.RecordBatch]:
        """Give the nodes of all leaves below `high` (all there are if it is the last time); the others stay."""
        langs, own, rows, counts = self.merged()
        words = Words(own)
        cut = rows.shape[1] if last else _lower_bound(high, langs, words, rows)
        if cut:
            yield from self.nodes(langs, words, rows[:, :cut], counts[:cut], high)
            self.low = high
        self.held, self.size = [(langs, own, rows[:, cut:], counts[cut:])], rows.shape[1] - cut
        self.settled = self.size

    def nodes(self, langs: list[bytes], words: Sequence[bytes], rows: np.ndarray, counts: np.ndarray, high: Path | None) -> Iterator[pa.RecordBatch]:
        """Nodes with `least` occurrences and their first parts; those that a bound cuts are given in parts, whatever they count."""
        n = rows.shape[1]
        new = np.zeros(n, bool)
        new[0] = True
        totals, runs, found = [], [], []
        for k in range(DEPTH + 1):
            new[1:] |= rows[k, 1:] != rows[k, :-1]
            first = np.flatnonzero(new)
            totals.append(np.add.reduceat(counts, first))
            runs.append((np.cumsum(new, dtype=np.int32) - 1, first))
        # Of each level, only the first and the last run can go on beyond the bounds.
        open_ = [{int(run) for run in (0, len(totals[k]) - 1) if self._cut(_path(langs, words, rows[:, runs[k][1][run]]), k, high)} for k in range(DEPTH + 1)]
        for k in range(DEPTH + 1):
            first = runs[k][1]
            ends = rows[k, first] > 0 if k else np.ones(len(first), bool)
            wanted = set(np.flatnonzero((totals[k] >= self.least) & ends).tolist()) | {r for r in open_[k] if ends[r]}
            for run in sorted(wanted):
                at = first[run]
                lang, *phrase = _path(langs, words, rows[:, at])[: k + 1]
                lefts = [None, None, None]
                for j in range(1, k):
                    above = int(runs[j][0][at])
                    lefts[j - 1] = None if above in open_[j] else int(totals[j][above])
                # A language is always counted in parts.
                found.append((_text(lang), _text(b" ".join(phrase)), k, int(totals[k][run]), *lefts, k > 0 and run not in open_[k]))
        for at in range(0, len(found), 1 << 16):
            yield _batch(found[at : at + (1 << 16)], _NODE_TYPE)

    def _cut(self, path: Path, k: int, high: Path | None) -> bool:
        """Whether the node at level `k` on `path` may have leaves on both sides of a bound."""
        node = path[: k + 1]
        return any(bound and bound[: k + 1] == node for bound in (self.low, high))


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def _merged(batches: Iterator[pa.RecordBatch], bounds: list[Path], least: int) -> Iterator[pa.RecordBatch]:
    merge, part = Merge(least), None
    for batch in batches:
        for at, first, leaves in zip(*(batch.column(c) for c in ("part", "first", "leaves")), strict=True):
            if at.as_py() != part:
                if part is not None:
                    yield from merge.settle(bounds[part], True)
                part, merge = at.as_py(), Merge(least)
                merge.low = bounds[part - 1] if part else ()
            elif merge.full():
                yield from merge.settle(tuple(first.as_py()), False)
            merge.add(unpack(leaves.as_py()))
    if part is not None:
        yield from merge.settle(bounds[part] if part < len(bounds) else None, True)


def _picked(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """The path at every `step`-th byte of the texts."""
    until, rows = step // 2, []
    for lang, text in _texts(batches):
        while until < len(text):
            near = split(text[until : until + 400]).split()[1:]
            while near and near[0] == _END:
                near = near[1:]
            near = near[:DEPTH]
            rows.append(([lang, *(near[: near.index(_END)] if _END in near else near)],))
            until += step
        until -= len(text)
    if rows:
        yield _batch(rows, pa.schema([("path", pa.list_(pa.binary()))]))


def _bounds(slim: DataFrame) -> list[Path]:
    """Where ranges of paths begin that hold about equally many distinct ones; they set the layout, not the result."""
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, total // RANGE_BYTES))
    if ranges == 1:
        return []
    step = max(1, total // (PICKS * ranges))
    paths = sorted({tuple(bytes(x) for x in row[0]) for row in slim.mapInArrow(lambda b: _picked(b, step), "path array<binary>").collect()})
    return sorted({paths[i * len(paths) // ranges] for i in range(1, ranges)}) if paths else []


def counted(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """(lang, phrase, k, n, l1, l2, l3): every phrase of `k` words, 1 to 4, with `n` >= `least` occurrences, and how often its first one, two and three words occur; `k` = 0 counts a language's words."""
    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _bounds(slim)
    blocks = slim.mapInArrow(lambda b: _blocks(b, bounds), _BLOCK)
    ranged = blocks.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "first")
    nodes = scratch.keep(ranged.mapInArrow(lambda b: _merged(b, bounds, least), _NODE), "nodes")
    parts = nodes.where("not whole").groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))
    parts = scratch.keep(parts, "parts")
    none = F.lit(None).cast("bigint")
    found = nodes.where("whole").drop("whole").unionByName(parts.where((F.col("n") >= least) | (F.col("k") == 0)).select("*", *(none.alias(f"l{j}") for j in (1, 2, 3))))
    for j in (1, 2, 3):  # first parts that ranges' bounds cut
        of_part = parts.where(f"k = {j}").select(F.col("lang").alias("of_lang"), F.col("phrase").alias("first_words"), F.col("n").alias("of_part"))
        missing = (F.col("lang") == F.col("of_lang")) & (F.substring_index("phrase", " ", j) == F.col("first_words")) & (F.col("k") > j) & F.col(f"l{j}").isNull()
        found = found.join(of_part, missing, "left").withColumn(f"l{j}", F.coalesce(f"l{j}", "of_part")).drop("of_lang", "first_words", "of_part")
    return scratch.keep(found, "counted")


def linked(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Phrases of two words and more with the counts r1, r2 and r3 of what follows their first one, two and three words."""
    rest = F.expr("substr(phrase, instr(phrase, ' ') + 1)")
    none = F.lit(None).cast("bigint")
    below = nodes.where("k = 1").select("lang", "phrase", "n", none.alias("r1"), none.alias("r2"))
    levels = []
    for k in range(2, DEPTH + 1):
        link = below.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("rest"), F.col("n").alias("s1"), F.col("r1").alias("s2"), F.col("r2").alias("s3"))
        own = nodes.where(F.col("k") == k).join(link, (F.col("lang") == F.col("of_lang")) & (rest == F.col("rest")))
        below = own.select(*nodes.columns, F.col("s1").alias("r1"), F.col("s2").alias("r2"), F.col("s3").alias("r3"))
        below = scratch.keep(below, f"linked-{k}")
        levels.append(below)
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def collocations(docs: DataFrame, least: int = LEAST, within: int = WITHIN, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of two to four words.

    n counts the language's words, a the phrase's occurrences within pieces of
    texts, overlapping ones included. The cut with the lowest score
    floor(2000000 * a / (l + r)) counts (l, r: occurrences of its two sides),
    ties to the shortest first side. A candidate goes if a longer one holds its
    words and has `within` hundredths of its occurrences. Order: score and a
    descending, then the phrase by its bytes. Null texts count as empty, a null
    lang as `und`; repeated rows count each; texts of any length are read whole,
    2 MB at once; no documents or no candidates give no rows. Columns other
    than text and lang are not read. Bytes that are no UTF-8 are shown replaced.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    nodes = counted(docs, scratch, least)
    cuts = [F.when(F.col("k") > j, F.struct(F.expr(f"cast({SCALE} * cast(n as decimal(30,0)) as decimal(38,0)) div cast(l{j} + r{j} as decimal(38,0))").alias("score"), F.lit(j).alias("at"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r"))) for j in (1, 2, 3)]
    phrases = linked(nodes, scratch).withColumn("cut", F.array_min(F.array_compact(F.array(*cuts))))
    phrases = scratch.keep(phrases.select("lang", "phrase", "k", F.col("n").alias("a"), "cut.score", "cut.l", "cut.r"), "phrases")
    inner = "filter(flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' ')))), x -> x is not null)"
    held = phrases.where("k > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), F.col("a").alias("longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.join(held, ["lang", "phrase"], "left").where(f"longer is null or 100 * cast(longer as decimal(30,0)) < {within} * cast(a as decimal(30,0))")
    # First among a 64th of a language's phrases each, so that no task orders all of them.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", "share").orderBy(*order)
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    words = nodes.where("k = 0").select("lang", F.col("n"))
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, row_number() OVER () AS id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, range(1, {DEPTH} + 1) AS r(k)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= {LEAST}),
cut AS (SELECT lang, phrase, k, a, unnest(range(1, k)) AS cut_at, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
scored AS (SELECT cut.lang, cut.phrase, cut.k, cut.a, cut_at, l.a AS l, r.a AS r, CAST(CAST({SCALE} AS HUGEINT) * cut.a // (l.a + r.a) AS BIGINT) AS score
  FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:cut_at], ' ') JOIN f AS r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[cut_at + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
held AS (SELECT DISTINCT s.lang, s.phrase FROM f AS b, range(1, 4) AS i(i), range(2, 4) AS m(m), f AS s
  WHERE b.k > m AND i + m - 1 <= b.k AND s.lang = b.lang AND s.phrase = array_to_string(string_split(b.phrase, ' ')[i:i + m - 1], ' ') AND 100 * CAST(b.a AS HUGEINT) >= {WITHIN} * CAST(s.a AS HUGEINT))
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, encode(best.phrase)) AS rank, best.phrase, best.a, l, r, total.n, score
FROM best JOIN total ON total.lang = best.lang ANTI JOIN held ON held.lang = best.lang AND held.phrase = best.phrase QUALIFY rank <= {TOP}
"""
