"""Similarity join of shingle sets by a size-aware heavy-light scheme, exactly.

Two sets of a and b shingles have a Jaccard similarity of `part / whole` or
more if they share o(a, b) = ceil(part * (a + b) / (part + whole)) of them.
Small sets are joined by what they share: for each pair of sizes that can be
linked, a set gives all its subsets of o(a, b) shingles, and sets with an equal
subset are linked, whatever else they hold. No pairs are needed for that, as
the sets of one subset are linked to the first one on the other side. Large
sets have too many subsets; they scan inverted lists. Shingles stand in an
order that is the same for all sets, rarest first, and only the lists of a
set's leading ones are scanned, of which linked sets share one. The size
from which sets count as large is the one for which the subsets to give and
the list entries to scan are fewest, by counts of both for each size.

Groups are connected components, so links inside one needn't be looked for:
each list is first compared with two of its members, and then only across
components, with pairs that a bitmap of their shingles rules out dropped inside
the join. A list that would still give many pairs (texts of one template that
are not alike) is split by the next shingle that two linked sets would share,
and once more if need be, as linked sets share any number of leading shingles
in prefixes longer by as many.

Sets with many shingles that no other has are linked to none. A fixed share of
the hash range shows that of most of them, so that only the others' shingles
are joined in full. Equal sets are one from the start (128-bit digests of their
hashes); shingles are told by 64-bit hashes; every link is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from textweir.llm.common import NULL_ID, Scratch, slices
from textweir.llm.components import components
from textweir.llm.simhash import least_of_each

SEED = 42
#: Bytes of text whose shingles are worked out at once.
SLICE_BYTES = 4 << 20
#: Sets of this size and more always scan lists; lists are split so many times at most.
MOST_SMALL, SPLITS = 48, 2
#: A list is split if its pairs are more than so many times what splitting it gives.
WORTH = 32
#: Bits of the maps by which pairs are ruled out.
BITS = 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of a number moves every bit of its result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct hashed shingles of `size` words of each text, sorted; a text of fewer words is one shingle, one without words has none."""
    lists = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.compute.fill_null(texts.cast(pa.binary()), b"").view(pa.string())))
    words = lists.flatten().view(pa.binary()).dictionary_encode()
    hashes = np.fromiter((xxh64_intdigest(w, SEED) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    ids, text = words.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    blank = words.dictionary.index(b"").as_py()
    if blank >= 0:  # what blanks at a text's ends leave
        ids, text = ids[ids != blank], text[ids != blank]
    hashes = hashes[ids]
    ends = np.cumsum(np.bincount(text, minlength=len(texts)))
    runs = np.full(max(0, len(ids) - size + 1), size, np.uint64) * _GOLDEN
    for k in range(size):
        runs = mixed(runs + hashes[k : k + len(runs)])
    found = []
    for start, end in zip([0, *ends.tolist()], ends.tolist(), strict=False):
        if end - start >= size:
            found.append(np.unique(runs[start : end - size + 1]))
        else:
            whole = np.full(1, end - start, np.uint64) * _GOLDEN
            for k in range(start, end):
                whole = mixed(whole + hashes[k : k + 1])
            found.append(whole if end > start else whole[:0])
    return found


def _digest(found: np.ndarray) -> bytes:
    return xxh3_128_digest(found.tobytes(), SEED)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


@dataclass(frozen=True)
class Rule:
    """Sets of shingles of `size` words are linked if `whole` times their intersection is at least `part` times their union."""

    size: int = 3
    part: int = 90
    whole: int = 100

    def shared(self, a: int, b: int) -> int:
        return -(-self.part * (a + b) // (self.part + self.whole))

    def sizes(self, n: int) -> range:
        """Sizes that a set of `n` can be linked to."""
        return range(-(-self.part * n // self.whole), self.whole * n // self.part + 1)

    def subsets(self, n: int) -> int:
        """How many subsets a set of `n` gives."""
        return sum(comb(n, o) for m in self.sizes(n) if (o := self.shared(n, m)) <= min(n, m))

    @property
    def need(self) -> str:
        """SQL: how many shingles of a set of `n` any linked set has."""
        return f"cast(({self.part} * cast(n as bigint) + {self.whole - 1}) div {self.whole} as int)"

    @property
    def tenths(self) -> int:
        """Tenths of the hash range that show of most sets that they are linked to none."""
        return min(10, max(1, 20 * (self.whole - self.part) // self.whole))

    def alike(self, a: str, b: str) -> str:
        return f"{self.whole} * least({a}, {b}) >= {self.part} * greatest({a}, {b})"

    def linked(self, shared: str, total: str) -> str:
        return f"{self.part + self.whole} * {shared} >= {self.part} * ({total})"

    def apart(self, different: str, total: str) -> str:
        """SQL: whether sets may be linked that differ in so many shingles at least."""
        return f"{self.part + self.whole} * ({different}) <= {self.whole - self.part} * ({total})"


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        found = shingles(batch.column("text"), rule.size)
        some = [x[x % np.uint64(10) < np.uint64(rule.tenths)] for x in found]
        columns = [batch.column("uid"), batch.column("doc_id"), pa.array(map(_digest, found), pa.binary()), pa.array(map(len, found), pa.int32()), _lists(some)]
        yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "sig", "n", "some"])


def _whole(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        found = shingles(batch.column("text"), rule.size)
        yield pa.RecordBatch.from_arrays([pa.array(map(_digest, found), pa.binary()), _lists(found)], names=["sig", "hs"])


def subsets(rows: np.ndarray, n: int, rule: Rule, below: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For a set of `n` with the shared shingles `rows`: sizes (a <= b, both under `below`) and the keys of its subsets of o(a, b) shingles."""
    parts = mixed(rows)
    for m in rule.sizes(n):
        a, b = min(n, m), max(n, m)
        o = rule.shared(a, b)
        if b >= below or o > a or o > len(parts):
            continue
        total, gone = parts.sum(), len(parts) - o
        if not gone:
            keys = np.array([total], np.uint64)
        elif gone == 1:
            keys = total - parts
        else:
            places = np.fromiter((i for c in combinations(range(len(parts)), gone) for i in c), np.int64, gone * comb(len(parts), gone))
            keys = total - parts[places.reshape(-1, gone)].sum(axis=1)
        yield a, b, keys


def _subsets(batches: Iterator[pa.RecordBatch], rule: Rule, below: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        held = 0
        for node, n, hs in zip(*(batch.column(c) for c in ("node", "n", "hs")), strict=True):
            n = n.as_py()
            for a, b, keys in subsets(hs.values.to_numpy().view(np.uint64), n, rule, below):
                for column, value in zip(columns, (a * MOST_SMALL + b, int(n == b and a < b), node.as_py()), strict=False):
                    column.append(np.full(len(keys), value, np.int64))
                columns[3].append(keys.view(np.int64))
                held += len(keys)
            if held >= 1 << 17:
                yield _of_subsets(columns)
                columns, held = [[], [], [], []], 0
        if held:
            yield _of_subsets(columns)


def _of_subsets(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    sizes, side, node, key = (pa.array(np.concatenate(c)) for c in columns)
    return pa.RecordBatch.from_arrays([sizes.cast(pa.int32()), side.cast(pa.int32()), key, node], names=["sizes", "side", "key", "node"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set, how many of its shingles no other has, and the parity of the others' hashes in `BITS` bits."""
    for batch in batches:
        hs = batch.column("hs")
        sizes = np.diff(hs.offsets.to_numpy())
        flat = hs.flatten().to_numpy().view(np.uint64)
        place = np.repeat(np.arange(len(sizes)), sizes) * BITS + ((flat >> np.uint64(20)) % np.uint64(BITS)).astype(np.int64)
        odd = (np.bincount(place, minlength=len(sizes) * BITS) & 1).astype(np.uint8)
        words = np.packbits(odd.reshape(len(sizes), BITS), axis=1).view(np.int64)
        lone = batch.column("n").to_numpy() - sizes
        columns = [batch.column("node"), pa.array(lone.astype(np.int32)), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(BITS // 64))]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "lone", *(f"b{i}" for i in range(BITS // 64))])


class Join:
    """The links of distinct sets; `near` holds a row (node, n, hs, times) of each that may have one, `hs` being its shared shingles in order."""

    def __init__(self, near: DataFrame, rule: Rule, scratch: Scratch, most_small: int = MOST_SMALL, worth: int = WORTH):
        self.near, self.rule, self.scratch, self.worth = near, rule, scratch, worth
        # How many leading shingles a linked set shares one of.
        lead = F.expr(f"size(hs) - {rule.need} + 1")
        first = [F.slice(c, F.lit(1), lead + SPLITS).alias(c) for c in ("hs", "times")]
        spots = near.select("node", "n", lead.alias("lead"), F.posexplode(F.arrays_zip(*first)).alias("pos", "at"))
        self.prefix = scratch.keep(spots.select("node", "n", "lead", "pos", F.col("at.hs").alias("h"), F.col("at.times").alias("times")), "prefix")
        self.large = self.boundary(min(most_small, MOST_SMALL))

    def boundary(self, most: int) -> int:
        """The size from which sets scan lists, by the counts of subsets and of list entries that either way takes."""
        found = self.prefix.where(f"n < {most} and pos < lead").groupBy("n").agg(F.count_distinct("node").alias("sets"), F.sum("times").alias("scanned")).collect()
        give = {r["n"]: r["sets"] * self.rule.subsets(r["n"]) for r in found}
        scan = {r["n"]: r["scanned"] for r in found}
        return min(range(most + 1), key=lambda x: (sum(v for n, v in give.items() if n < x) + sum(v for n, v in scan.items() if n >= x), x))

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        pairs = self.scratch.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"pairs-{name}")
        a, b = (self.near.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("hs").alias(f"hs_{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b").where(self.rule.alike("n_a", "n_b"))
        return self.scratch.keep(both.where(self.rule.linked("size(array_intersect(hs_a, hs_b))", "n_a + n_b")).select("a", "b"), f"links-{name}")

    def of_small(self) -> DataFrame:
        """Links between small sets: each to the first one on the other side of every subset of theirs."""
        rule, large = self.rule, self.large
        keys = self.near.where(F.col("n") < large).select("node", "n", "hs").mapInArrow(lambda b: _subsets(b, rule, large), "sizes int, side int, key bigint, node bigint")
        keys = self.scratch.keep(keys, "subsets")
        sides = keys.groupBy("sizes", "key").agg(*(F.min(F.when(F.col("side") == s, F.col("node"))).alias(f"of_{s}") for s in (0, 1)), F.max("node").alias("last"))
        # Sets of one size have no sides: all are linked to the first.
        one = F.expr(f"sizes div {MOST_SMALL} = sizes % {MOST_SMALL}")
        sides = sides.where((one & F.expr("of_0 < last")) | F.expr("of_0 is not null and of_1 is not null"))
        other = F.when(one | (F.col("side") == 1), F.col("of_0")).otherwise(F.col("of_1"))
        return keys.join(sides, ["sizes", "key"]).select(F.col("node").alias("a"), other.alias("b")).where("a <> b")

    def of_large(self, edges: DataFrame) -> DataFrame:
        """Links with a large set, but for those between members of one component; `edges` holds what is known."""
        keys = self.prefix.where(f"pos < lead and n >= {self.rule.sizes(self.large).start}")
        lists = keys.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("n").alias("most")).where(f"low < high and most >= {self.large}")
        keys = self.scratch.keep(keys.select("node", "n", "lead", "pos", "h").join(lists.drop("most"), "h"), "keys")
        for end in ("low", "high"):
            edges = edges.unionByName(self.verified(keys.where(f"node <> {end}").select(F.col("node").alias("a"), F.col(end).alias("b")), end))
        roots = self.scratch.keep(components(edges, self.scratch), "roots")
        rooted = keys.drop("low", "high").withColumnRenamed("h", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        return edges.unionByName(self.verified(self.across(rooted), "across"))

    def across(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components that a list holds and no bitmap rules out; rows are (node, n, lead, pos, key, root)."""
        done = None
        for level in range(SPLITS + 1):
            parts = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("count"), F.sum(F.col("lead") + level - F.col("pos")).alias("next"), F.max("n").alias("most"))
            parts = parts.groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.max("count").alias("m"), F.sum("count").alias("c"), F.sum("next").alias("next"), F.count(F.lit(1)).alias("parts"), F.max("most").alias("most"))
            costly = F.expr(f"(c - m) * c > {self.worth} * (next + c)") if level < SPLITS else F.lit(False)
            parts = parts.where(f"parts > 1 and most >= {self.large}").select("key", "largest", costly.alias("costly"))
            rows = self.scratch.keep(rows.join(parts, "key"), f"lists-{level}")
            few = rows.where("not costly").select("key", "node", "n", "root", "largest")
            done = few if done is None else done.unionByName(few)
            if level == SPLITS or not rows.where("costly").limit(1).count():
                break
            nexts = self.prefix.select("node", F.col("pos").alias("at"), "h")
            rows = rows.where("costly").drop("largest", "costly").join(nexts, "node").where(f"at > pos and at < lead + {level + 1}")
            rows = rows.select("node", "n", "lead", F.col("at").alias("pos"), F.xxhash64(F.lit(level), "key", "h").alias("key"), "root")
        bits = [f"b{i}" for i in range(BITS // 64)]
        maps = self.near.join(done.select("node").distinct(), "node", "left_semi").select("node", "n", "hs")
        maps = self.scratch.keep(maps.mapInArrow(_bitmaps, f"node bigint, lone int, {', '.join(f'{b} bigint' for b in bits)}"), "bitmaps")
        done = self.scratch.keep(done.join(maps.hint("merge"), "node"), "mapped")
        side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("n", "root", "lone", *bits)]
        a = done.where("root <> largest").select("key", F.col("node").alias("a"), *side("a"))
        b = done.select("key", F.col("node").alias("b"), *side("b"))
        apart = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in bits)
        like = F.expr(f"root_a <> root_b and greatest(n_a, n_b) >= {self.large} and {self.rule.alike('n_a', 'n_b')} and {self.rule.apart(f'lone_a + lone_b + {apart}', 'n_a + n_b')}")
        return a.join(b, "key").where(like).select("a", "b")

    def components(self) -> DataFrame:
        """(node, root) of the sets that are linked to another."""
        edges = self.verified(self.of_small(), "small")
        return components(self.of_large(edges), self.scratch)


def _candidates(docs: DataFrame, made: DataFrame, sets: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """The distinct sets that may be linked to another, as rows of (node, n, hs, times)."""
    members = made.select("uid", F.xxhash64("sig").alias("name"), F.explode("some").alias("h"))
    # A table, so that both sides of the join are plain shuffles, whose hot keys adaptive execution can split.
    shared = scratch.keep(members.groupBy("h").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low <> high").select("h"), "shared-some")
    seen = scratch.keep(members.select("uid", "h").join(shared, "h").groupBy(F.col("uid").alias("node")).agg(F.count(F.lit(1)).alias("seen")), "seen")
    hopeful = scratch.keep(sets.join(seen, "node", "left").where(f"n_some - coalesce(seen, 0) <= n - {rule.need}").select("node", "sig", "n", "least"), "hopeful")
    ids = hopeful.where("least is not null").select(F.col("least").alias("doc_id")).distinct()
    texts = docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select("text")
    found = texts.mapInArrow(lambda b: _whole(b, rule), "sig binary, hs array<bigint>").join(hopeful.select("sig", "node", "n"), "sig")
    found = scratch.keep(found.groupBy("node", "n").agg(F.first("hs").alias("hs")), "found")
    members = found.select("node", "n", F.explode("hs").alias("h"))
    times = scratch.keep(members.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    ordered = members.join(times, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "h"))).alias("o")).where(f"size(o) >= {rule.need}")
    return scratch.keep(ordered.select("node", "n", F.expr("o.h").alias("hs"), F.expr("o.times").alias("times")), "near")


def similar(docs: DataFrame, rule: Rule | None = None, empty_apart: bool = True, most_small: int = MOST_SMALL, worth: int = WORTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`.

    component_id is the smallest doc_id that can be reached over links. Null and
    wordless texts have no shingles and are linked with nothing, or else
    (`empty_apart` false) with each other. A row without an id gets its component's
    smallest id, or null if none has one; rows that repeat an id count each;
    equal texts are linked. Texts of any length are read whole, one at a time; an
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    rule = rule or Rule()
    scratch = Scratch(docs.sparkSession, "setjoin")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = slim.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(lambda b: _sets(b, rule), "uid bigint, doc_id bigint, sig binary, n int, some array<bigint>")
    made = scratch.keep(made, "made")
    sets = made.groupBy("sig").agg(F.min("uid").alias("node"), F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max(F.size("some")).alias("n_some"))
    sets = scratch.keep(sets, "sets")
    near = _candidates(slim, made, sets.where("n > 0"), rule, scratch)
    linked = scratch.keep(Join(near, rule, scratch, most_small, worth).components(), "linked")
    linked = sets.join(linked, "node")
    roots = linked.groupBy("root").agg(F.min(F.coalesce("least", F.lit(NULL_ID))).alias("component"))
    of_set = sets.join(linked.select("node", "root").join(roots, "root").select("node", "component"), "node", "left").select("sig", F.nullif(F.coalesce("component", "least"), F.lit(NULL_ID)).alias("of_set"))
    alone: Column = (F.col("n") == 0) if empty_apart else F.lit(False)
    rows = made.select("doc_id", "sig", "n").join(of_set, "sig")
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("of_set")).alias("component_id"))


#: Near-duplicates: five-word shingles and a similarity of 0.8 or more.
NEAR = Rule(5, 4, 5)


def one_of_each(docs: DataFrame, rule: Rule = NEAR) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each group of similar ones is kept, texts without words being one; see `least_of_each`."""
    return least_of_each(docs, similar(docs, rule, empty_apart=False).select("doc_id", "component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(ws) - 1, 2)), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS ss FROM w),
x AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS h FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) + any_value(b.n) AS n FROM x AS a JOIN x AS b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 90 * (n - c)),
far AS (SELECT doc_id, doc_id AS to_ FROM documents UNION SELECT f.doc_id, l.to_ FROM far AS f JOIN (SELECT a AS from_, b AS to_ FROM links UNION ALL SELECT b, a FROM links) AS l ON l.from_ = f.to_)
SELECT s.doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, (SELECT min(to_) FROM far WHERE far.doc_id = s.doc_id) AS component_id FROM s
"""
