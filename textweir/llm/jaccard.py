"""Near-duplicates by the Jaccard similarity of word shingles, exactly.

Two sets of `a` and `b` shingles with similarity 0.8 or more share at least
0.8 of either. So if the shingles of a set are put in an order that is the same
for all sets, the first n - ceil(0.8 n) + 1 of each hold a common one. The
order is rarest first: shingles that occur once lead and match nothing, so
a set with more than a fifth of such shingles has no near-duplicate and goes
before any pair is made, and passages that many texts hold come last.

SimHash comes first: of the sets that may have a near-duplicate, those whose
fingerprints differ in two bits at most, by op8's one-wildcard variants, are
verified by their shingles and linked. Fingerprints miss most links at 0.8, so
the exact join below then finds all that are left.

Sets that share such a leading shingle form a bucket. Groups are connected
components, so links between members of one component needn't be looked for:
each bucket is first compared with two of its members, and then only pairs
across components are, each with a member outside the bucket's largest one.
Every pair that can be a link is so either verified or already connected.
Pairs whose bitmaps differ in more bits than linked sets differ in shingles
are ruled out in the join itself, so that texts of one template, which share
rare shingles without being alike, are not written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from textweir.llm.common import NULL_ID, Scratch, slices
from textweir.llm.components import components
from textweir.llm.simhash import SEED, fingerprint, least_of_each
from textweir.llm.simhash import links as alike

#: Words of a shingle; texts are linked if their sets have a similarity of 4/5 or more (written out in whole numbers below).
SHINGLE = 5
#: Bytes of text whose shingles are worked out at once.
SLICE_BYTES = 1 << 20
#: Bits of the maps by which pairs are ruled out.
BITS = 1024
_ONE = np.uint64(1)
#: The shingles of a set of `n` that a near-duplicate must share.
_SHARED = "cast((4 * n + 4) div 5 as int)"


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashed shingles of a text, sorted; a text of fewer words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= size:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(words) - size + 1))


def _name(found: np.ndarray) -> int:
    return xxh64_intdigest(found.tobytes(), SEED) if len(found) else 0


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    for batch in slices(batches, "text", SLICE_BYTES):
        found = [shingles(x.as_py()) for x in batch.column("text")]
        yield batch, found, np.fromiter(map(_name, found), np.uint64, len(found)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, found, names in _named(batches):
        columns = [batch.column("doc_id"), pa.array(names), pa.array(map(len, found), pa.int32()), pa.array([int((~x & _ONE).sum()) for x in found], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig", "n", "half"])


def _half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The even shingles of each text."""
    for _, found, names in _named(batches):
        even = [x[x & _ONE == 0] for x in found]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(even).view(np.int64)), pa.array(np.repeat(names, [len(x) for x in even]))], names=["h", "sig"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch, _, names in _named(batches):
        z = [pack((x.as_py() or "").encode("utf-8", "surrogatepass")) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(z, pa.binary())], names=["sig", "z"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "z", SLICE_BYTES // 4):
        found = [shingles(unpack(z.as_py()).decode("utf-8", "surrogatepass")) for z in batch.column("z")]
        sigs = np.repeat(batch.column("sig").to_numpy(), [len(x) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(sigs)], names=["h", "sig"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprint of a text of each set."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "z", SLICE_BYTES // 4):
        found = np.fromiter((fingerprint(unpack(z.as_py()).decode("utf-8", "surrogatepass")) for z in batch.column("z")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(found.view(np.int64))], names=["sig", "fp"])


def marked(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of sets (sig, z) whose fingerprints are linked: each with the least of its own fingerprint, and these with each other."""
    marks = scratch.keep(texts.mapInArrow(_marks, "sig bigint, fp bigint"), "marks")
    least = scratch.keep(marks.groupBy("fp").agg(F.min("sig").alias("lead")), "leads")
    own = marks.join(least.hint("merge"), "fp").where("sig <> lead").select(F.col("sig").alias("a"), F.col("lead").alias("b"))
    a, b = (least.select(F.col("fp").alias(x), F.col("lead").alias(f"lead_{x}")) for x in "ab")
    near = alike(least.select("fp"), scratch).join(a.hint("merge"), "a").join(b.hint("merge"), "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    return own.unionByName(near)


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
        columns = [batch.column("sig"), pa.array(lone.astype(np.int32)), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(BITS // 64))]
        yield pa.RecordBatch.from_arrays(columns, names=["sig", "lone", *(f"b{i}" for i in range(BITS // 64))])


def links(slim: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of the sets `sig` that have a near-duplicate; `sizes` holds the number `n` of shingles of each, and of even ones."""

    def shared(members: DataFrame, name: str) -> DataFrame:
        # A table, so that both sides of the join are plain shuffles, whose hot keys adaptive execution can split.
        return scratch.keep(members.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), name)

    # The even half of the shingles shows of most sets that more than a fifth of all occur once: only the others are looked at whole.
    half = slim.select("text").mapInArrow(_half, "h bigint, sig bigint")
    seen = shared(half, "shared-half")
    seen = scratch.keep(half.join(seen, "h").select("sig", "h").groupBy("sig").agg(F.count_distinct("h").alias("seen")), "seen")
    hopeful = scratch.keep(sizes.join(seen, "sig", "left").where(f"n > 0 and half - coalesce(seen, 0) <= n - {_SHARED}").select("sig"), "hopeful")
    texts = slim.select("text").mapInArrow(_packed, "sig bigint, z binary").join(hopeful, "sig", "left_semi")
    texts = scratch.keep(texts.groupBy("sig").agg(F.first("z").alias("z")), "texts")
    members = texts.mapInArrow(_members, "h bigint, sig bigint")
    times = shared(members, "shared")
    found = members.join(times, "h").select("sig", "times", "h")
    sizes = sizes.select("sig", "n")
    near = found.groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("times", "h"))).alias("o")).join(sizes, "sig")
    near = near.where(f"size(o) >= {_SHARED}").select("sig", "n", F.expr("transform(o, x -> x.h)").alias("hs"))
    near = scratch.keep(near, "near")
    keys = near.select("sig", "n", F.explode(F.expr(f"slice(hs, 1, size(hs) - {_SHARED} + 1)")).alias("h"))
    buckets = keys.groupBy("h").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).where("low < high")
    keys = scratch.keep(keys.join(buckets, "h"), "keys")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"pairs-{name}")
        a, b = (near.select(F.col("sig").alias(x), F.col("n").alias(f"n_{x}"), F.col("hs").alias(f"hs_{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b").where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
        return scratch.keep(both.where("9 * size(array_intersect(hs_a, hs_b)) >= 4 * (n_a + n_b)").select("a", "b"), f"links-{name}")

    edges = verified(marked(texts.join(near.select("sig").hint("shuffle_hash"), "sig", "left_semi"), scratch), "marks")
    edges = edges.unionByName(verified(keys.where("sig <> low").select(F.col("sig").alias("a"), F.col("low").alias("b")), "low"))
    edges = edges.unionByName(verified(keys.where("sig <> high").select(F.col("sig").alias("a"), F.col("high").alias("b")), "high"))
    roots = scratch.keep(components(edges, scratch), "roots")
    rooted = keys.select("h", "sig", "n").join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    rooted = scratch.keep(rooted, "rooted")
    parts = rooted.groupBy("h", "root").count().groupBy("h").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.count(F.lit(1)).alias("parts"))
    mixed = scratch.keep(parts.where("parts > 1").join(rooted, "h").select("h", "sig", "n", "root", "largest"), "mixed")
    bits = [f"b{i}" for i in range(BITS // 64)]
    maps = near.join(mixed.select("sig").distinct(), "sig", "left_semi").select("sig", "n", "hs")
    maps = scratch.keep(maps.mapInArrow(_bitmaps, f"sig bigint, lone int, {', '.join(f'{b} bigint' for b in bits)}"), "bitmaps")
    mapped = scratch.keep(mixed.join(maps.hint("merge"), "sig"), "mapped")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("n", "root", "lone", *bits)]
    a = mapped.where("root <> largest").select("h", F.col("sig").alias("a"), *side("a"))
    b = mapped.select("h", F.col("sig").alias("b"), *side("b"))
    apart = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in bits)
    like = F.expr(f"root_a <> root_b and 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b) and 9 * (lone_a + lone_b + {apart}) <= n_a + n_b")
    across = a.join(b, "h").where(like).select("a", "b")
    return components(edges.unionByName(verified(across, "across")), scratch)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every row of `docs`.

    component_id is the smallest doc_id that can be reached over links. Texts
    with equal sets are one, those without words among them; a row without an
    id gets its component's smallest id, or null if none has one.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = scratch.keep(slim.mapInArrow(_sets, "doc_id bigint, sig bigint, n int, half int"), "made")
    sets = scratch.keep(made.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("half").alias("half")), "sets")
    linked = scratch.keep(links(slim, sets.select("sig", "n", "half"), scratch), "linked")
    linked = sets.join(linked.withColumnRenamed("node", "sig"), "sig")
    roots = linked.groupBy("root").agg(F.min(F.coalesce("least", F.lit(NULL_ID))).alias("component"))
    of_set = sets.join(linked.select("sig", "root").join(roots, "root").select("sig", "component"), "sig", "left").select(
        "sig", F.nullif(F.coalesce("component", "least"), F.lit(NULL_ID)).alias("component_id")
    )
    return made.join(of_set, "sig").select("doc_id", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each group of near-duplicates is kept; see `least_of_each`."""
    return least_of_each(docs, near_duplicates(docs))
