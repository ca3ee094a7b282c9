"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Two fingerprints with at
most two differing bits have a segment that differs in one bit at most, so
they share one of its 32 one-wildcard variants. Distinct fingerprints are
indexed under their 64 variants, joined on equal variants and verified.

A variant shared by more than `bucket` fingerprints (a large group of near
copies) would give all pairs of the group. Its members take an exact way that
needs no pairs: two fingerprints differ in at most two bits exactly if they
have a point at distance one or less from both, so each is joined to the 65
points around it, and a point has 65 fingerprints around it at most.

All joins are shuffles at every size: what they join grows with the input, and
Spark estimates exploded variants by the table they come from, a 64th of them,
so it would broadcast them through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from textweir.llm.common import NULL_ID, Scratch
from textweir.llm.components import components

SEED = 42
SHINGLE = 3
#: Pairs are joined directly in variants of up to so many fingerprints.
BUCKET = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; zero if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), "<u8", n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 255 * 64):
        part = hashes[start : start + 255 * 64]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for at in range(0, len(part), 255):  # sums of 255 rows fit a byte
            counts += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(x.as_py()) for x in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])


def links(fps: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp`: each differs in two bits at most, and all such are connected."""
    segment = "if(i < 32, fp & 4294967295L, shiftrightunsigned(fp, 32))"
    variants = fps.select("fp").withColumn(
        "key", F.explode(F.expr(f"transform(sequence(0, 63), i -> shiftleft(cast(i as bigint), 32) | ({segment} & ~shiftleft(1L, pmod(i, 32))))"))
    )
    sizes = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = scratch.keep(variants.join(sizes.hint("merge"), "key"), "shared")
    few = shared.where(F.col("n") <= bucket)
    a, b = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = a.join(b.hint("merge"), "key").where("a < b and bit_count(a ^ b) <= 2").select("a", "b")
    points = (
        shared.where(F.col("n") > bucket)
        .select("fp")
        .distinct()
        .withColumn("point", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")))
    )
    hubs = points.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = points.join(hubs.hint("merge"), "point").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    component_id is the smallest doc_id that can be reached over links of at
    most two differing bits. Null and wordless texts have fingerprint zero
    and are linked like any other; a row without an id gets its component's
    smallest id, or null if none has one; rows that repeat an id each count;
    texts of any length are read whole, one at a time; an empty table gives no
    rows; columns other than doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")
    made = scratch.keep(made, "fingerprints")
    fps = scratch.keep(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(links(fps, scratch, bucket), scratch)
    linked = scratch.keep(fps.join(linked.withColumnRenamed("node", "fp").hint("merge"), "fp"), "linked")
    roots = linked.groupBy("root").agg(F.min(F.coalesce("least", F.lit(NULL_ID))).alias("component"))
    of_fp = fps.join(linked.join(roots.hint("merge"), "root").select("fp", "component").hint("merge"), "fp", "left").select(
        "fp", F.nullif(F.coalesce("component", "least"), F.lit(NULL_ID)).alias("component_id")
    )
    return made.join(of_fp.hint("merge"), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each group of near-duplicates is kept; see `least_of_each`."""
    return least_of_each(docs, near_duplicates(docs, bucket))


def least_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of `docs` that stay when one document of each of `groups` (doc_id, component_id) is kept.

    The document with the group's smallest doc_id stays. Rows that repeat an id
    count as one document, of which one row stays; rows without an id stay, as
    nothing can tell them apart from the rest.
    """
    groups = Scratch(docs.sparkSession, "groups").keep(groups, "groups")
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    # A shuffle at every size: the ids that go grow with the input, so they are never broadcast.
    kept = docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    repeats = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeats:
        named = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.where("doc_id is null"))
    return kept
