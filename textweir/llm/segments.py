"""Finding repeated windows across documents by anchored segments.

Every window of a text (of so many bytes or words) picks an anchor that
depends on its content alone. Equal windows so pick equal anchors, and a
maximal run of windows with one anchor is a segment, which is told by its
anchor and a digest of 96 bits. Only anchors that occur more than once can
hold repeated windows.

Equal segments are grouped by their digests with partial aggregation: all but
the first go, and no text of theirs is moved. An anchor with several distinct
segments has one of each compared by an exact method. If those have more than
`HOT` windows (a passage that a large share of all documents hold, each with
other text around it), no task could hold them: then the digests of single
windows are grouped instead, again with partial aggregation.

So a key is never gathered: counts, least owners and joins are all that
shuffles see of a hot one, and adaptive execution splits those joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import NULL_ID, Scratch

#: Bytes of distinct segments that are compared at once.
CHUNK_BYTES = 4 << 20
#: Windows of an anchor's distinct segments that one task may compare.
HOT = 1 << 14
#: What a mapper tells of a segment: anchor, digest, row, the row's order, first window, windows, and TWICE and AGAIN.
SEGMENT = "h bigint, s bigint, t int, uid bigint, ord bigint, start int, n int, flags int"
#: The anchor may occur twice in the segment; an equal segment begins earlier in the row.
TWICE, AGAIN = 1, 2
#: What becomes of a segment.
WHOLE, COMPARED, SINGLE = 0, 1, 2
Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def identified(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(uid, doc, doc_id, text): a unique row id in the order of the documents, and the id that orders them, where null comes last.

    Rows that repeat an id are numbered in one written table, so that every
    later pass sees the same numbers.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    doc = F.coalesce("doc_id", F.lit(NULL_ID))
    if slim.groupBy("doc_id").count().where("count > 1").isEmpty():
        return slim.select(doc.alias("uid"), doc.alias("doc"), "doc_id", "text")
    # The text's hash lets the ranges split an id that many rows share.
    ordered = slim.withColumn("doc", doc).orderBy("doc", F.xxhash64("text"))
    return scratch.keep(ordered.select(F.monotonically_increasing_id().alias("uid"), "doc", "doc_id", "text"), "numbered")


def segment_batch(h: np.ndarray, s: np.ndarray, t: np.ndarray, uid: np.ndarray, order: np.ndarray, start: np.ndarray, n: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    wide = (h.view(np.int64), s.view(np.int64), t.astype(np.uint32).view(np.int32), uid, order, start, n, flags)
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(wide, kinds, strict=True)], names=[c.split()[0] for c in SEGMENT.split(", ")])


def again(*keys: np.ndarray) -> np.ndarray:
    """Which rows repeat an earlier row's keys."""
    out = np.zeros(len(keys[0]), bool)
    mixed = np.zeros(len(out), np.uint64)
    for k in keys:
        mixed = (mixed ^ k.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if same.any():  # few: look at the keys themselves
        near = order[np.append(same, False) | np.append(False, same)]
        order = near[np.lexsort((near, *(k[near] for k in keys)))]
        out[order[1:]] = np.logical_and.reduce([k[order[1:]] == k[order[:-1]] for k in keys])
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        z = [pack(x.as_py().encode("utf-8", "surrogatepass")) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc"), pa.array(z, pa.binary())], names=["uid", "doc", "z"])


def removed_spans(
    rows: DataFrame,
    segments: Mapper,
    cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]],
    compare: Mapper,
    windows: Callable[[bytes, list[tuple[int, int]]], tuple[np.ndarray, np.ndarray, np.ndarray]],
    scratch: Scratch,
    length: int,
    across: bool = False,
    counting: Mapper | None = None,
    hot: int = HOT,
) -> DataFrame:
    """(uid, z, spans) of the rows that lose something: their packed text and the spans (a, b) to remove.

    `segments` maps (uid, ord, text) to SEGMENT rows; `cut` gives the bytes of
    segments (start, n) of a text; `compare` maps (h, seg, ord, uid, start)
    sorted by h within a partition to spans (uid, a, b); `windows` gives the
    places and two digests of the single windows of segments. With `across`
    only repeats in rows of another order count. `counting` maps the same rows
    to (h, ord, flags) alone, for the first of two passes; without it all
    segments are kept on disk instead of being worked out twice.
    """
    given = rows.select("uid", (F.col("doc") if across else F.col("uid")).alias("ord"), "text")
    found = given.mapInArrow(segments, SEGMENT)
    if counting is None:
        slim = found = scratch.keep(found, "segments")
    else:
        slim = given.mapInArrow(counting, "h bigint, ord bigint, flags int")
    counted = slim.groupBy("h").agg(F.min("ord").alias("low"), F.max("ord").alias("high"), F.sum(F.lit(1) + F.col("flags").bitwiseAND(TWICE)).alias("times"))
    # A table, so that both sides of the join are plain shuffles, whose hot keys adaptive execution can split.
    repeated = scratch.keep(counted.where("low < high" if across else "times > 1").select("h"), "repeated")
    shared = scratch.keep(found.join(repeated.hint("merge"), "h"), "shared")
    scratch.drop("segments")
    twice = F.max(F.col("flags").bitwiseAND(TWICE))
    distinct = shared.groupBy("h", "s", "t").agg(F.min("ord").alias("least"), twice.alias("twice"), F.max("n").alias("n"), F.count(F.lit(1)).alias("k"))
    distinct = scratch.keep(distinct, "distinct")
    sizes = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("parts"), F.max("twice").alias("any"), F.sum("n").alias("all"))
    several = sizes.where("parts > 1" if across else "parts > 1 or any > 0").select("h", F.when(F.col("all") > hot, SINGLE).otherwise(COMPARED).alias("fate"))
    several = scratch.keep(several, "several")
    info = distinct.join(several.hint("merge"), "h", "left").select("h", "s", "t", "least", "k", F.coalesce("fate", F.lit(WHOLE)).alias("fate"))
    info = scratch.keep(info.where((F.col("fate") != WHOLE) | (F.col("k") > 1)).drop("k"), "info")
    later = (F.col("ord") > F.col("least")) | (F.col("flags").bitwiseAND(AGAIN) != 0)
    marks = shared.join(info.hint("merge"), ["h", "s", "t"]).withColumn("fate", F.when(later, WHOLE).otherwise(F.col("fate")))
    marks = marks.where(later | (F.col("fate") != WHOLE)).select("uid", F.struct("h", "start", "n", "fate").alias("cut"))
    marks = scratch.keep(marks.groupBy("uid").agg(F.collect_list("cut").alias("cuts")), "marks")
    for name in ("shared", "distinct", "info", "repeated", "several"):
        scratch.drop(name)
    packed = rows.select("uid", "doc", "text").mapInArrow(_packed, "uid bigint, doc bigint, z binary")
    held = scratch.keep(packed.join(marks.hint("merge"), "uid"), "held")
    scratch.drop("marks")

    def chosen(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[tuple[int, int, bytes, list[dict]]]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                if some := [c for c in batch.column("cuts")[row].as_py() if c["fate"] == kind]:
                    yield batch.column("uid")[row].as_py(), batch.column("doc" if across else "uid")[row].as_py(), unpack(batch.column("z")[row].as_py()), some

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, order, text, some in chosen(batches, COMPARED):
            spans = [(c["start"], c["n"]) for c in some]
            columns = [pa.array([c["h"] for c in some], pa.int64()), pa.array(cut(text, spans), pa.binary()), pa.array([order] * len(some), pa.int64()), pa.array([uid] * len(some), pa.int64()), pa.array([a for a, _ in spans], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "seg", "ord", "uid", "start"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, order, text, some in chosen(batches, SINGLE):
            at, w, v = windows(text, [(c["start"], c["n"]) for c in some])
            repeats = np.zeros(len(at), bool) if across else again(w, v)
            columns = [pa.array(w.view(np.int64)), pa.array(v.view(np.int64)), pa.array(np.full(len(at), uid, np.int64)), pa.array(np.full(len(at), order, np.int64)), pa.array(at.astype(np.int32)), pa.array(repeats)]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "v", "uid", "ord", "at", "again"])

    together = held.mapInArrow(compared, "h bigint, seg binary, ord bigint, uid bigint, start int").repartition(F.col("h")).sortWithinPartitions("h")
    spans = together.mapInArrow(compare, "uid bigint, a int, b int")
    if not held.where(F.exists("cuts", lambda c: c["fate"] == SINGLE)).isEmpty():
        each = scratch.keep(held.mapInArrow(single, "w bigint, v bigint, uid bigint, ord bigint, at int, again boolean"), "windows")
        least = each.groupBy("w", "v").agg(F.min("ord").alias("least"), F.max("ord").alias("most")).where("least < most").drop("most")
        gone = each.join(scratch.keep(least, "least").hint("merge"), ["w", "v"], "left").where("again or ord > least")
        spans = spans.unionByName(gone.select("uid", F.col("at").alias("a"), (F.col("at") + length).alias("b")))
    spans = scratch.keep(spans.groupBy("uid").agg(F.collect_list(F.struct("a", "b")).alias("more")), "spans")
    of_cuts = F.transform(F.filter("cuts", lambda c: c["fate"] == WHOLE), lambda c: F.struct(c["start"].alias("a"), (c["start"] + c["n"] + (length - 1)).alias("b")))
    none = F.array().cast("array<struct<a:int,b:int>>")
    whole = held.select("uid", "z", of_cuts.alias("whole")).join(spans.hint("merge"), "uid", "left")
    return whole.select("uid", "z", F.array_sort(F.concat("whole", F.coalesce("more", none))).alias("spans")).where(F.size("spans") > 0)


def union(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans, with those that touch or overlap made one."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [(a, b) for a, b in out]
