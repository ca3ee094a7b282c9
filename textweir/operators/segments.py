"""The index as immutable segments under a manifest.

A sync writes one segment with what is new, and tombstones for the chunks of
older segments that it replaces: their ids, and how much their terms count, so
that statistics stay those of an index built anew. A manifest names the live
segments; it is published by an atomic rename that fails if another writer has
published meanwhile. `TIER` segments of one level are merged into one of the
next, without their dead chunks, so a change costs what it holds and now and
then a merge.

Postings lie in blocks of a term and a slot, that is a range of chunk ids, with
the largest frequency and the least length in it. A query bounds each slot's
best score by its blocks' heads, scores the most promising slots, and then only
those whose bound reaches the pool's last score. Vectors lie in blocks around
centroids: by the triangle inequality no vector of a block is nearer to the
query than its centroid less the block's radius, which bounds its score.

A join is broadcast only where its rows are counted and few: Spark would tell by
the size of files, and compressed ids take many times that in the driver.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators.chunk import chunked
from textweir.operators.index import CHUNKS, DOCS, VECTORS, by_terms, numbered, synced_docs
from textweir.operators.search import K1, LEAST_IDF, POOL, B, Filters, Query, ranked, tokens
from textweir.storage import Lease, create_once, listed, read_text, unpublished

ATTRIBUTES = "chunk_id bigint, doc_id bigint, path string, corpus string, source string, date string, lines string"
BLOCKS = "term string, slot bigint, n int, max_tf int, min_len int, total bigint, ids array<bigint>, tfs array<int>, lens array<int>, places array<array<int>>"
VECTOR_BLOCKS = "cluster int, n int, radius double, centroid array<float>, ids array<bigint>, data binary"
DEAD, MINUS, CHANGES = "owner string, chunk_id bigint, terms int", "owner string, term string, df bigint", "doc_id bigint, change string"
TABLES = {"docs": DOCS, "chunks": CHUNKS, "attributes": ATTRIBUTES, "blocks": BLOCKS, "vectors": VECTORS, "near": f"block bigint, {VECTOR_BLOCKS}", "dead": DEAD, "minus": MINUS, "changes": CHANGES}
#: Chunk ids are numbered within documents below this; a slot holds the chunks of 256 documents.
OF_ONE, SLOT_BITS = 1 << 20, 28
#: Segments of one level that are merged.
TIER = 4
#: Slots and vector blocks that are scored first, ranges that a scan is given, and blocks that are named one by one.
FIRST, RANGES, NAMED = 32, 64, 4096
#: Vectors that centroids are fitted to, centroids at most, rounds, and vectors of a block.
SAMPLE, CENTROIDS, ROUNDS, BLOCK = 8192, 256, 8, 256
#: Rows that are sent to all tasks at most, to spare others a shuffle.
FEW = 1 << 16
#: Bytes of text whose blocks are sorted together.
PART_BYTES = 16 << 20


class Conflict(RuntimeError):
    """Another writer has published since this one read the index."""


@dataclass(frozen=True)
class Index:
    """The live segments of a published version."""

    spark: SparkSession
    root: str
    version: int
    segments: tuple[dict, ...]
    slot_bits: int = SLOT_BITS

    def table(self, name: str) -> DataFrame:
        """A table of all live segments, with the `segment` each row is from."""
        at = f"{self.root}/{name}"
        paths = [f"{at}/segment={s['name']}" for s in self.segments if name in s["tables"]]
        schema = f"{TABLES[name]}, segment string"
        return self.spark.read.schema(schema).option("basePath", at).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def alive(self, rows: DataFrame) -> DataFrame:
        """Rows (segment, chunk_id) without those of chunks that a later segment replaced."""
        n = sum(s["dead"] for s in self.segments)
        if not n:
            return rows
        dead = self.table("dead").where("terms >= 0").select(F.col("owner").alias("segment"), "chunk_id")
        return rows.join(_sent(dead, n), ["segment", "chunk_id"], "left_anti")

    def docs(self) -> DataFrame:
        dead = self.table("dead").select(F.col("owner").alias("segment"), F.shiftright("chunk_id", 20).alias("doc_id")).distinct()
        return self.table("docs").join(dead.hint("shuffle_hash"), ["segment", "doc_id"], "left_anti")

    @property
    def chunks(self) -> int:
        return sum(s["chunks"] - s["dead"] for s in self.segments)

    @property
    def mean(self) -> float:
        return sum(s["terms"] - s["dead_terms"] for s in self.segments) / max(1, self.chunks)


def _sent(rows: DataFrame, n: int) -> DataFrame:
    """`n` rows as the right side of a semi or anti join: sent to all tasks if they are few, else shuffled."""
    return F.broadcast(rows) if n <= FEW else rows.hint("shuffle_hash")


def opened(spark: SparkSession, root: str, version: int | None = None) -> Index:
    """The index below `root` as of a version, the last one by default; one without documents where nothing is published."""
    root = root.rstrip("/")
    known = sorted(int(name.removesuffix(".json")) for name in listed(spark, f"{root}/manifests") if name.endswith(".json"))
    if not known:
        return Index(spark, root, 0, ())
    at = known[-1] if version is None else version
    told = json.loads(read_text(spark, f"{root}/manifests/{at:012d}.json"))
    return Index(spark, root, at, tuple(told["segments"]), told["slot_bits"])


def publish(index: Index, segments: list[dict], lease: Lease | None = None) -> Index:
    """Publish `segments` as the version after `index`; fails if there is one already, or if the lease is no longer held."""
    if lease is not None:
        lease.check()
    version = index.version + 1
    told = json.dumps({"version": version, "slot_bits": index.slot_bits, "segments": segments})
    if not create_once(index.spark, f"{index.root}/manifests/{version:012d}.json", told):
        raise Conflict(f"version {version} of {index.root} is published already")
    return opened(index.spark, index.root, version)


# --- writing ---


def _blocked(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Postings of chunks (chunk_id, terms) in order of ids, a slice of terms at a time: a row for each term and slot of it."""
    for batch in by_terms(batches):
        found = batch.column("terms")
        sizes = np.diff(found.offsets.to_numpy()).astype(np.int32)
        if not sizes.sum():
            continue
        ids = batch.column("chunk_id").to_numpy()
        coded = found.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(row), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        # Postings, and blocks of them.
        first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
        of_posting, slot = code[first], ids[row[first]] >> bits
        ends = np.r_[first, len(code)].astype(np.int32)
        tf, size = np.diff(ends), sizes[row[first]]
        head = np.flatnonzero(np.r_[True, (of_posting[1:] != of_posting[:-1]) | (slot[1:] != slot[:-1])])
        cuts = np.r_[head, len(first)].astype(np.int32)
        lists = (pa.array(ids[row[first]]), pa.array(tf), pa.array(size), pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order])))
        columns = [
            coded.dictionary.take(pa.array(of_posting[head])), pa.array(slot[head]), pa.array(np.diff(cuts)),
            pa.array(np.maximum.reduceat(tf, head)), pa.array(np.minimum.reduceat(size, head)), pa.array(np.add.reduceat(tf.astype(np.int64), head)),
            *(pa.ListArray.from_arrays(pa.array(cuts), c) for c in lists),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCKS.split(", ")])


def blocks(chunks: DataFrame, bits: int = SLOT_BITS, size: int = 0) -> DataFrame:
    """Postings of chunks (chunk_id, text) in blocks. The chunks of a slot are brought together, about `PART_BYTES` of the `size` bytes of all texts in a part; only blocks are sorted, part by part, by term and slot."""
    slot = F.shiftright(F.col("chunk_id").cast("bigint"), bits)
    parts = max(1, -(-size // PART_BYTES), min(size >> 20, chunks.sparkSession.sparkContext.defaultParallelism))
    dealt = chunks.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), "text").repartition(parts, slot).sortWithinPartitions("chunk_id")
    terms = dealt.select("chunk_id", F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")).alias("terms"))
    return terms.mapInArrow(lambda b: _blocked(b, bits), BLOCKS).sortWithinPartitions("term", "slot")


def centroids(vectors: DataFrame) -> np.ndarray:
    """Centroids fitted to `SAMPLE` vectors at most, chosen by a hash of their ids; every vector is then stored with one."""
    some = vectors.orderBy(F.xxhash64("chunk_id")).limit(SAMPLE).select("embedding").collect()
    if not some:
        return np.zeros((0, 0), np.float32)
    x = np.array([r[0] for r in some], np.float32)
    k = max(1, min(CENTROIDS, math.isqrt(len(x))))
    at = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        own = _nearest(x, at)[0]
        sums = np.zeros_like(at)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)[:, None]
        at = np.where(n > 0, sums / np.maximum(n, 1), at).astype(np.float32)
    return at


def _nearest(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = np.argmin((at.astype(np.float64) ** 2).sum(axis=1) - 2 * (x @ at.T), axis=1)
    return own, np.linalg.norm(x.astype(np.float64) - at[own], axis=1)


def vector_blocks(vectors: DataFrame) -> DataFrame:
    """Vectors (chunk_id, embedding) in blocks of one centroid each, by their distance from it."""
    at = centroids(vectors)
    sent = vectors.sparkSession.sparkContext.broadcast(at)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, far = _nearest(_matrix(batch.column("embedding")), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("chunk_id"), pa.array(own.astype(np.int32)), pa.array(far), batch.column("embedding")], names=["chunk_id", "cluster", "far", "embedding"])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("cluster").to_numpy()
            edges = np.flatnonzero(np.r_[True, np.diff(own) != 0]) if len(own) else []
            for start, end in zip(edges, [*edges[1:], len(own)], strict=True):
                for a in range(start, end, BLOCK):
                    part = batch.slice(a, min(end, a + BLOCK) - a)
                    row = {"cluster": int(own[a]), "n": part.num_rows, "radius": float(part.column("far")[-1].as_py()), "centroid": sent.value[own[a]].tolist()}
                    row |= {"ids": part.column("chunk_id").to_pylist(), "data": _matrix(part.column("embedding")).tobytes()}
                    yield pa.RecordBatch.from_pylist([row], _NEAR)

    spots = vectors.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), "embedding").mapInArrow(placed, "chunk_id bigint, cluster int, far double, embedding array<float>")
    ordered = spots.repartitionByRange("cluster", "far").sortWithinPartitions("cluster", "far")
    return ordered.mapInArrow(blocked, VECTOR_BLOCKS).select(F.monotonically_increasing_id().alias("block"), "*")


_NEAR = pa.schema([("cluster", pa.int32()), ("n", pa.int32()), ("radius", pa.float64()), ("centroid", pa.list_(pa.float32())), ("ids", pa.list_(pa.int64())), ("data", pa.binary())])


def _matrix(embedding: pa.Array) -> np.ndarray:
    return embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(embedding), -1)


def _kept(index: Index, name: str, table: str, rows: DataFrame) -> DataFrame:
    """Write a table of a segment and return it as read back."""
    at = f"{index.root}/{table}/segment={name}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(at)
    return index.spark.read.schema(TABLES[table]).parquet(at)


Rows = Callable[[dict[str, DataFrame]], DataFrame]


def written(index: Index, name: str, level: int, tables: dict[str, DataFrame | Rows], vectors: DataFrame | None = None) -> dict:
    """Write a segment from its docs, chunks and attributes; what the manifest tells of it. A table may be given as a function of those before it, as they are read back."""

    def keep(table: str, rows: DataFrame) -> DataFrame:
        return _kept(index, name, table, rows)

    kept: dict[str, DataFrame] = {}
    for t, rows in tables.items():
        kept[t] = keep(t, rows if isinstance(rows, DataFrame) else rows(kept))
    chunks = kept["chunks"]
    n, size = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    posted = keep("blocks", blocks(chunks, index.slot_bits, size))
    told = {"name": name, "level": level, "tables": [*tables, "blocks"], "dead": 0, "dead_terms": 0, "chunks": n, "terms": posted.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]}
    if vectors is not None:
        keep("near", vector_blocks(keep("vectors", vectors)))
        told["tables"] += ["vectors", "near"]
    return told


def _name(level: int) -> str:
    return f"{level}-{uuid.uuid4().hex[:12]}"


def attributes(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """What a search needs of each chunk beside its text, in the order of ids."""
    lines = F.concat_ws("-", "start_line", "end_line").alias("lines")
    rows = chunks.select("chunk_id", "doc_id", lines).join(docs.select("doc_id", "path", "corpus", "source", "date").hint("merge"), "doc_id")
    return rows.select(*(c.split()[0] for c in ATTRIBUTES.split(", "))).repartitionByRange("chunk_id").sortWithinPartitions("chunk_id")


Chunker = Callable[[DataFrame], DataFrame]
Model = Callable[[DataFrame], DataFrame]


def sync(index: Index, now: DataFrame, chunker: Chunker = chunked, model: Model | None = None, lease: Lease | None = None) -> Index:
    """Bring an index up to date with documents `now` (those of `docs`, `text` and `first_line`) and publish it.

    `chunker` gives (doc_id, ord, start_line, end_line, text) of documents; `model`
    gives (chunk_id, embedding) of chunks (chunk_id, title, text), where vectors
    are wanted. Only new and changed documents are chunked, and only segments
    that a merge takes up are read beside `docs` and `dead`.
    """
    known = index.docs().drop("segment")
    name = _name(0)
    # Written once, without texts, so that these are read and moved for new and changed documents alone.
    changes = _kept(index, name, "changes", synced_docs(known, now.select(*known.columns)).select("doc_id", "change"))
    fresh = now.join(changes.where("change <> 'keep'").select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    kept = changes.where("change = 'keep'").select("doc_id")
    gone = index.docs().select("segment", "doc_id").join(kept.hint("shuffle_hash"), "doc_id", "left_anti")
    made = chunker(fresh)
    made = made.select((F.col("doc_id") * OF_ONE + F.col("ord")).alias("chunk_id"), "doc_id", "ord", "start_line", "end_line", "text")
    told = written(index, name, 0, {"docs": fresh.select(*known.columns), "chunks": made.sortWithinPartitions("chunk_id"), "attributes": lambda t: attributes(t["docs"], t["chunks"])})
    told["tables"].append("changes")
    if model is not None:
        chunks = index.spark.read.parquet(f"{index.root}/chunks/segment={name}").join(fresh.select("doc_id", "title", "chunker"), "doc_id")
        title = F.when(F.col("chunker") == "digest", "").otherwise(F.col("title")).alias("title")
        near = index.spark.read.schema(VECTORS)
        model(chunks.select("chunk_id", title, "text")).write.mode("overwrite").parquet(f"{index.root}/vectors/segment={name}")
        vector_blocks(near.parquet(f"{index.root}/vectors/segment={name}")).write.mode("overwrite").parquet(f"{index.root}/near/segment={name}")
        told["tables"] += ["vectors", "near"]
    segments = [dict(s) for s in index.segments]
    if segments:
        lost = index.table("chunks").join(_sent(gone, gone.limit(FEW + 1).count()), ["segment", "doc_id"], "left_semi").select(F.col("segment").alias("owner"), "chunk_id", F.array_distinct(tokens(F.col("text"))).alias("of"), F.size(tokens(F.col("text"))).alias("terms"))
        # A document without chunks leaves its number.
        bare = gone.select(F.col("segment").alias("owner"), (F.col("doc_id") * OF_ONE + OF_ONE - 1).alias("chunk_id"), F.lit(-1).alias("terms"))
        lost.select("owner", "chunk_id", "terms").unionByName(bare).write.mode("overwrite").parquet(f"{index.root}/dead/segment={name}")
        # An outer one, as Spark would filter on a plain one's terms before the join, and so make those of all chunks.
        lost.select("owner", F.explode_outer("of").alias("term")).where("term is not null").groupBy("owner", "term").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(f"{index.root}/minus/segment={name}")
        told["tables"] += ["dead", "minus"]
        sums = index.spark.read.schema(DEAD).parquet(f"{index.root}/dead/segment={name}").where("terms >= 0").groupBy("owner").agg(F.count(F.lit(1)).alias("dead"), F.sum("terms").alias("terms"))
        by_owner = {r["owner"]: r for r in sums.collect()}  # a row for each segment
        for s in segments:
            if r := by_owner.get(s["name"]):
                s["dead"] += r["dead"]
                s["dead_terms"] += r["terms"]
    after = publish(index, [*segments, told], lease)
    return merged(after, lease)


def merged(index: Index, lease: Lease | None = None, tier: int = TIER) -> Index:
    """Merge the segments of a level of which there are `tier`, level after level; dead chunks and their tombstones go."""
    level = 0
    while any(s["level"] >= level for s in index.segments):
        own = [s for s in index.segments if s["level"] == level]
        if len(own) >= tier:
            some = Index(index.spark, index.root, index.version, tuple(own), index.slot_bits)
            names = [s["name"] for s in own]
            rows = {t: index.alive(some.table(t)).drop("segment") for t in ("chunks", "attributes")}
            by_slot = F.shiftright("chunk_id", index.slot_bits)
            rows = {"docs": index.docs().where(F.col("segment").isin(names)).drop("segment")} | {t: r.repartition(by_slot).sortWithinPartitions("chunk_id") for t, r in rows.items()}
            vectors = index.alive(some.table("vectors")).drop("segment") if any("vectors" in s["tables"] for s in own) else None
            name = _name(level + 1)
            told = written(index, name, level + 1, rows, vectors)
            rest = [s for s in index.segments if s["level"] != level]
            for table in ("dead", "minus"):  # of the tombstones, those of live segments stay
                of_rest = some.table(table).drop("segment").where(F.col("owner").isin([s["name"] for s in rest]))
                of_rest.write.mode("overwrite").parquet(f"{index.root}/{table}/segment={name}")
                told["tables"].append(table)
            index = publish(index, [*rest, told], lease)
        level += 1
    return index


def refresh(spark: SparkSession, files: DataFrame, root: str, model: Model | None = None, seconds: int = 3600) -> Index:
    """Bring the index below `root` up to date with files as `sources.files.parsed` gives them, as the only writer for so long."""
    with Lease(spark, f"{root.rstrip('/')}/lease", seconds) as lease:
        index = opened(spark, root)
        now = numbered(files, index.docs()).select(
            "doc_id", "path", "corpus", "source", "date", "title", "url", F.col("size").cast("bigint").alias("size"),
            (F.unix_micros(F.col("mtime").cast("timestamp")).cast("double") / 1e6).alias("mtime"), "chunker", F.col("body").alias("text"), "first_line",
        )
        return sync(index, now, model=model, lease=lease)


def sweep(index: Index) -> list[str]:
    """Delete the segments that no published version from this one on names; their names."""
    return unpublished(index.spark, index.root, [*TABLES], {s["name"] for s in index.segments})


# --- reading ---


def ranges(numbers: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all of some numbers; the widest gaps part them."""
    numbers = sorted(set(numbers))
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(numbers, numbers[1:], strict=False), 1) if b - a > 1), reverse=True)[: most - 1]
    starts = [0, *sorted(i for _, i in gaps)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(starts, [*starts[1:], len(numbers)], strict=True)] if numbers else []


def _within(column: str, spans: list[tuple[int, int]], bits: int = 0) -> Column:
    """A condition that scans can use to skip row groups."""
    c = F.col(column)
    return reduce(or_, (c.between(a << bits, ((b + 1) << bits) - 1) for a, b in spans), F.lit(False))


def _of_postings(index: Index, query: Query, rows: DataFrame) -> tuple[DataFrame, Column]:
    """(segment, chunk_id, len, tf): how often each phrase of a query occurs in the live chunks of some blocks; and what matches."""
    fields = ["ids", "tfs", "lens"] + ["places"] * any(len(p) > 1 for p in query.phrases)
    flat = rows.select("segment", "term", F.inline(F.arrays_zip(*fields)))
    terms = sorted({t for p in query.phrases for t in p})
    spot = {t: i for i, t in enumerate(terms)}
    found = [F.first(F.when(F.col("term") == t, F.col("places" if len(fields) > 3 else "tfs")), ignorenulls=True).alias(f"t{i}") for t, i in spot.items()]
    of_chunk = flat.groupBy("segment", F.col("ids").alias("chunk_id")).agg(F.first("lens").alias("len"), *found)

    def times(phrase: tuple[str, ...]) -> Column:
        if len(fields) == 3:
            return F.coalesce(F.col(f"t{spot[phrase[0]]}"), F.lit(0))
        at = [F.coalesce(F.col(f"t{spot[t]}"), F.array().cast("array<int>")) for t in phrase]
        return F.size(reduce(F.array_intersect, [F.transform(x, _moved(k)) if k else x for k, x in enumerate(at)]))

    counted = of_chunk.select("segment", "chunk_id", "len", F.array(*(times(p) for p in query.phrases)).alias("tf"))
    matched = F.forall("tf", lambda f: f > 0) if query.how == "and" else F.exists("tf", lambda f: f > 0)
    return index.alive(counted), matched


def _moved(k: int) -> Callable[[Column], Column]:
    return lambda at: at - k


def _idf(n: int, df: int) -> float:
    return max(math.log((n - df + 0.5) / (df + 0.5)), LEAST_IDF)


def _bm25(index: Index, idfs: list[float]) -> Column:
    total = F.lit(0.0)
    for i, idf in enumerate(idfs):
        tf = F.get("tf", i)
        total += F.lit(idf) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / F.lit(index.mean)))
    return F.round(-total, 6)


def keyword_slots(index: Index, query: Query, filters: Filters = Filters(), pool: int = POOL) -> tuple[DataFrame, list[float]]:
    """The slots (segment, slot) that may hold one of a query's best chunks, and the inverse document frequencies of its phrases."""
    terms = sorted({t for p in query.phrases for t in p})
    heads = index.table("blocks").where(F.col("term").isin(terms)).select("segment", "term", "slot", "n", "max_tf", "min_len")
    if any(len(p) > 1 for p in query.phrases):
        # A phrase's frequency is known once it is counted wherever all its terms stand.
        sets = heads.groupBy("segment", "slot").agg(F.collect_set("term").alias("has"))
        all_of = [reduce(lambda a, b: a & b, (F.array_contains("has", t) for t in p)) for p in query.phrases]
        slots = sets.where(reduce(or_, all_of)).select("segment", "slot")
        counted = _of_postings(index, query, _in_slots(index, terms, slots))[0]
        df = counted.agg(*(F.count_if(F.get("tf", i) > 0) for i in range(len(query.phrases)))).first()
        return slots, [_idf(index.chunks, d) for d in df]
    less = index.table("minus").where(F.col("term").isin(terms)).where(F.col("owner").isin([s["name"] for s in index.segments])).groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["n"] for r in heads.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    for r in less.collect():
        df[r["term"]] -= r["df"]
    idfs = [_idf(index.chunks, df.get(p[0], 0)) for p in query.phrases]
    of_term = F.lit(0.0)
    for phrase, idf in zip(query.phrases, idfs, strict=True):
        of_term = F.when(F.col("term") == phrase[0], F.lit(idf)).otherwise(of_term)
    bound = of_term * F.col("max_tf") * (K1 + 1) / (F.col("max_tf") + K1 * (1 - B + B * F.col("min_len") / F.lit(index.mean)))
    slots = heads.groupBy("segment", "slot", "term").agg(F.max(bound).alias("bound")).groupBy("segment", "slot").agg(F.sum("bound").alias("bound"), F.count(F.lit(1)).alias("terms"))
    if query.how == "and":
        slots = slots.where(F.col("terms") == len(terms))
    first = slots.orderBy(F.desc("bound"), "segment", "slot").limit(FIRST)
    best = _scored(index, query, first.select("segment", "slot"), idfs, filters).orderBy("bm25").limit(pool).agg(F.count(F.lit(1)), F.max("bm25")).first()
    if best[0] == pool:  # a chunk of a lower bound is not among the best
        slots = slots.where(F.col("bound") >= -best[1] - 1e-5)
    return slots.select("segment", "slot"), idfs


def _in_slots(index: Index, terms: list[str], slots: DataFrame) -> DataFrame:
    rows, _ = _chosen(index.table("blocks").where(F.col("term").isin(terms)), slots, "slot")
    return rows


def _chosen(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, list[tuple[int, int]] | None]:
    """Rows of some (segment, key): where they are few, the scan is given their ranges."""
    few = wanted.limit(NAMED + 1).collect()
    if len(few) > NAMED:
        return rows.join(wanted, ["segment", key], "left_semi"), None
    spans = ranges([r[key] for r in few])
    named = rows.sparkSession.createDataFrame(few, wanted.schema)
    return rows.where(_within(key, spans)).join(F.broadcast(named), ["segment", key], "left_semi"), spans


def _scored(index: Index, query: Query, slots: DataFrame, idfs: list[float], filters: Filters) -> DataFrame:
    """The chunks of some slots that match and pass the filters, with their attributes and `bm25` (lower is better)."""
    terms = sorted({t for p in query.phrases for t in p})
    rows, spans = _chosen(index.table("blocks").where(F.col("term").isin(terms)), slots, "slot")
    counted, matched = _of_postings(index, query, rows)
    scored = counted.where(matched).select("segment", "chunk_id", _bm25(index, idfs).alias("bm25"))
    attrs = index.table("attributes").where(filters.condition())
    if spans is not None:
        attrs = attrs.where(_within("chunk_id", spans, index.slot_bits))
    return scored.join(attrs.hint("merge"), ["segment", "chunk_id"])


def keyword_rank(index: Index, query: Query, filters: Filters = Filters(), pool: int = POOL) -> DataFrame:
    """The best chunks for a query by BM25 over the whole live index; filters come after scoring and before the pool is cut."""
    if not query.phrases:
        return _scored(index, Query((("",),), "or"), index.spark.createDataFrame([], "segment string, slot bigint"), [0.0], filters).withColumn("kw_rank", F.lit(0)).limit(0)
    slots, idfs = keyword_slots(index, query, filters, pool)
    return ranked(_scored(index, query, slots, idfs, filters), "kw_rank", pool, F.col("bm25"), F.col("chunk_id"))


def near_blocks(index: Index, vector: list[float], filters: Filters | None = None, pool: int = POOL) -> DataFrame:
    """The blocks (segment, block) that may hold one of the `pool` vectors with the largest products with `vector`."""
    wanted = F.array(*(F.lit(float(x)) for x in vector))
    middle = F.aggregate(F.zip_with("centroid", wanted, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    heads = index.table("near").select("segment", "block", (middle + F.lit(float(np.linalg.norm(vector))) * F.col("radius")).alias("bound"))
    first = heads.orderBy(F.desc("bound"), "segment", "block").limit(FIRST)
    best = _products(index, vector, first.select("segment", "block"), filters).orderBy(F.desc("similarity")).limit(pool).agg(F.count(F.lit(1)), F.min("similarity")).first()
    if best[0] == pool:
        heads = heads.where(F.col("bound") >= best[1] - 1e-5)
    return heads.select("segment", "block")


def _products(index: Index, vector: list[float], wanted: DataFrame, filters: Filters | None) -> DataFrame:
    q = np.asarray(vector, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, ids, data in zip(*(batch.column(c) for c in ("segment", "ids", "data")), strict=True):
                scores = np.frombuffer(data.as_py(), np.float32).reshape(-1, len(q)).astype(np.float64) @ q
                yield pa.RecordBatch.from_arrays([pa.array([segment.as_py()] * len(scores), pa.string()), ids.values, pa.array(scores)], names=["segment", "chunk_id", "score"])

    rows, _ = _chosen(index.table("near").select("segment", "block", "ids", "data"), wanted, "block")
    scored = index.alive(rows.select("segment", "ids", "data").mapInArrow(run, "segment string, chunk_id bigint, score double"))
    scored = scored.select("segment", "chunk_id", F.round("score", 6).alias("similarity"))
    return scored.join(index.table("attributes").where(filters.condition()).hint("merge"), ["segment", "chunk_id"]) if filters else scored


def vector_rank(index: Index, vector: list[float], filters: Filters | None = None, pool: int = POOL) -> DataFrame:
    """The best chunks by exact dot product with the query vector; filters come first. Without any, attributes are not read."""
    found = _products(index, vector, near_blocks(index, vector, filters, pool), filters)
    return ranked(found, "vec_rank", pool, F.desc("similarity"), F.col("chunk_id"))


def search(index: Index, text: str, filters: Filters = Filters(), k: int = 10, per_doc: int = 1, by_date: bool = False, vector: list[float] | None = None, mode: str = "hybrid") -> DataFrame:
    """The returned rows with their texts, which are read last; `vector` is the query's, for the modes that need one."""
    from textweir.operators import search as S

    if mode not in ("hybrid", "keyword", "vector"):
        raise ValueError(f"unknown mode: {mode}")
    if mode != "keyword" and vector is None:
        raise ValueError(f"mode {mode} needs the query's vector")
    if mode != "keyword" and not any("near" in s["tables"] for s in index.segments):
        raise ValueError(f"mode {mode} needs an index with vectors")
    words = keyword_rank(index, S.compile_query(text), filters) if mode != "vector" else None
    near = vector_rank(index, vector, filters) if mode != "keyword" else None
    found = S.assemble(S.fuse(words, near), k, per_doc, S.KW_PIN if mode == "hybrid" else 0, by_date)
    found = found.sparkSession.createDataFrame(found.collect(), found.schema)  # k rows
    ids = [r["chunk_id"] for r in found.select("chunk_id").collect()]
    texts = index.alive(index.table("chunks").where(_within("chunk_id", ranges(ids))).select("segment", "chunk_id", "text"))
    return texts.drop("segment").join(F.broadcast(found), "chunk_id")
