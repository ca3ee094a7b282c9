"""Syncs of an index as tables (docs, chunks, vectors, postings), its numbers and exports; `segments` stores and searches it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators.chunk import chunk_table, sliced
from textweir.operators.ledger import snapshot_diff
from textweir.operators.search import tokens

DOCS = "doc_id bigint, path string, corpus string, source string, date string, title string, url string, size bigint, mtime double, chunker string"
CHUNKS = "chunk_id bigint, doc_id bigint, ord int, start_line int, end_line int, text string"
VECTORS = "chunk_id bigint, embedding array<float>"
POSTINGS = "term string, chunk_id bigint, tf int, at array<int>"
LENGTHS = "chunk_id bigint, terms int"
#: Terms whose postings a task makes at once, whatever an Arrow batch holds.
SLICE_TERMS = 1 << 20


def by_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of at most `SLICE_TERMS` of the column `terms`, one row at least."""
    for batch in batches:
        yield from sliced(batch, np.diff(batch.column("terms").offsets.to_numpy()), SLICE_TERMS)


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    """The tables of an index without documents."""
    return {name: spark.createDataFrame([], schema) for name, schema in (("docs", DOCS), ("chunks", CHUNKS), ("vectors", VECTORS), ("postings", POSTINGS), ("lengths", LENGTHS))}


def synced_docs(known: DataFrame, current: DataFrame) -> DataFrame:
    """The documents after a sync, as `current` has them, with `change`: add, change or keep. Deleted ones are not among them."""
    change = snapshot_diff(known, current, "path", "size", "mtime", "chunker")
    return current.join(change.where("change <> 'delete'"), "path")


def dropped(table: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """A table without the rows of some documents; chunks, postings and vectors follow their documents in turn."""
    return table.join(docs.select(key).distinct(), key, "left_anti")


def apply_sync(tables: dict[str, DataFrame], current: DataFrame) -> dict[str, DataFrame]:
    """docs, chunks, vectors, postings and lengths after a sync with `current` (docs and `text`).

    New and changed documents are chunked anew; deleted ones go with all
    that hangs on them. Vectors of new chunks are missing until they are embedded.
    """
    docs = synced_docs(tables["docs"], current)
    fresh = docs.where("change <> 'keep'")
    gone = tables["docs"].select("doc_id").join(docs.where("change = 'keep'").select("doc_id"), "doc_id", "left_anti")
    lost = tables["chunks"].join(gone, "doc_id", "left_semi").select("chunk_id")
    made = chunk_table(fresh.select("doc_id", "text"))
    made = made.select((F.col("doc_id") * (1 << 20) + F.col("ord")).alias("chunk_id"), "doc_id", "ord", "start_line", "end_line", "text")
    new = postings(made)
    return {
        "docs": docs.select(*tables["docs"].columns),
        "chunks": dropped(tables["chunks"], gone).unionByName(made),
        "vectors": dropped(tables["vectors"], lost, "chunk_id"),
        "postings": dropped(tables["postings"], lost, "chunk_id").unionByName(new),
        "lengths": dropped(tables["lengths"], lost, "chunk_id").unionByName(lengths(made)),
    }


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_terms(batches):
        listed = batch.column("terms")
        sizes = np.diff(listed.offsets.to_numpy())
        flat = listed.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        code = flat.indices.to_numpy().astype(np.int64)
        key = row * max(1, len(flat.dictionary)) + code
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)) if len(order) else order
        ends = np.append(first, len(order)).astype(np.int32)
        columns = [
            flat.dictionary.take(pa.array(code[order[first]])), batch.column("chunk_id").take(pa.array(row[order[first]])), pa.array(np.diff(ends)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order].astype(np.int32))),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "chunk_id", "tf", "at"])


def postings(chunks: DataFrame) -> DataFrame:
    """(term, chunk_id, tf, at): where each term of a chunk stands, counted in terms. A chunk's postings are made from its row alone, without a shuffle."""
    listed = chunks.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")).alias("terms"))
    return listed.mapInArrow(_posted, POSTINGS)


def lengths(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", F.size(tokens(F.col("text"))).alias("terms"))


def vector_export(vectors: DataFrame) -> DataFrame:
    """Vectors numbered in order of their chunk, as an export lays them out: (row, chunk_id, embedding).

    The numbers come from counts of ranges of ids, not from one sorted task.
    """
    from pyspark.sql.window import Window

    part = F.floor(F.col("chunk_id") / 4096)
    sizes = vectors.groupBy(part.alias("part")).count()
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("chunk_id"))
    return vectors.withColumn("part", part).withColumn("nth", within).join(before, "part").select((F.col("before") + F.col("nth") - 1).alias("row"), "chunk_id", "embedding")


def numbered(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files (path) with `doc_id`: that of the known document of the path, or one beyond all known ids.

    New ids come from counts of buckets of paths, not from one sorted task.
    """
    from pyspark.sql.window import Window

    held = files.join(known.select("path", "doc_id"), "path", "left")
    part = F.pmod(F.xxhash64("path"), F.lit(4096))
    new = held.where("doc_id is null").select("path").distinct().withColumn("part", part)
    before = new.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("path"))
    # One row of the largest id.
    most = known.agg(F.coalesce(F.max("doc_id"), F.lit(0).cast("bigint")).alias("most"))
    given = new.withColumn("nth", nth).join(before, "part").crossJoin(F.broadcast(most)).select("path", (F.col("most") + F.col("before") + F.col("nth")).alias("_id"))
    return held.join(given, "path", "left").withColumn("doc_id", F.coalesce("doc_id", "_id")).drop("_id")
