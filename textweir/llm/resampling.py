"""Importance resampling towards a target distribution, over hashed word features.

Two passes in Arrow batches. The first counts, for each partition, the features
in each of `BUCKETS` buckets; a tree of merges adds these vectors up. From the
counts of the documents and of the target texts every bucket gets a gain, and
the second pass, to which the gains are broadcast, adds up the gains of each
document's features. A document's weight is the mean of them, its score the
weight and a Gumbel variate that its id determines, so that the documents with
the highest scores are a sample without replacement.

A vector is 80 KB whatever the partition holds. Ranks come from one sort by
range: a row's place is its place in its range and the number of rows in the
ranges before, of which there are as many as partitions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import Scratch, slices

BUCKETS = 10_000
SEED = 7
#: Documents with fewer words are not drawn; so many of a hundred others are.
LEAST_WORDS = 20
PERCENT = 25
#: Bytes of text whose features are worked out at once.
SLICE_BYTES = 1 << 20
#: Partitions whose vectors a merge takes, at most.
FAN_IN = 64

#: Lower case for A-Z, itself for digits, small letters and every byte of a character beyond ASCII, else a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_ROW = "doc_id bigint, n_features bigint, n_words bigint, weight bigint, score bigint"


def words(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8: runs of digits, letters and characters beyond ASCII."""
    return (text or b"").translate(_LETTERS).split()


def features(found: list[bytes]) -> list[int]:
    """The checksums of a text's words, then of its pairs of neighbouring words."""
    ones = list(map(crc32, found))
    return ones + [crc32(b" " + word, one) for one, word in zip(ones, found[1:], strict=False)]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows with their numbers of words and the buckets of their features, row after row."""
    for batch in slices(batches, "text", SLICE_BYTES):
        counts, flat = [], []
        for text in batch.column("text").cast(pa.binary()):
            found = words(text.as_py())
            counts.append(len(found))
            flat += features(found)
        yield batch, np.array(counts, np.int64), np.array(flat, np.int64) % BUCKETS


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for _, _, buckets in _hashed(batches):
        total += np.bincount(buckets, minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all of `text` fall into each bucket."""
    parts = texts.select("text").mapInArrow(_vectors, "counts binary").rdd.map(lambda row: np.frombuffer(row[0], np.int64))
    if not (n := parts.getNumPartitions()):
        return np.zeros(BUCKETS, np.int64)
    return parts.treeReduce(np.add, depth=max(2, math.ceil(math.log(n, FAN_IN))))


def gains(of_docs: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds: a thousand times the logarithm of its smoothed share in the target over that in the documents."""
    s, t = float(of_docs.sum()) + BUCKETS, float(of_target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(of_docs.tolist(), of_target.tolist(), strict=True)], np.int64)


def noise(doc_id: int, seed: int = SEED) -> int:
    """A thousandfold Gumbel variate, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Each document's numbers of features and words, weight and score."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, n_words, buckets in _hashed(batches):
            ids = batch.column("doc_id")
            n = np.maximum(2 * n_words - 1, 0)
            # Sums of whole numbers: exact in doubles up to 2^53.
            total = np.bincount(np.repeat(np.arange(len(n)), n), weights=sent.value[buckets], minlength=len(n)).astype(np.int64)
            weight = total // np.maximum(n, 1)
            score = [None if i is None else w + noise(i, seed) for i, w in zip(ids.to_pylist(), weight.tolist(), strict=True)]
            columns = [ids, pa.array(n), pa.array(n_words), pa.array(weight), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "weight", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, _ROW)


def ranked(rows: DataFrame, drawn: int, scratch: Scratch) -> DataFrame:
    """`rows` with their rank by score, highest first, ties to the smaller doc_id; null after the first `drawn`."""
    # Rows that repeat an id tie in both: `at` lets a range end between them.
    ordered = rows.withColumn("at", F.monotonically_increasing_id()).orderBy(F.desc("score"), "doc_id", "at")
    placed = scratch.keep(ordered.drop("at").withColumn("place", F.monotonically_increasing_id()), "placed")
    # The high bits of a place are its partition's number, the low ones count the partition's rows.
    placed = placed.withColumn("part", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    before, starts = 0, []
    for part, n in sorted(placed.groupBy("part").agg(F.max("place") + 1).collect()):
        starts.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    rank = F.col("before") + F.col("place") + 1
    return placed.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= drawn, rank)).drop("part", "place", "before")


def resample(docs: DataFrame, target: DataFrame, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs`, drawn towards the texts of `target`.

    Of the N documents with at least `least_words` words, floor(percent * N / 100)
    with the highest scores get ranks 1, 2, 3...; ties go to the smaller doc_id;
    the rest have a null rank. Null, empty and wordless texts have no features
    and a weight of 0. A row without an id has a null score and is neither drawn
    nor counted in N. Rows that repeat an id are drawn each by its own weight;
    those that tie get neighbouring ranks. Texts of any length are read whole,
    one at a time; empty tables give no rows or, as target, equal gains before
    the documents' own shares. Columns other than doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = scratch.keep(weighted(docs, gain, seed), "weighted")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = percent * rows.where(able).count() // 100
    rest = rows.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked(rows.where(able), drawn, scratch).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


#: A feature's checksum is worked out bit by bit, once for each distinct feature.
ORACLE_SQL = f"""
WITH texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
w AS (SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM texts),
f AS (SELECT side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS feature FROM w),
crc AS (SELECT feature, xor(4294967295, list_reduce(flatten(list_transform(range(0, octet_length(encode(feature))), lambda i: list_transform(range(0, 8), lambda k:
  (CAST('0x' || hex(encode(feature))[2 * i + 1:2 * i + 2] AS BIGINT) >> k) & 1))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295)) % {BUCKETS} AS bucket FROM (SELECT DISTINCT feature FROM f)),
n AS (SELECT f.side, f.id, bucket, count(*) AS k FROM f JOIN crc USING (feature) GROUP BY ALL),
total AS (SELECT coalesce(sum(k) FILTER (side = 0), 0) AS s, coalesce(sum(k) FILTER (side = 1), 0) AS t FROM n),
per AS (SELECT bucket, coalesce(sum(k) FILTER (side = 0), 0) AS s, coalesce(sum(k) FILTER (side = 1), 0) AS t FROM n GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(per.t AS DOUBLE) + 1) * (CAST(total.s AS DOUBLE) + {BUCKETS}) / ((CAST(per.s AS DOUBLE) + 1) * (CAST(total.t AS DOUBLE) + {BUCKETS})))) AS BIGINT) AS gain FROM per, total),
mean AS (SELECT id AS doc_id, CAST(sum(k) AS BIGINT) AS n_features, CAST(floor(sum(k * gain)::DOUBLE / sum(k)::DOUBLE) AS BIGINT) AS weight FROM n JOIN gain USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (SELECT w.id AS doc_id, len(ws) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || w.id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN mean ON mean.doc_id = w.id WHERE side = 0),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE words >= {LEAST_WORDS}
  QUALIFY rank <= (SELECT {PERCENT} * count(*) // 100 FROM scored WHERE words >= {LEAST_WORDS}))
SELECT scored.doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn ON drawn.doc_id = scored.doc_id
"""
