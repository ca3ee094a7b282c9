"""Exact top-k search: BM25 over sharded inverted indexes with block-max WAND pruning.

Each input partition is indexed in shards of bounded size, written as one
table with a row group for each, so that a task holds a shard or two, however
many its partition has. Global statistics (rows, mean length, document frequencies) are summed
from the shards, so every shard scores by the same weights and the merged
result is that of one index.

In a shard, documents are ordered by their commonest frequent term and their
length, so that blocks of neighbours are alike. The lists of a query's rarer
terms are summed for each document. The terms of a share of the documents are a
matrix, of which each block of documents keeps the largest weights: these and
the largest of the sums bound a block, for many queries at once by a matrix
product. Only runs of blocks whose bound can still reach the k-th best score of
one of a group of queries are scored, by a product too (the pivot test of
block-max WAND, made for all blocks at once).

Queries come in blocks of bounded size. A block is sent to one shard in eight
first; the k-th best score of each query there is a floor for the others, which
prune by it and return only what reaches it. A task's shards raise the floors
for its next ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.llm.common import NULL_ID, Scratch

K1, B = 1.2, 0.75
#: The least inverse document frequency, for terms that half of all rows have.
LEAST_IDF = 1e-6
TOP = 10
#: Bytes of text in a shard; documents in a block; terms of the queries that are searched at once.
SHARD_BYTES, BLOCK, QUERY_TERMS = 24 << 20, 64, 1 << 21
#: Frequent terms of a shard by which its documents are ordered.
FREQUENT = 32
DECIMALS = 6
#: One shard in so many sets the floors.
FIRST = 8
#: A term of this share of a shard's documents is frequent; queries that are scored together, and bounded together; numbers in a matrix at most.
OFTEN, GROUP, CHUNK, CELLS = 0.05, 256, 4096, 1 << 23
#: What rounding may add to a score or take from it, and more; the least score of a match.
SLACK, LEAST = 2 * 10.0**-DECIMALS, 1e-300

TERM = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    """The runs of letters and digits of a text in lower case."""
    return TERM.findall(text.lower()) if text else []


class _Vocabulary(dict):
    def __missing__(self, term: str) -> int:
        self[term] = n = len(self)
        return n


def build_shard(ids: list[int], texts: list[str | None]) -> dict[str, object]:
    """The inverted index of some documents."""
    vocabulary = _Vocabulary()
    found, sizes = [], []
    for text in texts:
        got = np.fromiter(map(vocabulary.__getitem__, terms(text)), np.int32)
        sizes.append(len(got))
        found.append(np.unique(got, return_counts=True))
    lengths = np.array(sizes, np.int32)
    term = np.concatenate([t for t, _ in found]).astype(np.int32)
    count = np.concatenate([n for _, n in found]).astype(np.int32)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(t) for t, _ in found])
    held = np.bincount(term, minlength=len(vocabulary))
    frequent = np.zeros(len(vocabulary), bool)
    frequent[np.argsort(-held, kind="stable")[:FREQUENT]] = True
    main = np.full(len(ids), -1)
    some = np.flatnonzero(frequent[term])
    some = some[np.lexsort((count[some], doc[some]))]
    main[doc[some]] = term[some]  # the last of a document is its commonest
    order = np.lexsort((lengths, main))
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    words = list(vocabulary)
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int32)
    new = np.empty(len(words), np.int32)
    new[by_word] = np.arange(len(words))
    term, doc = new[term], place[doc]
    postings = np.lexsort((doc, term))
    return {
        "ids": np.array(ids, np.int64)[order].tobytes(),
        "lengths": lengths[order].tobytes(),
        "terms": [words[k] for k in by_word],
        "dfs": held[by_word].astype(np.int32),
        "docs": doc[postings].tobytes(),
        "counts": count[postings].tobytes(),
    }


INDEX = "shard bigint, n_docs bigint, n_terms bigint, ids binary, lengths binary, terms array<string>, dfs array<int>, docs binary, counts binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    texts: list[str | None] = []
    size = number = 0
    part = TaskContext.get().partitionId()

    def shard() -> pa.RecordBatch:
        s = build_shard(ids, texts)
        n_terms = int(np.frombuffer(s["lengths"], np.int32).sum())
        columns = [
            pa.array([part * (1 << 20) + number]), pa.array([len(ids)]), pa.array([n_terms]), pa.array([s["ids"]], pa.binary()), pa.array([s["lengths"]], pa.binary()),
            pa.array([s["terms"]], pa.list_(pa.string())), pa.array([s["dfs"]], pa.list_(pa.int32())), pa.array([s["docs"]], pa.binary()), pa.array([s["counts"]], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "n_docs", "n_terms", "ids", "lengths", "terms", "dfs", "docs", "counts"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size > SHARD_BYTES:
                yield shard()
                ids, texts, size, number = [], [], 0, number + 1
    if ids:
        yield shard()


class Asked:
    """A block of queries: their ids, the numbers of their terms end to end, whose they are, and each term's word and weight."""

    def __init__(self, found: pa.Table):
        sizes, each = found["size"].to_numpy(), found["term"].combine_chunks().flatten().dictionary_encode()
        self.ids = found["query_id"].to_numpy()
        self.words = each.dictionary
        self.terms = each.indices.to_numpy()
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.idf = np.zeros(len(self.words))
        self.idf[self.terms] = found["idf"].combine_chunks().flatten().to_numpy()


class Shard:
    """An index ready to be searched, with the weights of the terms of a block of queries."""

    def __init__(self, row: dict[str, object], mean: float, asked: Asked):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int32)
        self.doc = np.frombuffer(row["docs"], np.int32).astype(np.intp)
        count = np.frombuffer(row["counts"], np.int32)
        dfs = np.asarray(row["dfs"], np.int64)
        starts = np.cumsum(dfs) - dfs
        here = pa.compute.fill_null(pa.compute.index_in(asked.words, row["terms"]), -1).to_numpy()
        idf = np.zeros(len(dfs))
        idf[here[here >= 0]] = asked.idf[here >= 0]
        norm = K1 * (1 - B + B * lengths / mean) if mean else np.full(len(lengths), K1)
        self.weight = np.repeat(idf, dfs) * (count * (K1 + 1) / (count + norm[self.doc]))
        self.blocks = -(-len(self.ids) // BLOCK)
        room = self.blocks * BLOCK
        often = np.flatnonzero((dfs >= OFTEN * len(self.ids)) & (idf > 0))
        often = often[np.argsort(-dfs[often], kind="stable")[: max(1, CELLS // max(room, CHUNK))]]
        column = np.full(len(dfs), -1)
        column[often] = np.arange(len(often))
        at = _ranges(starts[often], starts[often] + dfs[often])
        self.matrix = np.zeros((len(often), self.blocks, BLOCK))  # weights of frequent terms
        self.matrix.reshape(len(often), room)[np.repeat(np.arange(len(often)), dfs[often]), self.doc[at]] = self.weight[at]
        term = here[asked.terms]
        query, term = asked.owner[term >= 0], term[term >= 0]
        at, every = column[term], np.arange(len(asked.ids) + 1)
        self.query, self.column = query[at >= 0], at[at >= 0]
        self.frequent = np.searchsorted(self.query, every)  # of each query, its frequent terms
        rare = term[at < 0]
        self.low, self.high = starts[rare], starts[rare] + dfs[rare]
        self.lists = np.searchsorted(query[at < 0], every)  # of each query, its other terms

    def search(self, floors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, document, rounded score) of the k best of at least `floors`, which rise by what is found; ties go to the smaller id."""
        most = self.matrix.max(2)
        norm = np.maximum(np.linalg.norm(most, axis=0), LEAST)
        group = min(GROUP, max(1, CELLS // (self.blocks * BLOCK)))
        chunk = min(CHUNK, max(1, CELLS // self.blocks))
        for first in range(0, len(floors), chunk):
            part = slice(self.frequent[first], self.frequent[min(first + chunk, len(floors))])
            has = np.zeros((min(chunk, len(floors) - first), len(most)))
            has[self.query[part] - first, self.column[part]] = 1
            upper = has @ most
            order = np.argsort(np.argmax(upper / norm, axis=1), kind="stable")  # queries with the same best block are alike
            for start in range(0, len(order), group):
                some = order[start : start + group]
                asked = some + first
                query, docs, scores, rank = self._group(asked, has[some], upper[some], floors[asked], k)
                floors[asked[query[rank == k - 1]]] = scores[rank == k - 1]
                yield asked[query], docs, scores

    def _group(self, asked: np.ndarray, has: np.ndarray, upper: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(place in `asked`, document, rounded score, rank) of the k best for some queries."""
        room = self.blocks * BLOCK
        scores = np.empty((len(asked), room))
        for i, query in enumerate(asked):
            lists = slice(self.lists[query], self.lists[query + 1])
            at = _ranges(self.low[lists], self.high[lists])
            scores[i] = np.bincount(self.doc.take(at), self.weight.take(at), room)
        least = np.maximum(floors - SLACK, LEAST)[:, None]
        bound = scores.reshape(len(asked), self.blocks, BLOCK).max(2) + upper
        chosen = np.flatnonzero((bound >= least).any(0))
        matrix = self.matrix.reshape(-1, room)
        for run in np.split(chosen, np.flatnonzero(np.diff(chosen) > 1) + 1) if len(chosen) else ():
            here = slice(run[0] * BLOCK, (run[-1] + 1) * BLOCK)
            scores[:, here] += has @ matrix[:, here]
        for i in np.flatnonzero(floors == 0) if room > k else ():  # nothing is known of these yet
            least[i] = max(LEAST, np.partition(scores[i], -k)[-k] - SLACK)
        query, docs = np.nonzero(scores >= least)
        score = np.round(scores[query, docs], DECIMALS)
        kept = score >= floors[query]
        query, docs, score = query[kept], docs[kept], score[kept]
        best = np.lexsort((self.ids[docs], -score, query))
        query, docs, score = query[best], docs[best], score[best]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return tuple(x[rank < k] for x in (query, docs, score, rank))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The integers of [low, high) for each pair, end to end."""
    n = high - low
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - n), n)


HIT = "query_id bigint, doc_id bigint, score double"


def _searcher(shared, floored, mean: float, k: int):
    """A function that searches shards for a block of queries; `floored` is a broadcast of floors, or empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        known = floored.value if floored else {}
        floors = np.array([known.get(q, 0.0) for q in asked.ids.tolist()])
        for batch in batches:
            for row in range(batch.num_rows):
                held = {c: batch.column(c)[row].as_buffer() for c in ("ids", "lengths", "docs", "counts")}
                held |= {"dfs": batch.column("dfs")[row].values.to_numpy(), "terms": batch.column("terms")[row].values}
                shard = Shard(held, mean, asked)
                for query, docs, scores in shard.search(floors, k):
                    yield pa.RecordBatch.from_arrays([pa.array(asked.ids[query]), pa.array(shard.ids[docs]), pa.array(scores)], names=["query_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best rows of `docs` for each query (query_id, text).

    A query is the set of its terms; rows that repeat a query_id are one query
    with all their terms, and those without an id or terms have no result.
    Rows of `docs` that share an id, or have none, are scored each; null and
    empty texts match nothing but count as rows. Scores are rounded to 6
    decimals; ties go to the smaller doc_id. No rows, or no queries, give no
    results. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "bm25")
    given = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("doc_id"), "text")
    index = scratch.keep(given.mapInArrow(_index, INDEX), "index", rows=1)
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, mean = totals[0] or 0, (totals[1] or 0) / (totals[0] or 1)
    counted = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.dfs").alias("df"))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column("query_id"), batch.column("text"), strict=True):
                found = sorted(set(terms(text.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([query.as_py()] * len(found), pa.int64()), pa.array(found, pa.string())], names=["query_id", "term"])

    wanted = queries.where("query_id is not null").select(F.col("query_id").cast("bigint").alias("query_id"), "text").mapInArrow(asked, "query_id bigint, term string").distinct()
    idf = F.greatest(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(LEAST_IDF))
    weighed = wanted.join(counted, "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("idf")))).alias("terms"))
    weighed = scratch.keep(weighed, "queries")
    blocks = max(1, -(-(weighed.agg(F.sum(F.size("terms"))).first()[0] or 0) // QUERY_TERMS))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    hits = None
    for block in range(blocks):
        part = weighed if blocks == 1 else weighed.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(Asked(part.select("query_id", F.size("terms").alias("size"), F.col("terms.term"), F.col("terms.idf")).toArrow()))
        columns = index.select("shard", "ids", "lengths", "terms", "dfs", "docs", "counts")
        opens = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
        first = scratch.keep(columns.where(opens).mapInArrow(_searcher(shared, {}, mean, k), HIT), f"first-{block}")
        floors = {r["query_id"]: r["score"] for r in first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).collect()}
        floored = spark.sparkContext.broadcast(floors)
        rest = scratch.keep(columns.where(~opens).mapInArrow(_searcher(shared, floored, mean, k), HIT), f"rest-{block}")
        for sent in (shared, floored):
            sent.destroy()
        part = first.unionByName(rest)
        hits = part if hits is None else hits.unionByName(part)
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "score")


ORACLE_SQL = r"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id),
n AS (SELECT count(*) AS n, (SELECT sum(len) FROM len) / count(*) AS mean FROM documents),
idf AS (SELECT term, greatest(ln((n.n - count(*) + 0.5) / (count(*) + 0.5)), 1e-6) AS idf FROM tf, n GROUP BY term, n.n),
scored AS (
  SELECT q.doc_id AS query_id, tf.doc_id,
         round(sum(idf.idf * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * len.len / n.mean))), 6) AS score
  FROM tf AS q JOIN idf ON q.term = idf.term JOIN tf ON tf.term = q.term JOIN len ON len.doc_id = tf.doc_id, n
  WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, tf.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
