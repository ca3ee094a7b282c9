"""Chunks of the test documents; the SQL folds them in a recursive query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators.chunk import chunk_table
from textweir.plans.corpus import table

COLUMNS = ("doc_id", "ord", "start_line", "end_line", "n_words")


def chunk_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_table(table(spark, sf_dir, "documents")).select(*COLUMNS, F.md5("text").alias("digest"))


def chunk_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line opens an item."""
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.when(i % 3 == 2, F.concat(F.lit("** "), line)).otherwise(line))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    return chunk_table(docs, digest=True).select(*COLUMNS)


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunk_table(table(spark, sf_dir, "documents"))
    return made.agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("doc_id").alias("docs"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest"), F.count_if(F.col("n_words") > 450).alias("over_budget"))


QUERIES = {f.__name__: f for f in (chunk_std, chunk_digest, chunk_stats)}


def _sql(line: str, budget: int, overlap: int, item: str) -> str:
    return rf"""
WITH RECURSIVE lines AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS ln, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
words AS (SELECT doc_id, ln, {item} AS item, regexp_extract_all({line}, '\S+') AS w FROM lines),
pieces AS (SELECT doc_id, ln, item AND o = 0 AS item, o, list_slice(w, o + 1, o + {budget}) AS w FROM words, LATERAL (SELECT unnest(range(0, len(w), {budget})) AS o)),
units AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln, o) AS i, ln, item, len(w) AS n, array_to_string(w, ' ') AS t FROM pieces),
fold AS (
  SELECT doc_id, i, 0 AS ord, [{{'ln': ln, 'n': n, 't': t}}] AS cur, n AS size, CAST(NULL AS STRUCT(ln BIGINT, n BIGINT, t VARCHAR)[]) AS done FROM units WHERE i = 1
  UNION ALL
  SELECT doc_id, i, ord + CASE WHEN cut THEN 1 ELSE 0 END, list_append(carry, {{'ln': ln, 'n': n, 't': t}}),
         coalesce(list_sum(list_transform(carry, lambda x: x.n)), 0) + n, CASE WHEN cut THEN cur END
  FROM (SELECT u.doc_id, u.i, f.ord, u.ln, u.n, u.t, f.cur, f.size + u.n > {budget} OR ({overlap} = 0 AND u.item AND f.size >= 25) AS cut,
          CASE WHEN f.size + u.n > {budget} OR ({overlap} = 0 AND u.item AND f.size >= 25)
            THEN list_slice(f.cur, len(f.cur) + 1 - len(list_filter(range(1, len(f.cur) + 1), lambda j: list_sum(list_transform(list_slice(f.cur, j, len(f.cur)), lambda x: x.n)) <= {overlap})), len(f.cur))
            ELSE f.cur END AS carry
        FROM fold AS f JOIN units AS u ON u.doc_id = f.doc_id AND u.i = f.i + 1)),
made AS (SELECT doc_id, ord - 1 AS ord, done AS c FROM fold WHERE done IS NOT NULL
  UNION ALL SELECT doc_id, ord, cur FROM fold QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1),
chunks AS (SELECT doc_id, CAST(ord AS INTEGER) AS ord, CAST(c[1].ln AS INTEGER) AS start_line, CAST(c[len(c)].ln AS INTEGER) AS end_line,
  CAST(list_sum(list_transform(c, lambda x: x.n)) AS INTEGER) AS n_words, md5(array_to_string(list_transform(c, lambda x: x.t), ' ')) AS digest FROM made)
"""


STD, DIGEST = _sql("line", 450, 50, "false"), _sql("CASE WHEN ln % 3 = 0 THEN '** ' || line ELSE line END", 200, 0, "ln % 3 = 0")
ORACLE_SQL = {
    "chunk_std": f"{STD} SELECT * FROM chunks",
    "chunk_digest": f"{DIGEST} SELECT {', '.join(COLUMNS)} FROM chunks",
    "chunk_stats": f"""{STD} SELECT count(*) AS chunks, count(DISTINCT doc_id) AS docs, CAST(sum(n_words) AS BIGINT) AS words, max(n_words) AS longest,
        count(*) FILTER (n_words > 450) AS over_budget FROM chunks""",
}
