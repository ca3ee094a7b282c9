"""Search over the test corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import segments
from textweir.operators import search as S
from textweir.operators.chunk import chunk_table
from textweir.plans.corpus import CORPUS_SQL, corpus, spread, table
from textweir.storage import shared_folder

OR_QUERY, AND_QUERY = "trash pathetic idiot worthless", '"of the" "and the"'
FILTERS = S.Filters(corpora=("raw",), since="2024-02-01", until="2024-10-31", sources=("src1", "src2/*", "src7"))
HYBRID = 'token trash "is the"'
QUERY_VECTOR = 0
#: Numbers of chunks are below this within a document.
CHUNKS_OF_ONE = 1 << 20


def whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one chunk each."""
    lines = F.concat(F.lit("1-"), F.size(F.split("text", "\n", -1)).cast("string"))
    return corpus(spark, sf_dir).withColumnRenamed("doc_id", "chunk_id").withColumn("lines", lines)


_built: dict[tuple[str, str, str], segments.Index] = {}


def _index(spark: SparkSession, sf_dir: str, name: str, make) -> segments.Index:
    """An index over the corpus that is built once for an application and read by every query after."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = make(segments.Index(spark, shared_folder(spark, name), 0, (), 8 if name == "documents" else segments.SLOT_BITS))
    return _built[key]


def indexed(spark: SparkSession, sf_dir: str) -> segments.Index:
    """Documents as one chunk each, with the vectors of the same numbers."""

    def make(empty: segments.Index) -> segments.Index:
        whole = spread(whole_documents(spark, sf_dir)).withColumn("doc_id", F.col("chunk_id"))
        chunks = whole.select("chunk_id", "doc_id", F.lit(0).alias("ord"), F.lit(1).alias("start_line"), F.lit(1).alias("end_line"), "text")
        attrs = whole.select("chunk_id", "doc_id", "path", "corpus", "source", "date", "lines")
        vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
        return segments.publish(empty, [segments.written(empty, "whole", 0, {"chunks": chunks, "attributes": attrs}, vectors)])

    return _index(spark, sf_dir, "documents", make)


def keyword_rank(spark: SparkSession, sf_dir: str, query: str, filters: S.Filters = S.Filters()) -> DataFrame:
    return segments.keyword_rank(indexed(spark, sf_dir), S.compile_query(query), filters)


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    row = table(spark, sf_dir, "embeddings").where(F.col("vec_id") == QUERY_VECTOR).select("embedding").first()
    return list(row["embedding"])


def keyword_search_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_rank(spark, sf_dir, OR_QUERY).select("chunk_id", "path", "bm25", "kw_rank")


def keyword_search_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_rank(spark, sf_dir, AND_QUERY).select("chunk_id", "path", "bm25", "kw_rank")


def keyword_search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_rank(spark, sf_dir, OR_QUERY, FILTERS).select("chunk_id", "path", "bm25", "kw_rank")


def search_until_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An `until` alone lets undated documents pass; `strict_dates` does not."""
    docs = corpus(spark, sf_dir)
    loose, strict = S.Filters(until="2024-03-31"), S.Filters(until="2024-03-31", strict_dates=True)
    return docs.agg(F.count_if(loose.condition()).alias("loose"), F.count_if(strict.condition()).alias("strict"), F.count_if(F.col("date") == "").alias("undated"))


def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.vector_rank(indexed(spark, sf_dir), query_vector(spark, sf_dir)).select("chunk_id", "similarity", "vec_rank")


def vector_search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.vector_rank(indexed(spark, sf_dir), query_vector(spark, sf_dir), FILTERS).select("chunk_id", "path", "similarity", "vec_rank")


def _vector_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.vector_rank(indexed(spark, sf_dir), query_vector(spark, sf_dir), S.Filters())


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return keyword_rank(spark, sf_dir, HYBRID), _vector_list(spark, sf_dir)


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.assemble(S.fuse(*_lists(spark, sf_dir)))


def hybrid_search_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.assemble(S.fuse(*_lists(spark, sf_dir)), by_date=True)


def rank_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fused row, before capping."""
    return S.fuse(*_lists(spark, sf_dir)).select("chunk_id", "path", "kw_rank", "vec_rank", F.round("score", 8).alias("score"), "via")


def keyword_mode_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.assemble(S.fuse(keyword_rank(spark, sf_dir, HYBRID), None), pins=0)


def vector_mode_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.assemble(S.fuse(None, _vector_list(spark, sf_dir)), pins=0)


def search_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir)
    return docs.select("doc_id", S.snippet(F.col("text"), "trash pathetic token").alias("snippet"))


def chunked(spark: SparkSession, sf_dir: str) -> segments.Index:
    """Documents in chunks; a document's vector belongs to its first one."""

    def make(empty: segments.Index) -> segments.Index:
        docs = corpus(spark, sf_dir)
        parts = chunk_table(spread(docs)).select((F.col("doc_id") * CHUNKS_OF_ONE + F.col("ord")).alias("chunk_id"), "doc_id", "ord", "start_line", "end_line", "text")
        vectors = table(spark, sf_dir, "embeddings").select((F.col("vec_id") * CHUNKS_OF_ONE).alias("chunk_id"), "embedding")
        return segments.publish(empty, [segments.written(empty, "chunked", 0, {"chunks": parts, "attributes": lambda t: segments.attributes(docs, t["chunks"])}, vectors)])

    return _index(spark, sf_dir, "chunks", make)


def hybrid_search_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunks of a document at most, over the chunk table."""
    index = chunked(spark, sf_dir)
    words = segments.keyword_rank(index, S.compile_query(HYBRID))
    return S.assemble(S.fuse(words, segments.vector_rank(index, query_vector(spark, sf_dir), S.Filters())), per_doc=2)


def hydrated_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned rows with their texts, joined last, as JSON lines."""
    found = segments.search(indexed(spark, sf_dir), HYBRID, vector=query_vector(spark, sf_dir))
    return found.select("pos", F.md5(F.concat_ws("|", "path", "date", "source", "lines", "via", "text")).alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        hydrated_results, keyword_search_or, keyword_search_phrase, keyword_search_filtered, search_until_undated, vector_search, vector_search_filtered, hybrid_search,
        hybrid_search_by_date, rank_fusion, keyword_mode_search, vector_mode_search, search_snippet, hybrid_search_per_doc,
    )
}


def _count_sql(phrase: tuple[str, ...]) -> str:
    if len(phrase) == 1:
        return f"len(list_filter(w, lambda x: x = '{phrase[0]}'))"
    at = " AND ".join(f"w[i + {k}] = '{t}'" for k, t in enumerate(phrase))
    return f"len(list_filter(range(1, greatest(len(w) - {len(phrase) - 2}, 1)), lambda i: {at}))"


def keyword_sql(text: str, where: str = "TRUE", corpus_sql: str = f"{CORPUS_SQL},") -> str:
    query = S.compile_query(text)
    n = range(len(query.phrases))
    tf = ", ".join(f"{_count_sql(p)} AS f{i}" for i, p in enumerate(query.phrases))
    df = ", ".join(f"sum(CASE WHEN f{i} > 0 THEN 1 ELSE 0 END) AS d{i}" for i in n)
    score = " + ".join(f"greatest(ln((n - d{i} + 0.5) / (d{i} + 0.5)), 1e-6) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * len / mean))" for i in n)
    match = (" AND " if query.how == "and" else " OR ").join(f"f{i} > 0" for i in n)
    return f"""{corpus_sql}
words AS (SELECT *, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+') AS w FROM corpus),
counted AS (SELECT doc_id, corpus, source, date, path, '1-' || len(string_split(text, chr(10))) AS lines, len(w) AS len, {tf} FROM words),
stats AS (SELECT count(*) AS n, avg(len) AS mean, {df} FROM counted),
scored AS (SELECT counted.*, round(-({score}), 6) AS bm25 FROM counted, stats WHERE {match}),
kw AS (SELECT doc_id AS chunk_id, path, date, source, lines, bm25, CAST(row_number() OVER (ORDER BY bm25, doc_id) - 1 AS INTEGER) AS kw_rank
       FROM scored WHERE {where} QUALIFY kw_rank < {S.POOL})"""


FILTER_SQL = "corpus = 'raw' AND date >= '2024-02-01' AND date <= '2024-10-31' AND (source = 'src1' OR path LIKE 'src2/%' OR source = 'src7')"
DOT_SQL = f"round(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = {QUERY_VECTOR}) AS DOUBLE[])), 6)"


def _vector_sql(where: str = "TRUE") -> str:
    return f"""sims AS (SELECT e.vec_id AS chunk_id, c.path, c.date, c.source, '1-' || len(string_split(c.text, chr(10))) AS lines, {DOT_SQL} AS similarity
       FROM embeddings AS e JOIN corpus AS c ON c.doc_id = e.vec_id WHERE {where}),
vec AS (SELECT *, CAST(row_number() OVER (ORDER BY similarity DESC, chunk_id) - 1 AS INTEGER) AS vec_rank FROM sims QUALIFY vec_rank < {S.POOL})"""


FUSED_SQL = f"""WITH {keyword_sql(HYBRID)}, {_vector_sql()},
fused AS (
  SELECT coalesce(kw.chunk_id, vec.chunk_id) AS chunk_id, coalesce(kw.path, vec.path) AS path, coalesce(kw.date, vec.date) AS date,
         coalesce(kw.source, vec.source) AS source, coalesce(kw.lines, vec.lines) AS lines, kw_rank, vec_rank,
         coalesce(0.5 / (61 + kw_rank), 0) + coalesce(1.0 / (61 + vec_rank), 0) AS score,
         concat_ws('+', CASE WHEN kw_rank IS NOT NULL THEN 'keyword' END, CASE WHEN vec_rank IS NOT NULL THEN 'vector' END) AS via
  FROM kw FULL OUTER JOIN vec ON kw.chunk_id = vec.chunk_id)"""
PLACED_SQL = """,
placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, kw_rank NULLS LAST, vec_rank NULLS LAST) AS at_ FROM fused QUALIFY at_ <= 10),
pins AS (SELECT * FROM fused WHERE kw_rank IS NOT NULL QUALIFY row_number() OVER (ORDER BY kw_rank) <= 3),
missing AS (SELECT * FROM pins WHERE path NOT IN (SELECT path FROM placed)),
final AS (
  SELECT * FROM placed WHERE at_ <= 10 - (SELECT count(*) FROM missing)
  UNION ALL SELECT *, 1000000 + kw_rank FROM missing)
"""
PLACED_COLUMNS = 'chunk_id, path, date, source, lines, round(score, 5) AS score, via FROM final'
ONE_LIST = """SELECT CAST(row_number() OVER (ORDER BY {rank}) AS INTEGER) AS pos, chunk_id, path, date, source, lines,
  round(1.0 / (61 + {rank}), 5) AS score, '{via}' AS via FROM {name} QUALIFY pos <= 10"""

ORACLE_SQL = {
    "hydrated_results": f"""{FUSED_SQL}{PLACED_SQL}, told AS (SELECT CAST(row_number() OVER (ORDER BY at_) AS INTEGER) AS pos, {PLACED_COLUMNS})
        SELECT pos, md5(concat_ws('|', path, date, told.source, lines, via, documents.text)) AS digest FROM told JOIN documents ON doc_id = chunk_id""",
    "keyword_search_or": f"WITH {keyword_sql(OR_QUERY)} SELECT chunk_id, path, bm25, kw_rank FROM kw",
    "keyword_search_phrase": f"WITH {keyword_sql(AND_QUERY)} SELECT chunk_id, path, bm25, kw_rank FROM kw",
    "keyword_search_filtered": f"WITH {keyword_sql(OR_QUERY, FILTER_SQL)} SELECT chunk_id, path, bm25, kw_rank FROM kw",
    "search_until_undated": f"""WITH {CORPUS_SQL} SELECT count(*) FILTER (date <= '2024-03-31') AS loose,
        count(*) FILTER (date <= '2024-03-31' AND date <> '') AS strict, count(*) FILTER (date = '') AS undated FROM corpus""",
    "vector_search": f"""WITH sims AS (SELECT e.vec_id AS chunk_id, {DOT_SQL} AS similarity FROM embeddings AS e)
        SELECT *, CAST(row_number() OVER (ORDER BY similarity DESC, chunk_id) - 1 AS INTEGER) AS vec_rank FROM sims QUALIFY vec_rank < {S.POOL}""",
    "vector_search_filtered": f"WITH {CORPUS_SQL}, {_vector_sql(FILTER_SQL)} SELECT chunk_id, path, similarity, vec_rank FROM vec",
    "hybrid_search": f"{FUSED_SQL}{PLACED_SQL} SELECT CAST(row_number() OVER (ORDER BY at_) AS INTEGER) AS pos, {PLACED_COLUMNS}",
    "hybrid_search_by_date": f"{FUSED_SQL}{PLACED_SQL} SELECT CAST(row_number() OVER (ORDER BY date, at_) AS INTEGER) AS pos, {PLACED_COLUMNS}",
    "rank_fusion": f"{FUSED_SQL} SELECT chunk_id, path, kw_rank, vec_rank, round(score, 8) AS score, via FROM fused",
    "keyword_mode_search": f"WITH {keyword_sql(HYBRID)} {ONE_LIST.format(rank='kw_rank', via='keyword', name='kw')}",
    "vector_mode_search": f"WITH {CORPUS_SQL}, {_vector_sql()} {ONE_LIST.format(rank='vec_rank', via='vector', name='vec')}",
    "search_snippet": """
WITH spots AS (
  SELECT doc_id, text, list_filter([strpos(lower(text), 'trash'), strpos(lower(text), 'pathetic'), strpos(lower(text), 'token')], lambda x: x > 0) AS at_ FROM documents),
cut AS (SELECT *, CASE WHEN len(at_) > 0 THEN greatest(list_min(at_) - 1 - 93, 0) ELSE 0 END AS start FROM spots)
SELECT doc_id, (CASE WHEN start > 0 THEN '…' ELSE '' END) || replace(substr(text, start + 1, 280), chr(10), ' ')
       || (CASE WHEN start + 280 < length(text) THEN '…' ELSE '' END) AS snippet FROM cut""",
}
