"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.llm import phrases, resampling, retrieval, setjoin
from textweir.llm.common import table
from textweir.llm.decontaminate import leaks
from textweir.llm.html_extract import main_text
from textweir.llm.language import identify, train
from textweir.llm.mixing import mix
from textweir.llm.pii import personal_data
from textweir.llm.recompression import remove_repeats
from textweir.llm.secrets import scan
from textweir.llm.simhash import near_duplicates
from textweir.llm.substrings import deduplicate


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return retrieval.search(docs, docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.similar(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_personal_data": op2_personal_data,
    "op3_source_mixing": op3_source_mixing,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_secret_scans": op6_secret_scans,
    "op7_recompression_dedup": op7_recompression_dedup,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_topk_search": op9_topk_search,
    "op10_language_id": op10_language_id,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_importance_resampling": op13_importance_resampling,
}

#: The pages of these tables are an article between a menu and a footer each, so plain SQL can tell what the text is.
HTML_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS a FROM pages),
t AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(a, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
  '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, regexp_replace(text, '&amp( |$)', '&\1', 'g') AS text, CAST(length(regexp_replace(text, '&amp( |$)', '&\1', 'g')) AS BIGINT) AS n_chars FROM t
"""

REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 49), ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 48, 1))) AS i)),
least_ AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s),
dup AS (SELECT win.doc_id, i FROM win JOIN least_ ON win.s = least_.s WHERE least_.d < win.doc_id),
gone AS (SELECT DISTINCT doc_id, k FROM dup, LATERAL (SELECT unnest(range(i, i + 50)) AS k)),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS x FROM w),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.k) AS t, count(*) AS n FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.k = word.k WHERE gone.k IS NULL GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_html_extraction": HTML_SQL,
    "op7_recompression_dedup": REPEATS_SQL,
    "op9_topk_search": retrieval.ORACLE_SQL,
    "op11_phrase_collocations": phrases.ORACLE_SQL,
    "op12_ngram_jaccard_join": setjoin.ORACLE_SQL,
    "op13_importance_resampling": resampling.ORACLE_SQL,
}
