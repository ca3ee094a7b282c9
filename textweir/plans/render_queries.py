"""Rendered documents, ledgers' appends and configuration over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions import dates
from textweir.operators import render, speech
from textweir.plans.corpus import SEGMENTS_SQL, corpus, segments, table
from textweir.plans.speech_queries import BLOCKS_SQL
from textweir.sources import files


def render_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = segments(spark, sf_dir)
    hosts = speech.host_speakers(made, 432_000.0).select("episode", "host", F.concat(F.lit("Host"), F.col("episode").cast("string"), F.lit(" Name")).alias("name"))
    return render.transcript(made, hosts).select("episode", F.md5("content").alias("digest"), F.length("content").alias("n_chars"))


def render_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.col("text"))
    made = render.paper(F.concat(F.lit('A "'), F.col("source"), F.lit('"')), F.array("lang", "source"), F.col("text"), F.col("n_chars"), F.lit("https://x/1"), F.array(F.lit("Deep Nets"), F.col("lang")), body)
    return docs.select("doc_id", F.md5(made).alias("digest"))


def metadata_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = render.header(title=F.col("source"), link=F.when(F.pmod("doc_id", F.lit(2)) == 0, F.lit("")).otherwise(F.lit("https://x/")), lang=F.col("lang"))
    return docs.select("doc_id", made.alias("header"))


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that an idempotent append adds to a ledger of some."""
    docs = table(spark, sf_dir, "documents")
    return render.append_new(docs.select("source"), docs.where("doc_id % 20 < 5").select("source"), "source")


def headers_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose new header differs from the one they have."""
    new = metadata_header(spark, sf_dir)
    old = new.where("doc_id % 11 <> 0").withColumn("header", F.when(F.pmod("doc_id", F.lit(4)) == 0, F.lit("---\n---\n")).otherwise(F.col("header")))
    return render.changed_only(old, new, "doc_id", "header").select("doc_id")


def config_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds' settings over the defaults."""
    defaults = F.create_map(F.lit("limit"), F.lit("10"), F.lit("order"), F.lit("newest"))
    own = F.when(F.pmod("n_nationkey", F.lit(2)) == 0, F.create_map(F.lit("limit"), F.col("n_nationkey").cast("string"))).otherwise(F.create_map(F.lit("delay"), F.lit("2")))
    made = table(spark, sf_dir, "nation").select("n_name", files.merged(defaults, own).alias("m"))
    return made.select("n_name", *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("limit", "order", "delay")))


def worker_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of a feed dealt to three workers in turn."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.pmod(n - 1, F.lit(3)) + 1).alias("worker"))


def weekly_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs of a window and the week behind it."""
    docs = corpus(spark, sf_dir).where("corpus = 'briefs' AND date <> ''")
    return docs.where(F.col("date").between("2024-03-01", F.date_format(F.date_add(F.lit("2024-03-31").cast("date"), 7), "yyyy-MM-dd"))).select("doc_id", "date", dates.prior_run(F.left("date", F.lit(7))).alias("prior"))


QUERIES = {f.__name__: f for f in (render_transcript, render_paper, metadata_header, ledger_append, headers_changed, config_merge, worker_labels, weekly_window)}
HEADER_SQL = """h AS (SELECT doc_id, concat_ws(chr(10), '---', 'title: "' || source || '"', CASE WHEN doc_id % 2 <> 0 THEN 'link: "https://x/"' END, 'lang: "' || lang || '"', '---', '') AS header FROM documents)"""
STAMP_SQL = """CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END"""
ORACLE_SQL = {
    "render_transcript": f"""WITH {SEGMENTS_SQL},
seen AS (SELECT *, max(CASE WHEN start >= 432000 THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY ord) AS past FROM segments),
total AS (SELECT episode, speaker, round(sum(least("end", 432000) - start), 3) AS seconds, min(ord) AS first_ FROM seen
          WHERE past = 0 AND least("end", 432000) - start > 0 GROUP BY episode, speaker),
hosts AS (SELECT episode, speaker AS host FROM total QUALIFY row_number() OVER (PARTITION BY episode ORDER BY seconds DESC, first_) = 1),
{BLOCKS_SQL.format(source='segments')},
told AS (SELECT b.episode, block, '**' || CASE WHEN speaker = host THEN 'Host' || CAST(b.episode AS VARCHAR) ELSE 'Speaker ' || speaker END || '** (' || {STAMP_SQL} || '): ' || text AS line
         FROM (SELECT *, CAST(floor(start) AS BIGINT) AS s FROM blocks) AS b LEFT JOIN hosts ON hosts.episode = b.episode)
SELECT episode, md5(string_agg(line, chr(10) || chr(10) ORDER BY block)) AS digest, CAST(length(string_agg(line, chr(10) || chr(10) ORDER BY block)) AS INTEGER) AS n_chars FROM told GROUP BY episode""",
    "render_paper": r"""SELECT doc_id, md5(concat_ws(chr(10), '---', 'title: "A \"' || source || '\""', 'type: paper', 'authors: [' || lang || ', ' || source || ']', 'url: https://x/1',
        'upvotes: ' || CAST(n_chars AS VARCHAR), 'tags: [deep-nets, ' || lang || ']', 'full_text: ' || CASE WHEN doc_id % 3 = 0 AND text <> '' THEN 'true' ELSE 'false' END, '---', '', '# A "' || source || '"', '',
        '## Abstract', '', text, CASE WHEN doc_id % 3 = 0 AND text <> '' THEN chr(10) || '## Full text' || chr(10) || chr(10) || text END)) AS digest FROM documents""",
    "metadata_header": f"WITH {HEADER_SQL} SELECT * FROM h",
    "ledger_append": "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 20 < 5)",
    "headers_changed": "SELECT doc_id FROM documents WHERE doc_id % 11 = 0 OR doc_id % 4 = 0",
    "config_merge": """SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS VARCHAR) ELSE '10' END AS "limit", 'newest' AS "order", CASE WHEN n_nationkey % 2 = 1 THEN '2' END AS delay FROM nation""",
    "worker_labels": "SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 3 + 1 AS INTEGER) AS worker FROM orders",
    "weekly_window": """SELECT doc_id, date, strftime(CAST(left(date, 7) || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') AS prior FROM (
        SELECT doc_id, strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') AS date FROM documents WHERE lang <> 'en' AND doc_id % 17 <> 0) WHERE date BETWEEN '2024-03-01' AND '2024-04-07'""",
}
