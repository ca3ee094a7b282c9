"""What polls decide, over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import index, polls
from textweir.plans.corpus import table


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat(F.lit("https://x/p/"), F.col("p_partkey").cast("string")).alias("url"))


def poll_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledgers after a poll that tried every second part and failed for every third of those."""
    rows = _parts(spark, sf_dir)
    known = {
        "processed": rows.where("k % 10 = 1").select("url"),
        "failed": rows.where("k % 10 = 3").select("url"),
        "attempts": rows.where("k % 4 = 0").select("url", F.expr("cast(1 + k % 5 % 2 as int)").alias("attempts")),
    }
    new = polls.after(rows.where("k % 2 = 0").select("url", (F.col("k") % 3 != 0).alias("ok")), known)
    none = F.lit(None).cast("int")
    out = new["attempts"].select(F.lit("attempts").alias("ledger"), "url", "attempts")
    for name in ("processed", "failed"):
        out = out.unionByName(new[name].select(F.lit(name).alias("ledger"), "url", none.alias("attempts")))
    return out


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of a listing: every fifth has no date, and the listing knows a day, a month, or nothing."""
    page = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    ship = F.date_add("o_orderdate", F.pmod("o_orderkey", F.lit(40)).cast("int"))
    listed = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.date_format(ship, "yyyy-MM")).when(F.pmod("o_orderkey", F.lit(3)) == 1, F.date_format(ship, "yyyy-MM-dd")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", page.alias("page"), listed.alias("listed"))


def article_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of articles from feeds and from listings; those of January 1995 are no dates."""
    rows = _dated(spark, sf_dir)
    day = lambda kind: polls.article_date(polls.Source("s", kind, ignore_dates=("1995-01",)), F.col("page"), F.col("listed"), F.lit("https://x/a"), F.lit("2024-06-01"))
    return rows.select("o_orderkey", day("rss").alias("of_feed"), day("html").alias("of_listing"))


def numbered_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ids: the known ones keep theirs, and the new ones have distinct ids beyond, without gaps."""
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"))
    known = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"), (F.col("doc_id") + 7).alias("doc_id"))
    made = index.numbered(files, known).join(known.select("path", F.col("doc_id").alias("old")), "path", "left")
    new = F.col("old").isNull()
    return made.agg(
        F.count_if(F.col("old") == F.col("doc_id")).alias("kept"), F.count_if(new).alias("added"), F.countDistinct("doc_id").alias("ids"),
        F.min(F.when(new, F.col("doc_id"))).alias("first_new"), F.max(F.when(new, F.col("doc_id"))).alias("last_new"),
    )


QUERIES = {f.__name__: f for f in (poll_ledgers, article_dates, numbered_docs)}

ORACLE_SQL = {
    "poll_ledgers": """WITH p AS (SELECT p_partkey AS k, 'https://x/p/' || CAST(p_partkey AS VARCHAR) AS url FROM part),
        c AS (SELECT k, url, CASE WHEN k % 2 = 0 AND k % 3 <> 0 THEN 0 ELSE (CASE WHEN k % 4 = 0 THEN 1 + k % 5 % 2 ELSE 0 END) + (CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END) END AS n FROM p)
        SELECT 'attempts' AS ledger, url, CAST(n AS INTEGER) AS attempts FROM c WHERE n BETWEEN 1 AND 2
        UNION ALL SELECT 'processed', url, NULL FROM p WHERE k % 10 = 1 OR (k % 2 = 0 AND k % 3 <> 0)
        UNION ALL SELECT 'failed', url, NULL FROM c WHERE k % 10 = 3 OR n >= 3""",
    "article_dates": """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS page,
          CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate + CAST(o_orderkey % 40 AS INTEGER) * INTERVAL 1 DAY, '%Y-%m')
            WHEN 1 THEN strftime(o_orderdate + CAST(o_orderkey % 40 AS INTEGER) * INTERVAL 1 DAY, '%Y-%m-%d') ELSE '' END AS listed FROM orders),
        f AS (SELECT *, CASE WHEN page LIKE '1995-01%' THEN coalesce(nullif(listed, ''), '2024-06-01') ELSE page END AS own FROM o)
        SELECT o_orderkey, coalesce(nullif(own, ''), nullif(listed, '')) AS of_feed,
          CASE WHEN length(listed) = 7 THEN CASE WHEN left(own, 7) = listed THEN own ELSE listed || '-01' END
            WHEN listed <> '' THEN listed ELSE nullif(own, '') END AS of_listing FROM f""",
    "numbered_docs": """SELECT count(*) FILTER (doc_id % 3 = 0) AS kept, count(*) FILTER (doc_id % 3 <> 0) AS added, count(*) AS ids,
        max(CASE WHEN doc_id % 3 = 0 THEN doc_id + 7 END) + 1 AS first_new, max(CASE WHEN doc_id % 3 = 0 THEN doc_id + 7 END) + count(*) FILTER (doc_id % 3 <> 0) AS last_new FROM documents""",
}
