"""How the engine's concepts map onto the shared test tables, in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the index's attributes; undated ones have an empty date."""
    docs = table(spark, sf_dir, "documents")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(366)).cast("int")), "yyyy-MM-dd")
    return docs.select(
        "doc_id",
        F.when(F.col("lang") == "en", "raw").otherwise("briefs").alias("corpus"),
        "source",
        F.when(F.pmod("doc_id", F.lit(17)) == 0, "").otherwise(day).alias("date"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        "text",
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over the cores where a scan has too few splits to keep them busy; larger scans stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(2 * cores) if rows.rdd.getNumPartitions() < 2 * cores else rows


CORPUS_SQL = """
corpus AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN 'raw' ELSE 'briefs' END AS corpus, source,
         CASE WHEN doc_id % 17 = 0 THEN '' ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') END AS date,
         source || '/' || CAST(doc_id AS VARCHAR) AS path, text
  FROM documents)
"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech segments: a user's events are an episode, event types are speakers, times are in seconds."""
    events = table(spark, sf_dir, "events")
    from pyspark.sql.window import Window

    of_user = Window.partitionBy("user_id")
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    return (
        events.withColumn("start", F.round(seconds("ts") - F.min(seconds("ts")).over(of_user), 3))
        .withColumn("ord", F.row_number().over(of_user.orderBy("ts", "event_id")))
        .select(F.col("user_id").alias("episode"), "ord", F.col("event_type").alias("speaker"), "start", F.round(F.col("start") + F.col("value"), 3).alias("end"), "event_id", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("text"))
    )


SEGMENTS_SQL = """
timed AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM events),
segments AS (
  SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord, event_type AS speaker,
         round(s - min(s) OVER (PARTITION BY user_id), 3) AS start,
         round(round(s - min(s) OVER (PARTITION BY user_id), 3) + value, 3) AS "end", event_id, event_type || ' ' || CAST(event_id AS VARCHAR) AS text
  FROM timed)
"""
