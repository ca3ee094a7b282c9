"""Streams over the test events, run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.storage import shared_folder
from textweir.streaming import ledgers


def _folder(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.parquet_stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose first errors were recorded; other events are looked at but not recorded."""
    folder = _folder(spark)
    ledgers.append_unseen(_events(spark, sf_dir).select("user_id", "event_type"), "user_id", f"{folder}/ledger", f"{folder}/checkpoint", F.col("event_type") == "error")
    return spark.read.parquet(f"{folder}/ledger").select("user_id")


def stream_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    outcomes = _events(spark, sf_dir).where(F.col("event_type").isin("error", "purchase"))
    rows = outcomes.select("user_id", (F.col("event_type") == "purchase").alias("ok"), F.struct("ts", "event_id").alias("ord"))
    ledgers.count_failures(rows, "user_id", "ok", f"{folder}/state", f"{folder}/checkpoint")
    return ledgers.last_state(spark, f"{folder}/state")


def dedup_within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (user, type) pairs, by a stream whose delay spans all events."""
    folder = _folder(spark)
    pairs = ledgers.distinct_within(_events(spark, sf_dir), "at", "60 days", "user_id", "event_type").select("user_id", "event_type")
    query = pairs.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a day and type, in the stream's complete output."""
    folder = _folder(spark)
    counts = ledgers.windowed_counts(_events(spark, sf_dir), "at", "1 day", "1 day", "event_type")

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    query = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {f.__name__: f for f in (stream_ledger, stream_attempts, dedup_within_watermark, windowed_counts)}
ORACLE_SQL = {
    "stream_ledger": "SELECT DISTINCT user_id FROM events WHERE event_type = 'error'",
    "stream_attempts": """
WITH o AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS ok FROM events WHERE event_type IN ('error', 'purchase')),
r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM o),
n AS (SELECT user_id, run, count(*) FILTER (NOT ok) AS n FROM r GROUP BY user_id, run)
SELECT user_id, arg_max(n, run) AS attempts, max(n) >= 3 AS failed FROM n GROUP BY user_id""",
    "dedup_within_watermark": "SELECT DISTINCT user_id, event_type FROM events",
    "windowed_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
