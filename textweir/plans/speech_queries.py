"""Speakers, hosts and chapters over the test events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import speech
from textweir.plans.corpus import SEGMENTS_SQL, segments

DAY = 86_400.0


def speaker_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech.speaker_blocks(segments(spark, sf_dir))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views, widened by an hour, as turns of their event."""
    views = segments(spark, sf_dir).where(F.col("speaker") == "view")
    name = F.concat(F.lit("T"), F.pmod("event_id", F.lit(3)).cast("string"))
    return views.select("episode", "ord", (F.col("start") - 3600).alias("t_start"), (F.col("end") + 3600).alias("t_end"), name.alias("speaker"))


def align_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech.align_speakers(segments(spark, sf_dir), turns(spark, sf_dir))


def host_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech.host_speakers(segments(spark, sf_dir), 5 * DAY)


def chapter_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups as chapters, attached to the block that follows."""
    all_segments = segments(spark, sf_dir)
    chapters = all_segments.where(F.col("speaker") == "signup").select("episode", F.col("start").alias("ts"))
    blocks = speech.speaker_blocks(all_segments.where(F.col("speaker") != "signup"))
    return speech.chapters_to_blocks(chapters, blocks.select("episode", "start"))


def speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers and segments of each episode."""
    return segments(spark, sf_dir).groupBy("episode").agg(F.countDistinct("speaker").alias("speakers"), F.count(F.lit(1)).alias("segments"))


QUERIES = {f.__name__: f for f in (speaker_blocks, align_midpoint, host_detection, chapter_asof, speaker_turns)}
BLOCKS_SQL = """
marked AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY episode ORDER BY ord) THEN 0 ELSE 1 END AS c FROM {source}),
islands AS (SELECT *, sum(c) OVER (PARTITION BY episode ORDER BY ord) AS block FROM marked),
blocks AS (SELECT episode, CAST(block AS BIGINT) AS block, arg_min(speaker, ord) AS speaker, arg_min(start, ord) AS start, arg_max("end", ord) AS "end", count(*) AS segments,
           string_agg(text, ' ' ORDER BY ord) AS text FROM islands GROUP BY episode, block)"""
ORACLE_SQL = {
    "speaker_blocks": f"WITH {SEGMENTS_SQL}, {BLOCKS_SQL.format(source='segments')} SELECT * FROM blocks",
    "align_midpoint": f"""WITH {SEGMENTS_SQL},
turns AS (SELECT episode, ord AS turn, start - 3600 AS a, "end" + 3600 AS b, 'T' || CAST(event_id % 3 AS VARCHAR) AS who FROM segments WHERE speaker = 'view'),
hits AS (SELECT s.episode, s.ord, turn, who, a <= (s.start + s."end") / 2 AND (s.start + s."end") / 2 <= b AS holds, least(s."end", b) - greatest(s.start, a) AS shared
         FROM segments AS s JOIN turns USING (episode)),
first_ AS (SELECT episode, ord, arg_min(who, turn) AS who FROM hits WHERE holds GROUP BY episode, ord),
over_ AS (SELECT episode, ord, who FROM hits WHERE shared > 0 QUALIFY row_number() OVER (PARTITION BY episode, ord ORDER BY shared DESC, turn) = 1)
SELECT s.episode, s.ord, coalesce(first_.who, over_.who, 'Unknown') AS speaker FROM segments AS s
LEFT JOIN first_ ON s.episode = first_.episode AND s.ord = first_.ord LEFT JOIN over_ ON s.episode = over_.episode AND s.ord = over_.ord""",
    "host_detection": f"""WITH {SEGMENTS_SQL},
seen AS (SELECT *, max(CASE WHEN start >= {5 * DAY} THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY ord) AS past FROM segments),
total AS (SELECT episode, speaker, round(sum(least("end", {5 * DAY}) - start), 3) AS seconds, min(ord) AS first_ FROM seen
          WHERE past = 0 AND least("end", {5 * DAY}) - start > 0 GROUP BY episode, speaker)
SELECT episode, speaker AS host, seconds FROM total QUALIFY row_number() OVER (PARTITION BY episode ORDER BY seconds DESC, first_) = 1""",
    "chapter_asof": f"""WITH {SEGMENTS_SQL}, others AS (SELECT * FROM segments WHERE speaker <> 'signup'), {BLOCKS_SQL.format(source='others')}
SELECT c.episode, c.start AS ts, (SELECT min(b.start) FROM blocks AS b WHERE b.episode = c.episode AND b.start >= c.start) AS block_start
FROM segments AS c WHERE speaker = 'signup'""",
    "speaker_turns": "SELECT user_id AS episode, count(DISTINCT event_type) AS speakers, count(*) AS segments FROM events GROUP BY user_id",
}
