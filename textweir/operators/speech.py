"""Speakers and chapters over time: islands, interval and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions.media import stamp_seconds

# Fixed value: the opening in which the host speaks most, in seconds.
OPENING = 60.0
#: Seconds of a time bucket for the interval join.
BUCKET = 3600.0


def speaker_blocks(segments: DataFrame) -> DataFrame:
    """Runs of segments of one speaker: (episode, block, speaker, start, end, segments, text), the texts in order and joined by a blank.

    Segments without a `text` column give empty texts.
    """
    w = Window.partitionBy("episode").orderBy("ord")
    changed = F.coalesce(F.col("speaker") != F.lag("speaker").over(w), F.lit(True)).cast("int")
    told = F.col("text") if "text" in segments.columns else F.lit("")
    islands = segments.withColumns({"_c": changed, "_text": told}).withColumn("block", F.sum("_c").over(w))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("ord", "_text"))), lambda x: x["_text"])
    return islands.groupBy("episode", "block").agg(
        F.min_by("speaker", "ord").alias("speaker"), F.min_by("start", "ord").alias("start"), F.max_by("end", "ord").alias("end"), F.count(F.lit(1)).alias("segments"), F.array_join(texts, " ").alias("text")
    )


def _buckets(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / BUCKET).cast("int"), F.floor(F.greatest(start, end) / BUCKET).cast("int")))


def align_speakers(segments: DataFrame, turns: DataFrame) -> DataFrame:
    """(episode, ord, speaker): the first turn that holds the middle of a segment, else the one of largest overlap, else Unknown.

    The interval join is hashed on episode and time bucket. Segments are
    joined in every bucket they touch; only the middle's bucket counts for the
    first rule.
    """
    by_bucket = turns.select("episode", F.col("ord").alias("turn"), "t_start", "t_end", F.col("speaker").alias("_speaker"), _buckets(F.col("t_start"), F.col("t_end")).alias("_b"))
    middle = (F.col("start") + F.col("end")) / 2
    spread = segments.select("episode", "ord", "start", "end", middle.alias("_mid"), _buckets(F.least("start", "end"), F.greatest("start", "end")).alias("_b"))
    holds = (F.col("t_start") <= F.col("_mid")) & (F.col("_mid") <= F.col("t_end"))
    overlap = F.least("end", "t_end") - F.greatest("start", "t_start")
    hits = spread.join(by_bucket, ["episode", "_b"]).where(holds | (overlap > 0))
    best = hits.groupBy("episode", "ord").agg(
        F.min_by("_speaker", F.when(holds, F.col("turn"))).alias("_in"),
        F.max_by("_speaker", F.when(overlap > 0, F.struct(overlap, -F.col("turn")))).alias("_over"),
    )
    return segments.select("episode", "ord").join(best, ["episode", "ord"], "left").select("episode", "ord", F.coalesce("_in", "_over", F.lit("Unknown")).alias("speaker"))


def host_speakers(segments: DataFrame, opening: float = OPENING) -> DataFrame:
    """(episode, host, seconds): who talks most in the opening; of equals, who spoke first."""
    w = Window.partitionBy("episode").orderBy("ord")
    past = F.max((F.col("start") >= opening).cast("int")).over(w)
    talk = F.greatest(F.lit(0.0), F.least("end", F.lit(opening)) - F.col("start"))
    spoken = segments.withColumn("_past", past).where("_past = 0").withColumn("_talk", talk).where("_talk > 0")
    total = spoken.groupBy("episode", "speaker").agg(F.round(F.sum("_talk"), 3).alias("seconds"), F.min("ord").alias("_first"))
    best = F.max_by(F.struct("speaker", "seconds"), F.struct("seconds", -F.col("_first")))
    return total.groupBy("episode").agg(best.alias("b")).select("episode", F.col("b.speaker").alias("host"), F.col("b.seconds").alias("seconds"))


def chapters_to_blocks(chapters: DataFrame, blocks: DataFrame) -> DataFrame:
    """(episode, ts, block_start): the first block that starts at or after each chapter, null behind the last. A forward as-of join."""
    both = chapters.select("episode", "ts", F.lit(0).alias("_kind"), F.lit(None).cast("double").alias("start")).unionByName(
        blocks.select("episode", F.col("start").alias("ts"), F.lit(1).alias("_kind"), "start")
    )
    ahead = Window.partitionBy("episode").orderBy("ts", "_kind").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return both.withColumn("block_start", F.first("start", ignorenulls=True).over(ahead)).where("_kind = 0").select("episode", "ts", "block_start")


def headings_above(cards: DataFrame, headings: DataFrame, group: str, at: str, value: str) -> DataFrame:
    """Cards with the value of the last heading above them. A backward as-of join."""
    both = cards.withColumn("_v", F.lit(None).cast(dict(headings.dtypes)[value])).withColumn("_card", F.lit(True)).unionByName(
        headings.select(group, at, F.col(value).alias("_v")).withColumn("_card", F.lit(False)), allowMissingColumns=True
    )
    above = Window.partitionBy(group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(above)).where("_card").select(*cards.columns, value)


def with_chapters(bodies: DataFrame, chapters: DataFrame) -> DataFrame:
    """(episode, body) of transcripts with chapter headings (episode, ts, title) before the first paragraph that begins at or after each.

    Headings that a body has are taken out first, so doing it again changes
    nothing; those behind the last paragraph's start stand at the end.
    Paragraphs are told by the time in brackets that follows the speaker.
    """
    parts = bodies.select("episode", F.posexplode(F.split("body", "\n\n")).alias("pos", "part")).where("part not like '## %'")
    stamp = F.regexp_extract("part", r"^\*\*[^*]*\*\* \(([0-9:]+)\)", 1)
    parts = parts.withColumn("start", F.when(stamp != "", stamp_seconds(stamp)))
    heads = chapters.select("episode", "ts", F.concat(F.lit("## "), "title").alias("head"))
    starts = parts.where("start is not null").groupBy("episode", "start").agg(F.min("pos").alias("pos"))
    timed = heads.select("episode", "ts", "head", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("at")).unionByName(
        starts.select("episode", F.col("start").alias("ts"), F.lit(None).cast("string").alias("head"), F.lit(1).alias("kind"), F.col("pos").alias("at"))
    )
    ahead = Window.partitionBy("episode").orderBy("ts", "kind").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = timed.withColumn("pos", F.first("at", ignorenulls=True).over(ahead)).where("kind = 0")
    lines = placed.select("episode", F.coalesce("pos", F.lit((1 << 31) - 1)).alias("pos"), F.lit(0).alias("kind"), "ts", F.col("head").alias("part")).unionByName(
        parts.select("episode", "pos", F.lit(1).alias("kind"), F.lit(0.0).alias("ts"), "part")
    )
    whole = lines.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "ts", "part"))).alias("lines"))
    return whole.select("episode", F.array_join(F.transform("lines", lambda x: x["part"]), "\n\n").alias("body"))
