"""Markdown renderings of papers, transcripts and headers, and the sinks that write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.functions.media import speaker_label, timestamp, transcript_text
from textweir.functions.text import yaml_escape
from textweir.operators.speech import speaker_blocks


def header(summary: Column | None = None, **fields: Column) -> Column:
    """Front matter with the fields that have a value, and the summary as a quotation below it."""
    quoted = [] if summary is None else [F.when(F.coalesce(summary, F.lit("")) != "", F.concat(F.lit("> "), F.regexp_replace(F.trim(summary), r"\n", "\n> "), F.lit("\n")))]
    lines = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f'{k}: "'), yaml_escape(v), F.lit('"'))) for k, v in fields.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""), *quoted)


def simple_transcript(title: Column, published: Column, text: Column) -> Column:
    """A transcript without speakers: heading, date, text."""
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.concat(F.lit("Published: "), published), text)


def flat_transcript(segments: DataFrame) -> DataFrame:
    """(episode, content): the texts of segments that have any, a line each, in order."""
    whole = segments.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("s"))
    return whole.select("episode", transcript_text(F.transform("s", lambda x: x["text"])).alias("content"))


def paper(title: Column, authors: Column, summary: Column, upvotes: Column, url: Column, tags: Column, body: Column) -> Column:
    """A paper with its header; without a body the summary stands alone."""
    slugs = F.transform(tags, lambda t: F.regexp_replace(F.lower(t), "[^a-z0-9]+", "-"))
    head = [
        F.lit("---"), F.concat(F.lit('title: "'), yaml_escape(title), F.lit('"')), F.lit("type: paper"), F.concat(F.lit("authors: ["), F.array_join(authors, ", "), F.lit("]")),
        F.concat(F.lit("url: "), url), F.concat(F.lit("upvotes: "), upvotes.cast("string")), F.concat(F.lit("tags: ["), F.array_join(slugs, ", "), F.lit("]")),
        F.concat(F.lit("full_text: "), (F.coalesce(body, F.lit("")) != "").cast("string")), F.lit("---"), F.lit(""), F.concat(F.lit("# "), title), F.lit(""), F.lit("## Abstract"), F.lit(""), summary,
    ]
    full = F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit("\n## Full text\n\n"), body))
    return F.concat_ws("\n", *head, full)


def transcript(segments: DataFrame, host: DataFrame | None = None) -> DataFrame:
    """(episode, content): blocks of one speaker with their time, in order; the host goes by name.

    An episode's blocks are gathered in one row, as its document is one text.
    """
    blocks = speaker_blocks(segments)
    label = F.concat(F.lit("Speaker "), speaker_label(F.col("speaker")))
    if host is not None:
        blocks = blocks.join(host.select("episode", F.col("host").alias("_host"), F.col("name").alias("_name")), "episode", "left")
        label = F.when(F.col("speaker") == F.col("_host"), F.split_part(F.trim("_name"), F.lit(" "), F.lit(1))).otherwise(label)
    line = F.concat(F.lit("**"), label, F.lit("** ("), timestamp(F.col("start")), F.lit("): "), F.col("text"))
    parts = blocks.groupBy("episode").agg(F.sort_array(F.collect_list(F.struct("block", line.alias("line")))).alias("lines"))
    return parts.select("episode", F.array_join(F.transform("lines", lambda b: b["line"]), "\n\n").alias("content"))


def append_new(rows: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """The rows that a ledger lacks, each key once: what an idempotent append writes."""
    return rows.dropDuplicates([key]).join(ledger.select(key).distinct(), key, "left_anti")


def changed_only(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of `after` whose text differs from before, or is new."""
    old = before.select(key, F.col(column).alias("_old"))
    return after.join(old, key, "left").where(~F.col(column).eqNullSafe(F.col("_old"))).drop("_old")
