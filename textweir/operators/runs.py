"""Runs over ledgers and listings: what is due, in which order, how far, and what is given up."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: the severities of an audit.
SEVERITIES = ("clean", "mild", "moderate", "severe")


def by_date(entries: DataFrame, at: Column, newest: bool = True, *ties: str) -> DataFrame:
    """Entries by time, those without one last; equal times keep their given order."""
    return entries.orderBy(at.desc_nulls_last() if newest else at.asc_nulls_last(), *ties)


def limited(rows: DataFrame, limit: int | None, zero_is_all: bool = True) -> DataFrame:
    """At most `limit` rows; none is no limit, and 0 is none either where `zero_is_all`."""
    return rows if limit is None or limit == 0 and zero_is_all else rows.limit(limit)


def effective_limit(asked: int | None, feed: int | None, default: int | None) -> int | None:
    """The first of the caller's, the feed's and the default limit that is given."""
    return next((x for x in (asked, feed, default) if x is not None), None)


def queue(pending: DataFrame, kind: str, limit: int | None = None) -> DataFrame:
    """Pending items by their date as text, newest first and undated last; papers keep the order they were found in."""
    order = [F.col("ord")] if kind == "papers" else [F.coalesce("date", F.lit("")).desc(), F.col("ord")]
    return limited(pending.orderBy(*order), limit)


def preview(rows: DataFrame, shown: int, *order: str) -> DataFrame:
    """The first rows in an order, each with how many more there are."""
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    return rows.orderBy(*order).limit(shown).crossJoin(F.broadcast(total)).withColumn("more", F.greatest(F.col("_total") - shown, F.lit(0))).drop("_total")


def without_dates(rows: DataFrame, date: str, ignored: tuple[str, ...]) -> DataFrame:
    """Rows whose date begins with none of the ignored prefixes."""
    for prefix in ignored:
        rows = rows.where(~F.startswith(F.coalesce(date, F.lit("")), F.lit(prefix)))
    return rows


def page_or_listing_date(page: Column, listing: Column) -> Column:
    """A page's own date, unless the listing names a month that it isn't in, or the page has none."""
    month_only = listing.rlike(r"^\d{4}-\d{2}$")
    outside = month_only & (F.left(page, F.lit(7)) != listing)
    first = F.concat(listing, F.lit("-01"))
    return F.when(F.coalesce(page, F.lit("")) == "", F.when(month_only, first).otherwise(listing)).when(outside, first).otherwise(page)


def narrowed(rows: DataFrame, stem: str, only: tuple[str, ...] = (), again: tuple[str, ...] = (), done: DataFrame | None = None) -> DataFrame:
    """Rows of the wanted stems; those done already only where they are to be done again."""
    if only:
        rows = rows.where(F.col(stem).isin(*only))
    if done is None:
        return rows
    redo = F.col(stem).isin(*again) if again else F.lit(False)
    return rows.join(done.select(F.col(stem), F.lit(True).alias("_done")).distinct(), stem, "left").where(F.col("_done").isNull() | redo).drop("_done")


def headerless(text: Column) -> Column:
    """Whether a document's first line opens no front matter."""
    return ~F.startswith(F.coalesce(text, F.lit("")), F.lit("---"))


def stale(source: DataFrame, dest: DataFrame, key: str) -> DataFrame:
    """Files (key, mtime) that a mirror lacks, or has an older copy of: time alone counts."""
    there = dest.select(F.col(key), F.col("mtime").alias("_mtime"))
    return source.join(there, key, "left").where(F.col("_mtime").isNull() | (F.col("_mtime") < F.col("mtime"))).drop("_mtime")


def latest_metadata(rows: DataFrame, metadata: DataFrame, stem: str, order: str) -> DataFrame:
    """Rows with the metadata of their stem, null without any; of several the last in order counts."""
    others = [c for c in metadata.columns if c not in (stem, order)]
    last = metadata.groupBy(stem).agg(F.max_by(F.struct(*others), order).alias("_m"))
    return rows.join(last, stem, "left").select(*rows.columns, *(F.col(f"_m.{c}").alias(c) for c in others))


def still_due(items: DataFrame, ledger: DataFrame, cache: DataFrame, key: str, mode: str) -> DataFrame:
    """Items that lack what a mode leaves behind: a ledger entry, or for diarization a cache file."""
    done = cache if mode == "diarize" else ledger
    return items.join(done.select(key).distinct(), key, "left_anti")


def chunk_plan(recordings: DataFrame, checkpoints: DataFrame, seconds: int = 1800) -> DataFrame:
    """(episode, chunk, start, done) of recordings (episode, seconds) cut in chunks; done ones have a checkpoint to go on from."""
    last = F.greatest(F.ceil(F.col("seconds") / seconds) - 1, F.lit(0)).cast("int")
    every = recordings.select("episode", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    there = checkpoints.select("episode", "chunk", F.lit(True).alias("_there")).distinct()
    return every.join(there, ["episode", "chunk"], "left").select("episode", "chunk", (F.col("chunk") * seconds).alias("start"), F.coalesce("_there", F.lit(False)).alias("done"))


def merged_chunks(segments: DataFrame, seconds: int = 1800) -> DataFrame:
    """Segments of chunks (episode, chunk, ord, start, end, text) as those of the whole recording, numbered through."""
    w = Window.partitionBy("episode").orderBy("chunk", "ord")
    shift = F.col("chunk") * F.lit(float(seconds))
    return segments.select("episode", F.row_number().over(w).alias("ord"), (F.col("start") + shift).alias("start"), (F.col("end") + shift).alias("end"), "text")


def until_done(step: Callable[[], None], pending: Callable[[], int], most: int = 1000) -> int:
    """Repeat a step until nothing is pending; the rounds it took. A round that changes nothing ends it with RuntimeError."""
    left, rounds = pending(), 0
    while left and rounds < most:
        step()
        rounds += 1
        now = pending()
        if now == left:
            raise RuntimeError(f"no progress: {now} still pending")
        left = now
    return rounds


def each_apart(sources: Iterable[str], run: Callable[[str], int], workers: int = 1) -> dict[str, int | str]:
    """What `run` gives for each source, or the error it ended with; one source's failure doesn't stop the others.

    Several workers run that many sources at once; their jobs share the session.
    """

    def told(source: str) -> int | str:
        try:
            return run(source)
        except Exception as error:
            return f"{type(error).__name__}: {error}"

    names = list(sources)
    with ThreadPoolExecutor(max(workers, 1)) as pool:
        return dict(zip(names, pool.map(told, names), strict=True))


def check_severities(wanted: Iterable[str]) -> None:
    if unknown := sorted(set(wanted) - set(SEVERITIES)):
        raise ValueError(f"unknown severities: {', '.join(unknown)}")


def audited(audit: DataFrame, severities: tuple[str, ...] = (), min_pct: float | None = None, feeds: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Audit rows to do again, worst first: of some severities, or by share alone where `min_pct` is given. A limit of 0 is none at all."""
    check_severities(severities)
    rows = audit.where(F.col("loop_pct") >= min_pct) if min_pct is not None else audit.where(F.col("severity").isin(*severities)) if severities else audit
    if feeds:
        rows = rows.where(F.col("feed").isin(*feeds))
    return limited(rows.orderBy(F.desc("loop_pct"), "path_under_transcripts"), limit, zero_is_all=False)


def stem_of(path: Column) -> Column:
    """A path's file name without its extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]+$", "")


def reprocess_plan(rows: DataFrame, audio: DataFrame, backup: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows (stem) with what is there of each (`has_audio`, `in_backup`, `in_ledger`) and the step that follows."""
    for name, there in (("has_audio", audio), ("in_backup", backup), ("in_ledger", ledger)):
        rows = rows.join(there.select("stem", F.lit(True).alias(name)).distinct(), "stem", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    step = F.when(F.col("has_audio"), "redo").when(F.col("in_backup"), "restore").otherwise("missing")
    return rows.withColumn("step", step)


def reprocess_summary(plan: DataFrame) -> DataFrame:
    """Rows of each step, and of those how many leave the ledger."""
    return plan.groupBy("step").agg(F.count(F.lit(1)).alias("rows"), F.count_if("in_ledger").alias("unlisted"))


def ledger_without(ledger: DataFrame, gone: DataFrame) -> DataFrame:
    """A ledger (feed, stem) without the stems that are to be done again: one rewrite for each feed that loses any."""
    touched = gone.select("feed").distinct()
    return ledger.join(touched, "feed", "left_semi").join(gone.select("feed", "stem").distinct(), ["feed", "stem"], "left_anti")


def saved_attempts(attempts: DataFrame) -> DataFrame:
    """The failure counts that are worth keeping."""
    return attempts.where(F.col("attempts") > 0)


def reset_failures(failed: DataFrame, attempts: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Empty failure tables, and how many rows they had."""
    return failed.limit(0), attempts.limit(0), failed.count() + attempts.count()


def cached_turns(recordings: DataFrame, cache: DataFrame) -> DataFrame:
    """Recordings (episode, size, digest, mtime) with the turns cached for them; null where there are none to use.

    An entry counts if size and digest are those of the recording; one of the
    old kind, without a digest, if it is no older than it.
    """
    found = cache.select("episode", F.col("size").alias("_size"), F.col("digest").alias("_digest"), F.col("mtime").alias("_mtime"), "turns")
    same = F.when(F.col("_digest").isNotNull(), (F.col("_size") == F.col("size")) & (F.col("_digest") == F.col("digest"))).otherwise(F.col("_mtime") >= F.col("mtime"))
    return recordings.join(found, "episode", "left").withColumn("turns", F.when(same, F.col("turns"))).drop("_size", "_digest", "_mtime")


def media_folder(explicit: Column, backup: Column, feed: Column, kind: str) -> Column:
    """Where a feed's files go: the folder it names, else one in its backup, else the default one."""
    in_backup = F.when(F.coalesce(backup, F.lit("")) != "", F.concat_ws("/", F.rtrim(backup, F.lit("/")), F.lit(kind), feed))
    return F.coalesce(F.nullif(explicit, F.lit("")), in_backup, F.concat_ws("/", F.lit(kind), feed))
