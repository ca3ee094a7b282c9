"""Discovery against append-only ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions import urls

#: Failures in a row after which an item is given up.
MAX_FAILURES = 3


def pending(found: DataFrame, processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Found items whose URL is neither processed, by full or slug key, nor failed, by exact URL.

    Two hashable anti-joins stand for the OR of the keys, which alone would be
    a nested loop. Nothing is removed within the batch itself.
    """
    done = processed.select(urls.full_key(F.col("url")).alias("_full"), urls.slug_key(F.col("url")).alias("_slug"))
    keyed = found.withColumns({"_full": urls.full_key(F.col("url")), "_slug": urls.slug_key(F.col("url"))})
    left = keyed.join(done.select("_full").distinct(), "_full", "left_anti").join(done.select("_slug").distinct(), "_slug", "left_anti")
    return left.join(failed.select("url").distinct(), "url", "left_anti").select(found.columns)


def first_seen(items: DataFrame, key: str | tuple[str, ...], *order: str) -> DataFrame:
    """The first item of each key, one column or several, in the given order."""
    return items.withColumn("_n", F.row_number().over(Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order))).where("_n = 1").drop("_n")


def failure_runs(outcomes: DataFrame, key: str, ok: Column, *order: str) -> DataFrame:
    """Failures since the last success of each key, and whether they are enough to give it up."""
    w = Window.partitionBy(key).orderBy(*order)
    runs = outcomes.withColumn("_ok", ok).withColumn("_run", F.sum(F.col("_ok").cast("int")).over(w))
    at_end = F.max("_run").over(Window.partitionBy(key))
    # An item is given up as soon as a run is long enough.
    worst = runs.where(~F.col("_ok")).groupBy(key, "_run").agg(F.count(F.lit(1)).alias("n"))
    worst = worst.groupBy(key).agg(F.max("n").alias("longest"), F.max_by("n", "_run").alias("_last_n"), F.max("_run").alias("_last_run"))
    ends = runs.select(key, at_end.alias("_end")).distinct()
    joined = ends.join(worst, key, "left")
    trailing = F.when(F.col("_last_run") == F.col("_end"), F.col("_last_n")).otherwise(0)
    return joined.select(key, F.coalesce(trailing, F.lit(0)).cast("bigint").alias("attempts"), (F.coalesce("longest", F.lit(0)) >= MAX_FAILURES).alias("failed"))


def success_capped(items: DataFrame, feed: str, ok: Column, cap: int, *order: str) -> DataFrame:
    """Items tried until `cap` of a feed succeed; failures don't count."""
    before = F.sum(ok.cast("int")).over(Window.partitionBy(feed).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return items.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < cap).drop("_before")


def newest(items: DataFrame, feed: str, keep: int, *order: Column) -> DataFrame:
    """Items with `rank`, 1 for a feed's newest, and `over` beyond the newest `keep`."""
    rank = F.row_number().over(Window.partitionBy(feed).orderBy(*order))
    return items.withColumn("rank", rank).withColumn("over", F.col("rank") > keep)


def snapshot_diff(known: DataFrame, current: DataFrame, key: str, *compared: str) -> DataFrame:
    """(key, change): add, change, delete or keep, by the compared attributes; doubles within 1e-6 are equal."""
    old = known.select(F.col(key), *(F.col(c).alias(f"_old_{c}") for c in compared), F.lit(True).alias("_old"))
    new = current.select(F.col(key), *compared, F.lit(True).alias("_new"))
    kinds = dict(current.dtypes)
    same = F.lit(True)
    for c in compared:
        same &= (F.abs(F.col(c) - F.col(f"_old_{c}")) <= 1e-6) if kinds[c] == "double" else F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    change = F.when(F.col("_old").isNull(), "add").when(F.col("_new").isNull(), "delete").when(same, "keep").otherwise("change")
    return old.join(new, key, "full_outer").select(key, change.alias("change"))


def needs_sync(source: DataFrame, dest: DataFrame, key: str) -> DataFrame:
    """Files (key, size, mtime, digest) to copy: absent, of another size, or older by two seconds with other content."""
    there = dest.select(F.col(key), F.col("size").alias("_size"), F.col("mtime").alias("_mtime"), F.col("digest").alias("_digest"))
    stale = (F.col("_mtime") + 2 < F.col("mtime")) & (F.col("_digest") != F.col("digest"))
    return source.join(there, key, "left").where(F.col("_size").isNull() | (F.col("_size") != F.col("size")) | stale).select(source.columns)
