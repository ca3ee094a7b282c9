"""A poll of a source from discovery to its ledgers, and one that runs over all sources.

The ledgers of a source are `processed` (url), `failed` (url) and `attempts`
(url, attempts).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions import dates, text, urls
from textweir.operators import ledger, mirror, runs
from textweir.sources import listings, providers
from textweir.storage import Busy, Lease, create_once, listed, read_text

LEDGERS = {"processed": "url string", "failed": "url string", "attempts": "url string, attempts int"}


@dataclass(frozen=True)
class Source:
    """A source's settings; `kind` and `settings` are those of `listings.discover`."""

    name: str
    kind: str = "rss"
    settings: dict = field(default_factory=dict)
    limit: int | None = None
    max_failures: int = ledger.MAX_FAILURES
    ignore_dates: tuple[str, ...] = ()
    strip_after: str = ""
    slug_date: tuple | None = None
    tags: tuple[str, ...] = ()


def due(source: Source, found: DataFrame, ledgers: dict[str, DataFrame]) -> DataFrame:
    """Found items (url, published, title) that a poll would fetch, newest first."""
    items = found.withColumnsRenamed({"published": "date"}).withColumn("ord", F.monotonically_increasing_id())
    left = ledger.pending(items, ledgers["processed"], ledgers["failed"])
    return runs.queue(left, source.kind, source.limit)


def article_date(source: Source, page: Column, listed: Column, url: Column, today: Column) -> Column:
    """An article's date: that coded in its slug, else the page's own; an ignored one gives way to the listing's, or today's.

    A listing page's own date comes before the article's, unless it names a month only.
    """
    own = F.coalesce(page, F.lit(""))
    if source.slug_date is not None:
        own = F.coalesce(F.nullif(dates.slug_date(urls.slug(url), *source.slug_date), F.lit("")), own)
    for prefix in source.ignore_dates:
        own = F.when(F.startswith(own, F.lit(prefix)), F.coalesce(F.nullif(listed, F.lit("")), today)).otherwise(own)
    if source.kind == "html":
        month = listed.rlike(r"^\d{4}-\d{2}$")
        own = F.when(month, runs.page_or_listing_date(own, listed)).otherwise(F.coalesce(F.nullif(listed, F.lit("")), own))
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(listed, F.lit("")))


def articles(source: Source, fetched: DataFrame, root: str, today: Column) -> DataFrame:
    """(url, path, content, published) of fetched items (url, date, title, body, page_date) that have a body."""
    body = text.strip_after(F.col("body"), source.strip_after) if source.strip_after else F.col("body")
    told = fetched.withColumn("body", body).where("coalesce(body, '') <> ''")
    told = told.withColumn("published", F.coalesce(article_date(source, F.col("page_date"), F.col("date"), F.col("url"), today), F.lit("")))
    slug = urls.slug(F.col("url"), F.col("title"))
    path = text.article_path(root, F.lit(source.name), F.coalesce(F.nullif("published", F.lit("")), F.lit("0000-00-00")), slug)
    # Articles of one date and slug get numbers, in order of their URLs.
    told = told.withColumn("path", path)
    nth = F.row_number().over(Window.partitionBy("path").orderBy("url"))
    path = F.when(nth > 1, F.concat(F.regexp_replace("path", r"\.md$", ""), F.lit("-"), nth.cast("string"), F.lit(".md"))).otherwise(F.col("path"))
    tags = F.array(*map(F.lit, source.tags)).cast("array<string>")
    title = F.coalesce(F.nullif("title", F.lit("")), slug)
    return told.select("url", path.alias("path"), text.markdown_article(title, F.col("url"), F.lit(source.name), F.col("published"), tags, F.col("body")).alias("content"), "published")


def after(outcomes: DataFrame, ledgers: dict[str, DataFrame], most: int = ledger.MAX_FAILURES) -> dict[str, DataFrame]:
    """The ledgers after a poll with outcomes (url, ok).

    A success ends a run of failures; the `most`-th failure moves an item to
    the failed ones; items that were not tried keep their count.
    """
    tried = outcomes.groupBy("url").agg(F.max("ok").alias("ok"), F.count_if(~F.col("ok")).alias("_n"))
    counts = ledgers["attempts"].join(tried, "url", "full_outer").select(
        "url", F.when(F.col("ok"), 0).otherwise(F.coalesce("attempts", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int").alias("attempts")
    )
    return {
        "processed": ledgers["processed"].select("url").unionByName(tried.where("ok").select("url")).distinct(),
        "failed": ledgers["failed"].select("url").unionByName(counts.where(F.col("attempts") >= most).select("url")).distinct(),
        "attempts": runs.saved_attempts(counts).where(F.col("attempts") < most),
    }


def read_ledgers(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The newest ledgers of a source; empty ones before its first poll."""
    last = max(listed(spark, f"{folder}/published"), default=None)
    if last is None:
        return {name: spark.createDataFrame([], schema) for name, schema in LEDGERS.items()}
    at = f"{folder}/{read_text(spark, f'{folder}/published/{last}')}"
    return {name: spark.read.schema(schema).parquet(f"{at}/{name}") for name, schema in LEDGERS.items()}


def save_ledgers(spark: SparkSession, folder: str, ledgers: dict[str, DataFrame], lease: Lease) -> None:
    """Write a source's ledgers and publish them, which only the holder of its lease can."""
    name = f"ledgers-{uuid.uuid4().hex[:12]}"
    for table, rows in ledgers.items():
        rows.write.parquet(f"{folder}/{name}/{table}")
    lease.check()
    if not create_once(spark, f"{folder}/published/{lease.number:012d}", name):
        raise Busy(f"{folder} was polled meanwhile")


def poll(spark: SparkSession, source: Source, bodies: DataFrame, fetch: Callable[[str], str | None], read: Callable[[DataFrame], DataFrame], root: str, ledgers: str, today: str, retry_failed: bool = False) -> dict[str, int]:
    """Poll a source: discover, fetch what is due, write its articles below `root`, and publish its ledgers.

    `bodies` are what discovery reads, `fetch` gives a page's HTML, and `read`
    adds `body` and `page_date` to rows (url, date, title, html). Pages are
    fetched once: they are written below the ledgers before anything reads them.
    An article that can't be written counts as a failure of its item. A source
    is polled by one at a time; a second poll fails as long as the first lasts.
    """
    folder = f"{ledgers.rstrip('/')}/{source.name}"
    with Lease(spark, f"{folder}/lease") as lease:
        return _poll(spark, source, bodies, fetch, read, root, folder, today, retry_failed, lease)


def _poll(spark: SparkSession, source: Source, bodies: DataFrame, fetch: Callable[[str], str | None], read: Callable[[DataFrame], DataFrame], root: str, folder: str, today: str, retry_failed: bool, lease: Lease) -> dict[str, int]:
    known = read_ledgers(spark, folder)
    if retry_failed:
        known["failed"], known["attempts"], _ = runs.reset_failures(known["failed"], known["attempts"])
    settings = {"fetch": fetch, **source.settings} if source.kind == "sitemap" else source.settings
    todo = due(source, listings.discover(source.kind, bodies, **settings).select("url", "published", "title"), known)
    pages = f"{folder}/pages-{today}"
    providers.fetched(todo.drop("ord"), fetch, body="html").write.mode("overwrite").parquet(pages)
    got = spark.read.parquet(pages)
    made = articles(source, read(got), root, F.lit(today))
    told = f"{folder}/written-{today}"
    mirror.written(made).write.mode("overwrite").parquet(told)
    done = made.select("url", "path").join(spark.read.parquet(told).where("error is null").select("path").distinct(), "path", "left_semi").select("url").distinct()
    outcomes = got.select("url").join(done.withColumn("_ok", F.lit(True)), "url", "left").select("url", F.coalesce("_ok", F.lit(False)).alias("ok"))
    new = after(outcomes, known, source.max_failures)
    save_ledgers(spark, folder, new, lease)
    counted = outcomes.agg(F.count(F.lit(1)).alias("tried"), F.count_if("ok").alias("written")).first()
    return {"tried": counted["tried"], "written": counted["written"]}
