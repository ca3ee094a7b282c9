"""Discovery sources: sitemaps, HTML listings, feeds and JSON papers, each given as a table of fetched bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions import dates, urls
from textweir.operators.ledger import first_seen
from textweir.sources import providers

#: A pattern with a group that matches nothing.
NO_HEADING = "()(?!)"


def dated_items(pages: DataFrame, patterns: tuple[str, ...], heading: str = NO_HEADING, own_date: bool = False, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(listing, link, title, date) of listing pages: as `listing_items`, dated by group 3 of the patterns or by the last heading above.

    A page is split at its headings, so an item's heading is that of its part, or the last
    one before it that tells a day, or a month as `YYYY-MM`; items above the first such have no date of their own.
    """
    pages = _dealt(pages)
    parts = F.split("html", f"(?s){heading}", -1)
    heads = F.concat(F.array(F.lit("")), F.regexp_extract_all("html", F.lit(f"(?s){heading}"), F.lit(1)))
    told = F.transform(heads, lambda h: F.coalesce(F.nullif(dates.loose_date(h), F.lit("")), dates.loose_month(h)))
    rows = pages.select("listing", "url", parts.alias("part"), told.alias("told"))
    above = F.transform("told", lambda _, i: F.coalesce(F.try_element_at(F.filter(F.slice("told", F.lit(1), i + 1), lambda d: d != ""), F.lit(-1)), F.lit("")))
    rows = rows.select("listing", "url", F.posexplode(F.arrays_zip("part", above.alias("head"))).alias("_part", "_p"))
    found = None
    for k, pattern in enumerate(patterns):
        groups = [F.regexp_extract_all("_p.part", F.lit(f"(?s){pattern}"), F.lit(g)).alias(n) for g, n in ((1, "a"), (2, "b"), *(((3, "c"),) if own_date else ()))]
        one = rows.select("listing", "url", "_part", "_p", F.posexplode(F.arrays_zip(*groups)).alias("_at", "_i"))
        day = dates.loose_date(F.col("_i.c")) if own_date else F.lit("")
        date = F.when(day != "", day).otherwise(F.col("_p.head"))
        one = one.select("listing", urls.absolute(F.col("url"), F.col("_i.a")).alias("link"), F.trim(F.regexp_replace("_i.b", "<[^>]+>", "")).alias("title"), date.alias("date"), F.lit(k).alias("_pattern"), "_part", "_at")
        found = one if found is None else found.unionByName(one)
    for part in exclude:
        found = found.where(~F.contains("link", F.lit(part)))
    return first_seen(found, ("listing", "link"), "_pattern", "_part", "_at").select("listing", "link", "title", "date")


def _dealt(pages: DataFrame) -> DataFrame:
    """Pages dealt over all partitions of a shuffle: the rows of a page are many times its size, and a scan of a small file is one task that would sort them all."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "listing", "url")


URLSET = "url array<struct<loc:string,lastmod:string>>"
SITEMAPS = "sitemap array<struct<loc:string>>"


def absolute_location(site: Column, loc: Column) -> Column:
    """A location with scheme and host: one that begins with the host lacks the scheme, any other is a path of the site."""
    host, root = F.parse_url(site, F.lit("HOST")), F.rtrim(site, F.lit("/"))
    named = (loc == host) | F.startswith(loc, F.concat(host, F.lit("/")))
    return F.when(loc.rlike("^https?://"), loc).when(named, F.concat(F.lit("https://"), loc)).otherwise(F.concat_ws("/", root, F.ltrim(loc, F.lit("/"))))


def urlset_rows(sitemaps: DataFrame, include: str = "", exclude: tuple[str, ...] = (), pattern: str = "", since: str = "") -> DataFrame:
    """(site, url, lastmod) of urlsets (site, xml); bodies that are none give nothing.

    Locations without a scheme or host are repaired from the site. The index
    page itself goes; entries without a date stay whatever `since` says.
    """
    rows = sitemaps.select("site", F.explode(F.from_xml("xml", URLSET)["url"]).alias("entry"))
    loc = F.trim(F.coalesce(F.col("entry.loc"), F.lit("")))
    rows = rows.where(loc != "").select("site", absolute_location(F.col("site"), loc).alias("url"), F.trim(F.coalesce(F.col("entry.lastmod"), F.lit(""))).alias("lastmod"))
    if include:
        rows = rows.where(F.contains("url", F.lit(include)) & ~F.endswith(F.rtrim("url", F.lit("/")), F.lit(include.rstrip("/"))))
    if pattern:
        rows = rows.where(F.col("url").rlike(pattern))
    for part in exclude:
        rows = rows.where(~F.contains("url", F.lit(part)))
    if since:
        rows = rows.where((F.col("lastmod") == "") | (F.col("lastmod") >= since))
    return rows


def sitemap_index(indexes: DataFrame, include: str = "") -> DataFrame:
    """(site, sitemap) of the sub-sitemaps of index bodies; urlsets among the bodies give none."""
    only = indexes.where(F.contains(F.lower(F.left("xml", F.lit(500))), F.lit("<sitemapindex")))
    subs = only.select("site", F.explode(F.from_xml("xml", SITEMAPS)["sitemap"]).alias("entry")).select("site", F.trim("entry.loc").alias("sitemap"))
    return subs.where(F.contains("sitemap", F.lit(include))) if include else subs


def sitemap_tree(roots: DataFrame, fetched: DataFrame, include: str = "", **filters) -> DataFrame:
    """(site, url, lastmod) of sitemaps (site, xml), through indexes to the bodies (sitemap, xml) fetched for them.

    A sub-sitemap that could not be fetched, or is malformed, is left out; the others count.
    """
    below = sitemap_index(roots, include).join(fetched.where("xml is not null"), "sitemap").select("site", "xml")
    direct = roots.where(~F.contains(F.lower(F.left("xml", F.lit(500))), F.lit("<sitemapindex"))).select("site", "xml")
    return urlset_rows(direct.unionByName(below), **filters)


def sitemap_pages(bodies: DataFrame, fetch: Callable[[str], str | None] | None = None, parts: str = "", **filters) -> DataFrame:
    """(site, url, lastmod) of bodies (site, xml) of either kind; the sitemaps that an index names are fetched in the tasks.

    `parts` chooses among an index's sitemaps. An index without `fetch` is an error, as its pages would be missed.
    """
    if fetch is None:
        index = F.contains(F.lower(F.left("xml", F.lit(500))), F.lit("<sitemapindex"))
        return urlset_rows(bodies.withColumn("xml", F.when(index, F.raise_error("a sitemap index needs a way to fetch its sitemaps")).otherwise(F.col("xml"))), **filters)
    named = sitemap_index(bodies, parts).select("sitemap").distinct()
    return sitemap_tree(bodies, providers.fetched(named, fetch, "sitemap", "xml"), parts, **filters)


def listing_items(pages: DataFrame, patterns: tuple[str, ...], exclude: tuple[str, ...] = ()) -> DataFrame:
    """(listing, link, title) of listing pages (listing, url, html): groups 1 and 2 of the patterns, in their order.

    The first occurrence of an absolute link in a listing wins.
    """
    pages, found = _dealt(pages), None
    for k, pattern in enumerate(patterns):
        links, titles = (F.regexp_extract_all("html", F.lit(f"(?s){pattern}"), F.lit(g)) for g in (1, 2))
        part = pages.select("listing", "url", F.posexplode(F.arrays_zip(links.alias("a"), titles.alias("b"))).alias("_at", "_i"))
        part = part.select("listing", urls.absolute(F.col("url"), F.col("_i.a")).alias("link"), F.trim(F.regexp_replace("_i.b", "<[^>]+>", "")).alias("title"), F.lit(k).alias("_pattern"), "_at")
        found = part if found is None else found.unionByName(part)
    for part in exclude:
        found = found.where(~F.contains("link", F.lit(part)))
    return first_seen(found, ("listing", "link"), "_pattern", "_at").select("listing", "link", "title")


ITEM = "struct<title:string,link:string,guid:string,pubDate:string,description:string,`content:encoded`:string,author:string,`dc:creator`:string>"
ENTRY = "struct<title:string,link:array<struct<_href:string,_rel:string>>,published:string,updated:string,content:string,summary:string,id:string,author:array<struct<name:string>>>"
FEED = f"channel struct<item:array<{ITEM}>>, item array<{ITEM}>, entry array<{ENTRY}>"


def _items(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RSS items and Atom entries of feed bodies."""
    read = feeds.select("feed", F.from_xml("xml", FEED).alias("x"))
    return read.select("feed", F.explode(F.coalesce("x.channel.item", "x.item")).alias("i")), read.select("feed", F.explode("x.entry").alias("e"))


def _alternate(links: Column) -> Column:
    """An Atom entry's link: the alternate one, or the first."""
    return F.coalesce(F.get(F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), 0), F.get(links, 0))["_href"]


def _updated() -> Column:
    return F.coalesce(dates.instant(F.col("e.published")), dates.instant(F.col("e.updated")))


def _since(rows: DataFrame, since: str) -> DataFrame:
    """Rows with `at` as the date `published`; undated ones stay whatever `since` says."""
    rows = rows.withColumn("published", F.coalesce(F.date_format("at", "yyyy-MM-dd"), F.lit(""))).drop("at")
    return rows.where((F.col("published") == "") | (F.col("published") >= since)) if since else rows


def feed_entries(feeds: DataFrame, since: str = "") -> DataFrame:
    """(feed, url, title, published) of RSS and Atom bodies (feed, xml): entries without a link go, and fragments are cut.

    An entry is as old as its publication, or else its update; undated ones
    stay whatever `since` says. An Atom entry's link is the alternate one, or
    the first. A malformed body gives no rows.
    """
    items, entries = _items(feeds)
    rows = items.select("feed", F.trim("i.link").alias("url"), F.trim(F.coalesce("i.title", F.lit(""))).alias("title"), dates.instant(F.col("i.pubDate")).alias("at")).unionByName(
        entries.select("feed", _alternate(F.col("e.link")).alias("url"), F.trim(F.coalesce("e.title", F.lit(""))).alias("title"), _updated().alias("at"))
    )
    return _since(rows.withColumn("url", F.regexp_replace("url", "#.*$", "")).where("url <> ''"), since)


def inline_entries(feeds: DataFrame, since: str = "") -> DataFrame:
    """(feed, url, title, html, secret, author, published) of RSS and Atom bodies whose entries carry their text.

    The text is an item's encoded content or else its description, an entry's
    content or else its summary. The URL is the guid or id if that is one, else
    the link, without its fragment; entries without text or URL go; `secret` is
    the last part of the feed's own URL.
    """
    items, entries = _items(feeds)
    shown = lambda *cs: F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in cs))
    web = lambda c: F.when(F.trim(c).rlike("^https?://"), F.trim(c))
    rows = items.select(
        "feed", F.coalesce(web("i.guid"), F.trim("i.link")).alias("url"), shown("i.title").alias("title"), shown("i.content:encoded", "i.description").alias("html"),
        shown("i.author", "i.dc:creator").alias("author"), dates.instant(F.col("i.pubDate")).alias("at"),
    ).unionByName(
        entries.select(
            "feed", F.coalesce(web("e.id"), F.trim(_alternate(F.col("e.link")))).alias("url"), shown("e.title").alias("title"), shown("e.content", "e.summary").alias("html"),
            shown(F.get("e.author", 0)["name"]).alias("author"), _updated().alias("at"),
        )
    )
    secret = F.element_at(F.split(F.rtrim("feed", F.lit("/")), "/"), -1)
    rows = rows.withColumn("url", F.regexp_replace("url", "#.*$", "")).where("url <> '' and html is not null")
    return _since(rows.select("feed", "url", F.coalesce("title", F.lit("")).alias("title"), "html", secret.alias("secret"), F.coalesce("author", F.lit("")).alias("author"), "at"), since)


def until_cutoff(posts: DataFrame, feed: str, at: str, date: str, cutoff: str) -> DataFrame:
    """Posts of an archive, newest first by `at`, up to the first that is older than the cutoff: what paging that stops there reads."""
    older = F.max((F.col(date) < cutoff).cast("int")).over(Window.partitionBy(feed).orderBy(at))
    return posts.withColumn("_older", older).where("_older = 0").drop("_older")


def bundle_slugs(bundles: DataFrame, pattern: str, template: str) -> DataFrame:
    """(site, slug, url) of the distinct slugs in script bundles (site, script), in order of the slug."""
    found = bundles.select("site", F.explode(F.array_sort(F.array_distinct(F.regexp_extract_all("script", F.lit(pattern), F.lit(1))))).alias("slug"))
    return found.distinct().withColumn("url", F.format_string(template, "slug"))


def iso_week(day: Column) -> Column:
    """The ISO week of a date, as 2024-W05."""
    return F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day))


def discover_papers(rows: DataFrame, min_upvotes: int | None = None, since: str = "", top: int | None = None) -> DataFrame:
    """Papers (id, title, upvotes, submitted, published) in order of votes and time; rows without an id go after the cut."""
    at = F.coalesce(F.nullif("submitted", F.lit("")), F.col("published"))
    kept = rows.where(F.coalesce("upvotes", F.lit(0)) >= min_upvotes) if min_upvotes else rows
    if since:
        kept = kept.where(at >= since)
    kept = kept.orderBy(F.desc("upvotes"), F.desc(at), "id")
    return (kept.limit(top) if top else kept).where("coalesce(id, '') <> ''")


def discover(kind: str, bodies: DataFrame, **settings) -> DataFrame:
    """(source, url, published, title) of a source of one of the known kinds; another raises ValueError.

    `settings` are the parameters of the kind's function. Papers are JSON bodies, or rows that are flat already.
    """
    none = F.lit("")
    if kind == "rss":
        return feed_entries(bodies, **settings).select(F.col("feed").alias("source"), "url", "published", "title")
    if kind == "rss_inline":
        return inline_entries(bodies, **settings).select(F.col("feed").alias("source"), "url", "published", "title")
    if kind == "sitemap":
        return sitemap_pages(bodies, **settings).select(F.col("site").alias("source"), "url", F.col("lastmod").alias("published"), none.alias("title"))
    if kind == "html":
        return dated_items(bodies, **settings).select(F.col("listing").alias("source"), F.col("link").alias("url"), F.col("date").alias("published"), "title")
    if kind == "archive":
        return until_cutoff(bodies, "source", "at", "published", **settings).select("source", "url", "published", "title")
    if kind == "spa":
        return bundle_slugs(bodies, **settings).select(F.col("site").alias("source"), "url", none.alias("published"), F.col("slug").alias("title"))
    if kind == "papers":
        found = discover_papers(papers(bodies) if "json" in bodies.columns else bodies, **settings)
        return found.select(F.lit("papers").alias("source"), F.concat(F.lit("papers/"), "id").alias("url"), F.coalesce(F.nullif("published", F.lit("")), "submitted").alias("published"), "title")
    raise ValueError(f"unknown kind of source: {kind}")


# The fields of a paper's JSON.
PAPER = (
    "id:string,title:string,authors:array<struct<name:string>>,upvotes:int,summary:string,ai_summary:string,ai_keywords:array<string>,publishedAt:string,submittedOnDailyAt:string,"
    "submittedOnDailyBy:struct<name:string,fullname:string>,projectPage:string,organization:struct<name:string,fullname:string>,discussionId:string"
)


def papers(bodies: DataFrame) -> DataFrame:
    """Flat rows of JSON papers, with or without their wrapper; missing values are empty.

    Columns: id, title, authors, upvotes, summary, ai_summary, keywords, published, submitted, submitted_by,
    project_page, organization, discussion_id. Empty names go from lists; `submitted_by` is a name before
    a full name, `organization` a full name before a name.
    """
    read = F.from_json("json", f"struct<paper:struct<{PAPER}>,{PAPER}>")
    field = lambda name: F.when(F.col("j.paper").isNotNull(), F.col(f"j.paper.{name}")).otherwise(F.col(f"j.{name}"))
    text = lambda *names: F.coalesce(*(F.nullif(F.trim(field(n)), F.lit("")) for n in names), F.lit(""))
    listed = lambda values: F.coalesce(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != ""), F.array().cast("array<string>"))
    return bodies.select(read.alias("j")).select(
        text("id").alias("id"), text("title").alias("title"), listed(field("authors.name")).alias("authors"), F.coalesce(field("upvotes"), F.lit(0)).alias("upvotes"),
        text("summary").alias("summary"), text("ai_summary").alias("ai_summary"), listed(field("ai_keywords")).alias("keywords"), text("publishedAt").alias("published"), text("submittedOnDailyAt").alias("submitted"),
        text("submittedOnDailyBy.name", "submittedOnDailyBy.fullname").alias("submitted_by"), text("projectPage").alias("project_page"), text("organization.fullname", "organization.name").alias("organization"), text("discussionId").alias("discussion_id"),
    )
