"""Feeds, sitemap trees, archives and fetched bodies made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions import text
from textweir.plans.corpus import table
from textweir.sources import files, listings, providers


def _feed(spark: SparkSession, sf_dir: str, entry, head: str, tail: str) -> DataFrame:
    """A feed for each user, of an entry for each event."""
    made = table(spark, sf_dir, "events").select("user_id", F.struct("event_id", entry.alias("xml")).alias("e"))
    whole = made.groupBy("user_id").agg(F.array_sort(F.collect_list("e")).alias("es"))
    body = F.concat(F.lit(head), F.array_join(F.transform("es", lambda e: e["xml"]), ""), F.lit(tail))
    return whole.select(F.concat(F.lit("https://x/feed/k"), F.col("user_id").cast("string")).alias("feed"), body.alias("xml"))


def _tag(name: str, value) -> F.Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _id():
    return F.col("event_id").cast("string")


def feed_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS items: every fifth has no link, every seventh no date, and links have fragments."""
    link = F.when(F.pmod("event_id", F.lit(5)) != 0, _tag("link", F.concat(F.lit("https://x/a/"), _id(), F.lit("#top")))).otherwise("")
    date = F.when(F.pmod("event_id", F.lit(7)) != 0, _tag("pubDate", F.date_format("ts", "'Mon, 'd MMM yyyy HH:mm:ss '+0000'"))).otherwise("")
    entry = F.concat(F.lit("<item>"), _tag("title", F.concat("event_type", F.lit(" &amp; more"))), link, date, F.lit("</item>"))
    return listings.feed_entries(_feed(spark, sf_dir, entry, '<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>', "</channel></rss>"), "2024-01-10")


def feed_atom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom entries: half are dated by their update, and the link to the entry itself isn't taken."""
    date = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    link = F.concat(F.lit('<link rel="self" href="https://x/self"/><link rel="alternate" href="https://x/b/'), _id(), F.lit('"/>'))
    entry = F.concat(F.lit("<entry>"), _tag("title", F.col("event_type")), link, F.when(F.pmod("event_id", F.lit(2)) == 0, _tag("published", date)).otherwise(_tag("updated", date)), F.lit("</entry>"))
    return listings.discover("rss", _feed(spark, sf_dir, entry, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>"))


def feed_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their text: the guid is the URL where it is one, the description stands in for content, and items without text go."""
    guid = F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit("https://x/g/"), _id())).otherwise(F.concat(F.lit("tag:"), _id()))
    content = F.when(F.pmod("event_id", F.lit(3)) == 0, _tag("content:encoded", F.concat(F.lit("<![CDATA[<p>"), "event_type", F.lit("</p>]]>")))).otherwise("")
    about = F.when(F.pmod("event_id", F.lit(4)) != 0, _tag("description", F.col("event_type"))).otherwise("")
    entry = F.concat(F.lit("<item>"), _tag("title", F.lit("t")), _tag("link", F.concat(F.lit("https://x/l/"), _id())), F.lit('<guid isPermaLink="false">'), guid, F.lit("</guid>"), content, about, F.lit("</item>"))
    head = '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
    return listings.inline_entries(_feed(spark, sf_dir, entry, head, "</channel></rss>")).select("feed", "url", "title", "html", "secret")


def feed_inline_atom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom entries with their text: the id is the URL where it is one, the summary stands in for content, and entries without text or older than a day go."""
    ident = F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit("https://x/g/"), _id(), F.lit("#c"))).otherwise(F.concat(F.lit("urn:"), _id()))
    link = F.concat(F.lit('<link rel="self" href="https://x/self"/><link rel="alternate" href="https://x/l/'), _id(), F.lit('"/>'))
    content = F.when(F.pmod("event_id", F.lit(3)) == 0, F.concat(F.lit('<content type="html">&lt;p&gt;'), "event_type", F.lit("&lt;/p&gt;</content>"))).otherwise("")
    about = F.when(F.pmod("event_id", F.lit(4)) != 0, _tag("summary", F.col("event_type"))).otherwise("")
    date = F.when(F.pmod("event_id", F.lit(7)) != 0, _tag("published", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))).otherwise("")
    author = _tag("author", _tag("name", F.concat(F.lit("u"), F.col("user_id").cast("string"))))
    entry = F.concat(F.lit("<entry>"), _tag("title", F.lit("t")), _tag("id", ident), link, content, about, date, author, F.lit("</entry>"))
    return listings.inline_entries(_feed(spark, sf_dir, entry, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>"), "2024-01-10")


def sitemap_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' sites through the dispatcher: those with even keys have an index, whose sitemaps are fetched (every fifth can't be), the others a urlset."""

    def fetch(url: str) -> str:
        site, _, part = url.removesuffix(".xml").rpartition("/s")
        if (int(site.rpartition("/s")[2].partition(".")[0]) + int(part)) % 5 == 0:
            raise OSError("gone")
        return f"<urlset><url><loc>{site}/p/{part}</loc><lastmod>2024-01-0{part}</lastmod></url><url><loc>/q/{part}</loc></url></urlset>"

    site = F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".com"))
    index = F.concat(F.lit("<sitemapindex>"), *(F.concat(F.lit("<sitemap><loc>"), F.replace(site, F.lit("https://"), F.lit("https://x/")), F.lit(f"/s{k}.xml</loc></sitemap>")) for k in (1, 2, 3)), F.lit("</sitemapindex>"))
    xml = F.when(F.pmod("s_suppkey", F.lit(2)) == 0, index).otherwise("<urlset><url><loc>/a</loc></url></urlset>")
    return listings.discover("sitemap", table(spark, sf_dir, "supplier").select(site.alias("site"), xml.alias("xml")), fetch=fetch, parts=".com/", since="2024-01-02")


def listing_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' listings through the dispatcher: a card's own day, else the month of the last heading above that tells one."""
    key = F.col("c_custkey").cast("string")
    card = lambda path, day="": F.concat(F.lit(f'<a href="/{path}/'), key, F.lit('">'), "c_name", F.lit(f"</a><i>{day}</i>"))
    html = F.concat(card("top"), F.lit("<h2>June 2025</h2>"), card("a", "Jun 3, 2025"), card("b"), F.lit("<h2>More</h2>"), card("c"), F.lit("<h2>Sept. 2024</h2>"), card("d"), card("skip"))
    pages = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("listing"), F.lit("https://x.com/list").alias("url"), html.alias("html"))
    return listings.discover("html", pages, patterns=('<a href="([^"]+)">(.*?)</a><i>(.*?)</i>',), heading="<h2>(.*?)</h2>", own_date=True, exclude=("/skip/",))


def paper_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of papers in JSON; those of the wrapper don't count where there is one."""
    day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    named = lambda name, full: F.struct(F.lit(name).alias("name"), full.alias("fullname"))
    inner = F.to_json(
        F.struct(
            _id().alias("id"), F.concat(F.lit(" "), "event_type").alias("title"), F.lit("s").alias("summary"), F.col("event_type").alias("ai_summary"), F.array(F.lit(" k "), F.lit(""), F.col("event_type")).alias("ai_keywords"),
            day.alias("publishedAt"), F.when(F.pmod("event_id", F.lit(3)) == 0, day).alias("submittedOnDailyAt"), named("", _id()).alias("submittedOnDailyBy"), F.concat(F.lit("https://p/"), _id()).alias("projectPage"),
            named("o", F.col("event_type")).alias("organization"), F.concat(F.lit("d"), _id()).alias("discussionId"),
        )
    )
    json = F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit('{"title": "outer", "summary": "outer", "paper":'), inner, F.lit("}"))).otherwise(inner)
    return listings.papers(table(spark, sf_dir, "events").select(json.alias("json")))


def sitemap_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as sub-sitemaps of their region's index; those of every fifth could not be fetched, of every sixth are malformed."""
    nations = table(spark, sf_dir, "nation").withColumn("loc", F.concat(F.lit("https://r"), F.col("n_regionkey").cast("string"), F.lit(".com/s"), F.col("n_nationkey").cast("string"), F.lit(".xml")))
    subs = nations.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<sitemap><loc>"), "loc", F.lit("</loc></sitemap>")))), "").alias("s"))
    site = lambda c: F.concat(F.lit("https://r"), F.col(c).cast("string"), F.lit(".com"))
    roots = subs.select(site("n_regionkey").alias("site"), F.concat(F.lit('<?xml version="1.0"?><sitemapindex>'), "s", F.lit("</sitemapindex>")).alias("xml"))
    members = table(spark, sf_dir, "customer").select("c_nationkey", F.concat(F.lit("<url><loc>/c/"), F.col("c_custkey").cast("string"), F.lit("</loc><lastmod>2024-01-01</lastmod></url>")).alias("u"))
    bodies = members.groupBy("c_nationkey").agg(F.concat(F.lit("<urlset>"), F.array_join(F.array_sort(F.collect_list("u")), ""), F.lit("</urlset>")).alias("body"))
    xml = F.when(F.pmod("n_nationkey", F.lit(5)) == 0, F.lit(None)).when(F.pmod("n_nationkey", F.lit(6)) == 0, F.lit("<urlset><url>")).otherwise(F.col("body"))
    fetched = nations.join(bodies, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("loc").alias("sitemap"), xml.alias("xml"))
    return listings.sitemap_tree(roots, fetched)


def archive_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as archives, newest first: what is read until the first post before the cutoff."""
    posts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("at"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"), F.concat(F.lit("https://x/"), F.col("o_orderkey").cast("string")).alias("url"), F.col("o_orderpriority").alias("title"))
    return listings.discover("archive", posts, cutoff="1995-01-01")


def spa_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scripts = table(spark, sf_dir, "pages").select(F.col("page_id").alias("site"), F.concat("html", F.lit(' "slug":"b" "slug":"a" "slug":"b" ')).alias("script"))
    return listings.bundle_slugs(scripts, '"slug":"([a-z]+)"', "https://x/md/%s.md")


def iso_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(listings.iso_week(F.col("o_orderdate").cast("date")).alias("week")).distinct()


def paper_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liked papers since a day, the best first; those without an id go after the cut."""
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = table(spark, sf_dir, "events").select(F.when(F.pmod("event_id", F.lit(10)) != 0, _id()).otherwise("").alias("id"), F.col("event_type").alias("title"), F.floor("value").cast("int").alias("upvotes"), F.when(F.pmod("event_id", F.lit(2)) == 0, day).otherwise("").alias("submitted"), day.alias("published"))
    return listings.discover_papers(rows, 20, "2024-01-05", 40).select("id", "upvotes")


def listing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with month headings: undated cards take the heading above them, the first occurrence of a link counts."""
    card = lambda link, extra="": F.concat(F.lit('<a href="'), link, F.lit('">'), "n_name", F.lit(f"</a>{extra}"))
    key = F.col("n_nationkey").cast("string")
    html = F.concat(card(F.concat(F.lit("/top/"), key)), F.lit("<h2>March 1, 2024</h2>"), card(F.concat(F.lit("/a/"), key)), card(F.lit("/both")), F.lit("<h2>Feb 1, 2024</h2>"), card(F.lit("/both")), card(F.concat(F.lit("/c/"), key)))
    pages = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("listing"), F.lit("https://x.com/list").alias("url"), html.alias("html"))
    return listings.dated_items(pages, ('<a href="([^"]+)">(.*?)</a>',), "<h2>(.*?)</h2>")


def front_matter_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter with a list, and documents without a fence, whose body is the whole text."""
    fenced = F.concat(F.lit("---\ntitle: 'It'\ntags:\n  - a\n  - "), "lang", F.lit("\nempty:\n---\n"), "text")
    read = text.simple_front_matter(F.when(F.pmod("doc_id", F.lit(4)) == 0, F.concat(F.lit("x"), "text")).otherwise(fenced))
    docs = table(spark, sf_dir, "documents").select("doc_id", read.alias("r"))
    value = lambda k: F.array_join(F.try_element_at("r.fields", F.lit(k)), ",").alias(k)
    return docs.select("doc_id", value("title"), value("tags"), F.md5("r.body").alias("digest"))


def page_text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' text without tags, where there is enough of it."""
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.unescape(text.plain_text("html", 300))).alias("digest"))


def full_text_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers fetched from two hosts: the first full text counts, an abstract page is none."""
    docs = table(spark, sf_dir, "documents")
    first, second = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.col("text")), F.concat("text", F.lit(" mirrored"))
    answered = F.when(F.pmod("doc_id", F.lit(5)) == 0, "https://a/abs/1").otherwise("https://a/html/1")
    return docs.select("doc_id", F.md5(providers.first_full(first, second, asked=F.lit("https://a/html/1"), answered=answered)).alias("digest"))


def fetched_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies by a provider that fails for every third URL."""

    def fetch(url: str) -> str:
        if int(url.rpartition("/")[2]) % 3 == 0:
            raise OSError("gone")
        return f"body of {url}"

    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("https://x/"), F.col("p_partkey").cast("string")).alias("url"))
    return providers.fetched(rows, fetch)


def hosted_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where hosting pages say that transcripts lie, and how many segments those have; malformed ones have none."""
    page = F.concat(F.lit('{"podcastUpload": {"transcription": {"cdn_url": "https://cdn/'), _id(), F.lit('"}}}'))
    body = F.when(F.pmod("event_id", F.lit(4)) == 0, F.lit("{oops")).otherwise(F.concat(F.lit('{"segments": [{"start": 1, "text": "'), "event_type", F.lit('"}, [1, 2, "x"]]}')))
    return table(spark, sf_dir, "events").select("event_id", providers.hosted_transcript_url(page).alias("url"), F.size(providers.hosted_segments(body)).alias("segments"))


def run_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" to "), F.date_format(F.date_add("o_orderdate", 6), "yyyy-MM-dd"))
    w = files.run_window(told)
    return table(spark, sf_dir, "orders").select("o_orderkey", w["start"].alias("start"), w["end"].alias("end"))


QUERIES = {
    f.__name__: f
    for f in (
        feed_rss, feed_atom, feed_inline, feed_inline_atom, sitemap_dispatch, listing_by_month, paper_fields, sitemap_tree, archive_paging, spa_slugs, iso_weeks, paper_discovery, listing_months, front_matter_lists, page_text_fallback, full_text_hosts, fetched_bodies, hosted_transcripts, run_windows,
    )
}

ORACLE_SQL = {
    "feed_rss": """SELECT 'https://x/feed/k' || CAST(user_id AS VARCHAR) AS feed, 'https://x/a/' || CAST(event_id AS VARCHAR) AS url, event_type || ' & more' AS title,
        CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS published FROM events WHERE event_id % 5 <> 0 AND (event_id % 7 = 0 OR ts >= TIMESTAMP '2024-01-10')""",
    "feed_atom": """SELECT 'https://x/feed/k' || CAST(user_id AS VARCHAR) AS source, 'https://x/b/' || CAST(event_id AS VARCHAR) AS url, strftime(ts, '%Y-%m-%d') AS published, event_type AS title FROM events""",
    "feed_inline": """SELECT 'https://x/feed/k' || CAST(user_id AS VARCHAR) AS feed, CASE WHEN event_id % 2 = 0 THEN 'https://x/g/' ELSE 'https://x/l/' END || CAST(event_id AS VARCHAR) AS url, 't' AS title,
        CASE WHEN event_id % 3 = 0 THEN '<p>' || event_type || '</p>' ELSE event_type END AS html, 'k' || CAST(user_id AS VARCHAR) AS secret FROM events WHERE event_id % 3 = 0 OR event_id % 4 <> 0""",
    "feed_inline_atom": """SELECT 'https://x/feed/k' || CAST(user_id AS VARCHAR) AS feed, CASE WHEN event_id % 2 = 0 THEN 'https://x/g/' ELSE 'https://x/l/' END || CAST(event_id AS VARCHAR) AS url, 't' AS title,
        CASE WHEN event_id % 3 = 0 THEN '<p>' || event_type || '</p>' ELSE event_type END AS html, 'k' || CAST(user_id AS VARCHAR) AS secret, 'u' || CAST(user_id AS VARCHAR) AS author,
        CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS published FROM events WHERE (event_id % 3 = 0 OR event_id % 4 <> 0) AND (event_id % 7 = 0 OR ts >= TIMESTAMP '2024-01-10')""",
    "sitemap_dispatch": """WITH s AS (SELECT s_suppkey AS k, 'https://s' || CAST(s_suppkey AS VARCHAR) || '.com' AS source FROM supplier),
        p AS (SELECT k, source, unnest([1, 2, 3]) AS n FROM s WHERE k % 2 = 0)
        SELECT source, source || '/a' AS url, '' AS published, '' AS title FROM s WHERE k % 2 <> 0
        UNION ALL SELECT source, source || '/q/' || CAST(n AS VARCHAR), '', '' FROM p WHERE (k + n) % 5 <> 0
        UNION ALL SELECT source, 'https://x/' || source[9:] || '/p/' || CAST(n AS VARCHAR), '2024-01-0' || CAST(n AS VARCHAR), '' FROM p WHERE (k + n) % 5 <> 0 AND n >= 2""",
    "listing_by_month": """SELECT c_custkey AS source, 'https://x.com/' || path || '/' || CAST(c_custkey AS VARCHAR) AS url, published, c_name AS title
        FROM customer, (VALUES ('top', ''), ('a', '2025-06-03'), ('b', '2025-06'), ('c', '2025-06'), ('d', '2024-09')) AS v(path, published)""",
    "paper_fields": """WITH e AS (SELECT *, CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS day FROM events)
        SELECT id, event_type AS title, CAST([] AS VARCHAR[]) AS authors, 0 AS upvotes, 's' AS summary, event_type AS ai_summary, ['k', event_type] AS keywords, day AS published,
        CASE WHEN event_id % 3 = 0 THEN day ELSE '' END AS submitted, id AS submitted_by, 'https://p/' || id AS project_page, event_type AS organization, 'd' || id AS discussion_id FROM e""",
    "sitemap_tree": """SELECT 'https://r' || CAST(n_regionkey AS VARCHAR) || '.com' AS site, 'https://r' || CAST(n_regionkey AS VARCHAR) || '.com/c/' || CAST(c_custkey AS VARCHAR) AS url, '2024-01-01' AS lastmod
        FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 5 <> 0 AND n_nationkey % 6 <> 0""",
    "archive_paging": """WITH p AS (SELECT *, max(CASE WHEN strftime(o_orderdate, '%Y-%m-%d') < '1995-01-01' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS older FROM orders)
        SELECT o_custkey AS source, 'https://x/' || CAST(o_orderkey AS VARCHAR) AS url, strftime(o_orderdate, '%Y-%m-%d') AS published, o_orderpriority AS title FROM p WHERE older = 0""",
    "spa_slugs": "SELECT DISTINCT page_id AS site, slug, 'https://x/md/' || slug || '.md' AS url FROM pages, (VALUES ('a'), ('b')) AS t(slug)",
    "iso_weeks": "SELECT DISTINCT printf('%04d-W%02d', isoyear(o_orderdate), weekofyear(o_orderdate)) AS week FROM orders",
    "paper_discovery": """WITH t AS (SELECT * FROM events WHERE floor(value) >= 20 AND strftime(ts, '%Y-%m-%d') >= '2024-01-05'
        ORDER BY floor(value) DESC, strftime(ts, '%Y-%m-%d') DESC, CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) ELSE '' END LIMIT 40)
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(floor(value) AS INTEGER) AS upvotes FROM t WHERE event_id % 10 <> 0""",
    "listing_months": """SELECT n_nationkey AS listing, 'https://x.com/top/' || CAST(n_nationkey AS VARCHAR) AS link, n_name AS title, '' AS date FROM nation
        UNION ALL SELECT n_nationkey, 'https://x.com/a/' || CAST(n_nationkey AS VARCHAR), n_name, '2024-03-01' FROM nation UNION ALL SELECT n_nationkey, 'https://x.com/both', n_name, '2024-03-01' FROM nation
        UNION ALL SELECT n_nationkey, 'https://x.com/c/' || CAST(n_nationkey AS VARCHAR), n_name, '2024-02-01' FROM nation""",
    "front_matter_lists": """SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN 'It' END AS title, CASE WHEN doc_id % 4 <> 0 THEN 'a,' || lang END AS tags, md5(CASE WHEN doc_id % 4 = 0 THEN 'x' || text ELSE text END) AS digest FROM documents""",
    "page_text_fallback": r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<nav\b[^>]*>.*?</nav>|<footer\b[^>]*>.*?</footer>|<header\b[^>]*>.*?</header>|<aside\b[^>]*>.*?</aside>', ' ', 'g'),
        '(?i)</(?:p|div|h[1-6]|li|tr)>|<br\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g') AS t FROM pages),
        b AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS t FROM a)
        SELECT page_id, CASE WHEN length(t) >= 300 THEN md5(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '&amp([ \n]|$)', '&\1', 'g')) END AS digest FROM b""",
    "full_text_hosts": """SELECT doc_id, md5(CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 AND length(text) > 1000 THEN text WHEN length(text) + 9 > 1000 THEN text || ' mirrored' END) AS digest FROM documents""",
    "fetched_bodies": "SELECT 'https://x/' || CAST(p_partkey AS VARCHAR) AS url, CASE WHEN p_partkey % 3 <> 0 THEN 'body of https://x/' || CAST(p_partkey AS VARCHAR) END AS body FROM part",
    "hosted_transcripts": "SELECT event_id, 'https://cdn/' || CAST(event_id AS VARCHAR) AS url, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 2 END AS segments FROM events",
    "run_windows": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS start, strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d') AS "end" FROM orders""",
}
