"""Discovery, ledgers, incremental indexing and retention over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions import urls
from textweir.operators import ledger
from textweir.plans.corpus import CORPUS_SQL, corpus, table
from textweir.sources import listings


def _rewritten(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Ledger URLs as they were written in the past: other scheme, `www.`, slash or path prefix."""
    marked = table(spark, sf_dir, "labels").where(f"{which} = 1").select(F.col("doc_id").alias("page_id"))
    url, way = F.col("url"), F.pmod("page_id", F.lit(4))
    bare = F.regexp_replace(url, "^https?://", "")
    old = F.when(way == 0, F.concat(F.lit("http://"), bare)).when(way == 1, F.concat(F.lit("https://www."), F.regexp_replace(bare, r"^www\.", "")))
    old = old.when(way == 2, F.concat(F.regexp_replace(url, "[?#].*$", ""), F.lit("/"))).otherwise(F.regexp_replace(url, "^(https?://[^/]+)/", "$1/old/"))
    return table(spark, sf_dir, "pages").join(marked, "page_id").select((url if which == "toxic" else old).alias("url"))


def discover_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url")
    return ledger.pending(found, _rewritten(spark, sf_dir, "quality"), _rewritten(spark, sf_dir, "toxic"))


def sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One urlset a host: rows of host and xml, with locs in full, without scheme, or as paths."""
    url, way = F.col("url"), F.pmod("page_id", F.lit(3))
    loc = F.when(way == 0, url).when(way == 1, F.regexp_replace(url, "^https?://", "")).otherwise(F.regexp_replace(url, "^https?://[^/]+", ""))
    entry = F.concat(F.lit("<url><loc>"), F.replace(loc, F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>2024-0"), (F.pmod("page_id", F.lit(9)) + 1).cast("string"), F.lit("-01</lastmod></url>"))
    made = table(spark, sf_dir, "pages").withColumns({"site": urls.base_url(url), "entry": entry})
    return made.groupBy("site").agg(F.concat(F.lit("<urlset>"), F.array_join(F.sort_array(F.collect_list("entry")), ""), F.lit("</urlset>")).alias("xml"))


def sitemap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings.urlset_rows(sitemap(spark, sf_dir), include="/en/", exclude=("page=", "#top"), pattern="example", since="2024-04-01")
    return rows.select("url", "lastmod")


def html_listing_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("listing"), "url", "html")
    items = listings.listing_items(pages, (r'<a href="(/[^"]*)">([A-Z][^<]*)</a>', r'<a href="(/[^"]*)">([^<]*)</a>'))
    return items.select("listing", "link", "title")


def embed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in range without a vector; briefs always are in range."""
    docs = corpus(spark, sf_dir).where((F.col("corpus") == "briefs") | F.col("date").between("2024-02-01", "2024-06-30"))
    have = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    missing = docs.join(have, "doc_id", "left_anti")
    given = F.when(F.col("source").isin("src1", "src2"), F.col("text")).otherwise(F.concat_ws("\n", "path", "text"))
    return missing.select("doc_id", F.md5(given).alias("input"))


def index_sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index against a later listing: some files gone, some new, some of another size or time."""
    docs = corpus(spark, sf_dir).select("doc_id", "path", F.length("text").cast("bigint").alias("size"), F.col("doc_id").cast("double").alias("mtime"), F.lit("std").alias("chunker"))
    known = docs.where("doc_id % 10 <> 0")
    current = docs.where("doc_id % 13 <> 0").withColumns(
        {"size": F.col("size") + F.when(F.pmod("doc_id", F.lit(7)) == 0, 1).otherwise(0), "mtime": F.col("mtime") + F.when(F.pmod("doc_id", F.lit(11)) == 0, 1.0).otherwise(1e-7), "chunker": F.when(F.pmod("doc_id", F.lit(17)) == 0, "digest").otherwise("std")}
    )
    return ledger.snapshot_diff(known, current, "path", "size", "mtime", "chunker")


def sync_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", F.length("text").cast("bigint").alias("size"), F.col("doc_id").cast("double").alias("mtime"), F.md5("text").alias("digest"))
    copies = files.where("doc_id % 5 <> 0").withColumns(
        {
            "size": F.col("size") - F.when(F.pmod("doc_id", F.lit(6)) == 0, 1).otherwise(0),
            "mtime": F.col("mtime") - F.when(F.pmod("doc_id", F.lit(4)) == 0, 3).otherwise(1),
            "digest": F.when(F.pmod("doc_id", F.lit(8)) == 0, F.lit("old")).otherwise(F.col("digest")),
        }
    )
    return ledger.needs_sync(files, copies, "doc_id").select("doc_id")


def attempts_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "purchase"))
    return ledger.failure_runs(outcomes, "user_id", F.col("event_type") == "purchase", "ts", "event_id")


def success_capped_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return ledger.success_capped(events, "user_id", F.col("event_type") != "error", 5, "ts", "event_id").select("event_id", "user_id", "event_type")


def evict_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old episodes beyond the newest five of a feed: evictable with a transcript, blocked without."""
    orders = table(spark, sf_dir, "orders")
    done = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has", F.lit(True))
    old = ledger.newest(orders, "o_custkey", 5, F.desc("o_orderdate"), F.desc("o_orderkey")).where("over")
    return old.join(done, "o_orderkey", "left").select("o_orderkey", "o_custkey", F.when(F.col("has"), "evict").otherwise("blocked").alias("action"))


def check_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no ledger has, by priority and in all."""
    orders = table(spark, sf_dir, "orders")
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("o_orderkey"))
    new = orders.join(known, "o_orderkey", "left_anti")
    return new.rollup("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes, done ones and shipped lines of each customer, each side aggregated before it is joined."""
    orders = table(spark, sf_dir, "orders")
    a = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    b = lines.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("lines"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return table(spark, sf_dir, "customer").select("c_custkey").join(a, "c_custkey", "left").join(b, "c_custkey", "left").select("c_custkey", zero("episodes"), zero("done"), zero("lines"))


def news_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.max("date").alias("newest"))


def paper_rank_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers (events): liked enough, most liked first, then newest; a blank id is dropped after the cut."""
    likes = F.floor("value").cast("int")
    papers = table(spark, sf_dir, "events").select("event_id", likes.alias("upvotes"), "ts").where(F.col("upvotes") >= 20)
    return papers.orderBy(F.desc("upvotes"), F.desc("ts"), "event_id").limit(30).where("event_id % 10 <> 0").select("event_id", "upvotes")


def paper_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers in JSON, with and without a wrapper, as flat rows."""
    inner = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"), F.array(F.struct(F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("name")), F.struct(F.lit("").alias("name"))).alias("authors"), F.get_json_object("props", "$.k").cast("int").alias("upvotes")))
    wrapped = F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit('{"paper":'), inner, F.lit("}"))).otherwise(inner)
    return listings.papers(table(spark, sf_dir, "events").select(wrapped.alias("json"))).select("id", "title", "authors", "upvotes")


QUERIES = {
    f.__name__: f
    for f in (
        discover_pending, sitemap_filter, html_listing_first_seen, embed_missing, index_sync_diff, sync_staleness, attempts_promoted, success_capped_download,
        evict_candidates, check_new, feed_status, news_status, paper_rank_topn, paper_flatten,
    )
}


def _keys(u: str) -> str:
    return f"{urls.FULL_SQL.format(u=u)} AS full_key, {urls.HOST_SQL.format(u=u)} || '|' || {urls.SLUG_SQL.format(u=u)} AS slug_key"


ORACLE_SQL = {
    "discover_pending": rf"""
WITH old AS (SELECT CASE page_id % 4 WHEN 0 THEN 'http://' || regexp_replace(url, '^https?://', '')
    WHEN 1 THEN 'https://www.' || regexp_replace(regexp_replace(url, '^https?://', ''), '^www\.', '')
    WHEN 2 THEN regexp_replace(url, '[?#].*$', '') || '/' ELSE regexp_replace(url, '^(https?://[^/]+)/', '\1/old/') END AS u
  FROM pages JOIN labels ON doc_id = page_id WHERE quality = 1),
done AS (SELECT {_keys('u')} FROM old),
found AS (SELECT page_id, url, {_keys('url')} FROM pages)
SELECT page_id, url FROM found WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.full_key = found.full_key)
  AND NOT EXISTS (SELECT 1 FROM done WHERE done.slug_key = found.slug_key)
  AND url NOT IN (SELECT url FROM pages JOIN labels ON doc_id = page_id WHERE toxic = 1)""",
    "sitemap_filter": r"""
WITH l AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/]+)', 1) AS site, page_id % 9 + 1 AS m FROM pages),
r AS (SELECT CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://' || regexp_replace(url, '^https?://', '') ELSE url END AS url, '2024-0' || CAST(m AS VARCHAR) || '-01' AS lastmod, m FROM l)
SELECT url, lastmod FROM r WHERE m >= 4 AND contains(url, '/en/') AND NOT contains(url, 'page=') AND NOT contains(url, '#top') AND regexp_matches(url, 'example')
  AND NOT ends_with(rtrim(url, '/'), '/en')""",
    "html_listing_first_seen": r"""
WITH a AS (SELECT page_id, 0 AS pat, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS path, unnest(t) AS title FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)">([A-Z][^<]*)</a>', 1) AS x, regexp_extract_all(html, '<a href="(/[^"]*)">([A-Z][^<]*)</a>', 2) AS t FROM pages)
  UNION ALL SELECT page_id, 1, unnest(range(1, len(x) + 1)), unnest(x), unnest(t) FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1) AS x, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2) AS t FROM pages)),
b AS (SELECT a.page_id AS listing, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || path AS link, title, pat, i FROM a JOIN pages USING (page_id))
SELECT listing, link, title FROM b QUALIFY row_number() OVER (PARTITION BY listing, link ORDER BY pat, i) = 1""",
    "embed_missing": f"""WITH {CORPUS_SQL} SELECT doc_id, md5(CASE WHEN source IN ('src1', 'src2') THEN text ELSE path || chr(10) || text END) AS input FROM corpus
        WHERE (corpus = 'briefs' OR date BETWEEN '2024-02-01' AND '2024-06-30') AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = doc_id)""",
    "index_sync_diff": f"""WITH {CORPUS_SQL} SELECT path, CASE WHEN doc_id % 10 = 0 THEN 'add' WHEN doc_id % 13 = 0 THEN 'delete'
        WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 THEN 'change' ELSE 'keep' END AS change FROM corpus WHERE NOT (doc_id % 10 = 0 AND doc_id % 13 = 0)""",
    "sync_staleness": "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 OR doc_id % 6 = 0 OR doc_id % 8 = 0",
    "attempts_promoted": """
WITH o AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS ok FROM events WHERE event_type IN ('error', 'purchase')),
r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM o),
n AS (SELECT user_id, run, count(*) FILTER (NOT ok) AS n FROM r GROUP BY user_id, run)
SELECT user_id, arg_max(n, run) AS attempts, max(n) >= 3 AS failed FROM n GROUP BY user_id""",
    "success_capped_download": """SELECT event_id, user_id, event_type FROM (SELECT *, coalesce(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) WHERE before < 5""",
    "evict_candidates": """WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
        SELECT o_orderkey, o_custkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F') THEN 'evict' ELSE 'blocked' END AS action FROM r WHERE n > 5""",
    "check_new": """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = o_orderkey) GROUP BY ROLLUP (o_orderpriority)""",
    "feed_status": """WITH a AS (SELECT o_custkey, count(*) AS episodes, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY o_custkey),
        b AS (SELECT o_custkey, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY o_custkey)
        SELECT c_custkey, coalesce(episodes, 0) AS episodes, coalesce(done, 0) AS done, coalesce(lines, 0) AS lines
        FROM customer LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN b ON b.o_custkey = c_custkey""",
    "news_status": f"WITH {CORPUS_SQL} SELECT source, count(*) AS files, max(date) AS newest FROM corpus GROUP BY source",
    "paper_rank_topn": """SELECT event_id, upvotes FROM (SELECT event_id, CAST(floor(value) AS INTEGER) AS upvotes, ts FROM events WHERE floor(value) >= 20
        ORDER BY upvotes DESC, ts DESC, event_id LIMIT 30) WHERE event_id % 10 <> 0""",
    "paper_flatten": """SELECT CAST(event_id AS VARCHAR) AS id, event_type AS title, ['A' || CAST(user_id AS VARCHAR)] AS authors,
        coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS upvotes FROM events""",
}
