"""Text, date and URL scalars over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.functions import dates, media, text, urls
from textweir.plans.corpus import table


def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.slug(F.col("url")).alias("slug"))


def url_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.full_key(url).alias("full_key"), urls.slug_key(url).alias("slug_key"), urls.base_url(url).alias("base_url"))


def url_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A URL that many items of a host share is the show's, not an item's."""
    url = F.regexp_replace("url", r"[?#].*$", "")
    pages = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("source"), url.alias("bare"))
    n = F.count(F.lit(1)).over(Window.partitionBy("source", "bare"))
    return pages.select("page_id", "source", F.when(F.col("bare") == "", "none").when(n > 1, "show").otherwise("article").alias("url_kind"))


def strip_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_after(F.col("text"), "token").alias("body"))


def strip_secret_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_secret_lines(F.col("text"), "token").alias("body"))


def trim_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.col("text"), F.lit("\n## References\n[1] "), F.col("source"))
    trimmed = text.trim_references(body)
    return table(spark, sf_dir, "documents").select("doc_id", trimmed["body"].alias("body"), trimmed["truncated"].alias("truncated"))


def loose_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written in four ways, one of them unreadable."""
    ts, way = F.col("ts"), F.pmod("event_id", F.lit(4))
    raw = (
        F.when(way == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(way == 1, F.date_format(ts, "MMM d, yyyy")).when(way == 2, F.concat(F.lit("Posted on "), F.date_format(ts, "MMMM dd yyyy")))
    ).otherwise(F.concat(F.lit("Mai 32, 20"), F.date_format(ts, "yy")))
    return table(spark, sf_dir, "events").select("event_id", dates.loose_date(raw).alias("day"), dates.normalize_date(raw, F.lit("2020-01-01")).alias("prefix"))


def slug_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs that code a date, with and without a year; every seventh has month 19."""
    month = F.when(F.pmod("event_id", F.lit(7)) == 0, "19").otherwise(F.date_format("ts", "MM"))
    year = F.when(F.pmod("event_id", F.lit(2)) == 0, F.date_format("ts", "yy")).otherwise("")
    slug = F.concat(F.lit("news"), year, month, F.date_format("ts", "dd"))
    return table(spark, sf_dir, "events").select("event_id", dates.slug_date(slug, r"^news(\d{2})?(\d{2})(\d{2})$", 1, 2, 3, "2024").alias("day"))


def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the last two weeks and undated ones; every 50th is undated."""
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    published = F.when(F.pmod("event_id", F.lit(50)) != 0, F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").where(published.isNull() | (published >= dates.since_cutoff("2w", now))).select("event_id", "event_type")


def rfc2822_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.pmod("event_id", F.lit(9)) == 0, "soon").otherwise(F.date_format("ts", "'Mon, 'd MMM yyyy HH:mm:ss '+0000'"))
    return table(spark, sf_dir, "events").select("event_id", dates.rfc2822_date(raw).alias("day"))


def safe_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.nfc(text.safe_filename(F.col("text"))).alias("stem"))


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.floor(F.col("value") * 60)
    return table(spark, sf_dir, "events").select("event_id", media.duration(seconds).alias("duration"), media.timestamp(seconds).alias("stamp"))


def speaker_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("SPEAKER_"), F.lpad(F.pmod("event_id", F.lit(30)).cast("string"), 2, "0"))
    return table(spark, sf_dir, "events").select("event_id", media.speaker_label(label).alias("label"))


def chapter_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions in three notations, with a repeated chapter and a sponsor's link."""
    t = lambda n: F.format_string("%02d:%02d", F.pmod(F.col("event_id") + n, F.lit(60)), F.pmod("user_id", F.lit(60)))
    way = F.pmod("event_id", F.lit(3))
    lines = lambda a, b: F.concat_ws("\n", F.concat(F.lit(a), t(0), F.lit(b), F.col("event_type"), F.lit(".")), F.concat(F.lit(a), t(7), F.lit(b), F.lit("Outro")), F.concat(F.lit(a), t(7), F.lit(b), F.lit("outro,")), F.concat(F.lit(a), t(9), F.lit(b), F.lit("https://ad.example")))
    description = F.when(way == 0, lines("(", ") - ")).when(way == 1, lines("[", "] ")).otherwise(lines("", "  "))
    found = table(spark, sf_dir, "events").select("event_id", F.explode(media.chapters(description)).alias("c"))
    return found.select("event_id", F.col("c.ts").alias("ts"), F.col("c.title").alias("title"))


def repetition_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.repetition(table(spark, sf_dir, "documents"), "doc_id")


def repetition_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_fraction(spark, sf_dir).where(F.col("fraction") >= text.LOOP_SHARE)


def audit_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst audit rows of some sources by severity, worst first."""
    scored = text.repetition(table(spark, sf_dir, "documents"), "doc_id", "source")
    severity = F.when(F.col("fraction") >= 0.3, "severe").when(F.col("fraction") >= text.LOOP_SHARE, "moderate").when(F.col("fraction") > 0.02, "mild").otherwise("clean")
    return scored.withColumn("severity", severity).where(F.col("severity").isin("severe", "moderate")).orderBy(F.desc("fraction"), "doc_id").limit(25)


def collapse_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    looped = F.concat_ws(" ", F.col("text"), F.repeat(F.concat(F.lit("So "), F.col("source"), F.lit(". ")), F.pmod("doc_id", F.lit(5)).cast("int")), F.lit("End."))
    return text.collapse_runs(table(spark, sf_dir, "documents").withColumn("text", looped), "doc_id")


def render_article_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    both = pages.join(docs, F.col("page_id") == F.col("doc_id"))
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    made = text.markdown_article(title, F.col("url"), F.col("source"), F.lit("2024-05-01"), F.array("lang", F.lit("news")), F.col("text"))
    return both.select("page_id", made.alias("content"))


def front_matter_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = render_article_md(spark, sf_dir).withColumn("fields", text.front_matter(F.col("content")))
    return made.select("page_id", F.col("fields")["url"].alias("url"), F.col("fields")["source"].alias("source"), F.col("fields")["published"].alias("published"))


def section_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of a weekly digest made of a document's lines: each a heading, and the line below another."""
    line = F.trim(F.regexp_replace(F.translate("text", "#", " "), r"[ \t\r]+", " "))
    made = F.array_join(F.transform(F.split(line, "\n", -1), lambda x: F.concat(F.lit("## Of "), F.trim(x), F.lit("\n### Detail\n"), F.trim(x))), "\n")
    found = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.section_bodies(made)).alias("at", "s"))
    return found.select("doc_id", "at", F.col("s.title").alias("heading"), F.col("s.body").alias("body"))


def html_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without tags, and how many distinct links a page has."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1)))
    title = F.trim(text.strip_tags(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)))
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), F.size(links).alias("links"))


QUERIES = {
    f.__name__: f
    for f in (
        url_slug, url_dedup_keys, url_kind, strip_after, strip_secret_lines, trim_references, loose_date_parse, slug_date_parse, since_filter, rfc2822_dates,
        safe_filenames, durations, speaker_labels, chapter_parse, repetition_fraction, repetition_flagged, audit_select, collapse_repetitions, render_article_md,
        front_matter_round_trip, section_extract, html_title_links,
    )
}

_U = {"u": "url"}
REPETITION_SQL = r"""
words AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
grams AS (SELECT doc_id, list_slice(w, i, i + 7) AS g FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 7, 1))) AS i)),
counted AS (SELECT doc_id, g, count(*) AS n FROM grams GROUP BY doc_id, g),
looped AS (SELECT doc_id, sum(n) AS n FROM counted WHERE n >= 3 GROUP BY doc_id),
scored AS (SELECT words.doc_id, source, CASE WHEN len(w) > 8 THEN round(coalesce(looped.n, 0) / CAST(len(w) AS DOUBLE), 6) ELSE 0.0 END AS fraction
           FROM words LEFT JOIN looped ON looped.doc_id = words.doc_id)
"""
ORACLE_SQL = {
    "url_slug": f"SELECT page_id, {urls.SLUG_SQL.format(**_U)} AS slug FROM pages",
    "url_dedup_keys": f"""SELECT page_id, {urls.FULL_SQL.format(**_U)} AS full_key, {urls.HOST_SQL.format(**_U)} || '|' || {urls.SLUG_SQL.format(**_U)} AS slug_key,
        regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS base_url FROM pages""",
    "url_kind": f"""WITH p AS (SELECT page_id, {urls.HOST_SQL.format(**_U)} AS source, regexp_replace(url, '[?#].*$', '') AS bare FROM pages)
        SELECT page_id, source, CASE WHEN bare = '' THEN 'none' WHEN count(*) OVER (PARTITION BY source, bare) > 1 THEN 'show' ELSE 'article' END AS url_kind FROM p""",
    "strip_after": r"SELECT doc_id, rtrim(regexp_replace(text, '(?is)token.*$', ''), ' ' || chr(10) || chr(9)) AS body FROM documents",
    "strip_secret_lines": r"""SELECT doc_id, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, 'token')), chr(10)),
        '\n{3,}', chr(10) || chr(10), 'g') AS body FROM documents""",
    "trim_references": r"""SELECT doc_id, left(cut, 40000) AS body, length(cut) > 40000 AS truncated FROM (
        SELECT doc_id, rtrim(regexp_replace(text || chr(10) || '## References' || chr(10) || '[1] ' || source, '(?is)\n#+\s*references\b.*$', ''), ' ' || chr(10) || chr(9)) AS cut FROM documents)""",
    "loose_date_parse": """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day,
        CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE '2020-01-01' END AS prefix FROM events""",
    "slug_date_parse": "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events",
    "since_filter": "SELECT event_id, event_type FROM events WHERE event_id % 50 = 0 OR ts >= TIMESTAMP '2024-01-30' - INTERVAL 14 DAY",
    "rfc2822_dates": "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '0000-00-00' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events",
    "safe_filenames": r"""SELECT doc_id, nfc_normalize(rtrim(left(trim(regexp_replace(regexp_replace(text, '[<>:"/\\|?*\x00-\x1f]', '', 'g'), '\s+', ' ', 'g')), 120))) AS stem FROM documents""",
    "durations": """WITH t AS (SELECT event_id, CAST(floor(value * 60) AS BIGINT) AS s FROM events)
        SELECT event_id, CASE WHEN s = 0 THEN '--:--' WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%d:%02d', s // 60, s % 60) END AS duration,
        CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS stamp FROM t""",
    "speaker_labels": "SELECT event_id, CASE WHEN event_id % 30 < 26 THEN chr(CAST(65 + event_id % 30 AS INTEGER)) ELSE printf('SPEAKER_%02d', event_id % 30) END AS label FROM events",
    "chapter_parse": """WITH t AS (SELECT event_id, event_type, user_id % 60 AS s, event_id % 60 AS a, (event_id + 7) % 60 AS b FROM events)
        SELECT event_id, CAST(a * 60 + s AS DOUBLE) AS ts, event_type AS title FROM t UNION ALL SELECT event_id, CAST(b * 60 + s AS DOUBLE), 'Outro' FROM t""",
    "repetition_fraction": f"WITH {REPETITION_SQL} SELECT doc_id, fraction FROM scored",
    "repetition_flagged": f"WITH {REPETITION_SQL} SELECT doc_id, fraction FROM scored WHERE fraction >= 0.08",
    "audit_select": f"""WITH {REPETITION_SQL} SELECT doc_id, fraction, source, CASE WHEN fraction >= 0.3 THEN 'severe' ELSE 'moderate' END AS severity
        FROM scored WHERE fraction >= 0.08 ORDER BY fraction DESC, doc_id LIMIT 25""",
    "collapse_repetitions": r"""
WITH looped AS (SELECT doc_id, concat_ws(' ', text, repeat('So ' || source || '. ', CAST(doc_id % 5 AS INTEGER)), 'End.') AS t FROM documents),
parts AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS p FROM looped),
rows_ AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS s FROM parts),
normal AS (SELECT *, regexp_replace(trim(lower(s)), '\s+', ' ', 'g') AS k FROM rows_),
marked AS (SELECT *, CASE WHEN k = lag(k) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS starts FROM normal),
islands AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM marked),
sized AS (SELECT *, count(*) OVER (PARTITION BY doc_id, island) AS n FROM islands)
SELECT doc_id, string_agg(s, ' ' ORDER BY i) AS body FROM sized WHERE n < 3 OR starts = 1 GROUP BY doc_id""",
    "render_article_md": r"""SELECT page_id, concat_ws(chr(10), '---', 'title: "' || replace(replace(t, '\', '\\'), '"', '\"') || '"', 'type: article', 'source: ' || source, 'url: ' || url,
        'published: 2024-05-01', 'tags: [' || lang || ', news]', '---', '', CASE WHEN ltrim(text) LIKE '# %' THEN NULL ELSE '# ' || t || chr(10) END, text) AS content
        FROM (SELECT *, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages JOIN documents ON page_id = doc_id)""",
    "front_matter_round_trip": "SELECT page_id, url, source, '2024-05-01' AS published FROM pages JOIN documents ON page_id = doc_id",
    "section_extract": r"""WITH l AS (SELECT doc_id, list_transform(string_split(trim(regexp_replace(translate(text, '#', ' '), '[ \t\r]+', ' ', 'g')), chr(10)), lambda x: trim(x)) AS p FROM documents)
        SELECT doc_id, CAST(unnest(range(0, len(p))) AS INTEGER) AS "at", unnest(list_transform(p, lambda x: trim('Of ' || x))) AS heading, unnest(list_transform(p, lambda x: '### Detail' || CASE WHEN x = '' THEN '' ELSE chr(10) || x END)) AS body FROM l""",
    "html_title_links": r"""SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]+>', '', 'g')) AS title,
        CAST(len(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS INTEGER) AS links FROM pages""",
}
