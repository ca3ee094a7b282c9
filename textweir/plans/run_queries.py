"""Runs, ledgers, caches and reprocessing over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions import dates, media, text, urls
from textweir.operators import mirror, render, runs
from textweir.plans.corpus import SEGMENTS_SQL, segments, table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as episodes of their customer's feed; every ninth has no date."""
    day = F.when(F.pmod("o_orderkey", F.lit(9)) == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("feed"), day.alias("date"), F.col("o_orderpriority").alias("title"))


def entries_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest entries, undated ones last."""
    rows = _orders(spark, sf_dir)
    made = runs.by_date(rows, F.try_to_date("date", "yyyy-MM-dd"), True, "ord")
    return runs.limited(made, 500).select("ord", "date")


def entries_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir)
    return runs.limited(runs.by_date(rows, F.try_to_date("date", "yyyy-MM-dd"), False, "ord"), runs.effective_limit(None, 300, 10)).select("ord", "date")


def pending_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.queue(_orders(spark, sf_dir), "articles", 400).select("ord")


def pending_order_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.queue(_orders(spark, sf_dir), "papers", 400).select("ord")


def check_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten entries of a check's list, and how many more there are."""
    return runs.preview(_orders(spark, sf_dir).where("date <> ''"), 10, "date", "ord").select("ord", "date", "more")


def ignore_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.without_dates(_orders(spark, sf_dir), "date", ("1995-0", "1996", "1997-12-31")).select("ord")


def listing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's date against a listing's month, which is a month off for every third."""
    listing = F.when(F.pmod("ord", F.lit(3)) == 0, F.date_format(F.add_months(F.try_to_date("date", "yyyy-MM-dd"), 1), "yyyy-MM")).otherwise(F.left("date", F.lit(7)))
    rows = _orders(spark, sf_dir).where("date <> ''")
    return rows.select("ord", runs.page_or_listing_date(F.col("date"), listing).alias("day"))


def narrowed_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that aren't done, and two that are to be done again."""
    rows = _orders(spark, sf_dir).select("ord", F.concat_ws(" - ", "date", "title").alias("stem"))
    done = rows.where("ord % 4 = 0").select("stem")
    again = ("1996-01-02 - 5-LOW", "1995-10-10 - 1-URGENT")
    return runs.narrowed(rows, "stem", again=again, done=done).select("ord", "stem")


def headerless_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(F.lit("---\nlang: x\n---\n"), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").where(runs.headerless(body)).select("doc_id")


def mirror_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose mirror is missing or older, by time alone."""
    files = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") * 10).cast("double").alias("mtime"))
    copies = files.where("doc_id % 5 <> 0").withColumn("mtime", F.col("mtime") - F.when(F.pmod("doc_id", F.lit(3)) == 0, 1.0).otherwise(0.0))
    return runs.stale(files, copies, "doc_id").select("doc_id")


def mirror_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mirror of the texts has to be given, in blocks of 500 characters; it lacks one text in five, and one in seven differs within some of its blocks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    other = F.concat(F.substr("text", F.lit(1), F.lit(1499)), F.translate(F.substr("text", F.lit(1500), F.lit(500)), "e", "3"), F.substr("text", F.lit(2000)))
    copies = docs.where("doc_id % 5 <> 0").withColumn("text", F.when(F.pmod("doc_id", F.lit(7)) == 0, other).otherwise(F.col("text")))

    def blocks(rows: DataFrame) -> DataFrame:
        each = rows.select("doc_id", "text", F.expr("explode(sequence(0L, greatest((length(text) + 499) div 500, 1L) - 1))").alias("block"))
        return each.select("doc_id", "block", F.expr("md5(encode(substr(text, cast(block * 500 + 1 as int), 500), 'UTF-8'))").alias("digest"))

    changed = mirror.changed_blocks(blocks(docs), blocks(copies), "doc_id")
    return changed.select("doc_id", F.size("blocks").cast("bigint").alias("n_blocks"), F.array_join(F.col("blocks").cast("array<string>"), ",").alias("blocks"))


def metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as transcripts with the metadata of their last order; those without one keep none."""
    stems = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("feed"))
    meta = _orders(spark, sf_dir).select("feed", "ord", "title", "date")
    return runs.latest_metadata(stems, meta, "feed", "ord")


def due_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("ord")
    return runs.still_due(rows, rows.where("ord % 3 = 0"), rows.where("ord % 2 = 0"), "ord", "transcribe")


def due_by_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("ord")
    return runs.still_due(rows, rows.where("ord % 3 = 0"), rows.where("ord % 2 = 0"), "ord", "diarize")


def chunk_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings cut in chunks, every fourth of which has a checkpoint."""
    recordings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode"), F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("seconds"))
    points = recordings.select("episode", F.pmod("episode", F.lit(4)).cast("int").alias("chunk"))
    return runs.chunk_plan(recordings, points)


def chunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three segments a chunk, merged to those of the whole recording."""
    made = segments(spark, sf_dir).select("episode", F.floor((F.col("ord") - 1) / 3).cast("int").alias("chunk"), "ord", "start", "end", "text")
    return runs.merged_chunks(made)


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pct = F.round(F.pmod("doc_id", F.lit(97)) / 2.0, 1)
    severity = F.when(pct < 8, "clean").when(pct < 20, "mild").when(pct < 35, "moderate").otherwise("severe")
    return table(spark, sf_dir, "documents").select(pct.alias("loop_pct"), severity.alias("severity"), F.col("source").alias("feed"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".x.md")).alias("path_under_transcripts"))


def audit_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.audited(_audit(spark, sf_dir), ("severe", "moderate"), feeds=("src1", "src2", "src3"), limit=50)


def audit_by_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share alone decides, whatever the severities."""
    return runs.audited(_audit(spark, sf_dir), ("clean",), min_pct=40.0).select("path_under_transcripts", "loop_pct")


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _audit(spark, sf_dir).where("severity = 'severe'").select("feed", runs.stem_of(F.col("path_under_transcripts")).alias("stem"))
    number = F.split_part("stem", F.lit("."), F.lit(1)).cast("bigint")
    return runs.reprocess_plan(rows, rows.where(number % 2 == 0), rows.where(number % 3 == 0), rows.where(number % 5 == 0))


def reprocess_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


def reprocess_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.reprocess_summary(_plan(spark, sf_dir))


def ledger_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledgers of the feeds that lose severe episodes, without them."""
    ledger = _audit(spark, sf_dir).select("feed", runs.stem_of(F.col("path_under_transcripts")).alias("stem"))
    return runs.ledger_without(ledger, _plan(spark, sf_dir).where("step <> 'missing'"))


def attempts_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://x/"), F.col("c_custkey").cast("string")).alias("url"), (F.pmod("c_custkey", F.lit(4)) - 1).cast("int").alias("attempts"))
    return runs.saved_attempts(attempts)


def failures_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a reset clears."""
    customers = table(spark, sf_dir, "customer")
    _, _, cleared = runs.reset_failures(customers.where("c_custkey % 7 = 0"), customers.where("c_custkey % 3 = 0"))
    return spark.createDataFrame([(cleared,)], "cleared long")


def sidecar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sidecars written as JSON and read again; every eighth is corrupt."""
    from textweir.sources.files import sidecars

    meta = F.to_json(F.struct("title", "date"))
    files = _orders(spark, sf_dir).select(F.col("ord").alias("stem"), F.when(F.pmod("ord", F.lit(8)) == 0, F.lit('{"title": "x"')).otherwise(meta).alias("json"))
    return sidecars(files, "title string, date string").select("stem", F.col("meta.title").alias("title"), F.col("meta.date").alias("date"))


def turn_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with cached turns: changed content, and old entries older than the recording, don't count."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("episode"), F.col("p_size").cast("bigint").alias("size"), F.md5("p_name").alias("digest"), F.lit(100.0).alias("mtime"))
    digest = F.when(F.pmod("episode", F.lit(4)) == 0, "other").when(F.pmod("episode", F.lit(4)) == 1, F.lit(None)).otherwise(F.col("digest"))
    cache = rows.where("episode % 5 <> 0").select("episode", "size", digest.alias("digest"), F.when(F.pmod("episode", F.lit(8)) == 1, 99.0).otherwise(101.0).alias("mtime"), F.lit("turns").alias("turns"))
    return runs.cached_turns(rows, cache).select("episode", "turns")


def media_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    explicit = F.when(F.pmod("n_nationkey", F.lit(3)) == 0, F.concat(F.lit("/own/"), "n_name"))
    backup = F.when(F.pmod("n_nationkey", F.lit(2)) == 0, F.lit("/backup/"))
    return table(spark, sf_dir, "nation").select("n_name", runs.media_folder(explicit, backup, F.col("n_name"), "mp3").alias("folder"))


def skip_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that need no download: those on disk and those transcribed."""
    rows = _orders(spark, sf_dir).select("ord")
    return rows.where("ord % 3 = 0").union(rows.where("ord % 5 = 0")).distinct()


def media_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media type and audio URL of entries with one, two or no media links."""
    link = lambda kind, end: F.struct(F.lit(kind).alias("type"), F.concat(F.lit("https://x/"), F.col("event_id").cast("string"), F.lit(end)).alias("href"))
    way = F.pmod("event_id", F.lit(4))
    links = F.when(way == 0, F.array(link("text/html", ""), link("audio/mpeg", ".mp3"))).when(way == 1, F.array(link("video/mp4", ".mp4"), link("audio/mp4", ".m4a"))).when(way == 2, F.array(link("image/png", ".png"))).otherwise(F.array(link("audio/ogg", ".ogg")))
    return table(spark, sf_dir, "events").select("event_id", media.media_type(links).alias("kind"), media.audio_url(links).alias("audio"))


def episode_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("What: is/this? "), F.col("title"), F.lit("  "))
    return _orders(spark, sf_dir).select("ord", F.concat_ws(" - ", F.when(F.col("date") == "", "0000-00-00").otherwise(F.col("date")), text.safe_filename(title)).alias("stem"))


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as ISO with a zone, without one, as a date, in RFC-2822 and not at all, in UTC."""
    way = F.pmod("event_id", F.lit(5))
    raw = (
        F.when(way == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(way == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(way == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(way == 3, F.date_format("ts", "'Mon, 'd MMM yyyy HH:mm:ss '-0500'")).otherwise("soon")
    )
    return table(spark, sf_dir, "events").select("event_id", dates.iso_time(raw).alias("iso"), dates.dated(F.lit("n/a"), raw)["prefix"].alias("prefix"))


def segment_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in both notations; those without text give null."""
    told = F.when(F.pmod("event_id", F.lit(6)) == 0, " ").otherwise(F.col("event_type"))
    hundredths = F.round(F.col("value") * 100).cast("bigint")
    as_list = F.concat(F.lit("["), hundredths.cast("string"), F.lit(", "), (hundredths + 150).cast("string"), F.lit(', "'), told, F.lit('"]'))
    as_object = F.to_json(F.struct((hundredths / 100).alias("start"), ((hundredths + 150) / 100).alias("end"), F.concat(told, F.lit(" ")).alias("text")))
    s = media.segment_fields(F.when(F.pmod("event_id", F.lit(2)) == 0, as_list).otherwise(as_object))
    return table(spark, sf_dir, "events").select("event_id", s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"))


def simple_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = render.simple_transcript(F.col("source"), F.lit("2024-05-01"), F.col("text"))
    return docs.select("doc_id", F.md5(made).alias("digest"), text.article_path("news/", F.col("source"), F.lit("2024-05-01"), urls.slug(F.concat(F.lit("https://x/a/"), F.col("doc_id").cast("string")))).alias("path"))


def header_with_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(render.header(F.col("text"), title=F.col("source"), show=F.lit(None).cast("string"))).alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        entries_newest, entries_oldest, pending_order, pending_order_papers, check_preview, ignore_dates, listing_dates, narrowed_stems, headerless_docs, mirror_stale, mirror_blocks, metadata_join,
        due_by_ledger, due_by_cache, chunk_resume, chunk_offsets, audit_by_severity, audit_by_share, reprocess_plan, reprocess_summary, ledger_rewrite, attempts_saved, failures_reset,
        sidecar_round_trip, turn_cache, media_folders, skip_set, media_links, episode_stems, iso_dates, segment_fields, simple_transcripts, header_with_summary,
    )
}

EPISODES_SQL = """e AS (SELECT o_orderkey AS ord, o_custkey AS feed, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, o_orderpriority AS title FROM orders)"""
AUDIT_SQL = """a AS (SELECT round((doc_id % 97) / 2.0, 1) AS loop_pct, CASE WHEN round((doc_id % 97) / 2.0, 1) < 8 THEN 'clean' WHEN round((doc_id % 97) / 2.0, 1) < 20 THEN 'mild'
        WHEN round((doc_id % 97) / 2.0, 1) < 35 THEN 'moderate' ELSE 'severe' END AS severity, source AS feed, source || '/' || CAST(doc_id AS VARCHAR) || '.x.md' AS path_under_transcripts, doc_id FROM documents)"""
PLAN_SQL = """p AS (SELECT feed, CAST(doc_id AS VARCHAR) || '.x' AS stem, doc_id % 2 = 0 AS has_audio, doc_id % 3 = 0 AS in_backup, doc_id % 5 = 0 AS in_ledger,
        CASE WHEN doc_id % 2 = 0 THEN 'redo' WHEN doc_id % 3 = 0 THEN 'restore' ELSE 'missing' END AS step FROM a WHERE severity = 'severe')"""
ORACLE_SQL = {
    "entries_newest": f"WITH {EPISODES_SQL} SELECT ord, date FROM e ORDER BY date = '', date DESC, ord LIMIT 500",
    "entries_oldest": f"WITH {EPISODES_SQL} SELECT ord, date FROM e ORDER BY date = '', date, ord LIMIT 300",
    "pending_order": f"WITH {EPISODES_SQL} SELECT ord FROM e ORDER BY date DESC, ord LIMIT 400",
    "pending_order_papers": f"WITH {EPISODES_SQL} SELECT ord FROM e ORDER BY ord LIMIT 400",
    "check_preview": f"WITH {EPISODES_SQL} SELECT ord, date, (SELECT count(*) FROM e WHERE date <> '') - 10 AS more FROM e WHERE date <> '' ORDER BY date, ord LIMIT 10",
    "ignore_dates": f"WITH {EPISODES_SQL} SELECT ord FROM e WHERE NOT starts_with(date, '1995-0') AND NOT starts_with(date, '1996') AND NOT starts_with(date, '1997-12-31')",
    "listing_dates": f"""WITH {EPISODES_SQL} SELECT ord, CASE WHEN ord % 3 = 0 THEN strftime(date_trunc('month', CAST(date AS DATE)) + INTERVAL 1 MONTH, '%Y-%m-01') ELSE date END AS day FROM e WHERE date <> ''""",
    "narrowed_stems": f"""WITH {EPISODES_SQL}, s AS (SELECT ord, date || ' - ' || title AS stem FROM e)
        SELECT ord, stem FROM s WHERE stem NOT IN (SELECT stem FROM s WHERE ord % 4 = 0) OR stem IN ('1996-01-02 - 5-LOW', '1995-10-10 - 1-URGENT')""",
    "headerless_docs": "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 AND NOT starts_with(coalesce(text, ''), '---')",
    "mirror_stale": "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 OR doc_id % 3 = 0",
    "mirror_blocks": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS (SELECT doc_id, t, CASE WHEN doc_id % 7 = 0 THEN substr(t, 1, 1499) || translate(substr(t, 1500, 500), 'e', '3') || substr(t, 2000) ELSE t END AS u FROM d),
        b AS (SELECT doc_id, t, u, unnest(range(greatest((length(t) + 499) // 500, 1))) AS block FROM m)
        SELECT doc_id, count(*) AS n_blocks, string_agg(block, ',' ORDER BY block) AS blocks FROM b WHERE doc_id % 5 = 0 OR substr(t, block * 500 + 1, 500) <> substr(u, block * 500 + 1, 500) GROUP BY doc_id""",
    "metadata_join": f"WITH {EPISODES_SQL}, l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY feed ORDER BY ord DESC) = 1) SELECT c_custkey AS feed, title, date FROM customer LEFT JOIN l ON feed = c_custkey",
    "due_by_ledger": "SELECT o_orderkey AS ord FROM orders WHERE o_orderkey % 3 <> 0",
    "due_by_cache": "SELECT o_orderkey AS ord FROM orders WHERE o_orderkey % 2 <> 0",
    "chunk_resume": """WITH r AS (SELECT c_custkey AS episode, greatest(CAST(ceil(greatest(c_acctbal, 0) / 1800) AS INTEGER) - 1, 0) AS last FROM customer),
        c AS (SELECT episode, unnest(range(0, last + 1)) AS chunk FROM r) SELECT episode, CAST(chunk AS INTEGER) AS chunk, CAST(chunk * 1800 AS INTEGER) AS start, chunk = episode % 4 AS done FROM c""",
    "chunk_offsets": f"""WITH {SEGMENTS_SQL} SELECT episode, CAST(ord AS INTEGER) AS ord, start + (ord - 1) // 3 * 1800.0 AS start, "end" + (ord - 1) // 3 * 1800.0 AS "end", text FROM segments""",
    "audit_by_severity": f"WITH {AUDIT_SQL} SELECT * EXCLUDE (doc_id) FROM a WHERE severity IN ('severe', 'moderate') AND feed IN ('src1', 'src2', 'src3') ORDER BY loop_pct DESC, path_under_transcripts LIMIT 50",
    "audit_by_share": f"WITH {AUDIT_SQL} SELECT path_under_transcripts, loop_pct FROM a WHERE loop_pct >= 40",
    "reprocess_plan": f"WITH {AUDIT_SQL}, {PLAN_SQL} SELECT * FROM p",
    "reprocess_summary": f"WITH {AUDIT_SQL}, {PLAN_SQL} SELECT step, count(*) AS rows, count(*) FILTER (in_ledger) AS unlisted FROM p GROUP BY step",
    "ledger_rewrite": f"""WITH {AUDIT_SQL}, {PLAN_SQL}, g AS (SELECT * FROM p WHERE step <> 'missing')
        SELECT feed, CAST(doc_id AS VARCHAR) || '.x' AS stem FROM a WHERE feed IN (SELECT feed FROM g) AND CAST(doc_id AS VARCHAR) || '.x' NOT IN (SELECT stem FROM g)""",
    "attempts_saved": "SELECT 'https://x/' || CAST(c_custkey AS VARCHAR) AS url, CAST(c_custkey % 4 - 1 AS INTEGER) AS attempts FROM customer WHERE c_custkey % 4 > 1",
    "failures_reset": "SELECT count(*) FILTER (c_custkey % 7 = 0) + count(*) FILTER (c_custkey % 3 = 0) AS cleared FROM customer",
    "sidecar_round_trip": f"WITH {EPISODES_SQL} SELECT ord AS stem, CASE WHEN ord % 8 <> 0 THEN title END AS title, CASE WHEN ord % 8 <> 0 THEN date END AS date FROM e",
    "turn_cache": """SELECT p_partkey AS episode, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 4 = 0 OR p_partkey % 8 = 1 THEN NULL ELSE 'turns' END AS turns FROM part""",
    "media_folders": """SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN '/own/' || n_name WHEN n_nationkey % 2 = 0 THEN '/backup/mp3/' || n_name ELSE 'mp3/' || n_name END AS folder FROM nation""",
    "skip_set": "SELECT o_orderkey AS ord FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0",
    "media_links": """SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'video' WHEN 2 THEN 'text' ELSE 'audio' END AS kind,
        CASE event_id % 4 WHEN 0 THEN 'https://x/' || CAST(event_id AS VARCHAR) || '.mp3' WHEN 1 THEN 'https://x/' || CAST(event_id AS VARCHAR) || '.m4a' WHEN 3 THEN 'https://x/' || CAST(event_id AS VARCHAR) || '.ogg' END AS audio FROM events""",
    "episode_stems": f"WITH {EPISODES_SQL} SELECT ord, CASE WHEN date = '' THEN '0000-00-00' ELSE date END || ' - What isthis ' || title AS stem FROM e",
    "iso_dates": """WITH t AS (SELECT event_id, date_trunc('second', ts) AS s FROM events)
        SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN s - INTERVAL 2 HOUR WHEN 3 THEN s + INTERVAL 5 HOUR WHEN 4 THEN NULL ELSE s END, '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
        CASE WHEN event_id % 5 < 3 THEN strftime(s, '%Y-%m-%d') ELSE '0000-00-00' END AS prefix FROM t""",
    "segment_fields": """WITH t AS (SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) AS h FROM events)
        SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN h / 100.0 END AS start, CASE WHEN event_id % 6 <> 0 THEN (h + 150) / 100.0 END AS "end", CASE WHEN event_id % 6 <> 0 THEN event_type END AS text FROM t""",
    "simple_transcripts": """SELECT doc_id, md5(concat_ws(chr(10) || chr(10), '# ' || source, 'Published: 2024-05-01', text)) AS digest, 'news/' || source || '/2024-05-01 - ' || CAST(doc_id AS VARCHAR) || '.md' AS path FROM documents""",
    "header_with_summary": """SELECT doc_id, md5(concat_ws(chr(10), '---', 'title: "' || source || '"', '---', '', CASE WHEN coalesce(text, '') <> '' THEN '> ' || replace(trim(text), chr(10), chr(10) || '> ') || chr(10) END)) AS digest FROM documents""",
}
