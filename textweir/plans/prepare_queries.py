"""Bundles, digests and transcripts with chapters over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.operators import bundles, render, speech
from textweir.plans import bundle_queries as given
from textweir.plans.bundle_queries import LINKS_SQL, OWNERS_SQL
from textweir.plans.corpus import SEGMENTS_SQL, segments, table
from textweir.plans.speech_queries import BLOCKS_SQL


def _reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.reach(given.links(spark, sf_dir), given.owns(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = F.when(F.pmod("o_custkey", F.lit(3)) != 0, F.concat(F.lit("l"), F.col("o_custkey").cast("string")))
    of_signal = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("signal"), lineage.alias("lineage"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return bundles.shared_lines(_reached(spark, sf_dir), of_signal)


def shared_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand shared signals by lineage and date."""
    return _lines(spark, sf_dir).select("signal", "lineage", "date").limit(1000)


def shared_lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.lineage_count(_lines(spark, sf_dir))


def others_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = given.owner_resolution(spark, sf_dir).where("owner is not null").select("signal", "owner")
    return bundles.others_by_owner(owned, _reached(spark, sf_dir))


def trend_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trend's supporting and other signals in one sorted list."""
    rows = given.links(spark, sf_dir).select("trend", F.col("signal").cast("string").alias("s"), "supporting")
    both = rows.groupBy("trend").agg(F.collect_list(F.when(F.col("supporting"), F.col("s"))).alias("a"), F.collect_list(F.when(~F.col("supporting"), F.col("s"))).alias("b"))
    ids = bundles.signal_ids(F.col("a"), F.col("b"))
    return both.select("trend", F.size(ids).alias("n"), F.md5(F.array_join(ids, ",")).alias("digest"))


def section_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as headings that name two counts, matched to nations as trends with the same; a trend once matched alone is taken."""
    trends = table(spark, sf_dir, "nation").select(F.format_string("t%02d", "n_nationkey").alias("trend"), F.pmod("n_nationkey", F.lit(7)).cast("int").alias("signals"), F.pmod("n_regionkey", F.lit(3)).cast("int").alias("lineages"))
    told = F.format_string("Section %d: %d signals, %d lineages", "r_regionkey", F.pmod(F.col("r_regionkey") * 3, F.lit(7)), F.pmod("r_regionkey", F.lit(3)))
    heads = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("ord"), told.alias("heading"))
    counts = bundles.heading_counts(F.col("heading"))
    found = bundles.section_trends(heads.select("ord", "heading", counts["signals"].alias("signals"), counts["lineages"].alias("lineages")), trends)
    return spark.createDataFrame([(h, ",".join(t)) for h, t in found], "heading string, trends string")


def trend_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as trends in the order of a report's summary, numbered."""
    trends = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("trend"), F.pmod("n_nationkey", F.lit(3)).alias("tier"), F.col("n_regionkey").alias("lineages"))
    ordered = [r["trend"] for r in bundles.trend_summary(trends).collect()]
    return spark.createDataFrame(list(enumerate(ordered, 1)), "at int, trend int")


def bundle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics' bundles as Markdown: their lineage signals in order."""
    mine = given.owner_resolution(spark, sf_dir).where("basis = 'lineage'").join(given.signals(spark, sf_dir), "signal")
    lists = mine.groupBy(F.col("owner").alias("topic")).agg(F.array_sort(F.collect_list(F.struct("signal", "claim", F.col("raw_ref").alias("ref")))).alias("signals"))
    return lists.select("topic", F.md5(bundles.bundle_text(F.concat(F.lit("Topic "), "topic"), F.lit("Why?"), F.col("signals"))).alias("digest"))


def weekly_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short block, the headings and the watch list of briefs made of documents."""
    body = F.translate("text", "#*-\n", "    ")
    brief = F.concat(F.lit("# W\n## The 60-second brief\n"), body, F.lit("\n## More\nx\n### Watch list\n- one "), "source", F.lit("\nno item\n* two\n## End\n- not this"))
    read = bundles.digest(brief)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.regexp_replace(read["brief"], r"\s+", " ")).alias("digest"), F.array_join(read["headings"], "|").alias("headings"), F.array_join(bundles.watch_list(brief), "|").alias("watch"))


def violations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections and registry rows with faults put in, and a topic that owns nothing."""
    owns = given.owns(spark, sf_dir).where("topic <> 4").select(F.col("topic").cast("int"), F.col("trend").cast("int"))
    topics = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("topic"))
    sections = spark.sql("SELECT * FROM VALUES ('s1', 1), ('s2', 12) AS t(section, topic)")
    registry = [("event", "ok", 0), ("event", " ", 1), ("mechanism", "(", 2), ("mechanism", "fine", 77)]
    return bundles.violations(owns, topics, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("trend")), sections, registry)


def flat_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = segments(spark, sf_dir).withColumn("text", F.when(F.pmod("event_id", F.lit(4)) == 0, "  ").otherwise(F.concat(F.lit(" "), "text")))
    return render.flat_transcript(made).select("episode", F.md5("content").alias("digest"))


def transcript_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts with two chapters each, put in twice over: the second time changes nothing."""
    bodies = render.transcript(segments(spark, sf_dir)).select("episode", F.col("content").alias("body"))
    times = F.explode(F.array(F.struct(F.lit(432_000.0).alias("ts"), F.lit("Middle").alias("title")), F.struct(F.lit(1e9).alias("ts"), F.lit("Past the end").alias("title"))))
    chapters = bodies.select("episode", times.alias("c")).select("episode", "c.ts", "c.title")
    once = speech.with_chapters(bodies, chapters)
    return speech.with_chapters(once, chapters).select("episode", F.md5("body").alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        shared_in_order, shared_lineages, others_by_owner, trend_signals, section_trends, trend_order, bundle_files, weekly_digest, violations_all, flat_transcripts, transcript_chapters,
    )
}
SHARED_SQL = f"""{LINKS_SQL}, sh AS (SELECT signal FROM links GROUP BY signal HAVING count(DISTINCT topic) >= 2),
ln AS (SELECT signal, CASE WHEN o_custkey % 3 <> 0 THEN 'l' || CAST(o_custkey AS VARCHAR) END AS lineage, strftime(o_orderdate, '%Y-%m-%d') AS date FROM sh JOIN orders ON o_orderkey = signal)"""
ORACLE_SQL = {
    "shared_in_order": f"WITH {SHARED_SQL} SELECT * FROM ln ORDER BY coalesce(lineage, ''), date, signal LIMIT 1000",
    "shared_lineages": f"WITH {SHARED_SQL} SELECT count(*) AS signals, count(DISTINCT lineage) AS lineages FROM ln",
    "others_by_owner": f"""WITH {OWNERS_SQL}, r AS (SELECT DISTINCT signal, topic FROM links)
        SELECT topic, owner, count(*) AS n FROM r JOIN owners USING (signal) WHERE owner IS NOT NULL AND owner <> CAST(topic AS VARCHAR) GROUP BY topic, owner""",
    "trend_signals": f"""WITH {LINKS_SQL}, d AS (SELECT DISTINCT trend, CAST(signal AS VARCHAR) AS s FROM links)
        SELECT trend, CAST(count(*) AS INTEGER) AS n, md5(string_agg(s, ',' ORDER BY s)) AS digest FROM d GROUP BY trend""",
    "trend_order": "SELECT CAST(row_number() OVER (ORDER BY n_nationkey % 3, n_regionkey DESC, n_nationkey) AS INTEGER) AS \"at\", n_nationkey AS trend FROM nation",
    "bundle_files": f"""WITH {OWNERS_SQL}, l AS (SELECT owner AS topic, string_agg('- ' || claim || ' (' || raw_ref || ')', chr(10) ORDER BY signal) AS lines FROM owners JOIN signals USING (signal) WHERE basis = 'lineage' GROUP BY owner)
        SELECT topic, md5(concat_ws(chr(10), '# Topic ' || topic, '', 'Why?', '', lines)) AS digest FROM l""",
    "weekly_digest": r"""SELECT doc_id, md5(regexp_replace(trim(translate(text, '#*-' || chr(10), '    ')), '\s+', ' ', 'g')) AS digest, 'The 60-second brief|More|End' AS headings, 'one ' || source || '|two' AS watch FROM documents""",
    "violations_all": """SELECT 'no owner' AS rule, CAST(n_nationkey AS VARCHAR) AS key FROM nation WHERE n_regionkey = 4 UNION ALL SELECT 'nothing owned', '4' UNION ALL SELECT 'section of unknown topic', 's2'
        UNION ALL SELECT 'empty pattern', ' ' UNION ALL SELECT 'no regular expression', '(' UNION ALL SELECT 'registry of unknown topic', '77'""",
    "flat_transcripts": f"""WITH {SEGMENTS_SQL} SELECT episode, md5(coalesce(string_agg(text, chr(10) ORDER BY ord) FILTER (event_id % 4 <> 0), '')) AS digest FROM segments GROUP BY episode""",
    "transcript_chapters": f"""WITH {SEGMENTS_SQL}, {BLOCKS_SQL.format(source='segments')},
told AS (SELECT episode, block, start, '**Speaker ' || speaker || '** (' || CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END || '): ' || text AS line
         FROM (SELECT *, CAST(floor(start) AS BIGINT) AS s FROM blocks)),
mid AS (SELECT episode, min(block) FILTER (floor(start) >= 432000) AS at_ FROM told GROUP BY episode),
parts AS (SELECT episode, block, 1 AS kind, line FROM told UNION ALL SELECT episode, coalesce(at_, 1000000000), 0, '## Middle' FROM mid UNION ALL SELECT episode, 1000000000, 0.5, '## Past the end' FROM mid)
SELECT episode, md5(string_agg(line, chr(10) || chr(10) ORDER BY block, kind)) AS digest FROM parts GROUP BY episode""",
}
