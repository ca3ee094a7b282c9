"""Topic bundles: which topics a signal reaches, who owns it, and what each topic's bundle holds.

Inputs: `owns` (topic, trend), `links` (signal, trend, canonical, supporting),
`signals` (signal, claim, ...), `registry` (ord, kind, pattern, owner).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def reach(links: DataFrame, owns: DataFrame) -> DataFrame:
    """(signal, topics, canonical_in, supporting_in): sorted arrays of topics."""
    joined = links.join(owns, "trend")
    topics = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("topic"))))
    return joined.groupBy("signal").agg(topics(F.lit(True)).alias("topics"), topics(F.col("canonical")).alias("canonical_in"), topics(F.col("supporting")).alias("supporting_in"))


def registry_owner(claim: Column, registry: list[tuple[str, str, int]]) -> Column:
    """(owner, basis) of the first pattern that matches, in the registry's order; null if none does."""
    found = F.lit(None).cast("struct<owner:string,basis:string>")
    for kind, pattern, owner in reversed(registry):
        found = F.when(claim.rlike(pattern), F.struct(F.lit(str(owner)).alias("owner"), F.lit("registry" if kind == "event" else "mechanism").alias("basis"))).otherwise(found)
    return found


def owners(signals: DataFrame, reached: DataFrame, registry: list[tuple[str, str, int]]) -> DataFrame:
    """(signal, owner, basis). The registry comes first, then canonical, supporting and all topics.

    The first of these sets that has any topic decides: one topic owns the
    signal, several share it.
    """
    joined = signals.select("signal", registry_owner(F.col("claim"), registry).alias("_r")).join(reached, "signal", "left")
    decides = F.coalesce(*(F.when(F.size(c) > 0, F.col(c)) for c in ("canonical_in", "supporting_in", "topics")))
    one = F.size(decides) == 1
    names = F.array_join(F.transform(decides, lambda t: t.cast("string")), ",")
    owner = F.when(one, names).when(decides.isNotNull(), F.concat(F.lit("shared:"), names))
    basis = F.when(one, "lineage").when(decides.isNotNull(), "shared").otherwise("none")
    return joined.select("signal", F.coalesce("_r.owner", owner).alias("owner"), F.coalesce("_r.basis", basis).alias("basis"))


def shared(reached: DataFrame) -> DataFrame:
    """Signals that reach two topics or more."""
    return reached.where(F.size("topics") >= 2)


def stats(owns: DataFrame, trends: DataFrame, links: DataFrame, signals: DataFrame, floor: int, ceiling: float) -> DataFrame:
    """Per topic: trends, signals, first-party lineages against a floor, and the share of transcripts among supporting signals.

    A signal that supports several trends of a topic counts for each.
    """
    of_topic = owns.join(trends, "trend").groupBy("topic").agg(F.count(F.lit(1)).alias("owns"), F.sum("first_party").alias("first_party_lineages"))
    joined = links.join(owns, "trend")
    counts = joined.groupBy("topic").agg(F.countDistinct("signal").alias("signals"))
    supporting = joined.where("supporting").select("topic", "trend", "signal").distinct().join(signals.select("signal", "transcript"), "signal")
    share = supporting.groupBy("topic").agg(F.avg(F.col("transcript").cast("double")).alias("_share"))
    all_of = of_topic.join(counts, "topic", "left").join(share, "topic", "left")
    ratio = F.coalesce("_share", F.lit(0.0))
    return all_of.select(
        "topic", "owns", F.coalesce("signals", F.lit(0)).alias("signals"), "first_party_lineages", (F.col("first_party_lineages") < floor).alias("below_floor"),
        F.round(ratio, 3).alias("podcast_share"), (ratio > ceiling).alias("over_podcast_ceiling"),
    )


def source_pack(owned: DataFrame, articles: int, transcripts: int) -> DataFrame:
    """The strongest sources of each topic: rows (topic, raw_ref, signal, strength), strengths summed; ties go to the first signal."""
    weight = owned.groupBy("topic", "raw_ref").agg(F.sum("strength").alias("weight"), F.min("signal").alias("_first"))
    kind = F.when(F.startswith("raw_ref", F.lit("transcripts/")), "transcript").otherwise("article")
    rank = F.row_number().over(Window.partitionBy("topic", "kind").orderBy(F.desc("weight"), "_first"))
    ranked = weight.withColumn("kind", kind).withColumn("rank", rank)
    return ranked.where(F.col("rank") <= F.when(F.col("kind") == "article", articles).otherwise(transcripts)).drop("_first")


def violations(owns: DataFrame, topics: DataFrame, trends: DataFrame, sections: DataFrame | None = None, registry: list[tuple[str, str, int]] = ()) -> DataFrame:
    """(rule, key) of broken ownership rules.

    Unknown topics and trends, trends with several owners and with none,
    topics that own nothing, sections (section, topic) of unknown topics, and registry rows whose
    owner is unknown or whose pattern is empty or no regular expression.
    """
    told = lambda rule, rows, key: rows.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))
    found = [
        told("unknown topic", owns.join(topics, "topic", "left_anti"), "topic"),
        told("unknown trend", owns.join(trends, "trend", "left_anti"), "trend"),
        told("several owners", owns.groupBy("trend").count().where("count > 1"), "trend"),
        told("no owner", trends.join(owns, "trend", "left_anti"), "trend"),
        told("nothing owned", topics.join(owns, "topic", "left_anti"), "topic"),
    ]
    if sections is not None:
        found.append(told("section of unknown topic", sections.join(topics, "topic", "left_anti"), "section"))
    if registry:
        faults = [("empty pattern", pattern) for _, pattern, _ in registry if not pattern.strip()] + [("no regular expression", pattern) for _, pattern, _ in registry if not _compiles(pattern)]
        spark = owns.sparkSession
        if faults:
            found.append(spark.createDataFrame(faults, "rule string, key string"))
        rows = spark.createDataFrame([(str(owner),) for _, _, owner in registry], "topic string")
        found.append(told("registry of unknown topic", rows.join(topics.select(F.col("topic").cast("string").alias("topic")), "topic", "left_anti"), "topic"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.distinct()


def _compiles(pattern: str) -> bool:
    import re

    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def signal_ids(supporting: Column, counter: Column) -> Column:
    """The distinct signals of a trend, sorted."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(supporting, none), F.coalesce(counter, none)))


def shared_lines(reached: DataFrame, lineages: DataFrame) -> DataFrame:
    """(signal, lineage, date, topics) of the signals that several topics reach, in order of lineage and date; none counts as empty."""
    rows = shared(reached).join(lineages, "signal", "left")
    return rows.select("signal", "lineage", "date", "topics").orderBy(F.coalesce("lineage", F.lit("")), "date", "signal")


def lineage_count(lines: DataFrame) -> DataFrame:
    """How many signals are shared, and the distinct lineages among them."""
    return lines.agg(F.count(F.lit(1)).alias("signals"), F.countDistinct("lineage").alias("lineages"))


def others_by_owner(owned: DataFrame, reached: DataFrame) -> DataFrame:
    """(topic, owner, n): the owners of the signals that a topic's trends reach but it doesn't own, commonest first within a topic."""
    of_topic = reached.select("signal", F.explode("topics").alias("topic"))
    rows = of_topic.join(owned, "signal").where(F.col("owner") != F.col("topic").cast("string"))
    return rows.groupBy("topic", "owner").agg(F.count(F.lit(1)).alias("n")).orderBy("topic", F.desc("n"), "owner")


def section_trends(headings: DataFrame, trends: DataFrame) -> list[tuple[str, list[str]]]:
    """Headings (ord, heading, signals, lineages) with the trends (trend, signals, lineages) that have the same counts.

    Headings are taken in order; a trend that is the only one for a heading is
    no candidate for later ones. Runs on the driver: a report has some dozen headings.
    """
    taken: set[str] = set()
    out = []
    given = [(r["trend"], (r["signals"], r["lineages"])) for r in trends.orderBy("trend").collect()]
    for row in headings.orderBy("ord").collect():
        found = [t for t, counts in given if counts == (row["signals"], row["lineages"]) and t not in taken]
        if len(found) == 1:
            taken.add(found[0])
        out.append((row["heading"], found))
    return out


def heading_counts(heading: Column) -> Column:
    """A struct (signals, lineages) of the counts that a heading names."""
    read = lambda what: F.regexp_extract(heading, rf"(\d+) {what}", 1).try_cast("int")
    return F.struct(read("signals?").alias("signals"), read("lineages?").alias("lineages"))


def trend_summary(trends: DataFrame) -> DataFrame:
    """Trends in the order a report is prepared in: tier, then lineages, then id."""
    return trends.orderBy("tier", F.desc("lineages"), "trend")


def bundle_text(title: Column, question: Column, signals: Column) -> Column:
    """A topic's bundle as Markdown: its question, and its signals (ref, claim) in a list."""
    lines = F.transform(signals, lambda s: F.concat(F.lit("- "), s["claim"], F.lit(" ("), s["ref"], F.lit(")")))
    return F.concat_ws("\n", F.concat(F.lit("# "), title), F.lit(""), question, F.lit(""), F.array_join(lines, "\n"))


def write_bundles(bundles: DataFrame, folder: str) -> None:
    """Signals (topic, ...) as JSON lines, in a folder for each topic."""
    bundles.write.mode("overwrite").partitionBy("topic").json(folder)


def watch_list(report: Column) -> Column:
    """The items of a report's watch list: the lines of the section below its heading."""
    section = F.regexp_extract(report, r"(?is)(?:\A|\n)##+ [^\n]*watch list[^\n]*\n(.*?)(?:\n#|\z)", 1)
    return F.transform(F.filter(F.split(section, "\n"), lambda x: x.rlike(r"^\s*[-*] ")), lambda x: F.trim(F.regexp_replace(x, r"^\s*[-*] ", "")))


def digest(weekly: Column) -> Column:
    """A struct of a weekly brief's short block and its headings."""
    brief = F.trim(F.regexp_extract(weekly, r"(?is)(?:\A|\n)## [^\n]*60[- ]second[^\n]*\n(.*?)(?:\n## |\z)", 1))
    return F.struct(brief.alias("brief"), F.regexp_extract_all(weekly, F.lit(r"(?m)^## (.*)$"), F.lit(1)).alias("headings"))
