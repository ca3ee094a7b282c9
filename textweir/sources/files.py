"""File sources and configuration: Markdown trees, CSV audits, JSON lines, TOML, and the regular expressions in them."""

from __future__ import annotations

import re
import tomllib
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweir.functions.text import front_matter
from textweir.operators.chunk import DIGEST_SOURCES

AUDIT = "loop_pct double, severity string, feed string, path_under_transcripts string"
SIGNAL = "signal_id string, raw_ref string, claim string, date string, provenance string, lineage_id string, strength string, metrics array<string>"


#: Where documents of a tree lie, by corpus, with the parts of a path from the root; the parameter of `corpus_files`.
LAYOUT = (("raw", "news/*/*.md", 3), ("raw", "transcripts/*/*.md", 3), ("briefs", "reports/*-[0-9][0-9][0-9][0-9]-*.md", 2), ("briefs", "*-[0-9][0-9][0-9][0-9]-*.md", 1), ("briefs", "reports/story-log.yaml", 2))


def corpus_files(spark: SparkSession, root: str, layout: tuple[tuple[str, str, int], ...] = LAYOUT) -> DataFrame:
    """(path, corpus, source, size, mtime, text) of the documents below a root; paths are from the root.

    The source is the folder's name, or that of a brief without its date.
    """
    found = None
    for corpus, pattern, parts in layout:
        try:
            part = spark.read.format("binaryFile").load(f"{root}/{pattern}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # a tree may lack a branch
        at = F.split("path", "/")
        stem = F.regexp_replace(F.element_at(at, -1), r"(-?\d{4}-\d{2}-\d{2}.*)?\.[a-z]+$", "")
        part = part.select(
            F.array_join(F.slice(at, -parts, parts), "/").alias("path"), F.lit(corpus).alias("corpus"), (F.element_at(at, -2) if parts == 3 else stem).alias("source"),
            F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise FileNotFoundError(f"no documents below {root}")
    return found


def parsed(files: DataFrame, digests: tuple[str, ...] = DIGEST_SOURCES) -> DataFrame:
    """Add title (else the file's stem), url and date of the front matter, the body, its first line's number and the `chunker`.

    The date is that of the file name, in a brief after its stem, else the front matter's `published` or `date`.
    """
    fields = files.withColumn("_f", front_matter(F.col("text")))
    head = F.regexp_extract("text", r"(?s)\A(---\n.*?\n---(?:\n|\z))", 1)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]+$", "")
    in_name = F.regexp_extract(F.when(F.col("corpus") == "briefs", F.regexp_replace(name, r"^\D+-(?=\d)", "")).otherwise(name), r"^(\d{4}-\d{2}-\d{2})", 1)
    given = lambda key: F.nullif(F.col("_f")[key], F.lit(""))
    date = F.coalesce(F.nullif(in_name, F.lit("")), F.left(F.coalesce(given("published"), given("date"), F.lit("")), F.lit(10)))
    return fields.select(
        *files.columns, F.coalesce(F.col("_f")["title"], stem).alias("title"), F.coalesce(given("url"), F.col("_f")["link"], F.lit("")).alias("url"), date.alias("date"),
        (F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1).alias("first_line"), F.substr("text", F.length(head) + 1).alias("body"),
        F.when(F.col("source").isin(*digests), "digest").otherwise("std").alias("chunker"),
    )


def audit_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=AUDIT)


def signals(spark: SparkSession, path: str) -> DataFrame:
    """Signals in JSON lines; references lose their `c/` prefix."""
    return spark.read.schema(SIGNAL).json(path).withColumn("raw_ref", F.regexp_replace("raw_ref", "^c/", ""))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system Spark reads it from."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def require(spark: SparkSession, *paths: str) -> None:
    """Raise FileNotFoundError naming the paths that are missing."""
    if missing := [p for p in paths if not exists(spark, p)]:
        raise FileNotFoundError(", ".join(missing))


def run_window(told: Column) -> Column:
    """A struct (start, end) of a window told as `YYYY-MM-DD to YYYY-MM-DD`."""
    return F.struct(F.trim(F.split_part(told, F.lit(" to "), F.lit(1))).alias("start"), F.trim(F.split_part(told, F.lit(" to "), F.lit(2))).alias("end"))


def load_run(spark: SparkSession, folder: str, latest: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The trends, with their window, and the signals of a run; the run has to be complete, and the latest if that is named."""
    require(spark, f"{folder}/trends.json", f"{folder}/signals.jsonl")
    if latest is not None and latest != folder.rstrip("/").rpartition("/")[2]:
        raise ValueError(f"the latest run is {latest}")
    whole = spark.read.option("multiLine", True).json(f"{folder}/trends.json")
    return whole.select(run_window(F.col("_meta.window")).alias("window"), F.explode("trends").alias("trend")).select("window", "trend.*"), signals(spark, f"{folder}/signals.jsonl")


def topics(paths: list[str]) -> dict:
    """The topics file, of which there has to be exactly one; YAML where a reader for it is installed, else JSON."""
    if len(paths) != 1:
        raise ValueError(f"need one topics file, found {len(paths)}")
    raw = Path(paths[0]).read_text()
    try:
        import yaml
    except ImportError:
        import json

        return json.loads(raw)
    return yaml.safe_load(raw)


def ledger(spark: SparkSession, path: str, bootstrap: DataFrame) -> DataFrame:
    """(key) of a ledger of one key a line; where it doesn't exist yet, the keys of what is there already."""
    if exists(spark, path):
        return spark.read.text(path).select(F.trim("value").alias("key")).where("key <> ''").distinct()
    return bootstrap.select("key").distinct()


def sidecars(json: DataFrame, schema: str) -> DataFrame:
    """Sidecar files (stem, json) parsed; a corrupt one gives null."""
    return json.select("stem", F.from_json("json", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("meta")).withColumn(
        "meta", F.when(F.col("meta._corrupt").isNull(), F.col("meta").dropFields("_corrupt"))
    )


def config(path: str) -> dict:
    """A TOML file, or nothing if there is none."""
    file = Path(path)
    return tomllib.loads(file.read_text()) if file.exists() else {}


def feed_config(settings: dict, feed: str) -> dict:
    """A feed's settings over the defaults."""
    return settings.get("defaults", {}) | settings.get("feeds", {}).get(feed, {})


def merged(defaults: Column, own: Column) -> Column:
    """Map of settings in which a feed's own win over the defaults."""
    kept = F.map_filter(defaults, lambda k, _: ~F.array_contains(F.map_keys(own), k))
    return F.map_concat(kept, own)


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's syntax: named groups are written otherwise, and classes are Unicode by default."""
    return "(?U)" + re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))
