"""Text scalars: repetition, cleaning, escaping, sections.

Arrays are passed to higher-order functions as arguments, never captured by
their lambdas: a captured expression would be worked out for every element.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# N-gram size, least count and warning share of the loop score; run length that collapses; length limits.
GRAM, GRAM_TIMES, LOOP_SHARE, RUN = 8, 3, 0.08, 3
PAPER_LIMIT, STEM_LIMIT = 40_000, 120


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    """Unicode NFC, for which Spark has no function."""
    import unicodedata

    return values.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


@F.pandas_udf(T.StringType())
def unescape(values: pd.Series) -> pd.Series:
    """HTML character references decoded, for which Spark has no function."""
    from html import unescape as decode

    return values.map(lambda s: None if s is None else decode(s))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def safe_filename(name: Column) -> Column:
    """A file name without reserved and control characters, of at most 120 characters (compose it with `nfc`)."""
    plain = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', ""), r"\s+", " ")
    return F.rtrim(F.left(F.trim(plain), F.lit(STEM_LIMIT)))


def _flags(true_at: Column) -> Column:
    """An element is set if one of the triples it can be in is: triples are flagged where they begin."""
    one = F.array(F.lit(False))
    two = F.concat(one, one)
    return F.zip_with(F.zip_with(F.concat(true_at, two), F.concat(one, true_at, one), lambda a, b: a | b), F.concat(two, true_at), lambda a, b: a | b)


def _without(xs: Column, head: int, n: Column) -> Column:
    """The array from element `head` on, `n` elements, or none."""
    return F.slice(xs, head + 1, F.greatest(n, F.lit(0)))


def repetition(docs: DataFrame, *carried: str) -> DataFrame:
    """The carried columns and `fraction`: the share of words in 8-grams that occur three times or more.

    The last 8-gram is left out and the sum is divided by the words, as the
    score defines it. No shuffle: a document's grams are hashed, sorted and
    compared with their second next. Each step is a column of its own, so
    that none is worked out twice.
    """
    words = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: F.xxhash64(w))
    df = docs.select(*carried, words.alias("_g"))
    df = df.withColumn("_words", F.size("_g"))
    for step in (1, 2, 4):
        n = F.size("_g") - step
        df = df.withColumn("_g", F.zip_with(_without(F.col("_g"), 0, n), _without(F.col("_g"), step, n), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_g", F.array_sort(_without(F.col("_g"), 0, F.size("_g") - 1)))
    n = F.size("_g") - 2
    triple = F.zip_with(_without(F.col("_g"), 0, n), _without(F.col("_g"), 2, n), lambda a, b: a == b)
    # The row number keeps a filter on the score from being pushed below, where it would repeat all steps.
    df = df.withColumns({"_t": triple, "_row": F.monotonically_increasing_id()})
    looped = F.when(F.size("_t") > 0, F.size(F.filter(_flags(F.col("_t")), lambda x: x))).otherwise(0)
    return df.select(*carried, F.when((F.col("_words") > GRAM) & (F.col("_row") >= 0), F.round(looped / F.col("_words"), 6)).otherwise(0.0).alias("fraction"))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+", -1)


def collapse_runs(docs: DataFrame, *carried: str) -> DataFrame:
    """The carried columns and `body`: the text in which three or more equal sentences in a row are one.

    Case and white space don't count; the sentences are joined by a blank.
    """
    parts = F.col("_parts")
    df = docs.select(*carried, sentences(F.col("text")).alias("_parts"))
    df = df.withColumn("_plain", F.transform(parts, lambda s: F.regexp_replace(F.trim(F.lower(s)), r"\s+", " ")))
    n = F.size(parts)
    df = df.withColumn("_same", F.zip_with(_without(F.col("_plain"), 0, n - 1), _without(F.col("_plain"), 1, n - 1), lambda a, b: a == b))
    df = df.withColumn("_triple", F.zip_with(_without(F.col("_same"), 0, n - 2), _without(F.col("_same"), 1, n - 2), lambda a, b: a & b))
    gone = F.zip_with(_flags(F.col("_triple")), F.concat(F.array(F.lit(False)), F.col("_same")), lambda a, b: a & b)
    kept = F.filter(F.zip_with(parts, gone, lambda s, g: F.when(~g, s)), lambda s: s.isNotNull())
    return df.select(*carried, F.when(n < RUN, F.array_join(parts, " ")).otherwise(F.array_join(kept, " ")).alias("body"))


def strip_after(body: Column, marker: str) -> Column:
    """The body up to the first match of a pattern, whatever its case."""
    return F.rtrim(F.regexp_replace(body, f"(?is){marker}.*$", ""), F.lit(" \n\t"))


def strip_secret_lines(body: Column, secret: str) -> Column:
    """The body without the lines that hold the secret; three or more line breaks become two."""
    kept = F.array_join(F.filter(F.split(body, "\n", -1), lambda line: ~F.contains(line, F.lit(secret))), "\n")
    return F.regexp_replace(kept, r"\n{3,}", "\n\n")


# What the headings of a paper's last sections open with.
ENDINGS = ("references", "bibliography", "acknowledg")


def trim_references(body: Column, limit: int = PAPER_LIMIT) -> Column:
    """A paper's body up to a heading that opens with one of `ENDINGS`, cut at the limit: a struct of body and truncated. One without such a heading stays as it is."""
    heading = rf"(?i)\n#+\s*(?:{'|'.join(ENDINGS)})"
    cut = F.when(body.rlike(heading), F.rtrim(F.regexp_replace(body, f"(?s){heading}.*$", ""), F.lit(" \r\n\t"))).otherwise(body)
    return F.struct(F.left(cut, F.lit(limit)).alias("body"), (F.length(cut) > limit).alias("truncated"))


def yaml_escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def article_path(root: str, source: Column, date: Column, slug: Column) -> Column:
    """Where an article goes: a folder for its source, a file for its date and slug."""
    return F.concat(F.lit(f"{root.rstrip('/')}/"), source, F.lit("/"), date, F.lit(" - "), slug, F.lit(".md"))


def markdown_article(title: Column, url: Column, source: Column, published: Column, tags: Column, body: Column, backfilled: Column | None = None) -> Column:
    """An article with its front matter; the title is repeated unless the body opens with a heading. Backfilled ones have a tag more."""
    if backfilled is not None:
        tags = F.when(backfilled, F.array_append(tags, F.lit("backfilled"))).otherwise(tags)
    lines = [
        F.lit("---"), F.concat(F.lit('title: "'), yaml_escape(title), F.lit('"')), F.lit("type: article"), F.concat(F.lit("source: "), source),
        F.concat(F.lit("url: "), url), F.concat(F.lit("published: "), published), F.concat(F.lit("tags: ["), F.array_join(tags, ", "), F.lit("]")), F.lit("---"), F.lit(""),
        F.when(F.ltrim(body).startswith("# "), F.lit(None)).otherwise(F.concat(F.lit("# "), title, F.lit("\n"))), body,
    ]
    return F.concat_ws("\n", *lines)


def front_matter(text: Column) -> Column:
    """The keys of a document's front matter as a map; empty without one."""
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    lines = F.filter(F.split(block, "\n"), lambda line: line.rlike(r"^[A-Za-z_][A-Za-z0-9_-]*:"))
    pairs = F.transform(lines, lambda line: F.struct(F.trim(F.regexp_extract(line, "^([^:]+):", 1)).alias("key"), F.regexp_replace(F.trim(F.regexp_extract(line, "^[^:]+:(.*)$", 1)), '^"(.*)"$', "$1").alias("value")))
    return F.map_from_entries(pairs)


def sections(text: Column, level: str = "##") -> Column:
    """Titles of the headings of a level."""
    return F.regexp_extract_all(text, F.lit(rf"(?m)^{level} (.*)$"), F.lit(1))


def section_bodies(text: Column, level: str = "##") -> Column:
    """(title, body) of the sections of a level: the trimmed text up to the next heading of that level or a higher one."""
    deep = len(level)
    broken = F.regexp_replace(F.concat(F.lit("\n"), text), rf"\n(#{{1,{deep}}}) ", "\x01$1 ")
    own = F.filter(F.split(broken, "\x01"), lambda part: F.startswith(part, F.lit(f"{level} ")))
    title = lambda part: F.trim(F.substr(F.split_part(part, F.lit("\n"), F.lit(1)), F.lit(deep + 2)))
    body = lambda part: F.btrim(F.regexp_replace(part, r"\A[^\n]*", ""), F.lit(" \n\t"))
    return F.transform(own, lambda part: F.struct(title(part).alias("title"), body(part).alias("body")))


def simple_front_matter(text: Column) -> Column:
    """(fields, body) of a document whose front matter may hold lists: fields map keys to arrays of values.

    A key's value follows its colon, or stands in `- ` lines below it. Without
    a fence there are no fields and the body is the whole text.
    """
    fence = r"(?s)\A---\n(.*?)\n---(?:\n|\z)"
    block = F.regexp_extract(text, fence, 1)
    # A key with its list is one line: list items are drawn up to the key.
    flat = F.split(F.regexp_replace(block, r"\n\s+-\s+|\n-\s+", "\x01"), "\n")
    keyed = F.filter(flat, lambda line: line.rlike(r"^[A-Za-z_][A-Za-z0-9_-]*:"))
    plain = lambda v: F.regexp_replace(F.trim(v), "^([\"'])(.*)\\1$", "$2")
    values = lambda line: F.filter(F.transform(F.split(F.regexp_replace(line, "^[^:]*:", ""), "\x01"), plain), lambda v: v != "")
    fields = F.map_from_entries(F.transform(keyed, lambda line: F.struct(F.regexp_extract(line, "^([^:]+):", 1).alias("key"), values(line).alias("value"))))
    body = F.when(text.rlike(fence), F.regexp_replace(text, fence, "")).otherwise(text)
    return F.struct(fields.alias("fields"), body.alias("body"))


def plain_text(html: Column, least: int = 500) -> Column:
    """The text of a page without scripts, styles and tags; null if it has fewer than `least` characters. Compose it with `unescape`."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|header|aside)\b[^>]*>.*?</\1>", " ")
    lined = F.regexp_replace(bare, r"(?i)</(?:p|div|h[1-6]|li|tr)>|<br\s*/?>", "\n")
    text = F.regexp_replace(F.regexp_replace(strip_tags(lined), r"[ \t\r\f]+", " "), r" ?\n[ \n]*", "\n")
    trimmed = F.btrim(text, F.lit(" \n"))
    return F.when(F.length(trimmed) >= least, trimmed)
