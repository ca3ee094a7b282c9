"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Fixed patterns find the seed entities. The words beside the seeds induce
lexical patterns; a graph of patterns and instances (seeds and other
identifier-like tokens) is scored in rounds, patterns by the belief in their
instances and instances by their patterns, and instances of an identifier's
shape that trusted patterns surround are added. Seeds always stay.

Texts are read once. What is joined and grouped afterwards are spans and
context words, never texts; groups are pre-aggregated sums, and only trusted
patterns are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweir.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")

# The base patterns. The looks behind and possessive forms keep
# them linear; they match the same spans as the plain ones.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
#: A run without white space that has a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: Rounds of scoring; distinct seed values that a pattern needs; least confidence of a pattern and belief in an instance.
ROUNDS, SUPPORT, CONFIDENCE, BELIEF = 3, 5, 0.6, 0.9
#: Elements that a fold runs over at once.
FOLD = 256


def running(df: DataFrame, name: str, values: str, most: bool = False) -> DataFrame:
    """`df` with a column `name`: [0, v1, v1 + v2, ...] of an array of numbers, or with `most` their running maxima.

    The folds go over blocks, as they copy what they have so far. Arrays that
    a lambda reads are columns of their own, each used more than once, so that
    the optimizer doesn't move their making into the lambda.
    """
    join = (lambda a, x: F.greatest(a, x)) if most else (lambda a, x: a + x)
    zero = F.lit(0)
    fold = lambda start, xs: F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x))))
    v, blocks, starts = F.col(values), F.col("_blocks"), F.col("_starts")
    cuts = F.transform(F.sequence(zero, F.greatest(F.floor((F.size(v) - 1) / FOLD).cast("int"), zero)), lambda c: F.slice(v, c * FOLD + 1, FOLD))
    df = df.withColumn("_blocks", cuts)
    df = df.withColumn("_starts", fold(zero, F.transform(blocks, lambda b: F.aggregate(b, zero, join))))
    inside = F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), lambda b, s: F.slice(fold(s, b), 1, F.size(b))))
    return df.withColumn(name, F.concat(inside, F.array(F.element_at(starts, -1)))).drop("_blocks", "_starts")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    n = F.length(number)

    def weighed(i: Column) -> Column:
        d = F.substr(number, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_PARTS)
    n = F.length(digits(match))
    if kind == "card":
        return F.when(n.between(16, 19), passes_luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


#: What a text must hold for a pattern to be tried; cheap next to the pattern.
TRIGGERS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "token": lambda t: t.rlike("[0-9@]"),
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "token": TOKEN}
SPAN = "array<struct<kind:int,start:int,end:int,value:string,left:string,left2:string,right:string>>"
# Words next to a match, whole; each reads its piece of the text once.
LAST_WORD = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"
LAST_WORDS = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"
FIRST_WORD = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"


def _word(text: Column) -> Column:
    """A context word: lower case, letters and a colon only; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(text), r"[^\p{L}:\x20]", ""), F.lit(""))


def _spans(kind: str, matches: Column, pieces: Column, starts: Column) -> Column:
    """Spans of the matches of a kind with the words around them."""
    n = F.size(matches)
    beside = F.arrays_zip(matches.alias("value"), F.slice(pieces, 1, n).alias("before"), F.slice(pieces, 2, n).alias("after"), starts.alias("start"))

    def span(x: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind) if kind in KINDS else -1).alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"),
            _word(F.regexp_extract(x["before"], LAST_WORD, 1)).alias("left"),
            _word(F.regexp_extract(x["before"], LAST_WORDS, 1)).alias("left2"),
            _word(F.regexp_extract(x["after"], FIRST_WORD, 1)).alias("right"),
        )

    return F.when(n > 0, F.filter(F.transform(beside, span), lambda s: _valid(kind, s["value"]))).otherwise(F.array().cast(SPAN))


def annotate(docs: DataFrame, scratch: Scratch, *carried: str) -> DataFrame:
    """(row, carried, base, other): a row number, the carried columns as a struct, base spans and other identifier-like tokens of every row.

    A written table.
    """
    kept = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.lit(None).cast("int")
    df = docs.select(kept.alias("carried"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        tried = TRIGGERS[kind](text)
        df = df.withColumns(
            {f"m_{kind}": F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none), f"p_{kind}": F.when(tried, F.split(text, pattern, -1)).otherwise(none)}
        )
    df = df.drop("text")
    for kind in PATTERNS:
        matches, pieces = F.col(f"m_{kind}"), F.col(f"p_{kind}")
        before = F.slice(pieces, 1, F.size(matches))
        df = df.withColumn(f"g_{kind}", F.transform(before, F.length)).withColumn(f"l_{kind}", F.zip_with(f"g_{kind}", matches, lambda g, m: g + F.length(m)))
        df = running(df, f"r_{kind}", f"l_{kind}")
        df = df.withColumn(f"a_{kind}", F.zip_with(F.slice(f"r_{kind}", 1, F.size(matches)), f"g_{kind}", lambda r, g: r + g))
    df = df.withColumns({f"s_{kind}": _spans(kind, F.col(f"m_{kind}"), F.col(f"p_{kind}"), F.col(f"a_{kind}")) for kind in PATTERNS})
    df = df.select("carried", F.concat(*(F.col(f"s_{kind}") for kind in KINDS)).alias("base"), F.col("s_token").alias("tokens"))
    # A token stands apart if no base span that begins before its end ends behind its start: spans in order, with the running maximum of the base ones' ends.
    event = lambda at, side, reach, token: F.struct(at.alias("at"), F.lit(side).alias("side"), reach.alias("reach"), token.alias("token"))
    of_base = F.transform("base", lambda s: event(s["start"], 1, s["end"], F.lit(None).cast(SPAN[6:-1])))
    of_token = F.transform("tokens", lambda s: event(s["end"], 0, F.lit(0), s))
    df = df.withColumn("events", F.when((F.size("base") > 0) & (F.size("tokens") > 0), F.array_sort(F.concat(of_base, of_token))))
    df = running(df.withColumn("reaches", F.coalesce(F.transform("events", lambda e: e["reach"]), F.array().cast("array<int>"))), "most", "reaches", most=True)
    judged = F.zip_with("events", F.slice("most", 1, F.size("reaches")), lambda e, m: F.struct(e["token"].alias("token"), m.alias("most")))
    apart = F.transform(F.filter(judged, lambda j: j["token"].isNotNull() & (j["most"] <= j["token"]["start"])), lambda j: j["token"])
    df = df.select(F.monotonically_increasing_id().alias("row"), "carried", "base", F.when(F.size("base") == 0, F.col("tokens")).otherwise(F.coalesce(apart, F.array().cast(SPAN))).alias("other"))
    return scratch.keep(df, "annotated")


def _shape(value: Column) -> Column:
    """The kinds that a token could be an unseen identifier of."""
    n = F.length(digits(value))
    plain = value.rlike(r"^[^\p{L}]*$")
    dotted = F.length(F.regexp_replace(value, r"[^.:]", ""))
    return F.filter(
        F.array(
            F.when(value.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]"), F.lit(0)),
            F.when((dotted >= 3) & (n >= 4), F.lit(1)),
            F.when(plain & n.between(13, 19), F.lit(2)),
            F.when(plain & n.between(7, 15) & (dotted < 3), F.lit(3)),
        ),
        lambda k: k.isNotNull(),
    )


def discover(annotated: DataFrame, scratch: Scratch, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE, belief: float = BELIEF) -> DataFrame:
    """(row, added) for rows of `annotated` with added spans: structs of kind, start and end."""
    seeds = annotated.select("row", F.explode("base").alias("s"))
    others = annotated.select("row", F.explode("other").alias("s"))
    contexts = lambda s: F.filter(
        F.array(F.concat(F.lit("1 "), s["left"]), F.concat(F.lit("2 "), s["left2"]), F.concat(F.lit("r "), s["right"])), lambda p: p.isNotNull()
    )
    edges = seeds.select("row", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.kind").alias("seed"), F.xxhash64("s.value").alias("value"), F.array().cast("array<int>").alias("shapes"), F.explode(contexts(F.col("s"))).alias("pattern"))
    edges = edges.unionByName(
        others.select("row", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.lit(None).cast("int").alias("seed"), F.xxhash64("s.value").alias("value"), _shape(F.col("s.value")).alias("shapes"), F.explode(contexts(F.col("s"))).alias("pattern"))
    )
    # An instance is a distinct value beside a pattern: copies of a passage count once.
    edges = scratch.keep(edges, "edges")
    graph = scratch.keep(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.first("shapes").alias("shapes")), "graph")
    induced = graph.where("seed is not null").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= support)
    induced = scratch.keep(induced, "patterns")
    trusted = None
    beliefs = graph.where("seed is null").select("value", F.lit(-1).alias("kind"), F.lit(0.0).alias("belief")).limit(0)
    sizes = scratch.keep(graph.join(induced.select("pattern").distinct(), "pattern", "left_semi"), "reached")
    for k in range(rounds):
        scored = sizes.join(induced, "pattern").join(beliefs, ["value", "kind"], "left")
        weight = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0).otherwise(F.coalesce("belief", F.lit(0.0)))
        trusted = scored.groupBy("pattern", "kind").agg((F.sum(weight) / F.count(F.lit(1))).alias("confidence")).where(F.col("confidence") >= confidence)
        trusted = scratch.keep(trusted, f"trusted-{k}")
        known = sizes.where("seed is null").join(trusted, "pattern").where(F.array_contains("shapes", F.col("kind")))
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        beliefs = scratch.keep(known.groupBy("value", "kind").agg((1 - doubt).alias("belief")), f"beliefs-{k}")
    chosen = beliefs.where(F.col("belief") >= belief).groupBy("value").agg(F.min_by("kind", F.struct(-F.col("belief"), F.col("kind"))).alias("kind"))
    spans = edges.where("seed is null").join(trusted, "pattern", "left_semi").join(chosen, "value").select("row", F.struct("kind", "start", "end").alias("span")).distinct()
    return spans.groupBy("row").agg(F.collect_list("span").alias("added"))


def _found(docs: DataFrame, scratch: Scratch, *carried: str) -> DataFrame:
    """(carried, base, all) of every row, spans in order of kind and start."""
    annotated = annotate(docs, scratch, *carried)
    added = discover(annotated.select("row", "base", "other"), scratch)
    bare = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    joined = annotated.select("row", "carried", bare.alias("base")).join(added.hint("shuffle_hash"), "row", "left")
    return joined.select("carried", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added"))).alias("all"))


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data of every row: counts and digest of the base ones, and all as kind:start:end.

    Offsets are code points, ends exclusive. Null and empty texts give zeros
    and empty strings; a null id stays null; repeated rows are each scanned,
    though equal values beside equal words count once as evidence; a token
    that several kinds fit is of the kind it is believed most to be, or of the
    first as listed; texts of any length are read whole, in time about in
    proportion to it; an empty table gives no rows. Columns other than doc_id
    and text are not read.
    """
    found = _found(docs, Scratch(docs.sparkSession, "pii"), "doc_id")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("carried.doc_id", *counts, F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.col("all")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of personal data replaced by its kind in angle brackets; n_chars follows the text.

    Overlapping spans become one, of the kind that begins first (of the
    longest, if they begin together). Rows without spans, and null texts, stay
    as they are. Any column may have any name.
    """
    columns, kinds = docs.columns, dict(docs.dtypes)
    found = _found(docs, Scratch(docs.sparkSession, "redact"), *columns)
    some = F.size("all") > 0
    text = F.col("carried.text")
    by_start = F.array_sort(F.transform("all", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("order"), s["kind"].alias("kind"), s["end"].alias("end"))))
    # Four bytes a character, so that a part is cut out without counting from the text's start; x keeps a decoder from taking a first character for a mark.
    wide = F.when(some, F.encode(text, "UTF-32"))
    df = found.select("carried", by_start.alias("spans"), F.when(some, text).alias("text"), wide.alias("wide"))
    df = running(df.withColumn("ends", F.transform("spans", lambda s: s["end"])), "reach", "ends", most=True)
    part = lambda a, n: F.substr(F.decode(F.concat(F.encode(F.lit("x"), "UTF-32"), F.substr("wide", a * 4 + 1, n * 4)), "UTF-32"), F.lit(2))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def piece(s: Column, before: Column) -> Column:
        return F.when(s["start"] < before, F.lit("")).otherwise(F.concat(part(before, s["start"] - before), F.get(names, s["kind"])))

    last = F.element_at("reach", -1)
    clean = F.concat(F.array_join(F.zip_with("spans", F.slice("reach", 1, F.size("spans")), piece), ""), part(last, F.octet_length("wide") / 4 - last))
    df = df.withColumn("clean", F.when(F.size("spans") > 0, clean))
    out = []
    for c in columns:
        value = F.col("carried").getField(c)
        if c == "text":
            value = F.coalesce("clean", value)
        elif c == "n_chars":
            value = F.when(F.col("clean").isNotNull(), F.length("clean").cast(kinds[c])).otherwise(value)
        out.append(value.alias(c))
    return df.select(*out)
