"""Literal cases of the scalar functions."""

import sqlite3

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textweir.functions import dates, media, text, urls
from textweir.operators import search, segments
from textweir.operators.chunk import chunks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("stamp, seconds", [("14:08", 848.0), ("1:23:45", 5025.0), ("soon", 0.0), ("1:2:3:4", 0.0)])
def test_stamp(spark, stamp, seconds):
    assert one(spark, media.stamp_seconds(F.lit(stamp))) == seconds


def test_times(spark):
    assert one(spark, media.duration(F.lit(65))) == "1:05"
    assert one(spark, media.timestamp(F.lit(65))) == "01:05"
    assert one(spark, media.duration(F.lit(0))) == "--:--"
    assert one(spark, media.timestamp(F.lit(3725))) == "1:02:05"


@pytest.mark.parametrize("label, letter", [("SPEAKER_00", "A"), ("SPEAKER_26", "SPEAKER_26"), ("", "?"), ("guest", "guest")])
def test_speaker(spark, label, letter):
    assert one(spark, media.speaker_label(F.lit(label))) == letter


@pytest.mark.parametrize("url, slug", [("https://x/2606.19195", "2606-19195"), ("https://x/foo.md", "foo"), ("https://x/a/b?q=1#t", "b")])
def test_slug(spark, url, slug):
    assert one(spark, urls.slug(F.lit(url))) == slug


def test_keys(spark):
    full = lambda u: one(spark, urls.full_key(F.lit(u)))
    assert full("http://x/a") == full("https://x/a") == full("https://www.x/a/") == "x/a"
    assert (full("https://x/?p=1"), full("https://x/?p=2")) == ("x?p=1", "x?p=2")
    slug = lambda u: one(spark, urls.slug_key(F.lit(u)))
    assert slug("https://x/blog/b/") == slug("https://x/b") == "x|b"


@pytest.mark.parametrize("raw, day", [("Aug 25, 2026", "2026-08-25"), ("2026-08-25T10:00", "2026-08-25"), ("on August. 5 2024", "2024-08-05"), ("Foo 1, 2024", ""), ("Feb 31, 2024", ""), ("", "")])
def test_loose_date(spark, raw, day):
    assert one(spark, dates.loose_date(F.lit(raw))) == day


@pytest.mark.parametrize("slug, day", [("news260424", "2026-04-24"), ("news1226", "2024-12-26"), ("news261924", ""), ("old", "")])
def test_slug_date(spark, slug, day):
    assert one(spark, dates.slug_date(F.lit(slug), r"^news(\d{2})?(\d{2})(\d{2})$", 1, 2, 3, "2024")) == day


@pytest.mark.parametrize("spec, days", [("1y", 365), ("6m", 180), ("2w", 14), ("14d", 14)])
def test_since(spark, spec, days):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert one(spark, F.date_diff(now, dates.since_cutoff(spec, now))) == days


def test_since_rejects(spark):
    with pytest.raises(ValueError):
        dates.since_cutoff("soon", F.lit(None))


def test_prior_run(spark):
    assert one(spark, dates.prior_run(F.lit("2026-01"))) == "2025-12"


@pytest.mark.parametrize("given_text, body", [("A. A. B.", "A. A. B."), ("A. a.  A. B.", "A. B."), ("A. A. A? B.", "A. A. A? B."), ("", "")])
def test_collapse(spark, given_text, body):
    docs = spark.createDataFrame([(1, given_text)], "id int, text string")
    assert text.collapse_runs(docs, "id").first()["body"] == body


def test_front_matter(spark):
    doc = '---\ntitle: "A: b"\nurl: https://x/y\n---\nbody'
    assert one(spark, text.front_matter(F.lit(doc))) == {"title": "A: b", "url": "https://x/y"}
    assert one(spark, text.front_matter(F.lit("no fence"))) == {}


def test_query_compile():
    assert search.compile_query('"20 GW"') == search.Query((("20", "gw"),), "and")
    assert search.compile_query('a "b c" dd') == search.Query((("b", "c"), ("dd",)), "or")
    assert search.compile_query("gpt-4.1").phrases == (("gpt", "4", "1"),)
    assert not search.compile_query("$ %").phrases


def test_blind():
    search.check_blind(("raw", "briefs"), frozen=True, blind=True)
    with pytest.raises(PermissionError):
        search.check_blind(("raw", "briefs"), frozen=False, blind=True)


@pytest.mark.parametrize("glob, path, hit", [("a/*", "a/b/c", True), ("a/?", "a/bc", False), ("a/[!x]", "a/x", False), ("a/[!x]", "a/y", True), ("a.b/*", "aXb/c", False)])
def test_glob(spark, glob, path, hit):
    assert one(spark, F.lit(path).rlike(search.glob_pattern(glob))) is hit


words = st.lists(st.lists(st.sampled_from(["a", "bb", "**c"]), max_size=600).map(" ".join), max_size=8).map("\n".join)


@settings(max_examples=60, deadline=None)
@given(words, st.booleans())
def test_chunks_cover(body, digest):
    made = chunks(body, digest)
    budget, overlap = (200, 0) if digest else (450, 50)
    assert all(0 < len(t.split()) <= budget + overlap and a <= b for a, b, t in made)
    if digest:
        assert " ".join(t for _, _, t in made).split() == body.split()
    assert (made == []) == (not body.split())


def test_bm25_is_fts5(spark, tmp_path):
    docs = ["the cat sat on the mat", "the dog ate the cat food", "a cat and a dog and a cat", "nothing here", "mat " * 7]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE t USING fts5(x)")
    db.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", enumerate(docs))
    query = 'cat mat "the dog"'
    want = dict(db.execute("SELECT rowid, bm25(t) FROM t WHERE t MATCH ?", ('"the dog" OR "cat" OR "mat"',)))
    chunks = spark.createDataFrame([(i, i, 0, 1, 1, t) for i, t in enumerate(docs)], "chunk_id long, doc_id long, ord int, start_line int, end_line int, text string")
    attrs = chunks.selectExpr("chunk_id", "doc_id", "text as path", "'raw' as corpus", "'s' as source", "'' as date", "'1-1' as lines")
    empty = segments.Index(spark, str(tmp_path), 0, ())
    index = segments.publish(empty, [segments.written(empty, "a", 0, {"chunks": chunks, "attributes": attrs})])
    got = {r["chunk_id"]: r["bm25"] for r in segments.keyword_rank(index, search.compile_query(query)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_pins_replace_the_tail(spark):
    rows = [(i, f"p{i}", "", "s", "1-1", None, i, 1 / (61 + i), "vector") for i in range(10)]
    rows += [(90 + i, f"k{i}", "", "s", "1-1", i + 50, None, 0.5 / (111 + i), "keyword") for i in range(3)]
    fused = spark.createDataFrame(rows, "chunk_id long, path string, date string, source string, lines string, kw_rank int, vec_rank int, score double, via string")
    got = [r["path"] for r in search.assemble(fused).orderBy("pos").collect()]
    assert got == [f"p{i}" for i in range(7)] + ["k0", "k1", "k2"]
    assert search.assemble(fused, k=1).count() == 3


def test_until_done():
    from textweir.operators.runs import check_severities, each_apart, effective_limit, until_done

    left = [3]

    def step():
        left[0] -= 1

    assert until_done(step, lambda: left[0]) == 3
    with pytest.raises(RuntimeError):
        until_done(lambda: None, lambda: 1)

    def run(source):
        if source == "b":
            raise OSError("gone")
        return len(source)

    assert each_apart(["a", "b", "cc"], run) == {"a": 1, "b": "OSError: gone", "cc": 2}
    assert effective_limit(None, 0, 5) == 0 and effective_limit(None, None, 5) == 5
    with pytest.raises(ValueError):
        check_severities(["mild", "odd"])


def test_zero_limits(spark):
    from textweir.operators.runs import limited

    rows = spark.range(5)
    assert [limited(rows, 0).count(), limited(rows, 0, zero_is_all=False).count(), limited(rows, None).count(), limited(rows, 2).count()] == [5, 0, 5, 2]


def test_diacritics_fold(spark):
    from pyspark.sql import functions as F

    from textweir.operators.search import compile_query, tokens

    row = spark.createDataFrame([("Crème BRÛLÉE, naïve café ø straße 108×",)], "t string").select(tokens(F.col("t")).alias("t")).first()
    assert row["t"] == ["creme", "brulee", "naive", "cafe", "ø", "straße", "108"]
    assert compile_query("Crème cafés").phrases == (("creme",), ("cafes",))


def test_section_trends_take_turns(spark):
    """A heading's only trend is no candidate for later headings; several candidates stay open to all."""
    from textweir.operators.bundles import heading_counts, section_trends

    heads = spark.createDataFrame([(1, "A: 2 signals, 1 lineage"), (2, "B: 2 signals, 1 lineage"), (3, "C: 3 signals, 3 lineages"), (4, "D: none")], "ord int, heading string")
    counts = heading_counts(F.col("heading"))
    trends = spark.createDataFrame([("t1", 2, 1), ("t2", 3, 3), ("t3", 3, 3)], "trend string, signals int, lineages int")
    found = section_trends(heads.select("ord", "heading", counts["signals"].alias("signals"), counts["lineages"].alias("lineages")), trends)
    assert [t for _, t in found] == [["t1"], [], ["t2", "t3"], []]


def test_two_chunks_of_a_document_at_most(spark, sf):
    """The per-document search against scores and ranks worked out over the chunks in Python."""
    import math
    import re
    from collections import Counter

    from textweir.operators.search import KW_WEIGHT, POOL, RRF_K
    from textweir.plans import search_queries as Q
    from textweir.plans.corpus import corpus, table

    docs = {r["doc_id"]: r for r in corpus(spark, sf).collect()}
    parts = {d * Q.CHUNKS_OF_ONE + k: (d, words) for d, r in docs.items() for k, (_, _, words) in enumerate(chunks(r["text"]))}
    terms = {c: re.findall(r"[^\W_]+", search.folded(words)) for c, (_, words) in parts.items()}
    phrases = search.compile_query(Q.HYBRID).phrases
    times = {c: [sum(tuple(t[i : i + len(p)]) == p for i in range(len(t))) for p in phrases] for c, t in terms.items()}
    mean, n = sum(map(len, terms.values())) / len(terms), len(terms)
    df = [sum(f[i] > 0 for f in times.values()) for i in range(len(phrases))]
    idf = [max(math.log((n - d + 0.5) / (d + 0.5)), 1e-6) for d in df]
    score = {c: round(sum(w * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(terms[c]) / mean)) for w, f in zip(idf, fs, strict=True)), 6) for c, fs in times.items() if any(fs)}
    keyword = {c: k for k, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:POOL])}
    vectors = {r["vec_id"]: list(r["embedding"]) for r in table(spark, sf, "embeddings").collect()}
    like = {v * Q.CHUNKS_OF_ONE: round(sum(x * y for x, y in zip(e, vectors[Q.QUERY_VECTOR], strict=True)), 6) for v, e in vectors.items() if v * Q.CHUNKS_OF_ONE in parts}
    vector = {c: k for k, c in enumerate(sorted(like, key=lambda c: (-like[c], c))[:POOL])}
    fused = {c: (KW_WEIGHT / (RRF_K + 1 + keyword[c]) if c in keyword else 0) + (1 / (RRF_K + 1 + vector[c]) if c in vector else 0) for c in keyword | vector}
    ordered = sorted(fused, key=lambda c: (-fused[c], keyword.get(c, 1e9), vector.get(c, 1e9)))
    held, placed = Counter(), []
    for c in ordered:
        held[parts[c][0]] += 1
        if held[parts[c][0]] <= 2 and len(placed) < 10:
            placed.append(c)
    first = list(dict.fromkeys(parts[c][0] for c in keyword))[:3]
    best = [min((c for c in keyword if parts[c][0] == d), key=keyword.get) for d in first]
    missing = [c for c in best if parts[c][0] not in {parts[x][0] for x in placed}]
    want = placed[: 10 - len(missing)] + missing
    assert [r["chunk_id"] for r in Q.hybrid_search_per_doc(spark, sf).orderBy("pos").collect()] == want
