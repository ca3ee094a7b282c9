"""File, feed and listing sources on literal bodies."""

import pytest
from pyspark.sql import functions as F

from textweir.functions import text
from textweir.operators import ledger, render, speech
from textweir.sources import files, listings


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_corpus_files(spark, tmp_path):
    texts = {
        "news/site/2024-05-01 - a.md": '---\ntitle: "A"\nurl: https://x/a\n---\nbody\nmore',
        "transcripts/show/b.md": "plain",
        "reports/the-brief-2024-06-07.md": "---\npublished: 2024-01-01\n---\nx",
        "old-brief-2023-01-02.md": "y",
        "reports/story-log.yaml": "- z",
        "news/site/c.md": '---\ntitle: C\npublished: ""\ndate: 2024-02-03T10:00\nlink: https://x/c\n---\n',
    }
    for path, text in texts.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    found = files.parsed(files.corpus_files(spark, str(tmp_path)))
    got = rows(found.select("path", "corpus", "source", "title", "url", "date", "first_line", "body"), "path")
    assert got == [
        ("news/site/2024-05-01 - a.md", "raw", "site", "A", "https://x/a", "2024-05-01", 5, "body\nmore"),
        ("news/site/c.md", "raw", "site", "C", "https://x/c", "2024-02-03", 7, ""),
        ("old-brief-2023-01-02.md", "briefs", "old-brief", "old-brief-2023-01-02", "", "2023-01-02", 1, "y"),
        ("reports/story-log.yaml", "briefs", "story-log", "story-log", "", "", 1, "- z"),
        ("reports/the-brief-2024-06-07.md", "briefs", "the-brief", "the-brief-2024-06-07", "", "2024-06-07", 4, "x"),
        ("transcripts/show/b.md", "raw", "show", "b", "", "", 1, "plain"),
    ]
    assert {r["chunker"] for r in found.collect()} == {"std"} and files.parsed(files.corpus_files(spark, str(tmp_path)), ("site",)).where("chunker = 'digest'").count() == 2
    with pytest.raises(FileNotFoundError):
        files.corpus_files(spark, str(tmp_path / "none"))


def test_feed(spark):
    item = "<item><title><![CDATA[T & U]]></title><link>https://x/a#top</link><pubDate>Wed, 01 May 2024 23:30:00 -0200</pubDate></item>"
    feeds = spark.createDataFrame([("f", f"<rss>{item}<item><title>no link</title></item><item><link>https://x/b</link></item></rss>")], "feed string, xml string")
    assert rows(listings.feed_entries(feeds), "url") == [("f", "https://x/a", "T & U", "2024-05-02"), ("f", "https://x/b", "", "")]
    assert [r[1] for r in rows(listings.feed_entries(feeds, "2024-06-01"), "url")] == ["https://x/b"]


def test_sitemap(spark):
    body = "<urlset><url><loc>x.com/blog/a</loc></url><url><loc>/blog/b</loc><lastmod>2024-01-01</lastmod></url><url><loc>https://x.com/blog/</loc></url><url><loc>https://x.com/about</loc></url></urlset>"
    maps = spark.createDataFrame([("https://x.com", body), ("https://x.com", "<sitemapindex><sitemap><loc> https://x.com/s1.xml</loc></sitemap></sitemapindex>")], "site string, xml string")
    assert [r[1] for r in rows(listings.urlset_rows(maps, include="/blog"), "url")] == ["https://x.com/blog/a", "https://x.com/blog/b"]
    assert [r[1] for r in rows(listings.urlset_rows(maps, include="/blog", since="2024-02-01"), "url")] == ["https://x.com/blog/a"]
    assert rows(listings.sitemap_index(maps), "sitemap") == [("https://x.com", "https://x.com/s1.xml")]


def test_config(tmp_path):
    path = tmp_path / "feeds.toml"
    path.write_text("[defaults]\nlimit = 5\norder = 'newest'\n[feeds.a]\nlimit = 2\n")
    settings = files.config(str(path))
    assert files.feed_config(settings, "a") == {"limit": 2, "order": "newest"} and files.feed_config(settings, "b")["limit"] == 5
    assert files.config(str(tmp_path / "none.toml")) == {}


def test_audit_and_signals(spark, tmp_path):
    (tmp_path / "a.csv").write_text("loop_pct,severity,feed,path_under_transcripts\n12.5,severe,f,f/a.md\n")
    (tmp_path / "s.jsonl").write_text('{"signal_id": "s1", "raw_ref": "c/news/x.md", "metrics": ["1"]}\n')
    assert rows(files.audit_rows(spark, str(tmp_path / "a.csv")), "feed") == [(12.5, "severe", "f", "f/a.md")]
    assert files.signals(spark, str(tmp_path / "s.jsonl")).first()["raw_ref"] == "news/x.md"


def test_java_pattern(spark):
    pattern = files.java_pattern(r"(?P<y>\w+)-(?P=y)")
    assert spark.range(1).select(F.regexp_extract(F.lit("Éa-Éa"), pattern, 1).alias("x")).first()["x"] == "Éa"


def test_papers(spark):
    bodies = spark.createDataFrame([('{"paper": {"id": "1", "authors": [{"name": "A"}, {"name": ""}], "upvotes": 3}}',), ('{"id": "2", "title": "t"}',), ("broken",)], "json string")
    found = listings.papers(bodies)
    assert rows(found.select("id", "title", "authors", "upvotes"), "id") == [("", "", [], 0), ("1", "", ["A"], 3), ("2", "t", [], 0)]
    assert list(found.where("id = '2'").select(*found.columns[4:]).first()) == ["", "", [], "", "", "", "", "", ""]


def test_papers_are_discovered_from_their_json(spark):
    json = ['{"paper": {"id": "1", "upvotes": 3, "publishedAt": "2024-01-05", "submittedOnDailyAt": "2024-01-09"}, "title": "outer"}', '{"id": "2", "title": "t", "upvotes": 9, "publishedAt": "2024-01-01"}', '{"upvotes": 99}', None]
    bodies = spark.createDataFrame([(x,) for x in json], "json string")
    assert rows(listings.discover("papers", bodies), "url") == [("papers", "papers/1", "2024-01-05", ""), ("papers", "papers/2", "2024-01-01", "t")]
    assert [r["url"] for r in listings.discover("papers", bodies, since="2024-01-06").collect()] == ["papers/1"]
    assert listings.papers(bodies.limit(0)).count() == 0


def test_inline_entries(spark):
    atom = '<feed><entry><id>https://x/1#top</id><content type="html">&lt;p&gt;a&lt;/p&gt;</content></entry><entry><id>urn:2</id><link href="https://x/2"/><summary>b</summary><updated>2024-05-01T00:00:00Z</updated></entry><entry><id>https://x/3</id></entry></feed>'
    rss = '<rss xmlns:dc="d"><channel><item><link>https://x/4#c</link><description>c</description><dc:creator>D</dc:creator><pubDate>Wed, 01 May 2024 23:30:00 -0200</pubDate></item></channel></rss>'
    feeds = spark.createDataFrame([("https://f/k/", atom), ("https://f/r", rss)], "feed string, xml string")
    got = rows(listings.inline_entries(feeds).select("url", "html", "secret", "author", "published"), "url")
    assert got == [("https://x/1", "<p>a</p>", "k", "", ""), ("https://x/2", "b", "k", "", "2024-05-01"), ("https://x/4", "c", "r", "D", "2024-05-02")]
    assert [r[1] for r in rows(listings.discover("rss_inline", feeds, since="2024-05-02"), "url")] == ["https://x/1", "https://x/4"]


def test_sitemap_pages(spark):
    bodies = spark.createDataFrame([("https://x.com", "<sitemapindex><sitemap><loc>https://x.com/a.xml</loc></sitemap><sitemap><loc>https://x.com/b.xml</loc></sitemap></sitemapindex>"), ("https://y.com", None)], "site string, xml string")

    def fetch(url):
        return {"https://x.com/a.xml": "<urlset><url><loc>/1</loc></url></urlset>"}[url]

    assert rows(listings.discover("sitemap", bodies, fetch=fetch), "url") == [("https://x.com", "https://x.com/1", "", "")]
    assert listings.discover("sitemap", bodies, fetch=fetch, parts="/b").count() == 0
    with pytest.raises(Exception, match="fetch its sitemaps"):
        listings.discover("sitemap", bodies).collect()


def test_headings_that_tell_no_date(spark):
    html = "<h2>About</h2><a href='/1'>a</a><h2>May 2024</h2><a href='/2'>b</a><h2>x</h2><a href='/3'>c</a><h2>June 2, 2024</h2><a href='/4'>d</a>"
    pages = spark.createDataFrame([("l", "https://x", html), ("m", "https://x", None), ("n", "https://x", "")], "listing string, url string, html string")
    got = listings.dated_items(pages, ("<a href='([^']+)'>(.*?)</a>",), "<h2>(.*?)</h2>")
    assert [r["date"] for r in got.orderBy("link").collect()] == ["", "2024-05", "2024-05", "2024-06-02"]
    assert {r["date"] for r in listings.dated_items(pages, ("<a href='([^']+)'>(.*?)</a>",)).collect()} == {""}


def test_trim_references(spark):
    bodies = ["a \n## Acknowledging\nb", "a\n# references1", "a\nreferences ", None]
    cut = text.trim_references(F.col("b"))
    found = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, b string").orderBy("k").select(cut["body"].alias("body"))
    assert [r["body"] for r in found.collect()] == ["a", "a", "a\nreferences ", None]


def test_headings_above(spark):
    cards = spark.createDataFrame([("p", 5, "c1"), ("p", 25, "c2"), ("q", 5, "c3")], "page string, at int, card string")
    heads = spark.createDataFrame([("p", 10, "May"), ("p", 20, "June")], "page string, at int, month string")
    assert rows(speech.headings_above(cards, heads, "page", "at", "month").select("card", "month"), "card") == [("c1", None), ("c2", "June"), ("c3", None)]


def test_first_seen_and_append(spark):
    items = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, n int")
    assert rows(ledger.first_seen(items, "k", "n"), "k") == [("a", 1), ("b", 3)]
    assert rows(render.append_new(items, items.where("k = 'a'"), "k"), "k") == [("b", 3)]


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        listings.discover("carrier pigeon", spark.range(1))


def test_malformed_feed(spark):
    feeds = spark.createDataFrame([("f", "<rss><channel><item>"), ("g", ""), ("h", None)], "feed string, xml string")
    assert listings.feed_entries(feeds).count() == 0 and listings.inline_entries(feeds).count() == 0


def test_runs_need_their_files(spark, tmp_path):
    run = tmp_path / "2024-05"
    run.mkdir()
    with pytest.raises(FileNotFoundError):
        files.load_run(spark, str(run))
    (run / "trends.json").write_text('{"_meta": {"window": "2024-05-01 to 2024-05-31"}, "trends": [{"trend_id": "t1", "tier": 1}, {"trend_id": "t2", "tier": 2}]}')
    (run / "signals.jsonl").write_text('{"signal_id": "s1", "raw_ref": "c/news/a.md"}\n')
    trends, signals = files.load_run(spark, str(run), "2024-05")
    assert [(r["window"]["start"], r["trend_id"]) for r in trends.orderBy("trend_id").collect()] == [("2024-05-01", "t1"), ("2024-05-01", "t2")]
    assert signals.first()["raw_ref"] == "news/a.md"
    with pytest.raises(ValueError):
        files.load_run(spark, str(run), "2024-06")


def test_ledger_starts_from_files(spark, tmp_path):
    there = spark.createDataFrame([("a",), ("b",)], "key string")
    path = str(tmp_path / "ledger")
    assert sorted(r["key"] for r in files.ledger(spark, path, there).collect()) == ["a", "b"]
    (tmp_path / "ledger").write_text("x\n\nx\ny \n")
    assert sorted(r["key"] for r in files.ledger(spark, path, there).collect()) == ["x", "y"]


def test_topics_file(tmp_path):
    one = tmp_path / "topics.json"
    one.write_text('{"topics": [{"id": 1}]}')
    assert files.topics([str(one)])["topics"] == [{"id": 1}]
    with pytest.raises(ValueError):
        files.topics([])


def test_speech_providers(spark):
    from textweir.sources import providers

    audio = spark.createDataFrame([(7, "/x.mp3")], "episode long, path string")
    assert [tuple(r) for r in providers.transcribed(audio, lambda path: [(0.0, 1.5, path)]).collect()] == [(7, 1, 0.0, 1.5, "/x.mp3")]
    assert [tuple(r) for r in providers.diarized(audio, lambda path: [(0.0, 2.0, "S1")]).collect()] == [(7, 1, 0.0, 2.0, "S1")]


def test_bundles_are_written(spark, tmp_path):
    from textweir.operators.bundles import write_bundles

    write_bundles(spark.createDataFrame([("a", "s1"), ("b", "s2")], "topic string, signal string"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("topic=*")) == ["topic=a", "topic=b"]


def test_shared_folder_on_clusters():
    from types import SimpleNamespace

    from textweir.storage import shared_folder

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_folder(session, "x")


def test_audio_probe(spark, tmp_path):
    import wave

    from textweir.sources import providers

    with wave.open(str(tmp_path / "a.wav"), "wb") as out:
        out.setnchannels(1)
        out.setsampwidth(2)
        out.setframerate(8000)
        out.writeframes(bytes(2 * 12000))
    (tmp_path / "b.wav").write_text("no sound")
    audio = spark.createDataFrame([(k, str(tmp_path / f"{n}.wav")) for k, n in enumerate("abc")], "episode long, path string")
    assert rows(providers.probed(audio), "episode") == [(0, 1.5), (1, None), (2, None)]


def test_sources_run_apart():
    from textweir.operators.runs import each_apart

    run = {"a": lambda: 3, "b": lambda: 1 // 0}
    for workers in (1, 2):
        told = each_apart(run, lambda s: run[s](), workers)
        assert told["a"] == 3 and told["b"].startswith("ZeroDivisionError")
