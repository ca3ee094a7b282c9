"""Polls, mirrors and the command line on small trees."""

import json
import os

import pytest
from pyspark.sql import functions as F

from textweir.__main__ import main
from textweir.functions import text
from textweir.operators import mirror, polls
from textweir.storage import Busy

FEED = "<rss><channel>{}</channel></rss>"
ITEM = "<item><title>{0}</title><link>https://x/a/{0}</link><pubDate>Wed, 0{1} May 2024 10:00:00 +0000</pubDate></item>"


def listed(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def read(pages):
    return pages.withColumns({"body": F.trim(text.strip_tags(F.col("html"))), "page_date": F.regexp_extract("html", "data-day=([0-9-]+)", 1)})


def test_poll(spark, tmp_path):
    bodies = spark.createDataFrame([("f", FEED.format("".join(ITEM.format(n, k) for k, n in enumerate("abc", 1))))], "feed string, xml string")
    down = {"https://x/a/c"}

    def fetch(url):
        if url in down:
            raise OSError("gone")
        return f"<p data-day=2023-11-03>body of {url}</p>"

    source = polls.Source("site", max_failures=2, ignore_dates=("2023-11-03",), tags=("t",))
    poll = lambda day, **more: polls.poll(spark, source, bodies, fetch, read, str(tmp_path / "news"), str(tmp_path / "ledgers"), day, **more)
    assert poll("2024-06-01") == {"tried": 3, "written": 2}
    assert sorted(p.name for p in (tmp_path / "news" / "site").iterdir()) == ["2024-05-01 - a.md", "2024-05-02 - b.md"]
    assert "body of https://x/a/a" in (tmp_path / "news/site/2024-05-01 - a.md").read_text()
    known = polls.read_ledgers(spark, str(tmp_path / "ledgers/site"))
    assert listed(known["attempts"], "url") == [("https://x/a/c", 1)] and known["failed"].count() == 0
    assert poll("2024-06-02") == {"tried": 1, "written": 0}
    known = polls.read_ledgers(spark, str(tmp_path / "ledgers/site"))
    assert listed(known["failed"], "url") == [("https://x/a/c",)] and known["attempts"].count() == 0
    assert poll("2024-06-03") == {"tried": 0, "written": 0}
    down.clear()
    assert poll("2024-06-04", retry_failed=True) == {"tried": 1, "written": 1}
    known = polls.read_ledgers(spark, str(tmp_path / "ledgers/site"))
    assert known["processed"].count() == 3 and known["failed"].count() == 0


def test_one_date_and_slug(spark, tmp_path):
    """Two articles of one day and title are two files, and a poll leaves its ledgers to no other that runs beside it."""
    items = "".join(ITEM.format("same", 1).replace("/a/same", f"/{k}/same") for k in "xy")
    bodies = spark.createDataFrame([("f", FEED.format(items))], "feed string, xml string")

    def again(pages):
        with pytest.raises(Busy):
            polls.poll(spark, polls.Source("two"), bodies, str, read, str(tmp_path / "news"), str(tmp_path / "ledgers"), "2024-06-01")
        return read(pages)

    assert polls.poll(spark, polls.Source("two"), bodies, lambda url: f"<p>{url}", again, str(tmp_path / "news"), str(tmp_path / "ledgers"), "2024-06-01") == {"tried": 2, "written": 2}
    assert {p.name: p.read_text().strip()[-6:] for p in (tmp_path / "news" / "two").iterdir()} == {"2024-05-01 - same.md": "x/same", "2024-05-01 - same-2.md": "y/same"}


@pytest.mark.parametrize(
    ("kind", "page", "listed_day", "want"),
    [
        ("rss", "2024-02-02", "2024-01-01", "2024-02-02"), ("rss", "", "2024-01-01", "2024-01-01"), ("rss", "2023-11-03", "2024-01-01", "2024-01-01"),
        ("rss", "2023-11-03", "", "2024-06-01"), ("html", "2024-02-02", "2024-01-01", "2024-01-01"), ("html", "2024-02-02", "2024-01", "2024-01-01"), ("html", "2024-01-20", "2024-01", "2024-01-20"),
    ],
)
def test_article_date(spark, kind, page, listed_day, want):
    source = polls.Source("s", kind, ignore_dates=("2023-11-03",))
    day = polls.article_date(source, F.lit(page), F.lit(listed_day), F.lit("https://x/a"), F.lit("2024-06-01"))
    assert spark.range(1).select(day.alias("d")).first()["d"] == want


def test_mirror(spark, tmp_path):
    (tmp_path / "a.md").write_text("é" * 10)
    rows = spark.createDataFrame([(str(tmp_path / "a.md"),), (str(tmp_path / "none.md"),)], "path string").coalesce(1)
    target = F.concat(F.lit(f"{tmp_path}/out/"), F.element_at(F.split("path", "/"), -1))
    told = dict(listed(mirror.mirrored(rows, target), "path"))
    assert told[str(tmp_path / "a.md")] is None and "FileNotFoundError" in told[str(tmp_path / "none.md")]
    assert [(p.name, p.read_text()) for p in (tmp_path / "out").iterdir()] == [("a.md", "é" * 10)]


def test_mirror_gives_up(spark, tmp_path):
    rows = spark.range(9).coalesce(1).select(F.concat(F.lit(f"{tmp_path}/none"), F.col("id").cast("string")).alias("path"))
    told = [r["error"] for r in mirror.mirrored(rows, F.concat("path", F.lit(".copy"))).collect()]
    assert sum("not tried" in e for e in told) == 9 - mirror.MAX_ERRORS


def test_mirror_compares_blocks(spark, tmp_path):
    """Files of one size with an older, equal mirror are left alone; of others only what differs is read from the source."""
    ours, theirs = tmp_path / "ours", tmp_path / "theirs"
    texts = {"same": ("abcdefgh", "abcdefgh"), "differs": ("abcdXfgh", "abcdefgh"), "longer": ("abcdefghij", "abcdefgh"), "shorter": ("abcd", "abcdefgh"), "empty": ("", "abc"), "new": ("abc", None), "younger": ("abcd", "xxxx")}
    for folder, k in ((ours, 0), (theirs, 1)):
        folder.mkdir()
        for name, both in texts.items():
            if both[k] is not None:
                (folder / name).write_text(both[k])
                os.utime(folder / name, (2000, 2000) if k == 0 or name == "younger" else (1000, 1000))

    def rows(folder):
        found = [(p.name, str(p), p.stat().st_size, p.stat().st_mtime_ns // 1000) for p in sorted(folder.iterdir())]
        return spark.createDataFrame(found, "name string, path string, size bigint, mtime bigint")

    found = mirror.changes(rows(ours), rows(theirs), size=4)
    assert dict(listed(found.select("name", "blocks"), "name")) == {"differs": [1], "longer": [2], "shorter": [], "empty": [0], "new": None}
    told = mirror.patched(found, F.concat(F.lit(f"{theirs}/"), "name"), 4).collect()
    assert len(told) == 5 and not any(r["error"] for r in told)
    assert {n: (theirs / n).read_text() for n in texts} == {n: "xxxx" if n == "younger" else a for n, (a, _) in texts.items()}
    assert (theirs / "same").stat().st_mtime == 1000
    assert not mirror.changes(rows(ours), rows(theirs), size=4).count()
    assert not mirror.changes(rows(ours).limit(0), rows(theirs)).count()


def test_patch_reads_what_differs(tmp_path):
    new, old = tmp_path / "new", tmp_path / "old"
    for mtime, want in ((None, "----ef"), (7, "abcdef")):  # a source of another time than listed is copied whole
        new.write_text("abcdef")
        old.write_text("----xx")
        mirror.patch_whole(str(new), str(old), [1], new.stat().st_mtime_ns // 1000 if mtime is None else mtime, 4)
        assert old.read_text() == want


def test_command_line(spark, tmp_path, capsys):
    root, at = tmp_path / "root", str(tmp_path / "index")
    for name, body in (("a", "red fox and red hen"), ("b", "blue fox")):
        (root / "news" / name).mkdir(parents=True)
        (root / "news" / name / f"2024-05-0{1 + len(name)} - {name}.md").write_text(f'---\ntitle: "{name}"\n---\n{body}\n')
    assert main(["index", str(root), at], spark) == 0
    assert main(["search", at, '"red hen"', "--json", "--mode", "keyword"], spark) == 0
    found = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert found["path"] == "news/a/2024-05-02 - a.md" and found["text"] == "red fox and red hen" and found["via"] == "keyword" and found["lines"] == "4-4"
    for mode, via in (("vector", "vector"), ("hybrid", "keyword+vector")):
        assert main(["search", at, "red fox and red hen", "--json", "--mode", mode, "-k", "1", "--source", "news/a/*"], spark) == 0
        found = json.loads(capsys.readouterr().out.splitlines()[-1])
        assert found["path"].startswith("news/a/") and found["via"] == via
    first = {r["path"]: r["doc_id"] for r in _docs(spark, at)}
    (root / "news" / "b" / "2024-05-02 - b.md").unlink()
    (root / "news" / "a" / "new.md").write_text("green fox")
    assert main(["index", str(root), at], spark) == 0
    after = {r["path"]: r["doc_id"] for r in _docs(spark, at)}
    assert len(after) == 2 and [first[p] for p in after if p in first] == [after[p] for p in after if p in first]
    assert max(after.values()) > max(first.values())
    assert main(["search", at, "fox", "--sort", "date", "--mode", "keyword"], spark) == 0
    assert "green fox" in (out := capsys.readouterr().out) and "blue fox" not in out
    assert main(["mirror", str(root), str(tmp_path / "copy")], spark) == 0
    assert main(["mirror", str(root), str(tmp_path / "copy")], spark) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ["copied 2, failed 0", "copied 0, failed 0"]


def _docs(spark, at):
    from textweir.operators import segments

    return segments.opened(spark, at).docs().select("path", "doc_id").collect()


def test_modes_need_vectors(spark):
    from textweir.operators import segments

    for vector in (None, [1.0]):
        with pytest.raises(ValueError):
            segments.search(segments.Index(spark, "none", 0, ()), "x", vector=vector)
