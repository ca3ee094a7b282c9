"""Phrase collocations against a plain version, with tries, blocks, ranges and merges of the smallest sizes."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from oracle import check
from textweir.llm import phrases, queries


def plain(rows, least, within=80, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = []
    for path, a in f.items():
        if len(path) < 3 or a < least:
            continue
        lang, *w = path
        score, _, l, r = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        found.append((lang, w, a, l, r, score))
    gone = set()
    for lang, w, a, *_ in found:
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= within * f[(lang, *w[i : i + m])]:
                    gone.add((lang, *w[i : i + m]))
    out = []
    for lang in {x[0] for x in found}:
        own = sorted((x for x in found if x[0] == lang and (lang, *x[1]) not in gone), key=lambda x: (-x[5], -x[2], " ".join(x[1]).encode()))
        out += [(lang, k + 1, " ".join(w), a, l, r, n[lang], s) for k, (_, w, a, l, r, s) in enumerate(own[:top])]
    return sorted(out)


def some_rows(seed=3, n=80):
    rng = random.Random(seed)
    words = ["the", "The", "of", "été", "a\x00", "\x01b", "日本", "x-y", "ÀB", "to", "and so", "zz"]
    weights = [9, 2, 8, 3, 1, 1, 1, 1, 1, 5, 1, 2]
    rows = []
    for _ in range(n):
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]) for w in rng.choices(words, weights, k=rng.randrange(40)))
        rows.append((rng.choice(["en", "fr", None, ""]), rng.choice(["", " "]) + text))
    return rows + [("en", None), ("fr", ""), ("en", " \t "), ("en", "..."), ("en", "to the zz " * 50), ("de", "one phrase"), ("en", "of the " * 30)] * 2


SIZES = [{}, {"SHARD_BYTES": 300, "TEXT_BYTES": 40, "BLOCK_LEAVES": 7, "MERGE_LEAVES": 20, "RANGE_BYTES": 500}, {"RANGE_BYTES": 200, "PICKS": 8}]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("least", [3, 30])
def test_is_the_plain_version(spark, monkeypatch, sizes, least):
    rows = some_rows()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n int, phrase int").repartition(4)
    for k, v in sizes.items():  # those of the driver: ranges and picks
        monkeypatch.setattr(phrases, k, v)
    got = phrases.collocations(docs, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least)


@pytest.mark.parametrize("sizes", SIZES)
def test_tries_in_one_process(monkeypatch, sizes):
    """The shards' tries, cut by bounds and merged in any small sizes, count as the plain version does."""
    for k, v in sizes.items():
        monkeypatch.setattr(phrases, k, v)
    rows = [("en" if x is None else x, y or "") for x, y in some_rows(5, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    bounds = [(b"en", b"of", b"the"), (b"en", b"the"), (b"en", b"the", b"of", b"the", b"zzz"), (b"fr",), (b"fr", b"to", b"to")]
    blocks = [b for out in phrases._blocks(iter([batch]), bounds) for b in out.to_pylist()]
    blocks.sort(key=lambda b: (b["part"], b["first"]))
    whole, parts = {}, Counter()
    for out in phrases._merged(iter([pa.RecordBatch.from_pylist(blocks, phrases._BLOCK_TYPE)]), bounds, 2):
        for x in out.to_pylist():
            if x["whole"]:
                assert (x["lang"], x["phrase"]) not in whole
                whole[x["lang"], x["phrase"]] = x["n"]
            else:
                parts[x["lang"], x["phrase"]] += x["n"]
    assert not set(whole) & set(parts)
    f = Counter()
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            f.update({(lang, ""): len(w)} if w else {})
            f.update((lang, " ".join(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert whole | {k: v for k, v in parts.items() if v >= 2} == {k: v for k, v in f.items() if v >= 2}


def test_no_rows(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "a b")], "lang string, text string")).count() == 0


def test_one_long_text(spark):
    """A text far longer than what is split at once, one piece of it without an end."""
    text = "go on and " * 200_000
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == plain([("en", text)], 30)


def test_query(spark, sf):
    check(queries.op11_phrase_collocations(spark, sf), phrases.ORACLE_SQL, sf)
