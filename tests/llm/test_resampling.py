"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from oracle import check
from textweir.llm import queries, resampling


def plain(docs, target, least=resampling.LEAST_WORDS, percent=resampling.PERCENT):
    def grams(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return w, [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(grams(text)[1])
    for text in target:
        t.update(grams(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        w, found = grams(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, len(w)))
    able = sorted((r for r in rows if r[4] >= least and r[3] is not None), key=lambda r: (-r[3], r[0]))
    drawn = percent * len(able) // 100
    ranks = [(r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(r[:4], None) for r in rows if r[4] < least or r[3] is None]
    return sorted(((*r, k) for r, k in ranks), key=repr)


WORDS = ["alpha", "Été", "b2", "x", "日本", "Delta", "ÀÉ", "q_r", "don't", "\x00z", "K"]


def some_docs():
    docs = [(i, " ".join(WORDS[(i * k + k * k) % len(WORDS)] for k in range(3 + i))) for i in range(60)]
    docs += [(100, ""), (101, None), (102, "..."), (103, "one"), (None, "a b " * 30), (104, "same text " * 15), (104, "same text " * 15), (105, "long words " * 40_000)]
    return docs


@pytest.mark.parametrize("target", [["alpha Été b2 x", "delta, delta q", None, ""], []])
def test_is_the_plain_version(spark, target):
    docs = some_docs()
    frame = spark.createDataFrame([(i, t, "x", 9) for i, t in docs], "doc_id long, text string, rank string, score int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(frame, wanted)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, none).count() == 0


def test_ranks_over_many_ranges(spark):
    """Each row of one id and score: ranks are still 1, 2, 3..."""
    docs = spark.range(0, 400, 1, 7).selectExpr("if(id % 2 = 0, 5, id) as doc_id", "repeat('same words here ', 9) as text")
    ranks = [r["rank"] for r in resampling.resample(docs, docs.limit(3), percent=50).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 201)) and ranks.count(None) == 200


def test_query(spark, sf):
    check(queries.op13_importance_resampling(spark, sf), resampling.ORACLE_SQL, sf)
