"""The segmented index: changes, writers, pruning and what a change costs."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textweir.operators import search, segments
from textweir.storage import Busy, Lease, create_once

DOCS = "doc_id long, path string, corpus string, source string, date string, title string, url string, size long, mtime double, chunker string, text string, first_line int"


def documents(spark, texts, times=None):
    rows = [(i, f"news/s{i % 3}/{i}.md", "raw" if i % 4 else "briefs", f"s{i % 3}", f"2024-01-{1 + i % 28:02d}", "", "", len(t), float((times or {}).get(i, 1)), "std", t, 1) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS)


def some_texts(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 500}" for _ in range(4000)]
    return {i: " ".join(rng.choices(words, k=rng.randrange(1, 60))) for i in range(n)}


def hashed(chunks):
    from textweir.sources import providers

    return providers.embedded(chunks, providers.hashed_words(16))


def results(index, query, **more):
    return [(r["chunk_id"], r["bm25"], r["kw_rank"]) for r in segments.keyword_rank(index, search.compile_query(query), **more).orderBy("kw_rank").collect()]


def test_changes_equal_a_new_index(spark, tmp_path):
    texts, times = some_texts(60), {}
    index = segments.opened(spark, str(tmp_path / "a"))
    rng = random.Random(2)
    for step in range(5):
        index = segments.sync(index, documents(spark, texts, times), model=hashed)
        for i in rng.sample(sorted(texts), 6):
            texts[i], times[i] = f"w1 w2 {texts[i]} w{step}", step + 2
        for i in rng.sample(sorted(texts), 3):
            del texts[i]
        texts[100 + step] = "w3 w1 new"
    index = segments.sync(index, documents(spark, texts, times), model=hashed)
    assert {s["level"] for s in index.segments} == {0, 1}
    new = segments.sync(segments.opened(spark, str(tmp_path / "b")), documents(spark, texts, times), model=hashed)
    assert (index.chunks, index.mean) == (new.chunks, new.mean) == (len(texts), new.mean)
    for query in ("w1 w2", '"w1 w2"', 'w3 "w1 w2"', "w499 w7", "none"):
        for filters in (search.Filters(), search.Filters(("raw",), since="2024-01-05", sources=("news/s1/*",))):
            assert results(index, query, filters=filters) == results(new, query, filters=filters)
    vector = hashed(spark.createDataFrame([(1, "w1 w2 w9")], "chunk_id long, text string")).first()["embedding"]
    near = [[(r["chunk_id"], r["similarity"]) for r in segments.vector_rank(i, vector, search.Filters(), 20).orderBy("vec_rank").collect()] for i in (index, new)]
    assert near[0] == near[1] and len(near[0]) == 20
    names = {s["name"] for s in index.segments}
    assert not set(segments.sweep(index)) & names and segments.sweep(index) == []
    assert segments.opened(spark, str(tmp_path / "a")).docs().count() == len(texts)


def test_best_slots_alone_are_scored(spark, tmp_path):
    """A query reads the slots that can hold its best chunks, and gives what reading all does."""
    texts = {i: "common " + ("rare " * (1 + i % 5) if i % 16 == 0 and i < 400 else "") + "filler " * (1 + i % 7) for i in range(0, 6400, 2)}
    empty = segments.Index(spark, str(tmp_path), 0, (), 6)
    docs = documents(spark, texts)
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), "doc_id", F.lit(0).alias("ord"), F.lit(1).alias("start_line"), F.lit(1).alias("end_line"), "text")
    index = segments.publish(empty, [segments.written(empty, "a", 0, {"chunks": chunks, "attributes": segments.attributes(docs, chunks)})])
    query = search.compile_query("rare common")
    slots, idfs = segments.keyword_slots(index, query, pool=10)
    every = index.table("blocks").select("segment", "slot").distinct()
    assert slots.count() <= 8 < every.count() == 100
    best = segments._scored(index, query, every, idfs, search.Filters()).orderBy("bm25", "chunk_id").limit(10).collect()
    assert [(r["chunk_id"], r["bm25"]) for r in best] == [r[:2] for r in results(index, "rare common", pool=10)]
    # The scan is given ranges of slots, so it skips row groups; texts and lengths are not read at all.
    plan = segments.keyword_rank(index, query, pool=10)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(slot" in plan and "ReadSchema: struct<text" not in plan


def test_far_vectors_are_skipped(spark, tmp_path):
    rng = random.Random(3)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in middles[i % 40]]) for i in range(8000)]
    vectors = spark.createDataFrame(rows, "chunk_id long, embedding array<float>")
    empty = segments.Index(spark, str(tmp_path), 0, ())
    docs = documents(spark, {0: "x"})
    chunks = docs.select(F.lit(0).cast("long").alias("chunk_id"), "doc_id", F.lit(0).alias("ord"), F.lit(1).alias("start_line"), F.lit(1).alias("end_line"), "text")
    index = segments.publish(empty, [segments.written(empty, "a", 0, {"chunks": chunks, "attributes": segments.attributes(docs, chunks)}, vectors)])
    query = middles[7]
    every = index.table("near").select("segment", "block")
    assert segments.near_blocks(index, query, pool=50).count() < every.count() / 4
    scores = np.array([v for _, v in rows], np.float32).astype(float) @ np.array(query)
    want = sorted(((-round(float(x), 6), i) for i, x in enumerate(scores)))[:50]
    got = segments.vector_rank(index, query, pool=50).orderBy("vec_rank").collect()
    assert [(-r["similarity"], r["chunk_id"]) for r in got] == want


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_a_small_change_writes_little(spark, tmp_path):
    texts = some_texts(3000)
    index = segments.sync(segments.opened(spark, str(tmp_path)), documents(spark, texts).coalesce(1))
    before = size(tmp_path)
    texts |= {i: texts[i] + " more" for i in range(0, 3000, 100)}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        segments.sync(index, documents(spark, texts, dict.fromkeys(range(0, 3000, 100), 2.0)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert size(tmp_path) - before < 0.05 * before + 40_000  # some files' footers


def test_one_of_two_publishes_fails(spark, tmp_path):
    index = segments.sync(segments.opened(spark, str(tmp_path)), documents(spark, {1: "a b"}))
    late = segments.opened(spark, str(tmp_path))
    segments.sync(index, documents(spark, {1: "a b", 2: "c"}))
    with pytest.raises(segments.Conflict):
        segments.sync(late, documents(spark, {1: "a b", 3: "d"}))
    assert {r["doc_id"] for r in segments.opened(spark, str(tmp_path)).docs().collect()} == {1, 2}


def test_lease(spark, tmp_path):
    folder = str(tmp_path / "lease")
    with Lease(spark, folder) as first:
        first.check()
        with pytest.raises(Busy), Lease(spark, folder):
            pass
    with Lease(spark, folder, seconds=-1) as away:
        with pytest.raises(Busy):
            away.check()
        with Lease(spark, folder) as after:
            after.check()
            with pytest.raises(Busy):  # it was taken over
                away.check()
    assert create_once(spark, f"{folder}/x", "1") and not create_once(spark, f"{folder}/x", "2") and (tmp_path / "lease" / "x").read_text() == "1"


def test_ranges():
    assert segments.ranges([5, 1, 2, 9, 10, 3]) == [(1, 3), (5, 5), (9, 10)]
    assert segments.ranges([5, 1, 2, 9, 10, 3], 2) == [(1, 5), (9, 10)]
    assert segments.ranges([]) == []
