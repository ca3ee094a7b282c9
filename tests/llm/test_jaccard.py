"""The near-duplicate stage against brute force."""

import random

from textweir.llm import jaccard


def slow_shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_copies(seed=7):
    """Groups of edited copies with a common passage, some within 0.8 of each other and some beyond."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([8, 40, 150, 400]))] + passage * rng.randrange(2)
        rows.append(base)
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(rng.randrange(1, 1 + max(1, len(base) // 80))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
    texts = [" ".join(r) for r in rows] + ["", "  ", "one two", "One two", "one two three", " ".join(passage)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_dedup_is_brute_force(spark):
    import corpus_pipeline

    rows = near_copies()
    sets = {d: slow_shingles(t) for d, t in rows}
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                i = len(sets[a] & sets[b])
                if root[a] != root[b] and (sets[a] == sets[b] or 9 * i >= 4 * (len(sets[a]) + len(sets[b]))):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == root
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == set(root.values())
    assert len(set(root.values())) < len({t for _, t in rows}) - 10


def test_near_dedup_goes_by_fingerprints_first(spark, monkeypatch):
    """Pairs by SimHash are verified and linked before the exact join."""
    import corpus_pipeline
    from textweir.llm.common import Scratch

    made, keep = {}, Scratch.keep

    def kept(self, df, name):
        got = keep(self, df, name)
        if name in ("pairs-marks", "links-marks"):
            made[name] = got.count()
        return got

    monkeypatch.setattr(Scratch, "keep", kept)
    words = " ".join(f"w{k}" for k in range(300))
    texts = [words, words + " w0", words + " w0 w1", words.replace("w150 ", "w15 "), "some other text of few words", " ".join(f"v{k}" for k in range(200))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {0, 4, 5}
    assert made["pairs-marks"] >= made["links-marks"] > 0
