"""The similarity join of shingle sets against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from oracle import check
from textweir.llm import queries, setjoin


def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, rule, empty_apart=True):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(" ".join(w[k : k + rule.size]) for k in range(max(1, len(w) - rule.size + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        alike = rule.whole * len(a & b) >= rule.part * len(a | b) if a or b else not empty_apart
        if alike and (a or not empty_apart):
            root[find(j)] = find(i)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(own) if own else None))
    return sorted(out, key=repr)


def edited(rng, base, pool, k):
    copy = list(base)
    for _ in range(k):
        i = rng.randrange(len(copy))
        copy[i : i + rng.randrange(2)] = [rng.choice(pool)] * rng.randrange(2)
    return copy


def some_rows(seed, sizes):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)] + ["Été", "ß", "日本"]
    passage = rng.choices(pool, k=25)
    texts = []
    for size in sizes:
        base = rng.choices(pool, k=size) + passage * rng.randrange(2)
        texts.append(base)
        for _ in range(rng.choice([1, 3, 12])):
            texts.append(edited(rng, base, pool, rng.randrange(1, 2 + len(base) // 30)))
        texts.append(base[: len(base) - rng.randrange(1 + len(base) // 9)])
    rows = [" ".join(t) for t in texts] + ["", "  ", None, "one", "One", "one two", "one two three", "  x\x1cy z", " ".join(passage)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(None, rows[0]), (None, "no other text"), (3, rows[5]), (3, "a third row of three")]


SMALL, LONG = [3, 5, 9, 10, 11, 12, 14, 18, 20, 22, 25, 28, 30, 33] * 2, [40, 90, 150, 300, 18, 22]


@pytest.mark.parametrize(
    "rule, sizes, most_small, worth",
    [
        (setjoin.Rule(), SMALL, 48, 32),
        (setjoin.Rule(), SMALL, 0, 0),
        (setjoin.Rule(), LONG, 26, 0),
        (setjoin.Rule(5, 4, 5), LONG + SMALL, 48, 32),
    ],
)
def test_is_brute_force(spark, rule, sizes, most_small, worth):
    rows = some_rows(len(sizes) + most_small, sizes)
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, sig string, n int, node string").repartition(5)
    got = sorted(map(tuple, setjoin.similar(docs, rule, most_small=most_small, worth=worth).collect()), key=repr)
    assert got == brute(rows, rule)
    assert len({r[2] for r in got}) < len(got) - 10


def test_subsets_are_shared_exactly_by_linked_sets():
    rule, rng = setjoin.Rule(), np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(9, 24))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        m = int(rng.integers(rule.sizes(n).start, rule.sizes(n).stop))
        b = np.r_[a[: int(rng.integers(max(0, min(n, m) - 3), min(n, m) + 1))], rng.integers(0, 1 << 62, 30).astype(np.uint64)][:m]
        keys = [{(x, y, k) for x, y, ks in setjoin.subsets(s, len(s), rule, 48) for k in ks.tolist()} for s in (a, b)]
        common = len(set(a.tolist()) & set(b.tolist()))
        sizes = (min(n, m), max(n, m))
        assert any(k[:2] == sizes for k in keys[0] & keys[1]) == (100 * common >= 90 * (n + m - common))
        assert rule.subsets(n) == len(keys[0])


def test_shingles():
    texts = pa.array([None, "", " \t", "A b", "a B", "x y z", " x  y\nz w x y z", "é É"])
    found = [x.tolist() for x in setjoin.shingles(texts, 3)]
    assert list(map(len, found)) == [0, 0, 0, 1, 1, 1, 4, 1]
    assert found[3] == found[4] and found[5][0] in found[6]
    assert setjoin.shingles(pa.array([], pa.string()), 3) == []


@pytest.mark.parametrize("worth", [32, 0])
def test_template_texts(spark, worth):
    """Texts of one template, rarely alike: lists are split, and the result is the same."""
    rng = random.Random(4)
    template = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(template)
        for k in rng.sample(range(20), 3):
            w[3 * k] = f"v{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    rule = setjoin.Rule()
    got = sorted(map(tuple, setjoin.similar(spark.createDataFrame(rows, "doc_id long, text string"), rule, worth=worth).collect()), key=repr)
    assert got == brute(rows, rule)


def test_no_rows(spark):
    assert setjoin.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    """One very long text and a near copy of it, beside short ones."""
    rng = random.Random(9)
    long = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    rows = [(5, " ".join(long)), (2, " ".join(long[:100_000] + ["new"] + long[100_000:])), (7, "short text here"), (9, " ".join(long[:150_000]))]
    got = {r["doc_id"]: r["component_id"] for r in setjoin.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 2, 2: 2, 7: 7, 9: 9}


def test_query(spark, sf):
    check(queries.op12_ngram_jaccard_join(spark, sf), setjoin.ORACLE_SQL, sf)
