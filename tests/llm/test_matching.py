"""Operators on repeated text against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
import xxhash

from textweir.llm import decontaminate, induced, mixing, recompression, simhash, substrings

RANDOM = random.Random(11)


def corpus(n=60):
    """Texts with copies, near copies, shared passages and oddities."""
    words = ["".join(RANDOM.choices("abcdeé", k=RANDOM.randrange(1, 6))) for _ in range(80)]
    texts = [" ".join(RANDOM.choices(words, k=RANDOM.randrange(0, 160))) for _ in range(n)]
    passage = " ".join(RANDOM.choices(words, k=70))
    for k in range(12):
        texts.append(f"{k} {texts[k]} {passage} {k}")
        texts.append(texts[k])
        texts.append(texts[k].replace("a", "b", 1))
    texts += ["", None, "a" * 400, "ab " * 200, "buy " * 120, "x " + "buy " * 60, "\x00é " * 90, "é\n\t\x0b" * 40]
    return list(enumerate(texts))


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], "doc_id long, text string, h string, uid int")


def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh", bytes(range(1, 255))])
@pytest.mark.parametrize("memory", [64, 1 << 20])
def test_induced_sorting(alphabet, memory):
    for _ in range(25):
        text = bytes(RANDOM.choice(alphabet) for _ in range(RANDOM.randrange(150)))
        text = text + text[: RANDOM.randrange(len(text) + 1)] + b"\0"
        rows = np.concatenate(list(induced.sorted_suffixes(np.frombuffer(text, np.uint8), 20, memory)))
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert rows[:, 0].tolist() == order
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert rows[k, 1] == min(same, 20)


def removed_bytes(rows):
    seen, want = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = [True] * 100
            seen.add(data[i : i + 100])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return want


@pytest.mark.parametrize("hot", [substrings.SORTED, 60])
def test_substrings(docs, hot):
    want = removed_bytes(ROWS)
    got = {r["doc_id"]: (*r[1:5], bytes(r["kept"])) for r in substrings.deduplicate(docs, bytes_too=True, hot=hot).collect()}
    assert got == want and sum(w[1] for w in want.values())


def test_substrings_in_pieces(docs, monkeypatch):
    """Texts longer than a piece, shards longer than a chunk."""
    monkeypatch.setattr(substrings, "PIECE", 256)
    batch = [(k, k, t or "") for k, t in ROWS]
    import pyarrow as pa

    columns = pa.RecordBatch.from_arrays([pa.array([b[i] for b in batch]) for i in range(3)], names=["uid", "ord", "text"])
    rows = [r for b in substrings.segments(100)([columns]) for r in b.to_pylist()]
    covered = {(r["uid"], r["start"] + i) for r in rows for i in range(r["n"])}
    assert covered == {(k, i) for k, t in ROWS for i in range(len((t or "").encode()) - 99)} and len({(r["uid"], r["start"]) for r in rows}) == len(rows)
    texts = {k: (t or "").encode() for k, t in ROWS}
    strings = {}
    for r in rows:
        seg = texts[r["uid"]][r["start"] : r["start"] + r["n"] + 99]
        assert strings.setdefault((r["h"], r["s"], r["t"]), seg) == seg
        at, w, v = substrings.single_windows(100)(texts[r["uid"]], [(r["start"], r["n"])])
        assert at.tolist() == list(range(r["start"], r["start"] + r["n"])) and len(set(zip(w.tolist(), v.tolist(), strict=True))) == len({seg[i : i + 100] for i in range(r["n"])})


def repeated_ids(spark):
    rows = [(i % 20 if i % 5 else None, t) for i, t in ROWS]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_substrings_of_repeated_ids(spark):
    """Rows that share an id, or have none, are documents of their own: the longest of equal texts' bytes stay once."""
    rows, docs = repeated_ids(spark)
    got = substrings.deduplicate(docs, hot=100).collect()
    assert len(got) == len(rows) and sorted((str(r["doc_id"]), r["n_bytes"]) for r in got) == sorted((str(i), len((t or "").encode())) for i, t in rows)
    kept = {(t or "").encode()[i : i + 100] for _, t in rows for i in range(len((t or "").encode()) - 99)}
    assert sum(r["n_removed"] for r in got) and kept
    copies = spark.createDataFrame([(None, "x" * 30 + "abc" * 60), (7, "x" * 30 + "abc" * 60), (7, "x" * 30 + "abc" * 60)], "doc_id long, text string")
    removed = sorted((r["doc_id"] is None, r["n_removed"]) for r in substrings.deduplicate(copies).collect())
    alone = removed_bytes([(0, "x" * 30 + "abc" * 60)])[0][1]
    assert removed == [(False, alone), (False, 210), (True, 210)]


def test_words_of_repeated_ids(spark):
    """Rows of one id don't remove each other's words; rows without an id come last."""
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(3, text), (3, text), (None, text), (None, text), (5, text)], "doc_id long, text string")
    for hot in (recompression.HOT, 1):
        got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in recompression.remove_repeats(docs, hot=hot).collect())
        assert got == [(3, 0), (3, 0), (5, 60), (99, 60), (99, 60)]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.deduplicate(empty).count() == 0 and recompression.remove_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_long_texts(spark):
    """Texts of several pieces, which share all but a few words at other places, beside a short one."""
    own = random.Random(5)
    words = ["".join(own.choices("abcdefgh", k=own.randrange(2, 9))) for _ in range(90_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["at", "first", *words[:50_000], "new", *words[50_060:]])), (3, " ".join(words[70_000:70_100]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    strings, runs, want = set(), set(), {}
    for k, text in rows:
        data, each = text.encode(), text.split()
        gone, lost = np.zeros(len(data), bool), np.zeros(len(each), bool)
        for i in range(len(data) - 99):
            if data[i : i + 100] in strings:
                gone[i : i + 100] = True
            strings.add(data[i : i + 100])
        windows = [" ".join(each[i : i + 50]) for i in range(len(each) - 49)]
        for i, w in enumerate(windows):
            if w in runs:
                lost[i : i + 50] = True
        runs.update(windows)
        left = " ".join(w for w, x in zip(each, lost, strict=True) if not x)
        want[k] = (int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(data, np.uint8)[~gone])).hexdigest(), int(lost.sum()), hashlib.sha256(left.encode()).hexdigest(), f"{simhash.fingerprint(text):016x}")
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in substrings.deduplicate(docs).collect()}
    assert got == {k: w[:2] for k, w in want.items()} and got[2][0] > 200_000
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in recompression.remove_repeats(docs).collect()}
    assert got == {k: w[2:4] for k, w in want.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(docs).collect()} == {k: w[4] for k, w in want.items()}


@pytest.mark.parametrize("hot", [recompression.HOT, 20])
def test_repeated_words(docs, hot):
    first, want = {}, {}
    for doc, text in ROWS:
        w = words_of(text)
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), doc)
    for doc, text in ROWS:
        w = words_of(text)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < doc:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[doc] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    got = {r["doc_id"]: tuple(r[1:]) for r in recompression.remove_repeats(docs, texts=True, hot=hot).collect()}
    assert got == want and sum(w[1] for w in want.values())


def slow_fingerprint(text):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [8, 1])
def test_simhash(docs, bucket):
    fps = {doc: slow_fingerprint(text) for doc, text in ROWS}
    root = {d: d for d in fps}
    for _ in range(len(fps)):
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
        if not changed:
            break
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs, bucket).collect()}
    assert got == {d: (f"{fps[d]:016x}", root[d]) for d in fps}
    assert {r["doc_id"] for r in simhash.one_of_each(docs, bucket).collect()} == set(root.values())


def test_simhash_chain(spark):
    """A chain of near copies is one group, whichever way links are found."""
    base = 0x123456789ABCDEF0
    chain = [base]
    for k in range(20):
        chain.append(chain[-1] ^ (3 << (2 * k)))
    fps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in chain], "fp long")
    from textweir.llm.common import Scratch
    from textweir.llm.components import components

    for bucket in (1, 8):
        found = components(simhash.links(fps, Scratch(spark, "test"), bucket), Scratch(spark, "test"))
        assert found.select("root").distinct().count() == 1 and found.select("node").distinct().count() == len(chain)


def fewest_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_is_brute_force():
    letters = "abcdeé "
    items = [(i, "".join(RANDOM.choices(letters, k=n))) for i, n in enumerate((5, 30, 70, 90, 140))]
    index = decontaminate.Index(items)
    found = 0
    for _ in range(60):
        source = RANDOM.choice(items)[1]
        at = RANDOM.randrange(max(1, len(source) - 60))
        part = list(source[at : at + RANDOM.choice((60, 66, 90))])
        for _ in range(RANDOM.randrange(8)):
            k = RANDOM.randrange(len(part))
            part[k : k + 1] = RANDOM.choice(([], ["x"], [part[k], "y"]))
        text = decontaminate.normalise("q" * RANDOM.randrange(9) + "".join(part) + "".join(RANDOM.choices(letters, k=30)))
        got = {m[1] for m in index.matches([text])}
        for k, item in enumerate(index.texts):
            if len(item) < decontaminate.Q:
                want = item in text
            else:
                w = int(index.window[k])
                want = min(fewest_edits(item[u : u + w], text) for u in range(len(item) - w + 1)) <= index.edits[k]
            assert want == (k in got)
            found += want
    assert found > 20


def test_decontamination_fields(monkeypatch):
    """n_windows and min_edits against all windows along every band, with pairs worked out whole and in ranges of diagonals."""
    say = random.Random(5)
    items = [(0, "".join(say.choices("ab", k=150))), (1, "".join(say.choices("abcdefgh ", k=90))), (2, "ab" * 60)]
    texts = ["".join(say.choices("ab", k=60)) + items[0][1][20:140] + "x" * 30, items[1][1][:40] + "zz" + items[1][1][41:], "ab" * 90, "c" * 200]
    index = decontaminate.Index(items)
    step, k = index.widest + 1, index.widest
    whole = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(index.texts):
            w, last = int(index.window[i]), len(item) - int(index.window[i])
            for band in range(-len(item) // step - 1, len(text) // step + 1):
                grams = [(s, p) for s in range(len(item) - 9) for p in range(len(text) - 9) if item[s : s + 10] == text[p : p + 10] and band * step <= p - s < (band + 2) * step]
                good = []
                for u in range(last + 1):
                    if sum(u <= s and s + 10 <= u + w for s, _ in grams) >= index.least[i]:
                        low = u + band * step - k
                        edits = fewest_edits_on_band(item[u : u + w], text, low, 2 * step + 2 * k)
                        if edits <= index.edits[i]:
                            good.append(edits)
                if good:
                    n, least = whole.get((d, i), (0, 99))
                    whole[d, i] = max(n, len(good)), min(least, min(good))
    assert {(d, i): (n, e) for d, i, n, e in index.matches(texts)} == whole and len(whole) >= 3
    monkeypatch.setattr(decontaminate, "PAIRS", 8)
    assert {(d, i): (n, e) for d, i, n, e in index.matches(texts)} == whole


def fewest_edits_on_band(pattern, text, low, width):
    """Edits of a pattern against the text on the diagonals from `low`, free to begin and end anywhere on them."""
    far = 10**6
    cost = {d: 0 for d in range(width)}
    for row, c in enumerate(pattern):
        new = {}
        for d in range(width):
            at = low + row + d
            best = cost[d] + (not (0 <= at < len(text) and text[at] == c))
            best = min(best, cost.get(d + 1, far) + 1)
            new[d] = min(best, new.get(d - 1, far) + 1)
        cost = new
    return min(cost.values())


@pytest.mark.parametrize("item, text", [("a" * 2000, "a" * 1_000_000), ("ab" * 1000, "ab" * 100_000 + "c" * 800_000)])
def test_decontamination_of_one_letter(item, text):
    began = time.monotonic()
    assert decontaminate.Index([(1, item)]).matches([text]) == [(0, 0, 1941, 0)] and time.monotonic() - began < 60


def test_decontamination_of_short_items():
    say = random.Random(7)
    letters = "abé日本😀 "
    items = [(k, "".join(say.choices(letters, k=say.randrange(1, 10)))) for k in range(400)]
    texts = [decontaminate.normalise("".join(say.choices(letters, k=n))) for n in (0, 1, 3, 9, 10, 200, 3000)]
    index = decontaminate.Index(items)
    got = index.matches(texts)
    assert sorted(got) == sorted((k, i, 1, 0) for i, item in enumerate(index.texts) for k, text in enumerate(texts) if item in text)
    assert len(got) > 400 and not index.matches([]) and not index.matches([""])


def test_decontamination_of_a_million_short_items():
    say = np.random.default_rng(3)
    items = [(k, x) for k, x in enumerate(say.integers(97, 123, (1_000_000, 7)).astype(np.uint8).view("S7").ravel().astype(str).tolist())]
    text = say.integers(97, 123, 1_000_000).astype(np.uint8).tobytes().decode()
    index = decontaminate.Index(items)
    began = time.monotonic()
    got = index.matches([text])
    assert time.monotonic() - began < 10
    held = {text[p : p + 7] for p in range(len(text) - 6)}
    assert sorted(index.texts[i] for _, i, _, _ in got) == sorted(x for x in index.texts if x in held)


def test_decontamination_in_blocks(spark, docs):
    items = spark.createDataFrame([(1, ROWS[3][1]), (1, ROWS[3][1]), (2, None), (3, ""), (4, "nothing like it in any of the documents, at all, whatever")], "item_id long, text string")
    whole, parts = decontaminate.leaks(docs, items), decontaminate.leaks(docs, items, block_chars=100)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    dirty = {r["doc_id"] for r in whole.collect()}
    assert 3 in dirty
    clean = decontaminate.without_leaks(docs, items, block_chars=100)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {d for d, _ in ROWS} - dirty


@pytest.mark.parametrize("weights", [[3, 5, 2], [1, 1, 1, 7], [13, 29, 58], [1]])
def test_period_is_pfair(weights):
    slots, total = mixing.period(weights), sum(weights)
    count = [0] * len(weights)
    for t, s in enumerate(slots, 1):
        count[s] += 1
        assert all(abs(c - w * t / total) < 1 for c, w in zip(count, weights, strict=True))
    assert count == weights


@pytest.mark.parametrize("blocks, weights", [([10, 3, 7], [1, 1, 2]), ([100, 1], [1, 9]), ([0, 5, 0], [1, 2, 3]), ([0], [1]), ([12, 12], [3, 3])])
def test_phases_place_every_block(blocks, weights):
    places = []
    for s, first, end, start, size, share, slots in mixing.phases(blocks, weights):
        for b in range(first, end):
            places.append((start + (b - first) // share * size + slots[(b - first) % share], s, b))
    assert sorted(p[0] for p in places) == list(range(sum(blocks)))
    for s, n in enumerate(blocks):
        assert [b for _, t, b in sorted(places) if t == s] == list(range(n))


def dealt(blocks, weights):
    """The plain schedule: slot by slot, the released block with the earliest deadline; anew when a source runs out."""
    left, out = list(blocks), []
    while any(left):
        live = [s for s, n in enumerate(left) if n]
        common = np.gcd.reduce([weights[s] for s in live])
        share = {s: weights[s] // common for s in live}
        total, done, t = sum(share.values()), dict.fromkeys(live, 0), 0
        whole = min(left[s] // share[s] for s in live)  # a source that ends with a period ends the phase there
        stop = whole * total if any(left[s] == whole * share[s] for s in live) else 1 << 60
        while t < stop and (stop < 1 << 60 or all(left[s] for s in live)):
            ready = [(-(-(done[s] + 1) * total // share[s]), s) for s in live if done[s] * total // share[s] <= t]
            s = min(ready)[1]
            out.append((s, blocks[s] - left[s]))
            left[s] -= 1
            done[s] += 1
            t += 1
    return out


@pytest.mark.parametrize("blocks, weights", [([10, 3, 7], [1, 1, 2]), ([40, 40, 9, 2], [7, 2, 5, 1]), ([0, 5, 0], [1, 2, 3])])
def test_phases_are_the_plain_schedule(blocks, weights):
    at = {}
    for s, first, end, start, size, share, slots in mixing.phases(blocks, weights):
        for b in range(first, end):
            at[start + (b - first) // share * size + slots[(b - first) % share]] = (s, b)
    assert [at[k] for k in sorted(at)] == dealt(blocks, weights)


def test_mixing_query_is_brute_force(spark, sf):
    from textweir.llm import queries
    from textweir.llm.common import table

    got = queries.op3_source_mixing(spark, sf).orderBy("mix_position").collect()
    sources = [r["source"] for r in table(spark, sf, "documents").select("source").collect()]
    names = sorted({s for s in sources if s is not None}) + [None] * (None in sources)
    keys = sorted(names, key=lambda s: "n" if s is None else f"s{s}")
    counts = [sources.count(s) for s in keys]
    total = sum(n**0.5 for n in counts)
    plain = dealt(counts, [max(1, round(1000 * n**0.5 / total)) for n in counts])
    assert [(keys.index(r["source"]), r["mix_block"]) for r in got] == plain
    assert [r["mix_position"] for r in got] == list(range(len(sources))) and len({r["doc_id"] for r in got}) == len({r["doc_id"] for r in table(spark, sf, "documents").select("doc_id").collect()})


@pytest.mark.parametrize("nodes", [256, 8, 4])
def test_mix_of_many_sources(spark, nodes):
    """Sources beyond one schedule keep their share, however deep the tree."""
    rows = [(i, f"s{i % 40}") for i in range(1200)] + [(5000 + i, "big") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(docs, nodes=nodes).orderBy("mix_position").collect()
    assert [r["mix_position"] for r in got] == list(range(len(rows))) and {r["doc_id"] for r in got} == {d for d, _ in rows}
    half = [r["source"] for r in got[:800]]
    assert all(8 <= half.count(f"s{k}") <= 24 for k in range(40))
    given = mixing.mix(docs, {"big": 1, "s3": 1, mixing.POOL: 2}, nodes=nodes).orderBy("mix_position").collect()
    first = [r["source"] for r in given[:100]]
    assert abs(first.count("big") - 25) <= 1 and abs(first.count("s3") - 25) <= 1


def test_mix(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None, "keep", 1, 2) for i in range(200)] + [(5, "a", "again", 1, 2), (None, "a", None, 1, 2), (None, "a", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string, _mix_first int, node int")
    mixed = mixing.mix(docs, {"a": 6, "b": 3, "c": 1}, block_rows=1)
    got = mixed.orderBy("mix_position").collect()
    assert [r["mix_position"] for r in got] == list(range(len(rows))) and mixed.columns == ["doc_id", "source", "_mix_first", "node", "mix_block", "mix_slot", "mix_position"]
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in rows) and {r["node"] for r in got} == {2}
    share = sum(r["source"] == "a" for r in got[:55]) / 55
    assert abs(share - 6 / 11) < 1 / 55 * 1.5
    assert mixing.mix(docs.limit(0)).count() == 0
    assert sorted(r["mix_position"] for r in mixing.mix(docs, block_rows=4).collect())[0] == 0


def test_simhash_broadcasts_nothing(docs, monkeypatch):
    """Exploded variants are 64 times what Spark takes them for, so no join may pass them through the driver."""
    from textweir.llm.common import Scratch

    plans, keep = [], Scratch.keep

    def kept(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name)

    monkeypatch.setattr(Scratch, "keep", kept)
    made = simhash.near_duplicates(docs, 1)
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
