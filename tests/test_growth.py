"""What shows only in odd or larger tables."""

from zlib import crc32

from oracle import check
from textweir.plans import catalogue, index_queries


def test_embed_with_model_odd_texts(spark, tmp_path):
    """Words that cancel out, white space that isn't ASCII, blank texts and none are told of as SQL does."""
    seen, pair = {}, None
    for k in range(10_000):
        h = crc32(f"w{k}".encode())
        other = seen.setdefault(h % 64, (h >> 31, k))
        if other[0] != h >> 31:
            pair = f"w{other[1]} w{k}"
            break
    rows = [(1, pair), (2, f"{pair} {pair}"), (3, "\x0b"), (4, "\xa0"), (5, " \n"), (6, ""), (7, None), (8, "one two")]
    docs = spark.createDataFrame([(i, t, "en", "src1") for i, t in rows], "doc_id long, text string, lang string, source string")
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    check(index_queries.embed_with_model(spark, str(tmp_path)), catalogue.ORACLE_SQL["embed_with_model"], str(tmp_path))


def test_lost_terms_are_made_after_the_join(spark, tmp_path, monkeypatch):
    """Only replaced chunks are split into terms: no filter on terms goes below the join that finds them."""
    from pyspark.sql import DataFrameWriter
    from textweir.operators import segments

    plans, write = [], DataFrameWriter.parquet

    def kept(self, path, *more):
        plans.append((path, self._df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, path, *more)

    columns = "doc_id long, path string, corpus string, source string, date string, title string, url string, size long, mtime double, chunker string, text string, first_line int"
    docs = lambda time: spark.createDataFrame([(i, f"p/{i}", "raw", "p", "", "", "", 1, time if i < 3 else 1.0, "std", f"a b{i}", 1) for i in range(20)], columns)
    index = segments.sync(segments.opened(spark, str(tmp_path)), docs(1.0))
    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    index = segments.sync(index, docs(2.0))
    (minus,) = [p for path, p in plans if "/minus/" in path]
    assert "regexp_extract_all" in minus and not any("Filter" in line and "regexp_extract_all" in line for line in minus.splitlines())
    assert {(r["term"], r["df"]) for r in index.table("minus").collect()} == {("a", 3), ("b0", 1), ("b1", 1), ("b2", 1)}


def test_no_join_of_an_index_is_broadcast_by_its_files(spark, tmp_path, monkeypatch):
    """Small files may hold many rows: of those that grow with the index, only counted ones go through the driver."""
    from pyspark.sql import DataFrameWriter
    from textweir.operators import search, segments

    plans, write = [], DataFrameWriter.parquet

    def kept(self, path, *more):
        plans.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return write(self, path, *more)

    columns = "doc_id long, path string, corpus string, source string, date string, title string, url string, size long, mtime double, chunker string, text string, first_line int"
    docs = lambda time: spark.createDataFrame([(i, f"p/{i}", "raw", "p", "", "", "", 1, time if i < 5 else 1.0, "std", f"a b{i}", 1) for i in range(20)], columns)
    found = []
    for few in (0, 1 << 16):
        plans.clear()
        with monkeypatch.context() as patch:
            patch.setattr(segments, "FEW", few, raising=False)
            patch.setattr(DataFrameWriter, "parquet", kept)
            index = segments.opened(spark, str(tmp_path / str(few)))
            for time in (1.0, 2.0, 3.0, 4.0):  # the last is a merge
                before, index = index, segments.sync(index, docs(time))
            rank = segments.keyword_rank(before, search.compile_query("b1 b7"))
            plan = rank._jdf.queryExecution().executedPlan().toString()
            found.append([(r["chunk_id"], r["bm25"]) for r in rank.orderBy("kw_rank").collect()])
        sent = {path.split("/")[-2] for path, p in plans if "BroadcastExchange" in p}
        # Slots that are named one by one are sent, and tombstones if they are few.
        assert (sent, plan.count("BroadcastExchange")) == ((set(), 1) if few == 0 else ({"chunks", "attributes", "dead", "minus"}, 2))
    assert found[0] == found[1] and len(found[0]) == 2


def test_postings_need_no_shuffle_of_their_own(spark):
    """Texts are brought together by slots once; postings are made, and put into blocks, where their chunk is, in slices."""
    from textweir.operators import index, segments

    rows = [(i, " ".join(f"w{i % 7} v{k}" for k in range(i % 40))) for i in range(300)]
    chunks = spark.createDataFrame(rows, "chunk_id long, text string").repartition(3)
    made = segments.blocks(chunks, 4, 1)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1  # the rows' own is one with it
    before, index.SLICE_TERMS = index.SLICE_TERMS, 50
    try:
        cut = segments.blocks(chunks, 4, 100 << 20)
        got = [{(r["term"], i): (r["slot"], f, n, tuple(at)) for r in b.collect() for i, f, n, at in zip(r["ids"], r["tfs"], r["lens"], r["places"], strict=True)} for b in (made, cut)]
    finally:
        index.SLICE_TERMS = before
    want = {}
    for i, text in rows:
        words = text.split()
        for w in set(words):
            at = tuple(k for k, x in enumerate(words) if x == w)
            want[w, i] = (i >> 4, len(at), len(words), at)
    assert got == [want, want]


def test_rows_of_listings_are_dealt(spark):
    """Pages of one small file don't become the rows of one task."""
    from textweir.sources import listings

    html = "".join(f'<a href="/{k}">t</a>' for k in range(50))
    pages = spark.createDataFrame([(i, "https://x.com/l", html) for i in range(200)], "listing long, url string, html string").coalesce(1)
    for made in (listings.listing_items(pages, ('<a href="([^"]+)">(.*?)</a>',)), listings.dated_items(pages, ('<a href="([^"]+)">(.*?)</a>',))):
        plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
        dealt = next(k for k, line in enumerate(plan) if "RepartitionByExpression" in line)
        assert dealt > max(k for k, line in enumerate(plan) if "Generate" in line)  # below what makes the rows
        assert made.count() == 200 * 50


def test_one_list_makes_only_that_list(spark, sf, monkeypatch):
    """A search of one mode doesn't run the other's jobs."""
    from textweir.plans import search_queries

    def never(*_, **__):
        raise AssertionError("the other list was made")

    with monkeypatch.context() as patch:
        patch.setattr(search_queries.segments, "keyword_rank", never)
        assert search_queries.vector_mode_search(spark, sf).count() == 10
    with monkeypatch.context() as patch:
        patch.setattr(search_queries.segments, "vector_rank", never)
        assert search_queries.keyword_mode_search(spark, sf).count() == 10
