"""Ledgers over several batches."""

from pyspark.sql import functions as F

from textweir.streaming import ledgers

SCHEMA = "url string, ok boolean, ord int"


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(f"{folder}/*")


def test_failures_across_batches(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / x) for x in ("in", "state", "checkpoint"))
    batches = [
        [("a", False, 1), ("b", False, 1), ("c", False, 1), ("c", False, 2), ("c", False, 3)],
        [("a", False, 2), ("b", True, 2), ("c", True, 4)],
        [("a", False, 3), ("b", False, 3), ("a", True, 4)],
    ]
    for n, rows in enumerate(batches):
        write(spark, source, f"b{n}", rows)
        ledgers.count_failures(stream(spark, source), "url", "ok", state, checkpoint)
    got = {r["url"]: (r["attempts"], r["failed"]) for r in spark.read.parquet(f"{state}/batch=2").collect()}
    assert got == {"a": (0, True), "b": (1, False), "c": (0, True)}


def test_ledger_grows_once(spark, tmp_path):
    source, ledger, checkpoint = (str(tmp_path / x) for x in ("in", "ledger", "checkpoint"))
    for n, rows in enumerate(([("a", True, 1), ("a", True, 2), ("b", False, 3)], [("a", True, 4), ("b", True, 5)])):
        write(spark, source, f"b{n}", rows)
        ledgers.append_unseen(stream(spark, source), "url", ledger, checkpoint, F.col("ok"))
    assert sorted(r["url"] for r in spark.read.parquet(ledger).collect()) == ["a", "b"]
