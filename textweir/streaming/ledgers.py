"""Structured Streaming forms of the ledgers.

Streams run to the end of what is there (`availableNow`) and stop, as the
polling of a ledger does; a checkpoint lets the next run go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _run(stream: DataFrame, checkpoint: str, batch) -> None:
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_unseen(stream: DataFrame, key: str, ledger: str, checkpoint: str, keep=None) -> None:
    """Append the rows of new keys to the Parquet table `ledger`.

    Rows that `keep` (a condition) rejects are not recorded, so a later poll
    looks at them again. A batch that is retried after a crash appends
    nothing twice, as it meets its own keys in the ledger.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        rows = batch.where(keep) if keep is not None else batch
        rows = rows.dropDuplicates([key])
        try:
            rows = rows.join(spark.read.parquet(ledger).select(key).distinct(), key, "left_anti")
        except Exception as none_yet:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(none_yet):
                raise
        rows.write.mode("append").parquet(ledger)

    _run(stream, checkpoint, write)


def count_failures(stream: DataFrame, key: str, ok: str, state: str, checkpoint: str, limit: int = 3) -> None:
    """Keep (key, attempts, failed) in the Parquet table `state`: a success resets the count, `limit` failures in a row fail for good.

    Each batch is folded by window functions in order of `ord` and written as
    a new version of the state, named by the batch.
    """
    spark = stream.sparkSession
    from textweir.operators.ledger import failure_runs

    def write(batch: DataFrame, number: int) -> None:
        before = F.sum(F.col(ok).cast("int")).over(Window.partitionBy(key).orderBy("ord"))
        lead = batch.withColumn("_s", before).groupBy(key).agg(F.max(F.col(ok).cast("int")).alias("_any"), F.count_if(F.col("_s") == 0).alias("_lead"))
        fresh = failure_runs(batch, key, F.col(ok), "ord").join(lead, key)
        if number:
            old = spark.read.parquet(f"{state}/batch={number - 1}").select(key, F.col("attempts").alias("_a"), F.col("failed").alias("_f"))
            joined = fresh.join(old, key, "full_outer")
            attempts = F.when(F.col("_any") == 1, F.col("attempts")).otherwise(F.coalesce("attempts", F.lit(0)) + F.coalesce("_a", F.lit(0)))
            carried = F.coalesce("_a", F.lit(0)) + F.coalesce("_lead", F.lit(0))  # the run that the last batch left open
            failed = F.coalesce("failed", F.lit(False)) | F.coalesce("_f", F.lit(False)) | (carried >= limit)
            fresh = joined.select(key, attempts.cast("bigint").alias("attempts"), failed.alias("failed"))
        fresh.select(key, "attempts", "failed").write.mode("overwrite").parquet(f"{state}/batch={number}")

    _run(stream, checkpoint, write)


def last_state(spark: SparkSession, state: str) -> DataFrame:
    """The newest version that `count_failures` wrote; the older ones are not read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    held = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    newest = max(int(name[6:]) for f in held if (name := f.getPath().getName()).startswith("batch="))
    return spark.read.parquet(f"{state}/batch={newest}")


def distinct_within(stream: DataFrame, time: str, delay: str, *keys: str) -> DataFrame:
    """The first row of each key, as long as repeats come within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, time: str, delay: str, width: str, *keys: str) -> DataFrame:
    """Counts of tumbling windows, with late rows dropped after the delay."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def parquet_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder as a stream; it may be one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}*.parquet")
