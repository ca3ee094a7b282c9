"""Shared plumbing: table readers, scratch tables and Arrow batch helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute available)
from pyspark.sql import DataFrame, SparkSession

#: Orders rows whose id is null after every numbered one.
NULL_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Where `spark.checkpoint.dir` is unset, a session on one machine (as in
    tests) uses a temporary folder; one on a cluster has to set it, as its
    executors don't share such a folder.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    at = tempfile.mkdtemp(prefix="textweir-")
    spark.sparkContext.setCheckpointDir(at)
    return at


#: Lets Spark delete a query's shuffle files when the query has ended.
SHED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables in the shared folder that cut the lineage of a query.

    They survive the loss of executors. `drop` removes one that no later
    plan reads; the rest go when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/textweir-{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self.drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write `df` and return it as read back; the shuffle files of the write go with its end.

        Writers and readers hold a row group, whose size Parquet looks at after
        a hundred rows first: `rows` is how many a group has at most, for rows of megabytes.
        """
        before = self.spark.conf.get(SHED, None)
        self.spark.conf.set(SHED, "true")
        try:
            out = df.write.mode("overwrite").option("compression", "zstd")
            (out.option("parquet.block.row.count.limit", rows) if rows else out).parquet(self.path(name))
        finally:
            self.spark.conf.unset(SHED) if before is None else self.spark.conf.set(SHED, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended: its owner clears the folder
            return


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about `limit` bytes of `column`, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        yield batch.slice(start)

