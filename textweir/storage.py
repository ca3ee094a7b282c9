"""Where tables lie that outlive a query: a folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`.

    Where that is unset, a session on one machine (as in tests) gets a
    temporary one; on a cluster it has to be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix=f"textweir-{name}-")
    atexit.register(shutil.rmtree, local, True)
    return local


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    at, files = _path(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    at, files = _path(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole, by a rename that never replaces one; False if it is there already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at, files = _path(spark, path)
    if files.exists(at):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(at).toUri(), conf)
        context.rename(draft, at, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:
        files.delete(draft, False)
        if files.exists(at):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    at, files = _path(spark, path)
    files.delete(at, True)


def unpublished(spark: SparkSession, root: str, tables: list[str], live: set[str]) -> list[str]:
    """Delete the folders `segment=...` of some tables that aren't live; their names."""
    gone = set()
    for table in tables:
        for name in listed(spark, f"{root}/{table}"):
            if name.startswith("segment=") and name[8:] not in live:
                remove(spark, f"{root}/{table}/{name}")
                gone.add(name[8:])
    return sorted(gone)


class Busy(RuntimeError):
    """Another writer holds the lease, or has taken it over."""


class Lease:
    """One writer at a time, by files in the shared file system.

    Each holder has a number above the one before; the file of a number is
    created once, so of several that try, one gets it. A lease ends when it is
    released or when its time is over; `check` fails once a later number is out,
    so a writer that was away too long cannot publish.
    """

    def __init__(self, spark: SparkSession, folder: str, seconds: int = 3600):
        self.spark, self.folder, self.seconds, self.number = spark, folder.rstrip("/"), seconds, 0

    def _last(self) -> int:
        return max((int(n) for n in listed(self.spark, self.folder) if n.isdigit()), default=0)

    def __enter__(self) -> Lease:
        last = self._last()
        if last and float(read_text(self.spark, f"{self.folder}/{last}")) > time.time() and f"{last}.released" not in listed(self.spark, self.folder):
            raise Busy(f"{self.folder} is held")
        if not create_once(self.spark, f"{self.folder}/{last + 1}", str(time.time() + self.seconds)):
            raise Busy(f"{self.folder} was taken meanwhile")
        self.number = last + 1
        if last > 1:
            remove(self.spark, f"{self.folder}/{last - 1}")
            remove(self.spark, f"{self.folder}/{last - 1}.released")
        return self

    def check(self) -> None:
        if self._last() != self.number or float(read_text(self.spark, f"{self.folder}/{self.number}")) <= time.time():
            raise Busy(f"the lease {self.number} of {self.folder} has ended")

    def __exit__(self, *_) -> None:
        create_once(self.spark, f"{self.folder}/{self.number}.released", "")
