"""Files written and mirrored whole: a reader sees the old file or the new one.

Paths may be of any file system that Arrow knows. Contents go from storage to
storage in the tasks that copy them; only paths and digests of blocks pass
through Spark. Files of which a mirror has an older version are compared by
blocks, which are dealt over the tasks whatever files they are of, and only
blocks that differ are read for the copy.
"""

from __future__ import annotations

import posixpath
import shutil
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

#: Bytes of a block.
BLOCK = 4 << 20
#: Microseconds by which a mirror may be older without being compared.
SLACK = 2_000_000
#: Failures in a row after which a task tries no more files: its target has gone.
MAX_ERRORS = 5


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _placed(path: str, fill) -> None:
    """Fill a file beside the path, and move it there when it is whole."""
    store, name = _at(path)
    folder, base = posixpath.split(name)
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{base}.part"
    try:
        with store.open_output_stream(part) as out:
            size = fill(out)
        if store.get_file_info(part).size != size:
            raise OSError(f"short write of {path}")
        store.move(part, name)
    except BaseException:
        if store.get_file_info(part).type is fs.FileType.File:
            store.delete_file(part)
        raise


def write_whole(path: str, content: str) -> None:
    data = content.encode("utf-8", "surrogatepass")
    _placed(path, lambda out: out.write(data))


def copy_whole(source: str, target: str) -> None:
    store, name = _at(source)

    def fill(out) -> int:
        with store.open_input_stream(name) as read:
            shutil.copyfileobj(read, out, 1 << 20)
        return store.get_file_info(name).size

    _placed(target, fill)


def patch_whole(source: str, target: str, blocks: list[int] | None, mtime: int, size: int = BLOCK) -> None:
    """Copy a file that differs from its target in some blocks; the others are read from the target.

    It is copied whole without blocks, or where the source has another time
    (microseconds, of which files keep thousands) than when it was compared.
    """
    store, name = _at(source)
    info = store.get_file_info(name)
    if blocks is None or info.mtime_ns is None or info.mtime_ns // 1_000_000 != mtime // 1000:
        copy_whole(source, target)
        return
    there, old = _at(target)
    differ = set(blocks)

    def fill(out) -> int:
        with store.open_input_file(name) as new, there.open_input_file(old) as kept:
            for block in range(-(-info.size // size)):
                read = new if block in differ else kept
                read.seek(block * size)
                out.write(read.read(size))
        return info.size

    _placed(target, fill)


def _each(rows: DataFrame, columns: list[str], act) -> DataFrame:
    """(path, error) of what `act` does with some columns of each row, the first of which names it; the error is null where it went well."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = 0
        for part in parts:
            told = []
            for values in zip(*(part[c] for c in columns), strict=True):
                error = f"not tried after {MAX_ERRORS} failures in a row"
                if failed < MAX_ERRORS:
                    try:
                        act(*values)
                        error, failed = None, 0
                    except OSError as e:
                        error, failed = f"{type(e).__name__}: {e}", failed + 1
                told.append(error)
            yield pd.DataFrame({"path": part[columns[0]], "error": pd.Series(told, dtype=object)})

    return rows.select(*columns).mapInPandas(run, "path string, error string")


def written(files: DataFrame) -> DataFrame:
    """Write files (path, content); (path, error) of each. A task that is run again writes the same files again."""
    return _each(files, ["path", "content"], write_whole)


def mirrored(files: DataFrame, target: Column) -> DataFrame:
    """Copy files (path), the stale ones of a mirror, to `target`; (path, error) of each.

    After `MAX_ERRORS` failures in a row a task leaves the rest untried.
    """
    return _each(files.withColumn("_target", target), ["path", "_target"], copy_whole)


def fingerprints(files: DataFrame, size: int = BLOCK) -> DataFrame:
    """(name, block, digest) of the blocks of files (name, path, size); an empty file has one.

    A block that can't be read has a null digest. Blocks are dealt over the
    tasks, so that a large file is not read by one.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            digests = []
            for path, block in zip(part["path"], part["block"], strict=True):
                store, name = _at(path)
                try:
                    with store.open_input_file(name) as read:
                        read.seek(block * size)
                        digests.append(xxh3_128_hexdigest(read.read(size)))
                except OSError:
                    digests.append(None)
            yield pd.DataFrame({"name": part["name"], "block": part["block"], "digest": pd.Series(digests, dtype=object)})

    last = F.expr(f"greatest((size + {size - 1}) div {size}, 1L) - 1")
    each = files.select("name", "path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"))
    return each.repartition("path", "block").mapInPandas(run, "name string, block bigint, digest string")


def changed_blocks(ours: DataFrame, theirs: DataFrame, key: str = "name") -> DataFrame:
    """(key, blocks): the blocks of each of our files, in order, that theirs lacks or has with another digest; files without any have no row.

    Both hold (key, block, digest); a null digest differs from all.
    """
    there = theirs.select(key, "block", F.col("digest").alias("_digest"))
    same = F.coalesce(F.col("digest") == F.col("_digest"), F.lit(False))
    return ours.join(there, [key, "block"], "left").where(~same).groupBy(key).agg(F.sort_array(F.collect_list("block")).alias("blocks"))


def changes(files: DataFrame, there: DataFrame, slack: int = SLACK, size: int = BLOCK) -> DataFrame:
    """Files (name, path, size, mtime) that a mirror lacks or has otherwise, with the `blocks` to copy; null if it lacks the file.

    `there` holds the mirror's files with the same columns. Files of one size
    are compared if the mirror's is older by more than `slack` microseconds:
    those with equal blocks are left out, whatever their time. Of a file of
    another size only the blocks that differ are named, perhaps none.
    """
    old = there.select("name", F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    stale = files.join(old, "name", "left").where(f"_path is null or _size <> size or _mtime + {slack} < mtime")
    held = stale.where("_path is not null")
    ours, theirs = held.select("name", "path", "size"), held.select("name", F.col("_path").alias("path"), F.col("_size").alias("size"))
    found = stale.join(changed_blocks(fingerprints(ours, size), fingerprints(theirs, size)), "name", "left")
    found = found.where("_path is null or _size <> size or blocks is not null")
    named = F.when(F.col("_path").isNotNull(), F.coalesce("blocks", F.array().cast("array<bigint>")))
    return found.select("name", "path", "size", "mtime", named.alias("blocks"))


def patched(files: DataFrame, target: Column, size: int = BLOCK) -> DataFrame:
    """Bring what `changes` found to `target`, a column of paths; (path, error) of each, as `mirrored` gives."""
    act = lambda path, to, blocks, mtime: patch_whole(path, to, blocks, mtime, size)
    return _each(files.withColumn("_target", target), ["path", "_target", "blocks", "mtime"], act)
