"""File listing through the Hadoop file system, on the driver. Metadata only."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

GZIP_MAGIC = (0x1F, 0x8B)
REQUESTS = 32  # file system calls under way at once


@dataclass(frozen=True)
class SourceFile:
    path: str
    modified: int
    length: int


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _as_file(status) -> SourceFile:
    return SourceFile(
        status.getPath().toString(), status.getModificationTime(), status.getLen()
    )


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, folder: str) -> list[SourceFile]:
    """All files under a folder whatever their names, oldest first."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        found.append(_as_file(it.next()))
    return sorted(found, key=lambda f: (f.modified, f.path))


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, which appears at once or not at all."""
    fs, p = _fs(spark, path)
    fs.createNewFile(p)


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, p = _fs(spark, folder)
    fs.delete(p, True)


def data_folder(spark: SparkSession, base: str) -> str | None:
    """The only data folder under `base`, ignoring loader bookkeeping; None if unclear."""
    found = [f for f in subfolders(spark, base) if not f.startswith("_dlt")]
    return f"{base}/{found[0]}" if len(found) == 1 else None


def is_gzip(spark: SparkSession, path: str) -> bool:
    """Look at the first two bytes; the extension says nothing."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return (stream.read(), stream.read()) == GZIP_MAGIC
    finally:
        stream.close()


def packed_files(spark: SparkSession, files: Iterable[SourceFile]) -> set[str]:
    """Paths of the gzipped files, many looked at together."""
    paths = [f.path for f in files]
    with ThreadPoolExecutor(REQUESTS) as pool:
        return {p for p, packed in zip(paths, pool.map(lambda p: is_gzip(spark, p), paths)) if packed}


def copy_file(spark: SparkSession, source: SourceFile, target: str) -> str:
    """Copy through a small buffer, with the time of the change where the store can set it.

    Returns the full name of the copy, as listings have it."""
    (fs_from, a), (fs_to, b) = _fs(spark, source.path), _fs(spark, target)
    conf = spark._jsc.hadoopConfiguration()
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_from, a, fs_to, b, False, True, conf)
    fs_to.setTimes(b, source.modified, -1)
    return fs_to.makeQualified(b).toString()


def move_unchanged(spark: SparkSession, moves: Iterable[tuple[SourceFile, str]]) -> None:
    """Move files to their targets, but for those that are no longer what was listed.

    Where the target is taken, by an earlier file of the name, the time of the change is added.
    """

    def move(step: tuple[SourceFile, str]) -> None:
        file, target = step
        fs, p = _fs(spark, file.path)
        if not fs.exists(p) or _as_file(fs.getFileStatus(p)) != file:
            return
        q = _fs(spark, target)[1]
        if fs.exists(q):
            q = _fs(spark, f"{target}.{file.modified}")[1]
        fs.mkdirs(q.getParent())
        if not fs.rename(p, q):
            raise OSError(f"cannot move {file.path} to {q.toString()}")

    with ThreadPoolExecutor(REQUESTS) as pool:
        list(pool.map(move, moves))
