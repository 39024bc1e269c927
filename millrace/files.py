"""Names of files and folders, asked of Hadoop's file system: any URI that Spark itself can open."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Folders that are asked at a time whether they hold a file.
REQUESTS = 16


def _opened(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _opened(spark, path)
    return files.exists(target)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether Spark has written ``path`` to the end."""
    return exists(spark, f"{path}/_SUCCESS")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that match a glob, one request per folder that it names with a star."""
    files, target = _opened(spark, pattern)
    return [found.getPath().toString() for found in files.globStatus(target) or ()]


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, ascending; none if it is missing."""
    files, target = _opened(spark, path)
    if not files.exists(target):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(target) if found.isDirectory())


def has_file(spark: SparkSession, path: str) -> bool:
    """Whether a file with a visible name lies right in ``path``; stops at the first one."""
    files, target = _opened(spark, path)
    if not files.exists(target):
        return False
    listed = files.listStatusIterator(target)
    while listed.hasNext():
        found = listed.next()
        if found.isFile() and not found.getPath().getName().startswith(("_", ".")):
            return True
    return False


def filled(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that hold a file, asked some at a time."""
    with ThreadPoolExecutor(REQUESTS) as pool:
        return [path for path, full in zip(paths, pool.map(lambda p: has_file(spark, p), paths), strict=True) if full]


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    files, target = _opened(spark, path)
    return files.getContentSummary(target).getLength()


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, and the folders above it."""
    files, target = _opened(spark, path)
    files.create(target, True).close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens if it is missing."""
    files, target = _opened(spark, path)
    files.delete(target, True)
