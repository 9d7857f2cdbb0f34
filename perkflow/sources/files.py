"""File operations on whatever file system a path belongs to."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, name: str) -> str:
    """The path with the file system that Spark takes it to be on."""
    return _system(spark, name).makeQualified(_path(spark, name)).toString()


def delete(spark: SparkSession, name: str) -> None:
    """Remove a file or folder if it is there."""
    _system(spark, name).delete(_path(spark, name), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder a new name, which must be free."""
    system = _system(spark, target)
    if system.exists(_path(spark, target)) or not system.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def make_folder(spark: SparkSession, name: str) -> None:
    _system(spark, name).mkdirs(_path(spark, name))


def entries(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder with the second they were last changed; nothing if it is missing."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in system.listStatus(_path(spark, folder))}


def size(spark: SparkSession, name: str) -> int:
    """Bytes of a file or of all files below a folder; 0 if it is missing."""
    system = _system(spark, name)
    if not system.exists(_path(spark, name)):
        return 0
    return system.getContentSummary(_path(spark, name)).getLength()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a file or folder in the place of another one.

    The old one is renamed aside and removed last, so `target` lacks for two renames only, and comes
    back if the second one fails.
    """
    system, aside = _system(spark, target), f"{target}.{uuid4().hex}.old"
    had = system.exists(_path(spark, target))
    if had and not system.rename(_path(spark, target), _path(spark, aside)):
        raise OSError(f"cannot rename {target} to {aside}")
    try:
        done = system.rename(_path(spark, source), _path(spark, target))
    except Exception as problem:
        done = False
        reason = problem
    else:
        reason = None
    if not done:
        if had:
            system.rename(_path(spark, aside), _path(spark, target))
        raise OSError(f"cannot rename {source} to {target}") from reason
    if had:
        delete(spark, aside)
