"""Numbered folders of finished writes, in whatever store they lie."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has ended."""
    where, store = _store(spark, f"{path}/_SUCCESS")
    return store.exists(where)


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _store(spark, path)
    return store.exists(where)


def last_whole(spark: SparkSession, path: str, prefix: str = "", before: int | None = None) -> int | None:
    """The highest number of the finished folders path/prefixN, of those below ``before`` if that is given."""
    where, store = _store(spark, path)
    if not store.exists(where):
        return None
    names = [x.getPath().getName() for x in store.listStatus(where)]
    numbers = [int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit()]
    return max((n for n in numbers if (before is None or n < before) and is_whole(spark, f"{path}/{prefix}{n}")), default=None)


def delete(spark: SparkSession, path: str) -> None:
    where, store = _store(spark, path)
    store.delete(where, True)
