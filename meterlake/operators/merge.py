"""Upserts on plain tables: each returns the new table as a DataFrame, built from joins on null-safe keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys; it still plans as an equi-join."""
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def upsert_with_feed(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str = "row_hash") -> DataFrame:
    """The hash-guarded upsert, with the feed in one pass: rows of the new table and their _change_type.

    unchanged: not in the source, or of equal hash; update_postimage: its hash differs, all columns and the hash are
    taken; insert: new. One full outer join on the keys. Source keys must be unique.
    """
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in target.columns], F.lit(True).alias("_in_s"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}"))
    both = t.join(s, on, "full_outer")
    differs = ~F.col(f"_t_{hash_col}").eqNullSafe(F.col(f"_s_{hash_col}"))
    kind = F.when(F.col("_in_t").isNull(), "insert").when(F.col("_in_s").isNotNull() & differs, "update_postimage").otherwise("unchanged")
    both = both.withColumn("_change_type", kind)
    take = lambda c: F.when(F.col("_change_type") == "unchanged", F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c)
    return both.select(*[take(c) for c in target.columns], "_change_type")


def upsert_guarded(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str = "row_hash") -> DataFrame:
    return upsert_with_feed(target, source, keys, hash_col).drop("_change_type")


def change_feed(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str = "row_hash") -> DataFrame:
    return upsert_with_feed(target, source, keys, hash_col).where("_change_type <> 'unchanged'")


def upsert_all(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type 1: every source row replaces the target's row of its keys."""
    return target.join(source, same_key(target, source, keys), "left_anti").unionByName(source)


def upsert_keep_surrogate(target: DataFrame, source: DataFrame, keys: Sequence[str], surrogate: str, new_key: Column) -> DataFrame:
    """Attributes from the source, the surrogate from the target where it has one, else new_key over the source."""
    payload = [c for c in target.columns if c not in {*keys, surrogate}]
    fresh = source.select(*keys, *payload).withColumn("_new", new_key)
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *[F.col(c).alias(f"_t_{c}") for c in payload], F.col(surrogate).alias("_old"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_t_{k}").eqNullSafe(fresh[k])
    both = t.join(fresh, on, "full_outer")
    has_source = F.col("_new").isNotNull()
    take = lambda c: F.when(has_source, F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c)
    return both.select(*[take(c) for c in (*keys, *payload)], F.coalesce("_old", "_new").alias(surrogate))


def append_evolving(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def rewrite_partitions(target: DataFrame, increment: DataFrame, by: str) -> DataFrame:
    """The target with the partitions that the increment touches replaced by it; others pass through."""
    return target.join(increment.select(by).distinct(), by, "left_anti").unionByName(increment)


def write_partitions(df: DataFrame, path: str, *by: str, sort: Sequence[str] = (), tasks: int | None = None) -> None:
    """Dynamic partition overwrite: only partitions present in df are replaced, by one file each.

    tasks: how many write side by side; by default as many as the rows' size asks for, few for many small partitions.
    """
    dealt = df.repartition(tasks, *by) if tasks else df.repartition(*by)
    dealt.sortWithinPartitions(*by, *sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
