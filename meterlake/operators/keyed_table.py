"""A table of unique keys in hash buckets, kept by upserts, with its change feed stored by commit version.

    rows/_bucket=K/            the table; an upsert rewrites the buckets that it touches and no other file
    changes/_commit_version=N/ what commit N changed: insert, update_preimage, update_postimage, delete
    consumers/NAME/N/          that a consumer has taken all changes up to version N

An upsert first writes its changes, found against the rows of the touched buckets, and then applies them to those buckets. A commit
that was cut off is finished by running it again: whole changes are only applied, which may be done any number of times, and
partial ones are found anew from rows that they have not reached. So a replayed batch changes nothing, and no consumer sees half a commit or
misses one. The feed alone gives the table (``rebuilt``), should a store lose a bucket between the two renames of an overwrite.

Null keys are keys. A key that is deleted stays as a marked row, so that a bucket never disappears; ``read`` leaves it out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.columns import row_hash

from . import folders

BUCKETS = 64
#: Changes by which the table's rows are replaced.
LAST_IMAGES = ("insert", "update_postimage", "delete")


class KeyedTable:
    """schema: the columns of the rows. order: columns of which a row must have more than the stored one to replace it (late rows change nothing).

    buckets: fixed when the table is made; so many that one of them fits a task with ease.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, order: Sequence[str] = (), buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path, list(keys), list(order), buckets
        self.columns = [f.name for f in schema.fields]
        self.stored = T.StructType([*schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])
        self.feed = T.StructType([*schema.fields, T.StructField("_change_type", T.StringType()), T.StructField("_bucket", T.IntegerType()), T.StructField("_commit_version", T.LongType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("_bucket")

    def _rows(self, buckets: Iterable[int] | None = None) -> DataFrame:
        if not folders.exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.stored)
        df = self.spark.read.schema(self.stored).parquet(f"{self.path}/rows")
        return df if buckets is None else df.where(F.col("_bucket").isin(*buckets))

    def read(self) -> DataFrame:
        return self._rows().where("NOT _deleted").select(*self.columns)

    def version(self) -> int | None:
        """The last commit; None for a new table."""
        return folders.last_whole(self.spark, f"{self.path}/changes", "_commit_version=")

    def changes(self, after: int = -1, until: int | None = None) -> DataFrame:
        """The changes of commits (after, until], up to the last one by default; only their folders are read."""
        last = self.version()
        if last is None or after >= (last if until is None else until):
            return self.spark.createDataFrame([], self.feed).drop("_bucket")
        of = self.spark.read.schema(self.feed).parquet(f"{self.path}/changes")
        return of.where(f"_commit_version > {after} AND _commit_version <= {last if until is None else min(until, last)}").drop("_bucket")

    # Writing

    def upsert(self, batch: DataFrame, version: int | None = None, deleted: Column | None = None) -> int:
        """Takes a batch in as one commit and returns its version; running the same version again changes nothing.

        batch: the table's columns; keys must be unique, ``newest`` makes them so. deleted: which of its rows delete their keys. A row equal
        to the stored one (by hash) is no change.
        """
        version = (-1 if (v := self.version()) is None else v) + 1 if version is None else version
        at = f"{self.path}/changes/_commit_version={version}"
        if not folders.is_whole(self.spark, at):
            new = batch.select(*self.columns, (deleted if deleted is not None else F.lit(False)).alias("_gone"), self.bucket())
            touched = self._numbers(new)
            self._found(self._rows(touched), new).write.mode("overwrite").parquet(at)
        self._apply(self.spark.read.schema(T.StructType(self.feed.fields[:-1])).parquet(at))
        return version

    def _numbers(self, df: DataFrame) -> list[int]:
        """The buckets that df has rows in: a list no longer than the number of buckets."""
        return sorted(r[0] for r in df.select("_bucket").distinct().collect())

    def _found(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The changes that make old rows into new ones, one to two rows a changed key."""
        row = lambda: F.struct(*self.columns)
        before = old.where("NOT _deleted").select("_bucket", *self.keys, row().alias("_old"))
        after = new.select("_bucket", *self.keys, row().alias("_new"), "_gone")
        # Deleted keys keep their order, so that a late row does not bring them back.
        past = old.where("_deleted").select("_bucket", *self.keys, row().alias("_past")) if self.order else None
        on = lambda a, b: (a["_bucket"] == b["_bucket"]) & self._same(a, b)
        both = after.join(before, on(after, before), "left").select(after["_bucket"], *[after[k] for k in self.keys], "_new", "_gone", "_old")
        wanted = F.lit(True)
        if past is not None:
            both = both.join(past, on(both, past), "left").select(both["_bucket"], "_new", "_gone", "_old", "_past")
            stored = F.coalesce("_old", "_past")
            last = lambda r: F.struct(*[r[c] for c in self.order])
            wanted = stored.isNull() | (last(F.col("_new")) > last(stored))
        payload = [c for c in self.columns if c not in self.keys]
        same = row_hash(*[F.col("_new")[c] for c in payload]) == row_hash(*[F.col("_old")[c] for c in payload])
        change = lambda kind, r: F.struct(F.lit(kind).alias("_change_type"), F.col(r).alias("_row"))
        update = F.array(change("update_preimage", "_old"), change("update_postimage", "_new"))
        none = F.array().cast("array<struct<_change_type:string,_row:" + self._row_type() + ">>")
        kinds = F.when(F.col("_gone"), F.when(F.col("_old").isNotNull(), F.array(change("delete", "_old"))).otherwise(none)).when(F.col("_old").isNull(), F.array(change("insert", "_new"))).when(~same, update).otherwise(none)
        out = both.where(wanted).select("_bucket", F.explode(kinds).alias("_x"))
        return out.select(*[F.col("_x._row")[c].alias(c) for c in self.columns], F.col("_x._change_type").alias("_change_type"), "_bucket")

    def _row_type(self) -> str:
        return T.StructType(self.stored.fields[:-2]).simpleString()

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        on = F.lit(True)
        for k in self.keys:
            on = on & a[k].eqNullSafe(b[k])
        return on

    def _apply(self, changes: DataFrame) -> None:
        images = changes.where(F.col("_change_type").isin(*LAST_IMAGES)).select(*self.columns, (F.col("_change_type") == "delete").alias("_deleted"), "_bucket")
        touched = self._numbers(images)
        if not touched:
            return
        old = self._rows(touched)
        kept = old.join(images, (old["_bucket"] == images["_bucket"]) & self._same(old, images), "left_anti")
        out = kept.unionByName(images).repartition(len(touched), "_bucket").sortWithinPartitions("_bucket", *self.keys)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{self.path}/rows")

    def rebuilt(self) -> DataFrame:
        """The table from its feed alone: the last image of each key, by an aggregate with a map side."""
        images = self.changes().where(F.col("_change_type").isin(*LAST_IMAGES))
        last = images.groupBy(*[F.struct(*self.keys).alias("_key")]).agg(F.max_by(F.struct(*self.columns, "_change_type"), "_commit_version").alias("_last"))
        return last.where("_last._change_type <> 'delete'").select(*[F.col("_last")[c].alias(c) for c in self.columns])

    # Consumers

    def offset(self, consumer: str) -> int:
        """The last version that a consumer has taken; -1 before its first."""
        last = folders.last_whole(self.spark, f"{self.path}/consumers/{consumer}")
        return -1 if last is None else last

    def pending(self, consumer: str) -> tuple[DataFrame, int]:
        """(the changes that a consumer has not taken, the version they reach to); commit that version once they are worked off."""
        last = self.version()
        until = -1 if last is None else last
        return self.changes(self.offset(consumer), until), until

    def commit(self, consumer: str, until: int) -> None:
        """Stores a consumer's own offset; it never moves back, and no other consumer's moves at all."""
        if until > self.offset(consumer):
            self.spark.range(0).write.mode("overwrite").parquet(f"{self.path}/consumers/{consumer}/{until}")

    def reset(self, consumer: str) -> None:
        """Lets a consumer begin again from the first commit."""
        folders.delete(self.spark, f"{self.path}/consumers/{consumer}")


def newest(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key, the last by its order columns, then by the others; an aggregate with a map side, as keys may be hot."""
    rest = [c for c in batch.columns if c not in keys]
    best = batch.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in batch.columns])
