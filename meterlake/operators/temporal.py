"""Versioned tables: intervals, as-of and price joins, SCD2 maintenance. All intervals are half-open [from, to)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.columns import TOTAL, row_hash


def intervalize(log: DataFrame, keys: Sequence[str], at: str = "change_time") -> DataFrame:
    """A change log as versions: valid_from, valid_to (null: open) and is_current. One window over the keys."""
    following = F.lead(at).over(Window.partitionBy(*keys).orderBy(at))
    return log.withColumns({"valid_from": F.col(at), "valid_to": following}).withColumn("is_current", F.col("valid_to").isNull()).drop(at)


def merge_increment(history: DataFrame, batch: DataFrame, keys: Sequence[str], at: str = "change_time") -> DataFrame:
    """History with a batch of changes, late ones too: affected keys are cut into intervals anew, others pass through.

    A change that history has already (same keys, same time) is taken from the batch.
    """
    touched = batch.select(*keys).distinct()
    payload = [c for c in batch.columns if c != at]
    old = history.join(touched, list(keys), "left_semi").withColumn(at, F.col("valid_from")).select(*payload, at, F.lit(0).alias("_new"))
    both = old.unionByName(batch.select(*payload, at, F.lit(1).alias("_new")))
    one = Window.partitionBy(*keys, at).orderBy(F.desc("_new"), F.desc(row_hash(*[F.col(c) for c in payload])))
    fresh = intervalize(both.withColumn("_rn", F.row_number().over(one)).where("_rn = 1").drop("_rn", "_new"), keys, at)
    return history.join(touched, list(keys), "left_anti").unionByName(fresh)


def collapse_unchanged(log: DataFrame, keys: Sequence[str], payload: Sequence[str], at: str = "change_time") -> DataFrame:
    """Drops changes whose payload equals the one before."""
    digest = row_hash(*[F.col(c) for c in payload])
    before = F.lag("_hash").over(Window.partitionBy(*keys).orderBy(at))
    return log.withColumn("_hash", digest).withColumn("_before", before).where(~F.col("_hash").eqNullSafe(F.col("_before"))).drop("_hash", "_before")


def close_and_insert(dim: DataFrame, source: DataFrame, keys: Sequence[str], payload: Sequence[str], at: str = "change_time") -> DataFrame:
    """Closes current rows whose payload differs (null-safe) and inserts the new version; a rerun changes nothing."""
    new = source.select(*keys, *[F.col(c).alias(f"_{c}") for c in payload], F.col(at).alias("_at"))
    joined = dim.join(new, [*keys], "left")
    differs = F.lit(False)
    for c in payload:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    changed = F.coalesce(F.col("is_current") & F.col("_at").isNotNull() & (F.col("_at") > F.col("valid_from")) & differs, F.lit(False))
    closed = joined.withColumn("_changed", changed).select(*keys, *payload, "valid_from", F.when(F.col("_changed"), F.col("_at")).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~F.col("_changed")).alias("is_current"))
    current = closed.where("is_current").select(*keys)
    inserted = source.join(current, [*keys], "left_anti").select(*keys, *payload, F.col(at).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    return closed.unionByName(inserted)


def problems(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key: versions, overlaps, gaps and current rows; sound tables have no overlap and one current row."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    nxt = versions.withColumn("_next", F.lead("valid_from").over(w))
    return nxt.groupBy(*keys).agg(
        F.count("*").alias("versions"),
        F.count_if(F.col("_next").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_next")))).alias("overlaps"),
        F.count_if(F.col("_next").isNotNull() & (F.col("valid_to") < F.col("_next"))).alias("gaps"),
        F.count_if("is_current").alias("current_rows"),
    )


def within(at: Column, start: Column, end: Column) -> Column:
    return (at >= start) & (end.isNull() | (at < end))


def dealt(by: Column, keys: Sequence[Column], absent: Column | None = None) -> Column:
    """The share of a row that joins: 0, or a hash of by for rows that match nothing, which have a null key or an absent one."""
    none = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    return F.when(none if absent is None else none | absent, F.xxhash64(by)).otherwise(F.lit(0).cast("bigint"))


def undealt(keys: Sequence[Column]) -> Column:
    """The share of a row that is joined: always 0. The optimizer takes a literal out of the equi-keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))


def asof_join(facts: DataFrame, versions: DataFrame, keys: dict[str, str], at: Column, keep: Sequence[str], how: str = "left", start: Column | None = None, end: Column | None = None, absent: Column | None = None) -> DataFrame:
    """facts with columns ``keep`` of the version valid at a time; keys: fact column to version column.

    An equi-join on the keys with the interval as residual: versions a key are few, so it plans as a hash or merge join. absent: which facts
    carry a key that stands for none, so that no version has it; they and null keys are dealt by their time, as one task would hold them all.
    The share is one more equi-key, so neither side's exchange is the one of a window or a group before or after: adaptive execution splits
    other hot keys.
    """
    v = versions.select(*[F.col(c).alias(f"_k_{c}") for c in keys.values()], (start if start is not None else F.col("valid_from")).alias("_from"), (end if end is not None else F.col("valid_to")).alias("_to"), *keep)
    on = within(at, v["_from"], v["_to"]) & (dealt(at, [facts[f] for f in keys], absent) == undealt([v[f"_k_{c}"] for c in keys.values()]))
    for f, c in keys.items():
        on = on & (facts[f] == v[f"_k_{c}"])
    return facts.join(v, on, how).drop("_from", "_to", *[f"_k_{c}" for c in keys.values()])


def lookup(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """rows with the columns of table, one row a key there, where it has their key; rows with a null key are dealt by a column of theirs."""
    on = (rows[key] == table[key]) & (dealt(rows[by], [rows[key]]) == undealt([table[key]]))
    return rows.join(table, on, "left").drop(table[key])


PRICE_KEYS = ("sku_name", "usage_unit")


def price_join(usage: DataFrame, prices: DataFrame, how: str = "inner", keys: Sequence[str] = PRICE_KEYS, keep: Sequence[str] = ()) -> DataFrame:
    """usage with price, has_price and cost; how "left" keeps usage without a price at cost 0.

    keys: columns that both have, more than the usual two where accounts have prices of their own; keep: further columns of the price.
    """
    out = asof_join(usage, prices, {k: k for k in keys}, usage["usage_start_time"], ["price", *keep], how, F.col("price_start_time"), F.col("price_end_time"))
    cost = F.coalesce((F.col("usage_quantity") * F.col("price")).cast(TOTAL), F.lit(0).cast(TOTAL))
    return out.withColumns({"has_price": F.col("price").isNotNull(), "cost": cost})


def overlap_join(facts: DataFrame, versions: DataFrame, keys: dict[str, str], start: Column, end: Column, keep: Sequence[str], fact_id: str) -> DataFrame:
    """facts with the latest version whose interval overlaps [start, end); one row a fact."""
    v = versions.select(*[F.col(c).alias(f"_k_{c}") for c in keys.values()], F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *keep)
    on = (v["_from"] < end) & (v["_to"].isNull() | (v["_to"] > start))
    for f, c in keys.items():
        on = on & (facts[f] == v[f"_k_{c}"])
    # One aggregate with a map side instead of a window over the fanned-out rows.
    best = facts.join(v, on).groupBy(fact_id).agg(F.max_by(F.struct(*keep), F.struct("_from", *keep)).alias("_best"))
    return facts.join(best, fact_id, "left").select(*facts.columns, *[F.col(f"_best.{c}").alias(c) for c in keep])


def latest(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row a key: the first in a total order."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")
