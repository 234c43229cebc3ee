"""As-of joins for long histories: by time buckets, and by merging.

``temporal.asof_join`` lets a key's facts meet all of its versions, which is right while versions are few. Here a fact meets at most the
versions of its own stretch of time (``asof_join_bucketed``), or none at all: facts and versions are sorted together once and the last
version is carried forward (``asof_merge``). Both give exactly the rows of the plain join. Null keys and null times match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sizes import BROADCAST_ROWS
from .temporal import dealt, undealt, within

#: Versions that a bucket of a long history holds on average.
PER_BUCKET = 256
#: Width of the stretches of time that are merged apart, in microseconds: 30 days.
STRETCH = 30 * 24 * 3600 * 1_000_000


def ticks(df: DataFrame, at: Column) -> Column:
    """A point in time as a whole number: microseconds of a timestamp, days of a date, a number as it is."""
    kind = df.select(at.alias("at")).schema["at"].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), at)
    if isinstance(kind, T.DateType):
        return F.unix_date(at).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return at.cast("bigint")
    raise TypeError(f"no points in time: {kind.simpleString()}")


def bucket_size(counts: DataFrame, per_bucket: int) -> tuple[int, bool]:
    """How many versions (_n of counts, one row a key) a bucket holds, and whether the list of longer keys can be broadcast.

    Without a broadcast every fact would be shuffled once more, to learn its bucket. So the size is doubled while the list is too large, but never
    beyond PER_BUCKET, which is still few versions for a fact to meet.
    """
    sizes = [per_bucket]
    while sizes[-1] < PER_BUCKET:
        sizes.append(min(2 * sizes[-1], PER_BUCKET))
    longer = counts.agg(*[F.count_if(F.col("_n") > size) for size in sizes]).first()
    fit = [size for size, keys in zip(sizes, longer) if keys <= BROADCAST_ROWS]
    return (fit[0], True) if fit else (per_bucket, False)


def asof_join_bucketed(facts: DataFrame, versions: DataFrame, keys: dict[str, str], at: Column, keep: Sequence[str], how: str = "left", start: Column | None = None, end: Column | None = None, per_bucket: int = PER_BUCKET, absent: Column | None = None) -> DataFrame:
    """``temporal.asof_join`` with a time bucket in the equi-key.

    The history of a key with more than per_bucket versions is cut into even stretches of time, one for every per_bucket versions; a version is
    repeated in each stretch that it touches, which adds at most one row a stretch: the versions grow by a 1/per_bucket-th. Other keys have
    one bucket, so short histories are neither repeated nor cut. Which keys are long is known from one count a key, at most a
    1/per_bucket-th of the versions. The list is counted before it is broadcast; where it is too large a bucket holds more (bucket_size), and only
    if that doesn't help it is joined by shuffle. absent: as there.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    first, after = start if start is not None else F.col("valid_from"), end if end is not None else F.col("valid_to")
    v = versions.select(*[F.col(c).alias(n) for n, c in zip(names, keys.values())], first.alias("_from"), after.alias("_to"), *keep)
    v = v.withColumns({"_lo": ticks(v, F.col("_from")), "_hi": ticks(v, F.col("_to"))}).where("_hi IS NULL OR _hi > _lo")
    span = F.max("_lo") - F.min("_lo")  # of the starts: ends may be far in the future
    counts = v.groupBy(*names).agg(F.count("*").alias("_n"), F.min("_lo").alias("_origin"), span.alias("_span"))
    most, listed = bucket_size(counts, per_bucket)
    n = F.ceil(F.col("_n") / most)
    long = counts.where(F.col("_n") > most).select(*names, "_origin", (F.floor(F.col("_span") / n) + 1).alias("_width"), (n - 1).alias("_last"))
    long = F.broadcast(long) if listed else long
    bucket = lambda t: F.least(F.floor((t - F.col("_origin")) / F.col("_width")), F.col("_last"))
    cut = v.join(long, names, "left")
    stretches = F.sequence(F.coalesce(bucket(F.col("_lo")), F.lit(0)), F.coalesce(bucket(F.col("_hi") - 1), F.col("_last"), F.lit(0)))
    cut = cut.select(*names, "_from", "_to", *keep, F.explode(stretches).alias("_bucket"))
    mine = long.select(*[F.col(n).alias(f"{n}f") for n in names], "_origin", "_width", "_last")
    share = dealt(at, [facts[f] for f in keys], absent)
    of = facts.join(mine, reduce(lambda a, b: a & b, [facts[f] == mine[f"{n}f"] for f, n in zip(keys, names)], share == undealt([mine[f"{n}f"] for n in names])), "left")
    of = of.select(*[facts[c] for c in facts.columns], at.alias("_at"), F.when(F.col("_origin").isNull(), share).otherwise(bucket(ticks(facts, at))).alias("_at_bucket"))
    on = (of["_at_bucket"] == cut["_bucket"]) & within(of["_at"], cut["_from"], cut["_to"])
    for f, name in zip(keys, names):
        on = on & (of[f] == cut[name])
    return of.join(cut, on, how).drop("_at", "_at_bucket", "_bucket", "_from", "_to", *names)


def asof_merge(facts: DataFrame, versions: DataFrame, keys: dict[str, str], at: Column, keep: Sequence[str], start: Column | None = None, end: Column | None = None, until: Column | None = None, inclusive: bool = True, stretch: int = STRETCH, absent: Column | None = None) -> DataFrame:
    """facts with columns ``keep`` of the last version of their keys that starts at or before a time (inclusive=False: before it).

    until: the version must also end after this time, else the columns are null; of versions that do not overlap, the last one is the only one
    that can. A version without end (null) is open; end is only read where until is given.

    Facts and versions are united and sorted once by key and time; the last version so far is carried to each fact, so the work is in
    proportion to facts plus versions, whatever the history's length. A key may hold any share of the rows: it is merged in stretches of
    time, each opened by the last version before it. Those come from one version a key and stretch, pre-aggregated. Facts with
    a null key or time pass by; absent ones (as in ``temporal.asof_join``) are dealt by their time. Of versions that start together the one
    that sorts last by its columns counts. The facts' columns stay apart, so that those which are not asked for are never built.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    first = start if start is not None else F.col("valid_from")
    after = end if end is not None else F.col("valid_to") if until is not None else first
    v = versions.select(*[F.col(c).alias(n) for n, c in zip(names, keys.values())], ticks(versions, first).alias("_t"), F.struct(F.struct(*keep).alias("row"), after.alias("end")).alias("_v"))
    v = v.where(F.col("_t").isNotNull()).withColumn("_b", F.floor(F.col("_t") / stretch))
    columns = {c: f"_f{i}" for i, c in enumerate(facts.columns)}
    share = dealt(at, [facts[f] for f in keys], absent)
    f = facts.select(*[facts[c].alias(n) for n, c in zip(names, keys)], ticks(facts, at).alias("_t"), *[facts[c].alias(n) for c, n in columns.items()], (until if until is not None else F.lit(None)).alias("_until"), share.alias("_share"))
    f = f.withColumn("_b", F.floor(F.col("_t") / stretch))
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in [*names, "_t"]])
    inside, aside = f.where(known), f.where(~known)
    # The last version before each stretch that has facts.
    latest = v.groupBy(*names, "_b").agg(F.max(F.struct("_t", "_v"))["_v"].alias("_v"))
    asked = inside.where("_share = 0").select(*names, "_b").distinct().withColumn("_v", F.lit(None).cast(v.schema["_v"].dataType))
    before = Window.partitionBy(*names).orderBy("_b", "_is_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening = asked.withColumn("_is_version", F.lit(0)).unionByName(latest.withColumn("_is_version", F.lit(1))).withColumn("_v", F.last("_v", ignorenulls=True).over(before))
    opening = opening.where("_is_version = 0 AND _v IS NOT NULL").select(*names, "_b", (F.col("_b") * stretch).alias("_t"), "_v", F.lit(-1).alias("_order"))
    of_versions = {"_share": F.lit(0).cast("bigint"), "_is_fact": F.lit(False)}
    rows = [opening.withColumns(of_versions), v.withColumns({"_order": F.lit(0), **of_versions}), inside.withColumns({"_order": F.lit(1 if inclusive else -1), "_is_fact": F.lit(True)})]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    # A fact at the very start of its stretch comes after the opening version, whatever its order.
    order = [F.col("_t"), F.col("_order"), F.col("_is_fact"), F.col("_v")]
    carried = F.last("_v", ignorenulls=True).over(Window.partitionBy(*names, "_b", "_share").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = both.withColumn("_v", carried).where("_is_fact")
    out = merged.select(*columns.values(), "_until", "_v").unionByName(aside.select(*columns.values(), "_until"), allowMissingColumns=True)
    fits = F.col("_v").isNotNull() if until is None else F.col("_v").isNotNull() & (F.col("_v.end").isNull() | (F.col("_v.end") > F.col("_until")))
    return out.select(*[F.col(n).alias(c) for c, n in columns.items()], *[F.when(fits, F.col(f"_v.row.{c}")).alias(c) for c in keep])
