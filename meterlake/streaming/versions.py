"""Versions from a stream of changes, with keyed state: what ``temporal.merge_increment`` does batch by batch.

The state of a key is its recent changes: the open version, and those before it that a late change could still cut. A batch's changes are put
among them, and every version whose interval is new or different is emitted, to be upserted by (key, valid_from). So closed
intervals come out once, and again only if a late change cuts them. A change that is older than all that is kept
can't be placed any more: it comes out marked ``too_late``, for ``merge_increment`` on the stored history, and changes nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from meterlake.operators import folders
from meterlake.operators.keyed_table import KeyedTable

#: Changes of a key are kept so long, measured back from its newest one.
KEPT = dt.timedelta(days=365)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def intervals(changes: dict) -> dict:
    """start -> (payload, end) of changes by time; the last one is open."""
    times = sorted(changes)
    return {t: (changes[t], after) for t, after in zip(times, [*times[1:], None])}


class Versions(StatefulProcessor):
    """keys, payload and the time of a change; kept: how long back from its newest change a key can be cut (None: for ever)."""

    def __init__(self, keys: T.StructType, payload: T.StructType, at: T.StructField, kept: dt.timedelta | None) -> None:
        self.keys, self.payload, self.at, self.kept = keys, payload, at, kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        # One list a key, read and written whole: each call is a round trip to the JVM. _cut: older changes have left the state.
        self.changes = handle.getListState("changes", T.StructType([self.at, *self.payload.fields, T.StructField("_cut", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        made = Row(*self.keys.fieldNames(), *self.payload.fieldNames(), "valid_from", "valid_to", "too_late")
        stored = sorted((tuple(r) for r in self.changes.get()), key=lambda r: r[0])
        before = {r[0]: r[1:-1] for r in stored}
        cut = any(r[-1] for r in stored)
        floor = stored[0][0] if cut else None
        fresh: dict = {}
        place = None
        for r in rows:
            if place is None:
                at, place = r.__fields__.index(self.at.name), [r.__fields__.index(c) for c in self.payload.fieldNames()]
            fresh.setdefault(r[at], []).append(tuple(r[i] for i in place))
        late = {t: rows for t, rows in fresh.items() if floor is not None and t < floor}
        # Of changes at one time the batch's counts, of the batch's the one that sorts last, nulls first.
        last = lambda rows: rows[0] if len(rows) == 1 else max(rows, key=lambda p: [(x is not None, "" if x is None else str(x)) for x in p])
        after = before | {t: last(rows) for t, rows in fresh.items() if t not in late}
        old, new = intervals(before), intervals(after)
        for t, version in new.items():
            if old.get(t) != version:
                yield made(*key, *version[0], t, version[1], False)
        for t, rows in late.items():
            yield made(*key, *last(rows), t, None, True)
        kept = sorted(after)
        if self.kept is not None and after:
            bound = kept[-1] - self.kept
            gone = max(sum(t <= bound for t in kept) - 1, 0)  # the last one before the bound may still be cut
            kept, cut = kept[gone:], cut or gone > 0
        if after != before:
            self.changes.put([(t, *after[t], cut) for t in kept])

    def close(self) -> None:
        pass


def session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams with keyed state: they need the RocksDB state store, others keep their own."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    return own


def versions(changes: DataFrame, keys: Sequence[str], at: str = "change_time", kept: dt.timedelta | None = KEPT) -> DataFrame:
    """A stream of changes as a stream of versions to upsert: keys, payload, valid_from, valid_to, too_late."""
    types = changes.schema
    payload = T.StructType([f for f in types.fields if f.name not in (*keys, at)])
    key = T.StructType([types[k] for k in keys])
    moment = T.StructField(at, types[at].dataType)
    out = T.StructType([*key.fields, *payload.fields, T.StructField("valid_from", moment.dataType), T.StructField("valid_to", moment.dataType), T.StructField("too_late", T.BooleanType())])
    of = changes.where(F.col(at).isNotNull()).groupBy(*keys)
    return of.transformWithState(Versions(key, payload, moment, kept), outputStructType=out, outputMode="Update", timeMode="None")


def maintain(stream: DataFrame, table: KeyedTable, at: str) -> DataFrame:
    """Runs a stream of versions() into a table keyed on the keys and valid_from, and gives back its late changes.

    A replayed micro-batch is the same commit of the table. The changes that came too late lie in the folder ``late`` beside the stream's state.
    """

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        table.upsert(batch.where("NOT too_late").drop("too_late"), number)
        batch.where("too_late").drop("too_late", "valid_to").write.mode("overwrite").parquet(f"{at}/late/{number}")
        batch.unpersist()

    query = stream.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    spark, late = table.spark, stream.schema
    kept = T.StructType([f for f in late.fields if f.name not in ("too_late", "valid_to")])
    return spark.read.schema(kept).option("recursiveFileLookup", "true").parquet(f"{at}/late") if folders.exists(spark, f"{at}/late") else spark.createDataFrame([], kept)
