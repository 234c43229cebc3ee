"""Structured Streaming forms: available-now runs over a file source whose results equal the batch operators'.

Progress lives in a checkpoint under the folder that ``spark.checkpoint.dir`` names, so a run that loses executors, or
restarts, continues where it was.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import folders
from meterlake.operators.keyed_table import KeyedTable, newest
from meterlake.operators.temporal import latest

LATENESS = "2 days"


def folder(spark: SparkSession) -> str:
    """A new folder for one stream; name it again to go on with that stream."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root or tempfile.mkdtemp(prefix='streams-')}/stream-{uuid.uuid4().hex}"


def written(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The number of the last batch whose table stands whole under path, of those before a batch if one is given.

    It is read from the store, so a new driver finds what an earlier one has written.
    """
    return folders.last_whole(spark, path, before=before)


def last_table(stream: DataFrame, path: str) -> DataFrame:
    """The last batch's table; without any batch an empty one."""
    spark, last = stream.sparkSession, written(stream.sparkSession, path)
    return spark.createDataFrame([], stream.schema) if last is None else spark.read.parquet(f"{path}/{last}")


def events(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The events table as an unbounded file source."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 4).parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def append_now(stream: DataFrame, at: str | None = None) -> DataFrame:
    """Runs an append-mode stream over what there is and reads its files back."""
    at = at or folder(stream.sparkSession)
    query = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{at}/out")


def complete_now(stream: DataFrame, at: str | None = None) -> DataFrame:
    """Runs an aggregation in complete mode; each batch's result is a folder of its own, the last one counts."""
    at = at or folder(stream.sparkSession)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/{number}")

    query = stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return last_table(stream, f"{at}/out")


def upsert_now(stream: DataFrame, keys: list[str], order: list[str], at: str | None = None) -> DataFrame:
    """The newest row a key: every micro-batch is merged into the table of the one before. A replayed batch writes the
    same folder again from the same predecessor, so replays change nothing. The tables lie beside the stream's state, so a run
    with the same ``at`` goes on where the last one ended."""
    spark, at = stream.sparkSession, at or folder(stream.sparkSession)

    def merge(batch: DataFrame, number: int) -> None:
        last = written(spark, f"{at}/table", number)
        rows = batch if last is None else batch.unionByName(spark.read.parquet(f"{at}/table/{last}"))
        latest(rows, keys, *[F.desc(c) for c in order]).write.mode("overwrite").parquet(f"{at}/table/{number}")

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return last_table(stream, f"{at}/table")


def upsert_into(stream: DataFrame, table: KeyedTable, at: str) -> DataFrame:
    """The newest row a key, kept in a bucketed table: a micro-batch rewrites only the buckets that it has rows for.

    Each micro-batch is a commit of the table's feed, of the batch's own number, so a replayed one changes nothing. The table lies where it was
    made; ``at`` holds the stream's progress.
    """

    def take(batch: DataFrame, number: int) -> None:
        table.upsert(newest(batch, table.keys, table.order), number)

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read()


#: Prices hold for so long at most; older usage and prices leave the state.
LONGEST_PRICE = "366 days"


def priced_by_stream(usage: DataFrame, prices: DataFrame, keys: tuple[str, ...] = ("sku_name", "usage_unit"), lateness: str = LATENESS, longest: str = LONGEST_PRICE, how: str = "inner") -> DataFrame:
    """A stream of usage joined with a stream of prices valid at its start; a price that comes late finds the usage that waits for it.

    usage: keys, usage_start_time; prices: keys, price_start_time, price_end_time, price. Both have a watermark, and the join bounds how far usage
    may lie after a price's start, so either side's rows leave the state once the other's watermark has passed them. The month is one more key:
    a price is repeated for each month that it can hold in, and meets the usage of its months only, which tasks share even where keys are few.
    """
    month = lambda at: F.year(at) * 12 + F.month(at)
    starts, ends = month(F.col("price_start_time")), month(F.least("price_end_time", F.expr(f"price_start_time + INTERVAL {longest}")))
    u = usage.withWatermark("usage_start_time", lateness).withColumn("_month", month(F.col("usage_start_time"))).alias("u")
    p = prices.withWatermark("price_start_time", lateness).withColumn("_month", F.explode(F.sequence(starts, F.greatest(starts, ends)))).alias("p")
    on = F.expr(f"u.usage_start_time >= p.price_start_time AND u.usage_start_time <= p.price_start_time + INTERVAL {longest} AND u.usage_start_time < p.price_end_time")
    for k in (*keys, "_month"):
        on = on & (F.col(f"u.{k}") == F.col(f"p.{k}"))
    return u.join(p, on, {"inner": "inner", "left": "leftOuter"}[how]).select(*[F.col(f"u.{c}") for c in usage.columns], "p.price")


def deduplicated(stream: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    return stream.withWatermark(ts, LATENESS).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, ts: str, width: str, *keys: str, **measures) -> DataFrame:
    return stream.withWatermark(ts, LATENESS).groupBy(F.window(ts, width), *keys).agg(*[m.alias(a) for a, m in measures.items()])


def sliding(stream: DataFrame, ts: str, width: str, step: str, *keys: str, **measures) -> DataFrame:
    return stream.withWatermark(ts, LATENESS).groupBy(F.window(ts, width, step), *keys).agg(*[m.alias(a) for a, m in measures.items()])


def sessions(stream: DataFrame, ts: str, gap: str, *keys: str, **measures) -> DataFrame:
    return stream.withWatermark(ts, LATENESS).groupBy(F.session_window(ts, gap), *keys).agg(*[m.alias(a) for a, m in measures.items()])
