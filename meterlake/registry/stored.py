"""Long histories, tables kept by upserts with their stored feed, keyed streaming state, sketches, files of differing schemas.

Queries over stored tables and streams run when they are called: they write tables of their own into the shared folder, and return what those hold.
"""

from __future__ import annotations

from functools import partial
from pathlib import Path

from pyspark import pipelines as dp
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import columns as c
from meterlake.operators import asof, sketches
from meterlake.operators import merge as up
from meterlake.operators import quality as dq
from meterlake.operators import schema as sch
from meterlake.operators import temporal as t
from meterlake.operators.keyed_table import KeyedTable
from meterlake.plans import declared
from meterlake.plans import facts as p
from meterlake.sources.model import Model
from meterlake.streaming import streams as st
from meterlake.streaming import versions as vs

from .base import TEXTS, query
from .core import _HASH, _RESULTS, _SCD, _STATUS, ENTITY, _checked, _new, _old, _rules

#: Versions that a bucket holds in these queries; small, so that histories of the test tables are cut too.
FEW = 4

# As-of joins for long histories


def same_as(name: str) -> str:
    """The SQL of an earlier query that gives the same rows by another plan."""
    return TEXTS[name]


_ENTITY_KEYS = {"entity_type": "entity_type", "entity_id": "entity_id"}


def _entities(m: Model) -> DataFrame:
    return p.dim_entity(m).select(*ENTITY, "valid_from", "valid_to", F.col("name").alias("entity_name"), F.col("valid_from").alias("entity_from"))


@query(same_as("join_asof_scd2"))
def join_asof_bucketed(m: Model) -> DataFrame:
    """Usage with the entity version of its start, by key and time bucket: a long history is cut, so no key holds all of it."""
    u = p.silver_usage(m)
    return asof.asof_join_bucketed(u, _entities(m), _ENTITY_KEYS, u["usage_start_time"], ["entity_name", "entity_from"], per_bucket=FEW, absent=p.no_entity(u)).select("record_id", "entity_name", "entity_from")


@query(same_as("join_asof_scd2"))
def join_asof_merged(m: Model) -> DataFrame:
    """The same by one sort of usage and versions together."""
    u = p.silver_usage(m)
    out = asof.asof_merge(u, _entities(m), _ENTITY_KEYS, u["usage_start_time"], ["entity_name", "entity_from"], until=u["usage_start_time"], absent=p.no_entity(u))
    return out.select("record_id", "entity_name", "entity_from")


@query(same_as("join_asof_datekey"))
def join_asof_datekey_bucketed(m: Model) -> DataFrame:
    cost = p.entity_cost(m)
    out = asof.asof_join_bucketed(cost, p.dim_entity(m), _ENTITY_KEYS, cost["date_key"], ["name"], "left", c.date_key(F.col("valid_from")), c.date_key(F.col("valid_to")), FEW, absent=p.no_entity(cost))
    return out.select("date_key", "workspace_id", "entity_type", "entity_id", "name")


@query(same_as("join_asof_hour_trunc"))
def join_asof_hour_bucketed(m: Model) -> DataFrame:
    facts, hour = p.priced(m), lambda x: F.date_trunc("hour", F.col(x)).cast("timestamp_ntz")
    keep = ["cluster_name", "runtime_version", "worker_node_type"]
    out = asof.asof_join_bucketed(facts, p.dim_cluster(m), {"cluster_id": "cluster_id"}, facts["usage_start_time"], keep, "left", hour("valid_from"), hour("valid_to"), FEW)
    return out.select("record_id", *keep)


@query(same_as("join_interval_overlap"))
def join_overlap_merged(m: Model) -> DataFrame:
    """Runs with the latest version that overlaps them: the last to start before their end, if it lasts beyond their start."""
    r = m.runs()
    return asof.asof_merge(r, p.dim_entity(m), {"job_id": "entity_id"}, r["end_time"], ["name"], until=r["start_time"], inclusive=False).select("run_id", "name")


@query(same_as("fact_usage_priced"))
def fact_usage_long_histories(m: Model) -> DataFrame:
    """The priced usage fact where definitions change often: entities and clusters are joined by time buckets."""
    join = partial(asof.asof_join_bucketed, per_bucket=FEW)
    columns = ["record_id", "date_key", "workspace_id", "workspace_name", "entity_type", "entity_id", "entity_name", "cluster_id", "cluster_name", "sku_name", "usage_unit", "sku_from", "usage_quantity", "price", "cost"]
    return p.usage_fact(m, join=join).select(*columns)


# Tables kept by upserts

ORDER_ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("priority", T.StringType())])


def _table(m: Model, name: str = "orders") -> KeyedTable:
    return KeyedTable(m.spark, f"{st.folder(m.spark)}/{name}", ["id"], ORDER_ROWS, buckets=16)


def _three_commits(m: Model, table: KeyedTable):
    """Commits 0 to 2, one after another: the old rows, the new ones, and that a tenth of the keys is deleted."""
    rows = lambda df: df.select("id", "status", "priority")
    for batch, gone in ((rows(_old(m)), None), (rows(_new(m)), None), (rows(_new(m)).where("id % 10 = 9"), F.lit(True))):
        yield table.upsert(batch, deleted=gone)


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, o_orderpriority AS priority, {_HASH} AS row_hash FROM orders WHERE o_orderkey % 10 <> 9")
def table_bucketed_upserts(m: Model) -> DataFrame:
    """A table in hash buckets after three commits, each run twice: only touched buckets are rewritten, and a replay changes nothing."""
    table = _table(m)
    for version in _three_commits(m, table):
        table.upsert(table.read().limit(0), version)
    return table.read().withColumn("row_hash", c.row_hash(F.col("status"), F.col("priority")))


_CHANGED = "o_orderkey % 10 BETWEEN 4 AND 6 AND o_orderkey % 3 = 0 AND o_orderstatus <> 'X'"


@query(f"""SELECT o_orderkey AS id, {_STATUS} AS status, 'insert' AS _change_type, 1::BIGINT AS _commit_version FROM orders WHERE o_orderkey % 10 >= 7
UNION ALL SELECT o_orderkey, o_orderstatus, 'update_preimage', 1 FROM orders WHERE {_CHANGED} UNION ALL SELECT o_orderkey, 'X', 'update_postimage', 1 FROM orders WHERE {_CHANGED}
UNION ALL SELECT o_orderkey, {_STATUS}, 'delete', 2 FROM orders WHERE o_orderkey % 10 = 9""")
def feed_stored_changes(m: Model) -> DataFrame:
    """The stored feed of commits (0, 2], read by their folders."""
    table = _table(m)
    list(_three_commits(m, table))
    return table.changes(0, 2).select("id", "status", "_change_type", "_commit_version")


_COUNTED = f"""SELECT 0::BIGINT AS _commit_version, 'insert' AS _change_type, count(*) AS n FROM orders WHERE o_orderkey % 10 < 7 UNION ALL SELECT 1, 'insert', count(*) FROM orders WHERE o_orderkey % 10 >= 7
UNION ALL SELECT 1, k, count(*) FROM orders, (SELECT unnest(['update_preimage', 'update_postimage']) AS k) WHERE {_CHANGED} GROUP BY k UNION ALL SELECT 2, 'delete', count(*) FROM orders WHERE o_orderkey % 10 = 9"""


@query(f"SELECT consumer, x.* FROM ({_COUNTED}) x, (SELECT unnest(['prompt', 'lagging']) AS consumer) WHERE n > 0")
def feed_consumers(m: Model) -> DataFrame:
    """Two consumers with their own offsets, one after every commit, one two commits late: both get every change, once."""
    table, taken = _table(m), []
    for version in _three_commits(m, table):
        for consumer in ["prompt"] if version == 1 else ["prompt", "lagging"]:
            changes, until = table.pending(consumer)
            taken.append(changes.select(F.lit(consumer).alias("consumer"), "_commit_version", "_change_type"))
            table.commit(consumer, until)
    rows = taken[0]
    for more in taken[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("consumer", "_commit_version", "_change_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def stream_upsert_buckets(m: Model) -> DataFrame:
    """The newest event a user, by a stream whose micro-batches rewrite the buckets that they touch."""
    at, e = st.folder(m.spark), st.events(m.spark, m.sf_dir).select("user_id", "event_id", "event_type")
    return st.upsert_into(e, KeyedTable(m.spark, f"{at}/table", ["user_id"], e.schema, ["event_id"]), at)


# Keyed state, and two streams


@query(_SCD)
def stream_scd2_versions(m: Model) -> DataFrame:
    """Versions kept by a stream with keyed state, over a log that comes in three parts with late changes in each.

    Changes that are too old for the state are merged into the stored history, which makes it exact however late a change is.
    """
    at, log = st.folder(m.spark), m.entity_log()
    for k in range(3):
        log.where(F.pmod(F.xxhash64(*ENTITY, "change_time"), F.lit(3)) == k).write.mode("append").parquet(f"{at}/log")
    stream = vs.session(m.spark).readStream.schema(log.schema).parquet(f"{at}/log")
    changes = vs.versions(stream, ENTITY)
    table = KeyedTable(m.spark, f"{at}/versions", [*ENTITY, "valid_from"], T.StructType([f for f in changes.schema.fields if f.name != "too_late"]))
    late = vs.maintain(changes, table, at).withColumnRenamed("valid_from", "change_time")
    history = table.read().withColumn("is_current", F.col("valid_to").isNull())
    return t.merge_increment(history, late, ENTITY).select(*ENTITY, "name", "run_as", "valid_from", "valid_to", "is_current")


@query("SELECT record_id, price, (usage_quantity * price)::DECIMAL(28,6) AS cost FROM m_priced")
def stream_price_stream_join(m: Model) -> DataFrame:
    """Usage and prices both as streams, joined within the time that a price holds."""
    at, spark = st.folder(m.spark), m.spark
    usage, prices = m.usage().select("record_id", "sku_name", "usage_unit", "usage_quantity", F.col("usage_start_time").cast("timestamp").alias("usage_start_time")), m.prices()
    stamped = prices.withColumns({k: F.col(k).cast("timestamp") for k in ("price_start_time", "price_end_time")})
    for name, df in (("usage", usage), ("prices", stamped)):
        df.write.parquet(f"{at}/{name}")
    stream = lambda name, df: spark.readStream.schema(df.schema).parquet(f"{at}/{name}")
    out = st.append_now(st.priced_by_stream(stream("usage", usage), stream("prices", stamped)), at)
    return out.select("record_id", "price", (F.col("usage_quantity") * F.col("price")).cast(c.TOTAL).alias("cost"))


# Sketches


@query("SELECT task_key, strftime(start_time, '%Y%m')::INTEGER AS month_key, count(*) AS n_tasks, true AS p50_ok, true AS p90_ok, true AS p99_ok FROM m_tasks GROUP BY 1, 2")
def task_latency_sketches(m: Model) -> DataFrame:
    """Latency quantiles a month, from one stored sketch a task and day, each held against the exact ranks."""
    at = st.folder(m.spark)
    tasks = p.silver_tasks(m).withColumn("month_key", F.expr("date_key div 100"))
    sketches.sketched(tasks, ["task_key", "date_key"], "seconds").write.parquet(f"{at}/days")
    months = sketches.merged(m.spark.read.parquet(f"{at}/days").withColumn("month_key", F.expr("date_key div 100")), ["task_key", "month_key"])
    wanted = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    found = sketches.quantiles(months, **wanted)
    counted = tasks.groupBy("task_key", "month_key", "seconds").agg(F.count("*").alias("k"))
    both = found.join(counted, ["task_key", "month_key"])
    share = lambda q, op: F.sum(F.when(op(F.col("seconds"), F.col(q)), F.col("k")).otherwise(0)) / F.first("n")
    ok = lambda q, x: ((share(q, lambda a, b: a < b) <= x + sketches.RANK_ERROR) & (share(q, lambda a, b: a <= b) >= x - sketches.RANK_ERROR)).alias(f"{q}_ok")
    return both.groupBy("task_key", F.col("month_key").cast("int").alias("month_key")).agg(F.first("n").alias("n_tasks"), *[ok(q, x) for q, x in wanted.items()])


# Declared pipeline


@query("SELECT product, count(*) AS n_records, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_priced WHERE usage_quantity > 0 GROUP BY 1")
def declared_tables(m: Model) -> DataFrame:
    """A declared dataflow graph: a source view, a view over it and a materialised view, refreshed by Spark's pipeline engine."""

    def declare(graph: declared.Graph) -> None:
        @dp.temporary_view(name="bronze")
        def bronze() -> DataFrame:
            return p.priced(m).select("record_id", "product", "usage_quantity", "cost")

        graph.register_sql(f"CREATE TEMPORARY VIEW silver AS SELECT * FROM bronze WHERE usage_quantity > 0; CREATE MATERIALIZED VIEW gold AS SELECT product, count(*) AS n_records, CAST(sum(cost) AS {c.TOTAL}) AS total_cost FROM silver GROUP BY product;", Path("declared.sql"))

    return declared.run(m.spark, st.folder(m.spark), declare).table("gold")


# Files


def _evolving_parts(m: Model) -> list[str]:
    """Three parts of the orders: whole numbers that get wider, a new column and a new nested field, then a column that turned into text."""
    o, at = m.raw("orders"), st.folder(m.spark)
    k, days = F.col("o_orderkey"), (F.col("o_orderkey") % 1000).cast("int")
    parts = [
        o.where(k % 3 == 0).select(k.cast("int").alias("id"), days.alias("amount"), F.struct((k % 7).cast("int").alias("a")).alias("info")),
        o.where(k % 3 == 1).select(k.alias("id"), days.alias("amount"), F.col("o_orderpriority").alias("priority"), F.struct((k % 7).alias("a"), F.col("o_orderstatus").alias("b")).alias("info")),
        o.where(k % 3 == 2).select(k.alias("id"), F.when(k % 5 == 0, "n/a").otherwise(days.cast("string")).alias("amount"), F.struct((k % 7).alias("a")).alias("info")),
    ]
    for i, part in enumerate(parts):
        part.write.parquet(f"{at}/part={i}")
    return [f"{at}/part={i}" for i in range(len(parts))]


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 1000)::INTEGER END AS amount, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS priority, o_orderkey % 7 AS info_a, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS info_b FROM orders")
def files_of_evolving_schema(m: Model) -> DataFrame:
    """Parts written with added, missing and widened columns, nested ones too, read as one table."""
    rows, _ = sch.read_evolving(m.spark, _evolving_parts(m))
    return rows.select("id", "amount", "priority", F.col("info.a").alias("info_a"), F.col("info.b").alias("info_b"))


@query("SELECT 'amount' AS path, 'type_changed' AS kind, 'string' AS source_type, 'int' AS target_type, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS n_rows FROM orders WHERE o_orderkey % 3 = 2")
def files_schema_conflicts(m: Model) -> DataFrame:
    """The conflict among those parts: the rows whose text is no number."""
    _, drift = sch.read_evolving(m.spark, _evolving_parts(m))
    return drift.drop("part")


@query("SELECT strftime(usage_date, '%Y%m%d')::INTEGER AS date_key, count(*) AS n_records, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_priced WHERE usage_date = last_day(usage_date) AND year(usage_date) = 1998 GROUP BY 1")
def fact_pruned_by_date(m: Model) -> DataFrame:
    """The fact in a folder a day; a filter on the stored date dimension prunes the folders at run time."""
    at = st.folder(m.spark)
    up.write_partitions(p.priced(m).select("record_id", "workspace_id", "entity_id", "usage_quantity", "cost", "date_key"), f"{at}/fact", "date_key", sort=["workspace_id"], tasks=4 * m.spark.sparkContext.defaultParallelism)
    p.dim_date(m).coalesce(1).write.parquet(f"{at}/dates")
    dates = m.spark.read.parquet(f"{at}/dates").where("is_month_end AND year = 1998").select("date_key")
    return m.spark.read.parquet(f"{at}/fact").join(dates, "date_key").groupBy("date_key").agg(F.count("*").alias("n_records"), c.total(F.col("cost")).alias("total_cost"))


@query(_RESULTS)
def dq_observed_write(m: Model) -> DataFrame:
    """Good and quarantined rows written, and the rules' counts observed, in one pass."""
    df = _checked(m)
    return dq.checked_write(df, _rules(df), f"{st.folder(m.spark)}/checked")
