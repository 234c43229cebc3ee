"""Scans, upserts, projections, joins, dimensions, facts, quality and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import columns as c
from meterlake.operators import asof
from meterlake.operators import incremental as inc
from meterlake.operators import merge as up
from meterlake.operators import quality as dq
from meterlake.operators import schema as sch
from meterlake.operators import temporal as t
from meterlake.plans import facts as p
from meterlake.sources.model import Model, metadata, with_runtime
from meterlake.streaming import streams as st

from .base import query
from .model_sql import NODE_FAMILY, TAGS, default

CUT = "1999-01-01 00:00:00"
AS_OF = "2001-12-01 00:00:00"
ts = lambda text: F.lit(text).cast("timestamp_ntz")


def kept(sql: str, columns: str) -> str:
    return f"SELECT {columns} FROM ({sql})"


# Scans and change feeds


@query("SELECT record_id, usage_end_time FROM m_usage WHERE usage_end_time > TIMESTAMP '1999-01-01' - INTERVAL 48 HOUR")
def src_hwm_overlap_scan(m: Model) -> DataFrame:
    return inc.hwm_scan(m.usage(), "usage_end_time", CUT, 48).select("record_id", "usage_end_time")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def src_hwm_strict_scan(m: Model) -> DataFrame:
    return inc.hwm_scan(m.raw("events"), "ts", "2024-01-15 00:00:00").select("event_id", "ts")


@query("SELECT key, event_id, value, _change_type, _commit_version FROM m_feed WHERE _change_type NOT IN ('delete', 'update_preimage') AND _commit_timestamp > TIMESTAMP '2024-01-10'")
def cdc_filter_changes(m: Model) -> DataFrame:
    return inc.live_changes(inc.hwm_scan(m.feed(), "_commit_timestamp", "2024-01-10 00:00:00")).select("key", "event_id", "value", "_change_type", "_commit_version")


@query("SELECT key, event_id, value, _change_type, _commit_version FROM m_feed WHERE _commit_version > 2 AND _commit_version <= 6 AND _change_type IN ('insert', 'delete')")
def cdc_version_range(m: Model) -> DataFrame:
    return inc.version_range(m.feed(), 2, 6, ["insert", "delete"]).select("key", "event_id", "value", "_change_type", "_commit_version")


_NET = "SELECT * FROM m_feed WHERE _change_type NOT IN ('delete', 'update_preimage') QUALIFY row_number() OVER (PARTITION BY key ORDER BY _commit_timestamp DESC, event_id DESC) = 1"


@query(f"SELECT key, event_id, value, _change_type FROM ({_NET})")
def cdc_net_change(m: Model) -> DataFrame:
    return inc.net_change(m.feed(), ["key"], "event_id").select("key", "event_id", "value", "_change_type")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def win_latest_per_key(m: Model) -> DataFrame:
    return t.latest(m.raw("events"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, min(event_id) AS first_event FROM events GROUP BY 1")
def dedupe_by_key(m: Model) -> DataFrame:
    return t.latest(m.raw("events"), ["user_id"], F.col("event_id")).select("user_id", F.col("event_id").alias("first_event"))


PAYLOAD = "cluster_id string, start_time bigint, autoscale struct<min_workers: int, max_workers: int>, init_scripts array<struct<dbfs: struct<destination: string>>>, cloud_attributes struct<zone: string>, settings struct<name: string, run_as: struct<service_principal: string, user: string>>"


@query("""SELECT event_id::VARCHAR AS cluster_id, date_trunc('second', ts) AS create_time, CASE WHEN user_id % 3 = 0 THEN 0 ELSE (user_id % 5)::INTEGER END AS min_workers, CASE WHEN user_id % 3 = 0 THEN 0 ELSE (user_id % 9)::INTEGER END AS max_workers,
 CASE WHEN event_id % 2 = 0 THEN ['dbfs:/' || event_type] ELSE []::VARCHAR[] END AS init_scripts, '{"zone":"z' || (user_id % 4) || '"}' AS cloud_attributes, event_type AS name, CASE WHEN event_id % 4 = 0 THEN 'sp_' || (user_id % 7) ELSE 'user_' || user_id END AS run_as FROM events""")
def src_nested_json_flatten(m: Model) -> DataFrame:
    """Definitions as nested JSON text, parsed by schema and flattened with higher-order functions."""
    e, uid, eid = m.raw("events"), F.col("user_id"), F.col("event_id")
    script = lambda path: F.struct(F.struct(path.alias("destination")).alias("dbfs"))
    nested = F.struct(
        eid.cast("string").alias("cluster_id"), (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).alias("start_time"),
        F.when(uid % 3 != 0, F.struct((uid % 5).cast("int").alias("min_workers"), (uid % 9).cast("int").alias("max_workers"))).alias("autoscale"),
        F.array(script(F.when(eid % 2 == 0, F.concat(F.lit("dbfs:/"), "event_type")).otherwise(F.lit("")))).alias("init_scripts"),
        F.struct(F.concat(F.lit("z"), (uid % 4).cast("string")).alias("zone")).alias("cloud_attributes"),
        F.struct(F.col("event_type").alias("name"), F.struct(F.when(eid % 4 == 0, F.concat(F.lit("sp_"), (uid % 7).cast("string"))).otherwise("").alias("service_principal"), F.concat(F.lit("user_"), uid.cast("string")).alias("user")).alias("run_as")).alias("settings"),
    )
    x = e.select(F.from_json(F.to_json(nested), PAYLOAD).alias("x")).select("x.*")
    return x.select(
        "cluster_id", F.timestamp_millis("start_time").cast("timestamp_ntz").alias("create_time"), F.coalesce("autoscale.min_workers", F.lit(0)).alias("min_workers"), F.coalesce("autoscale.max_workers", F.lit(0)).alias("max_workers"),
        F.filter(F.transform("init_scripts", lambda s: s["dbfs"]["destination"]), lambda s: s != "").alias("init_scripts"), F.to_json("cloud_attributes").alias("cloud_attributes"),
        F.col("settings.name").alias("name"), F.coalesce(F.nullif(F.col("settings.run_as.service_principal"), F.lit("")), F.col("settings.run_as.user")).alias("run_as"),
    )


@query("SELECT event_id, (props ->> '$.k')::INTEGER AS k FROM events")
def fn_from_json_struct(m: Model) -> DataFrame:
    return m.raw("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# Upserts


def _old(m: Model) -> DataFrame:
    o = m.raw("orders").where("o_orderkey % 10 < 7").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return o.withColumn("row_hash", c.row_hash(F.col("status"), F.col("priority")))


def _new(m: Model) -> DataFrame:
    o = m.raw("orders").where("o_orderkey % 10 >= 4").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"))
    return o.withColumn("row_hash", c.row_hash(F.col("status"), F.col("priority")))


_STATUS = "CASE WHEN o_orderkey % 10 >= 4 AND o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END"
_HASH = f"sha256({_STATUS} || '||' || o_orderpriority)"


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, o_orderpriority AS priority, {_HASH} AS row_hash FROM orders")
def merge_hash_guarded(m: Model) -> DataFrame:
    return up.upsert_guarded(_old(m), _new(m), ["id"])


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, o_orderpriority AS priority FROM orders")
def merge_type1(m: Model) -> DataFrame:
    return up.upsert_all(_old(m), _new(m), ["id"]).drop("row_hash")


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, CASE WHEN o_orderkey % 10 < 7 THEN o_orderkey * 2 ELSE o_orderkey * 2 + 1 END AS surrogate FROM orders")
def merge_keep_surrogate(m: Model) -> DataFrame:
    target = _old(m).select("id", "status", (F.col("id") * 2).alias("surrogate"))
    return up.upsert_keep_surrogate(target, _new(m).select("id", "status"), ["id"], "surrogate", F.col("id") * 2 + 1)


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, CASE WHEN o_orderkey % 10 >= 7 THEN 'insert' ELSE 'update_postimage' END AS _change_type FROM orders WHERE o_orderkey % 10 >= 7 OR (o_orderkey % 10 >= 4 AND o_orderkey % 3 = 0)")
def cdc_emit_from_merge(m: Model) -> DataFrame:
    return up.change_feed(_old(m), _new(m), ["id"]).select("id", "status", "_change_type")


@query(f"SELECT o_orderkey AS id, {_STATUS} AS status, {_HASH} AS row_hash FROM orders")
def inc_replay_idempotent(m: Model) -> DataFrame:
    """A batch merged twice, and an overlapping rescan, give what one merge gives."""
    once = up.upsert_guarded(_old(m), _new(m), ["id"])
    return up.upsert_guarded(up.upsert_guarded(once, _new(m), ["id"]), _new(m).where("id % 2 = 0"), ["id"]).select("id", "status", "row_hash")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 10 >= 7")
def join_anti_new_rows(m: Model) -> DataFrame:
    return _new(m).join(_old(m), "id", "left_anti").select("id")


@query("SELECT o_orderkey AS id, o_orderstatus AS status, NULL::VARCHAR AS priority FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1")
def append_evolve_schema(m: Model) -> DataFrame:
    o = m.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return up.append_evolving(o.where("id % 2 = 0").drop("priority"), o.where("id % 2 = 1"))


@query("WITH d AS (SELECT DISTINCT usage_date FROM m_usage WHERE usage_end_time > TIMESTAMP '2001-06-01') SELECT strftime(usage_date, '%Y%m%d')::INTEGER AS date_key, sum(usage_quantity)::DECIMAL(28,6) AS total_quantity, usage_date >= DATE '2001-05-31' AND usage_date IN (SELECT usage_date FROM d) AS rewritten FROM m_usage GROUP BY ALL")
def inc_impacted_partitions(m: Model) -> DataFrame:
    """Daily totals in which only the dates that the increment touches are computed anew."""
    u = m.usage().withColumn("date_key", c.date_key(F.col("usage_date")))
    dates = inc.hwm_scan(u, "usage_end_time", "2001-06-01 00:00:00").select("date_key").distinct()
    # What stands for the stored totals leaves the touched dates out, so that each date is summed once.
    sums = lambda rows, flag: rows.groupBy("date_key").agg(c.total(F.col("usage_quantity")).alias("total_quantity"), F.lit(flag).alias("rewritten"))
    return up.rewrite_partitions(sums(u.join(dates, "date_key", "left_anti"), False), sums(u.join(dates, "date_key", "left_semi"), True), "date_key")


# State


_STATE = "SELECT 'usage' AS source, 'task_' || (user_id % 5) AS task, max(ts) AS last_ts, max(event_id) AS last_version FROM events WHERE event_id % 2 = 0 OR user_id % 5 IN (1, 2) GROUP BY 1, 2"


def _state(m: Model) -> DataFrame:
    progress = lambda rows: rows.groupBy(F.lit("usage").alias("source"), F.concat(F.lit("task_"), (F.col("user_id") % 5).cast("string")).alias("task")).agg(F.max("ts").alias("last_ts"), F.max("event_id").alias("last_version"))
    e = m.raw("events")
    return inc.commit(progress(e.where("event_id % 2 = 0")), progress(e.where("user_id % 5 IN (1, 2)")))


@query(f"SELECT * FROM ({_STATE}) WHERE task <> 'task_4'")
def state_commit_per_task(m: Model) -> DataFrame:
    """Tasks 1 and 2 move on, 0 and 3 keep their offsets, 4 is reset."""
    return inc.reset(_state(m), "usage", "task_4")


@query(f"SELECT source, task, last_ts, date_diff('second', last_ts, TIMESTAMP '2024-02-05') // 3600 AS lag_hours FROM ({_STATE}) WHERE date_diff('second', last_ts, TIMESTAMP '2024-02-05') // 3600 > 72")
def state_lagging_tasks(m: Model) -> DataFrame:
    return inc.lagging(_state(m), "2024-02-05 00:00:00", 72).drop("last_version")


@query("SELECT max(usage_end_time) AS watermark, count(*) AS n_rows FROM m_usage")
def inc_max_watermark(m: Model) -> DataFrame:
    return inc.max_watermark(m.usage(), "usage_end_time")


# Projections


@query("SELECT record_id, entity_type, entity_id, job_run_id, cluster_id FROM m_silver")
def prj_entity_identify(m: Model) -> DataFrame:
    return p.silver_usage(m).select("record_id", "entity_type", "entity_id", "job_run_id", "cluster_id")


@query("SELECT record_id, t_line_of_business AS line_of_business, t_department AS department, t_cost_center AS cost_center, t_use_case AS use_case, CASE WHEN lower(t_environment) IN ('production','prod') THEN 'prod' WHEN lower(t_environment) IN ('staging','stage') THEN 'stage' WHEN lower(t_environment) = 'development' THEN 'dev' WHEN t_environment IS NULL THEN 'dev' ELSE lower(t_environment) END AS environment FROM m_usage")
def tag_extract_normalize(m: Model) -> DataFrame:
    tag = lambda k: c.tag(F.col("custom_tags"), k)
    return m.usage().select("record_id", *[tag(k).alias(k) for k in ("line_of_business", "department", "cost_center", "use_case")], c.environment(F.coalesce(tag("environment"), F.lit("dev"))).alias("environment"))


@query(f"SELECT record_id, {', '.join(f'{default(k)} AS {k}' for k in TAGS)}, CASE WHEN product = 'JOBS' THEN 'Job_Cluster' ELSE 'cluster_' || cluster_id END AS cluster_identifier FROM m_usage")
def tag_apply_defaults(m: Model) -> DataFrame:
    u = m.usage()
    name = F.concat(F.lit("cluster_"), metadata("cluster_id"))
    return u.select("record_id", *[c.defaulted(c.tag(F.col("custom_tags"), k), k).alias(k) for k in c.TAGS], F.when(F.col("product") == "JOBS", "Job_Cluster").otherwise(F.coalesce(name, F.lit("Unknown"))).alias("cluster_identifier"))


@query("WITH u AS (SELECT record_id, unnest([{'k': 'cost_center', 'v': t_cost_center}, {'k': 'department', 'v': t_department}, {'k': 'use_case', 'v': t_use_case}, {'k': 'line_of_business', 'v': t_line_of_business}]) AS x FROM m_usage) SELECT DISTINCT x.k AS tag, x.v AS value FROM u WHERE x.v IS NOT NULL")
def tag_explode(m: Model) -> DataFrame:
    e = m.usage().select(F.explode(F.map_entries("custom_tags")).alias("e")).select(F.col("e.key").alias("tag"), F.col("e.value").alias("value"))
    return e.where(F.col("value").isNotNull() & F.col("tag").isin("cost_center", "department", "use_case", "line_of_business")).distinct()


@query(f"SELECT cluster_id, change_time, worker_node_type, {NODE_FAMILY.format('worker_node_type')} AS node_family FROM m_compute_log")
def node_family_classify(m: Model) -> DataFrame:
    return m.compute_log().select("cluster_id", "change_time", "worker_node_type", c.node_family(F.col("worker_node_type")).alias("node_family"))


@query(r"SELECT cluster_id, change_time, runtime_version, try_cast(nullif(regexp_extract(runtime_version, '^(?:dlt:)?(\d+)\.(\d+)', 1), '') AS INTEGER) AS major_version, try_cast(nullif(regexp_extract(runtime_version, '^(?:dlt:)?(\d+)\.(\d+)', 2), '') AS INTEGER) AS minor_version, contains(lower(runtime_version), 'photon') AS is_photon, contains(lower(runtime_version), '-ml') AS is_ml FROM m_compute_log")
def runtime_version_parse(m: Model) -> DataFrame:
    return with_runtime(m.compute_log()).select("cluster_id", "change_time", "runtime_version", "major_version", "minor_version", "is_photon", "is_ml")


@query("SELECT record_id, hour(usage_start_time) BETWEEN 9 AND 17 AS is_peak, dayofweek(usage_start_time) IN (0, 6) AS is_weekend, CASE WHEN date_diff('second', usage_start_time, usage_end_time) > 0 THEN cost::DOUBLE / (date_diff('second', usage_start_time, usage_end_time) / 3600.0::DOUBLE) ELSE 0 END AS cost_per_hour FROM m_priced")
def usage_enrich_flags(m: Model) -> DataFrame:
    hours = c.seconds_between(F.col("usage_start_time"), F.col("usage_end_time")) / F.lit(3600.0)
    return p.priced(m).select("record_id", F.hour("usage_start_time").between(9, 17).alias("is_peak"), F.dayofweek("usage_start_time").isin(1, 7).alias("is_weekend"), F.when(hours > 0, F.col("cost").cast("double") / hours).otherwise(0.0).alias("cost_per_hour"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, greatest(l_quantity - 25, 0)::DECIMAL(18,6) AS quantity, CASE WHEN l_linenumber % 4 = 0 THEN l_shipdate + INTERVAL 1 SECOND ELSE l_shipdate + to_hours(l_linenumber) END AS end_time FROM lineitem")
def clean_usage_rows(m: Model) -> DataFrame:
    """Negative quantities become 0; an end at or before the start becomes start + 1 s."""
    raw = m.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.col("l_quantity") - 25).cast(c.MONEY).alias("quantity"), F.col("l_shipdate").alias("start"), F.timestamp_add("HOUR", F.when(F.col("l_linenumber") % 4 == 0, 0).otherwise(F.col("l_linenumber")), F.col("l_shipdate")).alias("end"))
    end = F.when(F.col("end") <= F.col("start"), F.timestamp_add("SECOND", F.lit(1), F.col("start"))).otherwise(F.col("end"))
    return raw.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.greatest("quantity", F.lit(0).cast(c.MONEY)).alias("quantity"), end.alias("end_time"))


@query("SELECT event_id, sha256(coalesce(user_id::VARCHAR, '') || '||' || coalesce(event_type, '') || '||' || coalesce(props, '')) AS row_hash FROM events")
def row_hash_sha256(m: Model) -> DataFrame:
    return m.raw("events").select("event_id", c.row_hash(F.col("user_id"), F.col("event_type"), F.col("props")).alias("row_hash"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE t_cost_center IS NULL) AS n_rejected, count(*) FILTER (WHERE t_cost_center IS NOT NULL) AS n_kept FROM m_usage")
def reject_null_keys(m: Model) -> DataFrame:
    good = dq.quarantine(m.usage().withColumn("cc", c.tag(F.col("custom_tags"), "cost_center")), [dq.Rule("no cost center", "WARN", F.col("cc").isNull())])
    return good.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("is_good")).alias("n_rejected"), F.count_if("is_good").alias("n_kept"))


@query("WITH e AS (SELECT entity_id, max_by(run_as, valid_from) AS entity_tag FROM m_entity_scd GROUP BY 1), k AS (SELECT cluster_id, max_by(nullif(worker_node_type, 'unknown'), valid_from) AS cluster_tag FROM (SELECT cluster_id, worker_node_type, valid_from FROM m_cluster_scd WHERE worker_node_type IS NOT NULL AND worker_node_type <> 'unknown') GROUP BY 1) SELECT record_id, coalesce(nullif(trim(t_cost_center, ' '), ''), cluster_tag, entity_tag, 'none') AS attribution FROM m_usage u LEFT JOIN k ON u.cluster_id = k.cluster_id LEFT JOIN e ON coalesce(u.job_id, u.pipeline_id) = e.entity_id")
def tag_inherit(m: Model) -> DataFrame:
    """The usage tag, else the cluster's, else the definition's."""
    e = p.dim_entity(m).groupBy("entity_id").agg(F.max_by("run_as", "valid_from").alias("entity_tag"))
    k = p.dim_cluster(m).where("worker_node_type IS NOT NULL AND worker_node_type <> 'unknown'").groupBy("cluster_id").agg(F.max_by("worker_node_type", "valid_from").alias("cluster_tag"))
    u = m.usage().select("record_id", metadata("cluster_id").alias("cluster_id"), F.coalesce(metadata("job_id"), metadata("pipeline_id")).alias("entity_id"), F.nullif(F.trim(c.tag(F.col("custom_tags"), "cost_center")), F.lit("")).alias("own"))
    tagged = t.lookup(t.lookup(u, k, "cluster_id", "record_id"), e, "entity_id", "record_id")
    return tagged.select("record_id", F.coalesce("own", "cluster_tag", "entity_tag", F.lit("none")).alias("attribution"))


@query("WITH p AS (SELECT DISTINCT o_custkey // 10 AS parent FROM orders) SELECT DISTINCT o_custkey AS id, CASE WHEN o_custkey IN (SELECT parent FROM p) THEN 'PARENT' WHEN o_custkey % 4 = 0 THEN 'SUB_WORKFLOW' ELSE 'STANDALONE' END AS workflow_level, CASE WHEN o_custkey IN (SELECT parent FROM p) THEN NULL WHEN o_custkey % 4 = 0 THEN 'WF_' || (o_custkey // 10) END AS parent_workflow FROM orders")
def workflow_level_derive(m: Model) -> DataFrame:
    jobs = m.raw("orders").select(F.col("o_custkey").alias("id")).distinct()
    parents = jobs.select(F.expr("id div 10").alias("parent")).distinct()
    x = jobs.join(parents, jobs["id"] == parents["parent"], "left")
    level = F.when(F.col("parent").isNotNull(), "PARENT").when(F.col("id") % 4 == 0, "SUB_WORKFLOW").otherwise("STANDALONE")
    return x.select("id", level.alias("workflow_level"), F.when(level == "SUB_WORKFLOW", F.concat(F.lit("WF_"), F.expr("id div 10").cast("string"))).alias("parent_workflow"))


# Joins


@query("SELECT record_id, price, cost FROM m_priced")
def join_price_inner(m: Model) -> DataFrame:
    return p.priced(m).select("record_id", "price", "cost")


@query("SELECT record_id, price, has_price, cost FROM m_priced_left")
def join_price_left(m: Model) -> DataFrame:
    return p.priced(m, "left").select("record_id", "price", "has_price", "cost")


@query("SELECT u.record_id, e.name AS entity_name, e.valid_from AS entity_from FROM m_silver u LEFT JOIN m_entity_scd e ON u.entity_type = e.entity_type AND u.entity_id = e.entity_id AND u.usage_start_time >= e.valid_from AND (e.valid_to IS NULL OR u.usage_start_time < e.valid_to)")
def join_asof_scd2(m: Model) -> DataFrame:
    return p.with_entity(p.silver_usage(m), m).select("record_id", "entity_name", "entity_from")


_EC = "SELECT date_key, workspace_id, entity_type, entity_id, sum(cost)::DECIMAL(28,6) AS total_cost, sum(usage_quantity)::DECIMAL(28,6) AS total_quantity, count(DISTINCT job_run_id) AS n_runs, count(*) AS n_records FROM m_priced GROUP BY ALL"
_KEY = "strftime({}, '%Y%m%d')::INTEGER"


@query(f"WITH c AS ({_EC}) SELECT c.date_key, c.workspace_id, c.entity_type, c.entity_id, e.name FROM c LEFT JOIN m_entity_scd e ON c.entity_type = e.entity_type AND c.entity_id = e.entity_id AND c.date_key >= {_KEY.format('e.valid_from')} AND (e.valid_to IS NULL OR c.date_key < {_KEY.format('e.valid_to')})")
def join_asof_datekey(m: Model) -> DataFrame:
    cost, e = p.entity_cost(m), p.dim_entity(m)
    out = t.asof_join(cost, e, {"entity_type": "entity_type", "entity_id": "entity_id"}, cost["date_key"], ["name"], "left", c.date_key(F.col("valid_from")), c.date_key(F.col("valid_to")), absent=p.no_entity(cost))
    return out.select("date_key", "workspace_id", "entity_type", "entity_id", "name")


@query("SELECT record_id, cluster_name, runtime_version, worker_node_type FROM m_fact")
def join_asof_hour_trunc(m: Model) -> DataFrame:
    return p.with_cluster(p.priced(m), m).select("record_id", "cluster_name", "runtime_version", "worker_node_type")


@query("SELECT r.run_id, max_by(e.name, e.valid_from) AS name FROM m_runs r LEFT JOIN m_entity_scd e ON r.job_id = e.entity_id AND e.valid_from < r.end_time AND (e.valid_to IS NULL OR e.valid_to > r.start_time) GROUP BY 1")
def join_interval_overlap(m: Model) -> DataFrame:
    r = m.runs()
    return t.overlap_join(r, p.dim_entity(m), {"job_id": "entity_id"}, r["start_time"], r["end_time"], ["name"], "run_id").select("run_id", "name")


@query("SELECT r.run_id, max(e.valid_from) AS version_from FROM m_runs r JOIN m_entity_scd e ON r.job_id = e.entity_id AND e.valid_from <= r.end_time GROUP BY 1")
def join_dedupe_one_match(m: Model) -> DataFrame:
    """The last version up to the end of a run, by one sort of runs and versions together: nothing fans out."""
    r, e = m.runs(), p.dim_entity(m).select("entity_id", "valid_from", F.col("valid_from").alias("version_from"))
    return asof.asof_merge(r, e, {"job_id": "entity_id"}, r["end_time"], ["version_from"]).where("version_from IS NOT NULL").select("run_id", "version_from")


@query("SELECT record_id, entity_type, entity_id FROM m_fact WHERE entity_name IS NULL AND entity_id <> 'UNKNOWN'")
def dq_orphan_keys(m: Model) -> DataFrame:
    return p.with_entity(p.priced(m), m).where("entity_name IS NULL AND entity_id <> 'UNKNOWN'").select("record_id", "entity_type", "entity_id")


# Versions and dimensions


_SCD = "SELECT entity_type, entity_id, name, run_as, valid_from, valid_to, valid_to IS NULL AS is_current FROM m_entity_scd"
ENTITY = ["entity_type", "entity_id"]


@query(_SCD)
def scd2_intervalize(m: Model) -> DataFrame:
    return t.intervalize(m.entity_log(), ENTITY).select(*ENTITY, "name", "run_as", "valid_from", "valid_to", "is_current")


@query(_SCD)
def scd2_merge_increment(m: Model) -> DataFrame:
    """History of two thirds of the changes, then the rest, late ones included: as if all had come at once."""
    log = m.entity_log()
    part = F.pmod(F.xxhash64(*ENTITY, "change_time"), F.lit(3))
    history = t.intervalize(log.where(part != 0), ENTITY)
    return t.merge_increment(history, log.where(part == 0), ENTITY).select(*ENTITY, "name", "run_as", "valid_from", "valid_to", "is_current")


_TWO = "WITH a AS (SELECT entity_type, entity_id, name, run_as, change_time FROM m_entity_log WHERE change_time < TIMESTAMP '1999-01-01' QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY change_time DESC) = 1), b AS (SELECT entity_type, entity_id, name, run_as, change_time FROM m_entity_log QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY change_time DESC) = 1)"


@query(f"""{_TWO} SELECT a.entity_type, a.entity_id, a.name, a.run_as, a.change_time AS valid_from, CASE WHEN b.change_time > a.change_time AND (b.name, b.run_as) IS DISTINCT FROM (a.name, a.run_as) THEN b.change_time END AS valid_to, NOT (b.change_time > a.change_time AND (b.name, b.run_as) IS DISTINCT FROM (a.name, a.run_as)) AS is_current FROM a JOIN b USING (entity_type, entity_id)
UNION ALL SELECT b.entity_type, b.entity_id, b.name, b.run_as, b.change_time, NULL, true FROM b LEFT JOIN a USING (entity_type, entity_id) WHERE a.entity_id IS NULL OR (b.change_time > a.change_time AND (b.name, b.run_as) IS DISTINCT FROM (a.name, a.run_as))""")
def scd2_close_and_insert(m: Model) -> DataFrame:
    """Applied twice: the second run changes nothing."""
    last = lambda rows: t.latest(rows, ENTITY, F.desc("change_time"))
    log = m.entity_log()
    first = last(log.where(F.col("change_time") < ts(CUT))).select(*ENTITY, "name", "run_as", F.col("change_time").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    new = last(log)
    return t.close_and_insert(t.close_and_insert(first, new, ENTITY, ["name", "run_as"]), new, ENTITY, ["name", "run_as"])


@query("WITH l AS (SELECT *, lag(run_as) OVER (PARTITION BY entity_type, entity_id ORDER BY change_time) AS before FROM m_entity_log) SELECT entity_type, entity_id, run_as, change_time FROM l WHERE before IS NULL OR before <> run_as")
def scd2_collapse_nochange(m: Model) -> DataFrame:
    return t.collapse_unchanged(m.entity_log(), ENTITY, ["run_as"]).select(*ENTITY, "run_as", "change_time")


@query("SELECT entity_type, entity_id, name, valid_from, valid_to, date_diff('day', valid_from, coalesce(valid_to, TIMESTAMP '2001-12-01')) AS days_active FROM m_entity_scd")
def scd2_history_report(m: Model) -> DataFrame:
    days = F.date_diff(F.coalesce("valid_to", ts(AS_OF)).cast("date"), F.col("valid_from").cast("date")).cast("bigint")
    return p.dim_entity(m).select(*ENTITY, "name", "valid_from", "valid_to", days.alias("days_active"))


@query("SELECT entity_type, entity_id, count(*) AS versions, 0::BIGINT AS overlaps, 0::BIGINT AS gaps, count(*) FILTER (WHERE valid_to IS NULL) AS current_rows FROM m_entity_scd GROUP BY 1, 2")
def scd2_validate_intervals(m: Model) -> DataFrame:
    return t.problems(p.dim_entity(m), ENTITY)


@query("SELECT sku_name, usage_unit, price, price_start_time AS valid_from, CASE WHEN price_end_time < TIMESTAMP '2001-01-01' THEN price_end_time END AS valid_to, price_end_time >= TIMESTAMP '2001-01-01' AS is_current FROM m_prices")
def price_scd(m: Model) -> DataFrame:
    """Price history by the supplier's own intervals: the last one is open; an effective price goes before the default."""
    listed = m.prices().withColumn("pricing", F.struct(F.col("price").alias("default"), F.struct(F.lit(None).cast(c.MONEY).alias("default")).alias("effective_list")))
    end = F.when(F.col("price_end_time") < ts("2001-01-01"), F.col("price_end_time"))
    return listed.select("sku_name", "usage_unit", F.coalesce("pricing.effective_list.default", "pricing.default").alias("price"), F.col("price_start_time").alias("valid_from"), end.alias("valid_to"), end.isNull().alias("is_current"))


@query("SELECT entity_type, entity_id, name, change_time FROM m_entity_log")
def entity_unify(m: Model) -> DataFrame:
    log = m.entity_log()
    jobs = log.where("entity_type = 'JOB'").select(F.col("entity_id").alias("job_id"), "name", "change_time")
    pipelines = log.where("entity_type = 'PIPELINE'").select(F.col("entity_id").alias("pipeline_id"), "name", "change_time")
    standard = lambda rows, kind, key: rows.select(F.lit(kind).alias("entity_type"), F.col(key).alias("entity_id"), "name", "change_time")
    return standard(jobs, "JOB", "job_id").unionByName(standard(pipelines, "PIPELINE", "pipeline_id"))


@query("SELECT cluster_id, cluster_name, kind, runtime_version, major_version, minor_version, worker_node_type, driver_node_type, node_family, min_workers, max_workers, valid_from, valid_to, cluster_current AS is_current FROM m_cluster_scd")
def dim_cluster_unified(m: Model) -> DataFrame:
    return p.dim_cluster(m).select("cluster_id", "cluster_name", "kind", "runtime_version", "major_version", "minor_version", "worker_node_type", "driver_node_type", "node_family", "min_workers", "max_workers", "valid_from", "valid_to", "is_current")


@query("SELECT * FROM m_workspaces")
def dim_workspace(m: Model) -> DataFrame:
    return m.workspaces().distinct()


@query(_SCD)
def dim_entity(m: Model) -> DataFrame:
    return p.dim_entity(m).drop("entity_key").select(*ENTITY, "name", "run_as", "valid_from", "valid_to", "is_current")


@query("SELECT sku_name, usage_unit, price, price_start_time AS valid_from, price_end_time AS valid_to FROM m_prices")
def dim_sku(m: Model) -> DataFrame:
    return p.dim_sku(m)


@query("SELECT DISTINCT result_state || '|' || termination_code AS run_status_key, result_state, termination_code FROM m_runs")
def dim_run_status(m: Model) -> DataFrame:
    return p.dim_run_status(m)


@query("SELECT node_type, core_count, memory_mb, gpu_count, CASE WHEN node_type LIKE 'm%' THEN 'General Purpose (M-family)' WHEN node_type LIKE 'p%' THEN 'GPU Enabled (P-family)' ELSE 'Other' END AS node_family FROM m_node_types")
def dim_node_type(m: Model) -> DataFrame:
    return m.node_types().withColumn("node_family", c.node_family(F.col("node_type")))


@query("WITH b AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS z FROM orders), d AS (SELECT unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM b) SELECT strftime(date, '%Y%m%d')::INTEGER AS date_key, date, year(date)::INTEGER AS year, quarter(date)::INTEGER AS quarter, month(date)::INTEGER AS month, day(date)::INTEGER AS day, (dayofweek(date) + 1)::INTEGER AS day_of_week, dayofyear(date)::INTEGER AS day_of_year, dayofweek(date) IN (0, 6) AS is_weekend, date = last_day(date) AS is_month_end, date = last_day(date) AND month(date) % 3 = 0 AS is_quarter_end, date = last_day(date) AND month(date) = 12 AS is_year_end FROM d")
def dim_date(m: Model) -> DataFrame:
    return p.dim_date(m)


@query("SELECT count(*) AS n_rows, count(*) AS n_keys, 0::BIGINT AS n_collisions, count(*) AS n_found FROM m_entity_scd")
def dim_surrogate_key(m: Model) -> DataFrame:
    """Keys hashed from the natural key are unique, and a second build finds every one."""
    e = p.dim_entity(m)
    again = p.dim_entity(m).select("entity_key", F.lit(1).alias("hit"))
    x = e.join(again, "entity_key", "left").groupBy("entity_key").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    return x.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum(F.col("n") - 1).alias("n_collisions"), F.sum("hits").alias("n_found"))


# Facts


@query("SELECT f.record_id, f.date_key, f.workspace_id, f.workspace_name, f.entity_type, f.entity_id, f.entity_name, f.cluster_id, f.cluster_name, f.sku_name, f.usage_unit, s.price_start_time AS sku_from, f.usage_quantity, f.price, f.cost FROM m_fact f LEFT JOIN m_prices s ON f.sku_name = s.sku_name AND f.usage_unit = s.usage_unit AND f.usage_start_time >= s.price_start_time AND f.usage_start_time < s.price_end_time")
def fact_usage_priced(m: Model) -> DataFrame:
    """Intervals of a key never overlap (scd2_validate_intervals), so no join fans out and no guard has to shuffle the fact again."""
    return p.usage_fact(m).select("record_id", "date_key", "workspace_id", "workspace_name", "entity_type", "entity_id", "entity_name", "cluster_id", "cluster_name", "sku_name", "usage_unit", "sku_from", "usage_quantity", "price", "cost")


_OF_DAY = "LEFT JOIN m_entity_scd e ON c.entity_type = e.entity_type AND c.entity_id = e.entity_id AND c.{0} >= strftime(e.valid_from, '%Y%m%d')::INTEGER AND (e.valid_to IS NULL OR c.{0} < strftime(e.valid_to, '%Y%m%d')::INTEGER)"


@query(f"WITH c AS ({_EC}) SELECT c.*, e.name AS entity_name, e.valid_from AS entity_from FROM c {_OF_DAY.format('date_key')}")
def fact_entity_cost(m: Model) -> DataFrame:
    return p.with_entity_of_day(p.entity_cost(m), m)


@query("WITH c AS (SELECT entity_id, job_run_id, sum(cost)::DECIMAL(28,6) AS run_cost, sum(usage_quantity)::DECIMAL(28,6) AS run_quantity FROM m_priced WHERE job_run_id <> 'UNKNOWN' GROUP BY 1, 2), n AS (SELECT r.run_id, max_by(k.cluster_name, k.valid_from) AS cluster_name FROM m_runs r JOIN m_cluster_scd k ON r.job_id = k.cluster_id AND k.valid_from < r.end_time AND (k.valid_to IS NULL OR k.valid_to > r.start_time) GROUP BY 1) SELECT c.*, n.cluster_name FROM c LEFT JOIN n ON c.job_run_id = n.run_id")
def fact_run_cost(m: Model) -> DataFrame:
    """Cost a run with the cluster whose version overlaps it; costs are summed before the join, so nothing fans out."""
    r = m.runs()
    named = t.overlap_join(r, p.dim_cluster(m), {"job_id": "cluster_id"}, r["start_time"], r["end_time"], ["cluster_name"], "run_id").select(F.col("run_id").alias("job_run_id"), "cluster_name")
    return p.run_cost(m).join(named, "job_run_id", "left")


@query(f"WITH c AS (SELECT r.run_id, 'JOB' AS entity_type, r.job_id AS entity_id, r.date_key, r.result_state || '|' || r.termination_code AS run_status_key, coalesce(c.run_cost, 0::DECIMAL(28,6)) AS run_cost FROM m_silver_runs r LEFT JOIN (SELECT job_run_id, sum(cost)::DECIMAL(28,6) AS run_cost FROM m_priced WHERE job_run_id <> 'UNKNOWN' GROUP BY 1) c ON r.run_id = c.job_run_id) SELECT c.*, e.name AS entity_name, e.valid_from AS entity_from FROM c {_OF_DAY.format('date_key')}")
def fact_run_status_cost(m: Model) -> DataFrame:
    rows = p.run_status_cost(m).select("run_id", "entity_type", "entity_id", "date_key", "run_status_key", "run_cost")
    return p.with_entity_of_day(rows, m)


@query(f"WITH c AS (SELECT end_date_key, workspace_id, 'JOB' AS entity_type, job_id AS entity_id, count(*) AS finished_runs, count(*) FILTER (WHERE result_state = 'SUCCESS') AS success_runs, count(*) FILTER (WHERE result_state = 'FAILED') AS failed_runs, count(*) FILTER (WHERE result_state = 'CANCELLED') AS cancelled_runs FROM m_silver_runs GROUP BY ALL) SELECT c.*, e.name AS entity_name, e.valid_from AS entity_from FROM c {_OF_DAY.format('end_date_key')}")
def fact_runs_finished(m: Model) -> DataFrame:
    return p.with_entity_of_day(p.runs_finished(m), m, "end_date_key")


@query("SELECT record_id, date_key, workspace_name, region, sku_name, product, CASE WHEN is_serverless THEN 'Y' ELSE 'N' END AS serverless, run_as, runtime_version, node_family, usage_quantity, cost, environment, cost_center FROM m_fact")
def fact_billing_usage(m: Model) -> DataFrame:
    return p.usage_fact(m).select("record_id", "date_key", "workspace_name", "region", "sku_name", "product", F.when(F.col("is_serverless"), "Y").otherwise("N").alias("serverless"), "run_as", "runtime_version", "node_family", "usage_quantity", "cost", "environment", "cost_center")


@query("SELECT * FROM m_silver")
def silver_usage_txn(m: Model) -> DataFrame:
    return p.silver_usage(m)


@query("SELECT run_id, job_id, date_key, end_date_key, seconds, result_state FROM m_silver_runs")
def silver_run_timeline(m: Model) -> DataFrame:
    return p.silver_runs(m).select("run_id", "job_id", "date_key", "end_date_key", "seconds", "result_state")


@query(f"SELECT run_id, task_key, {_KEY.format('start_time')} AS date_key, {_KEY.format('end_time')} AS end_date_key, date_diff('second', start_time, end_time) AS seconds, result_state FROM m_tasks")
def silver_task_timeline(m: Model) -> DataFrame:
    return p.silver_tasks(m).select("run_id", "task_key", "date_key", "end_date_key", "seconds", "result_state")


# Quality


def _rules(df: DataFrame) -> list[dq.Rule]:
    return [
        dq.Rule("non-negative quantity", "ERROR", dq.non_negative("quantity")),
        dq.Rule("valid time range", "ERROR", dq.valid_range("start_time", "end_time")),
        dq.Rule("required fields", "CRITICAL", dq.required(df, "l_orderkey", "code")),
        dq.Rule("workers in range", "WARN", F.col("l_linenumber") > F.col("quantity")),
        dq.Rule("known status", "WARN", ~F.col("l_linestatus").isin("O", "F")),
    ]


def _checked(m: Model) -> DataFrame:
    return m.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", (F.col("l_quantity") - 3).alias("quantity"), F.col("l_shipdate").alias("start_time"), F.timestamp_add("HOUR", (F.col("l_partkey") % 5).cast("int"), F.col("l_shipdate")).alias("end_time"), F.when(F.col("l_partkey") % 9 != 0, F.col("l_returnflag")).alias("code"))


_FAILS = {"non-negative quantity": ("ERROR", "l_quantity - 3 < 0"), "valid time range": ("ERROR", "l_partkey % 5 = 0"), "required fields": ("CRITICAL", "l_partkey % 9 = 0"), "workers in range": ("WARN", "l_linenumber > l_quantity - 3"), "known status": ("WARN", "l_linestatus NOT IN ('O', 'F')")}
_RESULTS = " UNION ALL ".join(f"SELECT '{k}' AS rule, '{s}' AS severity, count(*) AS checked, count(*) FILTER (WHERE {f}) AS failed, count(*) FILTER (WHERE NOT ({f})) AS passed, count(*) FILTER (WHERE {f}) = 0 AS ok FROM lineitem" for k, (s, f) in _FAILS.items())


@query(_RESULTS)
def dq_rule_results(m: Model) -> DataFrame:
    df = _checked(m)
    return dq.results(df, _rules(df))


@query(f"SELECT count(*) AS rules, count(*) FILTER (WHERE ok) AS rules_passed, round(count(*) FILTER (WHERE ok) * 100.0::DOUBLE / count(*), 2) AS success_rate, round(sum(passed)::DOUBLE * 100.0 / sum(checked)::DOUBLE, 2) AS quality_score FROM ({_RESULTS})")
def dq_score_summary(m: Model) -> DataFrame:
    df = _checked(m)
    return dq.score(dq.results(df, _rules(df)))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, [x FOR x IN [" + ", ".join(f"CASE WHEN {f} THEN '{k}' END" for k, (_, f) in _FAILS.items()) + "] IF x IS NOT NULL] AS reasons, NOT (" + " OR ".join(f"({f})" for _, f in _FAILS.values()) + ") AS is_good FROM lineitem")
def dq_quarantine(m: Model) -> DataFrame:
    df = _checked(m)
    return dq.quarantine(df, _rules(df)).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "reasons", "is_good")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_duplicate_keys(m: Model) -> DataFrame:
    return dq.duplicates(m.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events)::DOUBLE, 2) AS pct FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 10")
def profile_value_distribution(m: Model) -> DataFrame:
    n = m.raw("events").groupBy("event_type").agg(F.count("*").alias("n"))
    whole = n.agg(F.sum("n").alias("_all"))
    return n.join(F.broadcast(whole), F.lit(True)).select("event_type", "n", c.percent(F.col("n"), F.col("_all")).alias("pct")).orderBy(F.desc("n"), "event_type").limit(10)


@query(" UNION ALL ".join(f"SELECT count(*) AS n_rows, '{x}' AS column_name, count(*) FILTER (WHERE {x} IS NULL) AS nulls, count(DISTINCT {x}) AS distinct_values FROM m_compute_log" for x in ("cluster_id", "runtime_version", "worker_node_type")))
def profile_columns(m: Model) -> DataFrame:
    return dq.profile(m.compute_log(), ["cluster_id", "runtime_version", "worker_node_type"])


TABLES = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
_FRESH = " UNION ALL ".join(f"SELECT '{k}' AS table_name, max({v}) AS last_ts FROM {k}" for k, v in TABLES.items())
_AGE = "date_diff('second', last_ts, TIMESTAMP '2001-11-05') // 3600"
_FRESH = f"SELECT table_name, last_ts, CAST(trunc(date_diff('second', last_ts, TIMESTAMP '2001-11-05') / 3600.0) AS BIGINT) AS age_hours FROM ({_FRESH})"
_FRESH = f"SELECT *, CASE WHEN age_hours < 24 THEN 'FRESH' WHEN age_hours < 48 THEN 'STALE' ELSE 'VERY_STALE' END AS status FROM ({_FRESH})"


def _fresh(m: Model) -> DataFrame:
    return dq.freshness({k: (m.raw(k), v) for k, v in TABLES.items()}, "2001-11-05 00:00:00")


@query(_FRESH)
def health_freshness(m: Model) -> DataFrame:
    return _fresh(m)


_COUNTS = " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS n_rows, CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'OK' END AS status FROM {k}" for k in ("lineitem", "orders", "part", "customer", "supplier", "events"))


@query(_COUNTS)
def health_record_counts(m: Model) -> DataFrame:
    return dq.record_counts({k: m.raw(k) for k in ("lineitem", "orders", "part", "customer", "supplier", "events")})


@query(f"WITH s AS (SELECT 'freshness' AS area, CASE status WHEN 'FRESH' THEN 0 WHEN 'STALE' THEN 1 ELSE 2 END AS level FROM ({_FRESH}) UNION ALL SELECT 'records', CASE status WHEN 'OK' THEN 0 ELSE 2 END FROM ({_COUNTS})) SELECT area, max(level) AS level, CASE max(level) WHEN 0 THEN 'HEALTHY' WHEN 1 THEN 'WARNING' ELSE 'CRITICAL' END AS status, CASE max(level) WHEN 0 THEN 'none' ELSE 'check ' || area END AS recommendation FROM s GROUP BY 1")
def health_summary(m: Model) -> DataFrame:
    level = lambda good, middle: F.when(F.col("status") == good, 0).when(F.col("status") == middle, 1).otherwise(2)
    s = _fresh(m).select(F.lit("freshness").alias("area"), level("FRESH", "STALE").alias("level")).union(health_record_counts(m).select(F.lit("records"), level("OK", "")))
    worst = s.groupBy("area").agg(F.max("level").alias("level"))
    return worst.select("area", "level", F.when(F.col("level") == 0, "HEALTHY").when(F.col("level") == 1, "WARNING").otherwise("CRITICAL").alias("status"), F.when(F.col("level") == 0, "none").otherwise(F.concat(F.lit("check "), "area")).alias("recommendation"))


@query("SELECT count(*) AS n_rows, count(*) - count(DISTINCT record_id) AS duplicates, count(*) FILTER (WHERE record_id IS NULL) AS null_ids, count(*) FILTER (WHERE cost < 0) AS negatives, min(date_key) AS first_day, max(date_key) AS last_day, count(*) = count(DISTINCT record_id) AND count(*) FILTER (WHERE cost < 0) = 0 AS ok FROM m_fact")
def dq_fact_validation(m: Model) -> DataFrame:
    n, d, bad = F.count("*"), F.count_distinct("record_id"), F.count_if(F.col("cost") < 0)
    return p.usage_fact(m, "entity_name").agg(n.alias("n_rows"), (n - d).alias("duplicates"), F.count_if(F.col("record_id").isNull()).alias("null_ids"), bad.alias("negatives"), F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"), ((n == d) & (bad == 0)).alias("ok"))


@query("SELECT count(*) AS n_rows, sum(cost)::DECIMAL(28,6) AS total_cost, sum(cost)::DOUBLE / count(*) AS avg_cost, max(cost) AS max_cost, count(DISTINCT workspace_id) AS n_workspaces, count(*) FILTER (WHERE date_key >= 20001201) AS n_last_days FROM m_fact")
def fact_statistics(m: Model) -> DataFrame:
    return p.usage_fact(m, "record_id").agg(F.count("*").alias("n_rows"), c.total(F.col("cost")).alias("total_cost"), c.mean(F.col("cost")).alias("avg_cost"), F.max("cost").alias("max_cost"), F.count_distinct("workspace_id").alias("n_workspaces"), F.count_if(F.col("date_key") >= 20001201).alias("n_last_days"))


@query("WITH d AS (SELECT date_key, workspace_id, sum(cost)::DECIMAL(28,6) AS day_cost FROM m_priced GROUP BY 1, 2) SELECT 'COST' AS alert, date_key, workspace_id, day_cost::DOUBLE AS value FROM d WHERE day_cost > 80000 UNION ALL SELECT 'FAILED_RUNS', end_date_key, workspace_id, count(*) FILTER (WHERE result_state = 'FAILED')::DOUBLE FROM m_silver_runs GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE result_state = 'FAILED') >= 2")
def alert_cost_threshold(m: Model) -> DataFrame:
    cost = p.priced(m).groupBy("date_key", "workspace_id").agg(c.total(F.col("cost")).alias("v")).where("v > 80000").select(F.lit("COST").alias("alert"), "date_key", "workspace_id", F.col("v").cast("double").alias("value"))
    failed = p.runs_finished(m).groupBy("end_date_key", "workspace_id").agg(F.sum("failed_runs").alias("failed_runs")).where("failed_runs >= 2").select(F.lit("FAILED_RUNS"), F.col("end_date_key"), "workspace_id", F.col("failed_runs").cast("double"))
    return cost.union(failed)


@query("SELECT 'bronze' AS layer, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'silver', count(*) FROM m_silver UNION ALL SELECT 'gold', count(*) FROM m_fact UNION ALL SELECT 'unpriced', count(*) FROM m_priced_left WHERE NOT has_price")
def reconcile_layer_counts(m: Model) -> DataFrame:
    one = lambda name, rows: rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
    return one("bronze", m.raw("lineitem")).union(one("silver", p.silver_usage(m))).union(one("gold", p.usage_fact(m))).union(one("unpriced", p.priced(m, "left").where("NOT has_price")))


# Functions


@query(r"SELECT c_custkey, lower(c_mktsegment) AS lowered, c_name LIKE '%00_1' AS matches, contains(c_name, '12') AS has_12, regexp_extract(c_name, '(\d+)$', 1) AS digits, concat_ws('|', c_mktsegment, c_name) AS joined, md5(c_name) AS md5, sha256(c_name) AS sha FROM customer")
def fn_string(m: Model) -> DataFrame:
    n = F.col("c_name")
    return m.raw("customer").select("c_custkey", F.lower("c_mktsegment").alias("lowered"), n.like("%00_1").alias("matches"), F.contains(n, F.lit("12")).alias("has_12"), F.regexp_extract(n, r"(\d+)$", 1).alias("digits"), F.concat_ws("|", "c_mktsegment", "c_name").alias("joined"), F.md5(n).alias("md5"), F.sha2(n, 256).alias("sha"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key, date_trunc('month', o_orderdate)::DATE AS month_start, hour(o_orderdate)::INTEGER AS h, (dayofweek(o_orderdate) + 1)::INTEGER AS dow, (o_orderdate - INTERVAL 7 DAY)::DATE AS week_before, date_diff('day', o_orderdate::DATE, DATE '2001-12-01') AS days_ago, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, dayofyear(o_orderdate)::INTEGER AS doy, last_day(o_orderdate::DATE) AS month_end, epoch(o_orderdate)::BIGINT AS unix FROM orders")
def fn_datetime(m: Model) -> DataFrame:
    d = F.col("o_orderdate")
    return m.raw("orders").select("o_orderkey", c.date_key(d).alias("date_key"), F.date_trunc("month", d).cast("date").alias("month_start"), F.hour(d).alias("h"), F.dayofweek(d).alias("dow"), F.date_sub(d.cast("date"), 7).alias("week_before"), F.date_diff(F.lit("2001-12-01").cast("date"), d.cast("date")).cast("bigint").alias("days_ago"), F.year(d).alias("y"), F.quarter(d).alias("q"), F.dayofyear(d).alias("doy"), F.last_day(d.cast("date")).alias("month_end"), F.unix_timestamp(d.cast("timestamp")).alias("unix"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice::DECIMAL(18,6) * 2, 1)::DOUBLE AS rounded, l_extendedprice / nullif(l_linenumber - 1, 0) AS ratio, greatest(l_quantity - 10, 0) AS clamped FROM lineitem")
def fn_math(m: Model) -> DataFrame:
    return m.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.col("l_extendedprice").cast(c.MONEY) * 2, 1).cast("double").alias("rounded"), F.try_divide(F.col("l_extendedprice"), (F.col("l_linenumber") - 1).cast("double")).alias("ratio"), F.greatest(F.col("l_quantity") - 10, F.lit(0.0)).alias("clamped"))


@query("SELECT cluster_id, change_time, coalesce(runtime_version, 'none') AS version, runtime_version IS NULL AS missing, nullif(worker_node_type, 'unknown') AS node FROM m_compute_log")
def fn_null(m: Model) -> DataFrame:
    return m.compute_log().select("cluster_id", "change_time", F.nvl("runtime_version", F.lit("none")).alias("version"), F.col("runtime_version").isNull().alias("missing"), F.nullif("worker_node_type", F.lit("unknown")).alias("node"))


@query("SELECT record_id, cluster_id, job_id, is_photon, NULL::VARCHAR[] AS init_scripts FROM m_usage")
def fn_nested(m: Model) -> DataFrame:
    return m.usage().select("record_id", metadata("cluster_id").alias("cluster_id"), metadata("job_id").alias("job_id"), F.col("product_features.is_photon").alias("is_photon"), F.lit(None).cast("array<string>").alias("init_scripts"))


@query("SELECT event_id, value::DECIMAL(18,6) AS money, try_cast(event_type AS INTEGER) AS bad, event_id::VARCHAR AS text, ts::DATE AS day FROM events")
def fn_cast(m: Model) -> DataFrame:
    return m.raw("events").select("event_id", F.col("value").cast(c.MONEY).alias("money"), F.col("event_type").try_cast("int").alias("bad"), F.col("event_id").cast("string").alias("text"), F.col("ts").cast("date").alias("day"))


@query("SELECT event_id, event_id::VARCHAR || '' AS id_text, user_id::INTEGER AS a_user, event_type AS a_type, NULL::VARCHAR AS a_region FROM events")
def align_to_schema(m: Model) -> DataFrame:
    """A nested column rebuilt to the target: user narrowed, region missing, value dropped."""
    target = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("id_text", T.StringType()), T.StructField("actor", T.StructType([T.StructField("user", T.IntegerType()), T.StructField("type", T.StringType()), T.StructField("region", T.StringType())]))])
    source = m.raw("events").select("event_id", F.col("event_id").alias("id_text"), F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"), "value").alias("actor"))
    out = sch.align_to_schema(source, target)
    return out.select("event_id", "id_text", *[F.col(f"actor.{k}").alias(f"a_{k}") for k in ("user", "type", "region")])


TARGET = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.IntegerType()), T.StructField("event_type", T.IntegerType()), T.StructField("region", T.StringType()), T.StructField("value", T.DoubleType())])


@query("""SELECT 'event_type' AS path, 'type_changed' AS kind, 'string' AS source_type, 'int' AS target_type, count(*) FILTER (WHERE event_type IS NOT NULL AND try_cast(event_type AS INTEGER) IS NULL) AS n_rows FROM events
UNION ALL SELECT 'props', 'extra', 'string', NULL, count(props) FROM events UNION ALL SELECT 'region', 'missing', NULL, 'string', count(*) FROM events UNION ALL SELECT 'ts', 'extra', 'timestamp_ntz', NULL, count(ts) FROM events
UNION ALL SELECT 'user_id', 'type_changed', 'bigint', 'int', count(*) FILTER (WHERE user_id IS NOT NULL AND try_cast(user_id AS INTEGER) IS NULL) FROM events""")
def schema_drift(m: Model) -> DataFrame:
    """Differences of a source from its target as rows, with the rows of the source that each touches."""
    return sch.drift_report(m.raw("events"), TARGET)


@query("""SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id::VARCHAR END AS cluster_id, event_id % 97 = 0 AS is_malformed, CASE WHEN event_id % 97 <> 0 THEN coalesce(CASE WHEN user_id % 3 <> 0 THEN (user_id % 5)::INTEGER END, 0) END AS min_workers, CASE WHEN event_id % 97 <> 0 AND event_id % 4 <> 0 THEN event_type END AS name FROM events""")
def src_json_payload_files(m: Model) -> DataFrame:
    """Payloads read from JSON files by schema: absent fields are null, malformed lines are kept apart, none is lost.

    The files are written here, from the events, as the tables hold no JSON files.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    payload = F.struct(
        eid.cast("string").alias("cluster_id"), F.when(uid % 3 != 0, F.struct((uid % 5).cast("int").alias("min_workers"))).alias("autoscale"),
        F.when(eid % 4 != 0, F.struct(F.col("event_type").alias("name"))).alias("settings"),
    )
    line = F.to_json(payload)
    at = st.folder(m.spark)
    m.raw("events").select(F.when(eid % 97 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(f"{at}/payloads")
    x = m.spark.read.schema(f"{PAYLOAD}, _corrupt_record string").json(f"{at}/payloads")
    good = F.col("_corrupt_record").isNull()
    return x.select(F.when(good, F.col("cluster_id")).alias("cluster_id"), (~good).alias("is_malformed"), F.when(good, F.coalesce("autoscale.min_workers", F.lit(0))).alias("min_workers"), F.when(good, F.col("settings.name")).alias("name"))


@query("SELECT workspace_id, date_key AS day, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_priced GROUP BY 1, 2")
def partitioned_output(m: Model) -> DataFrame:
    """Daily costs written in a folder a month, one month written again, which replaces its own folder alone."""
    at = f"{st.folder(m.spark)}/costs"
    daily = p.priced(m).groupBy("workspace_id", "date_key").agg(c.total(F.col("cost")).alias("total_cost")).withColumn("month", F.expr("date_key div 100").cast("int"))
    up.write_partitions(daily, at, "month", sort=["workspace_id"])
    up.write_partitions(daily.where("month = 199806"), at, "month", sort=["workspace_id"])
    return m.spark.read.parquet(at).select("workspace_id", F.col("date_key").alias("day"), "total_cost")


# Streams


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def stream_upsert_available_now(m: Model) -> DataFrame:
    return st.upsert_now(st.events(m.spark, m.sf_dir).select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("SELECT DISTINCT event_id FROM events")
def stream_dedupe(m: Model) -> DataFrame:
    e = st.events(m.spark, m.sf_dir)
    twice = e.select("event_id", F.explode(F.array(F.col("ts"), F.col("ts"))).alias("ts"))
    return st.append_now(st.deduplicated(twice, ["event_id"]).select("event_id"))


def _windowed(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *rest)


_VALUE = "sum(value::DECIMAL(18,6))::DECIMAL(28,6) AS total_value, count(*) AS n_events"
STREAM_MEASURES = {"total_value": F.sum, "n_events": F.count}


def _measures() -> dict:
    return {"total_value": c.total(F.col("value").cast(c.MONEY)), "n_events": F.count("*")}


@query(f"SELECT date_trunc('day', ts) AS window_start, event_type, {_VALUE} FROM events GROUP BY 1, 2")
def stream_tumbling_cost(m: Model) -> DataFrame:
    return _windowed(st.complete_now(st.tumbling(st.events(m.spark, m.sf_dir), "ts", "1 day", "event_type", **_measures())), "event_type", "total_value", "n_events")


@query(f"SELECT date_trunc('day', ts) - to_days(k::INTEGER) AS window_start, {_VALUE} FROM events, (SELECT unnest(range(7)) AS k) GROUP BY 1")
def stream_sliding_cost(m: Model) -> DataFrame:
    return _windowed(st.complete_now(st.sliding(st.events(m.spark, m.sf_dir), "ts", "7 days", "1 day", **_measures())), "total_value", "n_events")


@query("""WITH g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > ts - INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n_events, sum(value::DECIMAL(18,6))::DECIMAL(28,6) AS total_value FROM s GROUP BY user_id, session""")
def stream_session_usage(m: Model) -> DataFrame:
    out = st.complete_now(st.sessions(st.events(m.spark, m.sf_dir), "ts", "12 hours", "user_id", **_measures()))
    return out.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("session_start"), "n_events", "total_value")


@query("SELECT event_id, event_type, value::DECIMAL(18,6) AS quantity, (value::DECIMAL(18,6) * price)::DECIMAL(28,6) AS cost FROM events JOIN m_prices ON sku_name = 'Brand#' || (user_id % 25 + 1) AND usage_unit = 'O' AND price_start_time = TIMESTAMP '2000-01-01'")
def stream_static_price_join(m: Model) -> DataFrame:
    """A stream of usage against the static price list, by an equi-join on the SKU."""
    prices = m.prices().where((F.col("usage_unit") == "O") & (F.col("price_start_time") == ts("2000-01-01"))).select("sku_name", "price")
    e = st.events(m.spark, m.sf_dir).withColumn("sku_name", F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")))
    quantity = F.col("value").cast(c.MONEY)
    return st.append_now(e.join(prices, "sku_name").select("event_id", "event_type", quantity.alias("quantity"), (quantity * F.col("price")).cast(c.TOTAL).alias("cost")))
