"""The model in DuckDB's SQL, for the oracles: written on its own, from the same table definitions."""

from __future__ import annotations

import re

TAGS = {"line_of_business": "Unknown", "department": "general", "cost_center": "unallocated", "environment": "dev", "use_case": "Unknown", "pipeline_name": "system", "workflow_level": "STANDALONE", "parent_workflow_name": "None"}


def default(name: str, column: str | None = None) -> str:
    x = f"coalesce(nullif(trim({column or 't_' + name}, ' '), ''), '{TAGS[name]}')"
    if name != "environment":
        return x
    return f"CASE WHEN lower({x}) IN ('production','prod') THEN 'prod' WHEN lower({x}) IN ('staging','stage') THEN 'stage' WHEN lower({x}) IN ('user_acceptance','uat') THEN 'uat' WHEN lower({x}) IN ('development','dev') THEN 'dev' ELSE lower({x}) END"


NODE_FAMILY = """CASE WHEN {0} LIKE '%Standard_DS%' THEN 'General Purpose (DS)' WHEN {0} LIKE '%Standard_E%' THEN 'Memory Optimized (E)' WHEN {0} LIKE '%Standard_F%' THEN 'Compute Optimized (F)'
 WHEN {0} LIKE '%Standard_L%' THEN 'Storage Optimized (L)' WHEN {0} LIKE '%Standard_N%' THEN 'GPU Enabled (N)' WHEN {0} LIKE '%Standard_M%' THEN 'Memory Optimized (M)' WHEN {0} LIKE 'c%' THEN 'Compute Optimized (C-family)'
 WHEN {0} LIKE 'm%' THEN 'General Purpose (M-family)' WHEN {0} LIKE 'r%' THEN 'Memory Optimized (R-family)' WHEN {0} LIKE 'i%' THEN 'Storage Optimized (I-family)' WHEN {0} LIKE 'g%' THEN 'GPU Enabled (G-family)'
 WHEN {0} LIKE 'p%' THEN 'GPU Enabled (P-family)' WHEN {0} LIKE 't%' THEN 'Burstable (T-family)' ELSE 'Other' END"""
NODES = lambda k: f"CASE {k} % 6 WHEN 0 THEN 'Standard_DS3_v2' WHEN 1 THEN 'Standard_E4s_v3' WHEN 2 THEN 'm5.large' WHEN 3 THEN 'c5.xlarge' WHEN 4 THEN 'g4dn.xlarge' ELSE 'unknown' END"
_T = "CASE WHEN (l_orderkey + l_linenumber) % 7 <> 5 THEN"

CTES = {
    "m_usage": f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record_id, l_suppkey::VARCHAR AS workspace_id,
 CASE l_suppkey % 3 WHEN 0 THEN 'AWS' WHEN 1 THEN 'AZURE' ELSE 'GCP' END AS cloud, p_brand AS sku_name, l_linestatus AS usage_unit,
 CASE WHEN l_returnflag = 'N' THEN 'SQL' WHEN o_custkey % 2 = 0 THEN 'JOBS' ELSE 'DLT' END AS product,
 CASE WHEN l_returnflag <> 'N' AND o_custkey % 2 = 0 THEN o_custkey::VARCHAR END AS job_id, CASE WHEN l_returnflag <> 'N' AND o_custkey % 2 = 1 THEN o_custkey::VARCHAR END AS pipeline_id,
 CASE WHEN l_returnflag <> 'N' AND o_custkey % 2 = 0 THEN l_orderkey::VARCHAR END AS job_run_id, o_custkey::VARCHAR AS cluster_id,
 l_partkey % 2 = 0 AS is_serverless, l_partkey % 3 = 0 AS is_photon,
 l_shipdate + to_hours((l_orderkey % 24)::INTEGER) AS usage_start_time, l_shipdate + to_hours((l_orderkey % 24 + l_linenumber)::INTEGER) AS usage_end_time,
 l_shipdate::DATE AS usage_date, l_quantity::DECIMAL(18,6) AS usage_quantity,
 {_T} CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'unallocated' ELSE 'cc_' || (l_partkey % 10) END END AS t_cost_center,
 {_T} p_type END AS t_line_of_business,
 {_T} CASE WHEN (l_orderkey + l_linenumber) % 7 = 3 THEN 'general' ELSE 'dept_' || (l_suppkey % 4) END END AS t_department,
 {_T} CASE l_partkey % 6 WHEN 0 THEN 'PRODUCTION' WHEN 1 THEN 'prod' WHEN 2 THEN 'Development' WHEN 3 THEN 'stage' WHEN 4 THEN 'QA' END END AS t_environment,
 {_T} CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'uc_' || (l_partkey % 5) END END AS t_use_case,
 {_T} CASE WHEN l_linenumber % 2 = 0 THEN 'pipe_' || (o_custkey % 20) END END AS t_pipeline_name,
 {_T} CASE o_custkey % 3 WHEN 0 THEN 'PARENT' WHEN 1 THEN 'SUB_WORKFLOW' END END AS t_workflow_level,
 {_T} CASE WHEN o_custkey % 3 = 1 THEN 'WF_' || (o_custkey % 10) END END AS t_parent_workflow_name
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "m_prices": """SELECT p_brand AS sku_name, u AS usage_unit, make_timestamp(y, 1, 1, 0, 0, 0) AS price_start_time, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS price_end_time,
 (base * (100 + 5 * (y - 1995))::DECIMAL(5,0) * 0.01::DECIMAL(3,2))::DECIMAL(18,6) AS price
 FROM (SELECT p_brand, max(p_retailprice)::DECIMAL(18,6) AS base FROM part GROUP BY 1), (SELECT unnest([1995,1996,1997,1998,1999,2000]) AS y), (SELECT unnest(['O','F']) AS u)""",
    "m_entity_log": """SELECT o_custkey::VARCHAR AS entity_id, CASE WHEN o_custkey % 2 = 0 THEN 'JOB' ELSE 'PIPELINE' END AS entity_type, o_orderpriority AS name, o_orderstatus AS run_as, o_orderdate AS change_time
 FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""",
    "m_entity_scd": "SELECT entity_id, entity_type, name, run_as, change_time AS valid_from, lead(change_time) OVER (PARTITION BY entity_type, entity_id ORDER BY change_time) AS valid_to FROM m_entity_log",
    "m_compute_log": f"""SELECT o_custkey::VARCHAR AS cluster_id, 'cluster_' || o_custkey AS cluster_name, CASE WHEN o_orderstatus = 'P' THEN 'WAREHOUSE' ELSE 'CLUSTER' END AS kind,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'custom:abc' ELSE (o_orderkey % 8 + 10) || '.' || (o_orderkey % 4) || CASE o_orderkey % 3 WHEN 0 THEN '.x-photon-scala2.12' WHEN 1 THEN '.x-cpu-ml' ELSE '.x' END END AS runtime_version,
 {NODES("o_orderkey")} AS worker_node_type, {NODES("(o_orderkey // 6)")} AS driver_node_type, (o_orderkey % 4)::INTEGER AS min_workers, (o_orderkey % 4 + o_orderkey % 9)::INTEGER AS max_workers,
 o_orderdate + to_minutes((o_orderkey % 1440)::INTEGER) AS change_time
 FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate + to_minutes((o_orderkey % 1440)::INTEGER) ORDER BY o_orderkey DESC) = 1""",
    "m_cluster_scd": f"""SELECT cluster_id, cluster_name, kind, CASE WHEN kind = 'CLUSTER' THEN runtime_version END AS runtime_version, CASE WHEN kind = 'CLUSTER' THEN worker_node_type END AS worker_node_type, CASE WHEN kind = 'CLUSTER' THEN driver_node_type END AS driver_node_type, min_workers, max_workers,
 CASE WHEN kind = 'CLUSTER' THEN try_cast(nullif(regexp_extract(runtime_version, '^(?:dlt:)?(\\d+)\\.(\\d+)', 1), '') AS INTEGER) END AS major_version, CASE WHEN kind = 'CLUSTER' THEN try_cast(nullif(regexp_extract(runtime_version, '^(?:dlt:)?(\\d+)\\.(\\d+)', 2), '') AS INTEGER) END AS minor_version,
 CASE WHEN kind = 'CLUSTER' THEN {NODE_FAMILY.format("worker_node_type")} END AS node_family, change_time AS valid_from, lead(change_time) OVER w AS valid_to, lead(change_time) OVER w IS NULL AS cluster_current
 FROM m_compute_log WINDOW w AS (PARTITION BY cluster_id ORDER BY change_time)""",
    "m_runs": """SELECT o_custkey::VARCHAR AS job_id, o_orderkey::VARCHAR AS run_id, (o_custkey % 10)::VARCHAR AS workspace_id, o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS start_time, o_orderdate + to_hours((o_orderkey % 24 + o_orderkey % 30)::INTEGER) AS end_time,
 CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'CANCELLED' END AS result_state, CASE WHEN o_orderkey % 5 = 0 THEN 'USER' ELSE 'NONE' END AS termination_code, o_orderpriority AS trigger_type FROM orders""",
    "m_silver_runs": "SELECT *, strftime(start_time, '%Y%m%d')::INTEGER AS date_key, strftime(end_time, '%Y%m%d')::INTEGER AS end_date_key, date_diff('second', start_time, end_time) AS seconds FROM m_runs",
    "m_tasks": """SELECT l_orderkey::VARCHAR AS run_id, l_linenumber::VARCHAR AS task_key, l_shipdate + to_hours((l_orderkey % 24)::INTEGER) AS start_time,
 l_shipdate + to_hours((l_orderkey % 24)::INTEGER) + to_minutes((l_linenumber * 60 + l_partkey % 60)::INTEGER) AS end_time, l_returnflag AS result_state FROM lineitem""",
    "m_workspaces": "SELECT s_suppkey::VARCHAR AS workspace_id, s_name AS workspace_name, n_name AS region, CASE WHEN s_acctbal < 0 THEN 'CANCELLED' ELSE 'RUNNING' END AS status FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "m_node_types": "SELECT lower(p_type) || '.' || p_partkey AS node_type, p_size AS core_count, (p_size * 4096)::BIGINT AS memory_mb, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS gpu_count FROM part",
    "m_feed": """SELECT user_id AS key, event_id, value::DECIMAL(18,6) AS value, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' WHEN 'view' THEN 'update_preimage' ELSE 'update_postimage' END AS _change_type,
 event_id // 1000 AS _commit_version, ts AS _commit_timestamp FROM events""",
    "m_silver": f"""SELECT record_id, workspace_id, cloud, sku_name, usage_unit, product, CASE WHEN job_id IS NOT NULL THEN 'JOB' WHEN pipeline_id IS NOT NULL THEN 'PIPELINE' ELSE product END AS entity_type,
 coalesce(job_id, pipeline_id, 'UNKNOWN') AS entity_id, coalesce(job_run_id, 'UNKNOWN') AS job_run_id, cluster_id, is_serverless, usage_start_time, usage_end_time, usage_date, strftime(usage_date, '%Y%m%d')::INTEGER AS date_key, usage_quantity,
 {", ".join(f"{default(k)} AS {k}" for k in TAGS)} FROM m_usage""",
    "m_priced_left": """SELECT u.*, p.price, p.price IS NOT NULL AS has_price, coalesce((u.usage_quantity * p.price)::DECIMAL(28,6), 0::DECIMAL(28,6)) AS cost FROM m_silver u LEFT JOIN m_prices p
 ON u.sku_name = p.sku_name AND u.usage_unit = p.usage_unit AND u.usage_start_time >= p.price_start_time AND u.usage_start_time < p.price_end_time""",
    "m_priced": "SELECT * FROM m_priced_left WHERE has_price",
    "m_fact": """SELECT f.*, e.name AS entity_name, e.valid_from AS entity_from, e.run_as, k.cluster_name, k.kind, k.runtime_version, k.major_version, k.minor_version, k.worker_node_type, k.node_family, k.min_workers, k.max_workers, k.cluster_current,
 w.workspace_name, w.region, w.status FROM m_priced f LEFT JOIN m_entity_scd e ON f.entity_type = e.entity_type AND f.entity_id = e.entity_id AND f.usage_start_time >= e.valid_from AND (e.valid_to IS NULL OR f.usage_start_time < e.valid_to)
 LEFT JOIN m_cluster_scd k ON f.cluster_id = k.cluster_id AND f.usage_start_time >= date_trunc('hour', k.valid_from) AND f.usage_start_time < coalesce(date_trunc('hour', k.valid_to), TIMESTAMP '9999-12-31')
 LEFT JOIN m_workspaces w ON f.workspace_id = w.workspace_id""",
}


def full(sql: str) -> str:
    """The statement with the definitions that it needs, in order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", text) and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(sql)
    body = sql.strip()
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    return head + (",\n" + body[5:] if body[:5].upper() == "WITH " else "\n" + body)
