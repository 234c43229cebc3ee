"""Business views and dashboards over the usage fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import columns as c
from meterlake.plans import facts as p
from meterlake.plans.rollups import USUAL, rollup
from meterlake.sources.model import Model

from .base import query

SQL_MEASURES = {
    "total_cost": "sum(cost)::DECIMAL(28,6)", "total_quantity": "sum(usage_quantity)::DECIMAL(28,6)", "n_records": "count(*)", "n_entities": "count(DISTINCT entity_id)", "n_workspaces": "count(DISTINCT workspace_id)", "n_clusters": "count(DISTINCT cluster_id)", "n_days": "count(DISTINCT date_key)",
    "avg_cost": "sum(cost)::DOUBLE / count(cost)", "cost_per_unit": "sum(cost)::DOUBLE / nullif(sum(usage_quantity)::DOUBLE, 0)", "cost_per_entity": "sum(cost)::DOUBLE / nullif(count(DISTINCT entity_id), 0)", "cost_per_workspace": "sum(cost)::DOUBLE / nullif(count(DISTINCT workspace_id), 0)",
    "n_runs": "count(DISTINCT nullif(job_run_id, 'UNKNOWN'))", "cost_per_run": "sum(cost)::DOUBLE / nullif(count(DISTINCT nullif(job_run_id, 'UNKNOWN')), 0)",
}
#: Dashboards ask for the last so many days up to this one; no query reads the clock.
AS_OF, DAYS = "2000-12-31", 731


RECENT = c.last_days("date_key", AS_OF, DAYS)
RECENT_SQL = f"(date_key > strftime(DATE '{AS_OF}' - INTERVAL {DAYS} DAY, '%Y%m%d')::INTEGER AND date_key <= strftime(DATE '{AS_OF}', '%Y%m%d')::INTEGER)"
MONTH = {"month_key": (lambda: F.expr("date_key div 100"), "date_key // 100")}
HOUR = {"hour_of_day": (lambda: F.hour("usage_start_time"), "hour(usage_start_time)")}

#: name: (keys, measures, where, having, top)
ROLLUPS = {
    "view_cost_allocation": (("date_key", "workspace_id", "entity_type", "entity_id", "entity_name"), USUAL, None, None, None),
    "view_department_cost": (("date_key", "line_of_business", "department"), USUAL, None, None, None),
    "view_sku_cost_trends": (("date_key", "sku_name", "usage_unit"), (*USUAL, "cost_per_unit"), None, None, None),
    "view_lob_cost": (("date_key", "workspace_id", "line_of_business"), USUAL, None, None, None),
    "view_environment_cost": (("date_key", "environment"), (*USUAL, "n_workspaces"), None, None, None),
    "view_use_case_cost": (("date_key", "use_case", "line_of_business"), USUAL, None, None, None),
    "view_cluster_cost": (("date_key", "cluster_id", "cluster_name", "kind", "runtime_version"), USUAL, None, None, None),
    "view_cost_center": (("date_key", "cost_center", "department"), (*USUAL, "n_workspaces"), None, None, None),
    "view_workflow_cost": (("date_key", "workflow_level", "parent_workflow_name"), (*USUAL, "n_workspaces"), None, None, None),
    "view_cluster_workflow_cost": (("date_key", "workflow_level", "parent_workflow_name", "cluster_name"), USUAL, None, None, None),
    "fact_usage_by_node_type": (("date_key", "worker_node_type", "node_family"), (*USUAL, "n_clusters"), None, None, None),
    "cost_by_entity_version": (("entity_type", "entity_id", "entity_name", "entity_from"), USUAL, "entity_from IS NOT NULL", None, None),
    "dash_usage_unit": (("usage_unit",), ("total_cost", "total_quantity", "n_records", "cost_per_unit"), RECENT, None, None),
    "dash_workload_distribution": (("product",), USUAL, RECENT, None, None),
    "dash_monthly_cost": (("month_key", "workspace_id"), USUAL, RECENT, None, None),
    "dash_business_unit": (("line_of_business", "department"), (*USUAL, "cost_per_entity"), RECENT, None, None),
    "dash_bu_performance": (("line_of_business",), (*USUAL, "cost_per_unit", "cost_per_entity"), RECENT, None, None),
    "dash_project_cost": (("month_key", "use_case"), USUAL, RECENT, None, None),
    "dash_usage_hourly": (("hour_of_day", "environment"), USUAL, RECENT, None, None),
    "dash_node_type_cost": (("worker_node_type", "runtime_version"), (*USUAL, "n_clusters", "cost_per_entity", "n_runs", "cost_per_run"), "worker_node_type IS NOT NULL", None, None),
    "dash_top_skus": (("sku_name",), ("total_cost", "total_quantity", "n_records", "cost_per_unit"), RECENT, None, 10),
    "dash_top_entities": (("entity_type", "entity_id"), ("total_cost", "total_quantity", "n_days"), f"{RECENT} AND entity_id <> 'UNKNOWN'", None, 15),
    "dash_top_cost_centers": (("cost_center",), ("total_cost", "n_entities", "cost_per_entity"), RECENT, None, 10),
    "workflow_monthly_cost": (("month_key", "workflow_level", "parent_workflow_name"), ("total_cost", "n_entities", "n_workspaces", "cost_per_entity", "cost_per_workspace"), None, None, None),
    "serverless_split": (("product", "is_serverless"), ("total_cost", "total_quantity", "n_records"), None, None, None),
    "usage_summary": (("sku_name", "workspace_id"), ("total_quantity", "n_records", "n_days"), None, None, None),
    "cluster_config_summary": (("kind", "worker_node_type", "min_workers", "max_workers"), ("total_cost", "n_clusters", "n_records"), "kind IS NOT NULL", None, None),
}


def _register(name: str) -> None:
    keys, measures, where, having, top = ROLLUPS[name]
    condition, where = where, where and where.replace(RECENT, RECENT_SQL)
    derived = {**MONTH, **HOUR}
    select = ", ".join([f"{derived[k][1]} AS {k}" if k in derived else k for k in keys] + [f"{SQL_MEASURES[m]} AS {m}" for m in measures])
    group = ", ".join(str(i + 1) for i in range(len(keys)))
    sql = f"SELECT {select} FROM m_fact" + (f" WHERE {where}" if where else "") + f" GROUP BY {group}" + (f" ORDER BY total_cost DESC, {', '.join(keys)} LIMIT {top}" if top else "")

    def make(m: Model) -> DataFrame:
        # Attributes named by keys and condition; "record_id" stands for none.
        need = ["record_id", *[k for k in (*p.ENTITY_COLUMNS, *p.CLUSTER_COLUMNS, *p.WORKSPACE_COLUMNS) if k in keys or k in (condition or "")]]
        return rollup(p.usage_fact(m, *need), [derived[k][0]().alias(k) if k in derived else k for k in keys], measures, condition, having, top)

    query(sql, name)(make)


for _name in ROLLUPS:
    _register(_name)


@query("SELECT date_key, line_of_business || '|' || department || '|' || cost_center || '|' || environment || '|' || use_case || '|' || pipeline_name AS attribution_key, sum(cost)::DECIMAL(28,6) AS total_cost, count(*) AS n_records FROM m_priced GROUP BY 1, 2")
def cost_attribution_rollup(m: Model) -> DataFrame:
    key = c.joined([F.col(k) for k in c.TAGS[:6]]).alias("attribution_key")
    return p.priced(m).groupBy("date_key", key).agg(c.total(F.col("cost")).alias("total_cost"), F.count("*").alias("n_records"))


@query("SELECT date_key, workspace_id, sku_name, sum(usage_quantity)::DECIMAL(28,6) AS total_quantity, sum(cost)::DECIMAL(28,6) AS total_cost, max(cost_center) AS cost_center, max(department) AS department FROM m_priced GROUP BY 1, 2, 3")
def fact_usage_daily_rollup(m: Model) -> DataFrame:
    return p.priced(m).groupBy("date_key", "workspace_id", "sku_name").agg(c.total(F.col("usage_quantity")).alias("total_quantity"), c.total(F.col("cost")).alias("total_cost"), F.max("cost_center").alias("cost_center"), F.max("department").alias("department"))


_MISSING = {k: f"({k} = '{v}')" for k, v in c.TAG_DEFAULTS.items()}


@query("SELECT record_id, date_key, workspace_id, entity_type, entity_id, " + ", ".join(f"CASE WHEN {x} THEN 'Missing' ELSE 'Present' END AS {k}_status" for k, x in _MISSING.items()) + ", " + " + ".join(f"{x}::INTEGER" for x in _MISSING.values()) + " AS missing_tags, cost FROM m_priced")
def view_tag_quality(m: Model) -> DataFrame:
    gone = F.col("gone")
    status = [F.when(gone[i], "Missing").otherwise("Present").alias(f"{k}_status") for i, k in enumerate(c.TAGS)]
    rows = p.priced(m, "inner", c.absent_tags(F.col("custom_tags")).alias("gone"))
    return rows.select("record_id", "date_key", "workspace_id", "entity_type", "entity_id", *status, F.size(F.filter(gone, lambda x: x)).alias("missing_tags"), "cost")


_COVERAGE_SQL = ", ".join(f"count(*) FILTER (WHERE NOT {x}) AS with_{k}, round(count(*) FILTER (WHERE NOT {x}) * 100.0::DOUBLE / count(*)::DOUBLE, 2) AS {k}_pct" for k, x in _MISSING.items())


def _coverage(m: Model, *keys: str) -> DataFrame:
    """One flag a tag, set where usage is read; shares come from the counts after the aggregation."""
    flags = [(~c.is_absent(c.tag(F.col("custom_tags"), k), k)).alias(f"has_{k}") for k in c.TAGS]
    sums = p.priced(m, "inner", *flags).groupBy(*keys).agg(F.count("*").alias("n_records"), *[F.count_if(F.col(f"has_{k}")).alias(f"with_{k}") for k in c.TAGS], c.total(F.col("cost")).alias("total_cost"))
    return sums.select(*keys, "n_records", *[x for k in c.TAGS for x in (F.col(f"with_{k}"), c.percent(F.col(f"with_{k}"), F.col("n_records")).alias(f"{k}_pct"))], "total_cost")


@query(f"SELECT date_key, count(*) AS n_records, {_COVERAGE_SQL}, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_priced GROUP BY 1")
def view_tag_coverage(m: Model) -> DataFrame:
    return _coverage(m, "date_key")


@query(f"SELECT workspace_id, count(*) AS n_records, {_COVERAGE_SQL}, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_priced GROUP BY 1")
def dash_tag_coverage_ws(m: Model) -> DataFrame:
    return _coverage(m, "workspace_id")


_LAG = "newest - major_version"


@query(f"""WITH newest AS (SELECT workspace_id, max(major_version) AS newest FROM m_fact GROUP BY 1)
SELECT f.date_key, f.workspace_id, f.runtime_version, f.major_version, f.minor_version, count(DISTINCT entity_id) AS n_entities, count(DISTINCT cluster_id) AS n_clusters, sum(cost)::DECIMAL(28,6) AS total_cost,
 CASE WHEN {_LAG} > 4 THEN 'CRITICAL' WHEN {_LAG} > 3 THEN 'HIGH' WHEN {_LAG} > 2 THEN 'MEDIUM' WHEN {_LAG} > 1 THEN 'CONSIDER' ELSE 'LOW' END AS upgrade_priority
FROM m_fact f JOIN newest n ON f.workspace_id = n.workspace_id GROUP BY f.date_key, f.workspace_id, f.runtime_version, f.major_version, f.minor_version, newest""")
def view_runtime_versions(m: Model) -> DataFrame:
    """The newest major version a workspace is a window over the grouped rows, as a join with them would build the fact twice.

    The fact is dealt by group once and counted there: a record is two rows, one an id that is counted, instead of the three that two distinct
    counts make of it and shuffle.
    """
    keys = ["date_key", "workspace_id", "runtime_version", "major_version", "minor_version"]
    facts = p.usage_fact(m, "runtime_version").select(*keys, "entity_id", "cluster_id", "cost").repartition(*keys)
    one = lambda kind, x, cost: F.struct(F.lit(kind).alias("is_entity"), F.col(x).alias("id"), cost.cast(c.TOTAL).alias("cost"))
    counted = F.array(one(True, "entity_id", F.col("cost")), one(False, "cluster_id", F.lit(None)))
    ids = facts.select(*keys, F.inline(counted)).groupBy(*keys, "is_entity", "id").agg(F.sum("cost").alias("cost"))
    n = lambda kind: F.count_if(F.col("id").isNotNull() & kind)
    rows = ids.groupBy(*keys).agg(n(F.col("is_entity")).alias("n_entities"), n(~F.col("is_entity")).alias("n_clusters"), c.total(F.col("cost")).alias("total_cost"))
    rows = rows.where("workspace_id IS NOT NULL").withColumn("newest", F.max("major_version").over(Window.partitionBy("workspace_id")))
    lag = F.col("newest") - F.col("major_version")
    level = c.first_of([(lag > 4, F.lit("CRITICAL")), (lag > 3, F.lit("HIGH")), (lag > 2, F.lit("MEDIUM")), (lag > 1, F.lit("CONSIDER"))], F.lit("LOW"))
    return rows.withColumn("upgrade_priority", level).drop("newest")


@query("""SELECT date_key, worker_node_type, node_family, CASE WHEN min_workers = max_workers THEN 'FIXED' WHEN max_workers - min_workers > 5 THEN 'WIDE' ELSE 'AUTOSCALE' END AS scaling,
 CASE WHEN node_family LIKE 'GPU%' THEN 'check GPU use' WHEN max_workers - min_workers > 5 THEN 'narrow the range' ELSE 'keep' END AS suggestion, count(DISTINCT cluster_id) AS n_clusters, sum(cost)::DECIMAL(28,6) AS total_cost FROM m_fact WHERE worker_node_type IS NOT NULL GROUP BY ALL""")
def view_node_types(m: Model) -> DataFrame:
    width = F.col("max_workers") - F.col("min_workers")
    scaling = F.when(width == 0, "FIXED").when(width > 5, "WIDE").otherwise("AUTOSCALE")
    suggestion = F.when(F.col("node_family").like("GPU%"), "check GPU use").when(width > 5, "narrow the range").otherwise("keep")
    rows = p.usage_fact(m, "worker_node_type").where("worker_node_type IS NOT NULL")
    return rows.groupBy("date_key", "worker_node_type", "node_family", scaling.alias("scaling"), suggestion.alias("suggestion")).agg(F.count_distinct("cluster_id").alias("n_clusters"), c.total(F.col("cost")).alias("total_cost"))


@query("SELECT DISTINCT runtime_version, major_version, minor_version, node_family, CASE WHEN major_version >= 14 THEN 'Latest Generation' WHEN major_version >= 13 THEN 'Current Generation' WHEN major_version >= 12 THEN 'Previous Generation' ELSE 'Legacy' END AS generation FROM m_cluster_scd WHERE runtime_version IS NOT NULL")
def view_runtime_generation(m: Model) -> DataFrame:
    v = F.col("major_version")
    generation = F.when(v >= 14, "Latest Generation").when(v >= 13, "Current Generation").when(v >= 12, "Previous Generation").otherwise("Legacy")
    return p.dim_cluster(m).where("runtime_version IS NOT NULL").select("runtime_version", "major_version", "minor_version", "node_family", generation.alias("generation")).distinct()


_DAILY = "SELECT usage_date, date_key, workspace_id, entity_type, sum(cost)::DECIMAL(28,6) AS day_cost, sum(usage_quantity)::DECIMAL(28,6) AS day_quantity FROM m_priced GROUP BY ALL"


def _daily(m: Model) -> DataFrame:
    return p.priced(m).groupBy("usage_date", "date_key", "workspace_id", "entity_type").agg(c.total(F.col("cost")).alias("day_cost"), c.total(F.col("usage_quantity")).alias("day_quantity"))


@query(f"WITH d AS ({_DAILY}) SELECT date_key, workspace_id, entity_type, day_cost, sum(day_cost) OVER w ::DECIMAL(28,6) AS rolling_cost, sum(day_quantity) OVER w ::DECIMAL(28,6) AS rolling_quantity FROM d WINDOW w AS (PARTITION BY workspace_id, entity_type ORDER BY date_key ROWS 6 PRECEDING)")
def view_cost_trends(m: Model) -> DataFrame:
    w = Window.partitionBy("workspace_id", "entity_type").orderBy("date_key").rowsBetween(-6, 0)
    roll = lambda x: F.sum(x).over(w).cast(c.TOTAL)
    return _daily(m).select("date_key", "workspace_id", "entity_type", "day_cost", roll("day_cost").alias("rolling_cost"), roll("day_quantity").alias("rolling_quantity"))


@query(f"WITH d AS ({_DAILY}) SELECT date_key, workspace_id, entity_type, day_cost, sum(day_cost) OVER w ::DOUBLE / count(*) OVER w AS rolling_avg FROM d WINDOW w AS (PARTITION BY workspace_id, entity_type ORDER BY date_key ROWS 6 PRECEDING)")
def win_rolling_avg_rows(m: Model) -> DataFrame:
    w = Window.partitionBy("workspace_id", "entity_type").orderBy("date_key").rowsBetween(-6, 0)
    return _daily(m).select("date_key", "workspace_id", "entity_type", "day_cost", (F.sum("day_cost").over(w).cast("double") / F.count("*").over(w)).alias("rolling_avg"))


@query(f"WITH d AS ({_DAILY}) SELECT date_key, workspace_id, entity_type, day_cost, sum(day_cost) OVER w ::DOUBLE / count(*) OVER w AS rolling_avg FROM d WINDOW w AS (PARTITION BY workspace_id, entity_type ORDER BY usage_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)")
def win_rolling_avg_days(m: Model) -> DataFrame:
    """True days: missing days count as absent, not as the row before."""
    w = Window.partitionBy("workspace_id", "entity_type").orderBy(F.unix_date("usage_date")).rangeBetween(-6, 0)
    return _daily(m).select("date_key", "workspace_id", "entity_type", "day_cost", (F.sum("day_cost").over(w).cast("double") / F.count("*").over(w)).alias("rolling_avg"))


@query("WITH d AS (SELECT date_key, product, sum(cost)::DECIMAL(28,6) AS day_cost FROM m_priced GROUP BY 1, 2) SELECT date_key, product, day_cost, sum(day_cost) OVER (PARTITION BY product ORDER BY date_key ROWS 6 PRECEDING)::DOUBLE / count(*) OVER (PARTITION BY product ORDER BY date_key ROWS 6 PRECEDING) AS rolling_avg FROM d")
def dash_daily_trend(m: Model) -> DataFrame:
    d = p.priced(m).groupBy("date_key", "product").agg(c.total(F.col("cost")).alias("day_cost"))
    w = Window.partitionBy("product").orderBy("date_key").rowsBetween(-6, 0)
    return d.select("*", (F.sum("day_cost").over(w).cast("double") / F.count("*").over(w)).alias("rolling_avg"))


@query("""WITH d AS (SELECT date_key, workspace_id, entity_type, entity_id, sum(cost)::DECIMAL(28,6) AS day_cost FROM m_priced GROUP BY ALL), g AS (SELECT *, sum(day_cost) OVER w ::DOUBLE / count(*) OVER w AS avg_cost FROM d WINDOW w AS (PARTITION BY workspace_id, entity_type))
SELECT *, CASE WHEN day_cost::DOUBLE > 2 * avg_cost THEN 'HIGH' ELSE 'LOW' END AS anomaly FROM g WHERE day_cost::DOUBLE > 2 * avg_cost OR day_cost::DOUBLE < 0.1 * avg_cost""")
def cost_anomalies(m: Model) -> DataFrame:
    """Group averages come from a map-combined aggregate, not from a window that would gather a whole group."""
    d = p.priced(m).groupBy("date_key", "workspace_id", "entity_type", "entity_id").agg(c.total(F.col("cost")).alias("day_cost"))
    avg = d.groupBy("workspace_id", "entity_type").agg(c.mean(F.col("day_cost")).alias("avg_cost"))
    cost = F.col("day_cost").cast("double")
    high, low = cost > 2 * F.col("avg_cost"), cost < 0.1 * F.col("avg_cost")
    return d.join(avg, ["workspace_id", "entity_type"]).where(high | low).withColumn("anomaly", F.when(high, "HIGH").otherwise("LOW"))


POLICIES = [("POL_001", "COST", 250000.0), ("POL_002", "PERFORMANCE", 24.0), ("POL_003", "QUALITY", 0.1), ("POL_004", "OTHER", 1.0)]


@query("""WITH p(policy_id, policy_type, threshold) AS (VALUES ('POL_001','COST',250000.0::DOUBLE),('POL_002','PERFORMANCE',24.0),('POL_003','QUALITY',0.1),('POL_004','OTHER',1.0)),
c AS (SELECT date_key, sum(cost)::DOUBLE AS daily_cost FROM m_priced GROUP BY 1), r AS (SELECT end_date_key AS date_key, count(*) FILTER (WHERE result_state = 'FAILED')::DOUBLE / count(*) AS failure_rate, max(seconds) / 3600.0::DOUBLE AS longest_hours FROM m_silver_runs GROUP BY 1)
SELECT policy_id, policy_type, threshold, date_key, daily_cost, failure_rate, longest_hours, CASE policy_type WHEN 'COST' THEN CASE WHEN daily_cost > threshold THEN 'VIOLATION' ELSE 'COMPLIANT' END WHEN 'QUALITY' THEN CASE WHEN failure_rate > threshold THEN 'VIOLATION' ELSE 'COMPLIANT' END
 WHEN 'PERFORMANCE' THEN CASE WHEN longest_hours > threshold THEN 'VIOLATION' ELSE 'COMPLIANT' END ELSE 'UNKNOWN' END AS compliance FROM (SELECT * FROM c LEFT JOIN r USING (date_key)), p""")
def policy_compliance(m: Model) -> DataFrame:
    """Each side is summed by day first; the few policies unfold as an inline list, so no join multiplies rows."""
    cost = p.priced(m).groupBy("date_key").agg(F.sum("cost").cast("double").alias("daily_cost"))
    runs = p.silver_runs(m).groupBy(F.col("end_date_key").alias("date_key")).agg((F.count_if(F.col("result_state") == "FAILED").cast("double") / F.count("*")).alias("failure_rate"), (F.max("seconds") / F.lit(3600.0)).alias("longest_hours"))
    rules = F.array(*[F.struct(F.lit(i).alias("policy_id"), F.lit(t).alias("policy_type"), F.lit(x).alias("threshold")) for i, t, x in POLICIES])
    days = cost.join(runs, "date_key", "left").select("*", F.inline(rules))
    value = c.first_of([(F.col("policy_type") == "COST", F.col("daily_cost")), (F.col("policy_type") == "QUALITY", F.col("failure_rate"))], F.col("longest_hours"))
    return days.withColumn("compliance", F.when(F.col("policy_type") == "OTHER", "UNKNOWN").when(value > F.col("threshold"), "VIOLATION").otherwise("COMPLIANT"))


@query(f"SELECT sum(cost)::DECIMAL(28,6) AS total_cost, sum(cost)::DOUBLE / count(*) AS avg_cost, count(DISTINCT workspace_id) AS n_workspaces, count(DISTINCT entity_id) AS n_entities, count(DISTINCT sku_name) AS n_skus FROM m_priced WHERE {RECENT_SQL}")
def dash_kpis(m: Model) -> DataFrame:
    return p.priced(m).where(RECENT).agg(c.total(F.col("cost")).alias("total_cost"), c.mean(F.col("cost")).alias("avg_cost"), *[F.count_distinct(x).alias(a) for x, a in (("workspace_id", "n_workspaces"), ("entity_id", "n_entities"), ("sku_name", "n_skus"))])


@query("SELECT sum(cost)::DECIMAL(28,6) AS total_cost, count(*) AS n_records FROM m_priced WHERE date_key BETWEEN 19970101 AND 19981231 AND ('7' = '<ALL>' OR workspace_id = '7')")
def dash_param_kpis(m: Model) -> DataFrame:
    """Named parameters, with <ALL> as the sentinel for every workspace."""
    sql = "SELECT CAST(sum(cost) AS DECIMAL(28,6)) AS total_cost, count(*) AS n_records FROM {usage} WHERE date_key BETWEEN :first AND :last AND (:workspace = '<ALL>' OR workspace_id = :workspace)"
    return m.spark.sql(sql, args={"first": 19970101, "last": 19981231, "workspace": "7"}, usage=p.priced(m))


@query(f"WITH k AS (SELECT sum(cost)::DOUBLE AS cost, sum(usage_quantity)::DOUBLE AS quantity, count(*)::DOUBLE AS records FROM m_priced WHERE {RECENT_SQL}) SELECT 'total_cost' AS metric, cost AS value, 'USD' AS unit FROM k UNION ALL SELECT 'total_quantity', quantity, 'units' FROM k UNION ALL SELECT 'records', records, 'rows' FROM k")
def dash_metric_cards(m: Model) -> DataFrame:
    k = p.priced(m).where(RECENT).agg(F.sum("cost").cast("double").alias("cost"), F.sum("usage_quantity").cast("double").alias("quantity"), F.count("*").cast("double").alias("records"))
    return k.select(F.expr("stack(3, 'total_cost', cost, 'USD', 'total_quantity', quantity, 'units', 'records', records, 'rows') AS (metric, value, unit)"))


@query("SELECT '<ALL>' AS workspace_id UNION ALL SELECT DISTINCT workspace_id FROM m_usage")
def dash_workspace_filter(m: Model) -> DataFrame:
    ids = m.usage().select("workspace_id").distinct()
    return m.spark.range(1).select(F.lit("<ALL>").alias("workspace_id")).union(ids)


@query("""WITH v AS (SELECT runtime_version, count(DISTINCT cluster_id) AS clusters, sum(cost)::DECIMAL(28,6) AS cost, CASE WHEN major_version IN (16, 17) THEN 'Current' WHEN major_version = 15 THEN 'Recent' WHEN major_version = 14 THEN 'Older' ELSE 'Legacy' END AS category FROM m_fact WHERE cluster_current GROUP BY runtime_version, category)
SELECT category, count(*) AS runtime_versions, sum(clusters)::BIGINT AS total_clusters, sum(cost)::DECIMAL(28,6) AS total_cost FROM v GROUP BY 1""")
def dash_runtime_health(m: Model) -> DataFrame:
    v = F.col("major_version")
    category = F.when(v.isin(16, 17), "Current").when(v == 15, "Recent").when(v == 14, "Older").otherwise("Legacy")
    by_version = p.usage_fact(m, "cluster_current").where("cluster_current").groupBy("runtime_version", category.alias("category")).agg(F.count_distinct("cluster_id").alias("clusters"), c.total(F.col("cost")).alias("cost"))
    return by_version.groupBy("category").agg(F.count("*").alias("runtime_versions"), F.sum("clusters").alias("total_clusters"), c.total(F.col("cost")).alias("total_cost"))


@query("SELECT job_id, count(*) AS n_runs, count(*) FILTER (WHERE result_state = 'SUCCESS') AS n_success, sum(run_cost)::DECIMAL(28,6) AS total_cost, sum(seconds)::DOUBLE / count(*) AS avg_seconds FROM (SELECT r.*, coalesce(c.run_cost, 0::DECIMAL(28,6)) AS run_cost FROM m_silver_runs r LEFT JOIN (SELECT job_run_id, sum(cost)::DECIMAL(28,6) AS run_cost FROM m_priced WHERE job_run_id <> 'UNKNOWN' GROUP BY 1) c ON r.run_id = c.job_run_id) GROUP BY 1 HAVING count(*) >= 5")
def dash_job_performance(m: Model) -> DataFrame:
    rows = p.run_status_cost(m).groupBy("job_id").agg(F.count("*").alias("n_runs"), F.count_if(F.col("result_state") == "SUCCESS").alias("n_success"), c.total(F.col("run_cost")).alias("total_cost"), c.mean(F.col("seconds")).alias("avg_seconds"))
    return rows.where("n_runs >= 5")


_MOM = "CASE WHEN previous <> 0 THEN round((cost - previous)::DOUBLE * 100.0 / previous::DOUBLE, 2) END AS change_pct"


@query(f"WITH d AS (SELECT date_key // 100 AS month_key, sum(cost)::DECIMAL(28,6) AS cost FROM m_priced GROUP BY 1), l AS (SELECT *, lag(cost) OVER (ORDER BY month_key) AS previous FROM d) SELECT *, {_MOM} FROM l")
def dash_budget_mom(m: Model) -> DataFrame:
    """The one unpartitioned window runs over months, a handful of rows whatever the input."""
    d = p.priced(m).groupBy(p.month_of().alias("month_key")).agg(c.total(F.col("cost")).alias("cost"))
    return p.with_lag(d, "cost", "month_key", [])


@query(f"WITH d AS (SELECT cost_center, date_key // 100 AS month_key, sum(cost)::DECIMAL(28,6) AS cost FROM m_priced GROUP BY 1, 2), l AS (SELECT *, lag(cost) OVER (PARTITION BY cost_center ORDER BY month_key) AS previous FROM d) SELECT *, {_MOM} FROM l")
def dash_cost_center_mom(m: Model) -> DataFrame:
    d = p.priced(m).groupBy("cost_center", p.month_of().alias("month_key")).agg(c.total(F.col("cost")).alias("cost"))
    return p.with_lag(d, "cost", "month_key", ["cost_center"])


@query("SELECT runtime_version, major_version, count(DISTINCT cluster_id) AS n_clusters, array_to_string(list_sort(list_distinct(list(worker_node_type))), ', ') AS node_types, CASE WHEN major_version >= 15 THEN 3 WHEN major_version >= 13 THEN 2 ELSE 1 END AS priority FROM m_cluster_scd WHERE runtime_version IS NOT NULL GROUP BY ALL")
def runtime_modernization(m: Model) -> DataFrame:
    v = F.col("major_version")
    rank = F.when(v >= 15, 3).when(v >= 13, 2).otherwise(1)
    rows = p.dim_cluster(m).where("runtime_version IS NOT NULL").groupBy("runtime_version", "major_version").agg(F.count_distinct("cluster_id").alias("n_clusters"), F.array_join(F.array_sort(F.collect_set("worker_node_type")), ", ").alias("node_types"))
    return rows.withColumn("priority", rank).orderBy("priority", "runtime_version")


@query("SELECT cluster_id, count(*) AS versions, max(max_workers - min_workers) AS widest, sum(max_workers)::BIGINT AS workers FROM m_cluster_scd GROUP BY 1 HAVING max(max_workers - min_workers) > 5 ORDER BY workers DESC, cluster_id LIMIT 20")
def dash_cluster_sizing(m: Model) -> DataFrame:
    rows = p.dim_cluster(m).groupBy("cluster_id").agg(F.count("*").alias("versions"), F.max(F.col("max_workers") - F.col("min_workers")).alias("widest"), F.sum("max_workers").alias("workers"))
    return rows.where("widest > 5").orderBy(F.desc("workers"), "cluster_id").limit(20)


@query("SELECT result_state, trigger_type, count(*) AS n_runs, sum(seconds)::DOUBLE / count(*) AS avg_seconds, max(seconds) AS max_seconds, count(*) FILTER (WHERE result_state <> 'SUCCESS') AS n_not_successful FROM m_silver_runs GROUP BY 1, 2")
def run_summary(m: Model) -> DataFrame:
    return p.silver_runs(m).groupBy("result_state", "trigger_type").agg(F.count("*").alias("n_runs"), c.mean(F.col("seconds")).alias("avg_seconds"), F.max("seconds").alias("max_seconds"), F.count_if(F.col("result_state") != "SUCCESS").alias("n_not_successful"))


_TASK = "date_diff('second', start_time, end_time)"


@query(f"SELECT task_key, count(*) AS n_tasks, min({_TASK}) AS min_seconds, sum({_TASK})::DOUBLE / count(*) AS avg_seconds, max({_TASK}) AS max_seconds FROM m_tasks GROUP BY 1")
def run_duration_stats(m: Model) -> DataFrame:
    t = m.tasks().withColumn("s", c.seconds_between(F.col("start_time"), F.col("end_time")))
    return t.groupBy("task_key").agg(F.count("*").alias("n_tasks"), F.min("s").alias("min_seconds"), c.mean(F.col("s")).alias("avg_seconds"), F.max("s").alias("max_seconds"))


@query(f"SELECT task_key, strftime(start_time, '%Y%m')::INTEGER AS month_key, quantile_cont({_TASK}, 0.5) AS p50, quantile_cont({_TASK}, 0.9) AS p90, quantile_cont({_TASK}, 0.99) AS p99 FROM m_tasks GROUP BY 1, 2")
def task_latency_percentiles(m: Model) -> DataFrame:
    """Exact: equal durations are counted before they move, so a group holds its different durations, seconds of a day or so."""
    t = m.tasks().withColumn("s", c.seconds_between(F.col("start_time"), F.col("end_time")))
    counted = t.groupBy("task_key", F.date_format("start_time", "yyyyMM").cast("int").alias("month_key"), "s").agg(F.count("*").alias("n"))
    return counted.groupBy("task_key", "month_key").agg(*[F.percentile("s", q, F.col("n")).alias(a) for a, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))])


@query("SELECT entity_type, run_as, count(*) AS n_versions, count(DISTINCT entity_id) AS n_entities, count(*) FILTER (WHERE valid_to IS NULL) AS n_current, count(*) FILTER (WHERE valid_to IS NOT NULL) AS n_closed FROM m_entity_scd GROUP BY 1, 2")
def definition_inventory(m: Model) -> DataFrame:
    return p.dim_entity(m).groupBy("entity_type", "run_as").agg(F.count("*").alias("n_versions"), F.count_distinct("entity_id").alias("n_entities"), F.count_if("is_current").alias("n_current"), F.count_if(~F.col("is_current")).alias("n_closed"))


@query("SELECT CASE WHEN gpu_count > 0 THEN 'GPU' WHEN core_count >= 16 THEN 'High CPU' WHEN memory_mb >= 65536 THEN 'High Memory' ELSE 'Standard' END AS category, count(*) AS n_types, sum(core_count)::DOUBLE / count(*) AS avg_cores, sum(memory_mb)::DOUBLE / count(*) AS avg_memory_mb FROM m_node_types GROUP BY 1")
def node_capacity_categories(m: Model) -> DataFrame:
    category = F.when(F.col("gpu_count") > 0, "GPU").when(F.col("core_count") >= 16, "High CPU").when(F.col("memory_mb") >= 65536, "High Memory").otherwise("Standard")
    return m.node_types().groupBy(category.alias("category")).agg(F.count("*").alias("n_types"), c.mean(F.col("core_count")).alias("avg_cores"), c.mean(F.col("memory_mb")).alias("avg_memory_mb"))


@query("SELECT e.entity_id, e.name, count(r.run_id) AS n_runs, count(r.run_id) FILTER (WHERE result_state = 'SUCCESS') AS n_success, CASE WHEN count(r.run_id) > 0 THEN round(count(r.run_id) FILTER (WHERE result_state = 'SUCCESS') * 100.0::DOUBLE / count(r.run_id)::DOUBLE, 2) END AS success_pct FROM m_entity_scd e LEFT JOIN m_runs r ON e.entity_id = r.job_id AND r.start_time >= TIMESTAMP '1999-01-01' WHERE e.valid_to IS NULL GROUP BY 1, 2")
def job_success_rate(m: Model) -> DataFrame:
    """The time predicate of the join is pushed below it; runs are summed before they meet the definitions."""
    ok = m.runs().where(F.col("start_time") >= F.lit("1999-01-01").cast("timestamp_ntz")).groupBy("job_id").agg(F.count("*").alias("n"), F.count_if(F.col("result_state") == "SUCCESS").alias("s"))
    jobs = p.dim_entity(m).where("is_current").select("entity_id", "name")
    n, s = F.coalesce("n", F.lit(0)), F.coalesce("s", F.lit(0))
    return jobs.join(ok, jobs["entity_id"] == ok["job_id"], "left").select("entity_id", "name", n.alias("n_runs"), s.alias("n_success"), c.percent(s, n).alias("success_pct"))


@query("SELECT w.workspace_id, w.workspace_name, w.status, (SELECT count(DISTINCT cluster_id) FROM m_usage u WHERE u.workspace_id = w.workspace_id) AS n_clusters, (SELECT count(DISTINCT sku_name) FROM m_usage u WHERE u.workspace_id = w.workspace_id) AS n_skus, (SELECT count(*) FROM m_runs r WHERE r.workspace_id = w.workspace_id) AS n_runs FROM m_workspaces w")
def workspace_inventory(m: Model) -> DataFrame:
    """Each side is counted by workspace first, so the joins are one to one."""
    used = m.usage().select("workspace_id", F.col("usage_metadata.cluster_id").alias("cluster_id"), "sku_name").groupBy("workspace_id").agg(F.count_distinct("cluster_id").alias("n_clusters"), F.count_distinct("sku_name").alias("n_skus"))
    runs = m.runs().groupBy("workspace_id").agg(F.count("*").alias("n_runs"))
    out = m.workspaces().join(used, "workspace_id", "left").join(runs, "workspace_id", "left")
    return out.select("workspace_id", "workspace_name", "status", *[F.coalesce(x, F.lit(0).cast("bigint")).alias(x) for x in ("n_clusters", "n_skus", "n_runs")])


@query("SELECT sku_name, usage_unit, price, price_start_time FROM m_prices WHERE price_start_time <= TIMESTAMP '1999-06-01' AND price_end_time > TIMESTAMP '1999-06-01' AND sku_name LIKE 'Brand#1%'")
def current_prices(m: Model) -> DataFrame:
    at = F.lit("1999-06-01").cast("timestamp_ntz")
    return m.prices().where((F.col("price_start_time") <= at) & (F.col("price_end_time") > at) & F.col("sku_name").like("Brand#1%")).select("sku_name", "usage_unit", "price", "price_start_time")


@query("SELECT usage_unit, count(*) AS n_prices, count(DISTINCT sku_name) AS n_skus, min(price) AS min_price, max(price) AS max_price, sum(price)::DOUBLE / count(*) AS avg_price FROM m_prices GROUP BY 1")
def pricing_summary(m: Model) -> DataFrame:
    return m.prices().groupBy("usage_unit").agg(F.count("*").alias("n_prices"), F.count_distinct("sku_name").alias("n_skus"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), c.mean(F.col("price")).alias("avg_price"))


@query("SELECT result_state, termination_code, count(*) AS n_runs, sum(coalesce(run_cost, 0::DECIMAL(28,6)))::DECIMAL(28,6) AS total_cost FROM m_silver_runs r LEFT JOIN (SELECT job_run_id, sum(cost)::DECIMAL(28,6) AS run_cost FROM m_priced WHERE job_run_id <> 'UNKNOWN' GROUP BY 1) c ON r.run_id = c.job_run_id WHERE result_state <> 'SUCCESS' GROUP BY 1, 2")
def run_status_cost_impact(m: Model) -> DataFrame:
    return p.run_status_cost(m).where("result_state <> 'SUCCESS'").groupBy("result_state", "termination_code").agg(F.count("*").alias("n_runs"), c.total(F.col("run_cost")).alias("total_cost"))


@query("SELECT usage_date, count(*) AS n_records FROM m_usage GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def daily_counts_recent(m: Model) -> DataFrame:
    return m.usage().groupBy("usage_date").agg(F.count("*").alias("n_records")).orderBy(F.desc("usage_date")).limit(30)


@query("SELECT date_key, product, sum(cost)::DECIMAL(28,6) AS total_cost, count(*) AS n_records FROM m_priced WHERE usage_date > DATE '1998-08-01' - INTERVAL 30 DAY AND usage_date <= DATE '1998-08-01' GROUP BY 1, 2")
def dash_last_days(m: Model) -> DataFrame:
    """The last 30 days as of a given day."""
    return p.priced(m).where(c.last_days("date_key", "1998-08-01", 30)).groupBy("date_key", "product").agg(c.total(F.col("cost")).alias("total_cost"), F.count("*").alias("n_records"))


@query(f"""SELECT trigger_type, count(*) AS n_runs, sum(n_tasks)::BIGINT AS n_tasks, round(sum(n_tasks) * 3600.0::DOUBLE / nullif(sum(seconds), 0)::DOUBLE, 4) AS tasks_per_hour,
 round(count(*) FILTER (WHERE result_state = 'SUCCESS') * 100.0::DOUBLE / count(*)::DOUBLE, 2) AS success_pct, round(count(*) FILTER (WHERE result_state = 'FAILED') * 100.0::DOUBLE / count(*)::DOUBLE, 2) AS error_pct
 FROM (SELECT r.*, coalesce(t.n, 0) AS n_tasks FROM m_silver_runs r LEFT JOIN (SELECT run_id, count(*) AS n FROM m_tasks GROUP BY 1) t USING (run_id)) GROUP BY 1""")
def run_metrics(m: Model) -> DataFrame:
    """Throughput, success and error rates by trigger; tasks are counted by run before they meet the runs."""
    tasks = m.tasks().groupBy("run_id").agg(F.count("*").alias("n"))
    rows = p.silver_runs(m).join(tasks, "run_id", "left").groupBy("trigger_type").agg(
        F.count("*").alias("n_runs"), F.sum(F.coalesce("n", F.lit(0))).alias("n_tasks"), F.sum("seconds").alias("s"), F.count_if(F.col("result_state") == "SUCCESS").alias("ok"), F.count_if(F.col("result_state") == "FAILED").alias("bad")
    )
    rate = F.round(F.try_divide(F.col("n_tasks") * F.lit(3600.0), F.col("s").cast("double")), 4)
    return rows.select("trigger_type", "n_runs", "n_tasks", rate.alias("tasks_per_hour"), c.percent(F.col("ok"), F.col("n_runs")).alias("success_pct"), c.percent(F.col("bad"), F.col("n_runs")).alias("error_pct"))


@query("SELECT sku_name, usage_unit, price_start_time, price, lag(price) OVER w AS previous, CASE WHEN lag(price) OVER w <> 0 THEN round((price - lag(price) OVER w)::DOUBLE * 100.0 / (lag(price) OVER w)::DOUBLE, 2) END AS change_pct FROM m_prices WHERE sku_name LIKE 'Brand#2%' WINDOW w AS (PARTITION BY sku_name, usage_unit ORDER BY price_start_time)")
def price_history(m: Model) -> DataFrame:
    """All prices of the SKUs that a pattern names, each with the one before."""
    rows = m.prices().where(F.col("sku_name").like("Brand#2%")).select("sku_name", "usage_unit", "price_start_time", "price")
    return p.with_lag(rows, "price", "price_start_time", ["sku_name", "usage_unit"])


@query("SELECT region, status, count(*) AS n_workspaces FROM m_workspaces GROUP BY 1, 2")
def workspace_status_counts(m: Model) -> DataFrame:
    return m.workspaces().groupBy("region", "status").agg(F.count("*").alias("n_workspaces"))


@query("SELECT is_serverless, is_photon, count(DISTINCT pipeline_id) AS n_pipelines, count(*) AS n_records FROM m_usage WHERE pipeline_id IS NOT NULL GROUP BY 1, 2")
def pipeline_settings_counts(m: Model) -> DataFrame:
    u = m.usage().where(F.col("usage_metadata.pipeline_id").isNotNull())
    return u.groupBy(F.col("product_features.is_serverless").alias("is_serverless"), F.col("product_features.is_photon").alias("is_photon")).agg(F.count_distinct("usage_metadata.pipeline_id").alias("n_pipelines"), F.count("*").alias("n_records"))
