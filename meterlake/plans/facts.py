"""Silver tables, dimensions and facts over the model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import columns as c
from meterlake.operators import temporal as t
from meterlake.operators.sizes import small
from meterlake.sources.model import Model, metadata, with_runtime

FOREVER = "9999-12-31 00:00:00"
#: The id of usage without a job or a pipeline, often half of all; no definition has it.
UNKNOWN = "UNKNOWN"
CLUSTER_COLUMNS = ("cluster_name", "kind", "runtime_version", "major_version", "minor_version", "worker_node_type", "node_family", "min_workers", "max_workers", "cluster_current")


def silver_usage(m: Model, *more: Column) -> DataFrame:
    """Usage with its entity, flattened metadata, defaulted tags and date key; more: further columns over the raw usage."""
    u = m.usage()
    job, pipeline = metadata("job_id"), metadata("pipeline_id")
    return u.select(
        "record_id", "workspace_id", "cloud", "sku_name", "usage_unit", "product",
        c.first_of([(job.isNotNull(), F.lit("JOB")), (pipeline.isNotNull(), F.lit("PIPELINE"))], F.col("product")).alias("entity_type"),
        F.coalesce(job, pipeline, F.lit(UNKNOWN)).alias("entity_id"), F.coalesce(metadata("job_run_id"), F.lit(UNKNOWN)).alias("job_run_id"), metadata("cluster_id").alias("cluster_id"),
        F.col("product_features.is_serverless").alias("is_serverless"), "usage_start_time", "usage_end_time", "usage_date", c.date_key(F.col("usage_date")).alias("date_key"), "usage_quantity",
        *[c.defaulted(c.tag(F.col("custom_tags"), k), k).alias(k) for k in c.TAGS], *more,
    )


def silver_runs(m: Model) -> DataFrame:
    r = m.runs()
    return r.withColumns({"date_key": c.date_key(F.col("start_time")), "end_date_key": c.date_key(F.col("end_time")), "seconds": c.seconds_between(F.col("start_time"), F.col("end_time"))})


def silver_tasks(m: Model) -> DataFrame:
    """Task runs with the date keys of both ends and their execution time."""
    r = m.tasks()
    return r.withColumns({"date_key": c.date_key(F.col("start_time")), "end_date_key": c.date_key(F.col("end_time")), "seconds": c.seconds_between(F.col("start_time"), F.col("end_time"))})


def dim_entity(m: Model) -> DataFrame:
    versions = t.intervalize(m.entity_log(), ["entity_type", "entity_id"])
    return versions.withColumn("entity_key", c.surrogate("entity_type", "entity_id", "valid_from"))


def dim_cluster(m: Model) -> DataFrame:
    """Clusters and warehouses in one versioned dimension; runtime columns are null for warehouses."""
    log = with_runtime(m.compute_log())
    clusters = log.where("kind = 'CLUSTER'")
    warehouses = log.where("kind = 'WAREHOUSE'").select("cluster_id", "cluster_name", "kind", "min_workers", "max_workers", "change_time")
    versions = t.intervalize(clusters.unionByName(warehouses, allowMissingColumns=True), ["cluster_id"])
    return versions.withColumn("cluster_key", c.surrogate("cluster_id", "valid_from"))


def dim_sku(m: Model) -> DataFrame:
    return m.prices().select("sku_name", "usage_unit", "price", F.col("price_start_time").alias("valid_from"), F.col("price_end_time").alias("valid_to")).distinct()


def dim_run_status(m: Model) -> DataFrame:
    """Keyed on state and code together, so a join on both never fans out."""
    return m.runs().select(F.concat_ws("|", "result_state", "termination_code").alias("run_status_key"), "result_state", "termination_code").distinct()


def dim_date(m: Model) -> DataFrame:
    """Every day between the first and the last order of the input."""
    bounds = m.raw("orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    month_end = d == F.last_day(d)
    return days.select(
        c.date_key(d).alias("date_key"), "date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.day(d).alias("day"), F.dayofweek(d).alias("day_of_week"), F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), month_end.alias("is_month_end"), (month_end & (F.month(d) % 3 == 0)).alias("is_quarter_end"), (month_end & (F.month(d) == 12)).alias("is_year_end"),
    )


def priced(m: Model, how: str = "inner", *more: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Usage with the price of its start; keep: further columns of the price list, as sku_from."""
    return t.price_join(silver_usage(m, *more), price_list(m), how, keep=keep)


def price_list(m: Model) -> DataFrame:
    """The price list, counted once a model, as it is broadcast where it is small."""
    if m.price_list is None:
        m.price_list = small(m.prices().withColumn("sku_from", F.col("price_start_time")))
    return m.price_list


def no_entity(facts: DataFrame) -> Column:
    return facts["entity_id"] == UNKNOWN


def with_entity_of_day(facts: DataFrame, m: Model, day: str = "date_key", join=t.asof_join) -> DataFrame:
    """Daily facts with the name and the version key of the entity as of the day."""
    versions = dim_entity(m).select("entity_type", "entity_id", "valid_from", "valid_to", F.col("name").alias("entity_name"), F.col("valid_from").alias("entity_from"))
    return join(facts, versions, {"entity_type": "entity_type", "entity_id": "entity_id"}, facts[day], ["entity_name", "entity_from"], "left", c.date_key(F.col("valid_from")), c.date_key(F.col("valid_to")), absent=no_entity(facts))


def with_entity(facts: DataFrame, m: Model, join=t.asof_join) -> DataFrame:
    versions = dim_entity(m).select("*", F.col("name").alias("entity_name"), F.col("valid_from").alias("entity_from"))
    return join(facts, versions, {"entity_type": "entity_type", "entity_id": "entity_id"}, facts["usage_start_time"], ["entity_name", "entity_from", "run_as"], absent=no_entity(facts))


def with_cluster(facts: DataFrame, m: Model, join=t.asof_join) -> DataFrame:
    """Bounds are truncated to the hour, an open end is capped, so a version that lives within an hour never matches."""
    versions = dim_cluster(m).withColumnRenamed("is_current", "cluster_current")
    start = F.date_trunc("hour", F.col("valid_from")).cast("timestamp_ntz")
    end = F.coalesce(F.date_trunc("hour", F.col("valid_to")).cast("timestamp_ntz"), F.lit(FOREVER).cast("timestamp_ntz"))
    return join(facts, versions, {"cluster_id": "cluster_id"}, facts["usage_start_time"], list(CLUSTER_COLUMNS), "left", start, end)


def assert_one_match(versions: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Raises if versions of a key overlap in any of these histories (name: versions, keys): a fact would meet two of them.

    Once a build, before usage_fact(): its joins rely on it. One window a history; one number of each comes to the driver.
    """
    for name, (of, keys) in versions.items():
        bad = t.problems(of, keys).agg(F.sum("overlaps")).first()[0]
        if bad:
            raise ValueError(f"{name}: {bad} versions overlap the next one of their key")


def histories(m: Model) -> dict[str, tuple[DataFrame, list[str]]]:
    """The versioned tables that usage_fact() joins."""
    prices = m.prices().withColumns({"valid_from": F.col("price_start_time"), "valid_to": F.col("price_end_time"), "is_current": F.col("price_end_time").isNull()})
    return {"entities": (dim_entity(m), ["entity_type", "entity_id"]), "clusters": (dim_cluster(m), ["cluster_id"]), "prices": (prices, ["sku_name", "usage_unit"])}


ENTITY_COLUMNS = ("entity_name", "entity_from", "run_as")
WORKSPACE_COLUMNS = ("workspace_name", "region", "status")


def usage_fact(m: Model, *need: str, join=t.asof_join) -> DataFrame:
    """The priced usage fact: one row a record, with the dimension attributes valid at its start.

    need: the attributes that are asked for, by default all; a dimension of which none is asked for is not joined. The optimizer
    can't leave such a join out by itself, as it can't know that one version matches at most: intervals of a key never overlap, which
    assert_one_match(histories(m)) checks for a build. join: asof.asof_join_bucketed where definitions change often.
    """
    asked = lambda columns: not need or not set(need).isdisjoint(columns)
    # The SKU's version is the price's: both are valid at the start of usage.
    facts = priced(m, keep=("sku_from",) if asked(["sku_from"]) else ())
    if asked(ENTITY_COLUMNS):
        facts = with_entity(facts, m, join)
    if asked(CLUSTER_COLUMNS):
        facts = with_cluster(facts, m, join)
    if asked(WORKSPACE_COLUMNS):
        facts = facts.join(m.workspaces().select("workspace_id", *WORKSPACE_COLUMNS), "workspace_id", "left")
    return facts


def entity_cost(m: Model) -> DataFrame:
    return priced(m).groupBy("date_key", "workspace_id", "entity_type", "entity_id").agg(c.total(F.col("cost")).alias("total_cost"), c.total(F.col("usage_quantity")).alias("total_quantity"), F.count_distinct("job_run_id").alias("n_runs"), F.count("*").alias("n_records"))


def run_cost(m: Model) -> DataFrame:
    """Cost a run; usage without a run is left out."""
    facts = priced(m).where("job_run_id <> 'UNKNOWN'")
    return facts.groupBy("entity_id", "job_run_id").agg(c.total(F.col("cost")).alias("run_cost"), c.total(F.col("usage_quantity")).alias("run_quantity"))


def run_status_cost(m: Model) -> DataFrame:
    """Every run with its cost, 0 where no priced usage names it."""
    cost = run_cost(m).select(F.col("job_run_id").alias("run_id"), "run_cost")
    runs = silver_runs(m).join(cost, "run_id", "left")
    key = F.concat_ws("|", "result_state", "termination_code")
    return runs.withColumns({"run_cost": F.coalesce("run_cost", F.lit(0).cast(c.TOTAL)), "run_status_key": key, "entity_type": F.lit("JOB"), "entity_id": F.col("job_id")})


def runs_finished(m: Model) -> DataFrame:
    state = lambda s: F.count_if(F.col("result_state") == s)
    return silver_runs(m).groupBy("end_date_key", "workspace_id", F.lit("JOB").alias("entity_type"), F.col("job_id").alias("entity_id")).agg(F.count("*").alias("finished_runs"), state("SUCCESS").alias("success_runs"), state("FAILED").alias("failed_runs"), state("CANCELLED").alias("cancelled_runs"))


def month_of(date_key: str = "date_key"):
    return F.expr(f"{date_key} div 100")


def with_lag(df: DataFrame, measure: str, order: str, by: list[str]) -> DataFrame:
    """Previous period's measure and the change in percent; partitions first roll up, so a window holds periods only."""
    w = Window.partitionBy(*by).orderBy(order)
    out = df.withColumn("previous", F.lag(measure).over(w))
    return out.withColumn("change_pct", c.percent(F.col(measure) - F.col("previous"), F.col("previous")))
