"""Cost rollups of the usage fact: keys, measures, filters and top-k as one declarative shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import columns as c



def _run() -> Column:
    return F.nullif(F.col("job_run_id"), F.lit("UNKNOWN"))


MEASURES = {
    "total_cost": lambda: c.total(F.col("cost")),
    "total_quantity": lambda: c.total(F.col("usage_quantity")),
    "n_records": lambda: F.count("*"),
    "n_entities": lambda: F.count_distinct("entity_id"),
    "n_runs": lambda: F.count_distinct(_run()),
    "cost_per_run": lambda: F.try_divide(F.sum("cost").cast("double"), F.count_distinct(_run()).cast("double")),
    "n_workspaces": lambda: F.count_distinct("workspace_id"),
    "n_clusters": lambda: F.count_distinct("cluster_id"),
    "n_days": lambda: F.count_distinct("date_key"),
    "avg_cost": lambda: c.mean(F.col("cost")),
    "cost_per_unit": lambda: F.try_divide(F.sum("cost").cast("double"), F.sum("usage_quantity").cast("double")),
    "cost_per_entity": lambda: F.try_divide(F.sum("cost").cast("double"), F.count_distinct("entity_id").cast("double")),
    "cost_per_workspace": lambda: F.try_divide(F.sum("cost").cast("double"), F.count_distinct("workspace_id").cast("double")),
}
USUAL = ("total_cost", "total_quantity", "n_records", "n_entities", "avg_cost")


def rollup(fact: DataFrame, keys: Sequence[str | Column], measures: Sequence[str] = USUAL, where: str | None = None, having: str | None = None, top: int | None = None) -> DataFrame:
    """fact grouped by keys; top keeps the most expensive, ties by the keys (a take of ordered rows, no full sort)."""
    rows = fact.where(where) if where else fact
    # An entity's own group has one entity; a distinct count would add an aggregation.
    measure = lambda m: F.max(F.lit(1).cast("bigint")) if m == "n_entities" and "entity_id" in [k for k in keys if isinstance(k, str)] else MEASURES[m]()
    out = rows.groupBy(*keys).agg(*[measure(m).alias(m) for m in measures])
    out = out.where(having) if having else out
    return out.orderBy(F.desc("total_cost"), *out.columns[: len(keys)]).limit(top) if top else out
