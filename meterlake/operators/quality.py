"""Data quality as DataFrames: one aggregate pass for all rules, then one row a rule."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """failed counts the rows that break it."""

    name: str
    severity: str
    failed: Column


def non_negative(c: str) -> Column:
    return F.col(c) < 0


def valid_range(start: str, end: str) -> Column:
    return F.col(end) <= F.col(start)


def required(df: DataFrame, *columns: str) -> Column:
    """Rows with any required column null, or not a number."""
    kinds = dict(df.dtypes)
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull() | (F.isnan(c) if kinds[c] in {"double", "float"} else F.lit(False))
    return out


def results(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, severity, checked, failed, passed, ok: all rules in one scan."""
    counts = df.agg(F.count("*").alias("checked"), *[F.count_if(r.failed).alias(f"f{k}") for k, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"f{k}").alias("failed")) for k, r in enumerate(rules)])
    out = counts.select("checked", F.inline(rows))
    return out.select("rule", "severity", "checked", "failed", (F.col("checked") - F.col("failed")).alias("passed"), (F.col("failed") == 0).alias("ok"))


def checked_write(df: DataFrame, rules: Sequence[Rule], path: str) -> DataFrame:
    """Writes df with its reasons into path/is_good=true and path/is_good=false and returns results() of the rules.

    The counts are observed while the rows are written: one job, one scan, whatever the number of rules. A task that is run again counts its
    rows once.
    """
    seen = Observation()
    counts = [F.count_if(r.failed).alias(f"f{k}") for k, r in enumerate(rules)]
    quarantine(df.observe(seen, F.count(F.lit(1)).alias("checked"), *counts), rules).write.mode("overwrite").partitionBy("is_good").parquet(path)
    got = seen.get
    rows = [(r.name, r.severity, got["checked"], got[f"f{k}"], got["checked"] - got[f"f{k}"], got[f"f{k}"] == 0) for k, r in enumerate(rules)]
    return df.sparkSession.createDataFrame(rows, "rule string, severity string, checked bigint, failed bigint, passed bigint, ok boolean")


def score(rule_results: DataFrame) -> DataFrame:
    return rule_results.agg(
        F.count("*").alias("rules"), F.count_if("ok").alias("rules_passed"), F.round(F.count_if("ok") * 100.0 / F.count("*"), 2).cast("double").alias("success_rate"),
        F.round(F.sum("passed").cast("double") * 100.0 / F.sum("checked").cast("double"), 2).alias("quality_score"),
    )


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with reasons (names of the rules that a row breaks) and is_good."""
    reasons = F.array_compact(F.array(*[F.when(r.failed, F.lit(r.name)) for r in rules]))
    return df.withColumn("reasons", reasons).withColumn("is_good", F.size("reasons") == 0)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_rows, nulls, distinct_values in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[x for c in columns for x in (F.count_if(F.col(c).isNull()).alias(f"n_{c}"), F.count_distinct(c).alias(f"d_{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("nulls"), F.col(f"d_{c}").alias("distinct_values")) for c in columns])
    return counts.select(F.col("n").alias("n_rows"), F.inline(rows))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str, fresh_hours: int = 24, stale_hours: int = 48) -> DataFrame:
    """table_name, last_ts, age_hours, status: FRESH, STALE or VERY_STALE."""
    out = None
    for name, (df, ts) in tables.items():
        one = df.agg(F.max(ts).cast("timestamp_ntz").alias("last_ts")).select(F.lit(name).alias("table_name"), "last_ts")
        out = one if out is None else out.union(one)
    age = F.timestamp_diff("HOUR", F.col("last_ts"), F.lit(as_of).cast("timestamp_ntz"))
    return out.withColumn("age_hours", age).withColumn("status", F.when(F.col("age_hours") < fresh_hours, "FRESH").when(F.col("age_hours") < stale_hours, "STALE").otherwise("VERY_STALE"))


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.union(one)
    return out.withColumn("status", F.when(F.col("n_rows") == 0, "EMPTY").otherwise("OK"))
