"""Watermarks, change feeds and processing state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import upsert_all
from .temporal import latest

EPOCH = "1900-01-01 00:00:00"


def hwm_scan(df: DataFrame, ts: str, last: str | None, overlap_hours: int = 0) -> DataFrame:
    """Rows after a watermark less an overlap; all rows if the watermark is null or no timestamp.

    The bound is one literal, so the filter on the raw column reaches the scan.
    """
    bound = F.coalesce(F.lit(last).try_cast("timestamp_ntz"), F.lit(EPOCH).cast("timestamp_ntz"))
    return df.where(F.col(ts) > F.timestamp_add("HOUR", F.lit(-overlap_hours), bound))


def live_changes(feed: DataFrame) -> DataFrame:
    return feed.where(~F.col("_change_type").isin("delete", "update_preimage"))


def version_range(feed: DataFrame, after: int, until: int, kinds: Sequence[str] | None = None) -> DataFrame:
    """Changes of versions (after, until], of some kinds; an empty frame of the same type where there is nothing new."""
    out = feed.where((F.col("_commit_version") > after) & (F.col("_commit_version") <= until))
    return out.where(F.col("_change_type").isin(*kinds)) if kinds else out


def net_change(feed: DataFrame, keys: Sequence[str], tie: str) -> DataFrame:
    """The last live change of each key."""
    return latest(live_changes(feed), keys, F.desc("_commit_timestamp"), F.desc(tie))


def commit(state: DataFrame, progress: DataFrame) -> DataFrame:
    """State (source, task, last_ts, last_version) with the progress of some tasks; other tasks keep their own offsets.

    An offset never moves back.
    """
    old = state.select("source", "task", F.col("last_ts").alias("_ts"), F.col("last_version").alias("_v"))
    ahead = progress.join(old, ["source", "task"], "left").select("source", "task", F.greatest("last_ts", "_ts").alias("last_ts"), F.greatest("last_version", "_v").alias("last_version"))
    return upsert_all(state, ahead, ["source", "task"])


def reset(state: DataFrame, source: str, task: str) -> DataFrame:
    return state.where(~((F.col("source") == source) & (F.col("task") == task)))


def lagging(state: DataFrame, as_of: str, max_hours: int) -> DataFrame:
    hours = F.timestamp_diff("HOUR", F.col("last_ts"), F.lit(as_of).cast("timestamp_ntz"))
    return state.withColumn("lag_hours", hours).where(F.col("last_ts").isNull() | (F.col("lag_hours") > max_hours))


def max_watermark(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("watermark"), F.count("*").alias("n_rows"))
