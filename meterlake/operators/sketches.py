"""Quantiles from mergeable sketches: one sketch a group and day is stored, longer periods are merged from them.

A sketch of size k holds some k numbers, however many it has seen, and its quantiles are off by a bounded share of ranks: for k = 800 by less
than 0.5 % at 99 % confidence. Sketches are aggregated on the map side, so a hot group costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 800
#: A quantile's rank is within this of the one asked for, by a margin of three times the bound of one in a hundred.
RANK_ERROR = 0.015


def sketched(rows: DataFrame, by: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """by, n and the sketch of a whole-number column; nulls are not counted."""
    return rows.groupBy(*by).agg(F.count(value).alias("n"), F.kll_sketch_agg_bigint(value, size).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str], size: int = SIZE) -> DataFrame:
    """Sketches of finer groups as one a group of ``by``."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", size).alias("sketch"))


def quantiles(sketches: DataFrame, **at: float) -> DataFrame:
    """The sketches' quantiles by name, as p50=0.5; null where nothing was counted."""
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q).cast("double"))).alias(name) for name, q in at.items()])
