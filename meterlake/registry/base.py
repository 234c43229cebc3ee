"""How queries are registered: a function of the model, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.sources.model import Model

from .model_sql import full

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The oracles as written, without the model's definitions.
TEXTS: dict[str, str] = {}


def query(sql: str | None, name: str | None = None):
    def register(make: Callable[[Model], DataFrame]):
        key = name or make.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(Model(spark, sf_dir))

        run.__name__, run.__doc__ = key, make.__doc__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key], TEXTS[key] = full(sql), sql
        return make

    return register
