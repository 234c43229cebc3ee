"""Every registered query of the engine against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from meterlake import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall())
    assert sorted(tuple(map(plain, row)) for row in df.select(*columns).collect()) == want


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
