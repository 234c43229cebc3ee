"""Rows that match nothing, or that share one key, do not meet in one task."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import registry
from meterlake.operators import asof
from meterlake.operators import temporal as t
from meterlake.plans import facts as p
from meterlake.sources.model import Model
from meterlake.streaming import streams as st
from meterlake.streaming import versions as vs

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def plain(spark):
    """A session whose joins shuffle into 8 parts that stay as they are."""
    own = spark.newSession()
    for name, value in {"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "8", "session.timeZone": "UTC"}.items():
        own.conf.set(f"spark.sql.{name}", value)
    return own


def largest(df) -> int:
    """Rows of the fullest partition."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def usage(spark, key):
    return spark.range(4000).select("id", F.expr(key).alias("k"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2000-01-01").cast("timestamp_ntz")).alias("at"))


def history(spark):
    rows = spark.createDataFrame([(k, f"2000-0{i}-01", i) for k in ("a", "b") for i in range(1, 7)], "k string, change_time string, v int")
    return t.intervalize(rows.withColumn("change_time", F.col("change_time").cast("timestamp_ntz")), ["k"])


KEYS = {"none": "if(id % 4 = 0, 'a', 'UNKNOWN')", "null": "if(id % 4 = 0, 'a', null)"}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("join", [t.asof_join, lambda *a, **k: asof.asof_join_bucketed(*a, per_bucket=2, **k)], ids=["plain", "bucketed"])
def test_rows_without_a_version_are_dealt(plain, kind, join):
    u = usage(plain, KEYS[kind])
    out = join(u, history(plain), {"k": "k"}, u["at"], ["v"], absent=u["k"] == "UNKNOWN").cache()
    assert largest(out) < 1800
    assert out.columns == ["id", "k", "at", "v"] and out.count() == 4000
    assert out.where("v IS NOT NULL").count() == out.where("k = 'a'").count() == 1000
    out.unpersist()


def test_a_lookup_deals_null_keys(plain):
    table = plain.createDataFrame([("a", 1)], "k string, v int").groupBy("k").agg(F.max("v").alias("v"))
    out = t.lookup(usage(plain, KEYS["null"]), table, "k", "id").cache()
    assert largest(out) < 1800 and out.where("v = 1").count() == 1000 and out.count() == 4000
    out.unpersist()


@pytest.mark.parametrize("of", [lambda m: p.with_entity(p.silver_usage(m), m), lambda m: p.with_entity_of_day(p.entity_cost(m), m)], ids=["usage", "day"])
def test_usage_without_an_entity_is_dealt(plain, of):
    out = of(Model(plain, DATA)).cache()
    assert largest(out.where("entity_id = 'UNKNOWN'")) < 0.25 * out.where("entity_id = 'UNKNOWN'").count()
    out.unpersist()


def test_attribution_of_usage_without_an_entity_is_dealt(plain):
    out = registry.QUERIES["tag_inherit"](plain, DATA).cache()
    assert largest(out) < 0.25 * out.count()
    out.unpersist()


def test_runtime_versions_read_the_fact_once(spark):
    plan = registry.QUERIES["view_runtime_versions"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1 and "Expand" not in plan


@pytest.mark.parametrize("most, size", [(1, (16, True)), (0, (2, False))])
def test_a_long_list_of_long_histories_gets_larger_buckets(plain, monkeypatch, most, size):
    monkeypatch.setattr(asof, "BROADCAST_ROWS", most)
    long = plain.createDataFrame([("a", 5), ("b", 9), ("c", 300)], "k string, _n int")
    assert asof.bucket_size(long, 2) == size
    log = long.select("k", F.explode(F.sequence(F.lit(1), "_n")).alias("v")).withColumn("change_time", F.timestamp_add("HOUR", F.col("v") * 9, F.lit("2000-01-01").cast("timestamp_ntz")))
    u, versions = usage(plain, "element_at(array('a', 'b', 'c', 'd'), cast(id % 4 as int) + 1)"), t.intervalize(log, ["k"])
    got, want = (join(u, versions, {"k": "k"}, u["at"], ["v"]) for join in (lambda *a: asof.asof_join_bucketed(*a, per_bucket=2), t.asof_join))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() == 4000


def test_the_tags_view_generates_methods_that_are_compiled(plain):
    """The JVM interprets methods of more than 8,000 bytes."""
    parts = registry.QUERIES["view_tag_quality"](plain, DATA)._jdf.queryExecution().debug().codegenToSeq()
    assert parts.size() > 1
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_a_merge_builds_only_the_columns_asked_for(spark):
    plan = registry.QUERIES["join_asof_merged"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [l_orderkey" in plan and "dept_" not in plan and "SUB_WORKFLOW" not in plan


def test_a_merge_deals_rows_without_a_version(plain):
    u = usage(plain, KEYS["none"])
    out = asof.asof_merge(u, history(plain), {"k": "k"}, u["at"], ["v"], stretch=asof.STRETCH * 100, absent=u["k"] == "UNKNOWN").cache()
    assert largest(out) < 1800 and out.columns == ["id", "k", "at", "v"] and out.count() == 4000
    assert out.where("v IS NOT NULL").count() == out.where("k = 'a'").count() == 1000
    out.unpersist()


def test_a_key_of_the_versions_stream_reads_and_writes_its_state_once():
    """Each call is a round trip between Python and the JVM, so their number must not grow with the changes."""
    calls, kept = [], []

    class State:
        def __getattr__(self, name):
            calls.append(name)
            return lambda *new: kept.__setitem__(slice(None), new[0]) if new else iter(kept)

    class Handle:
        def __getattr__(self, name):
            return lambda *a: State()

    at, day = T.StructField("at", T.TimestampNTZType()), lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    of = vs.Versions(T.StructType().add("k", T.StringType()), T.StructType().add("v", T.IntegerType()), at, dt.timedelta(days=20))
    of.init(Handle())
    take = lambda *days: sorted(tuple(r) for r in of.handleInputRows(("a",), iter([Row(k="a", at=day(n), v=n) for n in days]), None))
    assert take(*range(0, 100, 10)) == [("a", n, day(n), day(n + 10) if n < 90 else None, False) for n in range(0, 100, 10)]
    assert calls == ["get", "put"] and [(r[0], r[1]) for r in kept] == [(day(n), n) for n in (70, 80, 90)]
    # Too late, and one that cuts a kept version.
    assert take(5, 75) == [("a", 5, day(5), None, True), ("a", 70, day(70), day(75), False), ("a", 75, day(75), day(80), False)]
    assert calls == ["get", "put"] * 2 and len(kept) == 4


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_stream_of_one_sku_is_joined_by_many_tasks(spark, tmp_path, how):
    at = "cast('2024-01-01' as timestamp) + make_dt_interval(cast(id as int))"
    usage = spark.range(400).selectExpr("id", "'s' AS sku_name", "'O' AS unit", f"{at} AS usage_start_time")
    day = lambda n: f"cast('2024-01-01' as timestamp) + INTERVAL {n} DAY"
    prices = spark.sql(f"SELECT 's' AS sku_name, 'O' AS unit, {day(0)} AS price_start_time, {day(100)} AS price_end_time, 1 AS price UNION ALL SELECT 's', 'O', {day(100)}, {day(390)}, 2 UNION ALL SELECT 's', 'O', {day(395)}, {day(394)}, 3")
    usage.write.parquet(str(tmp_path / "u"))
    prices.write.parquet(str(tmp_path / "p"))
    read = lambda name, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    joined = st.priced_by_stream(read("u", usage), read("p", prices), ("sku_name", "unit"), "2 days", "200 days", how)
    assert joined.columns == [*usage.columns, "price"]
    out = st.append_now(joined.withColumn("task", F.spark_partition_id()), str(tmp_path / "at")).where("price IS NOT NULL")
    got = {r["id"]: r["price"] for r in out.collect()}
    assert out.count() == len(got) and got == {n: 1 if n < 100 else 2 for n in range(301)}
    assert out.select("task").distinct().count() > 1
