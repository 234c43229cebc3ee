"""Operators on small hand-made tables: boundaries, nulls, replays and the worked as-of example."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import columns as c
from meterlake.operators import incremental as inc
from meterlake.operators import merge as up
from meterlake.operators import quality as dq
from meterlake.operators import schema as sch
from meterlake.operators import temporal as t

D = dt.datetime


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_asof_join_takes_the_version_of_the_time(spark):
    versions = spark.createDataFrame([("w", "e", "A", D(2025, 6, 1), D(2025, 8, 25), False), ("w", "e", "B", D(2025, 8, 25), None, True)], "ws string, id string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    facts = spark.createDataFrame([(1, "w", "e", D(2025, 7, 15), 15.75), (2, "w", "e", D(2025, 8, 20), 11.28), (3, "w", "e", D(2025, 9, 1), 18.12), (4, "w", "e", D(2025, 9, 15), 14.30), (5, "w", "e", D(2025, 8, 25), 0.0), (6, "w", "e", D(2025, 1, 1), 0.0), (7, "w", None, D(2025, 7, 1), 0.0)], "n int, ws string, id string, at timestamp_ntz, cost double")
    out = t.asof_join(facts, versions, {"ws": "ws", "id": "id"}, facts["at"], ["name"])
    assert [tuple(r) for r in out.orderBy("n").select("n", "name").collect()] == [(1, "A"), (2, "A"), (3, "B"), (4, "B"), (5, "B"), (6, None), (7, None)]
    assert out.where("name = 'B'").agg(F.round(F.sum("cost"), 2)).first()[0] == 32.42


def test_price_join_is_half_open_and_keeps_unpriced_usage_on_demand(spark):
    prices = spark.createDataFrame([("s", "u", D(2020, 1, 1), D(2021, 1, 1), Decimal("2")), ("s", "u", D(2021, 1, 1), None, Decimal("3"))], "sku_name string, usage_unit string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, price decimal(18,6)")
    usage = spark.createDataFrame([(1, "s", "u", D(2019, 12, 31), Decimal(5)), (2, "s", "u", D(2020, 1, 1), Decimal(5)), (3, "s", "u", D(2021, 1, 1), Decimal(5)), (4, "x", "u", D(2021, 1, 1), Decimal(5))], "n int, sku_name string, usage_unit string, usage_start_time timestamp_ntz, usage_quantity decimal(18,6)")
    assert rows(t.price_join(usage, prices).select("n", F.col("cost").cast("int"))) == [(2, 10), (3, 15)]
    assert rows(t.price_join(usage, prices, "left").select("n", "has_price", F.col("cost").cast("int"))) == [(1, False, 0), (2, True, 10), (3, True, 15), (4, False, 0)]


def test_accounts_have_prices_of_their_own(spark):
    usage = spark.createDataFrame([(1, "x", "s", "u", D(2024, 1, 1), Decimal(10)), (2, "y", "s", "u", D(2024, 1, 1), Decimal(10)), (3, "z", "s", "u", D(2024, 1, 1), Decimal(10))], "n int, account_id string, sku_name string, usage_unit string, usage_start_time timestamp_ntz, usage_quantity decimal(18,6)")
    prices = spark.createDataFrame([("x", "s", "u", D(2024, 1, 1), None, Decimal(1)), ("y", "s", "u", D(2024, 1, 1), None, Decimal(2))], "account_id string, sku_name string, usage_unit string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, price decimal(18,6)")
    out = t.price_join(usage, prices, "left", (*t.PRICE_KEYS, "account_id"), ["price_start_time"])
    assert rows(out.select("n", F.col("cost").cast("int"), "price_start_time")) == [(1, 10, D(2024, 1, 1)), (2, 20, D(2024, 1, 1)), (3, 0, None)]


def test_the_priced_fact_joins_the_price_list_once(spark):
    from meterlake import registry

    plan = registry.QUERIES["fact_usage_priced"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max(p_retailprice") == 1


def test_a_build_is_refused_where_versions_overlap(spark):
    from meterlake.plans import facts as p
    from meterlake.sources.model import Model

    p.assert_one_match(p.histories(Model(spark, "/root/testdata/sf0.001")))
    versions = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 1, 9), False), ("a", D(2024, 1, 5), None, True)], "id string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    with pytest.raises(ValueError, match="jobs: 1 versions overlap"):
        p.assert_one_match({"jobs": (versions, ["id"])})


def log(spark, changes):
    return spark.createDataFrame([(k, v, D(2024, 1, 1) + dt.timedelta(days=d)) for k, v, d in changes], "k string, v string, change_time timestamp_ntz")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", None]), st.integers(0, 20)), min_size=1, max_size=12, unique_by=lambda x: (x[0], x[2])), st.randoms())
def test_merging_batches_equals_one_batch(spark, changes, random):
    batches = [[], [], []]
    for change in changes:
        batches[random.randrange(3)].append(change)
    history = t.intervalize(log(spark, batches[0]), ["k"])
    for batch in batches[1:]:
        history = t.merge_increment(history, log(spark, batch), ["k"])
    order = ["k", "v", "valid_from", "valid_to", "is_current"]
    assert rows(history.select(order)) == rows(t.intervalize(log(spark, changes), ["k"]).select(order))
    assert all(r["overlaps"] == 0 and r["gaps"] == 0 and r["current_rows"] == 1 for r in t.problems(history, ["k"]).collect())


def test_close_and_insert_is_idempotent_and_sees_nulls(spark):
    dim = spark.createDataFrame([("a", "x", D(2024, 1, 1), None, True), ("b", "y", D(2024, 1, 1), None, True)], "k string, v string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    new = log(spark, [("a", None, 5), ("b", "y", 5), ("c", "z", 5)])
    once = t.close_and_insert(dim, new, ["k"], ["v"])
    assert rows(t.close_and_insert(once, new, ["k"], ["v"])) == rows(once)
    assert rows(once.where("is_current").select("k", "v")) == [("a", None), ("b", "y"), ("c", "z")]


def test_upserts_take_null_keys_and_store_the_new_hash(spark):
    schema = "k string, v string, row_hash string"
    old = spark.createDataFrame([("a", "1", "h1"), (None, "2", "h2"), ("c", "3", "h3")], schema)
    new = spark.createDataFrame([("a", "1", "h1"), (None, "9", "h9"), ("d", "4", "h4")], schema)
    want = rows(spark.createDataFrame([("a", "1", "h1"), (None, "9", "h9"), ("c", "3", "h3"), ("d", "4", "h4")], schema))
    once = up.upsert_guarded(old, new, ["k"])
    assert rows(once) == want and rows(up.upsert_guarded(once, new, ["k"])) == want and rows(up.upsert_all(old, new, ["k"])) == want
    assert rows(up.change_feed(old, new, ["k"]).select("k", "_change_type")) == rows(spark.createDataFrame([(None, "update_postimage"), ("d", "insert")], "k string, t string"))
    assert up.change_feed(once, new, ["k"]).isEmpty()


def test_upsert_keeps_the_surrogate(spark):
    old = spark.createDataFrame([("a", "1", 7)], "k string, v string, sk bigint")
    out = up.upsert_keep_surrogate(old, spark.createDataFrame([("a", "2"), ("b", "3")], "k string, v string"), ["k"], "sk", F.lit(99).cast("bigint"))
    assert rows(out) == [("a", "2", 7), ("b", "3", 99)]


def test_partition_overwrite_replaces_only_what_it_brings(spark, tmp_path):
    path = str(tmp_path / "t")
    up.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "d int, v string"), path, "d", sort=["v"])
    up.write_partitions(spark.createDataFrame([(2, "c")], "d int, v string"), path, "d")
    assert rows(spark.read.parquet(path).select("d", "v")) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize(("last", "overlap", "n"), [(None, 0, 3), ("no time", 0, 3), ("2024-01-02 00:00:00", 0, 1), ("2024-01-02 00:00:00", 24, 2), ("2024-01-02 00:00:00", 48, 3)])
def test_watermark_scan(spark, last, overlap, n):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 3),)], "ts timestamp_ntz")
    assert inc.hwm_scan(df, "ts", last, overlap).count() == n


def test_watermark_scan_is_pushed_into_the_reader(spark):
    df = inc.hwm_scan(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderdate", "1999-01-01 00:00:00", 48)
    assert "GreaterThan(o_orderdate" in df.select("o_orderkey")._jdf.queryExecution().toString()


def test_tasks_keep_their_own_offsets_and_never_move_back(spark):
    schema = "source string, task string, last_ts timestamp_ntz, last_version bigint"
    state = spark.createDataFrame([("s", "a", D(2024, 1, 5), 5), ("s", "b", D(2024, 1, 1), 1)], schema)
    state = inc.commit(state, spark.createDataFrame([("s", "a", D(2024, 1, 2), 2), ("s", "c", D(2024, 1, 9), 9)], schema))
    assert rows(state.select("task", "last_version")) == [("a", 5), ("b", 1), ("c", 9)]
    assert [r["task"] for r in inc.lagging(state, "2024-01-09 00:00:00", 72).orderBy("task").collect()] == ["a", "b"]
    assert inc.reset(state, "s", "b").count() == 2


def test_tags_runtime_and_node_families(spark):
    df = spark.createDataFrame([({"environment": "PRODUCTION", "cost_center": " "},), ({"environment": "Zed"},), (None,)], "tags map<string,string>")
    out = df.select(c.defaulted(c.tag(F.col("tags"), "environment"), "environment"), c.defaulted(c.tag(F.col("tags"), "cost_center"), "cost_center"), c.is_missing(c.tag(F.col("tags"), "cost_center"), "cost_center"))
    assert [tuple(r) for r in out.collect()] == [("prod", "unallocated", True), ("zed", "unallocated", True), ("dev", "unallocated", True)]
    versions = spark.createDataFrame([("13.3.x-photon-scala2.12",), ("dlt:16.4",), ("custom:abc",), (None,)], "v string")
    parsed = c.runtime(F.col("v"))
    assert [tuple(r) for r in versions.select(parsed["major_version"], parsed["minor_version"], parsed["is_photon"]).collect()] == [(13, 3, True), (16, 4, False), (None, None, False), (None, None, None)]
    nodes = spark.createDataFrame([("Standard_DS3_v2",), ("Standard_E4s_v3",), ("m5.large",), ("unknown",)], "n string")
    assert [r[0] for r in nodes.select(c.node_family(F.col("n"))).collect()] == ["General Purpose (DS)", "Memory Optimized (E)", "General Purpose (M-family)", "Other"]


def test_quality_rules_count_nulls_and_nans_in_one_pass(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (-1.0, None), (None, None)], "x double, y string")
    rules = [dq.Rule("sign", "ERROR", dq.non_negative("x")), dq.Rule("required", "CRITICAL", dq.required(df, "x", "y"))]
    assert rows(dq.results(df, rules)) == [("required", "CRITICAL", 4, 3, 1, False), ("sign", "ERROR", 4, 1, 3, False)]
    assert [r["reasons"] for r in dq.quarantine(df, rules).collect()] == [[], ["required"], ["sign", "required"], ["required"]]
    assert dq.results(df.limit(0), rules).select("failed").distinct().collect()[0][0] == 0


def test_schema_alignment_and_drift(spark):
    source = spark.createDataFrame([(1, ("5", 2))], "a int, s struct<x: string, z: int>")
    target = T.StructType([T.StructField("s", T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])), T.StructField("b", T.DateType())])
    out = sch.align_to_schema(source, target)
    assert out.schema.simpleString() == "struct<s:struct<x:int,y:string>,b:date>" and tuple(out.first()["s"]) == (5, None)
    assert [(p, k) for p, k, *_ in sch.drift(source.schema, target)] == [("a", "extra"), ("b", "missing"), ("s.x", "type_changed"), ("s.y", "missing"), ("s.z", "extra")]


def test_overlap_join_picks_the_latest_version(spark):
    versions = spark.createDataFrame([("e", "A", D(2024, 1, 1), D(2024, 1, 5)), ("e", "B", D(2024, 1, 5), None)], "id string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(1, "e", D(2024, 1, 4), D(2024, 1, 6)), (2, "e", D(2024, 1, 4), D(2024, 1, 5)), (3, "q", D(2024, 1, 4), D(2024, 1, 5))], "n int, id string, a timestamp_ntz, b timestamp_ntz")
    assert rows(t.overlap_join(facts, versions, {"id": "id"}, facts["a"], facts["b"], ["name"], "n").select("n", "name")) == [(1, "B"), (2, "A"), (3, None)]


def test_rollups_join_only_the_dimensions_they_name(spark):
    from meterlake import registry

    def plan(name):
        return registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()

    allocation, departments, clusters = plan("view_cost_allocation"), plan("view_department_cost"), plan("view_cluster_cost")
    assert "supplier" not in allocation + departments and "s_suppkey" not in allocation + departments
    # Definition versions come from one window, cluster versions from two more.
    assert allocation.count("\n") < clusters.count("\n") and "runtime" not in allocation and allocation.count("Window [lead") == 1
    assert "Window [lead" not in departments and clusters.count("Window [lead") == 1
    assert "strategy=broadcast" in departments  # the price list, once counted


def test_streams_go_on_where_they_ended_and_take_nothing(spark, tmp_path):
    from meterlake.streaming import streams as st

    source, at = str(tmp_path / "in"), str(tmp_path / "at")
    schema = "k string, n int"
    write = lambda values: spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    write([("a", 1), ("b", 5)])
    assert rows(st.upsert_now(stream(), ["k"], ["n"], at)) == [("a", 1), ("b", 5)]
    write([("a", 3), ("c", 2)])
    want = [("a", 3), ("b", 5), ("c", 2)]
    assert rows(st.upsert_now(stream(), ["k"], ["n"], at)) == want  # another driver would find the same folder
    assert rows(st.upsert_now(stream(), ["k"], ["n"], at)) == want  # nothing new
    counts = lambda: st.complete_now(stream().groupBy("k").agg(F.sum("n").alias("n")), str(tmp_path / "sums"))
    assert rows(counts()) == rows(counts()) == [("a", 4), ("b", 5), ("c", 2)]
    (tmp_path / "none").mkdir()
    empty = spark.readStream.schema(schema).parquet(str(tmp_path / "none"))
    assert rows(st.upsert_now(empty, ["k"], ["n"])) == [] and rows(st.complete_now(empty.groupBy("k").count())) == []


def test_drift_is_counted_in_rows(spark):
    df = spark.createDataFrame([("5", 1, (1,)), ("x", None, None)], "a string, b int, s struct<z: int>")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.DateType()), T.StructField("s", T.StructType([T.StructField("z", T.IntegerType())]))])
    assert rows(sch.drift_report(df, target)) == [("a", "type_changed", "string", "int", 1), ("b", "extra", "int", None, 1), ("c", "missing", None, "date", 2)]
    assert rows(sch.drift_report(df, df.schema)) == []


def test_absent_tags_equal_their_defaults(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "  ", "dev", " Development ", "prod", "unallocated", "Unknown", "None", "x")], "v string")
    for name in c.TAGS:
        assert df.where(c.is_absent(F.col("v"), name) != c.is_missing(c.defaulted(F.col("v"), name), name)).count() == 0


def test_absent_tags_as_an_array_equal_each_tag(spark):
    values = (None, "", "  ", "dev", " Development ", "prod", "unallocated", "Unknown", "unknown", "None", "x")
    df = spark.createDataFrame([({k: v for k in c.TAGS},) for v in values] + [({},), (None,)], "tags map<string, string>")
    each = F.array(*[c.is_absent(c.tag(F.col("tags"), k), k) for k in c.TAGS])
    assert df.where(c.absent_tags(F.col("tags")) == each).count() == df.count()


def test_last_days_end_with_the_day_asked_for():
    assert c.last_days("d", "2000-03-01", 2) == "d BETWEEN 20000229 AND 20000301"
