"""Long histories, stored tables and feeds, keyed streaming state, sketches, evolving files, pruning and observed checks."""

from __future__ import annotations

import datetime as dt
import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import asof, folders, sketches
from meterlake.operators import quality as dq
from meterlake.operators import schema as sch
from meterlake.operators import temporal as t
from meterlake.operators.keyed_table import KeyedTable, newest
from meterlake.plans import declared
from meterlake.streaming import streams as st
from meterlake.streaming import versions as vs

D = dt.datetime


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# As-of joins


def histories(spark, seed):
    """Versions with gaps and open ends, a long and many short histories; facts with null keys and times, on the very bounds too."""
    rng, day, versions = random.Random(seed), lambda n: D(2024, 1, 1) + dt.timedelta(hours=n), []
    for key, n in [("long", 60), *[(f"k{i}", rng.randrange(1, 4)) for i in range(12)]]:
        cuts = sorted(rng.sample(range(0, 3000), n + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            end = None if i == n - 1 and rng.random() < 0.7 else day(b if rng.random() < 0.8 else (a + b) // 2 + 1)
            versions.append((key, f"{key}-{i}", day(a), end))
    facts = [(i, rng.choice(["long", "long", *[f"k{i}" for i in range(14)], None]), rng.choice([None, *[day(rng.randrange(-50, 3100)) for _ in range(6)], rng.choice(versions)[2], rng.choice(versions)[3]])) for i in range(400)]
    facts = spark.createDataFrame([(i, k, a, None if a is None else a - dt.timedelta(hours=i % 40)) for i, k, a in facts], "n int, key string, at timestamp_ntz, before timestamp_ntz")
    return facts, spark.createDataFrame(versions, "id string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")


@pytest.mark.parametrize("seed", [1, 2])
def test_bucketed_and_merging_joins_equal_the_plain_one(spark, seed):
    facts, versions = histories(spark, seed)
    for how in ("left", "inner"):
        want = rows(t.asof_join(facts, versions, {"key": "id"}, facts["at"], ["name"], how))
        assert rows(asof.asof_join_bucketed(facts, versions, {"key": "id"}, facts["at"], ["name"], how, per_bucket=3)) == want
    for stretch in (asof.STRETCH, 7 * 3_600_000_000, 10**16):
        assert rows(asof.asof_merge(facts, versions, {"key": "id"}, facts["at"], ["name"], until=facts["at"], stretch=stretch)) == rows(t.asof_join(facts, versions, {"key": "id"}, facts["at"], ["name"]))
        merged = asof.asof_merge(facts, versions, {"key": "id"}, facts["at"], ["name"], until=facts["before"], inclusive=False, stretch=stretch)
        assert rows(merged) == rows(t.overlap_join(facts, versions, {"key": "id"}, facts["before"], facts["at"], ["name"], "n"))
        last = asof.asof_merge(facts, versions, {"key": "id"}, facts["at"], ["valid_from"], stretch=stretch).select("n", "valid_from")
        plain = facts.join(versions, (facts["key"] == versions["id"]) & (versions["valid_from"] <= facts["at"]), "left").groupBy("n").agg(F.max("valid_from").alias("valid_from"))
        assert rows(last) == rows(plain)
    nothing = asof.asof_merge(facts, versions.limit(0), {"key": "id"}, facts["at"], ["name"])
    assert nothing.count() == 400 and nothing.where("name IS NOT NULL").count() == 0
    assert asof.asof_join_bucketed(facts.limit(0), versions, {"key": "id"}, facts["at"], ["name"]).count() == 0


def test_a_key_with_100_000_versions(spark):
    """Version k of the one key lasts the k-th minute; facts lie all over it, so the plain join would compare 2 * 10^9 pairs."""
    n, start = 100_000, F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    versions = spark.range(n).select(F.lit("hot").alias("id"), F.col("id").alias("v"), F.timestamp_add("MINUTE", F.col("id").cast("int"), start).alias("valid_from"))
    versions = versions.withColumn("valid_to", F.when(F.col("v") < n - 1, F.timestamp_add("MINUTE", F.lit(1), F.col("valid_from"))))
    facts = spark.range(20_000).select(F.col("id").alias("n"), F.lit("hot").alias("key"), F.timestamp_add("SECOND", (F.col("id") * 311).cast("int"), start).alias("at"))
    begin = time.perf_counter()
    for out in (asof.asof_join_bucketed(facts, versions, {"key": "id"}, facts["at"], ["v"]), asof.asof_merge(facts, versions, {"key": "id"}, facts["at"], ["v"], until=facts["at"])):
        assert out.count() == 20_000 and out.where(F.col("v").isNull() | (F.col("v") != F.least(F.floor(F.col("n") * 311 / 60), F.lit(n - 1)))).count() == 0
    assert time.perf_counter() - begin < 60
    plan = asof.asof_join_bucketed(facts, versions, {"key": "id"}, facts["at"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[[^\]]*_at_bucket#", plan)
    merged = asof.asof_merge(facts, versions, {"key": "id"}, facts["at"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in merged


def test_points_in_time_of_several_types(spark):
    facts = spark.createDataFrame([(1, 20240105, dt.date(2024, 1, 5))], "n int, k int, d date")
    versions = spark.createDataFrame([(20240101, None, dt.date(2024, 1, 1), None, "a")], "a int, b int, c date, e date, name string").withColumn("one", F.lit(1))
    for at, start, end in (("k", "a", "b"), ("d", "c", "e")):
        assert asof.asof_join_bucketed(facts, versions, {"n": "one"}, facts[at], ["name"], "left", F.col(start), F.col(end)).first()["name"] == "a"
        assert asof.asof_merge(facts, versions, {"n": "one"}, facts[at], ["name"], F.col(start), F.col(end), facts[at], stretch=31).first()["name"] == "a"
    with pytest.raises(TypeError):
        asof.ticks(versions, F.col("name"))


# Keyed tables and their feeds

ROW = "k string, v string, n int"


def table_at(spark, path, **more):
    return KeyedTable(spark, str(path), ["k"], spark.createDataFrame([], ROW).schema, buckets=8, **more)


def files(path):
    return {f"{f.parent.name}/{f.name}": f.parent.name for f in Path(path, "rows").rglob("*.parquet")}


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = table_at(spark, tmp_path)
    assert table.read().count() == 0 and table.version() is None and table.changes().count() == 0
    make = lambda data: spark.createDataFrame(data, ROW)
    table.upsert(make([(f"k{i}", "a", i) for i in range(60)] + [(None, "a", 0)]))
    before = files(tmp_path)
    table.upsert(make([("k3", "b", 1)]))
    after = files(tmp_path)
    changed = {before[f] for f in before.keys() - after.keys()}
    assert len(changed) == 1 and {after[f] for f in after.keys() - before.keys()} == changed and len(set(before.values())) > 4
    assert table.upsert(make([("k3", "b", 1), (None, "a", 0)])) == 2 and files(tmp_path) == after  # no change, no file
    assert rows(table.changes(0)) == [("k3", "a", 3, "update_preimage", 1), ("k3", "b", 1, "update_postimage", 1)]
    table.upsert(make([(None, "z", 5), ("new", "y", 6)]))
    table.upsert(make([("k5", None, None), ("none", None, None)]), deleted=F.lit(True))
    table.upsert(make([("k5", "back", 1)]))
    want = {(f"k{i}", "a", i) for i in range(60)} - {("k3", "a", 3), ("k5", "a", 5)} | {("k3", "b", 1), (None, "z", 5), ("new", "y", 6), ("k5", "back", 1)}
    assert set(rows(table.read())) == want == set(rows(table.rebuilt()))
    assert rows(table.changes(3)) == [("k5", "a", 5, "delete", 4), ("k5", "back", 1, "insert", 5)]
    assert set(rows(table_at(spark, tmp_path).read())) == want  # another driver finds the same


def test_a_commit_that_was_cut_off_is_finished_by_running_it_again(spark, tmp_path, monkeypatch):
    make = lambda data: spark.createDataFrame(data, ROW)
    for stop in ("before the feed ends", "before the rows", "half of the rows"):
        at = tmp_path / stop.replace(" ", "-")
        table = table_at(spark, at)
        table.upsert(make([(f"k{i}", "a", i) for i in range(30)]))
        batch = make([(f"k{i}", "b", i) for i in range(0, 40, 2)])
        whole, apply = folders.is_whole, KeyedTable._apply

        def cut(self, changes, stop=stop, apply=apply):
            if stop == "half of the rows":
                apply(self, changes.where("_bucket < 4"))
            raise RuntimeError("lost")

        monkeypatch.setattr(KeyedTable, "_apply", cut)
        with pytest.raises(RuntimeError):
            table.upsert(batch, 1)
        monkeypatch.setattr(KeyedTable, "_apply", apply)
        if stop == "before the feed ends":
            (at / "changes" / "_commit_version=1" / "_SUCCESS").unlink()
            assert table.version() == 0 and table.changes(0).count() == 0 and whole(spark, f"{at}/changes/_commit_version=0")
        for _ in range(2):
            table.upsert(batch, 1)
            assert rows(table.read()) == sorted([(f"k{i}", "b" if i % 2 == 0 else "a", i) for i in range(30)] + [(f"k{i}", "b", i) for i in range(30, 40, 2)], key=str)
            assert table.changes(0).groupBy("_change_type").count().count() == 3 and table.changes(0).count() == 15 * 2 + 5


def test_late_rows_change_nothing_and_batches_are_made_unique(spark, tmp_path):
    make = lambda data: spark.createDataFrame(data, ROW)
    table = table_at(spark, tmp_path, order=["n"])
    table.upsert(newest(make([("a", "x", 5), ("a", "y", 7), ("a", "w", None), ("b", None, 1), ("b", "q", 1)]), ["k"], ["n"]))
    assert rows(table.read()) == [("a", "y", 7), ("b", "q", 1)]
    table.upsert(make([("a", "late", 6), ("b", "same", 1)]))
    assert rows(table.read()) == [("a", "y", 7), ("b", "q", 1)] and table.changes(0).count() == 0
    table.upsert(make([("a", "", 8)]), deleted=F.lit(True))
    table.upsert(make([("a", "late", 7)]))
    assert rows(table.read()) == [("b", "q", 1)]
    table.upsert(make([("a", "next", 9)]))
    assert rows(table.read()) == [("a", "next", 9), ("b", "q", 1)]


def test_consumers_keep_their_own_offsets_and_lose_nothing(spark, tmp_path):
    table, taken = table_at(spark, tmp_path), {"prompt": [], "lagging": []}

    def take(name):
        changes, until = table_at(spark, tmp_path).pending(name)  # a new object, as after a restart
        taken[name] += rows(changes.select("k", "_change_type", "_commit_version"))
        table.commit(name, until)

    take("lagging")
    for i in range(4):
        table.upsert(spark.createDataFrame([(f"k{i}", "a", i), ("k0", f"v{i}", i)][: 1 if i == 0 else 2], ROW))
        take("prompt")
    again, until = table.pending("lagging")
    assert again.count() == table.changes().count() and until == 3  # not committed yet, so it comes again
    take("lagging")
    assert sorted(taken["prompt"]) == sorted(taken["lagging"]) and len(taken["prompt"]) == 4 + 2 * 3
    table.commit("lagging", 1)
    assert table.offset("lagging") == table.offset("prompt") == 3 and table.pending("prompt")[0].count() == 0
    table.reset("lagging")
    assert table.offset("lagging") == -1 and table.offset("prompt") == 3
    plan = table.changes(1, 2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_commit_version#\d+L > 1", plan)


def test_a_stream_goes_on_in_its_table(spark, tmp_path):
    source, at = str(tmp_path / "in"), str(tmp_path / "at")
    write = lambda data: spark.createDataFrame(data, ROW).coalesce(1).write.mode("append").parquet(source)
    run = lambda: rows(st.upsert_into(spark.readStream.schema(ROW).parquet(source), table_at(spark, tmp_path / "t", order=["n"]), at))
    write([("a", "1", 1), ("b", "1", 5)])
    assert run() == [("a", "1", 1), ("b", "1", 5)]
    write([("a", "2", 3), ("b", "old", 2), ("c", "1", 2), ("c", "2", 3)])
    want = [("a", "2", 3), ("b", "1", 5), ("c", "2", 3)]
    assert run() == want == run() and table_at(spark, tmp_path / "t").version() == 1


# Keyed state


@pytest.mark.parametrize(("seed", "kept"), [(1, None), (2, dt.timedelta(days=5))])
def test_streamed_versions_equal_the_batch_operator(spark, tmp_path, seed, kept):
    """Any split into batches, changes in any order: the stream's versions, with too late changes merged, are those of all changes at once."""
    rng, schema = random.Random(seed), "k string, v string, change_time timestamp_ntz"
    changes = [(k, rng.choice(["x", "y", None]), D(2024, 1, 1) + dt.timedelta(days=d)) for k in ("a", "b", "c", None) for d in rng.sample(range(40), 12)]
    rng.shuffle(changes)
    for i in range(3):
        spark.createDataFrame(changes[i::3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    own = vs.session(spark)
    stream = vs.versions(own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log")), ["k"], kept=kept)
    table = KeyedTable(own, str(tmp_path / "t"), ["k", "valid_from"], T.StructType([f for f in stream.schema.fields if f.name != "too_late"]), buckets=4)
    late = vs.maintain(stream, table, str(tmp_path / "at"))
    order, history = ["k", "v", "valid_from", "valid_to", "is_current"], table.read().withColumn("is_current", F.col("valid_to").isNull())
    assert (late.count() > 0) == (kept is not None) and table.version() == 2
    known = late.where("k IS NOT NULL").withColumnRenamed("valid_from", "change_time")
    merged = t.merge_increment(history, known, ["k"]).where("k IS NOT NULL")
    assert rows(merged.select(order)) == rows(t.intervalize(spark.createDataFrame(changes, schema).where("k IS NOT NULL"), ["k"]).select(order))
    state = own.read.format("statestore").option("stateVarName", "changes").load(str(tmp_path / "at" / "state"))
    # Changes of the last five days and the one before them, of each of four keys.
    assert state.count() == len(changes) if kept is None else state.count() <= 4 * (5 + 1)


def test_a_late_price_finds_its_usage_and_state_is_given_back(spark, tmp_path):
    day = lambda n: D(2024, 1, 1) + dt.timedelta(days=n)
    usage, price = "id int, sku_name string, usage_unit string, usage_start_time timestamp", "sku_name string, usage_unit string, price_start_time timestamp, price_end_time timestamp, price int"
    put = lambda name, data, schema: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    put("u", [(1, "s", "O", day(3)), (2, "s", "O", day(12)), (3, "none", "O", day(3)), (4, None, "O", day(3))], usage)
    put("p", [("s", "O", day(10), day(20), 7)], price)

    def run():
        read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
        out = st.priced_by_stream(read("u", usage), read("p", price), lateness="20 days", longest="30 days")
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("id", "price")), query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    assert run()[0] == [(2, 7)]
    put("p", [("s", "O", day(0), day(10), 5)], price)  # starts long before, comes a run later
    found, held = run()
    assert found == [(1, 5), (2, 7)] and held > 0
    put("u", [(9, "s", "O", day(400))], usage)
    put("p", [("s", "O", day(400), day(420), 9)], price)
    run()
    put("u", [(10, "t", "O", day(401))], usage)
    found, held = run()
    assert found == [(1, 5), (2, 7), (9, 9)] and held <= 3  # all but the newest rows have left


# Sketches


def test_sketches_keep_their_error_when_merged(spark):
    df = spark.range(300_000).select((F.col("id") % 30).alias("day"), (F.xxhash64("id") % 1_000_003).alias("v"))
    days = sketches.sketched(df, ["day"], "v")
    month = sketches.quantiles(sketches.merged(days.withColumn("month", F.lit(1)), ["month"]), p1=0.01, p50=0.5, p99=0.99).first()
    assert month["n"] == 300_000
    for name, q in (("p1", 0.01), ("p50", 0.5), ("p99", 0.99)):
        assert abs(df.where(F.col("v") <= month[name]).count() / 300_000 - q) < sketches.RANK_ERROR
    # What a sketch holds does not grow with what it has seen.
    size = lambda d: d.agg(F.max(F.length("sketch"))).first()[0]
    assert size(sketches.merged(days.withColumn("month", F.lit(1)), ["month"])) < 3 * size(sketches.sketched(df.limit(3_000), [], "v"))


def test_sketches_of_few_values_are_exact_and_nulls_are_not_counted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", None), ("b", None)], "g string, v bigint")
    out = sketches.quantiles(sketches.sketched(df, ["g"], "v"), low=0.0, p50=0.5, high=1.0)
    assert rows(out) == [("a", 3, 1, 2, 3), ("b", 0, None, None, None)]


# Declared pipelines


def test_declared_graphs_run_apart_and_report_failures(spark, tmp_path):
    from pyspark import pipelines as dp

    def declare(graph, n):
        @dp.materialized_view(name="numbers", comment="declared by a decorator", partition_cols=["part"])
        def numbers():
            return spark.range(n).withColumn("part", F.col("id") % 2)

        # Declared before what it reads: the engine finds the order.
        graph.register_sql("CREATE MATERIALIZED VIEW total AS SELECT sum(id) AS s FROM odd; CREATE TEMPORARY VIEW odd AS SELECT * FROM numbers WHERE part = 1;", Path("x.sql"))

    graphs = [declared.run(spark, str(tmp_path / str(n)), lambda g, n=n: declare(g, n)) for n in (10, 100)]
    assert [g.table("total").first()[0] for g in graphs] == [25, 2500]
    assert spark.sql(f"SHOW TABLES IN {graphs[0].database}").where("NOT isTemporary").count() == 2  # the view stays inside
    assert spark.catalog.tableExists(f"{graphs[0].database}.numbers") and "part" in str(spark.sql(f"SHOW PARTITIONS {graphs[0].database}.numbers").collect())
    with pytest.raises(Exception, match="missing|UNRESOLVED|TABLE_OR_VIEW_NOT_FOUND|analyze"):
        declared.run(spark, str(tmp_path / "bad"), lambda g: g.register_sql("CREATE MATERIALIZED VIEW bad AS SELECT * FROM missing;", Path("x.sql")))


# Files of differing schemas


def test_parts_of_differing_schemas_are_read_as_one(spark, tmp_path):
    def part(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    parts = [
        part("1", [(1, 2.5, [1], dt.date(2024, 1, 1), (1, (2,)))], "a int, f float, l array<int>, d date, s struct<x int, t struct<u int>>"),
        part("2", [(1 << 40, 2.25, [1 << 40], D(2024, 1, 2, 3), (1 << 40, (3, "w")), "new")], "a bigint, f double, l array<bigint>, d timestamp_ntz, s struct<x bigint, t struct<u int, w string>>, e string"),
        part("3", [("7", "only"), ("no", None), (None, None)], "a string, z string"),
    ]
    df, drift = sch.read_evolving(spark, parts)
    assert df.schema.simpleString() == "struct<a:bigint,f:double,l:array<bigint>,d:timestamp_ntz,s:struct<x:bigint,t:struct<u:int,w:string>>,e:string,z:string>"
    got = {r["a"]: r for r in df.collect()}
    assert got[1]["f"] == 2.5 and got[1]["l"] == [1] and got[1]["d"] == D(2024, 1, 1) and got[1]["s"]["x"] == 1 and got[1]["s"]["t"]["w"] is None and got[1]["e"] is None
    assert got[1 << 40]["l"] == [1 << 40] and got[1 << 40]["s"]["t"]["w"] == "w" and got[1 << 40]["e"] == "new"
    assert got[7]["z"] == "only" and df.count() == 5 and df.where("a IS NULL").count() == 2
    assert rows(drift.drop("part")) == [("a", "type_changed", "string", "bigint", 1)]
    alone, none = sch.read_evolving(spark, parts[:1])
    assert alone.count() == 1 and none.count() == 0


@pytest.mark.parametrize(("a", "b", "want"), [("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "double", "double"), ("bigint", "double", None), ("int", "string", None), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", None), ("date", "timestamp_ntz", "timestamp_ntz"), ("array<int>", "array<string>", None), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("struct<a:int>", "struct<a:string>", None), ("void", "int", "int")])
def test_types_widen_without_loss_or_conflict(a, b, want):
    types = [T._parse_datatype_string(x) if not x.startswith("void") else T.NullType() for x in (a, b)]
    for x, y in (types, types[::-1]):
        got = sch.widened(x, y)
        assert (got and got.simpleString()) == want


# Pruning and observed checks


def files_read(spark):
    """The numbers of files that the scans of the last query have read."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    last = runs.apply(runs.size() - 1).executionId()
    values, nodes = store.executionMetrics(last), store.planGraph(last).allNodes()
    metrics = [nodes.apply(i).metrics() for i in range(nodes.size())]
    found = [m.apply(k) for m in metrics for k in range(m.size()) if m.apply(k).name() == "number of files read"]
    return sorted(int(values.apply(m.accumulatorId())) for m in found if values.contains(m.accumulatorId()))


def test_a_filter_on_the_date_dimension_prunes_the_fact_at_run_time(spark, tmp_path):
    fact = spark.range(4_000).select(F.col("id"), (F.lit(20240101) + F.col("id") % 28).cast("int").alias("date_key"))
    from meterlake.operators import merge as up

    up.write_partitions(fact, str(tmp_path / "fact"), "date_key", tasks=4)
    spark.range(28).select((F.lit(20240101) + F.col("id")).cast("int").alias("date_key"), (F.col("id") % 7).alias("weekday")).coalesce(1).write.parquet(str(tmp_path / "dates"))
    out = spark.read.parquet(str(tmp_path / "fact")).join(spark.read.parquet(str(tmp_path / "dates")).where("weekday = 0").select("date_key"), "date_key")
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert len(out.collect()) == 572
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert files_read(spark) == [1, 4]  # the dimension, and 4 of the fact's 28 folders


def test_checks_are_observed_in_the_job_that_writes(spark, tmp_path):
    df = spark.range(1_000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") - 5).alias("x"))
    rules = [dq.Rule("sign", "ERROR", dq.non_negative("x")), dq.Rule("required", "CRITICAL", dq.required(df, "x"))]
    context = spark.sparkContext
    context.setJobGroup("observed", "observed")
    try:
        out = dq.checked_write(df, rules, str(tmp_path / "out"))
        assert len(context.statusTracker().getJobIdsForGroup("observed")) == 1
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert rows(out) == rows(dq.results(df, rules))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 1_000 and written.where("NOT is_good").count() == df.where("x IS NULL OR x < 0").count()
    assert rows(written.where("size(reasons) > 0").select("is_good").distinct()) == [("false",)]
    assert rows(dq.checked_write(df.limit(0), rules, str(tmp_path / "none"))) == rows(dq.results(df.limit(0), rules))
