"""The model's tables, mapped from the star-schema test tables by declarative projections and equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from meterlake.functions.columns import MONEY, first_of, node_family, runtime

#: Years of the price list; usage after them has no price.
PRICE_YEARS = range(1995, 2001)


class Model:
    """Lazy model tables over one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        #: The price list once it is known whether it can be broadcast.
        self.price_list: DataFrame | None = None

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def usage(self) -> DataFrame:
        """One metered record: who used how much of which SKU when, with its tag map."""
        line, order, part = self.raw("lineitem"), self.raw("orders").select("o_orderkey", "o_custkey"), self.raw("part").select("p_partkey", "p_brand", "p_type")
        x = line.join(order, line["l_orderkey"] == order["o_orderkey"]).join(part, line["l_partkey"] == part["p_partkey"])
        x = x.withColumn("m", (F.col("l_orderkey") + F.col("l_linenumber")) % 7)
        text = lambda c: F.col(c).cast("string")
        numbered = lambda prefix, c, n: F.concat(F.lit(prefix), (F.col(c) % n).cast("string"))
        tags = F.create_map(
            F.lit("cost_center"), first_of([(F.col("m") == 0, F.lit(None)), (F.col("m") == 1, F.lit(" ")), (F.col("m") == 2, F.lit("unallocated"))], numbered("cc_", "l_partkey", 10)),
            F.lit("line_of_business"), F.col("p_type"),
            F.lit("department"), F.when(F.col("m") == 3, "general").otherwise(numbered("dept_", "l_suppkey", 4)),
            F.lit("environment"), first_of([(F.col("l_partkey") % 6 == k, F.lit(v)) for k, v in enumerate(("PRODUCTION", "prod", "Development", "stage", "QA"))], F.lit(None)),
            F.lit("use_case"), F.when(F.col("l_partkey") % 5 == 0, "").otherwise(numbered("uc_", "l_partkey", 5)),
            F.lit("pipeline_name"), F.when(F.col("l_linenumber") % 2 == 0, numbered("pipe_", "o_custkey", 20)),
            F.lit("workflow_level"), first_of([(F.col("o_custkey") % 3 == 0, F.lit("PARENT")), (F.col("o_custkey") % 3 == 1, F.lit("SUB_WORKFLOW"))], F.lit(None)),
            F.lit("parent_workflow_name"), F.when(F.col("o_custkey") % 3 == 1, numbered("WF_", "o_custkey", 10)),
        )
        product = first_of([(F.col("l_returnflag") == "N", F.lit("SQL")), (F.col("o_custkey") % 2 == 0, F.lit("JOBS"))], F.lit("DLT"))
        start = F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate"))
        x = x.withColumns({"product": product, "usage_start_time": start})
        is_job = F.col("product") == "JOBS"
        return x.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_id"),
            text("l_suppkey").alias("workspace_id"),
            first_of([(F.col("l_suppkey") % 3 == 0, F.lit("AWS")), (F.col("l_suppkey") % 3 == 1, F.lit("AZURE"))], F.lit("GCP")).alias("cloud"),
            F.col("p_brand").alias("sku_name"),
            F.col("l_linestatus").alias("usage_unit"),
            "product",
            F.struct(
                F.when(is_job, text("o_custkey")).alias("job_id"),
                F.when(F.col("product") == "DLT", text("o_custkey")).alias("pipeline_id"),
                F.when(is_job, text("l_orderkey")).alias("job_run_id"),
                text("o_custkey").alias("cluster_id"),
            ).alias("usage_metadata"),
            F.struct((F.col("l_partkey") % 2 == 0).alias("is_serverless"), (F.col("l_partkey") % 3 == 0).alias("is_photon")).alias("product_features"),
            "usage_start_time",
            F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("usage_start_time")).alias("usage_end_time"),
            F.col("l_shipdate").cast("date").alias("usage_date"),
            F.col("l_quantity").cast(MONEY).alias("usage_quantity"),
            F.when(F.col("m") != 5, tags).alias("custom_tags"),
        )

    def prices(self) -> DataFrame:
        """List prices by SKU, unit and half-open yearly interval."""
        base = self.raw("part").groupBy("p_brand").agg(F.max("p_retailprice").cast(MONEY).alias("base"))
        years = F.explode(F.array(*map(F.lit, PRICE_YEARS)))
        rows = base.select("p_brand", "base", years.alias("y")).select("*", F.explode(F.array(F.lit("O"), F.lit("F"))).alias("usage_unit"))
        at = lambda y: F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp_ntz")
        price = (F.col("base") * (100 + 5 * (F.col("y") - PRICE_YEARS[0])).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
        return rows.select(F.col("p_brand").alias("sku_name"), "usage_unit", at(F.col("y")).alias("price_start_time"), at(F.col("y") + 1).alias("price_end_time"), price.alias("price"))

    def entity_log(self) -> DataFrame:
        """Definition changes of jobs and pipelines: the last of each day."""
        last = Window.partitionBy("o_custkey", "o_orderdate").orderBy(F.desc("o_orderkey"))
        rows = self.raw("orders").withColumn("rn", F.row_number().over(last)).where("rn = 1")
        return rows.select(
            F.col("o_custkey").cast("string").alias("entity_id"), F.when(F.col("o_custkey") % 2 == 0, "JOB").otherwise("PIPELINE").alias("entity_type"),
            F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("run_as"), F.col("o_orderdate").alias("change_time"),
        )

    def compute_log(self) -> DataFrame:
        """Configuration changes of clusters and warehouses, by the minute."""
        k = F.col("o_orderkey")
        rows = self.raw("orders").withColumn("change_time", F.timestamp_add("MINUTE", (k % 1440).cast("int"), F.col("o_orderdate")))
        last = Window.partitionBy("o_custkey", "change_time").orderBy(F.desc("o_orderkey"))
        rows = rows.withColumn("rn", F.row_number().over(last)).where("rn = 1")
        variant = first_of([(k % 3 == 0, F.lit(".x-photon-scala2.12")), (k % 3 == 1, F.lit(".x-cpu-ml"))], F.lit(".x"))
        version = first_of([(k % 13 == 0, F.lit(None)), (k % 11 == 0, F.lit("custom:abc"))], F.concat((k % 8 + 10).cast("string"), F.lit("."), (k % 4).cast("string"), variant))
        nodes = ("Standard_DS3_v2", "Standard_E4s_v3", "m5.large", "c5.xlarge", "g4dn.xlarge")
        node = lambda by: first_of([(by % 6 == i, F.lit(v)) for i, v in enumerate(nodes)], F.lit("unknown"))
        return rows.select(
            F.col("o_custkey").cast("string").alias("cluster_id"), F.concat(F.lit("cluster_"), F.col("o_custkey").cast("string")).alias("cluster_name"),
            F.when(F.col("o_orderstatus") == "P", "WAREHOUSE").otherwise("CLUSTER").alias("kind"), version.alias("runtime_version"), node(k).alias("worker_node_type"), node(F.expr("o_orderkey div 6")).alias("driver_node_type"),
            (k % 4).cast("int").alias("min_workers"), (k % 4 + k % 9).cast("int").alias("max_workers"), "change_time",
        )

    def runs(self) -> DataFrame:
        k = F.col("o_orderkey")
        start = F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate"))
        state = first_of([(F.col("o_orderstatus") == "F", F.lit("SUCCESS")), (F.col("o_orderstatus") == "O", F.lit("FAILED"))], F.lit("CANCELLED"))
        return self.raw("orders").select(
            F.col("o_custkey").cast("string").alias("job_id"), k.cast("string").alias("run_id"), (F.col("o_custkey") % 10).cast("string").alias("workspace_id"), start.alias("start_time"),
            F.timestamp_add("HOUR", (k % 30).cast("int"), start).alias("end_time"), state.alias("result_state"), F.when(k % 5 == 0, "USER").otherwise("NONE").alias("termination_code"), F.col("o_orderpriority").alias("trigger_type"),
        )

    def tasks(self) -> DataFrame:
        start = F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").cast("string").alias("run_id"), F.col("l_linenumber").cast("string").alias("task_key"), start.alias("start_time"),
            F.timestamp_add("MINUTE", (F.col("l_linenumber") * 60 + F.col("l_partkey") % 60).cast("int"), start).alias("end_time"), F.col("l_returnflag").alias("result_state"),
        )

    def workspaces(self) -> DataFrame:
        s, n = self.raw("supplier"), self.raw("nation")
        return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").cast("string").alias("workspace_id"), F.col("s_name").alias("workspace_name"), F.col("n_name").alias("region"), F.when(F.col("s_acctbal") < 0, "CANCELLED").otherwise("RUNNING").alias("status"))

    def node_types(self) -> DataFrame:
        return self.raw("part").select(F.concat(F.lower("p_type"), F.lit("."), F.col("p_partkey").cast("string")).alias("node_type"), F.col("p_size").alias("core_count"), (F.col("p_size") * 4096).cast("bigint").alias("memory_mb"), F.when(F.col("p_size") % 3 == 0, 1).otherwise(0).alias("gpu_count"))

    def feed(self) -> DataFrame:
        """A change feed: rows with their change type, commit version and commit time."""
        kind = first_of([(F.col("event_type") == "signup", F.lit("insert")), (F.col("event_type") == "error", F.lit("delete")), (F.col("event_type") == "view", F.lit("update_preimage"))], F.lit("update_postimage"))
        return self.raw("events").select(F.col("user_id").alias("key"), "event_id", F.col("value").cast(MONEY).alias("value"), kind.alias("_change_type"), F.expr("event_id div 1000").alias("_commit_version"), F.col("ts").alias("_commit_timestamp"))


def with_runtime(df: DataFrame) -> DataFrame:
    return df.withColumns(runtime(df["runtime_version"]) | {"node_family": node_family(df["worker_node_type"])})


def metadata(name: str) -> Column:
    return F.col(f"usage_metadata.{name}")
