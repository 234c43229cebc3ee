"""Declared pipelines: datasets by ``pyspark.pipelines`` decorators and by SQL, run as one dataflow graph by Spark's own pipeline engine.

The command-line runner of declarative pipelines talks to a Spark Connect server. A classic session has the same engine in its JVM, so the
declarations are registered there: the engine resolves the graph, orders its flows, refreshes the materialised views as tables and keeps
temporary views inside the graph.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.java_gateway import ensure_callback_server_started
from pyspark.pipelines.flow import Flow
from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context
from pyspark.pipelines.output import MaterializedView, Output, TemporaryView
from pyspark.sql import DataFrame, SparkSession


class Events:
    """What the engine reports, as text; it calls from its own threads."""

    class Java:
        implements = ["scala.Function1"]

    def __init__(self) -> None:
        self.seen: list[str] = []

    def apply(self, event) -> None:
        self.seen.append(event.toString())


class Graph(GraphElementRegistry):
    """Collects declarations for one run into a database of its own, so that two runs never write the same tables."""

    def __init__(self, spark: SparkSession, storage: str) -> None:
        self.spark, self.database, self.events = spark, f"declared_{uuid.uuid4().hex}", Events()
        self.storage = storage if "://" in storage else f"file://{storage}"
        self.jvm, self.views = spark._jvm, set()
        self.engine = self.jvm.org.apache.spark.sql.pipelines.graph
        self.none, self.some, self.empty = self.jvm.scala.Option.empty(), self.jvm.scala.Option.apply, self.jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({})
        spark.sql(f"CREATE DATABASE {self.database}")
        self.context = self.engine.GraphRegistrationContext("spark_catalog", self.database, self.empty)

    def _name(self, name: str):
        """A table's name in the run's database; views have none."""
        place = (self.none, self.none) if name in self.views else (self.some(self.database), self.some("spark_catalog"))
        return self.jvm.org.apache.spark.sql.catalyst.TableIdentifier(name, *place)

    def register_output(self, output: Output) -> None:
        origin, comment = self.engine.QueryOrigin.empty(), self.some(output.comment)
        if isinstance(output, TemporaryView):
            self.views.add(output.name)
            self.context.registerView(self.engine.TemporaryView(self._name(output.name), self.empty, self.none, comment, origin))
        elif isinstance(output, MaterializedView):
            properties = self.jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(dict(output.table_properties))
            parts = self.some(self.jvm.org.apache.spark.api.python.PythonUtils.toSeq(list(output.partition_cols))) if output.partition_cols else self.none
            self.context.registerTable(self.engine.Table(self._name(output.name), self.none, parts, self.none, self.none, properties, comment, origin, False, self.some(output.format)))
        else:
            raise TypeError(f"{output.name}: only materialised and temporary views are declared here")

    def register_flow(self, flow: Flow) -> None:
        plan = flow.func()._jdf.queryExecution().logical()
        here = self.engine.QueryContext(self.some("spark_catalog"), self.some(self.database))
        of = self.engine.FlowAnalysis.createFlowFunctionFromLogicalPlan(plan)
        self.context.registerFlow(self.engine.UnresolvedFlow(self._name(flow.name), self._name(flow.target), of, here, self.empty, False, self.engine.QueryOrigin.empty()))

    def register_sql(self, sql_text: str, file_path: Path) -> None:
        self.engine.SqlGraphRegistrationContext(self.context).processSqlFile(sql_text, str(file_path), self.spark._jsparkSession)

    def run(self) -> None:
        """Refreshes every table of the graph; raises where a flow fails or the graph does not resolve."""
        ensure_callback_server_started(self.spark.sparkContext._gateway)
        every = lambda name: getattr(getattr(self.engine, f"{name}$"), "MODULE$")
        self.jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(self.spark._jsparkSession)
        update = self.engine.PipelineUpdateContextImpl(self.context.toDataflowGraph(), self.events, every("AllTables"), every("NoTables"), self.storage)
        update.pipelineExecution().runPipeline()
        update.pipelineExecution().awaitCompletion()
        if not any("Run is COMPLETED" in e for e in self.events.seen):
            raise RuntimeError("\n".join(self.events.seen[-3:]))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


def run(spark: SparkSession, storage: str, declare: Callable[[Graph], None]) -> Graph:
    """Runs what declare() declares, by the decorators of ``pyspark.pipelines`` or by ``graph.register_sql``.

    Functions under the decorators read what lies outside the graph; datasets of the graph are read by SQL, which is resolved by the engine.
    """
    graph = Graph(spark, storage)
    with graph_element_registration_context(graph):
        declare(graph)
    graph.run()
    return graph
