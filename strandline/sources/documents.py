"""Parsed statements and graphs as JSON, to hand to other tools and to read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import graph
from strandline.schemas import RECORD


def statement_schema(spark: SparkSession):
    """Of parsed statements, as :func:`strandline.plans.pipeline.parse` gives them."""
    row = spark.range(0).select(F.from_json(F.lit(None).cast("string"), RECORD).alias("semantic"))
    text = F.lit(None).cast("string")
    return row.select(
        text.alias("script_name"), F.lit(None).cast("int").alias("order"), F.lit(None).cast("int").alias("block"), text.alias("statement_type"), text.alias("statement_text"), "semantic",
        text.alias("parse_note"), text.alias("parse_error"), F.lit(None).cast("array<string>").alias("notes"),
    ).schema


def write_parsed(parsed: DataFrame, path: str) -> None:
    """JSON lines, a statement each, in order within each script."""
    parsed.repartition("script_name").sortWithinPartitions("script_name", "order").write.mode("overwrite").json(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(statement_schema(spark)).json(path)


def write_graph(edges: DataFrame, chains: DataFrame, path: str) -> None:
    """Summary, edges, chains and column lineage, a folder of JSON lines each."""
    for name, df in {"summary": graph.summary(edges, chains), "edges": edges, "chains": chains, "column_lineage": graph.column_lineage(edges, chains)}.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
