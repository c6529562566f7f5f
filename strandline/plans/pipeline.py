"""From scripts to parsed statements, on executors."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import text
from strandline.plans.grammar import scan
from strandline.plans.lineage import normal, route
from strandline.schemas import RECORD

#: Dictionary entries that travel with the parser as they are; of a larger one, only columns that the scripts name.
DICTIONARY_ROWS = 500_000


def dictionary_map(entries: DataFrame | None, stmts: DataFrame) -> dict[str, list[str]]:
    """Beyond DICTIONARY_ROWS, the entries of columns that are a token of some statement; the parser can ask for no others."""
    if entries is None:
        return {}
    if entries.count() > DICTIONARY_ROWS:
        words = references(stmts.select("clean"), "clean", lambda sql: list({normal(t.text) for t in scan(sql) if t.kind in ("name", "text")}))
        entries = entries.join(words.select(F.explode("found").alias("column")).distinct(), "column", "left_semi")
    return {r["column"]: list(r["tables"]) for r in entries.collect()}


def routed(stmts: DataFrame, known: dict[str, list[str]] | None = None, robust: bool = False, limit: int = 10_000, seconds: float = 10.0) -> DataFrame:
    """The columns of ``stmts`` but ``clean``, and ``record`` (JSON or null), ``parse_note`` and ``parse_error`` of each statement."""
    kept = [c for c in stmts.columns if c != "clean"]

    def run(batches):
        for b in batches:
            kind, clean = b.column("statement_type").to_pylist(), b.column("clean").to_pylist()
            found = [route(k, c, known, robust, limit, seconds) for k, c in zip(kind, clean, strict=True)]
            cols = [pa.array([json.dumps(f[0]) if f[0] else None for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *cols], [*kept, "record", "parse_note", "parse_error"])

    schema = stmts.select(*kept, F.lit("").alias("record"), F.lit("").alias("parse_note"), F.lit("").alias("parse_error")).schema
    for f in schema.fields:
        f.nullable = True
    return stmts.mapInArrow(run, schema)


def parse(scripts: DataFrame, entries: DataFrame | None = None, robust: bool = False, limit: int = 10_000, seconds: float = 10.0) -> DataFrame:
    """One row for each statement: name, order, block, type, text, ``semantic`` (or null), ``parse_note``, ``parse_error`` and ``notes``.

    Statements, not scripts, are dealt to tasks, so that one long script doesn't hold up the rest. A statement that can't be
    parsed in ``seconds`` goes to the text fallbacks; none fails a task.
    """
    stmts = text.statements(scripts, robust)
    known = dictionary_map(entries, stmts)
    parsed = routed(stmts.repartition(F.xxhash64("script_name", "order")), known, robust, limit, seconds)
    plain = F.concat(F.lit("Not parsed: statement type '"), F.col("statement_type"), F.lit("' is not currently supported."))
    return parsed.select(
        "script_name", "order", "block", "statement_type", "statement_text", F.from_json("record", RECORD).alias("semantic"), "parse_note", "parse_error",
        F.when(~F.col("statement_type").isin("INSERT", "CREATE", "UPDATE", "MERGE"), F.array(plain)).alias("notes"),
    )


def references(rows: DataFrame, text_col: str, find: Callable[[str], list[str]]) -> DataFrame:
    """``rows`` with ``found``: what one of the text methods (column_refs, tables_read) finds in a column; null has nothing."""
    at = rows.columns.index(text_col)

    def run(batches):
        for b in batches:
            found = [find(x or "") for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.string()))], [*b.schema.names, "found"])

    return rows.mapInArrow(run, rows.withColumn("found", F.lit(None).cast("array<string>")).schema)


def script_results(scripts: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row for each script: its counters, or ``_skipped`` where it has no statement."""
    s = F.col("statement_type")
    counters = []
    for kind in ("INSERT", "CREATE", "UPDATE", "MERGE"):
        low = kind.lower()
        counters += [
            F.count_if(s == kind).alias(f"{low}_statement_count"),
            F.count_if((s == kind) & F.col("semantic").isNotNull()).alias(f"{low}_parsed_ok"),
            F.count_if((s == kind) & F.col("semantic").isNull()).alias(f"{low}_parse_failures"),
        ]
    by_script = parsed.groupBy("script_name").agg(F.count("*").alias("sql_statement_count"), *counters)
    joined = scripts.select("script_name").join(by_script, "script_name", "left")
    return joined.withColumn("_skipped", F.col("sql_statement_count").isNull())
