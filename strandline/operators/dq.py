"""Data quality of parsed statements: columns without a source, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_NOTE = "Source column(s) could not be resolved to a known table"
#: Reasons by the words of a note that tell them, and what is said of each.
REASONS = {
    "not found in external dictionary": "column(s) not found in external dictionary lookup — add them to the CSV to enable lineage resolution.",
    "ambiguous": "column(s) are ambiguous across multiple source tables — qualify them in SQL or refine the dictionary.",
    "no external dictionary": "column(s) are unqualified and no external dictionary was provided.",
}
OTHER = "column(s) could not be resolved — see resolution_note for details."


def missing(semantics: DataFrame) -> DataFrame:
    """Rows of column semantics that aren't constants and have no source, with a note."""
    empty = (F.size("base_sources") <= 0) | F.col("base_sources").isNull()
    return semantics.filter(empty & ~F.col("classification").eqNullSafe("Constant")).withColumn("resolution_note", F.coalesce("resolution_note", F.lit(DEFAULT_NOTE)))


def semantics(parsed: DataFrame) -> DataFrame:
    """One row for each column semantic of fully parsed statements; fallbacks have no data-quality record."""
    full = parsed.filter("semantic is not null and semantic.parse_mode = 'full'")
    return full.select("script_name", "order", F.explode("semantic.column_semantics").alias("s")).select("script_name", "order", "s.*")


def buckets(rows: DataFrame, *by: str) -> DataFrame:
    """Missing columns counted by reason; a note may count for several, ``other`` is none of them."""
    note = F.col("resolution_note")
    hit = {k: note.contains(k) for k in REASONS}
    none: Column = ~(hit["not found in external dictionary"] | hit["ambiguous"] | hit["no external dictionary"])
    named = dict(zip(("dictionary_miss", "ambiguous", "no_dictionary"), hit.values(), strict=True)) | {"other": none}
    return missing(rows).groupBy(*by).agg(F.count("*").alias("missing"), *(F.count_if(c).alias(k) for k, c in named.items()))


def notes(counted: DataFrame) -> DataFrame:
    """With ``notes``: a sentence for each reason that occurs."""
    said = dict(zip(("dictionary_miss", "ambiguous", "no_dictionary", "other"), [*REASONS.values(), OTHER], strict=True))
    each = [F.when(F.col(k) > 0, F.concat(F.col(k).cast("string"), F.lit(f" {v}"))) for k, v in said.items()]
    return counted.withColumn("notes", F.filter(F.array(*each), lambda x: x.isNotNull()))


def evaluate(parsed: DataFrame) -> DataFrame:
    """One record for each fully parsed statement: missing_base_sources, unresolved_derived_alias_refs (always empty), notes."""
    rows = missing(semantics(parsed))
    held = rows.groupBy("script_name", "order").agg(F.collect_list(F.struct("target_column", "classification", "resolved_expression", "resolution_note")).alias("missing_base_sources"))
    said = notes(buckets(semantics(parsed), "script_name", "order")).select("script_name", "order", "notes")
    full = parsed.filter("semantic is not null and semantic.parse_mode = 'full'").select("script_name", "order")
    empty = F.array().cast("array<string>")
    return (
        full.join(held, ["script_name", "order"], "left")
        .join(said, ["script_name", "order"], "left")
        .select("script_name", "order", F.coalesce("missing_base_sources", F.array().cast(held.schema["missing_base_sources"].dataType)).alias("missing_base_sources"), empty.alias("unresolved_derived_alias_refs"), F.coalesce("notes", empty).alias("notes"))
    )


def rollup(results: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row over all scripts."""
    kinds = ("insert", "create", "update", "merge")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = [total(f"{k}_{c}").alias(f"{k}_{n}") for k in kinds for c, n in (("statement_count", "statements_emitted"), ("parsed_ok", "parsed_ok"), ("parse_failures", "parse_failures"))]
    counted = results.agg(F.count_if(~F.col("_skipped")).alias("scripts_emitted"), F.count_if(F.col("_skipped")).alias("scripts_skipped_no_sql"), total("sql_statement_count").alias("sql_statements_emitted"), *sums)
    return counted.crossJoin(missing(semantics(parsed)).agg(F.count("*").alias("dq_missing_base_sources_total")))  # one row each
