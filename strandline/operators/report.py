"""The report on final columns: its tables as DataFrames, and one self-contained HTML page."""

from __future__ import annotations

import html
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import split_column

#: Colours by classification.
COLOURS = {"Direct assignment": "#2196F3", "Derived (function)": "#9C27B0", "Derived (expression)": "#FF9800", "Constant": "#607D8B", "Conditional": "#E91E63"}
OTHER_COLOUR = "#78909C"


def final_targets(e: DataFrame) -> DataFrame:
    """Targets that are no source."""
    return e.select("target_column").join(e.select(F.col("source_column").alias("target_column")), "target_column", "left_anti").distinct()


def constant_only(e: DataFrame) -> DataFrame:
    """Targets all of whose edges are constants without a source."""
    constant = F.col("source_column").isNull() & (F.col("classification") == "Constant")
    return e.groupBy("target_column").agg(F.bool_and(F.coalesce(constant, F.lit(False))).alias("only")).filter("only").select("target_column")


def reported(e: DataFrame) -> DataFrame:
    """Final targets less those that only constants feed."""
    return final_targets(e).join(constant_only(e), "target_column", "left_anti")


def unresolved(e: DataFrame) -> DataFrame:
    """Edges without a source, of reported targets."""
    return e.filter("source_column is null").join(reported(e), "target_column", "left_semi")


def columns(e: DataFrame, lineage: DataFrame) -> DataFrame:
    """One row for each reported target: table, name, state, its chains (each shown once) and what is known of unresolved edges."""
    held = unresolved(e).groupBy("target_column").agg(
        F.array_sort(F.collect_set(F.coalesce("resolution_note", F.lit("source could not be resolved")))).alias("reasons"),
        F.array_sort(F.collect_set(F.when(F.col("resolved_expression") != "", F.col("resolved_expression")))).alias("expressions"),
        F.array_sort(F.collect_set("statement_type")).alias("statement_types"),
    )
    table, name = split_column(F.col("target_column"), bare_is_table=False)
    shown = lineage.join(reported(e), "target_column", "left_semi").join(held, "target_column", "left")
    state = F.when(F.size("transformation_chains") > 0, "resolved").when(F.col("reasons").isNotNull(), "unresolved").otherwise("no-info")
    return shown.select("target_column", table.alias("table"), name.alias("column"), state.alias("state"), F.array_distinct("transformation_chains").alias("chains"), "reasons", "expressions", "statement_types")


def states(e: DataFrame, pairs: DataFrame) -> DataFrame:
    """target_column, table, column and state of each reported target, without its chains: what the rollup needs."""
    traced = pairs.select(F.col("ultimate_target").alias("target_column"), F.lit(True).alias("traced")).distinct()
    open_ends = e.filter("source_column is null").select("target_column", F.lit(True).alias("open end")).distinct()
    table, name = split_column(F.col("target_column"), bare_is_table=False)
    state = F.when(F.col("traced"), "resolved").when(F.col("open end"), "unresolved").otherwise("no-info")
    return reported(e).join(traced, "target_column", "left").join(open_ends, "target_column", "left").select("target_column", table.alias("table"), name.alias("column"), state.alias("state"))


def by_table(cols: DataFrame) -> DataFrame:
    return cols.groupBy("table").agg(F.count("*").alias("columns"), F.count_if(F.col("state") == "resolved").alias("resolved"), F.count_if(F.col("state") != "resolved").alias("unresolved"))


def badge(kind: str) -> str:
    return f'<span class="badge" style="background:{COLOURS.get(kind, OTHER_COLOUR)}">{html.escape(kind or "unknown")}</span>'


# The sentences, titles and headings below are fixed values: users know them.


def narrative(row) -> Iterator[str]:
    """Paragraphs on one column."""
    name = f"<strong>{html.escape(row.column)}</strong>"
    if row.chains:
        shown = set()
        for c in row.chains:
            key = (c.ultimate_source, c.hops, tuple((h.hop, h.source_column, h.target_column, h.classification, h.statement_type, h.script_name) for h in c.path))
            if key in shown:
                continue
            shown.add(key)
            steps = "step" if c.hops == 1 else f"{c.hops}-step transformation"
            lines = [f"{name} originates from <code>{html.escape(c.ultimate_source)}</code> through a {steps}."]
            for h in c.path:
                source = h.source_column or h.resolved_expression or ""
                said = f"<code>{html.escape(source)}</code>"
                if h.resolved_expression and h.resolved_expression != source:
                    said += f' <em class="expr">expr: {html.escape(h.resolved_expression)}</em>'
                script = f' <span class="script">{html.escape(h.script_name)}</span>' if h.script_name else ""
                lines.append(f'<span class="hop"><em>Step {h.hop}</em> ({html.escape(h.statement_type)}): {said} {badge(h.classification)} &rarr; <code>{html.escape(h.target_column)}</code>{script}</span>')
            yield "<p>" + "<br>".join(lines) + "</p>"
    elif row.state == "unresolved":
        code = ", ".join(f"<code>{html.escape(x)}</code>" for x in row.expressions) or "<em>(unknown)</em>"
        why = "; ".join(map(html.escape, row.reasons))
        yield f"<p>{name} could not be fully traced to an ultimate source. Written via {', '.join(map(html.escape, row.statement_types))} using expression {code}. Reason: <em>{why}</em>.</p>"
    else:
        yield f"<p>{name} has no resolved lineage information.</p>"


STYLE = """body{font:14px sans-serif;margin:2em;color:#222}.stats{display:flex;gap:1em;flex-wrap:wrap}.stat{border:1px solid #ddd;border-radius:6px;padding:.6em 1em}
.stat b{display:block;font-size:1.6em}.badge{color:#fff;border-radius:3px;padding:0 .4em;font-size:11px}.card{border-left:4px solid #2196F3;margin:.6em 0;padding:.2em 1em;background:#fafafa}
.card.unresolved{border-color:#e53935}.card.no-info{border-color:#bdbdbd}.hop{margin-left:2em}.expr{color:#888;font-size:11px}.script{color:#999;font-size:11px}"""


def render(cols: DataFrame, summary: DataFrame) -> Iterator[str]:
    """The page in pieces; rows come to the driver a partition at a time."""
    s = summary.first()
    n = cols.agg(F.count("*"), F.countDistinct("table"), F.count_if(F.col("state") == "resolved"), F.count_if(F.col("state") != "resolved")).first()
    numbers = zip(("Final Target Columns", "Target Tables", "Fully Traced", "Unresolved Source", "Total Chains", "Max Hops"), (*n, s["total_chains"], s["max_chain_hops"]), strict=True)
    yield f'<!DOCTYPE html>\n<html lang="en"><head><meta charset="UTF-8"><title>Column Lineage Report</title><style>{STYLE}</style></head><body>\n<h1>Column Lineage Report</h1>\n'
    yield "<p>Final target columns: data flow from ultimate sources to leaf destinations</p>\n"
    yield '<div class="stats">' + "".join(f'<div class="stat"><b>{v}</b>{k}</div>' for k, v in numbers) + "</div>\n"
    yield "<p>" + " ".join(badge(k) for k in COLOURS) + " Blue: resolved. Red: unresolved source. Grey: no lineage data.</p>\n"
    table = None
    for row in cols.orderBy("table", "target_column").toLocalIterator():
        if row.table != table:
            yield ("</section>\n" if table is not None else "") + f"<section><h2>{html.escape(row.table)}</h2>\n"
            table = row.table
        kind = "" if row.state == "resolved" else f" {row.state}"
        yield f'<div class="card{kind}"><h3>{html.escape(row.column)}</h3>{"".join(narrative(row))}</div>\n'
    yield ("</section>\n" if table is not None else "") + "</body></html>\n"
