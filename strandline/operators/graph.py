"""The column graph: edges, chains from roots to leaves, direct and ultimate sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import split_column
from strandline.schemas import HOP
from strandline.storage import written


def edges(parsed: DataFrame) -> DataFrame:
    """One row for each source and target column; a target without source keeps one row with a null source and its note."""
    label = F.concat_ws("/", "statement_type", "semantic.create_kind")
    each = parsed.filter("semantic is not null").select("script_name", F.col("order").alias("statement_order"), label.alias("statement_type"), F.explode("semantic.column_semantics").alias("s"))
    each = each.filter("s.target_column is not null").select("*", F.explode_outer("s.base_sources").alias("source_column"))
    note = F.when(F.col("source_column").isNull(), F.col("s.resolution_note"))
    return each.select(
        "source_column", "s.target_column", "statement_order", "statement_type", "s.resolved_expression", "s.classification", "script_name", "s.merge_clause", note.alias("resolution_note")
    )


def resolved(e: DataFrame) -> DataFrame:
    """Edges with both ends, each (source, target, expression, order) once: that of the first script by name."""
    rest = [c for c in e.columns if c not in ("source_column", "target_column", "resolved_expression", "statement_order")]
    first = F.min(F.struct(F.col("script_name"), *(F.col(c) for c in rest if c != "script_name")))
    best = e.filter("source_column is not null and target_column is not null").groupBy("source_column", "target_column", "resolved_expression", "statement_order").agg(first.alias("first"))
    return best.select("source_column", "target_column", "statement_order", "resolved_expression", "first.*").select(*e.columns)


def roots(e: DataFrame) -> DataFrame:
    """Sources that are no target."""
    return e.select(F.col("source_column").alias("node")).join(e.select(F.col("target_column").alias("node")), "node", "left_anti").distinct()


def leaves(e: DataFrame) -> DataFrame:
    """Targets that are no source."""
    return e.select(F.col("target_column").alias("node")).join(e.select(F.col("source_column").alias("node")), "node", "left_anti").distinct()


def _hop(number: Column | int) -> Column:
    n = number if isinstance(number, Column) else F.lit(number)
    return F.struct(n.cast("int").alias("hop"), "source_column", "target_column", F.col("statement_order").cast("int").alias("statement_order"), "statement_type", "resolved_expression", "classification", "script_name").cast(HOP)


def best_edges(e: DataFrame) -> DataFrame:
    """One edge for each pair of nodes: that of the earliest statement, then the first in text order."""
    best = F.min(F.struct("statement_order", "resolved_expression", "script_name", "statement_type", "classification")).alias("b")
    good = e.filter("source_column is not null and target_column is not null")
    return good.groupBy("source_column", "target_column").agg(best).select("source_column", "target_column", "b.*")


def reach(hop: DataFrame, starts: DataFrame | None = None, max_rounds: int | None = None) -> DataFrame:
    """Columns root, node, hops, previous: for each root and each node that it reaches, the fewest hops and the node before it.

    ``hop``: a written table with source_column and target_column. Breadth first; of several nodes before it on shortest paths
    that counts whose name is first, so results don't depend on the order of rows. Rows carry no paths; pruning by (root, node)
    keeps the work within roots times edges, and ends cycles. Each round is a written table; nothing is collected.
    """
    starts = starts if starts is not None else roots(hop)
    link = hop.select("source_column", "target_column").distinct()
    seen = written(starts.select(F.col("node").alias("root"), "node"), "graph-reach")
    frontier, rounds, parts, reached = seen, 0, [], seen
    while (max_rounds is None or rounds < max_rounds) and not frontier.isEmpty():
        rounds += 1
        step = frontier.select("root", F.col("node").alias("source_column")).join(link, "source_column")
        best = step.groupBy("root", F.col("target_column").alias("node")).agg(F.min("source_column").alias("previous"))
        frontier = written(best.join(reached, ["root", "node"], "left_anti").select("root", "node", F.lit(rounds).alias("hops"), "previous"), "graph-reach")
        parts.append(frontier)
        reached = reached.union(frontier.select("root", "node"))
    out = seen.select("root", "node", F.lit(0).alias("hops"), F.lit(None).cast("string").alias("previous")).filter("false")
    for p in parts:
        out = out.union(p)
    return out


def pairs(e: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """ultimate_source, ultimate_target and hops of each root and each leaf that it reaches: all that counts and rollups need."""
    hop = written(e.filter("source_column is not null and target_column is not null").select("source_column", "target_column").distinct(), "graph-links")
    ends = leaves(hop).withColumnRenamed("node", "ultimate_target")
    found = reach(hop, starts).select(F.col("root").alias("ultimate_source"), F.col("node").alias("ultimate_target"), "hops")
    return found.join(ends, "ultimate_target", "left_semi").select("ultimate_source", "ultimate_target", "hops")


def steps(hop: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """One row for each hop of each chain: root, leaf, total, hop (from 1), source_column and target_column.

    Chains are rebuilt once, from their leaves back, all of them a hop a round.
    """
    found = written(reach(hop, starts), "graph-reached")
    at = written(found.join(leaves(hop), "node", "left_semi").select("root", F.col("node").alias("leaf"), F.col("hops").alias("total"), "node", "hops", "previous"), "graph-steps")
    parts, most = [at], at.agg(F.max("hops")).first()[0] or 0
    before = found.select("root", F.col("node").alias("at node"), "hops", F.col("previous").alias("one before"))
    for n in range(most - 1, 0, -1):  # chains of more than n hops have an n-th one
        back = at.filter(F.col("hops") == n + 1).select("root", "leaf", "total", F.col("previous").alias("at node"))
        one = back.join(before.filter(F.col("hops") == n), ["root", "at node"]).select("root", "leaf", "total", F.col("at node").alias("node"), "hops", F.col("one before").alias("previous"))
        parts.append(written(one, "graph-steps"))
        at = parts[0].filter(F.col("hops") == n).union(parts[-1])
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("root", "leaf", "total", F.col("hops").alias("hop"), F.col("previous").alias("source_column"), F.col("node").alias("target_column"))


def chains(e: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """One chain for each root and each leaf that it reaches, with its path; of the fewest hops, then first by the names from the leaf back."""
    hop = written(best_edges(e), "graph-edges")
    each = steps(hop, starts).join(hop, ["source_column", "target_column"])
    path = F.array_sort(F.collect_list(_hop(F.col("hop")))).alias("path")  # as long as the chain
    return each.groupBy(F.col("root").alias("ultimate_source"), F.col("leaf").alias("ultimate_target")).agg(F.first("total").alias("hops"), path)


def in_order(found: DataFrame) -> DataFrame:
    """Chains by source and target, for a sink that shows them."""
    return found.orderBy("ultimate_source", "ultimate_target")


def chain_hops(found: DataFrame) -> DataFrame:
    """One row for each hop of each chain, with the columns of the hop table."""
    each = found.select("ultimate_source", "ultimate_target", F.col("hops").alias("total_hops"), F.explode("path").alias("h"))
    (st, sc), (tt, tc) = split_column(F.col("h.source_column")), split_column(F.col("h.target_column"))
    return each.select(
        "ultimate_source", "ultimate_target", "total_hops", F.col("h.hop").alias("hop_number"),
        st.alias("hop_source_table"), sc.alias("hop_source_column_name"), F.col("h.source_column").alias("hop_source_column"),
        tt.alias("hop_target_table"), tc.alias("hop_target_column_name"), F.col("h.target_column").alias("hop_target_column"),
        "h.statement_order", "h.statement_type", "h.resolved_expression", "h.classification",
    )


def edge_table(e: DataFrame) -> DataFrame:
    """Edges with the columns of the edge table; a null source is two empty names."""
    (st, sc), (tt, tc) = split_column(F.coalesce("source_column", F.lit(""))), split_column(F.col("target_column"))
    return e.select(
        "script_name", "statement_order", "statement_type", st.alias("source_table"), sc.alias("source_column_name"), F.coalesce("source_column", F.lit("")).alias("source_column"),
        tt.alias("target_table"), tc.alias("target_column_name"), "target_column", "resolved_expression", "classification", "merge_clause", "resolution_note",
    )


def direct_sources(e: DataFrame) -> DataFrame:
    return e.filter("target_column is not null").groupBy("target_column").agg(F.array_sort(F.collect_set("source_column")).alias("direct_sources"))


def column_sources(e: DataFrame, found: DataFrame) -> DataFrame:
    """For each target: direct sources, ultimate sources (of chains or pairs that end there) and how many chains these are."""
    held = found.groupBy(F.col("ultimate_target").alias("target_column")).agg(F.array_sort(F.collect_set("ultimate_source")).alias("ultimate_base_sources"), F.count("*").alias("chains"))
    return direct_sources(e).join(held, "target_column", "left").select(
        "target_column", "direct_sources", F.coalesce("ultimate_base_sources", F.array().cast("array<string>")).alias("ultimate_base_sources"), F.coalesce("chains", F.lit(0)).alias("chains")
    )


def column_lineage(e: DataFrame, found: DataFrame) -> DataFrame:
    """For each target: direct sources, ultimate sources (of chains that end there) and those chains, as the sinks show them."""
    held = found.groupBy(F.col("ultimate_target").alias("target_column")).agg(
        F.array_sort(F.collect_set("ultimate_source")).alias("ultimate_base_sources"), F.array_sort(F.collect_list(F.struct("ultimate_source", "ultimate_target", "hops", "path"))).alias("transformation_chains")
    )
    empty = F.array()
    return direct_sources(e).join(held, "target_column", "left").select(
        "target_column", "direct_sources", F.coalesce("ultimate_base_sources", empty.cast("array<string>")).alias("ultimate_base_sources"),
        F.coalesce("transformation_chains", empty.cast(held.schema["transformation_chains"].dataType)).alias("transformation_chains"),
    )


def summary(e: DataFrame, found: DataFrame) -> DataFrame:
    """One row of counts; ``found``: chains or pairs."""
    by_edge = e.agg(F.count("*").alias("total_edges"), F.count("source_column").alias("resolved_edges"), F.count_if(F.col("source_column").isNull()).alias("unresolved_edges"), F.countDistinct("target_column").alias("unique_target_columns"))
    by_chain = found.agg(F.count("*").alias("total_chains"), F.coalesce(F.max("hops"), F.lit(0)).alias("max_chain_hops"))
    return by_edge.crossJoin(by_chain)  # one row each
