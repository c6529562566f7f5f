"""Folder to report: ``python -m strandline.cli FOLDER [OUTPUT] [--reset]``."""

from __future__ import annotations

import argparse
import logging
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import dq, graph, report
from strandline.plans.pipeline import script_results
from strandline.progress import Progress
from strandline.sources.scripts import missing_files, read_dictionary, read_scripts
from strandline.storage import drop_path
from strandline.streaming.incremental import evicted, parse_pending

log = logging.getLogger("strandline")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="strandline", description="Column lineage of load scripts.")
    p.add_argument("folder", nargs="?", help="folder of .sh files")
    p.add_argument("output", nargs="?", help="output folder (default: output/<folder name>)")
    p.add_argument("--single", help="one script instead of a folder")
    p.add_argument("--corpus", help="an archive of scripts (not supported)")
    p.add_argument("--dict-csv", help="column dictionary with the headers Schema, Table, Column")
    p.add_argument("--prefix", default="", help="only scripts whose name begins so")
    p.add_argument("--files", help="only these scripts, comma-separated; they are parsed again")
    p.add_argument("--max-stmt-chars", type=int, default=10_000)
    p.add_argument("--stmt-timeout", type=float, default=10.0)
    p.add_argument("--robust", action="store_true", help="also read what comments and here-documents hide")
    p.add_argument("--reset", action="store_true", help="forget what was parsed before")
    p.add_argument("--log-file")
    return p.parse_args(argv)


def evict(spark: SparkSession, checkpoint: str, names: list[str]) -> None:
    """Rewrite the checkpoint without some scripts: a new table beside it, then the old one's place."""
    if not os.path.isdir(checkpoint):
        return
    fresh = f"{checkpoint}.new"
    evicted(spark.read.parquet(checkpoint), names).write.mode("overwrite").parquet(fresh)
    drop_path(spark, checkpoint)
    os.rename(fresh, checkpoint)


def build(parsed: DataFrame, out: str) -> str:
    """Graph tables, CSV files and the report from parsed statements."""
    spark = parsed.sparkSession
    graph.edges(parsed).write.mode("overwrite").parquet(f"{out}/edges")
    e = spark.read.parquet(f"{out}/edges")
    good = graph.resolved(e)
    graph.in_order(graph.chains(good)).write.mode("overwrite").parquet(f"{out}/chains")
    chains = spark.read.parquet(f"{out}/chains")
    graph.column_lineage(e, chains).orderBy("target_column").write.mode("overwrite").parquet(f"{out}/column_lineage")
    lineage = spark.read.parquet(f"{out}/column_lineage")
    graph.edge_table(e).write.mode("overwrite").option("header", True).csv(f"{out}/edges_csv")
    graph.chain_hops(chains).orderBy("ultimate_source", "ultimate_target", "hop_number").write.mode("overwrite").option("header", True).csv(f"{out}/chain_hops_csv")
    total = graph.summary(e, chains)
    total.write.mode("overwrite").json(f"{out}/graph_summary")
    page = f"{out}/report.html"
    with open(page, "w", encoding="utf-8") as f:
        for piece in report.render(report.columns(e, lineage), total):
            f.write(piece)
    return page


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    logging.basicConfig(level=logging.DEBUG if a.log_file else logging.WARNING, filename=a.log_file)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("strandline").getOrCreate()
    began = time.time()
    names = [x.strip() for x in a.files.split(",") if x.strip()] if a.files else None
    scripts = read_scripts(spark, a.folder, a.single, a.corpus, a.prefix, names)
    base = a.folder or a.single or ""
    out = os.path.abspath(a.output or os.path.join("output", os.path.basename(os.path.normpath(base))))
    os.makedirs(out, exist_ok=True)
    checkpoint = f"{out}/statements"
    if a.reset and os.path.isdir(checkpoint):
        drop_path(spark, checkpoint)
    if names:
        for row in missing_files(scripts, names).toLocalIterator():
            log.warning("%s isn't there", row.script_name)
        evict(spark, checkpoint, names)
    entries = read_dictionary(spark, a.dict_csv) if a.dict_csv else None
    with Progress(spark):
        parsed = parse_pending(scripts, checkpoint, entries=entries, robust=a.robust, limit=a.max_stmt_chars, seconds=a.stmt_timeout)
    results = script_results(scripts.select("script_name"), parsed)
    results.write.mode("overwrite").json(f"{out}/script_results")
    total = dq.rollup(results, parsed).withColumns({"wall_seconds": F.lit(round(time.time() - began, 1)), "dictionary": F.lit(a.dict_csv), "prefix": F.lit(a.prefix)})
    total.write.mode("overwrite").json(f"{out}/summary")
    page = build(parsed, out)
    print(f"{total.first().asDict()}\n{page}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
