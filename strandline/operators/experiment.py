"""The parser against the positional text method, on large INSERT statements."""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.functions.text import large_inserts
from strandline.plans.lineage import parse_statement, positional_insert

COLUMNS = "script_name string, `order` int, chars int, full_seconds double, full_error string, full_columns int, full_with_sources int, text_seconds double, text_columns int, text_with_sources int"


def compare(stmts: DataFrame, least: int = 5000, seconds: float = 15.0) -> DataFrame:
    """For each INSERT of at least ``least`` characters: seconds, columns and columns with sources by either method."""

    def run(batches):
        names = [c.split()[0].strip("`") for c in COLUMNS.split(", ")]
        for b in batches:
            rows = []
            for script, order, sql in zip(*(b.column(c).to_pylist() for c in ("script_name", "order", "clean")), strict=True):
                began = time.perf_counter()
                full, error = parse_statement("INSERT", sql, seconds=seconds)
                middle = time.perf_counter()
                text = positional_insert(sql)
                end = time.perf_counter()
                count = [(len(s), sum(bool(x["base_sources"]) for x in s)) for s in ((r or {}).get("column_semantics") or [] for r in (full, text))]
                rows.append((script, order, len(sql), middle - began, error, *count[0], end - middle, *count[1]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return large_inserts(stmts, least).select("script_name", "order", "clean").mapInArrow(run, COLUMNS)
