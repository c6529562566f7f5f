"""Script folders, single scripts, the column dictionary, and folders of files by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_scripts(spark: SparkSession, folder: str | None = None, single: str | None = None, corpus: str | None = None, prefix: str = "", files: Sequence[str] | None = None) -> DataFrame:
    """script_name and text of the ``.sh`` files of one folder (not of folders below it), or of a single file.

    Exactly one of ``folder``, ``single`` and ``corpus`` is given; archives (``corpus``) aren't supported. Bytes that are no
    UTF-8 become replacement characters.
    """
    if sum(x is not None for x in (folder, single, corpus)) != 1:
        raise ValueError("give exactly one of a folder, a single file and a corpus")
    if corpus is not None:
        raise NotImplementedError("a corpus archive can't be read; unpack it and give the folder")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    found = reader.load(single) if single else reader.option("pathGlobFilter", "*.[sS][hH]").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    out = found.select(name.alias("script_name"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    if prefix:
        out = out.filter(F.col("script_name").startswith(prefix))
    return out.filter(F.col("script_name").isin(list(files))) if files is not None else out


def missing_files(scripts: DataFrame, files: Sequence[str]) -> DataFrame:
    """Names that were asked for and aren't there."""
    asked = scripts.sparkSession.createDataFrame([(f,) for f in files], "script_name string")
    return asked.join(scripts.select("script_name"), "script_name", "left_anti")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """column and tables (``SCHEMA.TABLE``, sorted) from a CSV with the headers Schema, Table and Column in any case and order."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    held = {c.replace("﻿", "").strip().lower(): c for c in raw.columns}
    if lost := {"schema", "table", "column"} - set(held):
        raise ValueError(f"the dictionary has no header {', '.join(sorted(lost))}")
    rows = raw.select(*(F.trim(F.col(f"`{held[k]}`")).alias(k) for k in ("schema", "table", "column")))
    return dictionary(rows)


def dictionary(rows: DataFrame) -> DataFrame:
    """From rows of schema, table and column; those with a blank are dropped."""
    full = rows.filter(" and ".join(f"length(`{c}`) > 0" for c in ("schema", "table", "column")))
    name = F.upper(F.concat_ws(".", "schema", "table"))
    return full.groupBy(F.upper("column").alias("column")).agg(F.array_sort(F.collect_set(name)).alias("tables"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """name, path and md5 of the files of one folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.md5("content").alias("md5"))
