"""Script text as column expressions: lines, statements, kinds, and references, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "SELECT")
SHELL_PREFIX = r"\$\{?[A-Za-z_]\w*\}?\."
STATEMENT_END = r"(?md);\s*(?:\n|$)"
LEADING_COMMENTS = r"^(?:\s++|/\*[\s\S]*?\*/|--[^\n]*+(?:\n|$))++"


def trim(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def kept_lines(text: Column) -> Column:
    """Without blank lines and lines whose first character is a dot."""
    lines = F.filter(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"), lambda x: (trim(x) != "") & ~trim(x).startswith("."))
    return F.array_join(lines, "\n")


def without_shell_prefix(text: Column) -> Column:
    return F.regexp_replace(text, SHELL_PREFIX, "")


def flat_comments_removed(text: Column) -> Column:
    """Block comments without nesting, then lines that begin with a star (the dialect's line comments)."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", ""), r"(?m)^\s*\*.*$", "")


def control_lines_removed(text: Column) -> Column:
    """Without block comments, star lines and the dot commands that set, log on and jump; runs of blank lines become one."""
    plain = F.regexp_replace(flat_comments_removed(text), r"(?im)^\s*\.(?:SET|LOGON|LOGOFF|QUIT|IF|GOTO|LABEL|RUN)\b.*$", "")
    return trim(F.regexp_replace(plain, r"\n\s*\n+", "\n"))


def heredoc(text: Column) -> Column:
    """Bodies of ``bteq << EOF`` blocks, joined; from the first such line on where none is closed; else the whole text."""
    found = F.regexp_extract_all(text, F.lit(r"(?is)bteq[^\n]*<<-?\s*[\"']?(\w+)[\"']?[^\n]*\n(.*?)\n\s*\1\b"), F.lit(2))
    rest = F.regexp_extract(text, r"(?is)bteq[^\n]*<<[^\n]*\n(.*)", 1)
    return F.when(F.size(found) > 0, F.array_join(found, "\n")).when(rest != "", rest).otherwise(text)


def statement_array(text: Column, robust: bool = False) -> Column:
    """Statements in order, each with its semicolon; a semicolon ends one only at the end of a line."""
    if robust:
        text = flat_comments_removed(heredoc(text))
    parts = F.split(without_shell_prefix(kept_lines(text)), STATEMENT_END, -1)
    return F.transform(F.filter(F.transform(parts, trim), lambda x: x != ""), lambda x: F.concat(x, F.lit(";")))


def without_leading_comments(sql: Column) -> Column:
    return F.regexp_replace(sql, LEADING_COMMENTS, "")


def kind_of(clean: Column) -> Column:
    """By the first letters alone, without a word boundary."""
    upper = F.upper(clean)
    out = F.when(upper.startswith(KINDS[0]), KINDS[0])
    for k in KINDS[1:]:
        out = out.when(upper.startswith(k), k)
    return out.otherwise("OTHER")


def statements(scripts: DataFrame, robust: bool = False) -> DataFrame:
    """script_name, order (from 1), block, statement_type, statement_text and ``clean``, the text without leading comments."""
    split = scripts.select("script_name", F.posexplode(statement_array(F.col("text"), robust)).alias("pos", "statement_text"))
    clean = split.withColumn("clean", without_leading_comments(F.col("statement_text")))
    return clean.select("script_name", (F.col("pos") + 1).alias("order"), F.lit(1).alias("block"), kind_of(F.col("clean")).alias("statement_type"), "statement_text", "clean")


def all_comments_removed_split(text: Column) -> Column:
    """Every comment removed, then a cut at every semicolon."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
    return F.filter(F.transform(F.split(plain, ";", -1), trim), lambda x: x != "")


def large_inserts(stmts: DataFrame, least: int = 5000) -> DataFrame:
    """INSERT statements of at least ``least`` characters without their dot lines."""
    body = F.array_join(F.filter(F.split("statement_text", "\n"), lambda x: ~trim(x).startswith(".")), "\n")
    return stmts.withColumn("statement_text", body).filter(F.upper("statement_text").contains("INSERT") & (F.length("statement_text") >= least))


def split_column(c: Column, bare_is_table: bool = True) -> tuple[Column, Column]:
    """(table, column) at the first dot; a bare name is a table in the graph and a column in the report."""
    dot = F.instr(c, ".")
    left, right = F.substring_index(c, ".", 1), F.substr(c, dot + 1)
    bare = (c, F.lit("")) if bare_is_table else (F.lit(""), c)
    return F.when(dot > 0, left).otherwise(bare[0]), F.when(dot > 0, right).otherwise(bare[1])
