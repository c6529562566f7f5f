"""Queries over the test tables and small literal inputs, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import text
from strandline.operators import dedup, dq, graph, patterns, report
from strandline.plans import lineage as statement
from strandline.plans.pipeline import parse, references, routed, script_results
from strandline.schemas import RECORD
from strandline.sources.scripts import dictionary
from strandline.storage import fresh_path, table, written
from strandline.streaming.incremental import latest, pending

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def values(rows: list[tuple]) -> str:
    """Rows for a VALUES clause."""

    def one(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, list):
            return "[" + ", ".join(map(one, x)) + "]::VARCHAR[]"
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


# -- literal inputs ----------------------------------------------------------------------------------------

SCRIPTS = [
    (
        "a_stage.sh",
        "#!/bin/sh\nbteq << EOF\n.LOGON x\n.SET WIDTH 200\n\nDELETE FROM $DB.STG ALL;\nINSERT INTO ${DB}.STG (K, V)\nSELECT S.K, COALESCE(S.V, U.W)\nFROM $DB.SRC S LEFT JOIN $DB.UU U ON S.K = U.K;\n.IF ERRORCODE <> 0 THEN .QUIT 1\nSELECT 'a;b' FROM $DB.STG;\nEOF\n",
    ),
    (
        "b_core.sh",
        "/* load of the core */ -- twice a day\nINSERT INTO CORE (K, V, TAG)\nSELECT K, V, 'x' FROM STG;\nUPDATE CORE FROM FIX F SET V = F.V WHERE CORE.K = F.K;\nMERGE INTO MART USING CORE C ON MART.K = C.K\nWHEN MATCHED THEN UPDATE SET V = C.V\nWHEN NOT MATCHED THEN INSERT (K, V) VALUES (C.K, C.V);\nCREATE TABLE OUTCOME AS (SELECT M.K, M.V + 1 AS V1 FROM MART M) WITH DATA;\nSEL 1;\nCALL P();\n",
    ),
    ("c_hidden.sh", "/* a\n/* b */\n***/\nINSERT INTO T (A) SELECT S.X FROM S;\nINSERT INTO BOTH_SIDES (A) SELECT X FROM S1 JOIN S2 ON S1.K = S2.K;\nUPDATE T SET A = A || B || C || D || 'z';\n"),
    ("d_empty.sh", ".QUIT 0\n\n"),
]
EXPRESSIONS = [(1, "COALESCE(S.Y, U.Z)"), (2, "CASE WHEN A.B > 1 THEN 'C.D' ELSE e END"), (3, "'only text'"), (4, "x + X + t.x - 12"), (5, "")]
INSERTS = [(1, "INSERT INTO T (A) SELECT X FROM S1 JOIN S2 ON S1.K=S2.K"), (2, "insert into t select a from T join db.u v on v.k = t.k join DB.U w on 1=1"), (3, "INSERT T (A) SELECT 1"), (4, "INS T SELECT X FROM U, V JOIN w ON 1=1")]
SEMANTICS = [
    ("T.A", ["S.X"], "Direct assignment", None), ("T.B", [], "Constant", None), ("T.C", [], "Derived", "Column 'C' not found in external dictionary lookup"),
    ("T.D", [], "Derived", "Column 'D' is ambiguous across multiple source tables: S, U"), ("T.E", [], "Direct assignment", "Column 'E' is unqualified and no external dictionary was provided"),
    ("T.F", [], "Derived", None), ("T.G", ["S.X", "U.Y"], "Derived (function)", None), ("T.H", [], "Derived", "Qualified source column references a table not present in scope"),
]
DICTIONARY = [("D", "STG", "K"), ("D", "FIX", "k"), ("D", "UU", "W"), ("E", "UU", "w"), ("D", "STG", "V"), ("", "STG", "V"), ("D", "STG", "")]
CYCLE = [("A", "B"), ("B", "C"), ("C", "B"), ("C", "D"), ("X", "B"), ("D", "E"), ("Y", "Y2"), ("Y2", "Y"), ("B", "E")]


def _scripts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCRIPTS, "script_name string, text string")


def _semantics(spark: SparkSession) -> DataFrame:
    rows = [("s.sh", 1, t, "e", src, c, n, None) for t, src, c, n in SEMANTICS]
    return spark.createDataFrame(rows, "script_name string, order int, target_column string, resolved_expression string, base_sources array<string>, classification string, resolution_note string, merge_clause string")


STATEMENTS_SQL = rf"""scripts(script_name, txt) AS (VALUES {values(SCRIPTS)}),
kept AS (SELECT script_name, array_to_string(list_filter(string_split(txt, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '' AND NOT starts_with(regexp_replace(x, '^\s+', '', 'g'), '.')), chr(10)) AS t FROM scripts),
cut AS (SELECT script_name, list_filter(list_transform(string_split_regex(regexp_replace(t, '\$\{{?[A-Za-z_]\w*\}}?\.', '', 'g'), '(?m);\s*(?:\n|$)'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM kept),
stmts AS (SELECT script_name, CAST(i AS BIGINT) AS ord, p[i] || ';' AS statement_text, regexp_replace(p[i] || ';', '^(?:\s+|/\*(?s:.*?)\*/|--[^\n]*(?:\n|$))+', '') AS clean FROM cut, unnest(generate_series(1, len(p))) AS u(i)),
kinds AS (SELECT *, CASE WHEN upper(clean) LIKE 'INSERT%' THEN 'INSERT' WHEN upper(clean) LIKE 'UPDATE%' THEN 'UPDATE' WHEN upper(clean) LIKE 'DELETE%' THEN 'DELETE' WHEN upper(clean) LIKE 'MERGE%' THEN 'MERGE'
  WHEN upper(clean) LIKE 'CREATE%' THEN 'CREATE' WHEN upper(clean) LIKE 'SELECT%' THEN 'SELECT' ELSE 'OTHER' END AS statement_type FROM stmts)"""

# -- text --------------------------------------------------------------------------------------------------


@query(f"WITH {STATEMENTS_SQL} SELECT script_name, ord, statement_text FROM stmts")
def statement_split(spark, sf_dir):
    return text.statements(_scripts(spark)).select("script_name", F.col("order").cast("long").alias("ord"), "statement_text")


@query(f"WITH {STATEMENTS_SQL} SELECT script_name, ord, statement_type FROM kinds")
def statement_classify(spark, sf_dir):
    return text.statements(_scripts(spark)).select("script_name", F.col("order").cast("long").alias("ord"), "statement_type")


@query(f"""WITH {STATEMENTS_SQL} SELECT script_name, count(*) AS statements, count(*) FILTER (statement_type = 'INSERT') AS inserts, count(*) FILTER (statement_type = 'UPDATE') AS updates,
  count(*) FILTER (statement_type = 'MERGE') AS merges, count(*) FILTER (statement_type = 'CREATE') AS creates, count(*) FILTER (statement_type = 'OTHER') AS others FROM kinds GROUP BY script_name""")
def statement_counts(spark, sf_dir):
    s = F.col("statement_type")
    counts = [F.count_if(s == k).alias(n) for k, n in (("INSERT", "inserts"), ("UPDATE", "updates"), ("MERGE", "merges"), ("CREATE", "creates"), ("OTHER", "others"))]
    return text.statements(_scripts(spark)).groupBy("script_name").agg(F.count("*").alias("statements"), *counts)


@query(rf"SELECT script_name, regexp_replace(txt, '\$\{{?[A-Za-z_]\w*\}}?\.', '', 'g') AS stripped FROM (VALUES {values(SCRIPTS)}) t(script_name, txt)")
def shell_prefix_strip(spark, sf_dir):
    return _scripts(spark).select("script_name", text.without_shell_prefix(F.col("text")).alias("stripped"))


@query(r"""SELECT doc_id, CASE WHEN length(text) > 10000 THEN 'SimplifiedParse: too large' WHEN regexp_matches(text, '(?s)\|\|.{0,200}\|\|.{0,200}\|\|') THEN 'SimplifiedParse: concat-chain pattern detected' ELSE 'SimplifiedParse: full parser failed' END AS note, 'simplified' AS parse_mode FROM documents""")
def route_flags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("clean"), F.lit("UPDATE").alias("statement_type"))
    note = F.regexp_replace("parse_note", r"(?s) \(.*", "")
    return routed(docs).select("doc_id", note.alias("note"), F.get_json_object("record", "$.parse_mode").alias("parse_mode"))


_KEYS = ", ".join(f"'{k}'" for k in sorted(statement.KEYWORDS))
_REFS_SQL = rf"""list_filter(list_transform(regexp_extract_all(regexp_replace({{0}}, '''[^'']*''', ' ', 'g'), '\b[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?\b'), lambda x: upper(x)),
  lambda x: len(list_filter(string_split(x, '.'), lambda y: NOT list_contains([{_KEYS}], y))) > 0)"""


@query(f"""WITH e(id, e) AS (VALUES {values(EXPRESSIONS)}), r AS (SELECT id, {_REFS_SQL.format("e")} AS r FROM e)
  SELECT CAST(id AS BIGINT) AS id, array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i), ',') AS refs FROM r""")
def column_refs(spark, sf_dir):
    rows = spark.createDataFrame(EXPRESSIONS, "id long, e string")
    return references(rows, "e", statement.column_refs).select("id", F.array_join("found", ",").alias("refs"))


@query(f"WITH r AS (SELECT event_id, {_REFS_SQL.format('props')} AS r FROM events) SELECT event_id, array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i), ',') AS refs FROM r")
def column_refs_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    return references(rows, "props", statement.column_refs).select("event_id", F.array_join("found", ",").alias("refs"))


# with a column list and a SELECT the target is that of the positional method, else the plain one's or UNKNOWN
@query(rf"""WITH s(id, s) AS (VALUES {values(INSERTS)}), t AS (SELECT id, s, coalesce(nullif(regexp_extract(s, '(?i)INSERT\s+(?:INTO\s+)?(\S+)\s*\([^()]*\)\s*SELECT', 1), ''), nullif(regexp_extract(s, '(?i)INSERT\s+INTO\s+([A-Za-z0-9_$.]+)', 1), ''), 'UNKNOWN') AS target FROM s),
  f AS (SELECT id, target, list_filter(regexp_extract_all(s, '(?i)(?:FROM|JOIN)\s+([A-Za-z0-9_$.]+)', 1), lambda x: upper(x) <> upper(target)) AS f FROM t)
  SELECT CAST(id AS BIGINT) AS id, target, array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ',') AS tables FROM f""")
def source_tables(spark, sf_dir):
    rows = spark.createDataFrame([(i, "INSERT", e) for i, e in INSERTS], "id long, statement_type string, clean string")
    found = routed(rows, limit=0).select("id", F.from_json("record", RECORD).alias("r"))  # too large: by text alone
    return found.select("id", F.col("r.target.table").alias("target"), F.array_join("r.source_scope.base_tables", ",").alias("tables"))


@query(f"""SELECT upper(c) AS "column", string_agg(DISTINCT upper(s || '.' || t), ',' ORDER BY upper(s || '.' || t)) AS tables FROM (VALUES {values(DICTIONARY)}) d(s, t, c) WHERE s <> '' AND t <> '' AND c <> '' GROUP BY 1""")
def dict_load(spark, sf_dir):
    return dictionary(spark.createDataFrame(DICTIONARY, "schema string, table string, column string")).select("column", F.array_join("tables", ",").alias("tables"))


@query("""WITH r AS (SELECT c_custkey, c_nationkey AS n, n_regionkey AS g, c_custkey % 5 AS a, (c_custkey + 1) % 5 AS b FROM customer JOIN nation ON n_nationkey = c_nationkey)
  SELECT 'T' || c_custkey || '.A' AS target_column, CASE WHEN g IN (a, b) THEN 'S' || g || '.C' || n END AS source_column,
    CASE WHEN g NOT IN (a, b) THEN 'Column ' || chr(39) || 'C' || n || chr(39) || ' exists in external dictionary but none of its tables (S' || g || ') match the in-scope tables (S' || least(a, b) || ', S' || greatest(a, b) || ')' END AS resolution_note FROM r""")
def bind_columns(spark, sf_dir):
    """A statement for each customer names its nation's column bare, with two of five tables in scope; the dictionary has each nation's column in its region's table."""
    n = table(spark, sf_dir, "nation")
    entries = dictionary(n.select(F.lit("D").alias("schema"), F.concat(F.lit("S"), "n_regionkey").alias("table"), F.concat(F.lit("C"), "n_nationkey").alias("column")))
    a, b = (F.pmod(F.col("c_custkey") + k, F.lit(5)) for k in (0, 1))
    sql = F.format_string("INSERT INTO T%d (A) SELECT C%d FROM S%d JOIN S%d ON S%d.K = S%d.K;\n", "c_custkey", "c_nationkey", a, b, a, b)
    scripts = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey", F.lit(".sh")).alias("script_name"), sql.alias("text"))
    return graph.edges(parse(scripts, entries)).select("target_column", "source_column", "resolution_note")


# -- lineage -------------------------------------------------------------------------------------------------

LINEAGE = [
    ("a_stage.sh", 2, "INSERT", "SRC.K", "STG.K", "Direct assignment", None), ("a_stage.sh", 2, "INSERT", "SRC.V", "STG.V", "Derived (function)", None), ("a_stage.sh", 2, "INSERT", "UU.W", "STG.V", "Derived (function)", None),
    ("b_core.sh", 1, "INSERT", "STG.K", "CORE.K", "Direct assignment", None), ("b_core.sh", 1, "INSERT", "STG.V", "CORE.V", "Direct assignment", None), ("b_core.sh", 1, "INSERT", None, "CORE.TAG", "Constant", None),
    ("b_core.sh", 2, "UPDATE", "FIX.V", "CORE.V", "Direct assignment", None), ("b_core.sh", 3, "MERGE", "CORE.V", "MART.V", "Direct assignment", "WHEN MATCHED UPDATE"), ("b_core.sh", 3, "MERGE", "CORE.K", "MART.K", "Direct assignment", "WHEN NOT MATCHED INSERT"),
    ("b_core.sh", 3, "MERGE", "CORE.V", "MART.V", "Direct assignment", "WHEN NOT MATCHED INSERT"), ("b_core.sh", 4, "CREATE/CTAS", "MART.K", "OUTCOME.K", "Direct assignment", None), ("b_core.sh", 4, "CREATE/CTAS", "MART.V", "OUTCOME.V1", "Derived (arithmetic)", None),
    ("c_hidden.sh", 2, "INSERT", None, "BOTH_SIDES.A", "Direct assignment", None),
]


# the statements of a_stage.sh begin with the shell's lines, so its first is no DELETE; c_hidden.sh's first is hidden by a comment's rest
@query(f"SELECT script_name, CAST(o AS BIGINT) AS statement_order, statement_type, source_column, target_column, classification, merge_clause FROM (VALUES {values(LINEAGE)}) t(script_name, o, statement_type, source_column, target_column, classification, merge_clause)")
def lineage_edges(spark, sf_dir):
    e = graph.edges(parse(_scripts(spark)))
    return e.select("script_name", F.col("statement_order").cast("long").alias("statement_order"), "statement_type", "source_column", "target_column", "classification", "merge_clause")


#: Statements by a part's remainder, with its key for {k}; what each must give: mode, kind of CREATE, note, error.
FORMS: list[tuple[str, tuple, list[tuple]]] = [
    ("INSERT INTO T{k} (A, B) SELECT S.X + 1 AS C1, C1 * 2 FROM SRC{k} S;", ("full", None, None, None), [("SRC{k}.X", "T{k}.A", "Derived (arithmetic)", None), ("SRC{k}.X", "T{k}.B", "Derived (arithmetic)", None)]),
    ("INSERT INTO T{k} ('a', {k});", ("full", None, None, None), [(None, "T{k}.COL_1", "Constant", None), (None, "T{k}.COL_2", "Constant", None)]),
    ("INSERT INTO T{k} (A) VALUES (1);", ("simplified", None, "SimplifiedParse: full parser failed (GrammarError: INSERT source is not a SELECT)", None), []),
    ("CREATE TABLE T{k} (A INTEGER, B DECIMAL(10,2) NOT NULL);", ("full", "DDL", None, None), []),
    ("INSERT INTO T{k} (A) SELECT S.X FROM S1_{k} S UNION ALL SELECT U.Y FROM S2_{k} U;", ("full", None, None, None), [("S1_{k}.X", "T{k}.A", "Direct assignment", None)]),
    ("INSERT INTO T{k} (A) SELECT X FROM S1_{k} JOIN S2_{k} ON S1_{k}.K = S2_{k}.K;", ("full", None, None, None), [(None, "T{k}.A", "Direct assignment", "Column 'X' is unqualified and no external dictionary was provided")]),
    ("INSERT INTO T{k} (A) SELECT Z.X FROM SRC{k} S;", ("full", None, None, None), [(None, "T{k}.A", "Direct assignment", "Qualified source column references a table not present in scope")]),
    ("INSERT INTO T{k} (A, B, C) SELECT S.X || '-' || S.Y || '-' || F(S.Z, 1), S.W AS V, 'k' FROM SRC{k} S;", ("positional", None, "PositionalParse: concat-chain pattern detected", None),
     [("S.X", "T{k}.A", "DERIVED", None), ("S.Y", "T{k}.A", "DERIVED", None), ("S.Z", "T{k}.A", "DERIVED", None), ("S.W", "T{k}.B", "DIRECT", None), (None, "T{k}.C", "CONSTANT", None)]),
    ("INSERT INTO T{k} (A) SELECT S.X FROM SRC{k} S WHERE S.N IN ({long}0);", ("positional", None, "PositionalParse: too large", None), [("S.X", "T{k}.A", "DIRECT", None)]),
    ("UPDATE T{k} SET A = B || C || D || E;", ("simplified", None, "SimplifiedParse: concat-chain pattern detected", None), []),
    ("UPDATE T{k} FROM SRC{k} S SET A = S.X, B = 0 WHERE T{k}.K = S.K;", ("full", None, None, None), [("SRC{k}.X", "T{k}.A", "Direct assignment", None), (None, "T{k}.B", "Constant", None)]),
    ("MERGE INTO T{k} USING SRC{k} S ON T{k}.K = S.K WHEN MATCHED THEN UPDATE SET A = S.X;", ("full", None, None, None), [("SRC{k}.X", "T{k}.A", "Direct assignment", None)]),
    ("CREATE TABLE T{k} AS (SELECT COALESCE(S.X, 0) AS A FROM SRC{k} S) WITH DATA;", ("full", "CTAS", None, None), [("SRC{k}.X", "T{k}.A", "Derived (function)", None)]),
    ("CREATE TABLE T{k} AS (SELECT S.X FROM SRC{k} S WHERE S.N IN ({long}0)) WITH DATA;", (None, None, None, "StatementTooLarge"), []),
    ("DELETE FROM T{k} ALL;", (None, None, None, None), []),
]
LONG = "1, " * 4000


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script for each supplier: a statement for each part, forms in turn, parts dealt to suppliers."""
    forms = spark.createDataFrame([(n, f[0].replace("{long}", LONG)) for n, f in enumerate(FORMS)], "form long, sql string")
    suppliers = table(spark, sf_dir, "supplier").count()
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % len(FORMS)).alias("form"), (F.col("p_partkey") % suppliers).alias("s"))
    lines = parts.join(F.broadcast(forms), "form").select("s", F.struct("p_partkey", F.replace("sql", F.lit("{k}"), F.col("p_partkey").cast("string")).alias("sql")).alias("line"))
    held = lines.groupBy("s").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return held.select(F.format_string("s%d.sh", "s").alias("script_name"), F.concat(F.array_join("lines.sql", "\n"), F.lit("\n")).alias("text"))


_FORM_SQL = f"p AS (SELECT p_partkey AS k, p_partkey % {len(FORMS)} AS form, 's' || (p_partkey % (SELECT count(*) FROM supplier)) || '.sh' AS script_name, row_number() OVER (PARTITION BY p_partkey % (SELECT count(*) FROM supplier) ORDER BY p_partkey) AS ord FROM part)"


@query(f"""WITH {_FORM_SQL}, f(form, kind, parse_mode, create_kind, parse_note, parse_error) AS (VALUES {values([(n, f[0].split()[0], *f[1]) for n, f in enumerate(FORMS)])})
  SELECT script_name, ord, kind AS statement_type, parse_mode, create_kind, parse_note, parse_error, CASE WHEN kind = 'DELETE' THEN 'Not parsed: statement type ''DELETE'' is not currently supported.' END AS note FROM p JOIN f ON f.form = p.form""")
def parsed_statements(spark, sf_dir):
    """Routing, fallbacks, DDL and errors by the engine, end to end."""
    parsed = parse(_generated(spark, sf_dir))
    return parsed.select("script_name", F.col("order").cast("long").alias("ord"), "statement_type", "semantic.parse_mode", "semantic.create_kind", "parse_note", F.regexp_extract("parse_error", r"^\w+", 0).alias("parse_error"), F.col("notes")[0].alias("note"))


_GENERATED_EDGES = f"""{_FORM_SQL}, f(form, kind, s, t, classification, note, clause) AS (VALUES {values([(n, {"CREATE": "CREATE/CTAS"}.get(f[0].split()[0], f[0].split()[0]), *e, "WHEN MATCHED UPDATE" if f[0].startswith("MERGE") else None) for n, f in enumerate(FORMS) for e in f[2]])}),
  e AS (SELECT script_name, ord AS statement_order, kind AS statement_type, replace(s, '{{k}}', k::VARCHAR) AS source_column, replace(t, '{{k}}', k::VARCHAR) AS target_column, classification, clause AS merge_clause, CASE WHEN s IS NULL THEN note END AS resolution_note FROM p JOIN f ON f.form = p.form)"""


@query(f"WITH {_GENERATED_EDGES} SELECT * FROM e")
def parsed_edges(spark, sf_dir):
    """Lateral aliases, values, unions, notes, positional and full parsing by the engine, as edges."""
    e = graph.edges(parse(_generated(spark, sf_dir)))
    return e.select("script_name", F.col("statement_order").cast("long").alias("statement_order"), "statement_type", "source_column", "target_column", "classification", "merge_clause", "resolution_note")


@query(f"""WITH {_GENERATED_EDGES} SELECT script_name, statement_order, statement_type, coalesce(split_part(source_column, '.', 1), '') AS source_table, coalesce(split_part(source_column, '.', 2), '') AS source_column_name, coalesce(source_column, '') AS source_column,
  split_part(target_column, '.', 1) AS target_table, split_part(target_column, '.', 2) AS target_column_name, target_column, classification, merge_clause, resolution_note FROM e""")
def edge_csv(spark, sf_dir):
    """The edge table as it is written to CSV and read back."""
    path = fresh_path(spark, "edge-csv")
    rows = graph.edge_table(graph.edges(parse(_generated(spark, sf_dir))))
    rows.drop("resolved_expression").write.option("header", True).option("nullValue", "\\N").csv(path)
    schema = ", ".join(f"{f.name} {'long' if f.name == 'statement_order' else 'string'}" for f in rows.drop("resolved_expression").schema)
    back = spark.read.option("header", True).option("nullValue", "\\N").schema(schema).csv(path)
    return back.fillna("", ["source_table", "source_column_name", "source_column"])  # an empty name is no field


@query(f"WITH {_GENERATED_EDGES} SELECT count(*) AS missing, 0::BIGINT AS dictionary_miss, 0::BIGINT AS ambiguous, count(*) FILTER (contains(resolution_note, 'no external dictionary')) AS no_dictionary, count(*) FILTER (NOT contains(resolution_note, 'no external dictionary')) AS other FROM e WHERE source_column IS NULL AND classification NOT IN ('Constant', 'CONSTANT')")
def parsed_dq(spark, sf_dir):
    """Reasons of missing sources, from parsed statements."""
    return dq.buckets(dq.semantics(parse(_generated(spark, sf_dir))))


@query(f"""WITH {_GENERATED_EDGES}, c AS (SELECT script_name, count(*) FILTER (form IN (0, 1, 2, 4, 5, 6, 7, 8)) AS i, count(*) FILTER (form IN (3, 12)) AS c, count(*) FILTER (form = 13) AS cf, count(*) FILTER (form IN (9, 10)) AS u, count(*) FILTER (form = 11) AS m, count(*) AS n FROM p GROUP BY script_name)
  SELECT count(*) AS scripts_emitted, 0::BIGINT AS scripts_skipped_no_sql, sum(n)::BIGINT AS sql_statements_emitted, sum(i)::BIGINT AS insert_statements_emitted, sum(i)::BIGINT AS insert_parsed_ok, 0::BIGINT AS insert_parse_failures, sum(c + cf)::BIGINT AS create_statements_emitted, sum(c)::BIGINT AS create_parsed_ok, sum(cf)::BIGINT AS create_parse_failures,
  sum(u)::BIGINT AS update_statements_emitted, sum(u)::BIGINT AS update_parsed_ok, 0::BIGINT AS update_parse_failures, sum(m)::BIGINT AS merge_statements_emitted, sum(m)::BIGINT AS merge_parsed_ok, 0::BIGINT AS merge_parse_failures, (SELECT count(*) FROM e WHERE source_column IS NULL AND classification NOT IN ('Constant', 'CONSTANT')) AS dq_missing_base_sources_total FROM c""")
def parsed_rollup(spark, sf_dir):
    """Counters of all scripts and the total of missing sources."""
    scripts = _generated(spark, sf_dir)
    parsed = written(parse(scripts), "parsed")
    return dq.rollup(script_results(scripts, parsed), parsed)


@query(f"""WITH {STATEMENTS_SQL} SELECT s.script_name, count(k.ord) FILTER (k.statement_type = 'INSERT') AS insert_statement_count, count(k.ord) FILTER (k.statement_type = 'UPDATE') AS update_statement_count,
  CASE WHEN count(k.ord) = 0 THEN NULL ELSE count(k.ord) END AS sql_statement_count, count(k.ord) = 0 AS skipped FROM scripts s LEFT JOIN kinds k ON k.script_name = s.script_name GROUP BY s.script_name""")
def script_rollup(spark, sf_dir):
    scripts = _scripts(spark)
    found = script_results(scripts, parse(scripts))
    return found.select("script_name", *(F.coalesce(f"{k}_statement_count", F.lit(0)).alias(f"{k}_statement_count") for k in ("insert", "update")), "sql_statement_count", F.col("_skipped").alias("skipped"))


@query("SELECT * FROM (VALUES ('C', 'T.C'), ('D', 'T.D'), ('E', 'T.E'), ('F', 'T.F'), ('H', 'T.H')) t(short, target_column)")
def dq_missing(spark, sf_dir):
    return dq.missing(_semantics(spark)).select(F.substring("target_column", -1, 1).alias("short"), "target_column")


_MISSING_SQL = f"(SELECT coalesce(n, 'x') AS n FROM (VALUES {values(SEMANTICS)}) s(t, b, c, n) WHERE len(b) = 0 AND c <> 'Constant')"


@query(f"""SELECT count(*) AS missing, count(*) FILTER (contains(n, 'not found in external dictionary')) AS dictionary_miss, count(*) FILTER (contains(n, 'ambiguous')) AS ambiguous,
  count(*) FILTER (contains(n, 'no external dictionary')) AS no_dictionary, count(*) FILTER (NOT contains(n, 'not found in external dictionary') AND NOT contains(n, 'ambiguous') AND NOT contains(n, 'no external dictionary')) AS other FROM {_MISSING_SQL}""")
def dq_buckets(spark, sf_dir):
    return dq.buckets(_semantics(spark))


@query(f"""WITH s AS (SELECT * FROM (VALUES {values(SEMANTICS)}) s(t, b, c, n)) SELECT t AS target_column, unnest(b) AS source_column, c AS classification, NULL::VARCHAR AS resolution_note FROM s WHERE len(b) > 0
  UNION ALL SELECT t, NULL, c, n FROM s WHERE len(b) = 0""")
def edge_explode(spark, sf_dir):
    held = _semantics(spark).groupBy("script_name", "order").agg(F.collect_list(F.struct("target_column", "resolved_expression", "base_sources", "classification", "resolution_note", "merge_clause")).alias("s"))
    parsed = held.select("script_name", "order", F.lit("INSERT").alias("statement_type"), F.struct(F.lit(None).cast("string").alias("create_kind"), F.col("s").alias("column_semantics")).alias("semantic"))
    return graph.edges(parsed).select("target_column", "source_column", "classification", "resolution_note")


# -- graph -----------------------------------------------------------------------------------------------------

EDGES_SQL = """e(source_column, target_column, statement_order, script_name) AS (
  SELECT 'REGION.' || r_regionkey, 'NATION.' || n_nationkey, 1, 'nation.sh' FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'NATION.' || c_nationkey, 'CUSTOMER.' || c_custkey, 2, 'customer.sh' FROM customer
  UNION ALL SELECT 'CUSTOMER.' || o_custkey, 'ORDERS.' || o_orderkey, 3, 'orders.sh' FROM orders
  UNION ALL SELECT 'NATION.' || s_nationkey, 'SUPPLIER.' || s_suppkey, 2, 'supplier.sh' FROM supplier
  UNION ALL SELECT DISTINCT 'SUPPLIER.' || l_suppkey, 'PART.' || l_partkey, 3, 'part.sh' FROM lineitem)"""
ENDS_SQL = "roots AS (SELECT DISTINCT source_column AS node FROM e WHERE source_column NOT IN (SELECT target_column FROM e)), leaves AS (SELECT DISTINCT target_column AS node FROM e WHERE target_column NOT IN (SELECT source_column FROM e))"
WALK_SQL = f"{EDGES_SQL}, {ENDS_SQL}, walk(root, node, hops) AS (SELECT node, node, 0 FROM roots UNION SELECT w.root, e.target_column, w.hops + 1 FROM walk w JOIN e ON e.source_column = w.node), chains AS (SELECT root, node, min(hops) AS hops FROM walk WHERE hops > 0 AND node IN (SELECT node FROM leaves) GROUP BY root, node)"


def data_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region to nation to customer to order, and nation to supplier to part, as column edges."""
    t = lambda n: table(spark, sf_dir, n)

    def link(df: DataFrame, source: str, s: str, target: str, k: str, order: int) -> DataFrame:
        return df.select(F.concat(F.lit(f"{source}."), s).alias("source_column"), F.concat(F.lit(f"{target}."), k).alias("target_column"), F.lit(order).alias("statement_order"), F.lit(f"{target.lower()}.sh").alias("script_name"))

    parts = [
        link(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")), "REGION", "r_regionkey", "NATION", "n_nationkey", 1),
        link(t("customer"), "NATION", "c_nationkey", "CUSTOMER", "c_custkey", 2),
        link(t("orders"), "CUSTOMER", "o_custkey", "ORDERS", "o_orderkey", 3),
        link(t("supplier"), "NATION", "s_nationkey", "SUPPLIER", "s_suppkey", 2),
        link(t("lineitem").select("l_suppkey", "l_partkey").distinct(), "SUPPLIER", "l_suppkey", "PART", "l_partkey", 3),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    null = F.lit(None).cast("string")
    return out.select("source_column", "target_column", "statement_order", F.lit("INSERT").alias("statement_type"), F.col("source_column").alias("resolved_expression"), F.lit("Direct assignment").alias("classification"), "script_name", null.alias("merge_clause"), null.alias("resolution_note"))


@query("SELECT 'SUPPLIER.' || l_suppkey AS source_column, 'PART.' || l_partkey AS target_column, min('o' || (l_linenumber % 3)) AS script_name FROM lineitem GROUP BY 1, 2")
def edge_dedup(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    null = F.lit(None).cast("string")
    e = items.select(
        F.concat(F.lit("SUPPLIER."), "l_suppkey").alias("source_column"), F.concat(F.lit("PART."), "l_partkey").alias("target_column"), F.lit(1).alias("statement_order"), F.lit("INSERT").alias("statement_type"), F.lit("x").alias("resolved_expression"),
        F.lit("Derived").alias("classification"), F.concat(F.lit("o"), F.col("l_linenumber") % 3).alias("script_name"), null.alias("merge_clause"), null.alias("resolution_note"),
    )
    return graph.resolved(e).select("source_column", "target_column", "script_name")


@query(f"WITH {EDGES_SQL}, {ENDS_SQL} SELECT node FROM roots")
def graph_roots(spark, sf_dir):
    return graph.roots(data_edges(spark, sf_dir))


@query(f"WITH {EDGES_SQL}, {ENDS_SQL} SELECT node FROM leaves")
def graph_leaves(spark, sf_dir):
    return graph.leaves(data_edges(spark, sf_dir))


@query(f"WITH RECURSIVE {WALK_SQL} SELECT root AS ultimate_source, node AS ultimate_target, hops FROM chains")
def chains_root_leaf(spark, sf_dir):
    return graph.pairs(data_edges(spark, sf_dir))


@query(f"""WITH RECURSIVE e(s, t) AS (VALUES {values(CYCLE)}), roots AS (SELECT DISTINCT s AS node FROM e WHERE s NOT IN (SELECT t FROM e)), leaves AS (SELECT DISTINCT t AS node FROM e WHERE t NOT IN (SELECT s FROM e)),
  walk(root, node, hops, path) AS (SELECT node, node, 0, [node] FROM roots UNION ALL SELECT w.root, e.t, w.hops + 1, list_append(w.path, e.t) FROM walk w JOIN e ON e.s = w.node WHERE NOT list_contains(w.path, e.t))
  SELECT root AS ultimate_source, node AS ultimate_target, min(hops) AS hops FROM walk WHERE hops > 0 AND node IN (SELECT node FROM leaves) GROUP BY 1, 2""")
def chains_cyclic(spark, sf_dir):
    return graph.pairs(_cycle(spark))


def _cycle(spark: SparkSession) -> DataFrame:
    null = F.lit(None).cast("string")
    rows = spark.createDataFrame(CYCLE, "source_column string, target_column string")
    return rows.select("source_column", "target_column", F.lit(1).alias("statement_order"), F.lit("INSERT").alias("statement_type"), F.col("source_column").alias("resolved_expression"), F.lit("Direct assignment").alias("classification"), F.lit("s.sh").alias("script_name"), null.alias("merge_clause"), null.alias("resolution_note"))


#: Paths of the fewest hops, the first by the names from the leaf back; names in the cyclic graph are single words.
PATHS_SQL = """best AS (SELECT root, node, hops, path FROM walk WHERE hops > 0 AND node IN (SELECT node FROM leaves)
  QUALIFY row_number() OVER (PARTITION BY root, node ORDER BY hops, list_reverse(path)) = 1)
  SELECT root AS ultimate_source, node AS ultimate_target, hops, array_to_string(path, '>') AS path FROM best"""


def _paths(found: DataFrame) -> DataFrame:
    nodes = F.concat(F.array(F.col("path")[0]["source_column"]), F.transform("path", lambda h: h["target_column"]))
    return found.select("ultimate_source", "ultimate_target", "hops", F.array_join(nodes, ">").alias("path"))


@query(f"""WITH RECURSIVE {EDGES_SQL}, {ENDS_SQL}, walk(root, node, hops, path) AS (SELECT node, node, 0, [node] FROM roots UNION ALL SELECT w.root, e.target_column, w.hops + 1, list_append(w.path, e.target_column) FROM walk w JOIN e ON e.source_column = w.node), {PATHS_SQL}""")
def chain_paths(spark, sf_dir):
    return _paths(graph.chains(data_edges(spark, sf_dir)))


@query(f"""WITH RECURSIVE e(s, t) AS (VALUES {values(CYCLE)}), roots AS (SELECT DISTINCT s AS node FROM e WHERE s NOT IN (SELECT t FROM e)), leaves AS (SELECT DISTINCT t AS node FROM e WHERE t NOT IN (SELECT s FROM e)),
  walk(root, node, hops, path) AS (SELECT node, node, 0, [node] FROM roots UNION ALL SELECT w.root, e.t, w.hops + 1, list_append(w.path, e.t) FROM walk w JOIN e ON e.s = w.node WHERE NOT list_contains(w.path, e.t)), {PATHS_SQL}""")
def chain_paths_cyclic(spark, sf_dir):
    return _paths(graph.chains(_cycle(spark)))


@query("""WITH e(s, t) AS (SELECT 'REGION.' || n_regionkey, 'NATION.' || n_nationkey FROM nation UNION ALL SELECT 'NATION.' || c_nationkey, 'CUSTOMER.' || c_custkey FROM customer),
  two AS (SELECT a.s AS u, b.t AS v, a.t AS m FROM e a JOIN e b ON b.s = a.t), one AS (SELECT e.s AS u, e.t AS v FROM e WHERE e.s LIKE 'REGION%' AND e.t NOT IN (SELECT s FROM e))
  SELECT u AS ultimate_source, v AS ultimate_target, 2 AS total_hops, 1 AS hop_number, u AS hop_source_column, m AS hop_target_column, 'NATION' AS hop_target_table FROM two
  UNION ALL SELECT u, v, 2, 2, m, v, 'CUSTOMER' FROM two UNION ALL SELECT u, v, 1, 1, u, v, 'NATION' FROM one""")
def chain_hops(spark, sf_dir):
    e = data_edges(spark, sf_dir).filter("target_column like 'NATION.%' or target_column like 'CUSTOMER.%'")
    return graph.chain_hops(graph.chains(e)).select("ultimate_source", "ultimate_target", "total_hops", "hop_number", "hop_source_column", "hop_target_column", "hop_target_table")


@query(f"WITH {EDGES_SQL} SELECT target_column, string_agg(DISTINCT source_column, ',' ORDER BY source_column) AS direct_sources FROM e GROUP BY target_column")
def direct_sources(spark, sf_dir):
    return graph.direct_sources(data_edges(spark, sf_dir)).select("target_column", F.array_join("direct_sources", ",").alias("direct_sources"))


@query(f"""WITH RECURSIVE {WALK_SQL}, u AS (SELECT node, string_agg(DISTINCT root, ',' ORDER BY root) AS r, count(*) AS n FROM chains GROUP BY node)
  SELECT t.target_column, t.d AS direct_sources, coalesce(u.r, '') AS ultimate_base_sources, coalesce(u.n, 0) AS chains FROM (SELECT target_column, string_agg(DISTINCT source_column, ',' ORDER BY source_column) AS d FROM e GROUP BY 1) t LEFT JOIN u ON u.node = t.target_column""")
def column_lineage(spark, sf_dir):
    e = written(data_edges(spark, sf_dir), "edges")
    found = graph.column_sources(e, graph.pairs(e))
    return found.select("target_column", F.array_join("direct_sources", ",").alias("direct_sources"), F.array_join("ultimate_base_sources", ",").alias("ultimate_base_sources"), "chains")


@query(f"""WITH RECURSIVE {WALK_SQL} SELECT (SELECT count(*) FROM e) AS total_edges, (SELECT count(source_column) FROM e) AS resolved_edges, 0::BIGINT AS unresolved_edges, (SELECT count(DISTINCT target_column) FROM e) AS unique_target_columns,
  (SELECT count(*) FROM chains) AS total_chains, (SELECT coalesce(max(hops), 0) FROM chains) AS max_chain_hops""")
def graph_summary(spark, sf_dir):
    e = written(data_edges(spark, sf_dir), "edges")
    return graph.summary(e, graph.pairs(e))


# -- report ------------------------------------------------------------------------------------------------------

REPORT_SQL = f"{EDGES_SQL}, x AS (SELECT source_column, target_column, 'Direct assignment' AS classification FROM e UNION ALL SELECT NULL, 'TAG.' || r_regionkey, 'Constant' FROM region UNION ALL SELECT NULL, 'HALF.' || n_nationkey, 'Derived' FROM nation)"


def _report_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = data_edges(spark, sf_dir)
    null = F.lit(None).cast("string")

    def lone(name: str, key: str, label: str, kind: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        return rows.select(null.alias("source_column"), F.concat(F.lit(f"{label}."), key).alias("target_column"), F.lit(9).alias("statement_order"), F.lit("INSERT").alias("statement_type"), F.lit("1").alias("resolved_expression"), F.lit(kind).alias("classification"), F.lit("x.sh").alias("script_name"), null.alias("merge_clause"), F.lit("why").alias("resolution_note"))

    return e.union(lone("region", "r_regionkey", "TAG", "Constant")).union(lone("nation", "n_nationkey", "HALF", "Derived"))


@query(f"WITH {REPORT_SQL} SELECT DISTINCT target_column FROM x WHERE target_column NOT IN (SELECT source_column FROM x WHERE source_column IS NOT NULL)")
def final_targets(spark, sf_dir):
    return report.final_targets(_report_edges(spark, sf_dir))


@query(f"WITH {REPORT_SQL} SELECT target_column FROM x GROUP BY target_column HAVING bool_and(source_column IS NULL AND classification = 'Constant')")
def constant_only(spark, sf_dir):
    return report.constant_only(_report_edges(spark, sf_dir))


@query(f"""WITH {REPORT_SQL}, f AS (SELECT target_column, bool_or(source_column IS NOT NULL) AS ok FROM x WHERE target_column NOT IN (SELECT source_column FROM x WHERE source_column IS NOT NULL) GROUP BY 1 HAVING NOT bool_and(source_column IS NULL AND classification = 'Constant'))
  SELECT string_split(target_column, '.')[1] AS "table", count(*) AS columns, count(*) FILTER (ok) AS resolved, count(*) FILTER (NOT ok) AS unresolved FROM f GROUP BY 1""")
def report_table_rollup(spark, sf_dir):
    e = written(_report_edges(spark, sf_dir), "edges")
    return report.by_table(report.states(e, graph.pairs(e)))


@query(f"""WITH RECURSIVE {REPORT_SQL}, {ENDS_SQL}, walk(root, node, hops) AS (SELECT node, node, 0 FROM roots UNION SELECT w.root, e.target_column, w.hops + 1 FROM walk w JOIN e ON e.source_column = w.node),
  n AS (SELECT node, count(*) AS n, min(root) AS first FROM walk WHERE hops > 0 AND node IN (SELECT node FROM leaves) GROUP BY node)
  SELECT target_column, split_part(target_column, '.', 1) AS "table", split_part(target_column, '.', 2) AS "column", CASE WHEN n.n > 0 THEN 'resolved' ELSE 'unresolved' END AS state, coalesce(n.n, 0) AS chains, n.first AS first_source, CASE WHEN n.n IS NULL THEN 'why' END AS reasons, CASE WHEN n.n IS NULL THEN '1' END AS expressions, CASE WHEN n.n IS NULL THEN 'INSERT' END AS statement_types
  FROM (SELECT target_column FROM x WHERE target_column NOT IN (SELECT source_column FROM x WHERE source_column IS NOT NULL) GROUP BY 1 HAVING NOT bool_and(source_column IS NULL AND classification = 'Constant')) t LEFT JOIN n ON n.node = t.target_column""")
def report_columns(spark, sf_dir):
    """What the report says of each final column: its state, chains, reasons, expressions and statements."""
    e = written(_report_edges(spark, sf_dir), "edges")
    found = report.columns(e, graph.column_lineage(e, graph.chains(e)))
    joined = lambda c: F.array_join(c, ";").alias(c)
    return found.select("target_column", "table", "column", "state", F.size("chains").cast("long").alias("chains"), F.array_min(F.transform("chains", lambda c: c["ultimate_source"])).alias("first_source"), joined("reasons"), joined("expressions"), joined("statement_types"))


# -- runtime -----------------------------------------------------------------------------------------------------


@query("SELECT doc_id, md5(text) AS md5, min(doc_id) OVER (PARTITION BY md5(text)) AS kept, doc_id <> min(doc_id) OVER (PARTITION BY md5(text)) AS duplicate FROM documents")
def dedup_content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"))
    return dedup.marked(docs, name="doc_id").select("doc_id", "md5", "kept", "duplicate")


@query("SELECT md5(text) AS md5, min(doc_id) AS kept, count(*) AS copies, count(*) - 1 AS removable FROM documents GROUP BY 1 HAVING count(*) > 1")
def dedup_groups(spark, sf_dir):
    return dedup.groups(table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5")), name="doc_id")


@query("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def incremental_pending(spark, sf_dir):
    return pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query('SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1')
def checkpoint_latest(spark, sf_dir):
    return latest(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "role", "text")


# -- load patterns -------------------------------------------------------------------------------------------------


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_row_number(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return patterns.latest_row(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY 1 = rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC)")
def rank_ties_top(spark, sf_dir):
    return patterns.top_with_ties(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_quantity")


_BY_LINE = ("l_orderkey", "l_linenumber")


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) = 2")
def duplicate_second(spark, sf_dir):
    return patterns.nth_row(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *_BY_LINE), ["l_partkey", "l_suppkey"], [F.col(c) for c in _BY_LINE], 2)


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) > 1")
def duplicate_rest(spark, sf_dir):
    return patterns.later_rows(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *_BY_LINE), ["l_partkey", "l_suppkey"], [F.col(c) for c in _BY_LINE])


@query("""SELECT c_custkey, coalesce(n_name, 'UNK') AS nation, coalesce(r_name, 'UNK') AS region, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'HEAVY' ELSE coalesce(c_mktsegment, 'NA') END AS segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey <> 3 LEFT JOIN region ON n_regionkey = r_regionkey""")
def code_lookup_default(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    one = patterns.code_lookup(c, n, (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("n_nationkey") != 3), "n_name", "nation", F.lit("UNK"))
    two = patterns.code_lookup(one, r, F.col("n_regionkey") == F.col("r_regionkey"), "r_name", "region", F.lit("UNK"))
    segment = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "HEAVY").otherwise(F.coalesce("c_mktsegment", F.lit("NA")))
    return two.select("c_custkey", "nation", "region", segment.alias("segment"))


@query("SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000) o ON o_custkey = c_custkey WHERE o_custkey IS NULL")
def insert_only_anti(spark, sf_dir):
    held = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' and o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return patterns.insert_new(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), held, ["c_custkey"])


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def not_in_subquery(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select("l_partkey")
    return patterns.not_in(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", keys)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_partkey, l_suppkey, l_returnflag) NOT IN (SELECT (l_partkey, l_suppkey, l_returnflag) FROM lineitem WHERE l_discount >= 0.09)")
def tuple_in_delete(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount")
    keys = items.filter("l_discount >= 0.09")
    return patterns.delete_keys(items, keys, ["l_partkey", "l_suppkey", "l_returnflag"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT b.l_orderkey, b.l_linenumber FROM lineitem b WHERE NOT EXISTS (SELECT 1 FROM lineitem a WHERE a.l_orderkey = b.l_orderkey AND (a.l_quantity > b.l_quantity OR a.l_quantity = b.l_quantity AND a.l_linenumber > b.l_linenumber))""")
def theta_delete(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    a, b = items.alias("a"), items.alias("b")
    more = (F.col("a.l_quantity") > F.col("b.l_quantity")) | (F.col("a.l_quantity") == F.col("b.l_quantity")) & (F.col("a.l_linenumber") > F.col("b.l_linenumber"))
    return patterns.delete_where(b, a, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & more).select("l_orderkey", "l_linenumber")


@query("""SELECT e.user_id, e.event_id FROM events e JOIN (SELECT user_id, min(ts) AS first_ts FROM events WHERE event_type = 'purchase' GROUP BY user_id) p ON p.user_id = e.user_id AND e.ts < p.first_ts WHERE e.event_type = 'error'""")
def older_reversal_range(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    first = events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    return events.filter("event_type = 'error'").join(first, "user_id").filter("ts < first_ts").select("user_id", "event_id")


@query("""SELECT a.o_custkey, count(*) AS newer_pairs FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND (a.o_orderdate > b.o_orderdate OR a.o_orderdate = b.o_orderdate AND (a.o_totalprice > b.o_totalprice OR a.o_totalprice = b.o_totalprice AND a.o_orderkey > b.o_orderkey)) GROUP BY a.o_custkey""")
def lexicographic_newer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    return patterns.older(o, ["o_custkey"], ["o_orderdate", "o_totalprice", "o_orderkey"]).groupBy("o_custkey").agg(F.sum("older").alias("newer_pairs")).filter("newer_pairs > 0")


@query("""WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'purchase'), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'error')
  SELECT p.user_id, p.event_id AS purchase_id, r.event_id AS error_id FROM p JOIN r ON p.user_id = r.user_id AND p.rn = r.rn AND p.ts <= r.ts""")
def paired_cancel(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    order = [F.col("ts"), F.col("event_id")]
    p, r = (patterns.numbered(events.filter(F.col("event_type") == k), ["user_id"], order).alias(k) for k in ("purchase", "error"))
    met = p.join(r, (F.col("purchase.user_id") == F.col("error.user_id")) & (F.col("purchase.rn") == F.col("error.rn")) & (F.col("purchase.ts") <= F.col("error.ts")))
    return met.select("purchase.user_id", F.col("purchase.event_id").alias("purchase_id"), F.col("error.event_id").alias("error_id"))


@query("""WITH s AS (SELECT l_orderkey, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_returnflag DESC) = 1)
  SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN l_returnflag ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders LEFT JOIN s ON l_orderkey = o_orderkey""")
def update_from(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_returnflag")
    last = patterns.latest_row(items, ["o_orderkey"], ["l_shipdate", "l_linenumber", "l_returnflag"]).select("o_orderkey", "l_returnflag")
    return patterns.update_from(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), last, ["o_orderkey"], {"o_orderstatus": F.col("s.l_returnflag")})


@query("""WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'), s AS (SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_nationkey < 12)
  SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NULL THEN t.c_name ELSE s.c_name END AS c_name, round(CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END, 2) AS c_acctbal FROM t FULL OUTER JOIN s ON s.c_custkey = t.c_custkey""")
def merge_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    target = c.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")
    source = c.filter("c_nationkey < 12").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return patterns.upsert(target, source, ["c_custkey"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT s_suppkey, 'nation' AS attribute, CAST(s_nationkey AS VARCHAR) AS value FROM supplier UNION ALL SELECT s_suppkey, 'name', s_name FROM supplier UNION ALL SELECT s_suppkey, 'key', CAST(s_suppkey AS VARCHAR) FROM supplier")
def cross_join_unpivot(spark, sf_dir):
    return patterns.unpivot(table(spark, sf_dir, "supplier"), ["s_suppkey"], {"nation": F.col("s_nationkey"), "name": F.col("s_name"), "key": F.col("s_suppkey")})


@query("""WITH u AS (SELECT event_id, 'type' AS attribute, event_type AS value FROM events UNION ALL SELECT event_id, 'user', CAST(user_id % 7 AS VARCHAR) FROM events)
  SELECT attribute, coalesce(n_name, value) AS code, count(*) AS n, count(DISTINCT event_id) AS events FROM u LEFT JOIN nation ON attribute = 'user' AND CAST(n_nationkey AS VARCHAR) = value GROUP BY 1, 2""")
def error_log_rollup(spark, sf_dir):
    rows = patterns.unpivot(table(spark, sf_dir, "events"), ["event_id"], {"type": F.col("event_type"), "user": F.col("user_id") % 7})
    named = patterns.code_lookup(rows, table(spark, sf_dir, "nation"), (F.col("attribute") == "user") & (F.col("n_nationkey").cast("string") == F.col("value")), "n_name", "code", F.col("value"))
    return named.groupBy("attribute", "code").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY event_type")
def audit_count_distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("n"))


@query("SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem GROUP BY 1, 2, 3")
def group_ordinal_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("SELECT l_suppkey, min(l_shipdate) AS first_ship, min(l_quantity) AS least FROM lineitem GROUP BY l_suppkey")
def min_per_group(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first_ship"), F.min("l_quantity").alias("least"))


@query("SELECT p_partkey, substr(p_name, 6, 12) AS part_of_name, '' AS empty_text FROM part")
def substr_projection(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.substring("p_name", 6, 12).alias("part_of_name"), F.lit("").alias("empty_text"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  WHERE l_returnflag IN ('R', 'A') AND NOT (l_linestatus = 'O' AND l_quantity > 10) AND l_shipdate IS NOT NULL GROUP BY 1, 2, 4""")
def multi_key_filter_join(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").filter("l_returnflag in ('R', 'A') and not (l_linestatus = 'O' and l_quantity > 10) and l_shipdate is not null")
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    met = items.join(s, F.col("s_suppkey") == F.col("l_suppkey")).join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    return met.groupBy("l_returnflag", "l_linestatus", "n_name").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey, l_returnflag, n FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_suppkey, l_returnflag) = 1")
def rank_by_own_keys(spark, sf_dir):
    """Grouped before the window; a rank ordered by its partition's keys is 1 for every row and filters nothing."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
