"""Schemas, all declared, none inferred."""

SEMANTIC = "target_column string, resolved_expression string, base_sources array<string>, classification string, resolution_note string, merge_clause string"
RECORD = (
    "parse_mode string, statement_type string, create_kind string, "
    "target struct<table: string, columns: array<string>, column_definitions: array<struct<column: string, data_type: string>>>, "
    "source_scope struct<base_tables: array<string>, aliases: map<string, string>>, "
    f"column_semantics array<struct<{SEMANTIC.replace(' ', ': ').replace(',:', ',')}>>, notes array<string>"
)
HOP = "struct<hop: int, source_column: string, target_column: string, statement_order: int, statement_type: string, resolved_expression: string, classification: string, script_name: string>"
EDGE = (
    "source_column string, target_column string, statement_order int, statement_type string, resolved_expression string, classification string, "
    "script_name string, merge_clause string, resolution_note string"
)
CHAIN = f"ultimate_source string, ultimate_target string, hops int, path array<{HOP}>"
