"""Sinks: CSV / Parquet / managed tables, zone materialisation, schema enforcement."""

from starlane.sinks.files import (
    csv_line,
    declared_schema,
    enforce_schema,
    ensure_database,
    materialise,
    parse_lines,
    read_csv,
    write_csv,
    write_parquet,
    write_table,
)

__all__ = ["csv_line", "declared_schema", "enforce_schema", "ensure_database",
           "materialise", "parse_lines", "read_csv", "write_csv", "write_parquet", "write_table"]
