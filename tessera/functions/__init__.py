"""Column expressions (JVM-side, codegen'd): casts, CSV encoding, type tests."""

from tessera.functions.casting import cast_value, cast_columns, url_encode_fields
from tessera.functions.encode import csv_value, csv_line, csv_header, csv_lines, line_bytes

__all__ = [
    "cast_value",
    "cast_columns",
    "url_encode_fields",
    "csv_value",
    "csv_line",
    "csv_header",
    "csv_lines",
    "line_bytes",
]
