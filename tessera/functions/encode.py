"""CSV text of rows, as the export payloads carry it.

Value rule: null is empty; every ``"`` is doubled; the value is wrapped in
quotes when it holds a quote, a ``\\n`` or a comma (a ``\\r`` or blanks alone
do not quote).  Spark's ``to_csv`` differs on all of those, so the rule is
spelled out as column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _java_timestamp_text(c: Column) -> Column:
    """``java.sql.Timestamp.toString``: fraction without trailing zeros, at least one digit."""
    frac = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def value_text(c: Column | str, dtype: T.DataType | None = None, timestamp_style: str = "spark") -> Column:
    """String form of a value before CSV quoting."""
    c = F.col(c) if isinstance(c, str) else c
    if timestamp_style == "java" and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _java_timestamp_text(c)
    return c.cast("string")


def quote_text(s: Column, quote_cr: bool = False) -> Column:
    """Apply the CSV value rule to a string column.

    ``quote_cr`` also quotes a value holding a ``\r``: the payload rule does
    not, but a CSV reader that splits records on ``\r`` needs it, so files
    this library writes and parses back set it."""
    doubled = F.replace(s, F.lit('"'), F.lit('""'))
    needs = s.contains('"') | s.contains("\n") | s.contains(",")
    if quote_cr:
        needs = needs | s.contains("\r")
    return F.coalesce(F.when(needs, F.concat(F.lit('"'), doubled, F.lit('"'))).otherwise(s), F.lit(""))


def csv_value(c: Column | str, dtype: T.DataType | None = None, timestamp_style: str = "spark",
              quote_cr: bool = False) -> Column:
    return quote_text(value_text(c, dtype, timestamp_style), quote_cr)


def csv_line(df: DataFrame, columns: list[str] | None = None, timestamp_style: str = "spark",
             quote_cr: bool = False) -> Column:
    """One CSV record: encoded values joined by commas."""
    cols = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws(",", *[csv_value(F.col(c), types[c], timestamp_style, quote_cr) for c in cols])


def csv_header(columns: list[str]) -> str:
    """Header line of a column list (names quoted by the value rule when needed)."""
    out = []
    for name in columns:
        if '"' in name or "\n" in name or "," in name:
            name = '"' + name.replace('"', '""') + '"'
        out.append(name)
    return ",".join(out)


def csv_lines(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None,
              timestamp_style: str = "spark", quote_cr: bool = False) -> DataFrame:
    """``line`` per row (plus the ``keep`` columns, e.g. keys for ordering)."""
    keep = keep or []
    return df.select(*[F.col(k) for k in keep], csv_line(df, columns, timestamp_style, quote_cr).alias("line"))


def line_bytes(line: Column | str) -> Column:
    """UTF-8 bytes of a line plus its newline."""
    line = F.col(line) if isinstance(line, str) else line
    return F.octet_length(line) + F.lit(1)
