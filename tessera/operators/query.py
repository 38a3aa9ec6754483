"""Query clauses of dataset / object scripts, as DataFrame operators.

``q = group q by (a, b); q = foreach q generate a as a, count() as 'count';
q = limit q n`` becomes ``dataset_query(df, by=[a, b], generate=..., limit=n)``.
There is no query language here: each clause is a DataFrame call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, by: list[str] | str | None, alias: str = "count") -> DataFrame:
    """``group q by (...)`` + ``count()``; ``by="all"`` is the global count."""
    if by in (None, "all") or by == []:
        return df.agg(F.count(F.lit(1)).alias(alias))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))


def generate(df: DataFrame, items: list[tuple[str, Column | str]]) -> DataFrame:
    """``foreach q generate x as 'y', ...``: projection with aliases."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in items])


def limit_rows(df: DataFrame, n: int, order_by: list | None = None) -> DataFrame:
    """``limit q n`` with an order so the answer is stable (a bounded top-n)."""
    order = order_by or df.columns
    return df.orderBy(*order).limit(n)


def dataset_query(
    df: DataFrame,
    by: list[str] | str | None = None,
    generate_items: list[tuple[str, Column | str]] | None = None,
    limit: int | None = None,
    order_by: list | None = None,
    count_alias: str = "count",
) -> DataFrame:
    out = df
    if by is not None:
        out = group_count(out, by, count_alias)
    if generate_items:
        out = generate(out, generate_items)
    if limit is not None:
        out = limit_rows(out, limit, order_by)
    return out


def last_assignment(assignments: list[tuple[str, DataFrame | Callable[[], DataFrame]]], var: str) -> DataFrame:
    """Several loads in one script: the last assignment to ``var`` wins.

    An assignment may be a thunk; only the winning one is built, so a load
    that a later one replaces costs nothing (not even schema inference)."""
    found = None
    for name, frame in assignments:
        if name == var:
            found = frame
    if found is None:
        raise KeyError(f"no assignment to {var!r}")
    return found() if callable(found) else found
