"""tessera: string-shaped business exports <-> typed Spark tables.

Every operator is a function from DataFrames to a DataFrame built from
Spark column expressions, joins, aggregates and shuffles, so the work runs
on executors and Catalyst keeps pushdown, pruning and codegen.
"""

from tessera.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
