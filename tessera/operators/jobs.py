"""Job states as data: outcome per wanted job, over time, and the rollup.

A remote job's status decides whether a write succeeded.  Instead of polling
in a driver loop, statuses are a table and the decision is a join plus an
aggregate.  Where a job has several rows, a log of its states, the last one wins,
and a job that is still pending ``timeout`` after its first row has timed out: as
one aggregate over the log (``job_states``), or as a stream that keeps a state per
open job and lets an event-time timer end the wait (``streaming/jobs.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Job states and what they mean for the write.
SUCCESS_STATES = ("Completed", "CompletedWithWarnings", "NotProcessed")
FAILURE_STATES = ("Failed",)
PENDING_STATES = ("New", "Queued", "InProgress")


def outcome_of(status) -> F.Column:
    """success / failure / pending; an unknown state counts as success."""
    s = F.col(status) if isinstance(status, str) else status
    return (
        F.when(s.isin(*FAILURE_STATES), F.lit("failure"))
        .when(s.isin(*PENDING_STATES), F.lit("pending"))
        .otherwise(F.lit("success"))
    )


def job_outcomes(jobs: DataFrame, wanted: DataFrame, job_col: str = "job_id", status_col: str = "status") -> DataFrame:
    """Per wanted job: its status (``missing`` when the job is not found,
    which counts as success) and outcome."""
    # One row per job: of several states without an order the largest name, so that no job counts twice.
    found = jobs.groupBy(job_col).agg(F.max(status_col).alias("_status"))
    joined = wanted.select(job_col).join(found, job_col, "left")
    status = F.coalesce(F.col("_status"), F.lit("missing"))
    return joined.select(job_col, status.alias("status"), outcome_of(status).alias("outcome"))


def job_states(log: DataFrame, as_of: Column | str, timeout: str, job_col: str = "job_id", status_col: str = "status",
               at_col: str = "at", order_by: list[str] | None = None) -> DataFrame:
    """Per job of a log of states: ``(job, status, since, last_at, outcome)``.

    The last row wins (by ``at_col``, then ``order_by``, then the status name).  A job
    whose last state is pending has ``timed_out`` if its first row is more than
    ``timeout`` (an interval, ``"2 hours"``) before ``as_of``.  One aggregate with
    partial sums, so a job with a long log is combined map-side."""
    order = F.struct(F.col(at_col), *[F.col(c) for c in order_by or []], F.col(status_col))
    per = log.groupBy(job_col).agg(F.max_by(status_col, order).alias("status"), F.min(at_col).alias("since"), F.max(at_col).alias("last_at"))
    now = F.lit(as_of) if isinstance(as_of, str) else as_of
    late = F.col("since") + F.expr(f"INTERVAL {timeout}") < now.cast("timestamp_ntz").cast(log.schema[at_col].dataType)
    outcome = outcome_of("status")
    return per.select(job_col, "status", "since", "last_at", F.when((outcome == F.lit("pending")) & late, F.lit("timed_out")).otherwise(outcome).alias("outcome"))


def outcome_rollup(outcomes: DataFrame) -> DataFrame:
    """Count of jobs per (outcome, status)."""
    return outcomes.groupBy("outcome", "status").agg(F.count(F.lit(1)).alias("jobs"))


def all_succeeded(outcomes: DataFrame) -> DataFrame:
    """One row: true when every job succeeded (the AND of all acknowledgements)."""
    return outcomes.agg(F.coalesce(F.bool_and(F.col("outcome") == F.lit("success")), F.lit(True)).alias("ok"))
