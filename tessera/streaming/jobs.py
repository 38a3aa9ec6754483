"""Job states as a stream: the last state wins, and waiting ends by an event-time timer.

Each job keeps one state: its last status with the time of it, and the time of its
first row.  A row that is older than the last one changes nothing but the first time.
A job's outcome comes out when its status becomes final, again if a later row changes
it, and as ``timed_out`` when the watermark passes ``timeout`` after its first row
while it is pending; then its state is dropped (a row that comes later begins anew).
Rows later than the watermark are dropped by Spark.

Spark has no built-in operator with timers, so this is ``applyInPandasWithState``;
a job's rows of a micro-batch come in Arrow batches and only three values are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.jobs import FAILURE_STATES, PENDING_STATES

OUTPUT = "job_id long, status string, since timestamp, last_at timestamp, outcome string"
_STATE = "status string, last_us long, since_us long"


def _outcome(status: str) -> str:
    return "failure" if status in FAILURE_STATES else "pending" if status in PENDING_STATES else "success"


def job_outcome_stream(log: DataFrame, timeout_seconds: int, watermark: str, job_col: str = "job_id", status_col: str = "status", at_col: str = "at") -> DataFrame:
    """Outcomes of the jobs of a streamed log, as they become known (update mode)."""
    wait = timeout_seconds * 1_000_000

    def row(job: tuple, status: str, since: int, last: int, outcome: str) -> pd.DataFrame:
        at = pd.to_datetime([since, last], unit="us")
        return pd.DataFrame({"job_id": [job[0]], "status": [status], "since": [at[0]], "last_at": [at[1]], "outcome": [outcome]})

    def advance(job: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            status, last, since = state.get
            state.remove()
            if _outcome(status) == "pending":
                yield row(job, status, since, last, "timed_out")
            return
        before = status, last, since = state.get if state.exists else (None, None, None)
        for batch in batches:
            times = batch["at"].astype("datetime64[us]").astype("int64")
            k = max(range(len(batch)), key=lambda i: (times.iloc[i], batch["status"].iloc[i]))  # noqa: B023
            if last is None or (times.iloc[k], batch["status"].iloc[k]) > (last, status):
                status, last = batch["status"].iloc[k], int(times.iloc[k])
            since = int(times.min()) if since is None else min(since, int(times.min()))
        state.update((status, last, since))
        if before[0] != status and _outcome(status) != "pending":
            yield row(job, status, since, last, _outcome(status))
        # A final state is forgotten as soon as no older row can come.
        ends = since + wait if _outcome(status) == "pending" else last
        state.setTimeoutTimestamp(max(ends // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    rows = log.select(F.col(job_col).cast("long").alias("job_id"), F.col(status_col).alias("status"), F.col(at_col).cast("timestamp").alias("at")).withWatermark("at", watermark)
    return rows.groupBy("job_id").applyInPandasWithState(advance, OUTPUT, _STATE, "update", GroupStateTimeout.EventTimeTimeout)
