"""Structured Streaming sinks built from the batch writers.

Each micro-batch is published (or upserted into an object table) through
``foreachBatch``.  A stream is known by its checkpoint: (stream, epoch) is
recorded with the commit, so a micro-batch replayed after a failure is not
written twice, and epochs of another stream, or of a new checkpoint, are other
epochs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.publish import publish


def publish_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    upsert: bool = False,
    unique_ids: list[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish every micro-batch of ``stream`` to the dataset at ``path``."""

    def write(batch: DataFrame, epoch: int) -> None:
        publish(batch, path, mode=mode, upsert=upsert, unique_ids=unique_ids, epoch=int(epoch), stream=checkpoint)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def write_epoch(batch: DataFrame, path: str, checkpoint: str, epoch: int) -> None:
    """Write a micro-batch to ``stream=<digest of the checkpoint>/epoch=<id>``."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    (
        batch.withColumn("stream", F.lit(stream)).withColumn("epoch", F.lit(int(epoch)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream", "epoch")
        .parquet(path)
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every micro-batch to a Parquet table under ``path``, one folder
    per stream and micro-batch.  A micro-batch replayed after a failure
    overwrites its own folder (dynamic partition overwrite), so each epoch lands
    exactly once."""

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, path, checkpoint, epoch)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
