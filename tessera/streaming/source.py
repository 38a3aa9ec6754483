"""Bulk batches as a stream that the manifest drives.

The stream reads the manifest log, not the result files: a batch is read when its
``Completed`` row arrives, however long its files have been there, so a batch
that completes late is not lost.  A batch listed Completed twice is read once
(the stream's state holds one key per batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.bulk import DEFAULT_MAX_CHARS, MANIFEST, read_batches
from tessera.streaming.sink import write_epoch


def stream_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    max_chars: int = DEFAULT_MAX_CHARS,
    newline: str | None = " ",
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the rows of every batch under ``path`` that is or becomes
    Completed to the Parquet table ``out`` (see ``append_stream`` for its
    folders).  ``max_files_per_trigger`` counts manifest files."""
    log = spark.readStream.schema(MANIFEST)
    if max_files_per_trigger:
        log = log.option("maxFilesPerTrigger", str(max_files_per_trigger))
    done = log.parquet(f"{path}/_manifest").where(F.col("state") == F.lit("Completed"))

    def write(batch: DataFrame, epoch: int) -> None:
        # The rows of this micro-batch's manifest name the batches to read.
        rows = read_batches(batch.sparkSession, path, batch, schema, max_chars=max_chars, newline=newline)
        write_epoch(rows, out, checkpoint, epoch)

    writer = done.dropDuplicates(["batch_id", "result"]).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
