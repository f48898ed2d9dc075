"""Streaming ingest: new files once, drained and stopped, into a keyed table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.stages import Warehouse, ingest_batch
from ledgerloom.session import few_listing_tasks
from ledgerloom.sources.files import stream_files


def drain(stream: DataFrame, sink: Callable[[DataFrame, str], object], checkpoint: str) -> StreamingQuery:
    """Process everything available in micro-batches, then stop; restarts resume at the checkpoint.

    `sink` gets each batch with its name: the checkpoint's id and the batch's number, the same whenever
    the batch is delivered. It may see a batch again after a failure and has to be idempotent.
    """
    checkpoint_id: Future[str] = Future()

    def named(batch: DataFrame, number: int) -> None:
        sink(batch, f"{checkpoint_id.result(timeout=600)}-{number}")

    # a query keeps the settings that hold when it starts
    with few_listing_tasks(stream.sparkSession):
        query = (
            stream.writeStream.foreachBatch(named)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        checkpoint_id.set_result(query.id)
        query.awaitTermination()
    return query


def ingest_directory(
    warehouse: Warehouse,
    directory: str,
    checkpoint: str,
    run_id: str,
    glob: str = "*.json",
    per_batch: int = 1000,
    batch_bytes: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Stream document files of a directory into bronze and the log (see `stream_files`)."""
    stream = stream_files(warehouse.spark, directory, glob, per_batch, batch_bytes, archive)
    return drain(stream, lambda batch, name: ingest_batch(warehouse, batch, run_id, name), checkpoint)
