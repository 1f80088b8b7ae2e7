"""Messages -> bronze as a Structured Streaming job.

The same ``transform_to_bronze`` as the batch path runs per micro-batch; the
file sink appends parquet partitioned by ``ingestion_date`` and, together with
the checkpoint (source offsets / seen files), gives exactly-once output across
restarts: a second run over the same messages adds nothing.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadlake.operators.bronze import transform_to_bronze
from leadlake.sources.messages import MessageSource, read_message_stream


def start_bronze_ingest(spark: SparkSession, source: MessageSource, bronze_path: str,
                        checkpoint_path: str,
                        ingestion_date_override: str | dt.date | None = None,
                        available_now: bool = True,
                        processing_time: str | None = None,
                        files_per_date: int = 8) -> StreamingQuery:
    """Start the ingest query. ``available_now`` processes everything present
    at start (in bounded micro-batches) and then stops; otherwise it runs
    continuously with ``processing_time`` triggers.

    Each batch is clustered on (date, salted key) before the write: a date gets
    at most ``files_per_date`` files per batch however many tasks read it, and a
    hot date is written by that many tasks."""
    bronze = transform_to_bronze(read_message_stream(spark, source), ingestion_date_override)
    salt = F.pmod(F.xxhash64("kafka_key", "kafka_timestamp"), F.lit(files_per_date))
    bronze = bronze.repartition("ingestion_date", salt)
    writer = (bronze.writeStream.format("parquet")
              .option("path", bronze_path)
              .option("checkpointLocation", checkpoint_path)
              .partitionBy("ingestion_date")
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_bronze_ingest(spark: SparkSession, source: MessageSource, bronze_path: str,
                      checkpoint_path: str,
                      ingestion_date_override: str | dt.date | None = None,
                      timeout_seconds: float | None = None, poll_seconds: float = 0.1) -> int:
    """Run until caught up, then stop. Returns the rows written by this run."""
    return finish(start_bronze_ingest(spark, source, bronze_path, checkpoint_path, ingestion_date_override,
                                      available_now=True), timeout_seconds, poll_seconds)


def finish(query: StreamingQuery, timeout_seconds: float | None = None, poll_seconds: float = 0.1) -> int:
    """Wait until an available-now query has caught up; the messages it took."""
    # Spark keeps only the latest progress records: they are added up by batch
    # id while the query runs, so a long backlog is counted whole.
    rows: dict[int, int] = {}
    deadline = time.monotonic() + timeout_seconds if timeout_seconds else None
    finished = False
    while not finished:
        finished = query.awaitTermination(poll_seconds)
        for p in query.recentProgress:
            rows[p["batchId"]] = max(rows.get(p["batchId"], 0), int(p["numInputRows"]))
        if not finished and deadline is not None and time.monotonic() > deadline:
            query.stop()
            raise TimeoutError(f"bronze ingest did not finish in {timeout_seconds}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if rows and len(rows) != max(rows) - min(rows) + 1:
        raise RuntimeError("progress records of some batches were missed: the rows are written, their number "
                           "is not known; raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(rows.values())
