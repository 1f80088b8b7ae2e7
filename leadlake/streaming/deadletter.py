"""Messages -> bronze with a dead-letter table, exactly once.

Each micro-batch is looked at message by message: whether its value is there, is UTF-8
and is a JSON object. Good messages become bronze rows; the others go, with their raw
bytes and the reason, to the dead-letter table. Two file sinks can't commit together, so
both are written under the batch's id, into a ``batch_id=<id>`` folder that a replay of
the batch overwrites. Structured Streaming replays a batch with the same messages until
its commit is in the checkpoint, so every message ends up in exactly one table, once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from leadlake.operators.bronze import message_date, transform_to_bronze
from leadlake.schemas import BRONZE_SCHEMA, MESSAGE_SCHEMA
from leadlake.sinks.lake import read_if_there
from leadlake.sources.messages import MessageSource, read_message_stream
from leadlake.streaming.ingest import finish

_BATCH = [T.StructField("batch_id", T.LongType())]
DEAD_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("reason", T.StringType()),
                            T.StructField("ingestion_date", T.DateType())])
_CORRUPT = "_corrupt"


def fault_of(value: Column) -> Column:
    """Why a message can't be a lead record, NULL if it can: ``missing_value``, ``invalid_utf8``, ``malformed_json``."""
    text = value.cast("string")
    parsed = F.from_json(text, f"{_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    broken = parsed.isNull() | parsed[_CORRUPT].isNotNull() | ~F.ltrim(text).startswith("{")
    return (F.when(value.isNull(), "missing_value").when(~F.is_valid_utf8(text), "invalid_utf8")
            .when(broken, "malformed_json"))


def split_faults(messages: DataFrame) -> DataFrame:
    """The messages with ``reason``, NULL for good ones."""
    return messages.select("key", "value", "timestamp", fault_of(F.col("value")).alias("reason"))


def write_batch(batch: DataFrame, batch_id: int, bronze_path: str, dead_path: str,
                partition_date: str | dt.date | None = None, files_per_date: int = 8) -> None:
    """Both sinks of a micro-batch; may be repeated."""
    judged = split_faults(batch).persist()
    salt = F.pmod(F.xxhash64("kafka_key", "kafka_timestamp"), F.lit(files_per_date))
    good = transform_to_bronze(judged.where("reason IS NULL"), partition_date).repartition("ingestion_date", salt)
    bad = judged.where("reason IS NOT NULL").withColumn("ingestion_date", message_date(partition_date))
    try:
        for rows, path in ((good, bronze_path), (bad.hint("rebalance", "ingestion_date"), dead_path)):
            # Static: nothing of an attempt that was lost half-way may stay in the batch's folder.
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("ingestion_date").parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))
    finally:
        judged.unpersist()


def start_split_ingest(spark: SparkSession, source: MessageSource, bronze_path: str, dead_path: str,
                       checkpoint_path: str, ingestion_date_override: str | dt.date | None = None) -> StreamingQuery:
    """Start the ingest of everything present, in bounded micro-batches; it stops by itself."""
    message_date(ingestion_date_override)  # a bad date is an error here, not in the first batch
    return (read_message_stream(spark, source).writeStream
            .foreachBatch(lambda df, n: write_batch(df, n, bronze_path, dead_path, ingestion_date_override))
            .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())


def run_split_ingest(spark: SparkSession, source: MessageSource, bronze_path: str, dead_path: str, checkpoint_path: str,
                     ingestion_date_override: str | dt.date | None = None, timeout_seconds: float | None = None) -> int:
    """Run until caught up. Returns the messages taken by this run, good and bad."""
    return finish(start_split_ingest(spark, source, bronze_path, dead_path, checkpoint_path, ingestion_date_override),
                  timeout_seconds)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = read_if_there(lambda: spark.read.schema(T.StructType(schema.fields + _BATCH)).parquet(path))
    if found is None:
        found = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields + _BATCH])
    return found.select(*schema.names)


def read_split_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The good messages as bronze rows."""
    return _read(spark, path, BRONZE_SCHEMA)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """key, value (raw bytes), timestamp, reason, ingestion_date of the messages set aside."""
    return _read(spark, path, DEAD_SCHEMA)
