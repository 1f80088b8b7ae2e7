"""Rows -> keyed JSON messages, and publishing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode_messages(df: DataFrame, key: str | Column, timestamp: str | Column | None = None,
                    fields: list[str] | None = None, keep_nulls: bool = True) -> DataFrame:
    """Encode each row as a Kafka-shaped message.

    ``key`` = UTF-8 text of the key column, ``value`` = UTF-8 JSON object of
    ``fields`` (all columns but the timestamp by default, in column order),
    ``timestamp`` = the message time when given. ``keep_nulls`` writes
    ``"k":null`` instead of dropping the key.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    ts_name = timestamp if isinstance(timestamp, str) else None
    if fields is None:
        fields = [c for c in df.columns if c != ts_name]
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    cols = [key_col.cast("string").cast("binary").alias("key"),
            F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields]), options)
            .cast("binary").alias("value")]
    if timestamp is not None:
        ts_col = F.col(timestamp) if isinstance(timestamp, str) else timestamp
        cols.append(ts_col.cast("timestamp").alias("timestamp"))
    return df.select(*cols)


# Producer settings of the original publisher: wait for all replicas, retry 8 times.
PRODUCER_DEFAULTS = {"kafka.acks": "all", "kafka.retries": "8"}


def publish_messages(df: DataFrame, topic: str, kafka_options: dict[str, str]) -> None:
    """Write encoded messages to a Kafka topic (needs the Kafka connector on
    the classpath). ``kafka_options`` (at least ``kafka.bootstrap.servers``)
    override ``PRODUCER_DEFAULTS``."""
    writer = df.write.format("kafka").option("topic", topic)
    for k, v in {**PRODUCER_DEFAULTS, **kafka_options}.items():
        writer = writer.option(k, v)
    writer.save()
