"""Messages -> bronze rows (the same function serves batch and streaming)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.timefmt import parse_date, utc_date


def message_date(partition_date: str | dt.date | None = None) -> Column:
    """The UTC date of a message or, in a backfill, ``partition_date`` (checked here)."""
    return F.lit(parse_date(partition_date)) if partition_date else utc_date("timestamp")


def transform_to_bronze(messages: DataFrame, partition_date: str | dt.date | None = None) -> DataFrame:
    """Keyed messages (``key``, ``value``, ``timestamp``) as bronze rows.

    Key and value become text by a plain cast, which lets bytes through that are
    not UTF-8 (a decode would end the job on them); ``streaming.deadletter`` sets
    such messages aside. Rows belong to the UTC date of their message or, in a
    backfill, all to ``partition_date`` (checked here, before anything runs)."""
    date = message_date(partition_date)
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
        date.alias("ingestion_date"))
