"""Streaming ingest of the message log into bronze, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.fixtures import faulty
from leadlake.plans import lakehouse as lh
from leadlake.plans.checks import check_consumed_parity
from leadlake.sources.messages import MessageSource
from leadlake.streaming.deadletter import read_dead_letters, read_split_bronze, run_split_ingest
from leadlake.streaming.ingest import run_bronze_ingest


def ingest_in_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages arrive, are ingested, then the rest arrives and a
    second run with the same checkpoint takes only that."""
    landing, bronze, checkpoint = (lh.new_table_path(spark, k) for k in ("landing", "bronze_stream", "checkpoints"))
    messages = lh.messages(spark, sf_dir)
    first = F.xxhash64("key", "timestamp") % 2 == 0
    for part in (first, ~first):
        messages.where(part).write.mode("append").parquet(landing)
        run_bronze_ingest(spark, MessageSource("files", path=landing), bronze, checkpoint)
    return spark.read.parquet(bronze)


def ingest_with_dead_letters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(bronze, dead letters) of a log with faulty messages that arrives in two parts, taken by two runs."""
    landing, bronze, dead, checkpoint = (lh.new_table_path(spark, k) for k in (
        "landing", "bronze_split", "dead_letters", "checkpoints"))
    messages = faulty(lh.messages(spark, sf_dir))
    first = F.xxhash64("key", "timestamp") % 2 == 0
    for part in (first, ~first):
        messages.where(part).write.mode("append").parquet(landing)
        run_split_ingest(spark, MessageSource("files", path=landing), bronze, dead, checkpoint)
    return read_split_bronze(spark, bronze), read_dead_letters(spark, dead)


def parity_while_messages_arrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even keys have been ingested; odd keys arrived since and are not consumed yet."""
    landing, bronze, checkpoint = (lh.new_table_path(spark, k) for k in ("landing", "bronze_stream", "checkpoints"))
    source, messages = MessageSource("files", path=landing), lh.messages(spark, sf_dir)
    even = F.col("key").cast("string").cast("bigint") % 2 == 0
    messages.where(even).write.mode("append").parquet(landing)
    run_bronze_ingest(spark, source, bronze, checkpoint)
    messages.where(~even & (F.dayofmonth("timestamp") % 3 != 0)).write.mode("append").parquet(landing)
    return check_consumed_parity(spark, source, checkpoint, bronze)


def ingest_fixture_stream(spark: SparkSession, sf_dir: str,
                          ingestion_date_override: str | None = None) -> DataFrame:
    """Stream the message log into a fresh bronze folder (available-now, with
    its own checkpoint) and read the result back."""
    landing = lh.message_topic(spark, sf_dir)
    bronze = lh.new_table_path(spark, "bronze_stream")
    checkpoint = lh.new_table_path(spark, "checkpoints")
    run_bronze_ingest(spark, MessageSource("files", path=landing), bronze, checkpoint,
                      ingestion_date_override)
    return spark.read.parquet(bronze)
