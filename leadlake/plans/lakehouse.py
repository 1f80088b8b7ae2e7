"""End-to-end lakehouse steps over the fixture messages: ingest to bronze,
silver, gold. Written tables go under the shared warehouse folder
(``spark.checkpoint.dir``), never a machine-local path on a cluster."""

from __future__ import annotations

import datetime as dt
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake import fixtures
from leadlake.operators.bronze import transform_to_bronze
from leadlake.operators.silver import build_silver
from leadlake.plans.gold import gold_features
from leadlake.session import warehouse_dir
from leadlake.sinks.lake import write_partitioned
from leadlake.sources.lake import filter_date_window, read_immutable_parquet, trailing_window

LOOKBACK_DAYS = 365

_lock = threading.RLock()
_tables: dict[tuple[str, str, str], str] = {}


def new_table_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder for one written table under the warehouse."""
    return os.path.join(warehouse_dir(spark), kind, uuid.uuid4().hex)


def once(spark: SparkSession, kind: str, sf_dir: str, build) -> str:
    """Write a derived table once per (application, source folder) and return
    its path; ``build(path)`` performs the write."""
    key = (spark.sparkContext.applicationId, kind, sf_dir.rstrip("/"))
    with _lock:
        path = _tables.get(key)
        if path is None:
            path = new_table_path(spark, kind)
            build(path)
            _tables[key] = path
    return path


def message_topic(spark: SparkSession, sf_dir: str) -> str:
    """The message log (``key, value, timestamp`` files) the producer side
    publishes once; every consumer -- batch snapshot, stream, parity --
    reads it. Returns its folder (the file stand-in for a Kafka topic), whose
    files are as bounded as a topic's segments: a stream batch takes whole files."""
    return once(spark, "topic", sf_dir,
                lambda p: fixtures.lead_messages(spark, sf_dir).write.option("maxRecordsPerFile", 500_000).parquet(p))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch snapshot of the whole message log."""
    return read_immutable_parquet(spark, message_topic(spark, sf_dir))


def ensure_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Batch-ingest the message log into a date-partitioned bronze table and
    return its path."""
    def build(path):
        write_partitioned(transform_to_bronze(messages(spark, sf_dir)), path, "ingestion_date")
    return once(spark, "bronze", sf_dir, build)


def damaged_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Bronze with faults that parity and partition checks have to find: on days
    ending in 3 a quarter of the keys is lost, on days ending in 5 it is there
    twice, days ending in 7 are missing."""
    def build(path):
        rows = read_immutable_parquet(spark, ensure_bronze(spark, sf_dir))
        day = F.dayofmonth("ingestion_date") % 10
        some = F.col("kafka_key").cast("bigint") % 4 == 0
        kept = rows.where((day != 7) & ~((day == 3) & some))
        write_partitioned(kept.unionByName(rows.where((day == 5) & some)), path, "ingestion_date")
    return once(spark, "bronze_damaged", sf_dir, build)


def override_bronze(spark: SparkSession, sf_dir: str, date: str) -> str:
    """All messages ingested under one date (a backfill)."""
    return once(spark, f"bronze_{date}", sf_dir, lambda p: write_partitioned(
        transform_to_bronze(messages(spark, sf_dir), date), p, "ingestion_date"))


def tracking(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tracking tables (runs, experiments, metrics), written once like the message log."""
    made = (("tracking_runs", fixtures.tracking_runs), ("tracking_experiments", fixtures.tracking_experiments),
            ("tracking_metrics", fixtures.tracking_metrics))
    return tuple(read_immutable_parquet(spark, once(
        spark, kind, sf_dir, lambda p, make=make: make(spark, sf_dir).write.parquet(p))) for kind, make in made)


def bronze_table(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    # bronze folders are write-once (a fresh folder per application)
    bronze = read_immutable_parquet(spark, ensure_bronze(spark, sf_dir))
    return filter_date_window(bronze, "ingestion_date", start, end)


def run_date(spark: SparkSession, sf_dir: str) -> dt.date:
    """The newest ingestion date of bronze (1970-01-01 if there is none): reads the partition column only."""
    newest = bronze_table(spark, sf_dir).agg(F.max("ingestion_date")).first()[0]
    return newest or dt.date(1970, 1, 1)


def silver(spark: SparkSession, sf_dir: str, end: dt.date | None = None,
           lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The silver relation over the run window, which ends at the newest date."""
    start, end = trailing_window(end or run_date(spark, sf_dir), lookback_days)
    return build_silver(bronze_table(spark, sf_dir), start, end)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once as a parquet table and read back.

    The gold models read silver twice (the rows and the whole-set means);
    reading a written table costs a scan, recomputing silver would repeat the
    JSON parse and the de-duplication shuffle. It also cuts the lineage, so a
    lost executor re-reads files instead of recomputing bronze -> silver.
    """
    path = once(spark, "silver", sf_dir,
                 lambda p: silver(spark, sf_dir).write.mode("errorifexists").parquet(p))
    return read_immutable_parquet(spark, path)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_features(silver_table(spark, sf_dir))


def materialize(spark: SparkSession, df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a parquet table under the warehouse and read it back
    (cuts the lineage; later readers scan files instead of recomputing)."""
    path = new_table_path(spark, kind)
    df.write.parquet(path)
    return spark.read.parquet(path)
