"""Operational checks of the lake: ingestion parity, partition validation, export read-back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.literal import literal_rows
from leadlake.functions.timefmt import parse_date, utc_date
from leadlake.operators.quality import parity_report, schema_matches
from leadlake.schemas import BRONZE_SCHEMA
from leadlake.sinks.lake import read_if_there
from leadlake.sources.lake import read_partition, with_retry
from leadlake.sources.messages import MessageSource, read_message_batch

_PARITY = T.StructType([T.StructField("ingestion_date", T.DateType()), T.StructField("source_rows", T.LongType()),
                        T.StructField("bronze_rows", T.LongType()), T.StructField("status", T.StringType()),
                        T.StructField("missing_rows", T.LongType())])

_CONSUMED = T.StructType([T.StructField("ingestion_date", T.DateType())]
                         + [T.StructField(n, T.LongType()) for n in ("source_rows", "pending_rows", "bronze_rows")]
                         + [T.StructField("status", T.StringType()), T.StructField("missing_rows", T.LongType())])


def check_parity(spark: SparkSession, messages: DataFrame, bronze_base: str,
                 ingestion_date: str | dt.date | None = None, scope: str = "per_date",
                 tries: int = 5, wait_seconds: float = 5.0,
                 date_override: str | dt.date | None = None) -> DataFrame:
    """Parity of a message snapshot against bronze.

    Opening and counting bronze are retried together (files written by another
    job may become visible late, or be listed before they can be read). With
    ``date_override``, the date the messages were ingested under, all messages
    belong to that date, and only its folder is compared; with
    ``ingestion_date`` both sides are restricted to that date. The report (a
    row per date) is computed here."""
    override = parse_date(date_override) if date_override else None
    only = override or (parse_date(ingestion_date) if ingestion_date is not None else None)
    source_date = F.lit(override) if override else utc_date("timestamp")
    if override and ingestion_date is not None and parse_date(ingestion_date) != override:
        only, messages = parse_date(ingestion_date), messages.where(F.lit(False))
    elif only is not None:
        messages = messages.where(source_date == F.lit(only))

    def report() -> list:
        bronze = read_partition(spark, bronze_base, only) if only is not None else spark.read.parquet(bronze_base)
        return parity_report(messages, bronze, scope, source_date).select(_PARITY.names).collect()

    rows = with_retry(report, tries=tries, wait_seconds=wait_seconds)
    return literal_rows(spark, _PARITY, [tuple(r) for r in rows])


def _one_spelling(path: Column) -> Column:
    """``file:/a`` and ``file:///a`` are one file."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def consumed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``path`` of the files that committed batches of a stream over files have read, from the source's log.

    The log's entries stand in a file per batch and in compacted ones; a batch counts once its commit is written."""
    committed = read_if_there(lambda: spark.read.text(f"{checkpoint.rstrip('/')}/commits"))
    entries = read_if_there(lambda: spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}"))
    if committed is None or entries is None:
        return spark.range(0).select(F.lit("").alias("path"))
    last = committed.agg(F.max(F.col("_metadata.file_name").try_cast("bigint")).alias("last"))
    log = entries.where(F.col("value").startswith("{")).select(
        F.inline(F.array(F.from_json("value", "path string, batchId bigint"))))
    return log.where(F.col("batchId") <= last.scalar()).select(_one_spelling(F.col("path")).alias("path")).distinct()


def consumed_offsets(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(topic, partition, until): the offsets that committed batches of a stream over a topic have read up to."""
    committed = read_if_there(lambda: spark.read.text(f"{checkpoint.rstrip('/')}/commits"))
    empty = spark.range(0).selectExpr("'' AS topic", "0 AS partition", "id AS until")
    if committed is None:
        return empty
    last = committed.agg(F.max(F.col("_metadata.file_name").try_cast("bigint"))).first()[0]
    if last is None:
        return empty
    # A version line, a line of the batch's metadata, then a line per source.
    lines = [r["value"] for r in spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{last}", wholetext=True).collect()]
    line = lines[0].strip().split("\n")[2 + source]
    found = spark.range(1).select(F.explode(F.from_json(F.lit(line), "map<string,map<string,bigint>>")).alias("topic", "p"))
    return found.select("topic", F.explode("p").alias("partition", "until")).withColumn("partition", F.col("partition").cast("int"))


def _with_consumed(spark: SparkSession, source: MessageSource, checkpoint: str, date) -> DataFrame:
    """(ingestion_date, consumed, n): the snapshot's messages, counted before anything is joined."""
    messages = read_message_batch(spark, source)
    if source.kind == "kafka":
        until = consumed_offsets(spark, checkpoint)  # a row per topic partition
        rows = messages.select("topic", "partition", "offset", date.alias("ingestion_date"))
        rows = rows.join(until, ["topic", "partition"], "left")
        consumed = F.coalesce(F.col("offset") < F.col("until"), F.lit(False))
        return rows.groupBy("ingestion_date", consumed.alias("consumed")).agg(F.count(F.lit(1)).alias("n"))
    per_file = messages.groupBy(_one_spelling(F.col("_metadata.file_path")).alias("path"), date.alias("ingestion_date")).agg(
        F.count(F.lit(1)).alias("n"))
    read = consumed_files(spark, checkpoint).withColumn("consumed", F.lit(True))
    return (per_file.join(read, "path", "left")
            .groupBy("ingestion_date", F.coalesce("consumed", F.lit(False)).alias("consumed")).agg(F.sum("n").alias("n")))


def check_consumed_parity(spark: SparkSession, source: MessageSource, checkpoint: str, bronze_base: str,
                          date_override: str | dt.date | None = None, tries: int = 5, wait_seconds: float = 5.0) -> DataFrame:
    """Parity of bronze with what its stream has consumed, by date, while messages still arrive.

    Messages that no committed batch has read are ``pending_rows``: neither stored nor lost. Status: ``data_loss``
    or ``warning`` where bronze has fewer or more rows than were consumed, else ``pending`` where messages wait,
    else ``ok``."""
    date = F.lit(parse_date(date_override)) if date_override else utc_date("timestamp")

    def report() -> list:
        bronze = read_if_there(lambda: spark.read.schema(BRONZE_SCHEMA).parquet(bronze_base))
        sides = [_with_consumed(spark, source, checkpoint, date).select(
            "ingestion_date", F.when(F.col("consumed"), F.col("n")).alias("s"), F.when(~F.col("consumed"), F.col("n")).alias("p"),
            F.lit(None).cast("long").alias("b"))]
        if bronze is not None:
            sides.append(bronze.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("b")).select(
                "ingestion_date", F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("p"), "b"))
        both = reduce(DataFrame.unionByName, sides).groupBy("ingestion_date").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("s", "p", "b")])
        status = (F.when(F.col("b") < F.col("s"), "data_loss").when(F.col("b") > F.col("s"), "warning")
                  .when(F.col("p") > 0, "pending").otherwise("ok"))
        return both.select("ingestion_date", "s", "p", "b", status, F.greatest(F.col("s") - F.col("b"), F.lit(0))).collect()

    return literal_rows(spark, _CONSUMED, [tuple(r) for r in with_retry(report, tries=tries, wait_seconds=wait_seconds)])


def validate_partition(spark: SparkSession, bronze_base: str, ingestion_date: str | dt.date,
                       expected=BRONZE_SCHEMA) -> dict:
    """Does the date's folder exist, how many files and rows, is the schema
    the bronze schema? One aggregate job over that folder only."""
    part = read_if_there(lambda: read_partition(spark, bronze_base, ingestion_date))
    if part is None:
        return {"exists": False, "n_files": 0, "n_rows": 0, "schema_ok": False}
    stats = part.agg(F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
                     F.count("*").alias("n_rows")).collect()[0]
    return {"exists": True, "n_files": stats["n_files"], "n_rows": stats["n_rows"],
            "schema_ok": schema_matches(part, expected)}


def verify_export(spark: SparkSession, exported: DataFrame, base: str, run_date: str | dt.date,
                  tries: int = 5, wait_seconds: float = 5.0) -> dict:
    """Read an export back and compare its row count with the exported relation's."""
    want = exported.count()
    got = with_retry(lambda: read_partition(spark, base, run_date).count(), tries=tries, wait_seconds=wait_seconds)
    return {"expected_rows": want, "exported_rows": got, "ok": want == got}
