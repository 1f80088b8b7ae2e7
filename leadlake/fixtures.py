"""Deterministic lead messages and tracking tables derived from the test
tables (``events`` -> messages ``M``; ``orders``/``customer``/``lineitem`` ->
tracking tables ``T``). Both the Spark queries and their SQL oracles start
from these derivations, so every query's work grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.timefmt import iso_utc, utc_midnight
from leadlake.sinks.messages import encode_messages
from leadlake.sources.lake import read_immutable_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_immutable_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index, values):
    """CASE index WHEN 0 THEN values[0] ... (None -> NULL)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string") if v is None else F.lit(v)
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


# The category cycles of the message fixture.
OCCUPATION_CYCLE = ["Unemployed", "Working Professional", "Student", "  ", None,
                    " Unemployed ", "Unemployed"]
TAGS_CYCLE = ["Already a student", "Closed by Horizzon", "Interested in other courses",
              "Ringing", "Will revert after reading the email", "Busy", "", None,
              "Ringing", "Ringing", "Ringing"]
CITY_CYCLE = ["Mumbai", " Mumbai ", "Select"]


def lead_records(events: DataFrame) -> DataFrame:
    """One CRM lead record per event, with the message's field names."""
    eid = F.col("event_id")
    lead = F.lit(1000000) + F.col("user_id") * 20 + eid % 20
    ts = F.col("ts").cast("timestamp")
    activity = (F.when(eid % 19 == 0, F.lit("Modified"))
                .when(eid % 19 == 1, F.lit(None).cast("string"))
                .when(eid % 19 == 2, F.lit("Email Opened"))
                .otherwise(F.lit("SMS Sent")))
    return events.select(
        iso_utc(ts).alias("event_time"),
        iso_utc(utc_midnight(ts)).alias("ingestion_time"),
        F.lit("crm_leads_v1").alias("source_system"),
        F.lit("v1").alias("schema_version"),
        lead.alias("Lead Number"),
        F.col("event_type").alias("Lead Origin"),
        F.col("event_type").alias("Lead Source"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("Converted"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(eid % 9).cast("int").alias("TotalVisits"),
        F.floor(F.col("value") * 10).cast("int").alias("Total Time Spent on Website"),
        F.when(eid % 13 == 0, F.lit(None))
         .otherwise((eid % 40).cast("double") / 4).cast("double").alias("Page Views Per Visit"),
        F.col("event_type").alias("Last Activity"),
        F.when(eid % 10 == 0, F.lit(None).cast("string")).otherwise(F.lit("India")).alias("Country"),
        _pick(eid % 7, OCCUPATION_CYCLE).alias("What is your current occupation"),
        _pick(eid % 3, CITY_CYCLE).alias("City"),
        _pick(eid % 11, TAGS_CYCLE).alias("Tags"),
        activity.alias("Last Notable Activity"),
        ts.alias("_ts"),
    )


def lead_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture M: Kafka-shaped ``key, value, timestamp`` rows."""
    records = lead_records(table(spark, sf_dir, "events"))
    return encode_messages(records, key="Lead Number", timestamp="_ts")


def tracking_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_uuid"),
        F.col("o_custkey").alias("experiment_id"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + 123).alias("start_time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "deleted").otherwise("active")
         .alias("lifecycle_stage"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"),
    )


def tracking_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments; every third one was logged by two runs and is there twice."""
    c = table(spark, sf_dir, "customer")
    names = c.select(F.col("c_custkey").alias("experiment_id"), F.col("c_name").alias("name"))
    return names.unionByName(names.where(F.col("experiment_id") % 3 == 0))


def tracking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value metric rows per run, unpivoted from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    q = F.col("l_quantity")
    zero = F.col("l_orderkey") % 20 == 0

    def metric(cond, key, value):
        return F.when(cond, F.struct(F.lit(key).alias("key"), value.cast("double").alias("value")))

    candidates = F.array(
        metric(ln == 1, "auc", 0.5 + F.col("l_discount")),
        metric(ln == 2, "eval-auc", 0.5 + F.col("l_discount")),
        metric(ln >= 3, "precision", F.when(zero, F.lit(0.0)).otherwise(F.col("l_discount"))),
        metric(ln >= 3, "recall", F.when(zero, F.lit(0.0)).otherwise(F.col("l_tax"))),
        metric(ln >= 5, "true_positives", q),
        metric(ln >= 5, "true_negatives", q + 1),
        metric(ln >= 5, "false_positives", q % 7),
        metric(ln >= 5, "false_negatives", q % 5),
        metric(ln == 7, "best_iteration", q),
        metric(ln == 7, "stopped_iteration", q + 10),
    )
    # explode + where stays in generated code (a filter lambda would not).
    return (li.select(F.col("l_orderkey").cast("string").alias("run_uuid"),
                      F.explode(candidates).alias("m"))
              .where(F.col("m").isNotNull())
              .select("run_uuid", "m.key", "m.value"))


def faulty(messages: DataFrame) -> DataFrame:
    """The message log with faults by key: cut short, a byte that isn't UTF-8, no value, an empty one."""
    n, value = F.col("key").cast("string").cast("bigint") % 23, F.col("value")
    return messages.withColumn("value", F.when(n == 3, F.substring(value, F.lit(1), F.length(value) - 5))
                               .when(n == 5, F.concat(value, F.unhex(F.lit("FF"))))
                               .when(n == 7, F.lit(None).cast("binary"))
                               .when(n == 11, F.lit("").cast("binary")).otherwise(value))
