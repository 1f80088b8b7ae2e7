"""Schemas, field maps and the fixed level lists of the lead model."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, DateType, DoubleType, StringType, StructField,
                               StructType, TimestampType)

# Kafka-shaped message rows (the columns the bronze transform reads).
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("timestamp", TimestampType()),
])

BRONZE_SCHEMA = StructType([
    StructField("kafka_key", StringType()),
    StructField("raw_json", StringType()),
    StructField("kafka_timestamp", TimestampType()),
    StructField("ingestion_date", DateType()),
])

# JSON key of the message -> silver column -> type, in the
# order the silver model lists them.
MESSAGE_FIELDS: list[tuple[str, str, str]] = [
    ("event_time", "event_time", "timestamp"),
    ("ingestion_time", "ingestion_time", "timestamp"),
    ("source_system", "source_system", "string"),
    ("Lead Number", "lead_number", "bigint"),
    ("Lead Origin", "lead_origin", "string"),
    ("Lead Source", "lead_source", "string"),
    ("Converted", "converted", "int"),
    ("TotalVisits", "total_visits", "int"),
    ("Total Time Spent on Website", "total_time_spent_on_website", "int"),
    ("Page Views Per Visit", "page_views_per_visit", "double"),
    ("Last Activity", "last_activity", "string"),
    ("Country", "country", "string"),
    ("Specialization", "specialization", "string"),
    ("What is your current occupation", "current_occupation", "string"),
    ("City", "city", "string"),
    ("Tags", "tags", "string"),
    ("Last Notable Activity", "last_notable_activity", "string"),
]

SILVER_COLUMNS = (["kafka_key", "kafka_timestamp", "ingestion_date"]
                  + [c for _, c, _ in MESSAGE_FIELDS]
                  + ["total_visits_filled", "country_filled", "average_time_per_visit"])

# Category levels of the gold models.
TAGS_KEEP = ["Already a student", "Closed by Horizzon", "Interested in other courses",
             "Ringing", "Will revert after reading the email"]
TAGS_OTHER = "Other Tags"
OCCUPATION_KEEP = ["Unemployed", "Working Professional"]
OCCUPATION_OTHER = "Other"
CITY_KEEP = ["Mumbai"]
CITY_OTHER = "Other Cities"
ACTIVITY_KEEP = ["Modified", "SMS Sent"]
ACTIVITY_OTHER = "Other Activity"
UNKNOWN = "Unknown"

# Gold numeric columns, silver name -> model name.
GOLD_NUMERIC = [
    ("total_time_spent_on_website", "Total Time Spent on Website"),
    ("page_views_per_visit", "Page Views Per Visit"),
    ("total_visits", "TotalVisits"),
    ("average_time_per_visit", "Average Time Per Visit"),
]
# Gold dummies as (model name, cleaned column, level); tags are
# tested after bucketing, the others on the trimmed raw text.
GOLD_DUMMIES = [
    ("What is your current occupation_Unemployed", "current_occupation", "Unemployed"),
    ("What is your current occupation_Working Professional", "current_occupation",
     "Working Professional"),
    ("Tags_Closed by Horizzon", "tags_bucket", "Closed by Horizzon"),
    ("Tags_Ringing", "tags_bucket", "Ringing"),
    ("Tags_Will revert after reading the email", "tags_bucket",
     "Will revert after reading the email"),
    ("City_Mumbai", "city", "Mumbai"),
    ("Last Notable Activity_SMS Sent", "last_notable_activity", "SMS Sent"),
]
GOLD_ID = "Lead Number"
GOLD_LABEL = "Converted"
GOLD_FEATURES = [n for _, n in GOLD_NUMERIC] + [n for n, _, _ in GOLD_DUMMIES]

REPORTING_SCHEMA = StructType([
    StructField("run_id", StringType()),  # unique by the upsert, checked by tests
    StructField("run_timestamp", TimestampType()),
    StructField("experiment_name", StringType()),
    StructField("auc", DoubleType()),
    StructField("precision", DoubleType()),
    StructField("recall", DoubleType()),
    StructField("tp", DoubleType()),
    StructField("tn", DoubleType()),
    StructField("fp", DoubleType()),
    StructField("fn", DoubleType()),
    StructField("best_iter", DoubleType()),
    StructField("stopped_iter", DoubleType()),
    StructField("sync_timestamp", TimestampType()),
])

# Reporting column <- tracked metric keys (MAX over all keys).
METRIC_MAP: dict[str, list[str]] = {
    "auc": ["eval-auc", "auc"],
    "precision": ["precision"],
    "recall": ["recall"],
    "tp": ["true_positives"],
    "tn": ["true_negatives"],
    "fp": ["false_positives"],
    "fn": ["false_negatives"],
    "best_iter": ["best_iteration"],
    "stopped_iter": ["stopped_iteration"],
}

# Weights of the example categories (value -> weight).
CITY_WEIGHTS = {"Mumbai": 55, "Thane": 20, "Pune": 15, "Nagpur": 10}
LEAD_ORIGIN_WEIGHTS = {"web": 70, "phone": 25, "import": 5}
CONVERTED_WEIGHTS = {"1": 3, "0": 7}

# Columns under test, by model.
SILVER_NOT_NULL = ["lead_number", "lead_origin", "converted", "total_visits", "total_time_spent_on_website"]
GOLD_NOT_NULL = [GOLD_ID, GOLD_LABEL] + GOLD_FEATURES
INFERENCE_NOT_NULL = [GOLD_ID, "Total Time Spent on Website", "Tags_Ringing"]
GOLD_ACCEPTED = {GOLD_LABEL: [0, 1], **{n: [0, 1] for n, _, _ in GOLD_DUMMIES}}
