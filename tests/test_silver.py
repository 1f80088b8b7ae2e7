import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadlake.plans.inspect import plan_text
from leadlake.operators.silver import build_silver, dedup_latest, parse_messages
from leadlake.schemas import SILVER_COLUMNS


def bronze_rows(spark, docs):
    rows = [(str(i), json.dumps(d) if not isinstance(d, str) else d,
             dt.datetime(2024, 1, 1, 0, 0, i), dt.date(2024, 1, 1)) for i, d in enumerate(docs)]
    return spark.createDataFrame(
        rows, "kafka_key string, raw_json string, kafka_timestamp timestamp, ingestion_date date")


def test_json_integer_typing(spark):
    docs = [{"Lead Number": 1234567, "Converted": 5.7, "TotalVisits": 2.5,
             "Total Time Spent on Website": 3.5},
            {"Lead Number": "7654321", "Converted": True, "TotalVisits": False,
             "Total Time Spent on Website": "5", "Page Views Per Visit": "2.25"}]
    rows = parse_messages(bronze_rows(spark, docs)).orderBy("kafka_key").collect()
    assert (rows[0]["lead_number"], rows[0]["converted"], rows[0]["total_visits"],
            rows[0]["total_time_spent_on_website"]) == (1234567, 6, 2, 4)
    assert (rows[1]["lead_number"], rows[1]["converted"], rows[1]["total_visits"],
            rows[1]["total_time_spent_on_website"], rows[1]["page_views_per_visit"]) == \
        (7654321, 1, 0, 5, 2.25)
    assert rows[0]["specialization"] is None


def test_timestamp_with_offset(spark):
    docs = [{"event_time": "2024-01-01T10:00:00.500000+02:00"}]
    row = parse_messages(bronze_rows(spark, docs)).collect()[0]
    assert row["event_time"] == dt.datetime(2024, 1, 1, 8, 0, 0, 500000)


def test_malformed_json_fails_fast(spark):
    with pytest.raises(Exception):
        parse_messages(bronze_rows(spark, ["{not json"])).collect()
    permissive = parse_messages(bronze_rows(spark, ["{not json"]), mode="PERMISSIVE").collect()
    assert permissive[0]["lead_number"] is None


def test_dedup_keeps_latest_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, 5), (1, 2, 1), (1, 2, 3), (2, 1, 1), (2, None, None)],
        "k int, a int, b int")
    out = {r["k"]: (r["a"], r["b"]) for r in dedup_latest(df, "k", ["a", "b"]).collect()}
    assert out == {1: (2, 3), 2: (1, 1)}


def test_silver_filters_and_dedups(spark):
    docs = [
        {"ingestion_time": "2024-01-01T00:00:00+00:00", "Lead Number": 1,
         "Total Time Spent on Website": 10, "TotalVisits": 0, "Country": None},
        {"ingestion_time": "2024-01-02T00:00:00+00:00", "Lead Number": 1,
         "Total Time Spent on Website": 20, "TotalVisits": 4},
        {"ingestion_time": "2024-01-03T00:00:00+00:00", "Lead Number": 1,
         "Total Time Spent on Website": 0, "TotalVisits": 1},
        {"ingestion_time": "2024-01-01T00:00:00+00:00", "Lead Number": 2,
         "Total Time Spent on Website": 7},
    ]
    silver = build_silver(bronze_rows(spark, docs), "2023-01-01", "2024-12-31")
    assert silver.columns == SILVER_COLUMNS
    rows = {r["lead_number"]: r for r in silver.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["total_time_spent_on_website"] == 20  # the t=0 version is dropped first
    assert rows[1]["average_time_per_visit"] == 5.0
    assert rows[2]["average_time_per_visit"] is None  # visits NULL -> no division
    assert rows[2]["total_visits_filled"] == 0 and rows[2]["country_filled"] == "Unknown"


def test_silver_plan_parses_once_and_prunes_partitions(spark, tmp_path):
    docs = [{"Lead Number": i, "Total Time Spent on Website": i + 1} for i in range(4)]
    path = str(tmp_path / "bronze")
    bronze_rows(spark, docs).write.partitionBy("ingestion_date").parquet(path)
    silver = build_silver(spark.read.parquet(path), "2024-01-01", "2024-01-31")
    plan = plan_text(silver)
    assert plan.count("Generate") >= 1
    # one parse: from_json appears only in the Generate node
    assert sum(1 for line in plan.splitlines()
               if "from_json(" in line and not line.startswith("Arguments: inline")) == 0
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert "WindowGroupLimit" in plan
    assert silver.count() == 4
    assert silver.groupBy("lead_number").count().where(F.col("count") > 1).count() == 0


def test_annotate_routes_bad_messages(spark):
    from leadlake.operators.silver import annotate_messages, split_parsed
    docs = [{"Lead Number": 7, "Total Time Spent on Website": 3},
            "{not json",
            {"Lead Number": "abc", "Total Time Spent on Website": 3},
            {"Lead Number": 8, "event_time": "yesterday"}]
    good, bad = split_parsed(annotate_messages(bronze_rows(spark, docs)))
    assert [r["lead_number"] for r in good.collect()] == [7]
    reasons = {r["kafka_key"]: r["parse_error"] for r in bad.collect()}
    assert reasons == {"1": "malformed_json", "2": "bad_value:lead_number",
                       "3": "bad_value:event_time"}
    assert good.columns == parse_messages(bronze_rows(spark, docs[:1])).columns


def test_integer_overflow_is_an_error_not_a_wrap(spark):
    from leadlake.operators.silver import annotate_messages, split_parsed
    docs = [{"Lead Number": 1, "TotalVisits": 3_000_000_000}]
    with pytest.raises(Exception):
        parse_messages(bronze_rows(spark, docs)).collect()
    _, bad = split_parsed(annotate_messages(bronze_rows(spark, docs)))
    assert [r["parse_error"] for r in bad.collect()] == ["bad_value:total_visits"]
