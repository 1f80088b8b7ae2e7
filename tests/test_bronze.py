import datetime as dt

import pytest

from leadlake.functions.timefmt import iso_utc, utc_date, utc_midnight
from leadlake.operators.bronze import transform_to_bronze
from leadlake.schemas import BRONZE_SCHEMA, MESSAGE_SCHEMA

ROWS = [("clé-7".encode(), '{"città": "Łódź"}'.encode(), dt.datetime(2031, 6, 30, 23, 59, 59, 999999)),
        (None, b"", dt.datetime(2031, 7, 1)), (b"k8", None, None)]


def test_text_dates_and_nulls(spark):
    out = transform_to_bronze(spark.createDataFrame(ROWS, MESSAGE_SCHEMA))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    assert [(r.kafka_key, r.raw_json, r.ingestion_date) for r in out.collect()] == [
        ("clé-7", '{"città": "Łódź"}', dt.date(2031, 6, 30)), (None, "", dt.date(2031, 7, 1)), ("k8", None, None)]


@pytest.mark.parametrize("date", ["1999-12-31", dt.date(1999, 12, 31)])
def test_backfill_puts_all_rows_under_one_date(spark, date):
    out = transform_to_bronze(spark.createDataFrame(ROWS, MESSAGE_SCHEMA), date).collect()
    assert {r.ingestion_date for r in out} == {dt.date(1999, 12, 31)} and out[0].kafka_timestamp == ROWS[0][2]


def test_bad_override_is_rejected(spark):
    with pytest.raises(ValueError):
        transform_to_bronze(spark.createDataFrame(ROWS, MESSAGE_SCHEMA), "2025-13-45")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
def test_dates_and_text_are_utc_in_any_session_zone(spark, zone):
    instants = [0, -1, 1_711_846_800_000_001, 1_711_929_599_999_999, -86_400_000_001]  # microseconds
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = spark.createDataFrame([(x,) for x in instants], "us long").selectExpr("us", "timestamp_micros(us) AS ts")
        got = ts.select("us", iso_utc("ts").alias("iso"), utc_date("ts").alias("d"),
                        utc_midnight("ts").cast("long").alias("m")).collect()
        null = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS ts").select(iso_utc("ts").alias("x")).first().x
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for r in got:
        want = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=r.us)
        assert r.iso == want.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00") and r.d == want.date()
        assert r.m == want.replace(hour=0, minute=0, second=0, microsecond=0).timestamp()
    assert null is None


def test_malformed_bytes_go_through(spark):
    """One message that isn't UTF-8 doesn't end the job; the others are as they were."""
    bad = b'{"a": "\xff\xfe\xc3"}'
    out = transform_to_bronze(spark.createDataFrame([(b"\xff", bad, dt.datetime(2031, 7, 1)), *ROWS], MESSAGE_SCHEMA))
    got = out.selectExpr("cast(raw_json AS binary) AS raw", "raw_json").collect()
    assert len(got) == 4 and bytes(got[0].raw) == bad and got[1].raw_json == '{"città": "Łódź"}'
