import datetime as dt
import os

from leadlake.schemas import MESSAGE_SCHEMA
from leadlake.sources.messages import MessageSource
from leadlake.streaming.ingest import run_bronze_ingest


def write_messages(spark, path, start, n):
    rows = [(str(i).encode(), f'{{"Lead Number": {i}}}'.encode(),
             dt.datetime(2024, 1, 1 + i % 3, 12)) for i in range(start, start + n)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.mode("append").parquet(path)


def test_available_now_restart_and_backfill(spark, tmp_path):
    landing, bronze, ckpt = (str(tmp_path / n) for n in ("landing", "bronze", "ckpt"))
    src = MessageSource("files", path=landing)
    write_messages(spark, landing, 0, 30)
    assert run_bronze_ingest(spark, src, bronze, ckpt, timeout_seconds=120) == 30
    # run-until-caught-up twice over the same messages: nothing is added
    assert run_bronze_ingest(spark, src, bronze, ckpt, timeout_seconds=120) == 0
    assert spark.read.parquet(bronze).count() == 30
    parts = sorted(p for p in os.listdir(bronze) if p.startswith("ingestion_date="))
    assert parts == ["ingestion_date=2024-01-01", "ingestion_date=2024-01-02",
                     "ingestion_date=2024-01-03"]
    # new messages arrive: only they are ingested, routed to a backfill date
    write_messages(spark, landing, 100, 5)
    assert run_bronze_ingest(spark, src, bronze, ckpt, ingestion_date_override="2023-12-31",
                             timeout_seconds=120) == 5
    out = spark.read.parquet(bronze)
    assert out.count() == 35
    assert out.where("ingestion_date = DATE'2023-12-31'").count() == 5


def test_available_now_respects_batch_bound(spark, tmp_path):
    from leadlake.streaming.ingest import start_bronze_ingest
    landing, bronze, ckpt = (str(tmp_path / n) for n in ("landing", "bronze", "ckpt"))
    for start in (0, 10, 20):  # three appends = at least three files
        write_messages(spark, landing, start, 10)
    src = MessageSource("files", path=landing, max_files_per_trigger=1)
    query = start_bronze_ingest(spark, src, bronze, ckpt)
    query.awaitTermination(120)
    batches = [p for p in query.recentProgress if int(p.get("numInputRows", 0)) > 0]
    assert len(batches) >= 3
    assert sum(int(p["numInputRows"]) for p in batches) == 30
    assert spark.read.parquet(bronze).count() == 30


def test_rows_of_a_long_backlog_are_counted_whole(spark, tmp_path):
    landing, bronze, ckpt = (str(tmp_path / n) for n in ("landing", "bronze", "ckpt"))
    for start in range(0, 12, 2):
        write_messages(spark, landing, start, 2)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        src = MessageSource("files", path=landing, max_files_per_trigger=1)
        assert run_bronze_ingest(spark, src, bronze, ckpt, timeout_seconds=180, poll_seconds=0.05) == 12
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_many_input_files_make_few_files_per_date(spark, tmp_path):
    from leadlake.streaming.ingest import start_bronze_ingest
    landing, bronze, ckpt = (str(tmp_path / n) for n in ("landing", "bronze", "ckpt"))
    for start in range(0, 120, 12):
        write_messages(spark, landing, start, 12)
    query = start_bronze_ingest(spark, MessageSource("files", path=landing), bronze, ckpt, files_per_date=2)
    query.awaitTermination(120)
    for date in ("2024-01-01", "2024-01-02", "2024-01-03"):
        files = [f for f in os.listdir(f"{bronze}/ingestion_date={date}") if f.endswith(".parquet")]
        assert len(files) <= 2
    assert spark.read.parquet(bronze).count() == 120


def test_a_backlog_is_taken_in_batches_of_bounded_bytes(spark, tmp_path):
    from leadlake.streaming.ingest import start_bronze_ingest
    landing, bronze, ckpt = (str(tmp_path / n) for n in ("landing", "bronze", "ckpt"))
    for start in (0, 10, 20):
        write_messages(spark, landing, start, 10)
    src = MessageSource("files", path=landing, max_bytes_per_trigger=1)  # at least one file a batch
    query = start_bronze_ingest(spark, src, bronze, ckpt, "2023-12-31")
    query.awaitTermination(120)
    batches = [int(p["numInputRows"]) for p in query.recentProgress if int(p["numInputRows"])]
    assert len(batches) >= 3 and max(batches) <= 10 and sum(batches) == 30
    assert spark.read.parquet(bronze).count() == 30
    assert 0 < MessageSource("files", path=landing).max_bytes_per_trigger < 1 << 30
