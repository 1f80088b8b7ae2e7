"""Ingest with a dead-letter table, and parity with what a stream has consumed."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from leadlake.plans.checks import check_consumed_parity, consumed_files, consumed_offsets
from leadlake.schemas import BRONZE_SCHEMA, MESSAGE_SCHEMA
from leadlake.sources.messages import MessageSource
from leadlake.streaming.deadletter import (read_dead_letters, read_split_bronze, run_split_ingest, split_faults)
from leadlake.streaming.ingest import run_bronze_ingest

DAY = dt.datetime(2024, 1, 5, 23, 0)
GOOD = [b'{"Lead Number": 1}', b' {"a": "\xc3\xa9"}', b"{}"]
BAD = {b"not json": "malformed_json", b'{"a": 1': "malformed_json", b"": "malformed_json", b"  ": "malformed_json",
       b"[1]": "malformed_json", b"7": "malformed_json", b'{"a": "\xff"}': "invalid_utf8", b"\xc3": "invalid_utf8",
       None: "missing_value"}


def messages(spark, values, day=DAY):
    return spark.createDataFrame([(str(k).encode(), v, day + dt.timedelta(hours=k)) for k, v in enumerate(values)], MESSAGE_SCHEMA)


def tables(spark, bronze, dead):
    good = sorted((r["kafka_key"], r["raw_json"], r["ingestion_date"]) for r in read_split_bronze(spark, bronze).collect())
    bad = sorted(((bytes(r["value"]) if r["value"] is not None else None, r["reason"]) for r in read_dead_letters(spark, dead).collect()),
                 key=repr)
    return good, bad


def test_faults(spark):
    values = [*GOOD, *BAD]
    got = {None if r["value"] is None else bytes(r["value"]): r["reason"] for r in split_faults(messages(spark, values)).collect()}
    assert got == {**{v: None for v in GOOD}, **BAD}


def test_good_and_bad_are_all_also_after_a_replayed_batch(spark, tmp_path):
    landing, bronze, dead, ckpt = (str(tmp_path / k) for k in ("landing", "bronze", "dead", "ckpt"))
    source = MessageSource("files", path=landing)
    messages(spark, [*GOOD, *BAD]).write.parquet(landing)
    assert run_split_ingest(spark, source, bronze, dead, ckpt) == len(GOOD) + len(BAD)
    messages(spark, [b'{"z": 1}', b"zz"], dt.datetime(2024, 1, 9)).write.mode("append").parquet(landing)
    assert run_split_ingest(spark, source, bronze, dead, ckpt) == 2
    before = tables(spark, bronze, dead)
    assert [g[1].encode() for g in before[0]] == [*GOOD[:1], b'{"z": 1}', *GOOD[1:]]
    assert before[1] == sorted([*BAD.items(), (b"zz", "malformed_json")], key=repr)
    # The last batch was written, but its commit got lost: it comes again, under the same id.
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    assert run_split_ingest(spark, source, bronze, dead, ckpt) == 2
    assert tables(spark, bronze, dead) == before
    assert run_split_ingest(spark, source, bronze, dead, ckpt) == 0
    assert tables(spark, bronze, dead) == before


def test_backfill_date_and_empty_sides(spark, tmp_path):
    landing, bronze, dead, ckpt = (str(tmp_path / k) for k in ("landing", "bronze", "dead", "ckpt"))
    assert tables(spark, bronze, dead) == ([], [])  # nothing ingested yet
    messages(spark, GOOD).write.parquet(landing)
    with pytest.raises(ValueError):
        run_split_ingest(spark, MessageSource("files", path=landing), bronze, dead, ckpt, "2024-13-01")
    run_split_ingest(spark, MessageSource("files", path=landing), bronze, dead, ckpt, "2024-02-01")
    good, bad = tables(spark, bronze, dead)
    assert {g[2] for g in good} == {dt.date(2024, 2, 1)} and len(good) == 3 and bad == []


def test_pending_messages_are_neither_ok_nor_lost(spark, tmp_path):
    landing, bronze, ckpt = (str(tmp_path / k) for k in ("landing", "bronze", "ckpt"))
    source = MessageSource("files", path=landing)

    def report():
        rows = check_consumed_parity(spark, source, ckpt, bronze, tries=1).collect()
        return {r["ingestion_date"].day: (r["source_rows"], r["pending_rows"], r["bronze_rows"], r["status"], r["missing_rows"])
                for r in rows}

    messages(spark, GOOD, dt.datetime(2024, 1, 5)).write.parquet(landing)
    assert report() == {5: (0, 3, 0, "pending", 0)}  # before the first run
    run_bronze_ingest(spark, source, bronze, ckpt)
    assert report() == {5: (3, 0, 3, "ok", 0)}
    messages(spark, GOOD[:2], dt.datetime(2024, 1, 5)).write.mode("append").parquet(landing)
    messages(spark, GOOD[:1], dt.datetime(2024, 1, 6)).write.mode("append").parquet(landing)
    assert report() == {5: (3, 2, 3, "pending", 0), 6: (0, 1, 0, "pending", 0)}
    # A day that is lost in bronze stays lost, whatever is pending.
    spark.read.parquet(bronze).limit(1).write.parquet(f"{bronze}-damaged")
    lost = check_consumed_parity(spark, source, ckpt, f"{bronze}-damaged", tries=1).where("day(ingestion_date) = 5").first()
    assert (lost["status"], lost["missing_rows"], lost["pending_rows"]) == ("data_loss", 2, 2)
    run_bronze_ingest(spark, source, bronze, ckpt)
    assert report() == {5: (5, 0, 5, "ok", 0), 6: (1, 0, 1, "ok", 0)}


def test_uncommitted_batch_is_not_consumed(spark, tmp_path):
    landing, bronze, ckpt = (str(tmp_path / k) for k in ("landing", "bronze", "ckpt"))
    source = MessageSource("files", path=landing)
    messages(spark, GOOD).coalesce(1).write.parquet(landing)
    run_bronze_ingest(spark, source, bronze, ckpt)
    assert consumed_files(spark, ckpt).count() == 1
    for name in os.listdir(f"{ckpt}/commits"):
        os.remove(f"{ckpt}/commits/{name}")
    assert consumed_files(spark, ckpt).count() == 0


def test_consumed_offsets_of_a_topic(spark, tmp_path):
    ckpt = tmp_path / "ckpt"
    assert consumed_offsets(spark, str(ckpt)).count() == 0
    for name, text in (("offsets/0", {"leads": {"0": 3}}), ("offsets/1", {"leads": {"0": 7, "1": 2}}),
                       ("offsets/2", {"leads": {"0": 99, "1": 99}})):
        (ckpt / name).parent.mkdir(parents=True, exist_ok=True)
        (ckpt / name).write_text("v1\n" + json.dumps({"batchWatermarkMs": 0}) + "\n" + json.dumps(text))
    (ckpt / "commits").mkdir()
    for n in (0, 1):  # batch 2 is planned, not committed
        (ckpt / "commits" / str(n)).write_text("v1\n{}")
    got = {(r["topic"], r["partition"], r["until"]) for r in consumed_offsets(spark, str(ckpt)).collect()}
    assert got == {("leads", 0, 7), ("leads", 1, 2)}


def test_split_bronze_has_the_bronze_schema(spark, tmp_path):
    landing, bronze, dead, ckpt = (str(tmp_path / k) for k in ("landing", "bronze", "dead", "ckpt"))
    messages(spark, GOOD).write.parquet(landing)
    run_split_ingest(spark, MessageSource("files", path=landing), bronze, dead, ckpt)
    assert read_split_bronze(spark, bronze).schema == BRONZE_SCHEMA
    assert read_split_bronze(spark, bronze).where(F.col("ingestion_date") == "2024-01-06").count() == 2
