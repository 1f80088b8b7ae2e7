import datetime as dt

import pytest

from leadlake.operators import quality
from leadlake.sources.lake import with_retry


def as_dict(df):
    return {(r["model"], r["test"], r["column_name"]): (r["failing_rows"], r["passed"])
            for r in df.collect()}


def test_not_null_unique_accepted(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 2, None), (None, 3, "b"), (4, None, "b")],
                               "id int, flag int, `a name` string")
    nn = as_dict(quality.not_null_report(df, "m", ["id", "flag", "a name"]))
    assert nn == {("m", "not_null", "id"): (1, False), ("m", "not_null", "flag"): (1, False),
                  ("m", "not_null", "a name"): (1, False)}
    uq = as_dict(quality.unique_report(df, "m", ["id", "a name"]))
    assert uq == {("m", "unique", "id"): (1, False), ("m", "unique", "a name"): (1, False)}
    av = as_dict(quality.accepted_values_report(df, "m", {"flag": [0, 1]}))
    assert av == {("m", "accepted_values", "flag"): (2, False)}  # 2 and 3; NULL passes


def test_parity_statuses(spark):
    src = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 12),) for d in (1, 1, 2, 3)], "timestamp timestamp")
    brz = spark.createDataFrame(
        [(dt.date(2024, 1, d),) for d in (1, 1, 2, 2, 4)], "ingestion_date date")
    rep = {str(r["ingestion_date"]): (r["source_rows"], r["bronze_rows"], r["status"],
                                      r["missing_rows"])
           for r in quality.parity_report(src, brz).collect()}
    assert rep == {"2024-01-01": (2, 2, "ok", 0), "2024-01-02": (1, 2, "warning", 0),
                   "2024-01-03": (1, 0, "data_loss", 1), "2024-01-04": (0, 1, "warning", 0)}
    whole = quality.parity_report(src, brz, scope="whole_topic").collect()[0]
    assert (whole["source_rows"], whole["bronze_rows"], whole["status"]) == (4, 5, "warning")
    with pytest.raises(ValueError):
        quality.parity_report(src, brz, scope="nope")


def test_partition_report_and_relation_check(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)),
                                (3, dt.date(2024, 1, 2))], "x int, ingestion_date date")
    path = str(tmp_path / "t")
    df.write.partitionBy("ingestion_date").parquet(path)
    rep = {str(r["ingestion_date"]): (r["n_rows"], r["n_files"] >= 1, r["partition_exists"])
           for r in quality.partition_report(spark.read.parquet(path)).collect()}
    assert rep == {"2024-01-01": (2, True, True), "2024-01-02": (1, True, True)}
    chk = quality.relation_check(spark.read.parquet(path), ["x"], n=2)
    assert chk["count"] == 3 and [r["x"] for r in chk["sample"]] == [1, 2]


def test_row_counts(spark):
    a = spark.range(3)
    b = spark.range(5)
    rows = {r["table"]: r["n"] for r in quality.row_count_report({"a": a, "b": b}).collect()}
    assert rows == {"a": 3, "b": 5}


def test_retry_until_visible():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return 42

    assert with_retry(flaky, tries=5, wait_seconds=5, sleep=waits.append) == 42
    assert waits == [5, 5]
    with pytest.raises(OSError):
        with_retry(lambda: (_ for _ in ()).throw(OSError("never")), tries=2, sleep=lambda s: None)


def test_check_parity_and_validate_partition(spark, tmp_path):
    from leadlake.plans.checks import check_parity, validate_partition
    from leadlake.schemas import MESSAGE_SCHEMA
    from leadlake.operators.bronze import transform_to_bronze
    msgs = spark.createDataFrame(
        [(b"k", b"{}", dt.datetime(2024, 1, d, 9)) for d in (1, 1, 2)], MESSAGE_SCHEMA)
    base = str(tmp_path / "bronze")
    transform_to_bronze(msgs).write.partitionBy("ingestion_date").parquet(base)
    one = check_parity(spark, msgs, base, "2024-01-01", wait_seconds=0).collect()
    assert [(r["source_rows"], r["bronze_rows"], r["status"]) for r in one] == [(2, 2, "ok")]
    ok = validate_partition(spark, base, "2024-01-02")
    assert ok["exists"] and ok["n_rows"] == 1 and ok["n_files"] >= 1 and ok["schema_ok"]
    assert validate_partition(spark, base, "2024-02-01")["exists"] is False
    with pytest.raises(Exception):
        check_parity(spark, msgs, str(tmp_path / "missing"), tries=2, wait_seconds=0)


def test_export_replaces_only_its_date(spark, tmp_path):
    from leadlake.sinks.lake import export_with_run_date
    base = str(tmp_path / "export")
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # the write must not rely on it
    try:
        export_with_run_date(spark.range(3), base, "2024-01-01")
        export_with_run_date(spark.range(5), base, "2024-01-02")
        export_with_run_date(spark.range(7), base, "2024-01-01")  # re-run of the first date
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
    counts = {str(r["ingestion_date"]): r["count"] for r in
              spark.read.parquet(base).groupBy("ingestion_date").count().collect()}
    assert counts == {"2024-01-01": 7, "2024-01-02": 5}


def test_parity_of_a_backfill_and_of_null_dates(spark, tmp_path):
    from leadlake.operators.bronze import transform_to_bronze
    from leadlake.plans.checks import check_parity
    from leadlake.schemas import MESSAGE_SCHEMA
    msgs = spark.createDataFrame([(b"k", b"{}", dt.datetime(2024, 1, d, 9)) for d in (1, 1, 2)], MESSAGE_SCHEMA)
    base = str(tmp_path / "bronze")
    transform_to_bronze(msgs, "2023-05-05").write.partitionBy("ingestion_date").parquet(base)
    got = check_parity(spark, msgs, base, date_override="2023-05-05", wait_seconds=0).collect()
    assert [(str(r["ingestion_date"]), r["source_rows"], r["bronze_rows"], r["status"]) for r in got] == [
        ("2023-05-05", 3, 3, "ok")]
    src = spark.createDataFrame([(None,), (dt.datetime(2024, 1, 1),)], "timestamp timestamp")
    brz = spark.createDataFrame([(None,), (dt.date(2024, 1, 1),)], "ingestion_date date")
    assert {r["status"] for r in quality.parity_report(src, brz).collect()} == {"ok"}


def test_parity_retries_the_count(spark, tmp_path, monkeypatch):
    from leadlake.plans import checks
    from leadlake.schemas import MESSAGE_SCHEMA
    from leadlake.operators.bronze import transform_to_bronze
    msgs = spark.createDataFrame([(b"k", b"{}", dt.datetime(2024, 1, 1, 9))], MESSAGE_SCHEMA)
    base, calls = str(tmp_path / "bronze"), []
    transform_to_bronze(msgs).write.partitionBy("ingestion_date").parquet(base)
    report = checks.parity_report

    def flaky(*a):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("a listed file can't be read yet")
        return report(*a)

    monkeypatch.setattr(checks, "parity_report", flaky)
    assert checks.check_parity(spark, msgs, base, wait_seconds=0).first()["status"] == "ok"
    assert len(calls) == 3


def test_missing_partitions_are_reported(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2024, 1, 2))], "x int, ingestion_date date").write.partitionBy("ingestion_date").parquet(path)
    rep = quality.partition_report(spark.read.parquet(path), first=dt.date(2024, 1, 1), last=dt.date(2024, 1, 3))
    assert {str(r["ingestion_date"])[-1]: (r["n_rows"], r["partition_exists"]) for r in rep.collect()} == {
        "1": (0, False), "2": (1, True), "3": (0, False)}


def test_export_check_finds_lost_rows(spark, tmp_path):
    from leadlake.plans.checks import verify_export
    from leadlake.sinks.lake import export_with_run_date
    export_with_run_date(spark.range(4), str(tmp_path), "2024-01-01")
    assert verify_export(spark, spark.range(4), str(tmp_path), "2024-01-01", wait_seconds=0)["ok"]
    assert not verify_export(spark, spark.range(5), str(tmp_path), "2024-01-01", wait_seconds=0)["ok"]


def test_unreadable_partition_is_not_a_missing_one(spark, tmp_path, monkeypatch):
    from leadlake.plans import checks
    monkeypatch.setattr(checks, "read_partition", lambda *a: (_ for _ in ()).throw(OSError("denied")))
    with pytest.raises(OSError):
        checks.validate_partition(spark, str(tmp_path), "2024-01-01")
