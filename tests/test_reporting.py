import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators import reporting
from leadlake.schemas import REPORTING_SCHEMA
from leadlake.sinks import bucketed


def tracking(spark):
    runs = spark.createDataFrame([
        ("r1", 1, 1_700_000_000_999, "active", "FINISHED"),
        ("r2", 1, 1_700_000_100_000, "active", "FINISHED"),
        ("r3", 2, 1_700_000_200_000, "deleted", "FINISHED"),
        ("r4", 2, 1_700_000_300_000, "active", "RUNNING"),
    ], "run_uuid string, experiment_id long, start_time long, lifecycle_stage string, "
       "status string")
    exps = spark.createDataFrame([(1, "e1"), (2, "e2")], "experiment_id long, name string")
    metrics = spark.createDataFrame([
        ("r1", "auc", 0.7), ("r1", "eval-auc", 0.8), ("r1", "precision", 0.5),
        ("r1", "recall", 0.5), ("r1", "true_positives", 1.0), ("r1", "other", 9.0),
        ("r3", "auc", 0.9),
    ], "run_uuid string, key string, value double")
    return runs, exps, metrics


def test_pivot(spark):
    out = {r["run_uuid"]: r for r in reporting.pivot_run_metrics(*tracking(spark)).collect()}
    assert set(out) == {"r1", "r2"}  # deleted / running runs are excluded
    assert out["r1"]["auc"] == 0.8  # two keys feed auc, MAX wins
    assert out["r1"]["start_time"] == dt.datetime(2023, 11, 14, 22, 13, 20)  # whole seconds
    assert out["r2"]["auc"] is None and out["r2"]["experiment_name"] == "e1"  # left join


def test_upsert_is_idempotent_and_versioned(spark, tmp_path):
    base = str(tmp_path / f"reporting-{uuid.uuid4().hex}")
    assert reporting.read_reporting_table(spark, base).count() == 0  # created empty
    assert reporting.read_reporting_table(spark, base).schema == REPORTING_SCHEMA
    rows = reporting.pivot_run_metrics(*tracking(spark))
    batch = reporting.to_reporting_rows(rows, dt.datetime(2024, 2, 1))
    once = reporting.upsert_table(spark, base, batch)
    twice = reporting.upsert_table(spark, base, batch)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    newer = reporting.to_reporting_rows(rows.where("run_uuid = 'r2'"), dt.datetime(2024, 3, 1))
    third = {r["run_id"]: r["sync_timestamp"] for r in
             reporting.upsert_table(spark, base, newer).collect()}
    assert third == {"r1": dt.datetime(2024, 2, 1), "r2": dt.datetime(2024, 3, 1)}


def test_dashboard_view(spark):
    rows = reporting.to_reporting_rows(reporting.pivot_run_metrics(*tracking(spark)),
                                       dt.datetime(2024, 2, 1))
    out = {r["run_id"]: r for r in reporting.dashboard_view(rows).collect()}
    assert out["r1"]["f1"] == 0.5 and out["r1"]["accuracy"] is None
    assert out["r2"]["f1"] is None


def test_failed_version_write_keeps_previous_version(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    from leadlake.sinks.lake import current_table_version, write_table_version
    base = str(tmp_path / "t")
    first = write_table_version(spark.range(3), base)
    assert current_table_version(spark, base) == first
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom")))
                                    .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        write_table_version(broken, base)
    assert current_table_version(spark, base) == first
    assert spark.read.parquet(current_table_version(spark, base)).count() == 3


def test_repeated_tracking_rows_count_once(spark):
    runs, exps, metrics = tracking(spark)
    out = reporting.pivot_run_metrics(runs.union(runs), exps.union(exps).union(exps), metrics).collect()
    assert sorted(r["run_uuid"] for r in out) == ["r1", "r2"]


def test_upsert_rejects_a_batch_that_repeats_a_key(spark, tmp_path):
    import pytest
    base = str(tmp_path / "reporting")
    batch = reporting.to_reporting_rows(reporting.pivot_run_metrics(*tracking(spark)), dt.datetime(2024, 2, 1))
    reporting.upsert_table(spark, base, batch)
    with pytest.raises(ValueError, match="repeated"):
        reporting.upsert_table(spark, base, batch.union(batch))
    assert reporting.read_reporting_table(spark, base).count() == 2


def test_failed_log_read_does_not_empty_the_table(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.sql import DataFrameReader
    base = str(tmp_path / "reporting")
    batch = reporting.to_reporting_rows(reporting.pivot_run_metrics(*tracking(spark)), dt.datetime(2024, 2, 1))
    reporting.upsert_table(spark, base, batch)
    with monkeypatch.context() as m:
        m.setattr(DataFrameReader, "text", lambda *a, **k: (_ for _ in ()).throw(OSError("storage error")))
        with pytest.raises(OSError):
            reporting.upsert_table(spark, base, batch.where("run_id = 'r2'"))
    assert reporting.read_reporting_table(spark, base).count() == 2


def test_empty_reporting_table_is_created_once(spark, tmp_path):
    base = str(tmp_path / "reporting")
    first = reporting.ensure_reporting_table(spark, base)
    assert reporting.ensure_reporting_table(spark, base) == first
    assert bucketed.manifest(spark, base) == (bucketed.BUCKETS, {})
    assert reporting.dashboard_view(reporting.read_reporting_table(spark, base)).collect() == []


def _files(base):
    return {str(p.relative_to(base)) for p in base.rglob("part-*.parquet") if "_bucket=" in str(p)}


def test_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    """A sync of a few runs writes their buckets' files; the other buckets stay the same files, old versions readable."""
    base = tmp_path / "t"
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    rows = spark.range(2000).selectExpr("cast(id AS string) AS k", "id AS v")
    first = bucketed.upsert(spark, str(base), rows, ["k"], schema, n_buckets=16)
    before = _files(base)
    few = spark.createDataFrame([("7", -7), ("new", -1)], schema)
    second = bucketed.upsert(spark, str(base), few, ["k"], schema)
    written = {f.split("_bucket=")[1].split("/")[0] for f in _files(base) - before}
    touched = {str(r[0]) for r in few.select(bucketed.bucket_of(["k"], 16)).collect()}
    assert written == touched and before <= _files(base)
    now = {r["k"]: r["v"] for r in bucketed.read(spark, str(base), schema).collect()}
    assert now == {**{str(i): i for i in range(2000)}, "7": -7, "new": -1}
    assert bucketed.read(spark, str(base), schema, version=first).count() == 2000 and second != first
    assert bucketed.upsert(spark, str(base), few.limit(0), ["k"], schema) == second  # nothing to do


def test_upsert_rejects_a_batch_without_key(spark, tmp_path):
    base = str(tmp_path / "reporting")
    batch = reporting.to_reporting_rows(reporting.pivot_run_metrics(*tracking(spark)), dt.datetime(2024, 2, 1))
    reporting.upsert_table(spark, base, batch)
    for _ in range(2):
        with pytest.raises(ValueError, match="no or repeated"):
            reporting.upsert_table(spark, base, batch.limit(1).withColumn("run_id", F.lit(None).cast("string")))
    assert reporting.read_reporting_table(spark, base).count() == 2


def test_lost_upsert_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "t")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    bucketed.upsert(spark, base, spark.createDataFrame([("a", 1), ("b", 2)], schema), ["k"], schema, n_buckets=4)
    broken = spark.createDataFrame([("a", 9), ("c", 3)], schema).select(
        "k", F.when(F.col("k") == "c", F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="boom"):
        bucketed.upsert(spark, base, broken, ["k"], schema)
    assert sorted(tuple(r) for r in bucketed.read(spark, base, schema).collect()) == [("a", 1), ("b", 2)]


def test_newest_runs_first(spark):
    rows = reporting.pivot_run_metrics(*tracking(spark))
    assert [r["run_uuid"] for r in reporting.newest_first(rows).collect()] == ["r2", "r1"]
    assert {r["run_uuid"]: r["newest_rank"] for r in reporting.rank_newest(rows).collect()} == {"r2": 1, "r1": 2}
