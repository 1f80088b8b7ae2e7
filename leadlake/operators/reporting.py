"""Tracked runs -> reporting table: metric pivot, typed table, upsert,
dashboard view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlake.functions.literal import literal_rows
from leadlake.functions.numeric import accuracy, f1_score
from leadlake.functions.timefmt import epoch_ms_to_timestamp
from leadlake.schemas import METRIC_MAP, REPORTING_SCHEMA
from leadlake.sinks import bucketed


def pivot_run_metrics(runs: DataFrame, experiments: DataFrame, metrics: DataFrame,
                      metric_map: Mapping[str, Sequence[str]] = METRIC_MAP) -> DataFrame:
    """One row per finished, active run with its metrics as columns.

    ``MAX(CASE WHEN key IN keys THEN value END)`` per output column. The
    key/value rows are pivoted per run *before* the join (one hash aggregate
    with map-side combine), so the join moves one narrow row per run instead
    of every metric row; runs without metrics keep NULLs (left join). Repeated
    tracking rows count once: one row per run, start time and experiment name.
    """
    wanted = sorted({k for keys in metric_map.values() for k in keys})
    per_run = (metrics.where(F.col("key").isin(wanted))
               .groupBy("run_uuid")
               .agg(*[F.max(F.when(F.col("key").isin(list(keys)), F.col("value"))).alias(out)
                      for out, keys in metric_map.items()]))
    active = (runs.where((F.col("lifecycle_stage") == "active") & (F.col("status") == "FINISHED"))
              .select("run_uuid", "experiment_id", "start_time"))
    names = experiments.select("experiment_id", F.col("name").alias("experiment_name")).distinct()
    named = (active.join(names, "experiment_id", "inner")
             .select("run_uuid", "start_time", "experiment_name").distinct())
    return named.join(per_run, "run_uuid", "left").select(
        "run_uuid", epoch_ms_to_timestamp("start_time").alias("start_time"), "experiment_name",
        *[F.col(out) for out in metric_map])


def to_reporting_rows(pivot: DataFrame, sync_timestamp: dt.datetime | None = None) -> DataFrame:
    """Pivot rows in the reporting table's schema; ``sync_timestamp`` defaults
    to the current time (a passed value makes the output repeatable)."""
    sync = F.lit(sync_timestamp).cast("timestamp") if sync_timestamp else F.current_timestamp()
    cols = {f.name: f.dataType for f in REPORTING_SCHEMA.fields}
    return pivot.select(
        F.col("run_uuid").cast("string").alias("run_id"),
        F.col("start_time").cast("timestamp").alias("run_timestamp"),
        F.col("experiment_name").cast("string"),
        *[F.col(c).cast(cols[c]).alias(c) for c in
          ["auc", "precision", "recall", "tp", "tn", "fp", "fn", "best_iter", "stopped_iter"]],
        sync.alias("sync_timestamp"))


def read_reporting_table(spark: SparkSession, base: str) -> DataFrame:
    """The current reporting table, or an empty typed one when none exists."""
    return bucketed.read(spark, base, REPORTING_SCHEMA)


def newest_first(pivot: DataFrame) -> DataFrame:
    """Runs in the order they are presented: latest start first, then run id."""
    return pivot.orderBy(F.col("start_time").desc_nulls_last(), "run_uuid")


def rank_newest(pivot: DataFrame) -> DataFrame:
    """Each run with its place among its experiment's runs, the newest first."""
    newest = Window.partitionBy("experiment_name").orderBy(F.col("start_time").desc_nulls_last(), "run_uuid")
    return pivot.withColumn("newest_rank", F.row_number().over(newest))


def ensure_reporting_table(spark: SparkSession, base: str) -> str:
    """Create the empty typed table where there is none; returns the current version's path."""
    return bucketed.create(spark, base)


def upsert(target: DataFrame, batch: DataFrame, key: str | Sequence[str] = "run_id") -> DataFrame:
    """Replace target rows whose key is in the batch, add the new ones.

    One anti join + union instead of a delete/insert per row. The batch must
    be unique by key; ``upsert_table`` rejects one that is not."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def upsert_table(spark: SparkSession, base: str, batch: DataFrame,
                 key: str | Sequence[str] = "run_id") -> DataFrame:
    """Upsert into the reporting table at ``base`` and return the new version.

    The table lies in hash buckets: only those that the batch falls in are read and
    written anew, the pointer moves last. A batch with a NULL or repeated key is an
    error, and the table stays as it is."""
    keys = [key] if isinstance(key, str) else list(key)
    bucketed.upsert(spark, base, batch, keys, REPORTING_SCHEMA)
    return read_reporting_table(spark, base)


def dashboard_view(reporting: DataFrame) -> DataFrame:
    """Reporting rows plus F1 and accuracy (NULL when undefined)."""
    return reporting.select(
        "run_id", "run_timestamp", "experiment_name", "auc", "precision", "recall",
        f1_score("precision", "recall").alias("f1"),
        accuracy("tp", "tn", "fp", "fn").alias("accuracy"),
        "tp", "tn", "fp", "fn", "best_iter", "stopped_iter", "sync_timestamp")
