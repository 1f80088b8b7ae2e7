"""Expose the lake's layers to SQL users as named views.

``leads_gold_features`` is materialised (full refresh into a new version
folder, the previous version stays readable until the switch); the other
layers are views over the written silver table, as in the original models.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from leadlake.operators.reporting import dashboard_view, read_reporting_table
from leadlake.plans import lakehouse as lh
from leadlake.plans.gold import gold_inference, gold_typed
from leadlake.sinks.lake import current_table_version, write_table_version

VIEWS = ["leads_bronze", "leads_silver", "leads_gold_features", "leads_gold_typed",
         "leads_gold_sin_converted"]


def materialize_gold(spark: SparkSession, sf_dir: str, base: str | None = None) -> str:
    """Full refresh of the gold feature table; returns the version path."""
    base = base or lh.new_table_path(spark, "gold_features")
    return write_table_version(lh.gold(spark, sf_dir), base)


def register_lake_views(spark: SparkSession, sf_dir: str, reporting_base: str | None = None,
                        gold_base: str | None = None) -> list[str]:
    """Create or replace the temp views of every layer; returns their names."""
    lh.bronze_table(spark, sf_dir).createOrReplaceTempView("leads_bronze")
    silver = lh.silver_table(spark, sf_dir)
    silver.createOrReplaceTempView("leads_silver")
    version = current_table_version(spark, gold_base) if gold_base else None
    if version is None:
        version = materialize_gold(spark, sf_dir, gold_base)
    gold = spark.read.parquet(version)
    gold.createOrReplaceTempView("leads_gold_features")
    gold_typed(silver).createOrReplaceTempView("leads_gold_typed")
    gold_inference(gold).createOrReplaceTempView("leads_gold_sin_converted")
    names = list(VIEWS)
    if reporting_base:
        reporting = read_reporting_table(spark, reporting_base)
        reporting.createOrReplaceTempView("reporting_model_metrics")
        dashboard_view(reporting).createOrReplaceTempView("v_dashboard_model_metrics")
        names += ["reporting_model_metrics", "v_dashboard_model_metrics"]
    return names
