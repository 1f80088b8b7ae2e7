"""Write, audit, publish: a version becomes current only if it meets its expectations.

The rows are written to a version folder nobody reads yet, the expectations are checked
on what was written, and the pointer moves if all hold. Otherwise the version before
stays current; the rejected one stays on disk for inspection. Each audit's report is
kept beside the table, with the version's path and the decision.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.literal import literal_rows
from leadlake.operators.expectations import REPORT_SCHEMA, Expectations, check
from leadlake.schemas import GOLD_ACCEPTED, GOLD_ID, GOLD_NOT_NULL
from leadlake.sinks.lake import commit_version, current_table_version, new_version_path, read_if_there

GOLD_EXPECTATIONS = Expectations("leads_gold_features", GOLD_NOT_NULL, GOLD_ID, GOLD_ACCEPTED, at_least_rows=1)


@dataclass(frozen=True)
class Publication:
    version: str
    published: bool
    report: list[tuple]


def publish_audited(df: DataFrame, base: str, expected: Expectations) -> Publication:
    """Write ``df`` as a new version at ``base``; make it current if it meets ``expected``."""
    spark, version = df.sparkSession, new_version_path(base)
    df.write.mode("errorifexists").parquet(version)
    report = [tuple(r) for r in check(spark.read.schema(df.schema).parquet(version), expected).collect()]
    published = all(r[-1] for r in report)
    audit = literal_rows(spark, REPORT_SCHEMA, report).withColumns(
        {"version": F.lit(version), "published": F.lit(published)})
    audit.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/_audits")
    if published:
        commit_version(spark, base, version)
    return Publication(version, published, report)


def audits(spark: SparkSession, base: str) -> DataFrame | None:
    """All audits of the table: report rows with ``version`` and ``published``."""
    return read_if_there(lambda: spark.read.parquet(f"{base.rstrip('/')}/_audits"))


def good_then_bad_gold(gold: DataFrame, base: str) -> DataFrame:
    """Publishes gold, then tries a spoilt one (rows twice, values outside the list, no label): a row per audit line,
    with the version's place in time and whether it is current in the end."""
    spark, lead = gold.sparkSession, F.col(f"`{GOLD_ID}`")
    spoilt = (gold.unionByName(gold.where(lead % 50 == 0))
              .withColumn("Tags_Ringing", F.when(lead % 31 == 0, 2).otherwise(F.col("Tags_Ringing")))
              .withColumn("Converted", F.when(lead % 37 != 0, F.col("Converted"))))
    tried = [publish_audited(rows, base, GOLD_EXPECTATIONS) for rows in (gold, spoilt)]
    current = current_table_version(spark, base)
    parts = [literal_rows(spark, REPORT_SCHEMA, p.report).withColumns(
        {"attempt": F.lit(k), "published": F.lit(p.published), "current": F.lit(p.version == current)})
        for k, p in enumerate(tried)]
    return parts[0].unionByName(parts[1])
