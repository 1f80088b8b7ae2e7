"""Table writes of the lake."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.timefmt import parse_date


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] | str,
                      mode: str = "append", rebalance: bool = True) -> None:
    """Write parquet partitioned by ``partition_by``.

    With ``rebalance`` the rows are first clustered on the partition columns
    with the ``REBALANCE`` hint: AQE then splits a date that holds a large
    share of the rows over several tasks and merges small dates, so a folder
    gets a few files of the advisory size instead of either one task writing
    a whole hot date (``repartition(col)``) or every task writing a small file
    into every folder (no shuffle).
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df.hint("rebalance", *cols) if rebalance else df
    out.write.mode(mode).partitionBy(*cols).parquet(path)


def export_with_run_date(df: DataFrame, base: str, run_date: str | dt.date,
                         column: str = "ingestion_date") -> str:
    """Write ``df`` plus a constant run-date column into ``base/<column>=<date>``,
    replacing only that folder (dynamic partition overwrite). Returns the
    partition path."""
    d = parse_date(run_date)
    # One folder receives everything: rebalance to advisory-size files. The
    # overwrite mode is a per-write option, not a session-wide setting.
    (df.withColumn(column, F.lit(d)).hint("rebalance")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(base))
    return f"{base.rstrip('/')}/{column}={d.isoformat()}"


def new_version_path(base: str) -> str:
    """A version folder's path: names start with the UTC time, so the greatest is the newest."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{base.rstrip('/')}/version={stamp}-{uuid.uuid4().hex[:8]}"


def commit_version(spark: SparkSession, base: str, version: str) -> str:
    """Make a completely written version the current one: its path is appended to ``_log``."""
    spark.range(1).select(F.lit(version).alias("path")) \
        .write.mode("append").text(f"{base.rstrip('/')}/_log")
    return version


def write_table_version(df: DataFrame, base: str) -> str:
    """Full refresh without overwriting the folder being read.

    The rows go to a new ``version=<utc time>-<id>`` folder; only after that
    write has committed is the folder name appended to ``_log`` (an
    append-only list, never rewritten). A job that dies half-way leaves an
    unreferenced folder and the previous version stays current. Single writer
    per table. Returns the version path.
    """
    version = new_version_path(base)
    df.write.mode("errorifexists").parquet(version)
    return commit_version(df.sparkSession, base, version)


def current_table_version(spark: SparkSession, base: str) -> str | None:
    """The newest committed version folder, or None when never written.
    Version names start with a UTC timestamp, so the greatest name wins."""
    log = read_if_there(lambda: spark.read.text(f"{base.rstrip('/')}/_log"))
    if log is None:
        return None
    # top-1 per task, merged on the driver: one job, one row back
    rows = log.orderBy(F.col("value").desc()).limit(1).collect()
    return rows[0]["value"] if rows else None


def read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where its path does not exist. Any other failure is
    raised: taking it for "no table" would replace a table by its last batch."""
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
