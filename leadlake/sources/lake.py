"""Reads of the lake's parquet tables."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.timefmt import parse_date

T = TypeVar("T")

_schemas: dict[str, object] = {}


def read_immutable_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a parquet path that never changes once written (read-only inputs,
    write-once table folders), inferring its schema only on the first read.

    Schema inference runs a footer-reading job on every ``read.parquet``;
    later reads of the same folder pass the remembered schema instead
    (partition columns included).
    """
    schema = _schemas.get(path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    _schemas[path] = df.schema
    return df


def filter_date_window(df: DataFrame, column: str, start: str | dt.date | None = None,
                       end: str | dt.date | None = None) -> DataFrame:
    """Inclusive ``column BETWEEN start AND end``; literal bounds so that on a
    partition column the filter becomes a ``PartitionFilters`` entry."""
    c = F.col(column)
    if start is not None:
        df = df.where(c >= F.lit(parse_date(start)))
    if end is not None:
        df = df.where(c <= F.lit(parse_date(end)))
    return df


def trailing_window(end: str | dt.date, days: int) -> tuple[dt.date, dt.date]:
    """``[end - days, end]`` (the run date and the look-back)."""
    e = parse_date(end)
    return e - dt.timedelta(days=days), e


def read_partitioned(spark: SparkSession, base: str, start: str | dt.date | None = None,
                     end: str | dt.date | None = None,
                     partition_column: str = "ingestion_date") -> DataFrame:
    """Scan a hive-partitioned parquet table; the partition column comes from
    the folder names (``ingestion_date=YYYY-MM-DD`` -> DATE)."""
    return filter_date_window(spark.read.parquet(base), partition_column, start, end)


def read_partition(spark: SparkSession, base: str, value: str | dt.date,
                   partition_column: str = "ingestion_date") -> DataFrame:
    """Read one partition folder; ``basePath`` keeps the partition column."""
    path = f"{base.rstrip('/')}/{partition_column}={parse_date(value).isoformat()}"
    return spark.read.option("basePath", base).parquet(path)


def with_retry(action: Callable[[], T], tries: int = 5, wait_seconds: float = 5.0,
               sleep: Callable[[float], None] = time.sleep) -> T:
    """Run a driver-side read action until it succeeds (files written by another
    job may become visible late); re-raise after ``tries`` attempts."""
    if tries < 1:
        raise ValueError("tries must be >= 1")
    for attempt in range(tries):
        try:
            return action()
        except Exception:  # noqa: BLE001 - any read failure is retried
            if attempt == tries - 1:
                raise
            sleep(wait_seconds)
    raise AssertionError("unreachable")
