"""Feature profiles kept per ingestion date and merged on read.

A date's profile is a row per feature: extremes, numbers of values and NULLs, and a
distinct-count sketch (HyperLogLog of 2 ** LG_K registers) that merges without loss: the
sketch of a window is that of its dates' union. Profiling a window reads the dates' small
rows, not the data; a date that comes again replaces its rows.

Extremes and counts are exact. The distinct count has a relative standard error of about
1.04 / sqrt(2 ** LG_K): 0.8 %.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.sources.lake import filter_date_window

LG_K = 14
DATE = "ingestion_date"
SCHEMA = ("feature string, min_value double, max_value double, n_values long, n_nulls long, "
          f"sketch binary, {DATE} date")


def daily_profiles(df: DataFrame, cols: Sequence[str], date_col: str = DATE) -> DataFrame:
    """(feature, min_value, max_value, n_values, n_nulls, sketch, ingestion_date): one pass, partial aggregates.

    NaN is no value, as in ``feature_profile``."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.nanvl(
        F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias("v")) for c in cols])
    long = df.select(F.col(date_col).cast("date").alias(DATE), F.inline(entries))
    # The sketch takes no doubles; -0.0 and 0.0 are one value, as they are for DISTINCT.
    text = (F.col("v") + F.lit(0.0)).cast("string")
    return long.groupBy("feature", DATE).agg(
        F.min("v").alias("min_value"), F.max("v").alias("max_value"), F.count("v").alias("n_values"),
        F.count_if(F.col("v").isNull()).alias("n_nulls"), F.hll_sketch_agg(text, F.lit(LG_K)).alias("sketch")
    ).select("feature", "min_value", "max_value", "n_values", "n_nulls", "sketch", DATE)


def store_profiles(df: DataFrame, cols: Sequence[str], base: str, date_col: str = DATE) -> None:
    """Add the profiles of the dates in ``df``; dates that are there already are replaced, others untouched."""
    (daily_profiles(df, cols, date_col).hint("rebalance", DATE).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(base))


def window_profile(spark: SparkSession, base: str, start: str | dt.date | None = None,
                   end: str | dt.date | None = None) -> DataFrame:
    """The profile of a window of dates, merged from the stored ones."""
    days = filter_date_window(spark.read.schema(SCHEMA).parquet(base), DATE, start, end)
    merged = days.groupBy("feature").agg(
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sum("n_values").alias("n_values"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    return merged.withColumn("is_constant", F.col("n_distinct") <= 1)
