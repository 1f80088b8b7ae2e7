"""Silver -> gold models: the training feature table, the readable typed view
and the inference view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.functions.categories import bucket_categories, one_hot
from leadlake.operators.features import clean_text_columns, impute_mean
from leadlake.schemas import (ACTIVITY_KEEP, ACTIVITY_OTHER, CITY_KEEP, CITY_OTHER,
                              GOLD_DUMMIES, GOLD_ID, GOLD_LABEL, GOLD_NUMERIC, OCCUPATION_KEEP,
                              OCCUPATION_OTHER, TAGS_KEEP, TAGS_OTHER, UNKNOWN)

NUMERIC = [c for c, _ in GOLD_NUMERIC]
TEXT = ["current_occupation", "tags", "city", "last_notable_activity"]


def gold_base(silver: DataFrame) -> DataFrame:
    """Columns of silver the gold models use, imputed and cleaned."""
    base = silver.select("lead_number", "converted", *NUMERIC, *TEXT)
    return clean_text_columns(impute_mean(base, NUMERIC), TEXT)


def gold_features(silver: DataFrame) -> DataFrame:
    """Training table: id, 4 numerics, 7 dummies, target (model column names)."""
    clean = gold_base(silver).withColumn(
        "tags_bucket", bucket_categories("tags", TAGS_KEEP, TAGS_OTHER, UNKNOWN))
    return clean.select(
        F.col("lead_number").alias(GOLD_ID),
        *[F.col(src).alias(name) for src, name in GOLD_NUMERIC],
        *[one_hot(src, level).alias(name) for name, src, level in GOLD_DUMMIES],
        F.col("converted").alias(GOLD_LABEL),
    )


def gold_typed(silver: DataFrame) -> DataFrame:
    """Readable view: imputed numerics and bucketed categories."""
    clean = gold_base(silver)
    return clean.select(
        "lead_number", "converted", *NUMERIC,
        bucket_categories("current_occupation", OCCUPATION_KEEP, OCCUPATION_OTHER, UNKNOWN)
        .alias("current_occupation_bucket"),
        bucket_categories("tags", TAGS_KEEP, TAGS_OTHER, UNKNOWN).alias("tags_bucket"),
        bucket_categories("city", CITY_KEEP, CITY_OTHER).alias("city_bucket"),
        bucket_categories("last_notable_activity", ACTIVITY_KEEP, ACTIVITY_OTHER)
        .alias("last_notable_activity_bucket"),
    )


def gold_inference(features: DataFrame) -> DataFrame:
    """The feature table without the target (scoring input)."""
    return features.drop(GOLD_LABEL)
