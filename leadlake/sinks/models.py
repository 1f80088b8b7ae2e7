"""Models as versioned folders: what training leaves behind for scoring jobs.

A version holds the MLlib model and its contract, one JSON line that names the columns
it reads, the threshold, and how it was trained. The pointer moves once both are
written, so a job that reads the current version never meets half a model.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leadlake.sinks.lake import commit_version, current_table_version, new_version_path


@dataclass(frozen=True)
class StoredModel:
    version: str
    model: GBTClassificationModel
    contract: dict


def save_model(spark: SparkSession, base: str, model: GBTClassificationModel, contract: dict) -> str:
    """Write a new version of the model at ``base`` and make it the current one; returns its path.

    The contract needs ``id``, ``features`` and ``threshold``."""
    missing = {"id", "features", "threshold"} - set(contract)
    if missing:
        raise ValueError(f"the contract lacks {sorted(missing)}")
    if len(contract["features"]) != model.numFeatures:
        raise ValueError(f"the model reads {model.numFeatures} features, the contract names {len(contract['features'])}")
    version = new_version_path(base)
    model.write().save(f"{version}/model")
    spark.range(1).select(F.lit(json.dumps(contract, sort_keys=True)).alias("value")).write.text(f"{version}/contract")
    return commit_version(spark, base, version)


def load_model(spark: SparkSession, base: str, version: str | None = None) -> StoredModel:
    """The current (or a given) version of the model at ``base``."""
    version = version or current_table_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no model at {base}")
    contract = json.loads(spark.read.text(f"{version}/contract").first()["value"])
    return StoredModel(version, GBTClassificationModel.load(f"{version}/model"), contract)
