"""Gold -> model: profile, exact split, boosted trees with early stopping on AUC, test-set
evaluation, importance, the run's tracking rows, the stored model and scoring with it."""

from __future__ import annotations

import datetime as dt
import logging
import threading
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.literal import literal_rows
from leadlake.operators import ml
from leadlake.operators.boosting import EarlyStop, train_patiently
from leadlake.operators.features import feature_profile
from leadlake.operators.split import exact_split
from leadlake.plans import lakehouse as lh
from leadlake.plans.gold import gold_inference
from leadlake.schemas import GOLD_FEATURES, GOLD_ID, GOLD_LABEL
from leadlake.sinks.models import StoredModel, save_model

log = logging.getLogger(__name__)

EXPERIMENT = "GBT_Lead_Conversion"
# The training budget of the lead model.
PARAMS = {"max_iter": 100, "max_depth": 6, "step_size": 0.05, "subsampling_rate": 0.8,
          "seed": 42, "threshold": 0.5, "patience": 10}
TRAIN_SHARE = 0.8


# The registered queries' run: the same rows on every call.
RUN_ID = "run-1"
RUN_START = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
_METRICS = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("auc", "precision", "recall")]
    + [T.StructField(n, T.LongType()) for n in ("true_positives", "true_negatives", "false_positives",
                                                "false_negatives", "best_iteration", "stopped_iteration")])


@dataclass
class TrainingRun:
    model: GBTClassificationModel
    profile: DataFrame
    run_metrics: DataFrame
    importance: DataFrame
    tracking: dict[str, DataFrame]
    test_scores: DataFrame
    early_stop: EarlyStop


_lock = threading.RLock()
_runs: dict[tuple[str, str], TrainingRun] = {}


def train_on_gold(spark: SparkSession, gold: DataFrame, run_id: str | None = None,
                  start: dt.datetime | None = None) -> TrainingRun:
    # Written once: profile, fit and scoring read files, none recomputes gold.
    matrix = lh.materialize(spark, ml.training_matrix(gold, GOLD_ID, GOLD_LABEL, GOLD_FEATURES), "train_matrix")
    profile = feature_profile(matrix, GOLD_FEATURES)
    for row in profile.where("is_constant").select("feature").collect():
        log.warning("feature %s is constant (no information)", row["feature"])
    parts = split_rows(spark, matrix)
    data = ml.assemble(parts, GOLD_FEATURES)
    test = data.where(F.col("split") == "test")
    # As the original does, the test part also decides when training stops.
    model, stop = train_patiently(data.where(F.col("split") == "train"), test, patience=PARAMS["patience"],
                                  **{k: PARAMS[k] for k in ("max_iter", "max_depth", "step_size", "subsampling_rate", "seed")})
    scored = lh.materialize(spark, ml.score(model, test, PARAMS["threshold"], keep=[GOLD_ID, "label"]), "test_scores")
    # Two one-row reports of the written scores become one row of literals.
    confusion = ml.confusion_metrics(scored, "label", "prediction").first()
    auc = ml.auc_by_group(scored, "label", "probability").first()["auc"]
    metrics = literal_rows(spark, _METRICS, [(auc, confusion["precision"], confusion["recall"], confusion["tp"],
                                              confusion["tn"], confusion["fp"], confusion["fn"],
                                              stop.best, stop.last)])
    tracking = ml.run_log(spark, EXPERIMENT, PARAMS, metrics, run_id, start)
    importance = ml.feature_importance(spark, model, GOLD_FEATURES, 20)
    return TrainingRun(model, profile, tracking["latest_metrics"], importance, tracking, scored, stop)


def train_and_evaluate(spark: SparkSession, sf_dir: str) -> TrainingRun:
    """Train once per (application, source folder); later calls reuse the run."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        run = _runs.get(key)
        if run is None:
            run = train_on_gold(spark, lh.gold(spark, sf_dir), RUN_ID, RUN_START)
            _runs[key] = run
    return run


def split_rows(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows with their part: exactly ``int(0.8 n)`` are for training, by a hash of the lead number."""
    return exact_split(rows, GOLD_ID, TRAIN_SHARE, lambda df: lh.materialize(spark, df, "split_rows"), seed=PARAMS["seed"])


def contract_of(run: TrainingRun) -> dict:
    """What a scoring job has to know of the run's model."""
    return {"id": GOLD_ID, "label": GOLD_LABEL, "features": list(GOLD_FEATURES), "threshold": PARAMS["threshold"],
            "best_iteration": run.early_stop.best, "stopped_iteration": run.early_stop.last, "params": PARAMS}


def store_run(spark: SparkSession, run: TrainingRun, base: str) -> str:
    """Save the run's model as a new version at ``base``."""
    return save_model(spark, base, run.model, contract_of(run))


def _score(model: GBTClassificationModel, contract: dict, rows: DataFrame) -> DataFrame:
    missing = [c for c in (contract["id"], *contract["features"]) if c not in rows.columns]
    if missing:
        raise ValueError(f"the model reads columns that are not there: {missing}")
    label = contract.get("label", GOLD_LABEL)
    matrix = ml.training_matrix(rows.withColumn(label, F.lit(0)), contract["id"], label, contract["features"])
    return ml.score(model, ml.assemble(matrix, contract["features"]), contract["threshold"], keep=[contract["id"]])


def score_stored(stored: StoredModel, rows: DataFrame) -> DataFrame:
    """Id, probability and class of every row, by a stored model and the columns its contract names."""
    return _score(stored.model, stored.contract, rows)


def score_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the inference view (gold without the target) with the run's model."""
    run = train_and_evaluate(spark, sf_dir)
    return _score(run.model, contract_of(run), gold_inference(lh.gold(spark, sf_dir)))


def stored_model(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the run's model, saved once per application."""
    return lh.once(spark, "model", sf_dir, lambda p: store_run(spark, train_and_evaluate(spark, sf_dir), p))
