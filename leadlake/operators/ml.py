"""Model jobs on the gold table: split, feature matrix, boosted trees,
scoring, evaluation (confusion counts, AUC), importance, run log."""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from leadlake.functions.categories import hash_bucket
from leadlake.functions.literal import literal_rows
from leadlake.functions.numeric import ratio_or_zero
from leadlake.sinks.lake import read_if_there


_IMPORTANCE = StructType([StructField("feature", StringType()),
                          StructField("importance", DoubleType())])
_RUNS = StructType([StructField("run_uuid", StringType()), StructField("experiment_id", LongType()),
                    StructField("start_time", LongType()),
                    StructField("lifecycle_stage", StringType()),
                    StructField("status", StringType())])
_EXPERIMENTS = StructType([StructField("experiment_id", LongType()),
                           StructField("name", StringType())])
_PARAMS = StructType([StructField("run_uuid", StringType()), StructField("key", StringType()),
                      StructField("value", StringType())])


def _q(name: str):
    return F.col(f"`{name}`")


def hash_split(df: DataFrame, key: str, fractions: Mapping[str, int], seed: int = 42,
               column: str = "split") -> DataFrame:
    """Assign each row to a named part by the md5 bucket (0..99) of its key.

    ``fractions`` are percentages in order, e.g. ``{"train": 80, "test": 20}``.
    The assignment depends only on the key and the seed: no global shuffle,
    the same under any partitioning and task retry; part sizes are
    approximately (not exactly) the fractions. A NULL key hashes as the empty
    one, so every row is in a part.
    """
    if sum(fractions.values()) != 100:
        raise ValueError("fractions must add up to 100")
    b = hash_bucket(F.coalesce(_q(key).cast("string"), F.lit("")), seed, 100)
    expr, upper = None, 0
    for name, pct in fractions.items():
        upper += pct
        expr = F.when(b < upper, F.lit(name)) if expr is None else expr.when(b < upper, F.lit(name))
    return df.withColumn(column, expr)


def training_matrix(gold: DataFrame, id_col: str, label: str,
                    features: Sequence[str] | None = None) -> DataFrame:
    """Label (NULL -> 0) and features by exclusion of id and label; NULL
    floats become NaN, other NULLs 0; everything as DOUBLE."""
    feats = [c for c in gold.columns if c not in (id_col, label)] if features is None \
        else list(features)
    types = dict(gold.dtypes)
    filled = []
    for c in feats:
        fill = F.lit(float("nan")) if types[c] in ("double", "float") else F.lit(0)
        filled.append(F.coalesce(_q(c), fill).cast("double").alias(c))
    return gold.select(_q(id_col), F.coalesce(_q(label), F.lit(0)).cast("double").alias("label"),
                       *filled)


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Stack feature columns into one vector (NaN kept for the trees)."""
    return VectorAssembler(inputCols=list(features), outputCol=output,
                           handleInvalid="keep").transform(df)


def train_gbt(train: DataFrame, label: str = "label", features: str = "features",
              validation_col: str | None = None, max_iter: int = 100, max_depth: int = 6,
              step_size: float = 0.05, subsampling_rate: float = 0.8, seed: int = 42,
              validation_tol: float = 0.01) -> GBTClassificationModel:
    """Distributed gradient-boosted trees (logistic loss).

    With ``validation_col`` training stops early once the validation loss
    stops improving by ``validation_tol`` (MLlib's rule)."""
    gbt = GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step_size,
                        subsamplingRate=subsampling_rate, seed=seed, lossType="logistic",
                        validationTol=validation_tol,
                        # keep each row's node ids instead of re-descending all
                        # trees every round; checkpointed every 10 rounds into
                        # spark.checkpoint.dir, which also cuts the lineage
                        cacheNodeIds=True, checkpointInterval=10)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    return gbt.fit(train)


def score(model: GBTClassificationModel, df: DataFrame, threshold: float = 0.5,
          keep: Sequence[str] = ()) -> DataFrame:
    """Positive-class probability and the class at a strict threshold."""
    scored = model.transform(df)
    p = vector_to_array(F.col(model.getProbabilityCol()))[1]
    return scored.select(*[_q(c) for c in keep], p.alias("probability"),
                         classify(p, threshold).alias("prediction"))


def classify(probability: Column, threshold: float = 0.5) -> Column:
    """1 above the threshold, 0 at or below it (and for NULL)."""
    return F.when(probability > threshold, 1).otherwise(0)


def confusion_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp, tn, fp, fn and precision / recall (0.0 when undefined), one pass."""
    y, p = _q(label) == 1, _q(prediction) == 1
    counts = df.agg(F.count_if(p & y).alias("tp"), F.count_if(~p & ~y).alias("tn"),
                    F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"))
    return counts.select("tp", "tn", "fp", "fn",
                         ratio_or_zero("tp", F.col("tp") + F.col("fp")).alias("precision"),
                         ratio_or_zero("tp", F.col("tp") + F.col("fn")).alias("recall"))


def auc_by_group(df: DataFrame, label: str, score_col: str, group: str | None = None) -> DataFrame:
    """Area under the ROC curve per group (ties between a positive and a
    negative count one half): sum over scores of pos * (neg below + neg/2),
    divided by P * N.

    Counts per (group, distinct score) come first, by partial aggregation. They
    are dealt into ranges of (group, score); a running total inside each range
    gives the range's own share of the sum, and the negatives of a group's
    earlier ranges add ``pos * neg`` of whole ranges. So nothing is joined, a
    group's scores spread over many tasks, and there are four exchanges: by
    score, by range, by (group, range), by group (without a group one more for
    the single row). Integer arithmetic until one final division, so the result
    does not depend on where ranges begin. NULL is a group of its own, a NULL
    label counts as negative; without a group there is always one row (AUC
    NULL where a class is missing).
    """
    g = [F.struct(F.col(group).alias("v")).alias("_g")] if group else [F.struct(F.lit(0).alias("v")).alias("_g")]
    y = F.coalesce(_q(label).cast("int") == 1, F.lit(False))
    base = df.select(*g, _q(score_col).cast("double").alias("_s"),
                     y.cast("long").alias("_p"), (~y).cast("long").alias("_n"))
    per_score = base.groupBy("_g", "_s").agg(F.sum("_p").alias("pos"), F.sum("_n").alias("neg"))
    ranged = per_score.repartitionByRange("_g", "_s").withColumn("_r", F.spark_partition_id())
    before = Window.unboundedPreceding
    in_range = Window.partitionBy("_g", "_r").orderBy("_s").rowsBetween(before, -1)
    own = F.col("pos") * (2 * F.coalesce(F.sum("neg").over(in_range), F.lit(0)) + F.col("neg"))
    per_range = (ranged.select("_g", "_r", "pos", "neg", own.alias("own")).groupBy("_g", "_r")
                 .agg(F.sum("own").alias("own"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    earlier = Window.partitionBy("_g").orderBy("_r").rowsBetween(before, -1)
    below = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    out = (per_range.select("_g", "pos", "neg", (F.col("own") + 2 * F.col("pos") * below).alias("u2"))
           .groupBy("_g").agg(F.sum("u2").alias("_u2"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")))
    if not group:  # no rows: one row all the same
        out = out.agg(F.sum("_u2").alias("_u2"), F.coalesce(F.sum("n_pos"), F.lit(0)).alias("n_pos"),
                      F.coalesce(F.sum("n_neg"), F.lit(0)).alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("_u2").cast("double")
                 / (2 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))
    cols = [F.col("_g.v").alias(group)] if group else []
    return out.select(*cols, auc.alias("auc"), F.col("n_pos").cast("long"),
                      F.col("n_neg").cast("long"))


def feature_importance(spark: SparkSession, model: GBTClassificationModel,
                       names: Sequence[str], k: int = 20) -> DataFrame:
    """Top ``k`` features by MLlib importance (a vector of the model's size,
    not of the data)."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp, strict=True)]
    df = literal_rows(spark, _IMPORTANCE, rows)
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def append_run_log(tracking: Mapping[str, DataFrame], base: str) -> None:
    """Append a run's rows to the tracking tables at ``base``; an experiment that
    is there already is not written again."""
    for name, df in tracking.items():
        path = f"{base.rstrip('/')}/{name}"
        if name == "experiments":
            known = read_if_there(lambda: df.sparkSession.read.parquet(path))
            if known is not None:
                df = df.join(known, "experiment_id", "left_anti")
                if df.isEmpty():
                    continue
        df.write.mode("append").parquet(path)


def run_log(spark: SparkSession, experiment: str, params: Mapping[str, object],
            metrics: DataFrame, run_id: str | None = None,
            start: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Tracking rows of one run: ``runs``, ``experiments``, ``latest_metrics``
    (key/value), shaped like the tables the reporting pivot reads.
    ``metrics`` is a one-row DataFrame; its columns become metric keys."""
    run_id = run_id or uuid.uuid4().hex
    start = start or dt.datetime.now(dt.timezone.utc)
    exp_id = zlib.crc32(experiment.encode("utf-8"))
    runs = literal_rows(spark, _RUNS, [(run_id, exp_id, int(start.timestamp() * 1000), "active",
                                         "FINISHED")])
    experiments = literal_rows(spark, _EXPERIMENTS, [(exp_id, experiment)])
    numeric = [c for c, t in metrics.dtypes if t in ("int", "bigint", "double", "float")]
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value"))
                        for c in numeric])
    latest = metrics.select(F.lit(run_id).alias("run_uuid"), F.inline(entries))
    param_rows = literal_rows(spark, _PARAMS, [(run_id, k, str(v)) for k, v in params.items()])
    return {"runs": runs, "experiments": experiments, "latest_metrics": latest,
            "params": param_rows}

