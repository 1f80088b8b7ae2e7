"""Early stopping of boosted trees on the AUC, from the margins of the ensemble's prefixes.

MLlib stops on the validation loss. Here an ensemble is trained for a number of rounds,
and every evaluation row gets its margin after each of them in one pass (the running sum
of its weighted trees). The AUC of each round follows from those margins, the rule looks
at the series, and the model that stays is the ensemble's first rounds. As a round's
tree depends on the seed and the rounds before it only, a longer training begins with
the same trees: if the rule does not stop within the rounds trained, twice as many are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.operators.ml import auc_by_group, train_gbt


@dataclass(frozen=True)
class EarlyStop:
    """Rounds count from 0: the best one, the last one evaluated, and the AUC after each."""
    best: int
    last: int
    aucs: tuple[float | None, ...]


def stop_rule(aucs: Sequence[float | None], patience: int) -> tuple[int, int | None]:
    """(best round, round in which training stops or None): the first round of the highest AUC, and the
    first one that lies ``patience`` rounds after the best so far. A missing AUC is no gain."""
    best, highest = 0, float("-inf")
    for k, auc in enumerate(aucs):
        if auc is not None and auc > highest:
            best, highest = k, auc
        elif k - best >= patience:
            return best, k
    return best, None


def staged_margins(model: GBTClassificationModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``margins``: the ensemble's margin after every round."""
    trees = model.trees
    for k, tree in enumerate(trees):
        df = tree.setPredictionCol(f"_tree{k}").transform(df)
    steps = F.array(*[F.col(f"_tree{k}") * F.lit(float(w)) for k, w in zip(range(len(trees)), model.treeWeights)])
    sums = F.transform(F.sequence(F.lit(1), F.lit(len(trees))),
                       lambda n: F.aggregate(F.slice("_steps", F.lit(1), n), F.lit(0.0), lambda x, y: x + y))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], steps.alias("_steps"))
    return rows.select(*[F.col(f"`{c}`") for c in keep], sums.alias("margins"))


def staged_auc(model: GBTClassificationModel, df: DataFrame, label: str = "label") -> list[float | None]:
    """The AUC after every round (None where a class is missing): a value per round reaches the driver."""
    rows = staged_margins(model, df, [label]).select(label, F.posexplode("margins").alias("round", "margin"))
    found = {r["round"]: r["auc"] for r in auc_by_group(rows, label, "margin", "round").collect()}
    return [found.get(k) for k in range(model.getNumTrees)]


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble of the first ``rounds`` trees."""
    if rounds == model.getNumTrees:
        return model
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    jvm = gateway.jvm
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = java.trees()[k], float(java.treeWeights()[k])
    shorter = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), 2)
    return GBTClassificationModel(shorter)


def train_patiently(train: DataFrame, evaluation: DataFrame, label: str = "label", patience: int = 10,
                    max_iter: int = 100, keep: str = "last", **options) -> tuple[GBTClassificationModel, EarlyStop]:
    """Boosted trees that stop once the AUC on ``evaluation`` has not grown for ``patience`` rounds.

    The model ends with the round in which it stopped (``keep="last"``) or with the best one (``"best"``)."""
    if keep not in ("last", "best"):
        raise ValueError("keep must be 'last' or 'best'")
    rounds = min(max_iter, 2 * patience)
    while True:
        model = train_gbt(train, label, max_iter=rounds, **options)
        aucs = staged_auc(model, evaluation, label)
        best, stopped = stop_rule(aucs, patience)
        if stopped is not None or rounds >= max_iter:
            break
        rounds = min(max_iter, 2 * rounds)
    last = stopped if stopped is not None else len(aucs) - 1
    return first_rounds(model, (best if keep == "best" else last) + 1), EarlyStop(best, last, tuple(aucs[:last + 1]))
