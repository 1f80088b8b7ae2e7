"""Early stopping on AUC, staged margins, and models kept as files."""

import math
import random

import pytest
from pyspark.sql import functions as F

from leadlake.operators import boosting, ml
from leadlake.plans.training import score_stored
from leadlake.sinks.models import load_model, save_model


@pytest.mark.parametrize("aucs, patience, want", [
    ([.5, .6, .7, .7, .7, .69], 3, (2, 5)),          # an equal AUC is no gain
    ([.5, .6, .7, .7, .71, .7], 3, (4, None)),       # a gain in time starts the count anew
    ([.9, .8, .8], 2, (0, 2)),
    ([.5, .6], 10, (1, None)),
    ([None, .5, None, None], 2, (1, 3)),             # a missing AUC is no gain
    ([None, None, None], 2, (0, 2)),
    ([float(k) for k in range(30)], 1, (29, None)),
    ([.5] * 12, 10, (0, 10)),
])
def test_stop_rule(aucs, patience, want):
    assert boosting.stop_rule(aucs, patience) == want


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        a, b = rng.random(), rng.random()
        rows.append((i, a, b, float(rng.random() < 1 / (1 + math.exp(-6 * (a - b))))))
    df = ml.assemble(spark.createDataFrame(rows, "id int, a double, b double, label double"), ["a", "b"])
    return df.where("id % 4 <> 0"), df.where("id % 4 = 0")


def test_staged_margins_are_those_of_every_prefix(spark, data):
    train, test = data
    model = ml.train_gbt(train, max_iter=6, max_depth=2)
    staged = {r["id"]: r["margins"] for r in boosting.staged_margins(model, test, ["id"]).collect()}
    for rounds in (1, 3, 6):
        part = boosting.first_rounds(model, rounds)
        assert part.getNumTrees == rounds
        for r in ml.score(part, test, keep=["id"]).collect():
            assert abs(1 / (1 + math.exp(-2 * staged[r["id"]][rounds - 1])) - r["probability"]) < 1e-12
    aucs = boosting.staged_auc(model, test)
    for k in (0, 5):
        want = ml.auc_by_group(ml.score(boosting.first_rounds(model, k + 1), test, keep=["label"]), "label", "probability").first()["auc"]
        assert abs(aucs[k] - want) < 1e-12


def test_longer_training_begins_with_the_same_trees(data):
    train, _ = data
    short, long = (ml.train_gbt(train, max_iter=n, max_depth=2) for n in (3, 6))
    assert [t.toDebugString.split("\n", 1)[1] for t in short.trees] == [t.toDebugString.split("\n", 1)[1] for t in long.trees[:3]]


def test_training_stops_by_patience_and_keeps_true_rounds(spark, data):
    train, test = data
    model, stop = boosting.train_patiently(train, test, patience=2, max_iter=40, max_depth=2)
    best, stopped = boosting.stop_rule(stop.aucs, 2)
    assert (stop.best, stop.last) == (best, stopped if stopped is not None else 39)
    assert len(stop.aucs) == stop.last + 1 == model.getNumTrees and stop.last < 39
    kept, again = boosting.train_patiently(train, test, patience=2, max_iter=40, max_depth=2, keep="best")
    assert again == stop and kept.getNumTrees == stop.best + 1
    short, cut = boosting.train_patiently(train, test, patience=10, max_iter=3, max_depth=2)
    assert cut.last == 2 and short.getNumTrees == 3


def test_stored_model_scores_as_the_one_in_memory(spark, data, tmp_path):
    train, test = data
    base = str(tmp_path / "model")
    contract = {"id": "id", "label": "label", "features": ["a", "b"], "threshold": 0.3}
    models = [boosting.first_rounds(ml.train_gbt(train, max_iter=4, max_depth=2), n) for n in (3, 4)]
    versions = [save_model(spark, base, m, contract) for m in models]
    current, older = load_model(spark, base), load_model(spark, base, versions[0])
    assert current.version == versions[1] and current.contract == contract
    rows = test.select("id", "a", "b")
    for stored, model in ((current, models[1]), (older, models[0])):
        want = {r["id"]: (r["probability"], r["prediction"]) for r in ml.score(model, test, 0.3, keep=["id"]).collect()}
        assert {r["id"]: (r["probability"], r["prediction"]) for r in score_stored(stored, rows).collect()} == want
    with pytest.raises(ValueError, match="not there"):
        score_stored(current, rows.drop("b"))
    with pytest.raises(ValueError, match="lacks"):
        save_model(spark, base, models[0], {"id": "id"})
    with pytest.raises(ValueError, match="features"):
        save_model(spark, base, models[0], {**contract, "features": ["a"]})
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))


def test_feature_gone_from_the_rows_is_null_filled_by_training_only(spark, data):
    """Missing values are not missing columns: NULL features score, as the matrix fills them."""
    train, test = data
    model = ml.train_gbt(train, max_iter=2, max_depth=2)
    rows = test.select("id", F.lit(None).cast("double").alias("a"), "b", "label")
    matrix = ml.training_matrix(rows, "id", "label", ["a", "b"])
    assert ml.score(model, ml.assemble(matrix, ["a", "b"]), keep=["id"]).where("probability IS NULL").count() == 0
