import math

from pyspark.sql import functions as F

from leadlake.operators.features import (distinct_levels, feature_profile, impute_mean,
                                         one_hot_dynamic)
from leadlake.plans import lakehouse as lh
from leadlake.plans.gold import gold_features, gold_inference, gold_typed
from leadlake.plans.inspect import main_plan, plan_text
from leadlake.schemas import GOLD_DUMMIES, GOLD_FEATURES, GOLD_ID, GOLD_LABEL


def test_impute_mean_fills_with_whole_set_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, None)], "id int, x double")
    out = {r["id"]: r["x"] for r in impute_mean(df, ["x"]).collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 3.0, 4: 2.0}
    plan = plan_text(impute_mean(df, ["x"]))
    # the mean is a scalar subquery: no window over a single partition in the main plan
    assert "Window" not in main_plan(impute_mean(df, ["x"]))
    assert "Subquery" in plan


def test_gold_invariants(spark, sf_small):
    silver = lh.silver_table(spark, sf_small)
    gold = gold_features(silver)
    assert gold.columns[0] == GOLD_ID and gold.columns[-1] == GOLD_LABEL
    assert gold.count() == silver.count()
    nulls = gold.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in gold.columns])
    assert all(v == 0 for v in nulls.collect()[0])
    for name, _, _ in GOLD_DUMMIES:
        vals = {r[0] for r in gold.select(F.col(f"`{name}`")).distinct().collect()}
        assert vals <= {0, 1}
    assert gold.groupBy(F.col(f"`{GOLD_ID}`")).count().where("count > 1").count() == 0
    assert GOLD_LABEL not in gold_inference(gold).columns
    plan = main_plan(gold)
    assert "SinglePartition" not in plan


def test_gold_typed_buckets(spark, sf_small):
    typed = gold_typed(lh.silver_table(spark, sf_small))
    levels = {r[0] for r in typed.select("city_bucket").distinct().collect()}
    assert levels <= {"Mumbai", "Other Cities"}
    acts = {r[0] for r in typed.select("last_notable_activity_bucket").distinct().collect()}
    assert acts <= {"Modified", "SMS Sent", "Other Activity"}


def test_one_hot_dynamic_and_bound(spark):
    df = spark.createDataFrame([(1, "B b"), (2, "a-A"), (3, None), (4, "B b")], "id int, c string")
    out = one_hot_dynamic(df, "c", "cat", keep=["id"])
    assert out.columns == ["id", "cat__b_b", "cat__a_a"]  # ascending byte order
    rows = {r["id"]: (r["cat__a_a"], r["cat__b_b"]) for r in out.collect()}
    assert rows == {1: (0, 1), 2: (1, 0), 3: (0, 0), 4: (0, 1)}
    dropped = one_hot_dynamic(df, "c", "cat", drop_first=True, keep=["id"])
    assert dropped.columns == ["id", "cat__a_a"]
    try:
        distinct_levels(df, "c", max_levels=1)
        raise AssertionError("expected the level bound to trip")
    except ValueError:
        pass


def test_feature_profile(spark):
    df = spark.createDataFrame([(1.0, 0, float("nan")), (2.0, 0, None), (2.0, 0, 5.0)],
                               "a double, b int, c double")
    out = {r["feature"]: r for r in feature_profile(df, ["a", "b", "c"]).collect()}
    assert (out["a"]["min_value"], out["a"]["max_value"], out["a"]["n_distinct"]) == (1.0, 2.0, 2)
    assert out["b"]["is_constant"] and out["c"]["n_distinct"] == 1
    assert not math.isnan(out["c"]["max_value"])
    assert set(out) == {"a", "b", "c"}
    assert len(GOLD_FEATURES) == 11


def test_feature_profile_approx_agrees_on_small_data(spark):
    df = spark.createDataFrame([(1.0, 0, float("nan")), (2.0, 0, None), (2.0, 0, 5.0)],
                               "a double, b int, c double")
    exact = {r["feature"]: tuple(r) for r in feature_profile(df, ["a", "b", "c"]).collect()}
    approx = {r["feature"]: tuple(r) for r in
              feature_profile(df, ["a", "b", "c"], approx=True).collect()}
    assert exact == approx


def test_shuffle_partitions_for():
    from leadlake.session import shuffle_partitions_for
    assert shuffle_partitions_for(10) == 200
    assert shuffle_partitions_for(100 * 1024 ** 4) == 409601


def test_profile_has_a_row_for_a_feature_without_values(spark):
    from leadlake.operators.features import feature_profile
    df = spark.createDataFrame([(1.0, None), (float("nan"), None)], "a double, b double")
    for approx in (False, True):
        got = {r["feature"]: (r["n_distinct"], r["is_constant"]) for r in feature_profile(df, ["a", "b"], approx).collect()}
        assert got == {"a": (1, True), "b": (0, True)}
    assert feature_profile(df.limit(0), ["a", "b"]).count() == 2


def test_dummy_names_that_collide_are_an_error(spark):
    import pytest

    from leadlake.operators.features import one_hot_dynamic, one_hot_long
    df = spark.createDataFrame([(1, "a b"), (2, "a-b"), (3, None)], "id int, p string")
    with pytest.raises(ValueError, match="both become column"):
        one_hot_dynamic(df, "p", "p")
    assert sorted(map(tuple, one_hot_long(df, "p", "p", "id").collect())) == [(1, "p__a_b"), (2, "p__a_b")]


def test_means_of_whole_numbers_and_nan(spark):
    from leadlake.operators.features import column_means
    df = spark.createDataFrame([(9_007_199_254_740_993, 1.0), (1, float("nan")), (None, None)], "i long, f double")
    r = column_means(df, ["i", "f"]).first()
    assert r["i"] == 4503599627370497.0 and r["f"] != r["f"]
