import itertools
import random

from pyspark.sql import functions as F

from leadlake.operators import ml, split


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    total = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return total / (len(pos) * len(neg))


def test_auc_matches_brute_force_across_buckets(spark):
    rng = random.Random(3)
    data = [(g, round(rng.random(), 2), int(rng.random() < 0.3 + 0.4 * (g == "b")))
            for g in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame(data, "g string, s double, y int")
    got = {r["g"]: r["auc"] for r in ml.auc_by_group(df, "y", "s", "g").collect()}
    for g in ("a", "b"):
        want = brute_auc([(s, y) for gg, s, y in data if gg == g])
        assert abs(got[g] - want) < 1e-12
    whole = ml.auc_by_group(df, "y", "s").collect()[0]["auc"]
    assert abs(whole - brute_auc([(s, y) for _, s, y in data])) < 1e-12


def test_confusion_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    r = ml.confusion_metrics(df, "y", "p").collect()[0]
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (1, 2, 1, 1)
    assert r["precision"] == 0.5 and r["recall"] == 0.5
    z = ml.confusion_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").collect()[0]
    assert z["precision"] == 0.0 and z["recall"] == 0.0


def test_hash_split_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    a = ml.hash_split(df, "key", {"train": 80, "test": 20})
    b = ml.hash_split(df.repartition(7), "key", {"train": 80, "test": 20})
    assert a.exceptAll(b).count() == 0
    share = a.where("split = 'train'").count() / 5000
    assert 0.77 < share < 0.83


def test_training_matrix_fills(spark):
    df = spark.createDataFrame([(1, None, None, 1), (2, 2.0, 1, None)],
                               "id int, f double, d int, y int")
    rows = {r["id"]: r for r in ml.training_matrix(df, "id", "y").collect()}
    assert rows[1]["f"] != rows[1]["f"] and rows[1]["d"] == 0.0 and rows[2]["label"] == 0.0


def test_small_gbt_train_score_importance(spark):
    rng = random.Random(5)
    rows = [(i, float(rng.random()), float(rng.random())) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double").withColumn(
        "label", (F.col("a") > 0.5).cast("double"))
    data = ml.assemble(df, ["a", "b"])
    model = ml.train_gbt(data, max_iter=5, max_depth=2)
    scored = ml.score(model, data, keep=["id", "label"])
    acc = scored.where("prediction = label").count() / 300
    assert acc > 0.9
    imp = ml.feature_importance(spark, model, ["a", "b"], k=1).collect()
    assert imp[0]["feature"] == "a"
    log = ml.run_log(spark, "exp", {"depth": 2}, ml.confusion_metrics(scored, "label", "prediction"))
    assert {r["key"] for r in log["latest_metrics"].collect()} >= {"tp", "precision"}


def test_auc_plan_has_four_exchanges_and_no_join(spark):
    from leadlake.plans.inspect import main_plan
    df = spark.range(1000).selectExpr("id % 3 AS g", "id % 2 AS y", "(id % 97) / 97.0 AS s")
    tree = main_plan(ml.auc_by_group(df, "y", "s", "g")).split("\n\n")[0]
    assert tree.count("Exchange") <= 4 and "Join" not in tree and "SinglePartition" not in tree


def test_pivot_aggregates_metrics_before_join(spark):
    from leadlake.operators import reporting
    from leadlake.plans.inspect import plan_text
    runs = spark.createDataFrame([("r1", 1, 0, "active", "FINISHED")],
                                 "run_uuid string, experiment_id long, start_time long, "
                                 "lifecycle_stage string, status string")
    exps = spark.createDataFrame([(1, "e")], "experiment_id long, name string")
    metrics = spark.createDataFrame([("r1", "auc", 0.5)], "run_uuid string, key string, value double")
    plan = plan_text(reporting.pivot_run_metrics(runs, exps, metrics))
    tree = plan.split("\n\n")[0]
    # the HashAggregate sits under the outer join's build side, not above the join
    assert tree.index("Join LeftOuter") < tree.index("HashAggregate")


def test_auc_keeps_null_group_and_empty_input(spark):
    df = spark.createDataFrame([("x", 0.9, 1), ("x", 0.1, 0), (None, 0.2, 1), (None, 0.7, 0), (None, 0.7, None)],
                               "g string, s double, y int")
    got = {r["g"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in ml.auc_by_group(df, "y", "s", "g").collect()}
    assert got == {"x": (1.0, 1, 1), None: (0.0, 1, 2)}
    none = ml.auc_by_group(df.limit(0), "y", "s").collect()
    assert [(r["auc"], r["n_pos"], r["n_neg"]) for r in none] == [(None, 0, 0)]


def test_null_key_is_in_a_part(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "key long")
    assert ml.hash_split(df, "key", {"train": 80, "test": 20}).where("split IS NULL").count() == 0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,), (None,)], "p double")
    assert [r[0] for r in df.select(ml.classify(F.col("p"))).collect()] == [0, 1, 0]


def test_experiment_is_logged_once(spark, tmp_path):
    metrics = spark.createDataFrame([(0.5,)], "auc double")
    for run in ("a", "b", "c"):
        ml.append_run_log(ml.run_log(spark, "exp", {"x": 1}, metrics, run), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "experiments")).count() == 1
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 3


def _materialize(tmp_path):
    def write(df):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    return write


def test_exact_split_takes_exactly_its_share(spark, tmp_path):
    """Unique keys, one key for all rows, equal rows, NULL keys, shares of 0 and 1, no rows."""
    write = _materialize(tmp_path)
    unique = spark.range(1003).withColumnRenamed("id", "key")
    for df, share in ((unique, 0.8), (unique, 0.0), (unique, 1.0), (unique.limit(1), 0.8), (unique.limit(0), 0.8),
                      (unique.withColumn("key", F.lit(7)), 0.8), (unique.withColumn("key", F.lit(None).cast("long")), 0.5),
                      (unique.withColumn("key", F.col("key") % 3), 0.37)):
        n = df.count()
        out = split.exact_split(df, "key", share, write)
        assert out.columns == ["key", "split"]
        assert (out.where("split = 'train'").count(), out.count()) == (int(share * n), n)
    tied = unique.selectExpr("if(key % 4 = 0, NULL, key) AS key", "key AS other")
    a, b = (split.exact_split(t, "key", 0.9, write, ties=["other"]) for t in (tied, tied.repartition(7)))
    assert a.exceptAll(b).count() == 0 and a.where("split = 'train'").count() == int(0.9 * 1003)


def test_exact_split_is_the_front_of_the_hash_order(spark, tmp_path):
    import hashlib
    keys = [str(i) for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r["key"] for r in split.exact_split(df, "key", 0.3, _materialize(tmp_path), seed=9).where("split = 'train'").collect()}
    order = sorted(keys, key=lambda k: hashlib.md5(f"9|{k}".encode()).hexdigest()[:15])
    assert got == set(order[:150])
