"""Write, audit, publish; expectations in one aggregate; the level dictionary; stored profiles."""

import math

import pytest
from pyspark.sql import functions as F

from leadlake.operators.expectations import Expectations, check
from leadlake.operators.features import column_means, feature_profile
from leadlake.operators.levels import apply_levels, fit_levels, load_levels
from leadlake.operators.profile_store import store_profiles, window_profile
from leadlake.plans.inspect import main_plan
from leadlake.plans.publish import audits, publish_audited
from leadlake.sinks.lake import current_table_version

RULES = Expectations("m", ["k", "x"], "k", {"x": [0, 1]}, at_least_rows=2)


def rows(spark, values):
    return spark.createDataFrame(values, "k long, x int")


def test_expectations_count_what_fails(spark):
    df = rows(spark, [(1, 0), (1, 1), (1, 2), (2, None), (None, 0), (None, 5), (3, 5)])
    got = {(r["test"], r["column_name"]): (r["failing_rows"], r["passed"]) for r in check(df, RULES).collect()}
    assert got == {("not_null", "k"): (2, False), ("not_null", "x"): (1, False), ("unique", "k"): (2, False),
                   ("accepted_values", "x"): (3, False), ("row_count", "*"): (0, True)}
    empty = {r["test"]: r["failing_rows"] for r in check(rows(spark, []), RULES).collect()}
    assert empty == {"not_null": 0, "unique": 0, "accepted_values": 0, "row_count": 2}


def test_expectations_are_one_aggregate_over_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, [(1, 0), (2, 1)]).write.parquet(path)
    tree = main_plan(check(spark.read.parquet(path), RULES)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Expand" not in tree and "Join" not in tree and "Union" not in tree


def test_a_bad_version_is_not_published(spark, tmp_path):
    base = str(tmp_path / "t")
    bad, good = rows(spark, [(1, 0), (1, 7)]), rows(spark, [(1, 0), (2, 1)])
    first = publish_audited(bad, base, RULES)
    assert not first.published and current_table_version(spark, base) is None
    second = publish_audited(good, base, RULES)
    third = publish_audited(bad, base, RULES)
    assert second.published and not third.published and current_table_version(spark, base) == second.version
    kept = audits(spark, base)
    assert {r["version"]: r["published"] for r in kept.select("version", "published").distinct().collect()} == {
        first.version: False, second.version: True, third.version: False}
    assert kept.where("NOT passed").count() == 4
    broken = good.withColumn("x", F.when(F.col("k") == 2, F.raise_error(F.lit("boom")).cast("int")).otherwise(0))
    with pytest.raises(Exception, match="boom"):
        publish_audited(broken, base, RULES)
    assert current_table_version(spark, base) == second.version


def test_columns_agree_when_levels_are_new_or_gone(spark, tmp_path):
    base = str(tmp_path / "levels")
    def frame(levels):
        return spark.createDataFrame([(i, v) for i, v in enumerate(levels)], "id int, c string")
    train, score = frame(["b", "a", "a", None, "z z"]), frame(["b", "new", None, "b"])
    version = fit_levels(train, ["c"], base)
    levels = load_levels(spark, base, ["c"])
    assert levels == {"c": ["a", "b", "z z"]}
    fitted, applied = (apply_levels(df, levels) for df in (train, score))
    assert fitted.columns == applied.columns and len(applied.columns) == 5
    assert [tuple(r)[2:] for r in applied.orderBy("id").collect()] == [(0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 1, 0)]
    flagged = apply_levels(score, levels, unseen="column", keep=["id"]).orderBy("id").collect()
    assert [r["c__unseen"] for r in flagged] == [0, 1, 0, 0]
    with pytest.raises(Exception, match="lacks"):
        apply_levels(score, levels, unseen="error").collect()
    assert apply_levels(train, levels, unseen="error").count() == 5
    fit_levels(score, ["c"], base)  # a later fit; the model's version can still be read
    assert load_levels(spark, base, ["c"], version) == levels
    assert load_levels(spark, base, ["c"]) == {"c": ["b", "new"]}


def test_dictionary_errors(spark, tmp_path):
    base = str(tmp_path / "levels")
    df = spark.createDataFrame([(str(i),) for i in range(5)] + [("a b",), ("a_b",)], "c string")
    with pytest.raises(ValueError, match="more than 3"):
        fit_levels(df, ["c"], base, max_levels=3)
    with pytest.raises(ValueError, match="share"):
        fit_levels(df, ["c"], base)
    with pytest.raises(FileNotFoundError):
        load_levels(spark, base, ["c"])
    with pytest.raises(ValueError):
        apply_levels(df, {"c": ["a"]}, unseen="guess")
    nothing = df.where("false")
    fit_levels(nothing, ["c"], base)
    assert apply_levels(df, load_levels(spark, base, ["c"]), unseen="column").columns == ["c", "c__unseen"]


def test_window_profile_without_a_rescan(spark, tmp_path):
    base = str(tmp_path / "profiles")
    df = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("ingestion_date"),
        (F.col("id") % 20_011).alias("many"), (F.col("id") % 7 * 0.5).alias("few"), F.lit(1.0).alias("same"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(None).cast("double")).alias("none"))
    cols = ["many", "few", "same", "none"]
    early = F.col("ingestion_date") < "2024-01-06"
    store_profiles(df.where(early), cols, base)
    store_profiles(df.where(~early), cols, base)
    store_profiles(df.where(F.col("ingestion_date") == "2024-01-03"), cols, base)  # a date comes again
    for start, end in ((None, None), ("2024-01-03", "2024-01-08"), ("2024-01-04", "2024-01-04")):
        got = {r["feature"]: r for r in window_profile(spark, base, start, end).collect()}
        part = df.where(F.col("ingestion_date").between(start or "2024-01-01", end or "2024-12-31"))
        for want in feature_profile(part, cols).collect():
            r = got[want["feature"]]
            assert (r["min_value"], r["max_value"], r["is_constant"]) == (want["min_value"], want["max_value"], want["is_constant"])
            assert abs(r["n_distinct"] - want["n_distinct"]) <= 0.03 * want["n_distinct"]
            assert r["n_values"] + r["n_nulls"] == part.count()
    assert window_profile(spark, base, "2030-01-01").count() == 0
    assert "PartitionFilters: [isnotnull(ingestion_date" in main_plan(window_profile(spark, base, "2024-01-03", "2024-01-08"))


def test_means_of_values_a_decimal_cannot_hold(spark):
    df = spark.createDataFrame([(1e20, float("inf"), 1.5, float("nan")), (3e20, 1.0, 2.5, 1.0), (None, None, None, None)],
                               "big double, inf double, plain double, nan double")
    got = column_means(df, df.columns).first()
    assert (got["big"], got["inf"], got["plain"]) == (2e20, float("inf"), 2.0) and math.isnan(got["nan"])
    many = spark.range(300).select((F.lit(9e18) + F.col("id") * 0).cast("bigint").alias("n"), F.lit(9e19).alias("x"))
    got = column_means(many, ["n", "x"]).first()
    assert abs(got["n"] / 9e18 - 1) < 1e-12 and abs(got["x"] / 9e19 - 1) < 1e-12
