from pyspark.sql import functions as F

from leadlake.functions.categories import bucket_categories, hash_bucket, weighted_category
from leadlake.functions.numeric import accuracy, clamp, f1_score, safe_ratio
from leadlake.functions.text import clean_text, safe_name, safe_name_col


def test_safe_name_python_and_column_agree(spark):
    values = ["Thane & Outskirts", "Will revert (after) reading", "a/b-c.d,e'f\"g"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(safe_name_col("p", "v")).collect()]
    assert got == [safe_name("p", v) for v in values]
    assert safe_name("City", "Thane & Outskirts") == "city__thane_and_outskirts"


def test_clean_text_strips_unicode_blanks(spark):
    df = spark.createDataFrame([("  Mumbai　",), ("   ",), ("\tx",), (None,)], "v string")
    assert [r[0] for r in df.select(clean_text("v")).collect()] == ["Mumbai", None, "\tx", None]


def test_bucket_null_handling(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    with_null = [r[0] for r in df.select(bucket_categories("v", ["a"], "O", "U")).collect()]
    without = [r[0] for r in df.select(bucket_categories("v", ["a"], "O")).collect()]
    assert with_null == ["a", "O", "U"] and without == ["a", "O", "O"]


def test_numeric_guards(spark):
    df = spark.createDataFrame([(10, 0, None), (10, None, 2.5), (9, 3, 100.0)],
                               "n int, d int, x double")
    rows = df.select(safe_ratio("n", "d").alias("r"), clamp("x", 0.0, 20.0).alias("c")).collect()
    assert [r["r"] for r in rows] == [None, None, 3.0]
    assert [r["c"] for r in rows] == [None, 2.5, 20.0]
    m = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, 0.0, 0.0), (0.5, None, 0.0, 0.0, 0.0, 0.0)],
                              "p double, r double, tp double, tn double, fp double, fn double")
    out = m.select(f1_score("p", "r").alias("f1"), accuracy("tp", "tn", "fp", "fn").alias("a"))
    assert [tuple(r) for r in out.collect()] == [(None, 1.0), (None, None)]


def test_weighted_category_is_deterministic_and_weighted(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    w = {"x": 70, "y": 20, "z": 10}
    a = df.select("k", weighted_category("k", w, 7).alias("v"))
    b = df.repartition(13).select("k", weighted_category("k", w, 7).alias("v"))
    assert a.exceptAll(b).count() == 0
    share = {r["v"]: r["count"] / 20000 for r in a.groupBy("v").count().collect()}
    assert abs(share["x"] - 0.7) < 0.02 and abs(share["z"] - 0.1) < 0.02
    buckets = df.select(hash_bucket("k", 1, 100).alias("b")).agg(F.min("b"), F.max("b")).collect()
    assert tuple(buckets[0]) == (0, 99)
