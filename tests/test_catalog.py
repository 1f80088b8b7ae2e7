from leadlake.plans.catalog import register_lake_views


def test_sql_over_registered_views(spark, sf_small, tmp_path):
    names = register_lake_views(spark, sf_small, reporting_base=str(tmp_path / "reporting"))
    assert "leads_gold_features" in names and "v_dashboard_model_metrics" in names
    counts = spark.sql("""
        SELECT 'leads_silver' AS t, count(*) AS n FROM leads_silver
        UNION ALL SELECT 'leads_gold_features', count(*) FROM leads_gold_features
        UNION ALL SELECT 'leads_gold_sin_converted', count(*) FROM leads_gold_sin_converted
    """).collect()
    n = {r["t"]: r["n"] for r in counts}
    assert n["leads_silver"] == n["leads_gold_features"] == n["leads_gold_sin_converted"] > 0
    assert spark.sql("SELECT count(*) FROM v_dashboard_model_metrics").collect()[0][0] == 0
    tags = spark.sql("SELECT DISTINCT tags_bucket FROM leads_gold_typed").collect()
    assert {r[0] for r in tags} <= {"Already a student", "Closed by Horizzon",
                                    "Interested in other courses", "Ringing",
                                    "Will revert after reading the email", "Other Tags", "Unknown"}
