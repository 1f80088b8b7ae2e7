"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / composite of the lakehouse. Each reads the test tables (or data
Spark derives from them) in full."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake import fixtures
from leadlake.functions.categories import bucket_categories, weighted_category
from leadlake.functions.numeric import clamp
from leadlake.functions.text import safe_name_col
from leadlake.functions.timefmt import add_seconds, iso_utc
from leadlake.operators import levels, ml, profile_store, quality, reporting
from leadlake.operators.bronze import transform_to_bronze
from leadlake.operators.features import (clean_text_columns, feature_profile, impute_mean,
                                        one_hot_dynamic, one_hot_long)
from leadlake.operators.silver import dedup_latest, parse_messages
from leadlake.operators.split import exact_split
from leadlake.plans import lakehouse as lh
from leadlake.plans import catalog, publish
from leadlake.plans.checks import check_parity, validate_partition, verify_export
from leadlake.plans import streaming as stream_plan
from leadlake.plans import training
from leadlake.plans.gold import NUMERIC, TEXT, gold_base, gold_inference, gold_typed
from leadlake.schemas import (BRONZE_SCHEMA, CITY_WEIGHTS, CONVERTED_WEIGHTS, GOLD_ACCEPTED, GOLD_FEATURES, GOLD_ID,
                              GOLD_LABEL, GOLD_NOT_NULL, INFERENCE_NOT_NULL, LEAD_ORIGIN_WEIGHTS,
                              OCCUPATION_KEEP, OCCUPATION_OTHER, REPORTING_SCHEMA, SILVER_NOT_NULL, TAGS_KEEP,
                              TAGS_OTHER, UNKNOWN)
from leadlake.sinks.lake import current_table_version, export_with_run_date
from leadlake.sinks.models import load_model
from leadlake.sources.lake import read_immutable_parquet, read_partition, trailing_window, with_retry
from leadlake.sources.messages import MessageSource, read_message_batch

Query = Callable[[SparkSession, str], DataFrame]
BRONZE_COLS = ["kafka_key", "raw_json", "kafka_timestamp", "ingestion_date"]


def q_bronze_transform(spark, sf):
    return transform_to_bronze(lh.messages(spark, sf))


def q_bronze_transform_override(spark, sf):
    return transform_to_bronze(lh.messages(spark, sf), "2024-01-15")


def q_scan_partitioned(spark, sf):
    return lh.bronze_table(spark, sf).select(*BRONZE_COLS)


def q_scan_date_window(spark, sf):
    return lh.bronze_table(spark, sf, "2024-01-05", "2024-01-20").select(*BRONZE_COLS)


def q_scan_trailing_window(spark, sf):
    start, end = trailing_window("2024-01-20", 10)
    return lh.bronze_table(spark, sf, start, end).select(*BRONZE_COLS)


def q_json_parse_typed(spark, sf):
    return parse_messages(lh.bronze_table(spark, sf))


def q_silver_leads(spark, sf):
    return lh.silver(spark, sf)


def q_dedup_latest(spark, sf):
    parsed = parse_messages(lh.bronze_table(spark, sf))
    latest = dedup_latest(parsed, "lead_number", ["ingestion_time", "kafka_timestamp"])
    return latest.select("lead_number", "ingestion_time", "kafka_timestamp", "kafka_key",
                         "converted")


def q_impute_mean(spark, sf):
    s = lh.silver_table(spark, sf).select("lead_number", *NUMERIC)
    return impute_mean(s, NUMERIC)


def q_clean_text(spark, sf):
    s = lh.silver_table(spark, sf).select("lead_number", *TEXT)
    return clean_text_columns(s, TEXT)


def q_bucket_tags(spark, sf):
    return (gold_base(lh.silver_table(spark, sf))
            .select("lead_number", "tags",
                    bucket_categories("tags", TAGS_KEEP, TAGS_OTHER, UNKNOWN).alias("tags_bucket")))


def q_bucket_occupation(spark, sf):
    return (gold_base(lh.silver_table(spark, sf))
            .select("lead_number", "current_occupation",
                    bucket_categories("current_occupation", OCCUPATION_KEEP, OCCUPATION_OTHER,
                                      UNKNOWN).alias("current_occupation_bucket")))


def q_gold_features(spark, sf):
    return lh.gold(spark, sf)


def q_gold_typed(spark, sf):
    return gold_typed(lh.silver_table(spark, sf))


def q_gold_inference(spark, sf):
    return gold_inference(lh.gold(spark, sf))


# ---------------------------------------------------------------- quality

def _silver_gold(spark, sf):
    silver = lh.silver_table(spark, sf)
    gold = lh.gold(spark, sf)
    return silver, gold, gold_inference(gold)


MODELS = ("leads_silver", "leads_gold_features", "leads_gold_sin_converted")


def q_dq_not_null(spark, sf):
    silver, gold, inference = _silver_gold(spark, sf)
    return reduce(DataFrame.unionByName, [
        quality.not_null_report(silver, MODELS[0], SILVER_NOT_NULL),
        quality.not_null_report(gold, MODELS[1], GOLD_NOT_NULL),
        quality.not_null_report(inference, MODELS[2], INFERENCE_NOT_NULL)])


def q_dq_unique(spark, sf):
    silver, gold, inference = _silver_gold(spark, sf)
    return reduce(DataFrame.unionByName, [
        quality.unique_report(silver, MODELS[0], ["lead_number"]),
        quality.unique_report(gold, MODELS[1], [GOLD_ID]),
        quality.unique_report(inference, MODELS[2], [GOLD_ID])])


def q_dq_accepted_values(spark, sf):
    silver, gold, inference = _silver_gold(spark, sf)
    return reduce(DataFrame.unionByName, [
        quality.accepted_values_report(silver, MODELS[0], {"converted": [0, 1]}),
        quality.accepted_values_report(gold, MODELS[1], GOLD_ACCEPTED),
        quality.accepted_values_report(inference, MODELS[2], {"Tags_Ringing": [0, 1]})])


def q_row_count_report(spark, sf):
    return quality.row_count_report({"leads_silver": lh.silver_table(spark, sf),
                                     "leads_gold_features": lh.gold(spark, sf)})


def q_partition_report(spark, sf):
    """Every date from two days before the first message to two days after the last."""
    dates = lh.bronze_table(spark, sf).agg(F.min("ingestion_date"), F.max("ingestion_date")).first()
    pad = dt.timedelta(days=2)
    found = read_immutable_parquet(spark, lh.damaged_bronze(spark, sf))
    return quality.partition_report(found, first=dates[0] - pad, last=dates[1] + pad).select(
        "ingestion_date", "n_rows", "partition_exists")


def _snapshot(spark, sf):
    return read_message_batch(spark, MessageSource("files", path=lh.message_topic(spark, sf)))


def q_parity_check(spark, sf):
    """A bronze table with lost, repeated and missing rows: ok, warning and data_loss dates."""
    return check_parity(spark, _snapshot(spark, sf), lh.damaged_bronze(spark, sf))


def q_parity_override(spark, sf):
    """A backfill: all messages are compared with the one folder they were ingested under."""
    return check_parity(spark, _snapshot(spark, sf), lh.override_bronze(spark, sf, "2024-01-15"),
                        date_override="2024-01-15")


def q_partition_files(spark, sf):
    """File count, rows and schema verdict by date of a table that two loads wrote, a file per date each."""
    base, parts = lh.new_table_path(spark, "bronze_files"), lh.bronze_table(spark, sf).select(*BRONZE_COLS)
    even = F.col("kafka_key").cast("bigint") % 2 == 0
    for rows in (parts.where(even), parts.where(~even)):
        rows.repartition("ingestion_date").write.mode("append").partitionBy("ingestion_date").parquet(base)
    found = spark.read.parquet(base)
    one = validate_partition(spark, base, lh.run_date(spark, sf))
    return quality.partition_report(found).select(
        "ingestion_date", F.col("n_files").cast("bigint").alias("n_files"), "n_rows",
        F.lit(quality.schema_matches(found, BRONZE_SCHEMA) and one["schema_ok"]).alias("schema_ok"))


def q_relation_check(spark, sf):
    """Existence, row count and a repeatable sample of the dashboard view."""
    view = reporting.dashboard_view(reporting.read_reporting_table(spark, reporting_table(spark, sf)))
    found = quality.relation_check(view, ["run_id"], n=5)
    sample = view.where(F.col("run_id").isin([r["run_id"] for r in found["sample"]]))
    return sample.select("run_id", F.lit(found["exists"]).alias("exists"), F.lit(found["count"]).cast("bigint").alias("n_rows"),
                         F.lit(found["status"]).alias("status"))


def q_retried_read(spark, sf):
    """A table that another job has not finished writing: read again until it is there."""
    base, tries = lh.new_table_path(spark, "gold_late"), []

    def read():
        tries.append(1)
        if len(tries) == 3:  # the other job is done
            lh.gold(spark, sf).write.parquet(base)
        return spark.read.parquet(base).count()

    n = with_retry(read, tries=5, wait_seconds=0)
    return spark.range(1).select(F.lit(len(tries)).alias("tries"), F.lit(n).cast("bigint").alias("n_rows"))


def q_parity_pending(spark, sf):
    """Parity with what the stream has consumed: messages that arrived since are pending, not lost."""
    return stream_plan.parity_while_messages_arrive(spark, sf)


def q_audited_publication(spark, sf):
    """A good gold is published; a spoilt one fails its audit and the good one stays current."""
    return publish.good_then_bad_gold(lh.gold(spark, sf), lh.new_table_path(spark, "gold_audited"))


def q_export_check(spark, sf):
    """Rows exported against rows read back."""
    base, gold, day = lh.new_table_path(spark, "export_check"), lh.gold(spark, sf), lh.run_date(spark, sf)
    export_with_run_date(gold, base, day)
    check = verify_export(spark, gold, base, day)
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in check.items()])


def q_table_sample(spark, sf):
    return lh.gold(spark, sf).orderBy(F.col(f"`{GOLD_ID}`")).limit(5)


def q_gold_export(spark, sf):
    base = lh.new_table_path(spark, "gold_export")
    day = lh.run_date(spark, sf)
    export_with_run_date(lh.gold(spark, sf), base, day)
    return read_partition(spark, base, day)


def q_gold_materialized(spark, sf):
    """The gold table as written by a full refresh, read back."""
    base = lh.once(spark, "gold_table", sf, lambda p: catalog.materialize_gold(spark, sf, p))
    return spark.read.parquet(current_table_version(spark, base))


# ------------------------------------------------------------ categorical

def q_distinct_categories(spark, sf):
    part = fixtures.table(spark, sf, "part")
    return part.where(F.col("p_type").isNotNull()).select(F.col("p_type").alias("v")).distinct()


def q_one_hot_dynamic(spark, sf):
    part = fixtures.table(spark, sf, "part")
    return one_hot_dynamic(part, "p_type", "p_type", keep=["p_partkey"])


def q_one_hot_long(spark, sf):
    return one_hot_long(fixtures.table(spark, sf, "part"), "p_type", "p_type", "p_partkey")


def q_levels_applied(spark, sf):
    """The dictionary of some parts applied to others: PROMO is new there, SMALL is gone."""
    part, base = fixtures.table(spark, sf, "part"), lh.new_table_path(spark, "levels")
    fitted = (F.col("p_partkey") % 3 == 0) & (F.col("p_type") != "PROMO")
    levels.fit_levels(part.where(fitted), ["p_type"], base)
    rows = part.where((F.col("p_partkey") % 3 != 0) & (F.col("p_type") != "SMALL"))
    return levels.apply_levels(rows, levels.load_levels(spark, base, ["p_type"]), unseen="column", keep=["p_partkey"])


def q_safe_names(spark, sf):
    part = fixtures.table(spark, sf, "part")
    return part.select("p_partkey", "p_brand",
                       safe_name_col("brand", "p_brand").alias("safe_name"))


def q_clamp_round(spark, sf):
    c = fixtures.table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        clamp((F.col("c_acctbal") / 100).cast("int"), 0, 60).alias("visits_like"),
        F.round(clamp("c_acctbal", 0.0, 5000.0), 2).alias("balance_clamped"))


def q_weighted_category(spark, sf):
    c = fixtures.table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        weighted_category("c_custkey", CITY_WEIGHTS, 42).alias("city"),
        weighted_category("c_custkey", LEAD_ORIGIN_WEIGHTS, 43).alias("lead_origin"),
        weighted_category("c_custkey", CONVERTED_WEIGHTS, 44).cast("int").alias("converted"))


def q_encode_messages(spark, sf):
    msgs = fixtures.lead_messages(spark, sf)
    return msgs.select(F.col("key").cast("string").alias("key"),
                       F.col("value").cast("string").alias("value"), "timestamp")


def q_shift_event_time(spark, sf):
    ev = fixtures.table(spark, sf, "events")
    shifted = add_seconds("ts", (F.col("event_id") % 3600).cast("int"))
    return ev.select("event_id", shifted.alias("event_time"),
                     iso_utc(shifted).alias("event_time_iso"))


# --------------------------------------------------------------- reporting

TARGET_SYNC = dt.datetime(2024, 1, 31)
BATCH_SYNC = dt.datetime(2024, 2, 1)


def _pivot(spark, sf):
    return reporting.pivot_run_metrics(*lh.tracking(spark, sf))


def q_metrics_pivot(spark, sf):
    return _pivot(spark, sf)


def q_runs_newest_first(spark, sf):
    return reporting.rank_newest(_pivot(spark, sf)).select("run_uuid", "experiment_name", "start_time", "newest_rank")


def q_table_if_absent(spark, sf):
    """The typed reporting table is created empty where there is none; where there is one, it and its rows stay."""
    base = lh.new_table_path(spark, "reporting_new")
    first = reporting.ensure_reporting_table(spark, base)
    empty = reporting.read_reporting_table(spark, base)
    rows = reporting.upsert_table(spark, base, reporting.to_reporting_rows(lh.materialize(spark, _pivot(spark, sf), "run_pivot"), BATCH_SYNC))
    again = reporting.ensure_reporting_table(spark, base)
    facts = {"created_empty": empty.isEmpty(), "typed": empty.schema == REPORTING_SCHEMA == rows.schema,
             "newer_version_kept": first != again}
    return rows.groupBy("experiment_name").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "experiment_name", "n_rows", *[F.lit(v).alias(k) for k, v in facts.items()])


def q_sync_default_time(spark, sf):
    """Without a given sync time, rows carry the time of the sync."""
    rows = reporting.to_reporting_rows(_pivot(spark, sf))
    late = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("sync_timestamp")
    return rows.select("run_id", F.coalesce(F.abs(late) < 3600, F.lit(False)).alias("synced_now"))


FIRST_SYNC_BEFORE = dt.datetime(1999, 1, 1)
SECOND_SYNC_FROM = dt.datetime(1998, 1, 1)


def upsert_run_metrics(spark, sf, base: str) -> DataFrame:
    """Two incremental syncs into the reporting table at ``base``: first the
    runs started before 1999, then the runs started from 1998 on. Runs of
    1998 are replaced, earlier ones kept, later ones added."""
    rows = lh.materialize(spark, _pivot(spark, sf), "run_pivot")
    started = F.col("start_time")
    reporting.upsert_table(spark, base, reporting.to_reporting_rows(
        rows.where(started < F.lit(FIRST_SYNC_BEFORE)), TARGET_SYNC))
    return reporting.upsert_table(spark, base, reporting.to_reporting_rows(
        rows.where(started >= F.lit(SECOND_SYNC_FROM)), BATCH_SYNC))


def reporting_table(spark, sf) -> str:
    """The reporting table after the two syncs (built once per application)."""
    return lh.once(spark, "reporting", sf, lambda p: upsert_run_metrics(spark, sf, p))


def q_upsert_metrics(spark, sf):
    return reporting.read_reporting_table(spark, reporting_table(spark, sf))


def q_dashboard_view(spark, sf):
    """The view over the reporting table."""
    return reporting.dashboard_view(reporting.read_reporting_table(spark, reporting_table(spark, sf)))


def q_dashboard_by_name(spark, sf):
    """The view queried in SQL by its name."""
    catalog.register_lake_views(spark, sf, reporting_table(spark, sf),
                                lh.once(spark, "gold_table", sf, lambda p: catalog.materialize_gold(spark, sf, p)))
    return spark.sql("""SELECT experiment_name, count(*) AS n_runs, max(f1) AS best_f1, max(accuracy) AS best_accuracy
                        FROM v_dashboard_model_metrics GROUP BY experiment_name""")


# ---------------------------------------------------------------------- ml

def q_feature_profile(spark, sf):
    """The gold features and one that has no value in any row."""
    gold = lh.gold(spark, sf).withColumn("Empty", F.lit(None).cast("double"))
    return feature_profile(gold, [*GOLD_FEATURES, "Empty"])


PROFILE_FROM, PROFILE_TO = "2024-01-08", "2024-01-21"


def q_profile_window(spark, sf):
    """A window's profile merged from the dates' stored ones; the distinct counts against exact ones."""
    silver, base = lh.silver_table(spark, sf), lh.new_table_path(spark, "profiles")
    early = F.col("ingestion_date") <= "2024-01-14"
    for rows in (silver.where(early), silver.where(~early)):  # stored in two runs
        profile_store.store_profiles(rows, NUMERIC, base)
    merged = profile_store.window_profile(spark, base, PROFILE_FROM, PROFILE_TO)
    window = silver.where(F.col("ingestion_date").between(PROFILE_FROM, PROFILE_TO))
    exact = feature_profile(window, NUMERIC).select("feature", F.col("n_distinct").alias("exact"))
    return merged.join(exact, "feature").select(
        "feature", "min_value", "max_value", "n_values", "n_nulls",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")).alias("distinct_within_error"))


def q_training_matrix(spark, sf):
    return ml.training_matrix(lh.gold(spark, sf), GOLD_ID, GOLD_LABEL)


def q_train_test_split(spark, sf):
    """Some keys are NULL; their rows are in a part, too."""
    keyed = lh.gold(spark, sf).withColumn("key", F.when(F.col(f"`{GOLD_ID}`") % 97 != 0, F.col(f"`{GOLD_ID}`")))
    return ml.hash_split(keyed, "key", {"train": 80, "test": 20}, seed=42).select(GOLD_ID, "split")


def q_exact_split(spark, sf):
    """Exactly int(0.8 n) rows train; a part of them has no key, their order is that of the lead number's hash."""
    keyed = lh.gold(spark, sf).select(GOLD_ID, F.when(F.col(f"`{GOLD_ID}`") % 97 != 0, F.col(f"`{GOLD_ID}`")).alias("key"))
    return exact_split(keyed, "key", training.TRAIN_SHARE, lambda df: lh.materialize(spark, df, "split_rows"), seed=42,
                       ties=[GOLD_ID]).select(GOLD_ID, "split")


def q_confusion_metrics(spark, sf):
    labels = fixtures.table(spark, sf, "labels")
    scored = labels.select(F.col("quality").alias("label"),
                           F.when(F.col("toxic").cast("double") > 0.5, 1).otherwise(0)
                           .alias("prediction"))
    return ml.confusion_metrics(scored, "label", "prediction")


def q_auc_by_group(spark, sf):
    li = fixtures.table(spark, sf, "lineitem")
    status = F.when(F.col("l_linenumber") != 7, F.col("l_linestatus")).alias("l_linestatus")  # NULL is a group, too
    scored = li.select(status, (F.col("l_returnflag") == "R").cast("int").alias("label"),
                       F.col("l_discount").alias("score"))
    return ml.auc_by_group(scored, "label", "score", "l_linestatus")


def q_threshold_scores(spark, sf):
    """Probabilities on both sides of, and at, the threshold."""
    li = fixtures.table(spark, sf, "lineitem")
    p = F.col("l_discount") * 10
    return li.select("l_orderkey", "l_linenumber", p.alias("probability"), ml.classify(p).alias("prediction"))


def q_test_scores(spark, sf):
    """The test part as scored by the model: who is in it, and that scores and classes agree."""
    scored = training.train_and_evaluate(spark, sf).test_scores
    return scored.select(GOLD_ID, "label", F.col("probability").between(0, 1).alias("in_range"),
                         (F.col("prediction") == (F.col("probability") > 0.5).cast("int")).alias("class_agrees"))


def q_scored_leads(spark, sf):
    """Every lead of the inference view has one score."""
    return training.score_inference(spark, sf).select(
        GOLD_ID, F.col("probability").between(0, 1).alias("in_range"),
        (F.col("prediction") == (F.col("probability") > 0.5).cast("int")).alias("class_agrees"))


def q_stored_model_scores(spark, sf):
    """Every lead's probability by the model as loaded from its folder against that of the model in memory."""
    stored = load_model(spark, training.stored_model(spark, sf))
    loaded = training.score_stored(stored, gold_inference(lh.gold(spark, sf)))
    unsaved = training.score_inference(spark, sf).withColumnsRenamed({"probability": "p", "prediction": "c"})
    return loaded.join(unsaved, GOLD_ID, "full").select(
        GOLD_ID, F.col("probability").eqNullSafe(F.col("p")).alias("same_probability"),
        F.col("prediction").eqNullSafe(F.col("c")).alias("same_class"))


def q_early_stopping(spark, sf):
    """The rule on the run's AUC series, which is recomputed for its last round by MLlib's evaluator."""
    run = training.train_and_evaluate(spark, sf)
    stop, budget = run.early_stop, training.PARAMS["max_iter"]
    again = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(run.test_scores)
    facts = {
        "best_is_first_highest": stop.aucs.index(max(stop.aucs)) == stop.best,
        "stopped_by_patience_or_budget": stop.last - stop.best == training.PARAMS["patience"] or stop.last == budget - 1,
        "model_ends_with_last_round": run.model.getNumTrees == stop.last + 1 == len(stop.aucs),
        "last_auc_agrees": abs(stop.aucs[-1] - again) < 1e-9}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in facts.items()])


def q_logged_metrics(spark, sf):
    """Every logged metric against its value recomputed from the test scores, the AUC by MLlib's evaluator."""
    run = training.train_and_evaluate(spark, sf)
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(run.test_scores)
    again = run.test_scores.selectExpr("label = 1 AS y", "prediction = 1 AS p")
    want = again.selectExpr("double(count_if(y AND p)) AS true_positives", "double(count_if(NOT y AND NOT p)) AS true_negatives",
                            "double(count_if(NOT y AND p)) AS false_positives", "double(count_if(y AND NOT p)) AS false_negatives")
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    want = want.withColumns({"precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
                             "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)), "auc": F.lit(auc)})
    want = want.unpivot([], want.columns, "key", "want")
    rounds = F.col("value").between(0, training.PARAMS["max_iter"] - 1)
    agrees = F.col("value").isNull() | (F.abs(F.col("value") - F.col("want")) < 1e-9)
    return run.run_metrics.join(want, "key", "left").select(
        "key", F.when(F.col("key").endswith("_iteration"), rounds).otherwise(agrees).alias("ok"))


def q_assembled_vectors(spark, sf):
    """The elements of every feature vector, in order."""
    matrix = ml.training_matrix(lh.gold(spark, sf), GOLD_ID, GOLD_LABEL, GOLD_FEATURES)
    vector = vector_to_array(F.col("features"))
    return ml.assemble(matrix, GOLD_FEATURES).withColumn("v", vector).select(
        GOLD_ID, *[F.get("v", F.lit(k)).alias(f"f{k}") for k in range(len(GOLD_FEATURES))],
        F.size("v").alias("n_features"))


def q_importance_facts(spark, sf):
    """What holds of the importances whatever was learnt: every feature once, shares of one, the largest first."""
    run = training.train_and_evaluate(spark, sf)
    values = [(r["feature"], r["importance"]) for r in run.importance.collect()]
    top = ml.feature_importance(spark, run.model, GOLD_FEATURES, 3).collect()
    facts = {"n_features": len({f for f, _ in values}), "known_features": {f for f, _ in values} <= set(GOLD_FEATURES),
             "shares_of_one": abs(sum(v for _, v in values) - 1) < 1e-9 and all(v >= 0 for _, v in values),
             "largest_first": values == sorted(values, key=lambda x: (-x[1], x[0])),
             "top_is_the_front": [r["feature"] for r in top] == [f for f, _ in values[:3]]}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in facts.items()])


def q_train_eval(spark, sf):
    return training.train_and_evaluate(spark, sf).run_metrics


def q_score_leads(spark, sf):
    return training.score_inference(spark, sf)


def q_feature_importance(spark, sf):
    return training.train_and_evaluate(spark, sf).importance


# --------------------------------------------------------------- streaming

def q_bronze_stream_ingest(spark, sf):
    return stream_plan.ingest_fixture_stream(spark, sf).select(*BRONZE_COLS)


def q_stream_two_runs(spark, sf):
    return stream_plan.ingest_in_two_runs(spark, sf).select(*BRONZE_COLS)


def q_stream_backfill(spark, sf):
    return stream_plan.ingest_fixture_stream(spark, sf, "2024-01-15").select(*BRONZE_COLS)


def q_ingest_dead_letters(spark, sf):
    """Every message of a faulty log, in bronze (no reason) or set aside with its raw bytes."""
    good, bad = stream_plan.ingest_with_dead_letters(spark, sf)
    rows = [good.select("kafka_key", F.col("raw_json").cast("binary").alias("value"), "kafka_timestamp", "ingestion_date",
                        F.lit(None).cast("string").alias("reason")),
            bad.select(F.col("key").cast("string").alias("kafka_key"), "value", F.col("timestamp").alias("kafka_timestamp"),
                       "ingestion_date", "reason")]
    return rows[0].unionByName(rows[1]).withColumn("value_md5", F.md5("value")).drop("value")


QUERIES: dict[str, Query] = {
    "bronze_transform": q_bronze_transform,
    "bronze_transform_override": q_bronze_transform_override,
    "scan_partitioned": q_scan_partitioned,
    "scan_date_window": q_scan_date_window,
    "scan_trailing_window": q_scan_trailing_window,
    "json_parse_typed": q_json_parse_typed,
    "silver_leads": q_silver_leads,
    "dedup_latest": q_dedup_latest,
    "impute_mean": q_impute_mean,
    "clean_text": q_clean_text,
    "bucket_tags": q_bucket_tags,
    "bucket_occupation": q_bucket_occupation,
    "gold_features": q_gold_features,
    "gold_typed": q_gold_typed,
    "gold_inference": q_gold_inference,
    "gold_materialized": q_gold_materialized,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "row_count_report": q_row_count_report,
    "partition_report": q_partition_report,
    "parity_check": q_parity_check,
    "parity_override": q_parity_override,
    "table_sample": q_table_sample,
    "partition_files": q_partition_files,
    "relation_check": q_relation_check,
    "retried_read": q_retried_read,
    "gold_export": q_gold_export,
    "export_check": q_export_check,
    "distinct_categories": q_distinct_categories,
    "one_hot_dynamic": q_one_hot_dynamic,
    "one_hot_long": q_one_hot_long,
    "levels_applied": q_levels_applied,
    "safe_names": q_safe_names,
    "clamp_round": q_clamp_round,
    "weighted_category": q_weighted_category,
    "encode_messages": q_encode_messages,
    "shift_event_time": q_shift_event_time,
    "metrics_pivot": q_metrics_pivot,
    "runs_newest_first": q_runs_newest_first,
    "sync_default_time": q_sync_default_time,
    "table_if_absent": q_table_if_absent,
    "upsert_metrics": q_upsert_metrics,
    "dashboard_view": q_dashboard_view,
    "dashboard_by_name": q_dashboard_by_name,
    "feature_profile": q_feature_profile,
    "profile_window": q_profile_window,
    "training_matrix": q_training_matrix,
    "assembled_vectors": q_assembled_vectors,
    "train_test_split": q_train_test_split,
    "exact_split": q_exact_split,
    "confusion_metrics": q_confusion_metrics,
    "threshold_scores": q_threshold_scores,
    "auc_by_group": q_auc_by_group,
    "bronze_stream_ingest": q_bronze_stream_ingest,
    "stream_two_runs": q_stream_two_runs,
    "stream_backfill": q_stream_backfill,
    "ingest_dead_letters": q_ingest_dead_letters,
    "parity_pending": q_parity_pending,
    "audited_publication": q_audited_publication,
    "train_eval": q_train_eval,
    "test_scores": q_test_scores,
    "logged_metrics": q_logged_metrics,
    "score_leads": q_score_leads,
    "scored_leads": q_scored_leads,
    "feature_importance": q_feature_importance,
    "importance_facts": q_importance_facts,
    "stored_model_scores": q_stored_model_scores,
    "early_stopping": q_early_stopping,
}
