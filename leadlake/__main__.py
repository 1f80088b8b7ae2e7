"""Command-line jobs: one sub-command per pipeline step.

    python -m leadlake ingest  --files /lake/landing --bronze /lake/bronze --checkpoint /lake/ckpt
    python -m leadlake ingest  --kafka broker:9092 --topic leads_raw --bronze ... --checkpoint ...
    python -m leadlake parity  --files /lake/landing --bronze /lake/bronze [--date 2024-01-30]
    python -m leadlake silver  --bronze /lake/bronze --run-date 2024-01-30 --out /lake/silver
    python -m leadlake gold    --silver /lake/silver --out /lake/gold [--export /lake/export]
    python -m leadlake test    --silver /lake/silver --gold /lake/gold
    python -m leadlake train   --gold /lake/gold --tracking /lake/tracking --model /lake/model
    python -m leadlake score   --model /lake/model --silver /lake/silver --out /lake/scores
    python -m leadlake sync-metrics --tracking /lake/tracking --reporting /lake/reporting
    python -m leadlake verify  --reporting /lake/reporting

Versioned outputs (silver, gold, reporting) are written as new version
folders; readers take the latest committed one. Exit codes: 0 ok, 1 failed
tests, 2 data loss (parity) or no table (``verify``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from leadlake.operators import quality, reporting
from leadlake.operators.ml import append_run_log
from leadlake.operators.silver import build_silver, silver_and_quarantine
from leadlake.plans.checks import check_consumed_parity, check_parity, verify_export
from leadlake.plans.gold import gold_features, gold_inference
from leadlake.plans.lakehouse import materialize
from leadlake.plans.publish import GOLD_EXPECTATIONS, publish_audited
from leadlake.plans.training import score_stored, store_run, train_on_gold
from leadlake.schemas import GOLD_ACCEPTED, GOLD_ID, GOLD_NOT_NULL, INFERENCE_NOT_NULL, SILVER_NOT_NULL
from leadlake.session import build_session, checkpoint_dir
from leadlake.sinks.lake import (current_table_version, export_with_run_date, read_if_there,
                                 write_table_version)
from leadlake.sinks.models import load_model
from leadlake.sources.lake import read_partitioned, trailing_window
from leadlake.sources.messages import MessageSource, read_message_batch
from leadlake.streaming.deadletter import run_split_ingest
from leadlake.streaming.ingest import run_bronze_ingest


def _source(args) -> MessageSource:
    if args.kafka:
        options = {"kafka.bootstrap.servers": args.kafka}
        if getattr(args, "max_offsets_per_trigger", None):
            options["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
        return MessageSource("kafka", topic=args.topic, options=options)
    return MessageSource("files", path=args.files,
                         max_files_per_trigger=getattr(args, "max_files_per_trigger", None))


def _latest(spark: SparkSession, base: str) -> DataFrame:
    version = current_table_version(spark, base)
    if version is None:
        raise SystemExit(f"no table at {base}")
    return spark.read.parquet(version)


def cmd_ingest(spark, args) -> int:
    if args.dead_letters:
        n = run_split_ingest(spark, _source(args), args.bronze, args.dead_letters, args.checkpoint, args.date_override)
    else:
        n = run_bronze_ingest(spark, _source(args), args.bronze, args.checkpoint, args.date_override)
    print(f"ingested {n} messages into {args.bronze}")
    return 0


def cmd_parity(spark, args) -> int:
    if args.checkpoint:
        rows = check_consumed_parity(spark, _source(args), args.checkpoint, args.bronze, args.date_override).collect()
        for r in sorted(rows, key=lambda r: str(r["ingestion_date"])):
            print(r.asDict())
        return 2 if any(r["status"] == "data_loss" for r in rows) else 0
    report = check_parity(spark, read_message_batch(spark, _source(args)), args.bronze,
                          args.date, args.scope, date_override=args.date_override).orderBy("ingestion_date")
    rows = report.collect()
    for r in rows:
        print(r.asDict())
    return 2 if any(r["status"] == "data_loss" for r in rows) else 0


def cmd_silver(spark, args) -> int:
    start, end = trailing_window(args.run_date, args.lookback_days)
    bronze = read_partitioned(spark, args.bronze)
    if args.quarantine:
        silver, bad = silver_and_quarantine(bronze, start, end)
        print(write_table_version(bad, args.quarantine))
    else:
        silver = build_silver(bronze, start, end)
    print(write_table_version(silver, args.out))
    return 0


def cmd_gold(spark, args) -> int:
    gold = gold_features(_latest(spark, args.silver))
    if args.audit:
        done = publish_audited(gold, args.out, GOLD_EXPECTATIONS)
        for model, test, column, failing, passed in done.report:
            print(("PASS " if passed else "FAIL ") + f"{model}.{column} {test} failing={failing}")
        if not done.published:
            print(f"not published: {done.version}")
            return 1
        version = done.version
    else:
        version = write_table_version(gold, args.out)
    print(version)
    if args.export:
        written = spark.read.parquet(version)
        print(export_with_run_date(written, args.export, args.run_date))
        check = verify_export(spark, written, args.export, args.run_date)
        print(check)
        return 0 if check["ok"] else 2
    return 0


def cmd_test(spark, args) -> int:
    silver, gold = _latest(spark, args.silver), _latest(spark, args.gold)
    inference = gold_inference(gold)
    reports = [
        quality.not_null_report(silver, "leads_silver", SILVER_NOT_NULL),
        quality.unique_report(silver, "leads_silver", ["lead_number"]),
        quality.accepted_values_report(silver, "leads_silver", {"converted": [0, 1]}),
        quality.not_null_report(gold, "leads_gold_features", GOLD_NOT_NULL),
        quality.unique_report(gold, "leads_gold_features", [GOLD_ID]),
        quality.accepted_values_report(gold, "leads_gold_features", GOLD_ACCEPTED),
        quality.not_null_report(inference, "leads_gold_sin_converted", INFERENCE_NOT_NULL),
        quality.unique_report(inference, "leads_gold_sin_converted", [GOLD_ID]),
        quality.accepted_values_report(inference, "leads_gold_sin_converted",
                                       {"Tags_Ringing": [0, 1]}),
    ]
    rows = reduce(DataFrame.unionByName, reports).collect()
    for r in rows:
        print(("PASS " if r["passed"] else "FAIL ") + f"{r['model']}.{r['column_name']} "
              f"{r['test']} failing={r['failing_rows']}")
    return 0 if all(r["passed"] for r in rows) else 1


def cmd_train(spark, args) -> int:
    checkpoint_dir(spark)  # boosting cuts its lineage there
    run = train_on_gold(spark, _latest(spark, args.gold))
    if args.model:
        print(store_run(spark, run, args.model))
    append_run_log(run.tracking, args.tracking)
    for r in run.run_metrics.collect():
        print(r["key"], r["value"])
    return 0


def cmd_score(spark, args) -> int:
    """Score the leads of silver with the stored model; a new version of the scores table."""
    stored = load_model(spark, args.model, args.version)
    print(f"model {stored.version}")
    print(write_table_version(score_stored(stored, gold_inference(gold_features(_latest(spark, args.silver)))), args.out))
    return 0


def cmd_sync_metrics(spark, args) -> int:
    base = args.tracking.rstrip("/")
    tables = [read_if_there(lambda t=t: spark.read.parquet(f"{base}/{t}"))
              for t in ("runs", "experiments", "latest_metrics")]
    if any(t is None for t in tables):  # nothing tracked yet: the table and its view exist, empty
        reporting.ensure_reporting_table(spark, args.reporting)
        print("reporting rows: 0")
        return 0
    rows = materialize(spark, reporting.pivot_run_metrics(*tables), "run_pivot")  # the upsert reads it several times
    for r in reporting.newest_first(rows).limit(20).collect():
        print(r["start_time"], r["run_uuid"], r["experiment_name"], r["auc"])
    out = reporting.upsert_table(spark, args.reporting, reporting.to_reporting_rows(rows))
    print(f"reporting rows: {out.count()}")
    return 0


def cmd_verify(spark, args) -> int:
    """Existence, row count and a 5-row sample of the dashboard view."""
    base = args.reporting.rstrip("/")
    if current_table_version(spark, base) is None:
        print(f"ERROR: missing table {base}", file=sys.stderr)
        return 2
    view = reporting.dashboard_view(reporting.read_reporting_table(spark, base))
    check = quality.relation_check(view, ["run_id"], n=5)
    print(f"OK: v_dashboard_model_metrics rows={check['count']}")
    for r in check["sample"]:
        print("  ", tuple(r))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leadlake")
    p.add_argument("--input-bytes", type=int, help="bytes the job reads: sizes the shuffle partitions")
    sub = p.add_subparsers(dest="cmd", required=True)

    def messages(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--files", help="folder of message files (key, value, timestamp)")
        g.add_argument("--kafka", help="bootstrap servers")
        sp.add_argument("--topic", default="leads_raw")

    s = sub.add_parser("ingest")
    messages(s)
    s.add_argument("--bronze", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--date-override")
    s.add_argument("--dead-letters", help="table for messages that are no JSON objects in UTF-8; without it all go to bronze")
    s.add_argument("--max-files-per-trigger", type=int, help="files per micro-batch")
    s.add_argument("--max-offsets-per-trigger", type=int, help="Kafka offsets per micro-batch")
    s = sub.add_parser("parity")
    messages(s)
    s.add_argument("--bronze", required=True)
    s.add_argument("--date")
    s.add_argument("--date-override", help="the date the messages were ingested under")
    s.add_argument("--checkpoint", help="the ingest's: messages it hasn't consumed yet are pending, not lost")
    s.add_argument("--scope", default="per_date", choices=["per_date", "whole_topic"])
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--run-date", default=dt.date.today().isoformat())
    s.add_argument("--lookback-days", type=int, default=365)
    s.add_argument("--quarantine", help="table for messages that can't be parsed; without it they fail the job")
    s = sub.add_parser("gold")
    s.add_argument("--silver", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--export")
    s.add_argument("--audit", action="store_true", help="publish only a table that meets its expectations (exit code 1 if not)")
    s.add_argument("--run-date", default=dt.date.today().isoformat())
    s = sub.add_parser("test")
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s = sub.add_parser("train")
    s.add_argument("--gold", required=True)
    s.add_argument("--tracking", required=True)
    s.add_argument("--model", help="folder for the model's versions; without it the model is not kept")
    s = sub.add_parser("score")
    s.add_argument("--model", required=True)
    s.add_argument("--version", help="a version's path; the current one by default")
    s.add_argument("--silver", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("sync-metrics")
    s.add_argument("--tracking", required=True)
    s.add_argument("--reporting", required=True)
    s = sub.add_parser("verify")
    s.add_argument("--reporting", required=True)
    return p


COMMANDS = {"ingest": cmd_ingest, "parity": cmd_parity, "silver": cmd_silver, "gold": cmd_gold,
            "test": cmd_test, "train": cmd_train, "score": cmd_score, "sync-metrics": cmd_sync_metrics,
            "verify": cmd_verify}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"leadlake-{args.cmd}", input_bytes=args.input_bytes)
    return COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    sys.exit(main())
