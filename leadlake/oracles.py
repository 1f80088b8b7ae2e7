"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement starts from the same test tables as the Spark query and
re-derives the fixture inputs in SQL (``MSGS`` mirrors ``fixtures.lead_messages``,
``TRACKING`` mirrors the tracking-table fixtures). The operator under test is
then computed by another route than the Spark code takes: messages through one
JSON-to-struct transform, the latest version by ``arg_max`` per lead, levels by
lookup joins, metrics by filtered aggregates before the join.
"""

from __future__ import annotations

from leadlake.schemas import (ACTIVITY_KEEP, ACTIVITY_OTHER, CITY_KEEP, CITY_OTHER, CITY_WEIGHTS,
                              CONVERTED_WEIGHTS, GOLD_ACCEPTED, GOLD_DUMMIES, GOLD_FEATURES as GOLD_FEATURE_NAMES, GOLD_ID,
                              GOLD_LABEL, GOLD_NOT_NULL, GOLD_NUMERIC, INFERENCE_NOT_NULL, LEAD_ORIGIN_WEIGHTS,
                              MESSAGE_FIELDS, METRIC_MAP, OCCUPATION_KEEP, OCCUPATION_OTHER, SILVER_NOT_NULL,
                              TAGS_KEEP, TAGS_OTHER, UNKNOWN)

ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

MSGS = f"""
msgs AS (
  SELECT
    CAST(1000000 + user_id * 20 + event_id % 20 AS VARCHAR) AS key,
    json_object(
      'event_time', strftime(ts, {ISO}),
      'ingestion_time', strftime(date_trunc('day', ts), {ISO}),
      'source_system', 'crm_leads_v1',
      'schema_version', 'v1',
      'Lead Number', 1000000 + user_id * 20 + event_id % 20,
      'Lead Origin', event_type,
      'Lead Source', event_type,
      'Converted', CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END,
      'TotalVisits', CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 9 AS INTEGER) END,
      'Total Time Spent on Website', CAST(floor(value * 10) AS INTEGER),
      'Page Views Per Visit', CASE WHEN event_id % 13 = 0 THEN NULL
                                   ELSE CAST(event_id % 40 AS DOUBLE) / 4 END,
      'Last Activity', event_type,
      'Country', CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'India' END,
      'What is your current occupation', CASE event_id % 7
          WHEN 0 THEN 'Unemployed' WHEN 1 THEN 'Working Professional' WHEN 2 THEN 'Student'
          WHEN 3 THEN '  ' WHEN 4 THEN NULL WHEN 5 THEN ' Unemployed ' ELSE 'Unemployed' END,
      'City', CASE event_id % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN ' Mumbai ' ELSE 'Select' END,
      'Tags', CASE event_id % 11
          WHEN 0 THEN 'Already a student' WHEN 1 THEN 'Closed by Horizzon'
          WHEN 2 THEN 'Interested in other courses' WHEN 3 THEN 'Ringing'
          WHEN 4 THEN 'Will revert after reading the email' WHEN 5 THEN 'Busy'
          WHEN 6 THEN '' WHEN 7 THEN NULL ELSE 'Ringing' END,
      'Last Notable Activity', CASE event_id % 19
          WHEN 0 THEN 'Modified' WHEN 1 THEN NULL WHEN 2 THEN 'Email Opened' ELSE 'SMS Sent' END
    ) AS value,
    ts AS timestamp
  FROM events
)"""


def bronze_cte(where: str = "", override: str | None = None) -> str:
    date = f"DATE '{override}'" if override else "CAST(timestamp AS DATE)"
    return f"""{MSGS},
bronze_all AS (
  SELECT key AS kafka_key, value AS raw_json, timestamp AS kafka_timestamp,
         {date} AS ingestion_date
  FROM msgs
),
bronze AS (SELECT * FROM bronze_all {where})"""


def _q(c: str) -> str:
    return '"' + c + '"'


_STRUCT = "{" + ", ".join(f'"{k}": "{"VARCHAR" if t in ("string", "timestamp") else t.upper()}"'
                          for k, _, t in MESSAGE_FIELDS) + "}"


def _field(key: str, name: str, kind: str) -> str:
    value = f"j.{_q(key)}"
    return f"{value}::TIMESTAMPTZ::TIMESTAMP AS {name}" if kind == "timestamp" else f"{value} AS {name}"


PARSED = f"""
shaped AS (SELECT *, from_json(raw_json, '{_STRUCT}') AS j FROM bronze),
parsed AS (
  SELECT kafka_key, kafka_timestamp, ingestion_date, {", ".join(_field(*f) for f in MESSAGE_FIELDS)} FROM shaped)"""

# The visits of a lead that has none are 0, and a ratio to 0 is no number.
SILVER = f"""{{bronze}},{PARSED},
timed AS (
  SELECT p.*, ifnull(total_visits, 0) AS total_visits_filled, ifnull(country, '{UNKNOWN}') AS country_filled,
         CASE WHEN total_visits <> 0 THEN total_time_spent_on_website::DOUBLE / total_visits END AS average_time_per_visit
  FROM parsed p WHERE total_time_spent_on_website > 0),
newest AS (SELECT arg_max(t, (t.ingestion_time, t.kafka_timestamp)) AS r FROM timed t GROUP BY t.lead_number),
silver AS (SELECT unnest(r) FROM newest)"""
SILVER = SILVER.replace("{bronze}", bronze_cte(
    "WHERE ingestion_date BETWEEN (SELECT max(ingestion_date) - 365 FROM bronze_all) "
    "AND (SELECT max(ingestion_date) FROM bronze_all)"))

# Whole-set means: whole numbers by an integer sum, quarter steps by a DOUBLE sum (exact there), ratios by an
# exact DECIMAL sum (a DOUBLE average varies in the last bits from run to run).
_MEANS = {"total_time_spent_on_website": "sum(total_time_spent_on_website)::DOUBLE / count(total_time_spent_on_website)",
          "page_views_per_visit": "sum(page_views_per_visit) / count(page_views_per_visit)",
          "total_visits": "sum(total_visits)::DOUBLE / count(total_visits)",
          "average_time_per_visit": "sum(average_time_per_visit::DECIMAL(38,18))::DOUBLE / count(average_time_per_visit)"}
_TEXTS = ["current_occupation", "tags", "city", "last_notable_activity"]


def _levels(name: str, levels: list[str]) -> str:
    return f"{name}(level) AS (VALUES " + ", ".join(f"('{x}')" for x in levels) + ")"


CLEAN = f"""
means AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _MEANS.items())} FROM silver),
clean AS (
  SELECT s.lead_number, s.converted, {", ".join(f"ifnull(s.{c}, m.{c}) AS {c}" for c in _MEANS)},
         {", ".join(f"nullif(trim(s.{c}), '') AS {c}" for c in _TEXTS)}
  FROM silver s, means m),
{_levels("tag_levels", TAGS_KEEP)},
{_levels("occupation_levels", OCCUPATION_KEEP)},
{_levels("city_levels", CITY_KEEP)},
{_levels("activity_levels", ACTIVITY_KEEP)},
bucketed AS (
  SELECT c.*,
         coalesce(t.level, if(c.tags IS NULL, '{UNKNOWN}', '{TAGS_OTHER}')) AS tags_bucket,
         coalesce(o.level, if(c.current_occupation IS NULL, '{UNKNOWN}', '{OCCUPATION_OTHER}')) AS current_occupation_bucket,
         coalesce(y.level, '{CITY_OTHER}') AS city_bucket,
         coalesce(a.level, '{ACTIVITY_OTHER}') AS last_notable_activity_bucket
  FROM clean c LEFT JOIN tag_levels t ON c.tags = t.level
  LEFT JOIN occupation_levels o ON c.current_occupation = o.level
  LEFT JOIN city_levels y ON c.city = y.level
  LEFT JOIN activity_levels a ON c.last_notable_activity = a.level)"""

_DUMMIES = ", ".join(f"ifnull({src} = '{level}', false)::INTEGER AS {_q(name)}" for name, src, level in GOLD_DUMMIES)
GOLD_FEATURES = f"""{SILVER},{CLEAN},
gold AS (
  SELECT lead_number AS {_q(GOLD_ID)}, {", ".join(f"{src} AS {_q(name)}" for src, name in GOLD_NUMERIC)}, {_DUMMIES},
         converted AS {_q(GOLD_LABEL)}
  FROM bucketed)"""

GOLD_TYPED = f"""{SILVER},{CLEAN}
SELECT lead_number, converted, {", ".join(_MEANS)}, current_occupation_bucket, tags_bucket, city_bucket,
       last_notable_activity_bucket
FROM bucketed"""

BRONZE_COLS = "SELECT kafka_key, raw_json, kafka_timestamp, ingestion_date FROM bronze"

def weighted_case(key: str, weights: dict, seed: int) -> str:
    """SQL of ``weighted_category``: md5 bucket of 'key:seed' through the
    cumulative weights."""
    items = [(v, int(w)) for v, w in weights.items() if int(w) > 0]
    total = sum(w for _, w in items)
    bucket = (f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT "
              f"% {total})")
    parts, upper = [], 0
    for value, w in items[:-1]:
        upper += w
        parts.append(f"WHEN {bucket} < {upper} THEN '{value}'")
    return f"CASE {' '.join(parts)} ELSE '{items[-1][0]}' END"


def safe_name_sql(prefix: str, value: str) -> str:
    expr = f"lower('{prefix}__' || {value})"
    for old, new in [(" ", "_"), ("&", "and"), ("-", "_"), ("/", "_"), (".", ""), (",", ""),
                     ("(", ""), (")", ""), ("''", ""), ('"', "")]:
        expr = f"replace({expr}, '{old}', '{new}')"
    return expr


def _report(model: str, test: str, column: str, failing: str, source: str) -> str:
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS column_name, "
            f"CAST({failing} AS BIGINT) AS failing_rows, CAST({failing} AS BIGINT) = 0 AS passed "
            f"FROM {source}")


SILVER_NN, GOLD_NN, INF_NN = SILVER_NOT_NULL, GOLD_NOT_NULL, INFERENCE_NOT_NULL
GOLD_DUMMY_NAMES = [name for name, _, _ in GOLD_DUMMIES]
GOLD_NUMERIC_NAMES = [name for _, name in GOLD_NUMERIC]

DQ_NOT_NULL = f"""WITH {GOLD_FEATURES}, inference AS (SELECT * EXCLUDE ("Converted") FROM gold)
""" + "\nUNION ALL\n".join(
    [_report("leads_silver", "not_null", c, f"count(*) FILTER (WHERE {_q(c)} IS NULL)", "silver")
     for c in SILVER_NN]
    + [_report("leads_gold_features", "not_null", c, f"count(*) FILTER (WHERE {_q(c)} IS NULL)",
               "gold") for c in GOLD_NN]
    + [_report("leads_gold_sin_converted", "not_null", c,
               f"count(*) FILTER (WHERE {_q(c)} IS NULL)", "inference") for c in INF_NN])


def _unique(model, c, source):
    return (f"SELECT '{model}' AS model, 'unique' AS test, '{c}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failing_rows, count(*) = 0 AS passed FROM "
            f"(SELECT {_q(c)} FROM {source} WHERE {_q(c)} IS NOT NULL GROUP BY {_q(c)} "
            f"HAVING count(*) > 1)")


DQ_UNIQUE = f"""WITH {GOLD_FEATURES}, inference AS (SELECT * EXCLUDE ("Converted") FROM gold)
""" + "\nUNION ALL\n".join([_unique("leads_silver", "lead_number", "silver"),
                            _unique("leads_gold_features", "Lead Number", "gold"),
                            _unique("leads_gold_sin_converted", "Lead Number", "inference")])


def _accepted(model, c, source):
    f = f"count(DISTINCT {_q(c)}) FILTER (WHERE {_q(c)} IS NOT NULL AND {_q(c)} NOT IN (0, 1))"
    return _report(model, "accepted_values", c, f, source)


DQ_ACCEPTED = f"""WITH {GOLD_FEATURES}, inference AS (SELECT * EXCLUDE ("Converted") FROM gold)
""" + "\nUNION ALL\n".join(
    [_accepted("leads_silver", "converted", "silver")]
    + [_accepted("leads_gold_features", c, "gold") for c in ["Converted"] + GOLD_DUMMY_NAMES]
    + [_accepted("leads_gold_sin_converted", "Tags_Ringing", "inference")])

_METRICS = """
  {'k': 'auc', 'at': l_linenumber = 1, 'v': 0.5 + l_discount},
  {'k': 'eval-auc', 'at': l_linenumber = 2, 'v': 0.5 + l_discount},
  {'k': 'precision', 'at': l_linenumber >= 3, 'v': if(l_orderkey % 20 = 0, 0.0, l_discount)},
  {'k': 'recall', 'at': l_linenumber >= 3, 'v': if(l_orderkey % 20 = 0, 0.0, l_tax)},
  {'k': 'true_positives', 'at': l_linenumber >= 5, 'v': l_quantity},
  {'k': 'true_negatives', 'at': l_linenumber >= 5, 'v': l_quantity + 1},
  {'k': 'false_positives', 'at': l_linenumber >= 5, 'v': l_quantity % 7},
  {'k': 'false_negatives', 'at': l_linenumber >= 5, 'v': l_quantity % 5},
  {'k': 'best_iteration', 'at': l_linenumber = 7, 'v': l_quantity},
  {'k': 'stopped_iteration', 'at': l_linenumber = 7, 'v': l_quantity + 10}"""

TRACKING = f"""
tracked AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_uuid, o_custkey AS experiment_id,
         time_bucket(INTERVAL 1 SECOND, o_orderdate + INTERVAL 123 MILLISECOND) AS start_time
  FROM orders WHERE o_orderpriority IS DISTINCT FROM '5-LOW' AND o_orderstatus = 'F'),
logged AS (SELECT CAST(l_orderkey AS VARCHAR) AS run_uuid, unnest([{_METRICS}]) AS m FROM lineitem),
wide AS (
  SELECT run_uuid, {", ".join(f"max(m.v) FILTER (WHERE m.at AND m.k IN ({', '.join(repr(k) for k in keys)}))::DOUBLE AS {out}"
                             for out, keys in METRIC_MAP.items())}
  FROM logged GROUP BY run_uuid),
pivoted AS (
  SELECT t.run_uuid, t.start_time, c.c_name AS experiment_name, {", ".join(f"w.{out}" for out in METRIC_MAP)}
  FROM tracked t JOIN customer c ON c.c_custkey = t.experiment_id LEFT JOIN wide w USING (run_uuid))"""

REPORT_COLS = ("run_uuid AS run_id, start_time AS run_timestamp, experiment_name, auc, precision, "
               "recall, tp, tn, fp, fn, best_iter, stopped_iter")
UPSERTED = f"""{TRACKING},
target AS (SELECT {REPORT_COLS}, TIMESTAMP '2024-01-31 00:00:00' AS sync_timestamp
           FROM pivoted WHERE start_time < TIMESTAMP '1999-01-01 00:00:00'),
batch AS (SELECT {REPORT_COLS}, TIMESTAMP '2024-02-01 00:00:00' AS sync_timestamp
          FROM pivoted WHERE start_time >= TIMESTAMP '1998-01-01 00:00:00'),
reporting AS (
  SELECT unnest(arg_max(r, r.sync_timestamp)) FROM (SELECT * FROM target UNION ALL SELECT * FROM batch) r
  GROUP BY r.run_id)"""

DASHBOARD = f"""WITH {UPSERTED},
view AS (
  SELECT run_id, run_timestamp, experiment_name, auc, precision, recall,
         2 * precision * recall / nullif(precision + recall, 0) AS f1,
         (tp + tn) / nullif(tp + tn + fp + fn, 0) AS accuracy,
         tp, tn, fp, fn, best_iter, stopped_iter, sync_timestamp
  FROM reporting)"""

PROFILE = f"""WITH {GOLD_FEATURES},
long AS (
  SELECT unnest([{", ".join(f"{{'f': '{c}', 'v': CAST({_q(c)} AS DOUBLE)}}" for c in GOLD_FEATURE_NAMES)},
                 {{'f': 'Empty', 'v': NULL::DOUBLE}}]) AS x FROM gold)
SELECT x.f AS feature, min(x.v) AS min_value, max(x.v) AS max_value, count(DISTINCT x.v) AS n_distinct,
       count(DISTINCT x.v) <= 1 AS is_constant
FROM long GROUP BY x.f"""



def split_bucket(key: str) -> str:
    return f"(('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '') || ':42'), 1, 8))::BIGINT % 100)"


def exact_part(key: str, tie: str) -> str:
    """The part of a row when exactly int(0.8 n) rows, in hash order, train."""
    def order(c: str) -> str:
        return f"md5('42|' || coalesce(CAST({c} AS VARCHAR), ''))[:15]"

    return (f"CASE WHEN row_number() OVER (ORDER BY {order(key)}, {order(tie)}) "
            "<= trunc(0.8::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END")


SOME_KEYS = 'CASE WHEN "Lead Number" % 97 <> 0 THEN "Lead Number" END'

AUC = """WITH base AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_linestatus END AS g, l_discount AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
  FROM lineitem
),
per AS (SELECT g, s, sum(y) AS pos, sum(1 - y) AS neg FROM base GROUP BY g, s),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY g ORDER BY s
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM per
)
SELECT g AS l_linestatus,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
    CAST(sum(pos * (2 * nb + neg)) AS DOUBLE)
      / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM cum GROUP BY g"""

# Bronze with rows lost (days ending in 3), repeated (5) and a date missing (7).
DAMAGED = f"""{bronze_cte()},
damaged AS (
  SELECT ingestion_date, kafka_key AS key FROM bronze, range(2) AS twice(n)
  WHERE CASE day(ingestion_date) % 10
    WHEN 7 THEN false
    WHEN 3 THEN n = 0 AND kafka_key::BIGINT % 4 <> 0
    WHEN 5 THEN n = 0 OR kafka_key::BIGINT % 4 = 0
    ELSE n = 0 END)"""

#: The levels of part.p_type at every scale factor.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

ORACLES: dict[str, str] = {
    "bronze_transform": f"WITH {bronze_cte()} {BRONZE_COLS}",
    "bronze_transform_override": f"WITH {bronze_cte(override='2024-01-15')} {BRONZE_COLS}",
    "scan_partitioned": f"WITH {bronze_cte()} {BRONZE_COLS}",
    "scan_date_window": (
        "WITH " + bronze_cte("WHERE ingestion_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
        + f" {BRONZE_COLS}"),
    "scan_trailing_window": (
        "WITH " + bronze_cte("WHERE ingestion_date BETWEEN DATE '2024-01-20' - INTERVAL 10 DAY"
                             " AND DATE '2024-01-20'") + f" {BRONZE_COLS}"),
    "json_parse_typed": f"WITH {bronze_cte()},{PARSED} SELECT * FROM parsed",
    "silver_leads": f"WITH {SILVER} SELECT * FROM silver",
    "dedup_latest": f"""WITH {bronze_cte()},{PARSED},
newest AS (SELECT arg_max(p, (p.ingestion_time, p.kafka_timestamp)) AS r FROM parsed p GROUP BY p.lead_number)
SELECT r.lead_number, r.ingestion_time, r.kafka_timestamp, r.kafka_key, r.converted FROM newest""",
    "impute_mean": f"""WITH {SILVER},{CLEAN}
SELECT lead_number, total_time_spent_on_website, page_views_per_visit, total_visits,
       average_time_per_visit FROM clean""",
    "clean_text": f"""WITH {SILVER},{CLEAN}
SELECT lead_number, current_occupation, tags, city, last_notable_activity FROM clean""",
    "bucket_tags": f"""WITH {SILVER},{CLEAN}
SELECT lead_number, tags, tags_bucket FROM bucketed""",
    "bucket_occupation": f"""WITH {SILVER},{CLEAN}
SELECT lead_number, current_occupation, current_occupation_bucket FROM bucketed""",
    "gold_features": f"WITH {GOLD_FEATURES} SELECT * FROM gold",
    "gold_typed": f"WITH {GOLD_TYPED}",
    "gold_inference": f"WITH {GOLD_FEATURES} SELECT * EXCLUDE (\"Converted\") FROM gold",
    "dq_not_null": DQ_NOT_NULL,
    "dq_unique": DQ_UNIQUE,
    "dq_accepted_values": DQ_ACCEPTED,
    "row_count_report": f"""WITH {GOLD_FEATURES}
SELECT 'leads_silver' AS "table", count(*) AS n FROM silver
UNION ALL SELECT 'leads_gold_features', count(*) FROM gold""",
    "partition_report": f"""WITH {DAMAGED},
span AS (SELECT min(ingestion_date) - 2 AS a, max(ingestion_date) + 2 AS b FROM bronze),
days AS (SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ingestion_date FROM span)
SELECT ingestion_date, count(d.key) AS n_rows, count(d.key) > 0 AS partition_exists
FROM days LEFT JOIN damaged d USING (ingestion_date) GROUP BY ingestion_date""",
    "parity_check": f"""WITH {DAMAGED},
counted AS (
  SELECT ingestion_date, sum(s)::BIGINT AS source_rows, sum(b)::BIGINT AS bronze_rows
  FROM (SELECT ingestion_date, 1 AS s, 0 AS b FROM bronze UNION ALL SELECT ingestion_date, 0, 1 FROM damaged)
  GROUP BY ingestion_date)
SELECT *, ['data_loss', 'ok', 'warning'][sign(bronze_rows - source_rows)::INTEGER + 2] AS status,
       greatest(source_rows - bronze_rows, 0) AS missing_rows
FROM counted""",
    "parity_override": """SELECT DATE '2024-01-15' AS ingestion_date, count(*) AS source_rows, count(*) AS bronze_rows,
  'ok' AS status, 0::BIGINT AS missing_rows FROM events""",
    "export_check": f"""WITH {GOLD_FEATURES}
SELECT count(*) AS expected_rows, count(*) AS exported_rows, true AS ok FROM gold""",
    "gold_materialized": f"WITH {GOLD_FEATURES} SELECT * FROM gold",
    "table_sample": f'WITH {GOLD_FEATURES} SELECT * FROM gold ORDER BY "Lead Number" LIMIT 5',
    "gold_export": f"WITH {GOLD_FEATURES} SELECT *, (SELECT max(ingestion_date) FROM bronze_all) AS ingestion_date FROM gold",
    "distinct_categories": "SELECT DISTINCT p_type AS v FROM part WHERE p_type IS NOT NULL",
    "one_hot_dynamic": "SELECT p_partkey, " + ", ".join(
        f"ifnull(p_type = '{v}', false)::INTEGER AS p_type__{v.lower()}" for v in PART_TYPES) + " FROM part",
    "one_hot_long": "SELECT p_partkey, 'p_type__' || lower(p_type) AS dummy FROM part WHERE p_type IS NOT NULL",
    "levels_applied": "SELECT p_partkey, " + ", ".join(
        f"(p_type = '{v}')::INTEGER AS p_type__{v.lower()}" for v in PART_TYPES if v != "PROMO")
        + ", (p_type = 'PROMO')::INTEGER AS p_type__unseen FROM part WHERE p_partkey % 3 <> 0 AND p_type <> 'SMALL'",
    "profile_window": f"WITH {SILVER}" + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, count({c}) AS n_values, "
        f"count(*) - count({c}) AS n_nulls, true AS distinct_within_error FROM silver "
        "WHERE ingestion_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
        for c in ("total_time_spent_on_website", "page_views_per_visit", "total_visits", "average_time_per_visit")),
    "safe_names": f"SELECT p_partkey, p_brand, {safe_name_sql('brand', 'p_brand')} AS safe_name "
                  "FROM part",
    "clamp_round": """SELECT c_custkey,
  greatest(0, least(60, CAST(trunc(c_acctbal / 100) AS INTEGER))) AS visits_like,
  round(greatest(0.0, least(5000.0, c_acctbal)), 2) AS balance_clamped
FROM customer""",
    "weighted_category": "SELECT c_custkey, "
        + weighted_case("c_custkey", CITY_WEIGHTS, 42) + " AS city, "
        + weighted_case("c_custkey", LEAD_ORIGIN_WEIGHTS, 43) + " AS lead_origin, CAST("
        + weighted_case("c_custkey", CONVERTED_WEIGHTS, 44) + " AS INTEGER) AS converted FROM customer",
    "encode_messages": f"WITH {MSGS} SELECT key, value, timestamp FROM msgs",
    "shift_event_time": f"""SELECT event_id, ts + to_seconds(event_id % 3600) AS event_time,
  strftime(ts + to_seconds(event_id % 3600), {ISO}) AS event_time_iso FROM events""",
    "metrics_pivot": f"WITH {TRACKING} SELECT * FROM pivoted",
    "upsert_metrics": f"WITH {UPSERTED} SELECT * FROM reporting",
    "runs_newest_first": f"""WITH {TRACKING}
SELECT run_uuid, experiment_name, start_time, CAST(1 + (SELECT count(*) FROM pivoted b
  WHERE b.experiment_name = a.experiment_name
    AND (b.start_time > a.start_time OR b.start_time = a.start_time AND b.run_uuid < a.run_uuid)) AS INTEGER) AS newest_rank
FROM pivoted a""",
    "sync_default_time": f"WITH {TRACKING} SELECT run_uuid AS run_id, true AS synced_now FROM pivoted",
    "dashboard_view": f"{DASHBOARD} SELECT * FROM view",
    "dashboard_by_name": f"""{DASHBOARD}
SELECT experiment_name, count(*) AS n_runs, max(f1) AS best_f1, max(accuracy) AS best_accuracy
FROM view GROUP BY experiment_name""",
    "threshold_scores": """SELECT l_orderkey, l_linenumber, l_discount * 10 AS probability,
  CAST(ifnull(l_discount * 10 > 0.5, false) AS INTEGER) AS prediction FROM lineitem""",
    "test_scores": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", CAST(ifnull("Converted", 0) AS DOUBLE) AS label, true AS in_range, true AS class_agrees
FROM (SELECT *, {exact_part('"Lead Number"', '"Lead Number"')} AS part FROM gold) WHERE part = 'test'""",
    "exact_split": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", {exact_part(SOME_KEYS, '"Lead Number"')} AS split FROM gold""",
    "stored_model_scores": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", true AS same_probability, true AS same_class FROM gold""",
    "early_stopping": """SELECT true AS best_is_first_highest, true AS stopped_by_patience_or_budget,
  true AS model_ends_with_last_round, true AS last_auc_agrees""",
    "scored_leads": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", true AS in_range, true AS class_agrees FROM gold""",
    "logged_metrics": """SELECT unnest(['auc', 'precision', 'recall', 'true_positives', 'true_negatives',
  'false_positives', 'false_negatives', 'best_iteration', 'stopped_iteration']) AS key, true AS ok""",
    "feature_profile": PROFILE,
    "training_matrix": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", CAST(coalesce("Converted", 0) AS DOUBLE) AS label,
""" + ",\n".join(
        [f"CAST(coalesce({_q(c)}, 'NaN'::DOUBLE) AS DOUBLE) AS {_q(c)}" for c in GOLD_NUMERIC_NAMES]
        + [f"CAST(coalesce({_q(c)}, 0) AS DOUBLE) AS {_q(c)}" for c in GOLD_DUMMY_NAMES])
        + " FROM gold",
    "train_test_split": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", CASE WHEN {split_bucket(SOME_KEYS)} < 80 THEN 'train' ELSE 'test' END AS split
FROM gold""",
    "confusion_metrics": """WITH s AS (
  SELECT quality AS label, CASE WHEN CAST(toxic AS DOUBLE) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labels
),
c AS (
  SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
         count(*) FILTER (WHERE prediction <> 1 AND label <> 1) AS tn,
         count(*) FILTER (WHERE prediction = 1 AND label <> 1) AS fp,
         count(*) FILTER (WHERE prediction <> 1 AND label = 1) AS fn
  FROM s
)
SELECT tp, tn, fp, fn,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END
    AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall
FROM c""",
    "auc_by_group": AUC,
    "bronze_stream_ingest": f"WITH {bronze_cte()} {BRONZE_COLS}",
    "stream_two_runs": f"WITH {bronze_cte()} {BRONZE_COLS}",
    "stream_backfill": f"WITH {bronze_cte(override='2024-01-15')} {BRONZE_COLS}",
    "ingest_dead_letters": f"""WITH {MSGS},
faulty AS (SELECT key, timestamp, value::VARCHAR AS v, key::BIGINT % 23 AS n FROM msgs)
SELECT key AS kafka_key, timestamp AS kafka_timestamp, CAST(timestamp AS DATE) AS ingestion_date,
  CASE n WHEN 3 THEN 'malformed_json' WHEN 5 THEN 'invalid_utf8' WHEN 7 THEN 'missing_value' WHEN 11 THEN 'malformed_json' END AS reason,
  CASE n WHEN 3 THEN md5(left(v, length(v) - 5)) WHEN 5 THEN md5(encode(v) || '\\xFF'::BLOB) WHEN 7 THEN NULL WHEN 11 THEN md5('')
         ELSE md5(v) END AS value_md5
FROM faulty""",
    "partition_files": f"""WITH {bronze_cte()}
SELECT ingestion_date, count(DISTINCT kafka_key::BIGINT % 2) AS n_files, count(*) AS n_rows, true AS schema_ok
FROM bronze GROUP BY ingestion_date""",
    "relation_check": f"""{DASHBOARD}
SELECT run_id, true AS exists, (SELECT count(*) FROM view) AS n_rows, 'ok' AS status FROM view ORDER BY run_id LIMIT 5""",
    "retried_read": f"WITH {GOLD_FEATURES} SELECT 3 AS tries, count(*) AS n_rows FROM gold",
    "table_if_absent": f"""WITH {TRACKING}
SELECT experiment_name, count(*) AS n_rows, true AS created_empty, true AS typed, true AS newer_version_kept
FROM pivoted GROUP BY experiment_name""",
    "assembled_vectors": f"""WITH {GOLD_FEATURES}
SELECT "Lead Number", """ + ", ".join(
        f"CAST(coalesce({_q(c)}, {0 if c in GOLD_DUMMY_NAMES else repr('NaN')}::DOUBLE) AS DOUBLE) AS f{k}"
        for k, c in enumerate(GOLD_FEATURE_NAMES)) + f", {len(GOLD_FEATURE_NAMES)} AS n_features FROM gold",
    "importance_facts": f"""SELECT {len(GOLD_FEATURE_NAMES)} AS n_features, true AS known_features, true AS shares_of_one,
  true AS largest_first, true AS top_is_the_front""",
    "parity_pending": f"""WITH {MSGS},
counted AS (
  SELECT CAST(timestamp AS DATE) AS ingestion_date, count(*) FILTER (WHERE key::BIGINT % 2 = 0) AS taken,
         count(*) FILTER (WHERE key::BIGINT % 2 = 1 AND day(timestamp) % 3 <> 0) AS waiting
  FROM msgs GROUP BY 1)
SELECT ingestion_date, taken AS source_rows, waiting AS pending_rows, taken AS bronze_rows,
       CASE WHEN waiting > 0 THEN 'pending' ELSE 'ok' END AS status, 0::BIGINT AS missing_rows
FROM counted WHERE taken + waiting > 0""",
    "audited_publication": f"""WITH {GOLD_FEATURES},
spoilt AS (
  SELECT * REPLACE (CASE WHEN "Lead Number" % 31 = 0 THEN 2 ELSE "Tags_Ringing" END AS "Tags_Ringing",
                    CASE WHEN "Lead Number" % 37 <> 0 THEN "Converted" END AS "Converted")
  FROM gold, range(CASE WHEN "Lead Number" % 50 = 0 THEN 2 ELSE 1 END)),
found AS (
""" + "\n  UNION ALL ".join(
        f"SELECT {k} AS attempt, '{test}' AS test, '{c}' AS column_name, ({n}) AS failing_rows FROM {rows}"
        for k, rows in enumerate(("gold", "spoilt"))
        for test, c, n in ([("not_null", c, f"count(*) FILTER (WHERE {_q(c)} IS NULL)") for c in GOLD_NOT_NULL]
                           + [("unique", GOLD_ID, f"count({_q(GOLD_ID)}) - count(DISTINCT {_q(GOLD_ID)})")]
                           + [("accepted_values", c, f"count(*) FILTER (WHERE {_q(c)} NOT IN (0, 1))") for c in GOLD_ACCEPTED]
                           + [("row_count", "*", "greatest(1 - count(*), 0)")])) + """)
SELECT 'leads_gold_features' AS model, test, column_name, failing_rows::BIGINT AS failing_rows, failing_rows = 0 AS passed,
       attempt::INTEGER AS attempt, attempt = 0 AS published, attempt = 0 AS current FROM found""",
}
