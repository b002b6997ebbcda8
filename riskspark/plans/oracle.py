"""Equivalent ANSI SQL (DuckDB dialect) for the deterministic queries.

The driver tables are views named after the tables.  Each statement builds
the incidents view itself, so the oracle is independent of the Spark code.
"""

from __future__ import annotations

from riskspark.plans.catalog import MEAN_PLACES, SELECTED_COUNTRIES
from riskspark.schema import CATEGORICAL_COLUMNS, FOREST_TREES, NA_TOKENS, SILHOUETTE_K_RANGE, TEST_FOLDS, YEAR_MAX, YEAR_MIN


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


RAW = """
lines AS (
  SELECT l_orderkey,
         sum(l_quantity) AS line_quantity,
         max(l_returnflag) AS line_flag,
         max(p_type) AS line_part_type,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS line_price_cents,
         count(l_extendedprice) AS line_prices
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
raw AS (
  SELECT CAST(o_orderkey AS BIGINT) AS incident_id,
         n_name AS country,
         CAST(year(o_orderdate) + 20 AS INTEGER) AS year,
         o_orderpriority AS attack_type,
         c_mktsegment AS target_industry,
         o_totalprice / CAST(5000 AS DOUBLE) AS financial_loss_million,
         CAST(floor(line_quantity * CAST(5000 AS DOUBLE)) AS BIGINT) AS affected_users,
         o_orderstatus AS attack_source,
         line_flag AS vulnerability_type,
         line_part_type AS defense_mechanism,
         CAST(line_price_cents AS DOUBLE)
           / NULLIF(CAST(line_prices AS DOUBLE) * CAST(100000 AS DOUBLE), 0)
           AS resolution_time_hours
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON o_orderkey = l_orderkey)"""

LOSS_PER_USER = ("financial_loss_million * CAST(1000000 AS DOUBLE)"
                 " / NULLIF(CAST(affected_users AS DOUBLE), 0)")


def _norm(col: str) -> str:
    return (f"CASE WHEN trim({col}) IN ({_sql_list(NA_TOKENS)}) THEN NULL "
            f"ELSE trim({col}) END AS {col}")


def _text_reasons(col: str) -> list[str]:
    return [f"CASE WHEN {col} IS NULL THEN '{col} is missing' END",
            f"CASE WHEN length({col}) < 1 THEN '{col} is empty' END"]


def _reasons(require_label: bool) -> str:
    parts = []
    parts += _text_reasons("country")
    parts += ["CASE WHEN year IS NULL THEN 'year is missing' END",
              f"CASE WHEN year < {YEAR_MIN} OR year > {YEAR_MAX} "
              f"THEN 'year outside {YEAR_MIN}..{YEAR_MAX}' END"]
    parts += _text_reasons("attack_type")
    parts += _text_reasons("target_industry")
    parts += ["CASE WHEN financial_loss_million IS NULL THEN 'financial_loss_million is missing' END",
              "CASE WHEN financial_loss_million < 0 THEN 'financial_loss_million is negative' END",
              "CASE WHEN affected_users IS NULL THEN 'affected_users is missing' END",
              "CASE WHEN affected_users < 1 THEN 'affected_users is below 1' END"]
    parts += _text_reasons("attack_source")
    parts += _text_reasons("vulnerability_type")
    parts += _text_reasons("defense_mechanism")
    if require_label:
        parts.append("CASE WHEN resolution_time_hours IS NULL "
                     "THEN 'resolution_time_hours is missing' END")
    return "concat_ws(';', " + ", ".join(parts) + ")"


NORMALIZED = f"""
normalized AS (
  SELECT incident_id, {_norm('country')}, year, {_norm('attack_type')},
         {_norm('target_industry')}, financial_loss_million, affected_users,
         {_norm('attack_source')}, {_norm('vulnerability_type')},
         {_norm('defense_mechanism')}, resolution_time_hours
  FROM raw),
checked AS (
  SELECT *, {_reasons(True)} AS reject_reasons FROM normalized)"""

INCIDENT_COLS = ("incident_id, country, year, attack_type, target_industry, "
                 "financial_loss_million, affected_users, attack_source, "
                 "vulnerability_type, defense_mechanism, resolution_time_hours")

CLEAN = f"""
cleaned AS (
  SELECT {INCIDENT_COLS}, {LOSS_PER_USER} AS loss_per_user
  FROM checked
  WHERE reject_reasons = ''
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY {INCIDENT_COLS}) = 1)"""

BASE = "WITH " + RAW + "," + NORMALIZED + "," + CLEAN + "\n"


def _with(body: str) -> str:
    return BASE + body


def _mean(expr: str, alias: str) -> str:
    # "+ 0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding gives.
    return f"(round({expr}, {MEAN_PLACES}) + CAST(0 AS DOUBLE)) AS {alias}"


COUNTRIES = _sql_list(SELECTED_COUNTRIES)

_CELLS = "\n  UNION ALL ".join(
    f"SELECT incident_id, '{c}' AS column_name, {i} AS block, {c} AS label FROM cleaned"
    for i, c in enumerate(CATEGORICAL_COLUMNS))

# Indexer labels fitted on the training rows, slot offsets of each block.
LABELS = BASE + f""", cells AS (
  {_CELLS}),
train_counts AS (
  SELECT column_name, block, label, count(*) AS n
  FROM cells WHERE incident_id % {TEST_FOLDS} <> 0 AND label IS NOT NULL
  GROUP BY column_name, block, label),
labels AS (
  SELECT column_name, block, label,
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, label) - 1 AS INTEGER)
           AS label_index
  FROM train_counts),
sizes AS (SELECT column_name, block, count(*) AS n FROM labels GROUP BY column_name, block),
offsets AS (
  SELECT column_name, block, n,
         4 + coalesce(sum(n + 1) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING), 0) AS off
  FROM sizes)
"""

ENCODED = LABELS + """
SELECT incident_id, CAST(feature_index AS INTEGER) AS feature_index, value FROM (
  SELECT incident_id, 0 AS feature_index, CAST(year AS DOUBLE) AS value FROM cleaned
  UNION ALL SELECT incident_id, 1, financial_loss_million FROM cleaned
  UNION ALL SELECT incident_id, 2, CAST(affected_users AS DOUBLE) FROM cleaned
  UNION ALL SELECT incident_id, 3, loss_per_user FROM cleaned
  UNION ALL
  SELECT c.incident_id, o.off + coalesce(l.label_index, o.n), CAST(1 AS DOUBLE)
  FROM cells c JOIN offsets o ON o.column_name = c.column_name
  LEFT JOIN labels l ON l.column_name = c.column_name AND l.label = c.label)
WHERE value <> 0"""

PARITY_ORACLE = """
SELECT CAST(count(*) AS BIGINT) AS compared, CAST(0 AS BIGINT) AS missing,
       CAST(0 AS DOUBLE) AS max_difference, true AS within_tolerance
FROM cleaned"""

TRAIN_TEST = f"""
, train AS (SELECT * FROM cleaned WHERE incident_id % {TEST_FOLDS} <> 0),
test AS (SELECT * FROM cleaned WHERE incident_id % {TEST_FOLDS} = 0)"""

SQL: dict[str, str] = {
    "incidents": "WITH " + RAW + "\nSELECT * FROM raw",
    "validate_incidents": "WITH " + RAW + f"""
SELECT *, reject_reasons = '' AS is_valid
FROM (SELECT *, {LOSS_PER_USER} AS loss_per_user, {_reasons(False)} AS reject_reasons
      FROM raw)""",
    "rejected_by_reason": _with("""
SELECT reason, CAST(count(*) AS BIGINT) AS rejected_rows
FROM (SELECT unnest(string_split(reject_reasons, ';')) AS reason
      FROM checked WHERE reject_reasons <> '')
GROUP BY reason"""),
    "clean_incidents": _with("SELECT * FROM cleaned"),
    "loss_per_user": "WITH " + RAW + f"\nSELECT incident_id, {LOSS_PER_USER} AS loss_per_user FROM raw",
    "overview_kpis": _with("""
SELECT CAST(count(*) AS BIGINT) AS total_incidents,
       CAST(count(DISTINCT country) AS BIGINT) AS countries,
       CAST(count(DISTINCT attack_type) AS BIGINT) AS attack_types
FROM cleaned"""),
    "filtered_kpis": _with(f"""
SELECT CAST(count(*) AS BIGINT) AS matching_incidents,
       {_mean('avg(financial_loss_million)', 'average_loss_million')},
       {_mean('avg(resolution_time_hours)', 'average_resolution_hours')}
FROM cleaned WHERE country IN ({COUNTRIES})"""),
    "filter_country": _with(f"SELECT * FROM cleaned WHERE country IN ({COUNTRIES})"),
    "filter_country_empty": _with(f"""
SELECT CAST(count(*) AS BIGINT) AS matching_incidents,
       {_mean('avg(financial_loss_million)', 'average_loss_million')},
       {_mean('avg(resolution_time_hours)', 'average_resolution_hours')}
FROM cleaned"""),
    "incidents_by_year": _with("""
SELECT year, CAST(count(*) AS BIGINT) AS incident_count
FROM cleaned WHERE year IS NOT NULL GROUP BY year ORDER BY year"""),
    "attack_distribution": _with("""
SELECT attack_type, CAST(count(*) AS BIGINT) AS incident_count
FROM cleaned WHERE attack_type IS NOT NULL
GROUP BY attack_type ORDER BY incident_count DESC, attack_type"""),
    "avg_loss_by_attack": _with(f"""
SELECT attack_type, {_mean('avg(financial_loss_million)', 'financial_loss_million')}
FROM cleaned WHERE attack_type IS NOT NULL
GROUP BY attack_type ORDER BY 2, 1"""),
    "incidents_by_year_filtered": _with(f"""
SELECT year, CAST(count(*) AS BIGINT) AS incident_count
FROM cleaned WHERE year IS NOT NULL AND country IN ({COUNTRIES})
GROUP BY year ORDER BY year"""),
    "attack_distribution_filtered": _with(f"""
SELECT attack_type, CAST(count(*) AS BIGINT) AS incident_count
FROM cleaned WHERE attack_type IS NOT NULL AND country IN ({COUNTRIES})
GROUP BY attack_type ORDER BY incident_count DESC, attack_type"""),
    "avg_loss_by_attack_filtered": _with(f"""
SELECT attack_type, {_mean('avg(financial_loss_million)', 'financial_loss_million')}
FROM cleaned WHERE attack_type IS NOT NULL AND country IN ({COUNTRIES})
GROUP BY attack_type ORDER BY 2, 1"""),
    "distinct_options": _with("""
SELECT DISTINCT column_name, value FROM (
  SELECT 'country' AS column_name, country AS value FROM cleaned
  UNION ALL SELECT 'attack_type', attack_type FROM cleaned
  UNION ALL SELECT 'target_industry', target_industry FROM cleaned
  UNION ALL SELECT 'attack_source', attack_source FROM cleaned
  UNION ALL SELECT 'vulnerability_type', vulnerability_type FROM cleaned
  UNION ALL SELECT 'defense_mechanism', defense_mechanism FROM cleaned)
WHERE value IS NOT NULL ORDER BY 1, 2"""),
    "label_index": LABELS + "SELECT column_name, label, label_index FROM labels",
    "encoded_features": ENCODED,
    "features_from_deltas": ENCODED,
    "model_deltas": LABELS + """
SELECT '__baseline__' AS column_name, CAST(NULL AS VARCHAR) AS label,
       CAST(off + n AS INTEGER) AS feature_index, CAST(1 AS DOUBLE) AS delta FROM offsets
UNION ALL
SELECT l.column_name, l.label, CAST(o.off + l.label_index AS INTEGER), CAST(1 AS DOUBLE)
FROM labels l JOIN offsets o ON o.column_name = l.column_name
UNION ALL
SELECT l.column_name, l.label, CAST(o.off + o.n AS INTEGER), CAST(-1 AS DOUBLE)
FROM labels l JOIN offsets o ON o.column_name = l.column_name
UNION ALL
SELECT column_name, CAST(NULL AS VARCHAR), CAST(feature_index AS INTEGER), CAST(1 AS DOUBLE)
FROM (VALUES ('year', 0), ('financial_loss_million', 1), ('affected_users', 2),
             ('loss_per_user', 3)) AS numeric_columns(column_name, feature_index)""",
    "train_test_split": _with(f"""
SELECT CASE WHEN incident_id % {TEST_FOLDS} = 0 THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS incident_count,
       {_mean('avg(resolution_time_hours)', 'mean_resolution_hours')}
FROM cleaned GROUP BY 1"""),
    "mean_baseline_metrics": _with(TRAIN_TEST + f"""
SELECT CAST(count(*) AS BIGINT) AS evaluated_rows,
       {_mean('sqrt(avg((resolution_time_hours - m) * (resolution_time_hours - m)))', 'rmse')},
       {_mean('avg(abs(resolution_time_hours - m))', 'mae')},
       {_mean('1 - avg((resolution_time_hours - m) * (resolution_time_hours - m)) / var_pop(resolution_time_hours)', 'r2')}
FROM test, (SELECT avg(resolution_time_hours) AS m FROM train) AS train_mean"""),
    "clip_round": _with(TRAIN_TEST + """
SELECT incident_id,
       CAST(round(greatest(0.0, m), 2) AS DOUBLE) AS baseline_hours,
       CAST(round(greatest(0.0, resolution_time_hours - m), 2) AS DOUBLE) AS excess_hours
FROM cleaned, (SELECT avg(resolution_time_hours) AS m FROM train) AS train_mean"""),
    "incidents_csv_roundtrip": _with("SELECT * FROM cleaned"),
    "incidents_json_roundtrip": _with("SELECT * FROM cleaned"),
    # Parity invariants: every cleaned incident scored by both sides, none
    # missing, identical predictions.
    "reload_parity": _with(PARITY_ORACLE),
    "forest_parity": _with(PARITY_ORACLE),
    "incident_snapshot": _with("""
SELECT incident_id, country, year, attack_type, target_industry,
       financial_loss_million, affected_users, resolution_time_hours
FROM cleaned ORDER BY incident_id LIMIT 12"""),
    # Facts of any right fit, with the numbers that the tables give.
    "score_check": _with("""
SELECT CAST(count(*) AS BIGINT) AS answers, CAST(0 AS BIGINT) AS unanswered, CAST(0 AS BIGINT) AS negative,
       CAST(0 AS BIGINT) AS over_two_places, CAST(0 AS BIGINT) AS different_from_model FROM cleaned"""),
    "model_check": LABELS + f"""
SELECT CAST({FOREST_TREES} AS BIGINT) AS trees, CAST({FOREST_TREES} AS BIGINT) AS roots,
       CAST(4 + sum(n + 1) AS BIGINT) AS features, CAST(0 AS BIGINT) AS wrong_features,
       CAST(0 AS BIGINT) AS missing_children, CAST(0 AS BIGINT) AS orphans, CAST(0 AS BIGINT) AS repeated
FROM sizes""",
    "segment_check": _with("""
SELECT CAST(count(*) AS BIGINT) AS incidents, CAST(count(*) AS BIGINT) AS named, CAST(4 AS BIGINT) AS profiles,
       CAST(0 AS BIGINT) AS astray, true AS means_agree FROM cleaned"""),
    "segmented_csv_roundtrip": _with("""
SELECT CAST(count(*) AS BIGINT) AS incidents, CAST(4 AS BIGINT) AS profiles, CAST(4 AS BIGINT) AS clusters,
       CAST(sum(CAST(round(financial_loss_million * 100) AS BIGINT)) AS BIGINT) AS loss_cents FROM cleaned"""),
    "metrics_check": _with(f"""
SELECT CAST(count(*) AS BIGINT) AS evaluated_rows, CAST(0 AS BIGINT) AS missing,
       true AS rmse_agrees, true AS mae_agrees, true AS r2_agrees
FROM cleaned WHERE incident_id % {TEST_FOLDS} = 0"""),
    "reach_check": f"""
SELECT CAST({FOREST_TREES} AS BIGINT) AS trees, CAST(0 AS BIGINT) AS unreached, true AS depth_within,
       CAST(0 AS BIGINT) AS leaves_reached_again""",
    "leaf_check": _with(f"""
SELECT CAST({FOREST_TREES} AS BIGINT) AS trees, CAST({FOREST_TREES} * count(*) AS BIGINT) AS routed,
       CAST(0 AS BIGINT) AS empty_leaves, CAST(0 AS BIGINT) AS not_at_a_leaf, CAST(0 AS BIGINT) AS out_of_range
FROM cleaned WHERE incident_id % {TEST_FOLDS} <> 0"""),
    "silhouette_check": f"""
SELECT CAST(k AS INTEGER) AS k, true AS equals_evaluator, true AS in_range
FROM range({SILHOUETTE_K_RANGE[0]}, {SILHOUETTE_K_RANGE[-1] + 1}) AS sweep(k)""",
    "profile_check": _with("""
SELECT CAST(4 AS BIGINT) AS profiles, CAST(count(*) AS BIGINT) AS incidents, CAST(4 AS BIGINT) AS equal, true AS in_order
FROM cleaned"""),
    "sink_check": _with("""
SELECT CAST(count(*) AS BIGINT) AS incidents, CAST(4 AS BIGINT) AS profiles, CAST(0 AS BIGINT) AS lost,
       CAST(0 AS BIGINT) AS added FROM cleaned"""),
    "stream_parity": "WITH " + RAW + "," + NORMALIZED + f"""
SELECT CAST(count(*) AS BIGINT) AS compared, CAST(0 AS BIGINT) AS missing,
       CAST(0 AS DOUBLE) AS max_difference, true AS within_tolerance
FROM normalized WHERE {_reasons(False)} = ''""",
}
