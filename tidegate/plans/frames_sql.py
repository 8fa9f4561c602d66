"""The derived tables of ``frames`` as SQL, to be put into a WITH clause."""

from __future__ import annotations

from tidegate.plans.frames import COPY_OPTIONS, FILE_OPTIONS, FLOOR_DATE

AUDIT = """
audit AS (
  SELECT *, date_diff('second', start_time, end_time) AS duration_seconds FROM (
  SELECT event_id AS ingestion_log_id,
    CAST(user_id % 8 + 1 AS INTEGER) AS ingestion_config_id,
    'B' || strftime(ts, '%Y%m%d%H') AS batch_id,
    'R' || event_id AS pipeline_run_id,
    'object_load' AS pipeline_name,
    CASE WHEN event_id % 10 = 0 THEN 'BACKFILL' ELSE 'REGULAR' END AS run_type,
    CASE user_id % 5 WHEN 0 THEN 'SHOP' WHEN 1 THEN ' CARRIER ' WHEN 2 THEN 'BENCH'
      WHEN 3 THEN '   ' ELSE 'shop' END AS source_system,
    CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'sales' END AS source_schema,
    'obj_' || (user_id % 5) AS source_object,
    CASE WHEN event_id % 4 = 0 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_strategy,
    strftime(ts, '%Y-%m-%dT%H:00:00') AS processing_lower_bound,
    strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:00:00') AS processing_upper_bound,
    CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
      AS source_row_count,
    CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
      AS target_row_count,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'SUCCESS'
      WHEN event_type = 'view' THEN 'SKIPPED' WHEN event_type = 'error' THEN 'FAILED'
      WHEN user_id % 2 = 0 THEN 'CANCELLED' ELSE 'WARN' END AS status,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'WATERMARK_CONFLICT'
      WHEN event_type = 'error' THEN 'SOURCE_QUERY_FAILED' END AS error_code,
    CASE WHEN event_type = 'error' THEN
      'failed after ' || json_extract_string(props, '$.k') || ' rows' END AS error_message,
    ts AS start_time,
    ts + to_seconds(CAST(floor(value) AS INTEGER)) + to_milliseconds(500) AS end_time
  FROM events))"""

_copy_cases = " ".join(
    f"WHEN {place} THEN '{options}'"
    for place, options in enumerate(COPY_OPTIONS)
    if options is not None
)

CONFIGS = f"""
configs AS (
  SELECT CAST(c_custkey + 1 AS INTEGER) AS ingestion_config_id,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SHOP' WHEN 'BUILDING' THEN 'shop '
      WHEN 'FURNITURE' THEN 'CARRIER' WHEN 'HOUSEHOLD' THEN 'CARRIER' ELSE 'BENCH' END
      AS source_system,
    'C' || c_nationkey AS source_conn_ref,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
      THEN CASE WHEN c_nationkey = 13 THEN chr(9) || ' ' ELSE 'sales' END END AS source_schema,
    'obj_' || c_custkey AS source_object,
    CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') AND c_nationkey <> 14
      THEN '/outbound/feed/' END AS source_path,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'DATABASE'
      WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'FILE' ELSE 'API' END
      AS ingestion_pattern,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'DELIMITED_TEXT'
      WHEN c_mktsegment = 'FURNITURE' AND c_nationkey <> 15 THEN 'PARQUET' END AS file_format,
    CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN
      CASE WHEN c_nationkey = 12 THEN '{{"delimiter":","}} more' ELSE '{FILE_OPTIONS}' END END
      AS source_options,
    CASE c_nationkey {_copy_cases} END AS copy_options,
    CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN
      CASE WHEN c_nationkey = 16 THEN ' ' ELSE 'landing/feed/' END END AS landing_path,
    'L' || c_nationkey AS target_conn_ref,
    'bronze' AS target_schema,
    CASE WHEN c_nationkey = 17 THEN ' ' || chr(10) ELSE 't_' || c_custkey END AS target_table,
    CASE WHEN c_acctbal < 5000 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_strategy,
    CASE WHEN c_acctbal >= 5000 OR c_nationkey = 18 THEN NULL
      WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') AND c_nationkey = 9 THEN 'file_name'
      WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'last_modified_time'
      ELSE 'updated_at' END AS watermark_field,
    c_acctbal >= 0 AS is_active,
    c_nationkey AS nation
  FROM customer)"""

CONNECTIONS = """
connections AS (
  SELECT 'C' || n_nationkey AS connection_ref,
    CASE WHEN n_regionkey IN (0, 1) THEN 'SQL_SERVER' WHEN n_regionkey IN (2, 3) THEN 'sftp'
      ELSE 'LAKEHOUSE' END AS connection_type,
    '{"connectionId":"' || n_name || '"}' AS connection_settings
  FROM nation WHERE n_name <> 'NATION_19'
  UNION ALL
  SELECT 'L' || n_nationkey, CASE WHEN n_regionkey = 4 THEN 'FTP' ELSE 'LAKEHOUSE' END,
    CASE WHEN n_regionkey = 3 THEN '[]' ELSE '{"itemId":"lake"}' END
  FROM nation WHERE n_name <> 'NATION_19')"""

SOURCE_MAX = """
source_max AS (
  SELECT CAST(o_custkey + 1 AS INTEGER) AS config_id,
    strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S.%g') AS source_upper_bound
  FROM orders GROUP BY o_custkey)"""

STATE = f"""
state AS (
  SELECT CAST(c_custkey + 1 AS INTEGER) AS ingestion_config_id,
    CASE WHEN c_nationkey = 5 THEN 'another_field'
      WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'last_modified_time'
      ELSE 'updated_at' END AS watermark_field,
    CASE WHEN c_nationkey = 7 AND source_upper_bound IS NOT NULL THEN source_upper_bound
      WHEN c_nationkey = 8 AND source_upper_bound IS NOT NULL THEN source_upper_bound || 'Z'
      WHEN c_nationkey = 20 THEN ' ' || chr(9)
      ELSE strftime(DATE '{FLOOR_DATE}' + CAST(c_custkey % 1500 AS INTEGER), '%Y-%m-%d')
        || 'T00:00:00' END AS last_watermark_value
  FROM customer LEFT JOIN source_max ON config_id = c_custkey + 1
  WHERE c_acctbal < 5000 AND c_nationkey <> 3)"""

REQUESTS = """
requests AS (
  SELECT o_orderkey AS request_id,
    CAST(o_custkey + 1 + CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
      THEN 1000000000 ELSE 0 END AS INTEGER) AS config_id,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'BACKFILL'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'regular' ELSE 'REGULAR' END AS run_type,
    CASE WHEN (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O'))
        OR (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O')
      THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') ELSE '' END AS lower_bound,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'
      THEN strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INTEGER), '%Y-%m-%d')
        || 'T00:00:00' ELSE '' END AS upper_bound
  FROM orders)"""

FINALIZE = """
base AS (
  SELECT event_id * 2 AS call_order, event_id, event_type AS kind,
    CAST(user_id + 1 AS INTEGER) AS ingestion_config_id,
    'B' || strftime(ts, '%Y%m%d%H') AS batch_id,
    'R' || event_id AS pipeline_run_id,
    CASE WHEN event_id % 3 = 0 THEN '2023-12-31T00:00:00' ELSE '2024-01-01T00:00:00' END AS low,
    CASE WHEN event_id % 13 = 0 THEN NULL
      WHEN event_id % 11 = 0 THEN
        CASE WHEN event_id % 3 = 0 THEN '2023-12-31T00:00:00' ELSE '2024-01-01T00:00:00' END
      ELSE 'H' || event_id END AS high,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'SUCCESS'
      WHEN event_type = 'view' THEN 'SKIPPED' WHEN event_type = 'error' THEN 'FAILED'
      ELSE 'CANCELLED' END AS status,
    event_id % 17 = 0 AS ends_early,
    event_type IN ('purchase', 'click') OR (event_type = 'error' AND event_id % 5 = 0)
      AS advance
  FROM events),
calls AS (
  SELECT *, false AS replay FROM base
  UNION ALL
  SELECT call_order + CASE WHEN kind = 'purchase' AND event_id % 2 = 0 THEN 0 ELSE 1 END, event_id, kind, ingestion_config_id, batch_id, pipeline_run_id, low, high,
    CASE WHEN kind = 'view' THEN 'SUCCESS' ELSE status END, ends_early, advance, true
  FROM base WHERE kind IN ('purchase', 'view')),
current_state AS (
  SELECT CAST(c_custkey + 1 AS INTEGER) AS config_id,
    CASE WHEN c_acctbal < 0 THEN '2022-02-02T00:00:00' ELSE '2024-01-01T00:00:00' END AS value
  FROM customer),
argued AS (
  SELECT *, CASE WHEN NOT advance THEN NULL WHEN status <> 'SUCCESS' THEN 51003
      WHEN high IS NULL THEN 51004 WHEN high = low THEN 51005 END AS own_error
  FROM calls),
winner AS (
  SELECT ingestion_config_id AS config_id, min(call_order) AS call_order
  FROM argued JOIN current_state ON config_id = ingestion_config_id AND value = low
  WHERE advance AND own_error IS NULL AND NOT ends_early AND NOT replay
  GROUP BY ingestion_config_id),
first_use AS (
  SELECT a.pipeline_run_id,
    a.advance AND w.call_order IS NULL AS lost, a.status
  FROM argued a LEFT JOIN winner w ON w.call_order = a.call_order
  WHERE NOT replay AND own_error IS NULL AND NOT ends_early AND kind <> 'signup'),
judged AS (
  SELECT a.call_order, a.pipeline_run_id, a.ingestion_config_id, a.batch_id, a.low, a.high,
    CASE WHEN ends_early THEN 51000
      WHEN kind = 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 51007 END
      WHEN replay AND f.pipeline_run_id IS NOT NULL THEN
        CASE WHEN f.lost OR a.status <> f.status THEN 51007 END
      WHEN own_error IS NOT NULL THEN own_error
      WHEN f.lost THEN 51006 END AS error_number,
    kind = 'signup' OR (replay AND f.pipeline_run_id IS NOT NULL) AS seen_before,
    a.advance, a.replay
  FROM argued a LEFT JOIN first_use f USING (pipeline_run_id)),
outcomes AS (
  SELECT *, CASE WHEN error_number = 51006 THEN 'CONFLICT'
      WHEN error_number IS NOT NULL THEN 'REJECTED'
      WHEN seen_before THEN 'NO_OP' ELSE 'RECORDED' END AS outcome
  FROM judged)"""


def with_tables(*tables: str, body: str) -> str:
    return "WITH " + ",".join(tables) + "\n" + body.strip()
