"""Registered queries over configs, requests, state and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import configs as config_ops
from tidegate.operators import contracts, finalize, recovery, requests, routing, windows
from tidegate.plans import frames
from tidegate.plans.frames_sql import (
    AUDIT,
    CONFIGS,
    CONNECTIONS,
    FINALIZE,
    REQUESTS,
    SOURCE_MAX,
    STATE,
    with_tables,
)

QUERIES, SQL = {}, {}

# --- configs and state ---------------------------------------------------------


def select_active_configs(spark, folder):
    return requests.resolve_scope(frames.configs(spark, folder), " Shop ")


SQL["select_active_configs"] = with_tables(
    CONFIGS,
    body="""
SELECT ingestion_config_id AS config_id, 'REGULAR' AS run_type, '' AS lower_bound, '' AS upper_bound
FROM configs WHERE is_active AND lower(rtrim(source_system)) = 'shop'""",
)


def resolve_configs(spark, folder):
    resolved = routing.resolve_connections(
        frames.configs(spark, folder), frames.connections(spark, folder)
    )
    return resolved.select(
        "ingestion_config_id", "source_conn_ref", "source_connection_type",
        "source_connection_settings", "target_conn_ref", "target_connection_type",
        "target_connection_settings",
    )


_RESOLVED = """
resolved AS (
  SELECT c.*, s.connection_type AS source_connection_type,
    s.connection_settings AS source_connection_settings,
    t.connection_type AS target_connection_type,
    t.connection_settings AS target_connection_settings
  FROM configs c JOIN connections s ON s.connection_ref = c.source_conn_ref
    JOIN connections t ON t.connection_ref = c.target_conn_ref)"""

SQL["resolve_configs"] = with_tables(
    CONFIGS,
    CONNECTIONS,
    _RESOLVED,
    body="""
SELECT ingestion_config_id, source_conn_ref, source_connection_type, source_connection_settings,
  target_conn_ref, target_connection_type, target_connection_settings FROM resolved""",
)


def route_objects(spark, folder):
    resolved = routing.resolve_connections(
        frames.configs(spark, folder), frames.connections(spark, folder)
    )
    return routing.route_objects(resolved).select(
        "ingestion_config_id", "ingestion_pattern", "route", "route_error"
    )


SQL["route_objects"] = with_tables(
    CONFIGS,
    CONNECTIONS,
    _RESOLVED,
    body="""
SELECT ingestion_config_id, ingestion_pattern,
  CASE WHEN route_error IS NULL AND ingestion_pattern <> 'API'
    THEN upper(source_connection_type) || '|' || load_strategy END AS route, route_error
FROM (SELECT *, CASE
    WHEN ingestion_pattern = 'FILE' AND (file_format IS NULL OR file_format <> 'DELIMITED_TEXT')
      THEN 'UNSUPPORTED_FILE_FORMAT'
    WHEN ingestion_pattern = 'FILE' AND source_connection_type <> 'sftp'
      THEN 'UNSUPPORTED_FILE_ROUTE'
    WHEN ingestion_pattern = 'DATABASE' AND source_connection_type <> 'SQL_SERVER'
      THEN 'UNSUPPORTED_DATABASE_ROUTE' END AS route_error
  FROM resolved)""",
)


def copy_options_check(spark, folder):
    return routing.check_copy_options(frames.configs(spark, folder)).select(
        "ingestion_config_id", "partition_option", "partition_column", "parallel_copies",
        "copy_error",
    )


SQL["copy_options_check"] = with_tables(
    CONFIGS,
    body="""
SELECT ingestion_config_id,
  CASE WHEN nation IN (2, 3) THEN 'DYNAMIC_RANGE' WHEN nation NOT BETWEEN 4 AND 10 THEN 'NONE' END
    AS partition_option,
  CASE WHEN nation IN (2, 3) THEN 'line_id' END AS partition_column,
  CASE WHEN nation = 3 THEN CAST(8 AS BIGINT) WHEN nation NOT BETWEEN 4 AND 10
    THEN CAST(0 AS BIGINT) END AS parallel_copies,
  CASE WHEN nation BETWEEN 4 AND 10 THEN 'INVALID_COPY_OPTIONS' END AS copy_error
FROM configs""",
)


def copy_options_set(spark, folder):
    """Four parallel copies for every config, then the check of what came of it."""
    changed = routing.set_parallel_copies(frames.configs(spark, folder), 4)
    return routing.check_copy_options(changed).select(
        "ingestion_config_id", "partition_option", "partition_column", "parallel_copies",
        "copy_error",
    )


SQL["copy_options_set"] = with_tables(
    CONFIGS,
    body="""
SELECT ingestion_config_id,
  CASE WHEN nation IN (2, 3) THEN 'DYNAMIC_RANGE' WHEN nation NOT BETWEEN 5 AND 8 THEN 'NONE' END
    AS partition_option,
  CASE WHEN nation IN (2, 3) THEN 'line_id' END AS partition_column,
  CASE WHEN nation NOT BETWEEN 5 AND 8 THEN CAST(4 AS BIGINT) END AS parallel_copies,
  CASE WHEN nation BETWEEN 5 AND 8 THEN 'INVALID_COPY_OPTIONS' END AS copy_error
FROM configs""",
)


def config_pages(spark, folder):
    scope = requests.active_configs(frames.configs(spark, folder))
    return config_ops.config_page(scope, page=1, size=500).select("config_id", "run_type")


SQL["config_pages"] = with_tables(
    CONFIGS,
    body="""
SELECT ingestion_config_id AS config_id, 'REGULAR' AS run_type FROM configs WHERE is_active
ORDER BY ingestion_config_id LIMIT 500 OFFSET 500""",
)


def config_page_count(spark, folder):
    return config_ops.page_count(requests.active_configs(frames.configs(spark, folder)), 500)


SQL["config_page_count"] = with_tables(
    CONFIGS,
    body="""
SELECT count(*) AS active_config_count, CAST(ceil(count(*) / 500.0) AS BIGINT) AS page_count
FROM configs WHERE is_active""",
)


def watermark_view(spark, folder):
    view = config_ops.watermark_view(frames.configs(spark, folder), frames.state(spark, folder))
    return view.select(
        "ingestion_config_id", "source_system", "source_schema", "source_object",
        "load_strategy", "watermark_field", "last_watermark_value",
    )


SQL["watermark_view"] = with_tables(
    CONFIGS,
    SOURCE_MAX,
    STATE,
    body="""
SELECT c.ingestion_config_id, source_system, source_schema, source_object, load_strategy,
  s.watermark_field, last_watermark_value
FROM configs c JOIN state s ON s.ingestion_config_id = c.ingestion_config_id""",
)


def watermark_gaps(spark, folder):
    return config_ops.watermark_gaps(frames.configs(spark, folder), frames.state(spark, folder))


SQL["watermark_gaps"] = with_tables(
    CONFIGS,
    SOURCE_MAX,
    STATE,
    body="""
SELECT * FROM (
  SELECT c.ingestion_config_id, source_system, source_object, c.watermark_field,
    s.watermark_field AS state_field, last_watermark_value,
    CASE WHEN s.watermark_field IS NULL THEN 'MISSING'
      WHEN s.watermark_field IS DISTINCT FROM c.watermark_field THEN 'FIELD_MISMATCH' END AS gap
  FROM configs c LEFT JOIN state s ON s.ingestion_config_id = c.ingestion_config_id
  WHERE load_strategy = 'INCREMENTAL') WHERE gap IS NOT NULL""",
)


def missing_state(spark, folder):
    return config_ops.missing_state(frames.configs(spark, folder), frames.state(spark, folder))


SQL["missing_state"] = with_tables(
    CONFIGS,
    SOURCE_MAX,
    STATE,
    body="""
SELECT ingestion_config_id, watermark_field, '1900-01-01T00:00:00Z' AS last_watermark_value
FROM configs c WHERE load_strategy = 'INCREMENTAL' AND ingestion_pattern IN ('DATABASE', 'FILE')
  AND NOT EXISTS (SELECT 1 FROM state s WHERE s.ingestion_config_id = c.ingestion_config_id)""",
)


def config_upsert(spark, folder):
    everything = frames.configs(spark, folder)
    seed = everything.drop("ingestion_config_id").withColumns(
        {
            "target_schema": F.lit("seeded"),
            "source_system": F.upper("source_system"),
        }
    )
    after = config_ops.upsert_configs(everything.where(F.col("is_active")), seed, "BENCH")
    return after.select(
        "ingestion_config_id", "source_system", "source_schema", "source_object",
        "target_schema", "change",
    )


SQL["config_upsert"] = with_tables(
    CONFIGS,
    body="""
SELECT ingestion_config_id, source_system, source_schema, source_object,
  CASE WHEN source_system = 'BENCH' THEN 'bronze' ELSE 'seeded' END AS target_schema,
  CASE WHEN source_system = 'BENCH' THEN 'KEPT' ELSE 'UPDATED' END AS change
FROM configs WHERE is_active
UNION ALL
SELECT CAST((SELECT max(ingestion_config_id) FROM configs WHERE is_active) + row_number() OVER (
    ORDER BY upper(source_system) NULLS FIRST, source_schema NULLS FIRST, source_object)
    AS INTEGER),
  upper(source_system), source_schema, source_object, 'seeded', 'ADDED'
FROM configs WHERE NOT is_active""",
)



def config_ambiguity(spark, folder):
    """Seeds that spell a key twice, against configs of which some are there twice."""
    configs = frames.configs(spark, folder)
    upper = lambda df: df.withColumn("source_system", F.upper("source_system"))
    lower = lambda df: df.withColumn("source_system", F.lower("source_system"))
    key = F.col("ingestion_config_id")
    current = configs.unionByName(upper(configs.where(key % 5 == 0)))
    seed = lower(configs).unionByName(upper(configs.where(key % 3 == 0)))
    return config_ops.ambiguous_configs(current, seed)


SQL["config_ambiguity"] = with_tables(
    CONFIGS,
    body="""
SELECT rtrim(lower(source_system)) AS source_system, rtrim(lower(source_schema)) AS source_schema,
  rtrim(lower(source_object)) AS source_object, sum(CASE WHEN ingestion_config_id % 5 = 0 THEN 2 ELSE 1 END)::BIGINT
    AS in_current, sum(CASE WHEN ingestion_config_id % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS in_seed
FROM configs GROUP BY ALL HAVING in_current > 1 OR in_seed > 1""",
)


def connection_upsert(spark, folder):
    """Sources get new settings; one connection per supplier is added."""
    current = frames.connections(spark, folder)
    source = current.where(F.startswith("connection_ref", F.lit("C"))).select(
        F.lower("connection_ref").alias("connection_ref"),
        F.lit("SFTP").alias("connection_type"),
        F.lit('{"connectionId":"new"}').alias("connection_settings"),
    )
    added = frames.table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("connection_ref"),
        F.lit("SQL_SERVER").alias("connection_type"),
        F.concat(F.lit('{"connectionId":"'), F.col("s_name"), F.lit('"}')).alias(
            "connection_settings"
        ),
    )
    return config_ops.upsert_connections(current, source.unionByName(added))


SQL["connection_upsert"] = with_tables(
    CONNECTIONS,
    body="""
SELECT connection_ref, CASE WHEN connection_ref LIKE 'C%' THEN 'SFTP' ELSE connection_type END
    AS connection_type,
  CASE WHEN connection_ref LIKE 'C%' THEN '{"connectionId":"new"}' ELSE connection_settings END
    AS connection_settings FROM connections
UNION ALL SELECT 'S' || s_suppkey, 'SQL_SERVER', '{"connectionId":"' || s_name || '"}'
FROM supplier""",
)

# --- requests --------------------------------------------------------------------


def validate_requests(spark, folder):
    return requests.validate_requests(frames.envelopes(spark, folder)).select(
        "event_id", "error_code", "duplicate_ids"
    )


SQL["validate_requests"] = """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN NULL WHEN 5 THEN 51011 WHEN 6 THEN 51010
    WHEN 7 THEN 51013 ELSE 51012 END AS error_code,
  CASE WHEN event_id % 8 = 7 THEN (user_id + 1) || ', ' || (user_id + 1001) END AS duplicate_ids
FROM events"""


def _valid_envelopes(spark, folder):
    checked = requests.validate_requests(frames.envelopes(spark, folder))
    return checked.where(F.col("error_code").isNull())


def normalize_requests(spark, folder):
    items = requests.request_items(_valid_envelopes(spark, folder), "event_id")
    return items.withColumn("item_no", F.col("item_no").cast("bigint"))


SQL["normalize_requests"] = """
SELECT event_id, CAST(item_no AS BIGINT) AS item_no,
  CAST(user_id + 1 + item_no * 1000 AS INTEGER) AS config_id,
  CASE item_no WHEN 0 THEN 'REGULAR' ELSE 'BACKFILL' END AS run_type,
  CASE item_no WHEN 0 THEN '' ELSE '2024-01-01T00:00:00Z' END AS lower_bound, '' AS upper_bound
FROM events, (VALUES (0), (1)) items(item_no) WHERE event_id % 8 = 0"""


def duplicate_requests(spark, folder):
    checked = requests.validate_requests(frames.envelopes(spark, folder))
    readable = checked.where(F.col("error_code").isNull() | F.col("duplicate_ids").isNotNull())
    return requests.duplicate_requests(
        requests.request_items(readable, "event_id"), "event_id"
    )


SQL["duplicate_requests"] = """
SELECT event_id, CAST(user_id + 1 + step AS INTEGER) AS config_id,
  CAST(2 AS BIGINT) AS request_count
FROM events, (VALUES (0), (1000)) items(step) WHERE event_id % 8 = 7"""


def execution_decision(spark, folder):
    return requests.execution_decision(
        frames.run_requests(spark, folder),
        frames.configs(spark, folder),
        frames.connections(spark, folder),
    )


SQL["execution_decision"] = with_tables(
    REQUESTS,
    CONFIGS,
    CONNECTIONS,
    body="""
SELECT * , CASE WHEN decision = 'INACTIVE' THEN 'SKIPPED'
    WHEN decision NOT IN ('DATABASE', 'FILE') THEN 'FAILED' END AS terminal_status
FROM (SELECT request_id, config_id, run_type, lower_bound, upper_bound, ingestion_pattern,
    load_strategy,
    CASE WHEN c.ingestion_config_id IS NULL THEN 'CONFIG_NOT_FOUND'
      WHEN NOT is_active THEN 'INACTIVE'
      WHEN run_type = 'BACKFILL' AND load_strategy = 'INCREMENTAL'
        AND (lower_bound = '' OR upper_bound = '') THEN 'INVALID_REQUEST'
      WHEN NOT (run_type = 'BACKFILL' AND load_strategy = 'INCREMENTAL')
        AND (lower_bound <> '' OR upper_bound <> '') THEN 'INVALID_REQUEST'
      WHEN t.connection_type IS DISTINCT FROM 'LAKEHOUSE' THEN 'INVALID_TARGET'
      WHEN ingestion_pattern IN ('DATABASE', 'FILE') THEN ingestion_pattern
      ELSE 'UNSUPPORTED' END AS decision
  FROM requests r LEFT JOIN configs c ON c.ingestion_config_id = r.config_id
    LEFT JOIN connections t ON t.connection_ref = c.target_conn_ref)""",
)

RUN_START = "2001-06-01T08:00:00.000Z"


def plan_windows(spark, folder):
    return windows.plan_windows(
        frames.run_requests(spark, folder),
        frames.configs(spark, folder),
        frames.state(spark, folder),
        frames.source_max(spark, folder),
        RUN_START,
    )


SQL["plan_windows"] = with_tables(
    REQUESTS,
    CONFIGS,
    SOURCE_MAX,
    STATE,
    body=f"""
, known AS (
  SELECT r.*, ingestion_pattern, load_strategy, c.watermark_field,
    s.last_watermark_value AS stored,
    CASE WHEN upper(run_type) = 'REGULAR' THEN s.last_watermark_value ELSE lower_bound END AS low,
    CASE WHEN upper(run_type) <> 'REGULAR' THEN upper_bound
      WHEN ingestion_pattern = 'FILE' THEN '{RUN_START}' ELSE source_upper_bound END AS high,
    upper(run_type) = 'REGULAR' AS regular, load_strategy = 'INCREMENTAL' AS moving
  FROM requests r JOIN configs c ON c.ingestion_config_id = r.config_id
    LEFT JOIN state s ON s.ingestion_config_id = c.ingestion_config_id
      AND s.watermark_field = c.watermark_field
    LEFT JOIN source_max m ON m.config_id = r.config_id),
typed AS (
  SELECT *, try_cast(rtrim(low, 'Z') AS TIMESTAMP) AS low_at,
    try_cast(rtrim(high, 'Z') AS TIMESTAMP) AS high_at FROM known),
classified AS (
  SELECT *, CASE WHEN NOT moving THEN NULL
    WHEN ingestion_pattern = 'FILE' AND watermark_field <> 'last_modified_time'
      THEN 'UNSUPPORTED_FILE_WATERMARK'
    WHEN stored IS NULL THEN 'STATE_NOT_FOUND'
    WHEN regular AND ingestion_pattern <> 'FILE' AND high IS NULL THEN NULL
    WHEN regular AND ingestion_pattern <> 'FILE' AND coalesce(high_at = low_at, false) THEN NULL
    WHEN NOT coalesce(high_at > low_at, false) THEN 'INVALID_PROCESSING_BOUNDARY' END
    AS window_error FROM typed),
planned AS (
  SELECT *, CASE WHEN window_error IS NOT NULL THEN 'FAILED' WHEN NOT moving THEN 'PROCESS'
    WHEN regular AND ingestion_pattern <> 'FILE' AND (high IS NULL OR high_at = low_at)
      THEN 'SKIPPED' ELSE 'PROCESS' END AS window_class,
    moving AND (window_error IS NULL OR window_error = 'INVALID_PROCESSING_BOUNDARY') AS resolved
  FROM classified)
SELECT request_id, config_id, run_type, lower_bound, upper_bound, ingestion_pattern,
  load_strategy, watermark_field, CASE WHEN resolved THEN low END AS processing_lower_bound,
  CASE WHEN resolved THEN high END AS processing_upper_bound, window_class, window_error,
  window_class = 'PROCESS' AND regular AND moving AS may_advance
FROM planned""",
)

# --- finalisation and recovery -----------------------------------------------------


def _finalized(spark, folder):
    calls, recorded, current = frames.finalize_inputs(spark, folder)
    return finalize.finalize(calls, recorded, current, frames.configs(spark, folder))


def finalize_batch(spark, folder):
    return _finalized(spark, folder).outcomes()


SQL["finalize_batch"] = with_tables(
    FINALIZE,
    body="""
SELECT call_order, pipeline_run_id, ingestion_config_id, outcome, error_number FROM outcomes""",
)


def finalize_state(spark, folder):
    return _finalized(spark, folder).new_state("2024-03-01T00:00:00").select(
        "ingestion_config_id", "last_watermark_value", "last_successful_batch_id",
        "last_successful_pipeline_run_id", "watermark_updated_at",
    )


SQL["finalize_state"] = with_tables(
    FINALIZE,
    body="""
SELECT config_id AS ingestion_config_id, coalesce(high, value) AS last_watermark_value,
  batch_id AS last_successful_batch_id, pipeline_run_id AS last_successful_pipeline_run_id,
  CASE WHEN high IS NOT NULL THEN TIMESTAMP '2024-03-01 00:00:00' END AS watermark_updated_at
FROM current_state LEFT JOIN (SELECT * FROM outcomes WHERE outcome = 'RECORDED' AND advance)
  ON ingestion_config_id = config_id""",
)


def finalize_audit(spark, folder):
    return _finalized(spark, folder).audit_rows().select(
        "pipeline_run_id", "batch_id", "ingestion_config_id", "ingestion_pattern", "status",
        "error_code", "processing_lower_bound", "processing_upper_bound", "duration_seconds",
    )


SQL["finalize_audit"] = with_tables(
    CONFIGS,
    FINALIZE,
    body="""
SELECT o.pipeline_run_id, o.batch_id, o.ingestion_config_id, ingestion_pattern,
  CASE WHEN outcome = 'CONFLICT' THEN 'FAILED' ELSE a.status END AS status,
  CASE WHEN outcome = 'CONFLICT' THEN 'WATERMARK_CONFLICT'
    WHEN kind = 'error' THEN 'SOURCE_QUERY_FAILED' END AS error_code,
  o.low AS processing_lower_bound, o.high AS processing_upper_bound,
  CAST(3 AS BIGINT) AS duration_seconds
FROM outcomes o JOIN argued a ON a.call_order = o.call_order AND a.replay = o.replay
  LEFT JOIN configs c ON c.ingestion_config_id = o.ingestion_config_id
WHERE outcome IN ('RECORDED', 'CONFLICT')""",
)


def recovery_actions(spark, folder):
    facts = frames.audit(spark, folder)
    user = F.col("user_id")
    shifted = F.when(F.col("event_id") % 9 == 0, 100).otherwise(0)
    uncertain = frames.table(spark, folder, "events").select(
        (user % 8 + 1 + shifted).cast("int").alias("ingestion_config_id"),
        F.concat(F.lit("B"), F.date_format("ts", "yyyyMMddHH")).alias("batch_id"),
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("pipeline_run_id"),
        frames.pick(user, ["DATABASE", "FILE", "API"]).alias("ingestion_pattern"),
    )
    return recovery.recovery_actions(uncertain, facts)


SQL["recovery_actions"] = with_tables(
    AUDIT,
    body="""
SELECT * EXCLUDE (status, error_code, known), CASE
    WHEN known AND status = 'SUCCESS' THEN 'COMMITTED_SUCCESS'
    WHEN known AND error_code = 'WATERMARK_CONFLICT' THEN 'CONFIRMED_CONFLICT'
    ELSE 'OTHER' END AS outcome_class,
  CASE WHEN known AND status = 'SUCCESS' THEN 'COMMITTED_SUCCESS'
    WHEN known AND error_code = 'WATERMARK_CONFLICT' THEN 'CONFIRMED_CONFLICT_' || ingestion_pattern
    ELSE 'OTHER' END AS recovery_case,
  CASE WHEN known AND error_code = 'WATERMARK_CONFLICT' AND ingestion_pattern = 'DATABASE'
      THEN 'CLEAN_TABLE'
    WHEN known AND error_code = 'WATERMARK_CONFLICT' AND ingestion_pattern = 'FILE'
      THEN 'CLEAN_TABLE_AND_LANDING' ELSE 'KEEP' END AS action,
  CASE WHEN known AND status = 'SUCCESS' THEN 'FINALIZE_RESPONSE_FAILED_COMMITTED'
    WHEN known AND error_code = 'WATERMARK_CONFLICT' AND ingestion_pattern <> 'API'
      THEN 'WATERMARK_CONFLICT' ELSE 'FINALIZE_OUTCOME_UNCONFIRMED' END AS final_error
FROM (SELECT CAST(e.user_id % 8 + 1 + CASE WHEN e.event_id % 9 = 0 THEN 100 ELSE 0 END AS INTEGER)
      AS ingestion_config_id, a.batch_id, a.pipeline_run_id,
    CASE e.user_id % 3 WHEN 0 THEN 'DATABASE' WHEN 1 THEN 'FILE' ELSE 'API' END
      AS ingestion_pattern, status, error_code, e.event_id % 9 <> 0 AS known
  FROM events e JOIN audit a ON a.ingestion_log_id = e.event_id)""",
)

# --- contracts -----------------------------------------------------------------------


def _faulty_audit(spark, folder):
    key = F.col("ingestion_log_id")
    return (
        frames.audit(spark, folder)
        .withColumns(
            {
                "source_row_count": F.col("source_row_count") - 10,
                "run_type": F.when(key % 50 == 0, "MANUAL").otherwise(F.col("run_type")),
                "status": F.when(key % 47 == 0, "DONE").otherwise(F.lower("status")),
                "load_strategy": F.when(key % 43 == 0, "DELTA")
                .when(key % 3 == 0, None)
                .otherwise(F.col("load_strategy")),
                "pipeline_name": F.when(key % 41 == 0, "\t \n").otherwise(F.col("pipeline_name")),
                "end_time": F.col("end_time") - F.make_dt_interval(secs=F.lit(5)),
                "duration_seconds": F.col("duration_seconds") - 5,
            }
        )
    )


def contract_violations(spark, folder):
    check = contracts.contract_violations
    parts = [
        check(frames.configs(spark, folder), contracts.config_rules(), "ingestion_config",
              F.col("ingestion_config_id")),
        check(frames.connections(spark, folder), contracts.connection_rules(),
              "connection_settings", F.col("connection_ref")),
        check(frames.state(spark, folder), contracts.state_rules(), "pipeline_watermarks",
              F.col("ingestion_config_id")),
        check(_faulty_audit(spark, folder), contracts.audit_rules(), "ingestion_log",
              F.col("ingestion_log_id")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _violation(table: str, key: str, source: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{rule}' AS rule"
        f" FROM {source} WHERE {condition}"
        for rule, condition in rules.items()
    )


SQL["contract_violations"] = with_tables(
    CONFIGS,
    CONNECTIONS,
    SOURCE_MAX,
    STATE,
    AUDIT,
    body="\nUNION ALL ".join(
        [
            _violation(
                "ingestion_config", "ingestion_config_id", "configs",
                {
                    "copy_options_json": "nation IN (7, 8)",
                    "source_options_json": "nation = 12 AND ingestion_pattern = 'FILE'",
                    "file_format": "ingestion_pattern = 'FILE' AND file_format IS NULL",
                    "landing_path": "ingestion_pattern = 'FILE' AND nation = 16",
                    "required_text": "nation = 17",
                    "source_path": "ingestion_pattern = 'FILE' AND nation = 14",
                    "source_schema": "ingestion_pattern = 'DATABASE' AND nation = 13",
                    "watermark": "load_strategy = 'INCREMENTAL' AND nation = 18",
                },
            ),
            _violation(
                "connection_settings", "connection_ref", "connections",
                {
                    "settings_json": "connection_settings = '[]'",
                    "connection_type": "connection_type = 'FTP'",
                },
            ),
            _violation(
                "pipeline_watermarks", "ingestion_config_id", "state",
                {"required_text": "last_watermark_value = ' ' || chr(9)"},
            ),
            _violation(
                "ingestion_log", "ingestion_log_id", "audit",
                {
                    "counts": "source_row_count < 10",
                    "duration": "duration_seconds < 5",
                    "load_strategy": "ingestion_log_id % 43 = 0",
                    "required_text": "ingestion_log_id % 41 = 0",
                    "run_type": "ingestion_log_id % 50 = 0",
                    "status": "ingestion_log_id % 47 = 0",
                    "time": "end_time - INTERVAL 5 SECOND < start_time",
                },
            ),
        ]
    ),
)


def unique_violations(spark, folder):
    # two neighbouring customers share an object name
    configs = frames.configs(spark, folder).withColumn(
        "source_object",
        F.concat(F.lit("obj_"), F.floor((F.col("ingestion_config_id") - 1) / 2).cast("string")),
    )
    lines = frames.table(spark, folder, "lineitem")
    return contracts.unique_violations(
        configs, ["source_system", "source_schema", "source_object"], "ingestion_config", "source"
    ).unionByName(
        contracts.unique_violations(lines, ["l_orderkey", "l_linenumber"], "lineitem", "line")
    )


SQL["unique_violations"] = with_tables(
    CONFIGS,
    body="""
SELECT 'ingestion_config' AS table_name, 'source' AS rule,
  name || '|' || coalesce(part, '<null>') || '|' || object AS row_key, count(*) AS row_count
FROM (SELECT lower(rtrim(source_system)) AS name, rtrim(source_schema, ' ') AS part,
    'obj_' || ((ingestion_config_id - 1) // 2) AS object FROM configs)
GROUP BY name, part, object HAVING count(*) > 1
UNION ALL
SELECT 'lineitem', 'line', l_orderkey || '|' || l_linenumber, count(*)
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)


def fk_violations(spark, folder):
    configs, known = frames.configs(spark, folder), frames.connections(spark, folder)
    check, key = contracts.reference_violations, F.col("ingestion_config_id")
    active = configs.where(F.col("is_active"))
    return (
        check(configs, "source_conn_ref", known, "connection_ref", "source_connection", key)
        .unionByName(
            check(configs, "target_conn_ref", known, "connection_ref", "target_connection", key)
        )
        .unionByName(
            check(frames.state(spark, folder), "ingestion_config_id", active,
                  "ingestion_config_id", "watermark_config", key)
        )
    )


SQL["fk_violations"] = with_tables(
    CONFIGS,
    CONNECTIONS,
    SOURCE_MAX,
    STATE,
    body="""
SELECT CAST(ingestion_config_id AS VARCHAR) AS row_key, 'source_connection' AS rule,
  source_conn_ref AS reference FROM configs
WHERE source_conn_ref NOT IN (SELECT connection_ref FROM connections)
UNION ALL SELECT CAST(ingestion_config_id AS VARCHAR), 'target_connection', target_conn_ref
FROM configs WHERE target_conn_ref NOT IN (SELECT connection_ref FROM connections)
UNION ALL SELECT CAST(ingestion_config_id AS VARCHAR), 'watermark_config',
  CAST(ingestion_config_id AS VARCHAR) FROM state
WHERE ingestion_config_id NOT IN (SELECT ingestion_config_id FROM configs WHERE is_active)""",
)

for _query in (
    select_active_configs, resolve_configs, route_objects, copy_options_check,
    copy_options_set, config_pages,
    config_page_count, watermark_view, watermark_gaps, missing_state, config_upsert, config_ambiguity,
    connection_upsert,
    validate_requests, normalize_requests, duplicate_requests, execution_decision, plan_windows,
    finalize_batch, finalize_state, finalize_audit, recovery_actions, contract_violations,
    unique_violations, fk_violations,
):
    QUERIES[_query.__name__] = _query
