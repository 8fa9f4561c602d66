"""Registered queries over the audit table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.temporal import seconds_crossed
from tidegate.operators import monitor
from tidegate.plans import frames
from tidegate.plans.frames_sql import AUDIT, with_tables

QUERIES, SQL = {}, {}

_BATCHES = """
named AS (
  SELECT *, min(clean) OVER (PARTITION BY lower(clean)) AS name FROM (
    SELECT *, coalesce(nullif(trim(source_system), ''), 'UNKNOWN') AS clean FROM audit)),
batches AS (
  SELECT name AS source_system, batch_id, count(*) AS object_count,
    CAST(sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
    CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
    CAST(sum(CASE WHEN status = 'SKIPPED' THEN 1 ELSE 0 END) AS BIGINT) AS skipped_count,
    CAST(sum(coalesce(source_row_count, 0)) AS BIGINT) AS source_rows,
    CAST(sum(coalesce(target_row_count, 0)) AS BIGINT) AS target_rows,
    min(start_time) AS batch_start_time, max(end_time) AS batch_end_time,
    CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED'
      WHEN bool_or(status = 'CANCELLED') THEN 'CANCELLED'
      WHEN bool_or(status = 'WARN') THEN 'WARN'
      WHEN bool_or(status = 'SUCCESS') THEN 'SUCCESS' ELSE 'SKIPPED' END AS source_status
  FROM named GROUP BY name, batch_id),
latest AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(source_system)
      ORDER BY batch_end_time DESC, batch_id DESC) AS place FROM batches)
  WHERE place = 1)"""

_HISTORY = """
history AS (
  SELECT ingestion_log_id, coalesce(nullif(trim(source_system), ''), 'UNKNOWN') AS source_system,
    CASE WHEN source_schema <> '' THEN source_schema || '.' || source_object
      ELSE source_object END AS source_entity,
    ingestion_config_id, batch_id, pipeline_run_id, run_type, load_strategy, status,
    source_row_count, target_row_count, duration_seconds, start_time, end_time,
    error_code, error_message
  FROM audit)"""


def monitor_source_batch(spark, folder):
    return monitor.source_batch(frames.audit(spark, folder))


SQL["monitor_source_batch"] = with_tables(AUDIT, _BATCHES, body="SELECT * FROM batches")


def monitor_latest_source(spark, folder):
    return monitor.latest_source(frames.audit(spark, folder))


SQL["monitor_latest_source"] = with_tables(AUDIT, _BATCHES, body="SELECT * FROM latest")


def monitor_kpis(spark, folder):
    return monitor.kpis(monitor.latest_source(frames.audit(spark, folder)))


SQL["monitor_kpis"] = with_tables(
    AUDIT,
    _BATCHES,
    body="""
SELECT count(*) AS source_systems,
  CAST(sum(CASE WHEN source_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_sources,
  CAST(sum(object_count) AS BIGINT) AS objects, max(batch_end_time) AS latest_activity,
  CAST(sum(success_count) AS BIGINT) AS successful_objects,
  CAST(sum(failed_count) AS BIGINT) AS failed_objects,
  CAST(sum(skipped_count) AS BIGINT) AS skipped_objects FROM latest""",
)


def monitor_object_history(spark, folder):
    return monitor.object_history(frames.audit(spark, folder))


SQL["monitor_object_history"] = with_tables(AUDIT, _HISTORY, body="SELECT * FROM history")

_DIMENSIONS = ["source_system", "source_entity", "run_type", "load_strategy", "status"]


def monitor_history_totals(spark, folder):
    history = monitor.object_history(frames.audit(spark, folder))
    return monitor.history_totals(history, _DIMENSIONS)


SQL["monitor_history_totals"] = with_tables(
    AUDIT,
    _HISTORY,
    body=f"""
SELECT {', '.join(_DIMENSIONS)}, CAST(sum(source_row_count) AS BIGINT) AS source_rows,
  CAST(sum(target_row_count) AS BIGINT) AS target_rows,
  CAST(sum(duration_seconds) AS BIGINT) AS duration_seconds
FROM history GROUP BY ALL""",
)


def monitor_history_filtered(spark, folder):
    facts = frames.audit(spark, folder)
    unhealthy = monitor.latest_source(facts).where(F.col("failed_count") > 0)
    return monitor.history_of(monitor.object_history(facts), unhealthy)


SQL["monitor_history_filtered"] = with_tables(
    AUDIT,
    _BATCHES,
    _HISTORY,
    body="""
SELECT * FROM history WHERE lower(source_system) IN (
  SELECT lower(source_system) FROM latest WHERE failed_count > 0)""",
)


def audit_duration(spark, folder):
    return frames.audit(spark, folder).select(
        "ingestion_log_id",
        seconds_crossed(F.col("start_time"), F.col("end_time")).alias("seconds"),
    )


SQL["audit_duration"] = with_tables(
    AUDIT,
    body="SELECT ingestion_log_id, date_diff('second', start_time, end_time) AS seconds FROM audit",
)


def recent_audits(spark, folder):
    return monitor.recent_audits(frames.audit(spark, folder), 20).select(
        "ingestion_log_id", "batch_id", "pipeline_run_id", "source_system", "source_object",
        "run_type", "load_strategy", "status", "error_code", "end_time",
    )


SQL["recent_audits"] = with_tables(
    AUDIT,
    body="""
SELECT ingestion_log_id, batch_id, pipeline_run_id, source_system, source_object, run_type,
  load_strategy, status, error_code, end_time
FROM audit ORDER BY end_time DESC, ingestion_log_id DESC LIMIT 20""",
)


def watermark_chain(spark, folder):
    # short spans, so that the test tables cross many of them
    return monitor.watermark_chain(frames.audit(spark, folder), span=1000)


SQL["watermark_chain"] = with_tables(
    AUDIT,
    body="""
SELECT *, previous_upper_bound IS NULL OR previous_upper_bound = processing_lower_bound AS is_linked
FROM (SELECT ingestion_config_id, ingestion_log_id, processing_lower_bound, processing_upper_bound,
    lag(processing_upper_bound) OVER (
      PARTITION BY ingestion_config_id ORDER BY ingestion_log_id) AS previous_upper_bound
  FROM audit WHERE status = 'SUCCESS' AND run_type = 'REGULAR' AND load_strategy = 'INCREMENTAL')
""",
)

for _query in (
    monitor_source_batch, monitor_latest_source, monitor_kpis, monitor_object_history,
    monitor_history_totals, monitor_history_filtered, audit_duration, recent_audits,
    watermark_chain,
):
    QUERIES[_query.__name__] = _query
