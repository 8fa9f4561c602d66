"""Row types of the control and audit tables, and their code sets."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# --- fixed values: legal codes ----------------------------------------------
PATTERNS = ("DATABASE", "FILE", "API")
STRATEGIES = ("FULL", "INCREMENTAL")
FILE_FORMATS = ("DELIMITED_TEXT", "PARQUET", "JSON")
CONNECTION_TYPES = ("LAKEHOUSE", "SFTP", "SQL_SERVER")
RUN_TYPES = ("REGULAR", "BACKFILL")
# strongest first: the order in which one status of a batch hides another
STATUS_PRECEDENCE = ("FAILED", "CANCELLED", "WARN", "SUCCESS", "SKIPPED")
FILE_WATERMARK_FIELD = "last_modified_time"
INITIAL_WATERMARK = "1900-01-01T00:00:00Z"
UNKNOWN_SOURCE = "UNKNOWN"
# --- end of fixed values -----------------------------------------------------


def _fields(*specs: tuple) -> StructType:
    return StructType([StructField(name, kind(), nullable) for name, kind, nullable in specs])


CONNECTIONS = _fields(
    ("connection_ref", StringType, False),
    ("connection_type", StringType, False),
    ("connection_settings", StringType, False),
)

CONFIG = _fields(
    ("ingestion_config_id", IntegerType, False),
    ("source_system", StringType, False),
    ("source_conn_ref", StringType, False),
    ("source_schema", StringType, True),
    ("source_object", StringType, False),
    ("source_path", StringType, True),
    ("ingestion_pattern", StringType, False),
    ("file_format", StringType, True),
    ("source_options", StringType, True),
    ("copy_options", StringType, True),
    ("landing_path", StringType, True),
    ("target_conn_ref", StringType, False),
    ("target_schema", StringType, False),
    ("target_table", StringType, False),
    ("load_strategy", StringType, False),
    ("watermark_field", StringType, True),
    ("is_active", BooleanType, False),
)

STATE = _fields(
    ("ingestion_config_id", IntegerType, False),
    ("watermark_field", StringType, False),
    ("last_watermark_value", StringType, False),
    ("last_successful_batch_id", StringType, True),
    ("last_successful_pipeline_run_id", StringType, True),
    ("watermark_updated_at", TimestampNTZType, True),
)

# One terminal row per object execution; ``pipeline_run_id`` is the key.
AUDIT = _fields(
    ("ingestion_config_id", IntegerType, True),
    ("batch_id", StringType, False),
    ("pipeline_run_id", StringType, False),
    ("pipeline_name", StringType, False),
    ("run_type", StringType, False),
    ("source_system", StringType, True),
    ("source_conn_ref", StringType, True),
    ("source_schema", StringType, True),
    ("source_object", StringType, True),
    ("source_path", StringType, True),
    ("ingestion_pattern", StringType, True),
    ("landing_path", StringType, True),
    ("target_conn_ref", StringType, True),
    ("target_schema", StringType, True),
    ("target_table", StringType, True),
    ("load_strategy", StringType, True),
    ("watermark_field", StringType, True),
    ("processing_lower_bound", StringType, True),
    ("processing_upper_bound", StringType, True),
    ("source_row_count", LongType, True),
    ("target_row_count", LongType, True),
    ("status", StringType, False),
    ("error_code", StringType, True),
    ("error_message", StringType, True),
    ("start_time", TimestampNTZType, False),
    ("end_time", TimestampNTZType, False),
    ("duration_seconds", LongType, False),
)

# As stored: with the id of the row, rising in the order of publication, and the time of that.
AUDIT_LOG = StructType(
    [
        StructField("ingestion_log_id", LongType(), False),
        *AUDIT.fields,
        StructField("log_timestamp", TimestampNTZType(), False),
    ]
)

# A finalize call carries the audit facts except those looked up or computed.
FINALIZE_REQUEST = StructType(
    [
        field
        for field in AUDIT.fields
        if field.name not in ("source_path", "ingestion_pattern", "duration_seconds")
    ]
    + [
        StructField("advance_watermark", BooleanType(), False),
        StructField("call_order", LongType(), False),
    ]
)

RUN_REQUEST = _fields(
    ("config_id", IntegerType, False),
    ("run_type", StringType, False),
    ("lower_bound", StringType, True),
    ("upper_bound", StringType, True),
)
