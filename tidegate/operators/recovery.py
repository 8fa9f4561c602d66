"""What to do after a finalize call whose answer was lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.errors import (
    FINALIZE_OUTCOME_LOOKUP_FAILED,
    FINALIZE_OUTCOME_UNCONFIRMED,
    FINALIZE_RESPONSE_FAILED_COMMITTED,
    WATERMARK_CONFLICT,
)

from tidegate.operators.sizes import only_asked_for

# fixed values: outcome classes of an uncertain finalisation
COMMITTED_SUCCESS = "COMMITTED_SUCCESS"
CONFIRMED_CONFLICT = "CONFIRMED_CONFLICT"
OTHER = "OTHER"

KEEP, CLEAN_TABLE, CLEAN_TABLE_AND_LANDING = "KEEP", "CLEAN_TABLE", "CLEAN_TABLE_AND_LANDING"

EXECUTION = ["ingestion_config_id", "batch_id", "pipeline_run_id"]


def recovery_actions(
    uncertain: DataFrame, audit: DataFrame | None
) -> DataFrame:
    """Classify uncertain executions by their committed audit row.

    Data is removed only after a confirmed conflict; without an audit row, or
    without an audit to read (None), everything is kept for review.
    """
    if audit is None:
        return uncertain.withColumns(
            {
                "outcome_class": F.lit(OTHER),
                "recovery_case": F.lit(OTHER),
                "action": F.lit(KEEP),
                "final_error": F.lit(FINALIZE_OUTCOME_LOOKUP_FAILED),
            }
        )
    committed = only_asked_for(audit, uncertain, "pipeline_run_id").select(
        *EXECUTION, F.col("status").alias("_status"), F.col("error_code").alias("_error")
    )
    conflict = (F.col("_status") == "FAILED") & (F.col("_error") == WATERMARK_CONFLICT)
    known = F.when(F.col("_status") == "SUCCESS", COMMITTED_SUCCESS).when(
        conflict, CONFIRMED_CONFLICT
    )
    pattern = F.upper("ingestion_pattern")
    action = (
        F.when((known == CONFIRMED_CONFLICT) & (pattern == "DATABASE"), CLEAN_TABLE)
        .when((known == CONFIRMED_CONFLICT) & (pattern == "FILE"), CLEAN_TABLE_AND_LANDING)
        .otherwise(KEEP)
    )
    final_error = (
        F.when(known == COMMITTED_SUCCESS, FINALIZE_RESPONSE_FAILED_COMMITTED)
        .when(action != KEEP, WATERMARK_CONFLICT)
        .otherwise(FINALIZE_OUTCOME_UNCONFIRMED)
    )
    return (
        uncertain.join(committed, EXECUTION, "left")
        .withColumns(
            {
                "outcome_class": F.coalesce(known, F.lit(OTHER)),
                "recovery_case": F.when(
                    known == CONFIRMED_CONFLICT, F.concat_ws("_", F.lit(CONFIRMED_CONFLICT), pattern)
                ).otherwise(F.coalesce(known, F.lit(OTHER))),
                "action": action,
                "final_error": final_error,
            }
        )
        .drop("_status", "_error")
    )
