"""Finalisation: one terminal audit row per run, guarded checkpoint advance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import (
    ADVANCE_NEEDS_CHANGE,
    ADVANCE_NEEDS_FIELDS,
    ADVANCE_NEEDS_SUCCESS,
    INVALID_TIME_RANGE,
    OUTCOME_MISMATCH,
    WATERMARK_CONFLICT,
    WATERMARK_CONFLICT_NUMBER,
)
from tidegate.functions.temporal import seconds_crossed
from tidegate.functions.text import audit_message
from tidegate.operators.sizes import only_asked_for
from tidegate.schemas import AUDIT, STATE

# A repeated call is the same call when these agree (missing values agree too).
OUTCOME_FIELDS = (
    "batch_id",
    "status",
    "run_type",
    "ingestion_config_id",
    "error_code",
    "processing_lower_bound",
    "processing_upper_bound",
)

RECORDED, NO_OP, CONFLICT, REJECTED = "RECORDED", "NO_OP", "CONFLICT", "REJECTED"


def may_advance(status: Column, run_type: Column, strategy: Column) -> Column:
    """Only a successful regular incremental run moves the checkpoint."""
    return (status == "SUCCESS") & (run_type == "REGULAR") & (strategy == "INCREMENTAL")


def _agrees(prefix: str) -> Column:
    same = F.lit(True)
    for field in OUTCOME_FIELDS:
        same = same & F.col(field).eqNullSafe(F.col(f"{prefix}{field}"))
    return same


def _argument_error() -> Column:
    required = ("ingestion_config_id", "watermark_field", "processing_lower_bound",
                "processing_upper_bound")
    missing = F.lit(False)
    for field in required:
        missing = missing | F.col(field).isNull()
    unchanged = F.col("processing_lower_bound") == F.col("processing_upper_bound")
    return F.when(
        F.col("advance_watermark"),
        F.when(F.col("status") != "SUCCESS", ADVANCE_NEEDS_SUCCESS)
        .when(missing, ADVANCE_NEEDS_FIELDS)
        .when(unchanged, ADVANCE_NEEDS_CHANGE),
    )


@dataclass
class Finalized:
    """``judged``: every request with its outcome; the other frames follow from it."""

    judged: DataFrame
    state: DataFrame
    configs: DataFrame

    def settled(self) -> Finalized:
        """The same with the outcomes checkpointed, for use of several frames."""
        return Finalized(self.judged.checkpoint(), self.state, self.configs)

    def outcomes(self) -> DataFrame:
        return self.judged.select(
            "call_order", "pipeline_run_id", "ingestion_config_id", "outcome", "error_number"
        )

    def audit_rows(self) -> DataFrame:
        """Rows to append: recorded outcomes, and conflicts as FAILED."""
        conflict = F.col("outcome") == CONFLICT
        message = F.concat(
            F.lit("checkpoint of config "),
            F.col("ingestion_config_id").cast("string"),
            F.lit(" is no longer "),
            F.col("processing_lower_bound"),
        )
        looked_up = self.configs.select("ingestion_config_id", "source_path", "ingestion_pattern")
        rows = (
            self.judged.where(F.col("outcome").isin(RECORDED, CONFLICT))
            .withColumns(
                {
                    "error_message": audit_message(
                        F.when(conflict, message).otherwise(F.col("error_message"))
                    ),
                    "status": F.col("audited_status"),
                    "error_code": F.col("audited_error_code"),
                }
            )
            .join(looked_up, "ingestion_config_id", "left")
        )
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in AUDIT.fields])

    def new_state(self, instant: str) -> DataFrame:
        """The state after the winning advances; all other rows unchanged."""
        won = self.judged.where((F.col("outcome") == RECORDED) & F.col("advance_watermark")).select(
            "ingestion_config_id",
            F.col("processing_upper_bound").alias("_value"),
            F.col("batch_id").alias("_batch"),
            F.col("pipeline_run_id").alias("_run"),
        )
        moved = F.col("_value").isNotNull()
        pick = lambda new, old: F.when(moved, new).otherwise(F.col(old)).alias(old)
        return self.state.join(won, "ingestion_config_id", "left").select(
            "ingestion_config_id",
            "watermark_field",
            pick(F.col("_value"), "last_watermark_value"),
            pick(F.col("_batch"), "last_successful_batch_id"),
            pick(F.col("_run"), "last_successful_pipeline_run_id"),
            pick(F.lit(instant).cast("timestamp_ntz"), "watermark_updated_at"),
        )


def finalize(
    requests: DataFrame, audit: DataFrame, state: DataFrame, configs: DataFrame
) -> Finalized:
    """Judge a set of finalize requests against one audit and state snapshot.

    The requests of one call count as concurrent: they all saw the same state.
    If several could advance one config, the lowest ``call_order`` wins (of equal
    ones the smallest run id) and the others conflict.  A run id used again in the call is
    compared with what its first valid use puts into the audit; of uses with one ``call_order``
    one is the first, so a run never gets two audit rows.  Bounds are compared as exact texts.
    Winners and first uses are found by aggregation, never by a window over all
    requests of a key, so a key holding most of the requests stays parallel.

    The audit is read once and, for a call of usual size, not shuffled.  The
    requests with the audit rows they meet are checkpointed, so rows appended
    later cannot change the judgement.
    """
    recorded = only_asked_for(audit, requests, "pipeline_run_id").select(
        "pipeline_run_id",
        F.lit(True).alias("_known"),
        *[F.col(field).alias(f"_old_{field}") for field in OUTCOME_FIELDS],
    )
    seen = requests.withColumns(
        {
            "duration_seconds": seconds_crossed(F.col("start_time"), F.col("end_time")),
            "_argument_error": _argument_error(),
        }
    ).join(recorded, "pipeline_run_id", "left").checkpoint()
    # a place for every request; among equal orders the outcome decides, then the stored row
    told = F.xxhash64(*[F.coalesce(F.col(field).cast("string"), F.lit("")) for field in OUTCOME_FIELDS])
    seen = seen.withColumn("_row", F.monotonically_increasing_id())
    seen = seen.withColumn("_use", F.struct("call_order", told.alias("told"), F.col("_row").alias("row")))

    fresh = seen.where(
        F.col("_known").isNull()
        & (F.col("duration_seconds") >= 0)
        & F.col("_argument_error").isNull()
    )
    first_use = fresh.groupBy("pipeline_run_id").agg(F.min("_use").alias("_first_use"))
    leaders = fresh.join(first_use, "pipeline_run_id").where(F.col("_use") == F.col("_first_use"))
    advancing = leaders.where(F.col("advance_watermark"))
    current = state.select(
        "ingestion_config_id",
        "watermark_field",
        F.col("last_watermark_value").alias("processing_lower_bound"),
    )
    winners = (
        advancing.join(
            current, ["ingestion_config_id", "watermark_field", "processing_lower_bound"]
        )
        .groupBy("ingestion_config_id")
        .agg(F.min(F.struct("call_order", "pipeline_run_id")).alias("_winner"))
    )
    own = F.struct("call_order", "pipeline_run_id")
    beaten = F.col("advance_watermark") & ~own.eqNullSafe(F.col("_winner"))
    audited = leaders.join(winners, "ingestion_config_id", "left").withColumns(
        {
            "_lost": beaten,
            "_new_status": F.when(beaten, "FAILED").otherwise(F.col("status")),
            "_new_error_code": F.when(beaten, WATERMARK_CONFLICT).otherwise(F.col("error_code")),
        }
    )
    first_outcome = audited.select(
        "pipeline_run_id",
        "_first_use",
        "_lost",
        "_new_status",
        "_new_error_code",
        *[
            F.col(field).alias(f"_new_{field}")
            for field in OUTCOME_FIELDS
            if field not in ("status", "error_code")
        ],
    )
    joined = seen.join(first_outcome, "pipeline_run_id", "left")
    repeats = F.col("_use") > F.col("_first_use")
    leads = F.col("_use") == F.col("_first_use")
    error = (
        F.when(F.col("duration_seconds") < 0, INVALID_TIME_RANGE)
        .when(F.col("_known"), F.when(~_agrees("_old_"), OUTCOME_MISMATCH))
        .when(repeats, F.when(~_agrees("_new_"), OUTCOME_MISMATCH))
        .when(F.col("_argument_error").isNotNull(), F.col("_argument_error"))
        .when(F.col("_lost"), WATERMARK_CONFLICT_NUMBER)
    )
    outcome = (
        F.when(error == WATERMARK_CONFLICT_NUMBER, CONFLICT)
        .when(error.isNotNull(), REJECTED)
        .when(leads & F.col("_known").isNull(), RECORDED)
        .otherwise(NO_OP)
    )
    judged = joined.withColumns({"outcome": outcome, "error_number": error}).select(
        *requests.columns,
        "duration_seconds",
        "outcome",
        "error_number",
        F.col("_new_status").alias("audited_status"),
        F.col("_new_error_code").alias("audited_error_code"),
    )
    return Finalized(judged, state.select(*[f.name for f in STATE.fields]), configs)
