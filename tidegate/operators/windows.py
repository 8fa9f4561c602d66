"""Load windows: which range each request covers, and whether it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.errors import (
    INVALID_PROCESSING_BOUNDARY,
    STATE_NOT_FOUND,
    UNSUPPORTED_FILE_WATERMARK,
)
from tidegate.functions.once import computed_once
from tidegate.functions.temporal import sortable_bound
from tidegate.schemas import FILE_WATERMARK_FIELD


def plan_windows(
    requests: DataFrame,
    configs: DataFrame,
    state: DataFrame,
    source_max: DataFrame,
    run_start: str,
) -> DataFrame:
    """Classify every request in one plan: PROCESS, SKIPPED or FAILED.

    ``source_max`` holds (config_id, source_upper_bound) of table sources; file
    sources end at ``run_start``.  LOW comes from the state for a regular run
    and from the request for a backfill.  A table without any value has nothing
    new and is skipped.  The texts of both bounds are passed on unchanged; only
    their comparison uses a normalised form.
    """
    config = configs.select(
        F.col("ingestion_config_id").alias("config_id"),
        F.upper("ingestion_pattern").alias("_pattern"),
        F.upper("load_strategy").alias("_strategy"),
        "watermark_field",
    )
    # bounds kept per config are normalised once, before they meet the requests
    checkpoint = computed_once(
        state.select(
            F.col("ingestion_config_id").alias("config_id"),
            "watermark_field",
            F.col("last_watermark_value").alias("_state_value"),
        ),
        _state_sort=sortable_bound(F.col("_state_value")),
    )
    bounds = computed_once(source_max, _source_sort=sortable_bound(F.col("source_upper_bound")))
    known = config.join(checkpoint, ["config_id", "watermark_field"], "left").join(
        bounds, "config_id", "left"
    )
    incremental = F.col("_strategy") == "INCREMENTAL"
    is_file = F.col("_pattern") == "FILE"
    regular = F.upper("run_type") == "REGULAR"
    start = F.lit(run_start)

    def chosen(state_value, source_value, file_value, low_request, high_request):
        low = F.when(regular, state_value).otherwise(low_request)
        high = F.when(~regular, high_request).when(is_file, file_value).otherwise(source_value)
        return low, high

    low, high = chosen(
        F.col("_state_value"), F.col("source_upper_bound"), start,
        F.col("lower_bound"), F.col("upper_bound"),
    )
    low_sort, high_sort = chosen(
        F.col("_state_sort"), F.col("_source_sort"), sortable_bound(start),
        sortable_bound(F.col("lower_bound")), sortable_bound(F.col("upper_bound")),
    )
    ranged = computed_once(
        requests.join(known, "config_id"),
        _low=low,
        _high=high,
        _low_sort=low_sort,
        _high_sort=high_sort,
    )
    from_table = regular & ~is_file
    nothing_new = from_table & (
        F.col("_high").isNull()
        | F.coalesce(F.col("_high_sort") == F.col("_low_sort"), F.lit(False))
    )
    grows = F.coalesce(F.col("_high_sort") > F.col("_low_sort"), F.lit(False))
    error = F.when(
        incremental,
        F.when(
            is_file & (F.col("watermark_field") != FILE_WATERMARK_FIELD),
            UNSUPPORTED_FILE_WATERMARK,
        )
        .when(F.col("_state_value").isNull(), STATE_NOT_FOUND)
        .when(~nothing_new & ~grows, INVALID_PROCESSING_BOUNDARY),
    )
    failed = F.col("window_error").isNotNull()
    outcome = (
        F.when(failed, "FAILED")
        .when(incremental & nothing_new, "SKIPPED")
        .otherwise("PROCESS")
    )
    # a failed lookup leaves the bounds unset
    resolved = incremental & (
        ~failed | F.col("window_error").eqNullSafe(INVALID_PROCESSING_BOUNDARY)
    )
    return (
        computed_once(ranged, window_error=error)
        .withColumn("window_class", outcome)
        .select(
            *requests.columns,
            F.col("_pattern").alias("ingestion_pattern"),
            F.col("_strategy").alias("load_strategy"),
            "watermark_field",
            F.when(resolved, F.col("_low")).alias("processing_lower_bound"),
            F.when(resolved, F.col("_high")).alias("processing_upper_bound"),
            "window_class",
            "window_error",
            ((F.col("window_class") == "PROCESS") & regular & incremental).alias("may_advance"),
        )
    )
