"""Monitoring views over the audit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import match_key, source_entity, source_name
from tidegate.operators.configs import watermark_view
from tidegate.operators.finalize import may_advance
from tidegate.operators.sizes import small_side
from tidegate.schemas import STATUS_PRECEDENCE

SUMMARY = (
    "source_system", "batch_id", "object_count", "success_count", "failed_count",
    "skipped_count", "source_rows", "target_rows", "batch_start_time", "batch_end_time",
    "source_status",
)


def _severity(status: Column) -> Column:
    """Rank of a status, larger hides smaller; unknown ones rank with the last."""
    rank = F.lit(1)
    for place, code in enumerate(reversed(STATUS_PRECEDENCE), start=1):
        rank = F.when(status == code, F.lit(place)).otherwise(rank)
    return rank


def _named(audit: DataFrame) -> DataFrame:
    """Audit rows with the key under which spellings of one source count as equal."""
    return audit.withColumn("_name", match_key(source_name(F.col("source_system"))))


def _looked_up(df: DataFrame, live: bool) -> DataFrame:
    return df if live else small_side(df)


def _spellings(named: DataFrame) -> DataFrame:
    """One row per source and way of writing its name, with its latest end time."""
    text = source_name(F.col("source_system")).alias("_text")
    return named.groupBy("_name", text).agg(F.max("end_time").alias("end_time"))


def _display_names(spellings: DataFrame) -> DataFrame:
    """One spelling per source: the first in text order."""
    return spellings.groupBy("_name").agg(F.min("_text").alias("source_system"))


def source_batch(audit: DataFrame, live: bool = False) -> DataFrame:
    """One row per source system and batch.

    All running values have fixed width, so tasks combine their rows by hashing
    before the one shuffle.  Display names are looked up afterwards, among the
    few sources there are, rather than carried through the aggregate.

    The lookup runs when the frame is built, so that its size is known to the
    join.  With ``live`` it stays part of the plan, for views queried later.
    """
    named = _named(audit)
    return _summarise(named, _looked_up(_display_names(_spellings(named)), live))


def _status_of(severity: str) -> Column:
    names = F.array(*[F.lit(code) for code in reversed(STATUS_PRECEDENCE)])
    return F.element_at(names, F.col(severity))


def _sums() -> list[Column]:
    """The figures of a batch, in the order of the summary, and its strongest status."""
    status = F.upper("status")
    is_status = lambda code: F.sum(F.when(status == code, 1).otherwise(0))
    return [
        F.count(F.lit(1)).alias("object_count"),
        is_status("SUCCESS").alias("success_count"),
        is_status("FAILED").alias("failed_count"),
        is_status("SKIPPED").alias("skipped_count"),
        F.sum(F.coalesce("source_row_count", F.lit(0))).alias("source_rows"),
        F.sum(F.coalesce("target_row_count", F.lit(0))).alias("target_rows"),
        F.min("start_time").alias("batch_start_time"),
        F.max("end_time").alias("batch_end_time"),
        F.max(_severity(status)).alias("_severity"),
    ]


def batch_figures() -> list[Column]:
    """The figures of a group of audit rows; all can be merged, so streams may keep them."""
    return _sums()


def from_figures(batches: DataFrame) -> DataFrame:
    """The summary from figures per ``_name`` and ``batch_id`` that carry a spelling ``_text``."""
    names = batches.groupBy("_name").agg(F.min("_text").alias("source_system"))
    return (
        batches.join(names, "_name").withColumn("source_status", _status_of("_severity")).select(*SUMMARY)
    )


def _summarise(named: DataFrame, display_names: DataFrame) -> DataFrame:
    batches = named.groupBy("_name", "batch_id").agg(*_sums())
    return (
        batches.join(display_names, "_name")
        .withColumn("source_status", _status_of("_severity"))
        .select(*SUMMARY)
    )


def latest_source(audit: DataFrame) -> DataFrame:
    """The most recent batch of each source; equal end times go to the later id.

    The audit is read once. Rows are summed by batch and spelling of the source, with running
    values of fixed width; those few sums are merged by batch, and each task passes on only
    the latest batch of a source it holds, so a source with most batches stays parallel.
    """
    named = _named(audit).withColumn("_text", source_name(F.col("source_system")))
    spelled = named.groupBy("_name", "_text", "batch_id").agg(*_sums())
    merged = [F.sum(name).alias(name) for name in SUMMARY[2:8]]
    batches = spelled.groupBy("_name", "batch_id").agg(
        *merged,
        F.min("batch_start_time").alias("batch_start_time"),
        F.max("batch_end_time").alias("batch_end_time"),
        F.max("_severity").alias("_severity"),
        F.min("_text").alias("_text"),
    )
    figures = F.struct("batch_id", *SUMMARY[2:10], "_severity")
    newest = batches.groupBy("_name").agg(
        F.max_by(figures, F.struct("batch_end_time", "batch_id")).alias("_last"),
        F.min("_text").alias("source_system"),
    )
    return newest.select("source_system", "_last.*").select(
        *SUMMARY[:-1], _status_of("_severity").alias("source_status")
    )


def object_history(audit: DataFrame) -> DataFrame:
    """One row per finished object execution, with display names."""
    return audit.select(
        "ingestion_log_id",
        source_name(F.col("source_system")).alias("source_system"),
        source_entity(F.col("source_schema"), F.col("source_object")).alias("source_entity"),
        "ingestion_config_id",
        "batch_id",
        "pipeline_run_id",
        "run_type",
        "load_strategy",
        "status",
        "source_row_count",
        "target_row_count",
        "duration_seconds",
        "start_time",
        "end_time",
        "error_code",
        "error_message",
    )


def history_totals(history: DataFrame, dimensions: list[str]) -> DataFrame:
    """Row and duration sums per combination of the chosen columns."""
    return history.groupBy(*dimensions).agg(
        F.sum("source_row_count").alias("source_rows"),
        F.sum("target_row_count").alias("target_rows"),
        F.sum("duration_seconds").alias("duration_seconds"),
    )


def history_of(history: DataFrame, sources: DataFrame) -> DataFrame:
    """All history of the selected sources, not only their latest batch."""
    chosen = sources.where(F.col("source_system").isNotNull()).select(
        match_key(F.col("source_system")).alias("_name")
    )
    return (
        history.withColumn("_name", match_key(F.col("source_system")))
        .join(chosen, "_name", "left_semi")
        .drop("_name")
    )


def kpis(latest: DataFrame) -> DataFrame:
    """Headline figures over the latest batch of each source."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    failed = F.when(F.col("source_status") == "FAILED", 1).otherwise(0)
    return latest.where(F.col("source_system").isNotNull()).agg(
        F.count(F.lit(1)).alias("source_systems"),
        F.coalesce(F.sum(failed), F.lit(0)).alias("failed_sources"),
        total("object_count").alias("objects"),
        F.max("batch_end_time").alias("latest_activity"),
        total("success_count").alias("successful_objects"),
        total("failed_count").alias("failed_objects"),
        total("skipped_count").alias("skipped_objects"),
    )


def register_views(audit: DataFrame, configs: DataFrame, state: DataFrame) -> None:
    """Temporary views for reports; nothing is cached, each query reads the tables."""
    views = {
        "v_monitor_source_batch": source_batch(audit, live=True),
        "v_monitor_latest_source": latest_source(audit),
        "v_monitor_object_history": object_history(audit),
        "v_pipeline_watermarks": watermark_view(configs, state),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def recent_audits(audit: DataFrame, count: int) -> DataFrame:
    """The audit rows that ended last: a top-k, kept per task before the final merge."""
    return audit.orderBy(F.desc("end_time"), F.desc("ingestion_log_id")).limit(count)


def previous_in_order(
    df: DataFrame, key: str, order: str, value: str, name: str, span: int = 1_000_000
) -> DataFrame:
    """Add the value of the preceding row of the same key.

    A window per key would put a frequent key into one task.  The order column
    is cut into spans: inside a span the window is bounded by the span's length,
    and what each span hands to the next is one row per key and span.
    """
    inside = Window.partitionBy(key, "_span").orderBy(order)
    boxed = F.struct(F.col(value).alias("v"))
    cut = df.withColumn("_span", F.floor(F.col(order) / F.lit(span))).withColumns(
        {"_before": F.lag(boxed).over(inside), "_after": F.lead(order).over(inside)}
    )
    # the same shuffle and sort serve both uses of ``cut``
    handed = cut.where(F.col("_after").isNull()).select(
        key,
        "_span",
        F.lag(boxed).over(Window.partitionBy(key).orderBy("_span")).alias("_handed"),
    )
    return cut.join(handed, [key, "_span"]).select(
        *df.columns, F.coalesce("_before", "_handed")["v"].alias(name)
    )


def watermark_chain(audit: DataFrame, span: int = 1_000_000) -> DataFrame:
    """Advances with the upper bound that went before; a gap breaks the chain."""
    advances = audit.where(
        may_advance(F.col("status"), F.col("run_type"), F.col("load_strategy"))
        & F.col("ingestion_config_id").isNotNull()
        & F.col("processing_upper_bound").isNotNull()
    ).select(
        "ingestion_config_id",
        "ingestion_log_id",
        "processing_lower_bound",
        "processing_upper_bound",
    )
    linked = previous_in_order(
        advances, "ingestion_config_id", "ingestion_log_id", "processing_upper_bound",
        "previous_upper_bound", span,
    )
    return linked.withColumn(
        "is_linked",
        F.col("previous_upper_bound").isNull()
        | (F.col("previous_upper_bound") == F.col("processing_lower_bound")),
    )
