"""Table contracts: row rules, unique keys and references as violation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.documents import is_json_object
from tidegate.functions.text import has_text, match_key
from tidegate.schemas import (
    CONNECTION_TYPES,
    FILE_FORMATS,
    PATTERNS,
    RUN_TYPES,
    STATUS_PRECEDENCE,
    STRATEGIES,
)

Rules = dict[str, Column]


def _code(name: str, codes: tuple[str, ...]) -> Column:
    return F.upper(F.rtrim(F.col(name))).isin(*codes)


def _is(name: str, code: str) -> Column:
    return F.upper(F.rtrim(F.col(name))) == code


def _filled(*names: str) -> Column:
    result = F.lit(True)
    for name in names:
        result = result & has_text(F.col(name))
    return result


def _optional_object(name: str) -> Column:
    return F.col(name).isNull() | is_json_object(F.col(name))


def connection_rules() -> Rules:
    return {
        "settings_json": is_json_object(F.col("connection_settings")),
        "ref_not_blank": _filled("connection_ref"),
        "connection_type": _code("connection_type", CONNECTION_TYPES),
    }


def config_rules() -> Rules:
    given = lambda name: F.col(name).isNotNull() & has_text(F.col(name))
    not_file = _is("ingestion_pattern", "API") | _is("ingestion_pattern", "DATABASE")
    not_table = _is("ingestion_pattern", "API") | _is("ingestion_pattern", "FILE")
    return {
        "copy_options_json": _optional_object("copy_options"),
        "source_options_json": _optional_object("source_options"),
        "file_format": F.when(
            _is("ingestion_pattern", "FILE"),
            F.coalesce(_code("file_format", FILE_FORMATS), F.lit(False)),
        ).otherwise(not_file & F.col("file_format").isNull()),
        "landing_path": ~_is("ingestion_pattern", "FILE")
        | F.coalesce(F.length(F.trim("landing_path")) > 0, F.lit(False)),
        "pattern": _code("ingestion_pattern", PATTERNS),
        "required_text": _filled(
            "source_system", "source_conn_ref", "source_object",
            "target_conn_ref", "target_schema", "target_table",
        ),
        "source_path": not_file | (_is("ingestion_pattern", "FILE") & given("source_path")),
        "source_schema": not_table | (_is("ingestion_pattern", "DATABASE") & given("source_schema")),
        "strategy": _code("load_strategy", STRATEGIES),
        "watermark": (_is("load_strategy", "FULL") & F.col("watermark_field").isNull())
        | (_is("load_strategy", "INCREMENTAL") & given("watermark_field")),
    }


def state_rules() -> Rules:
    return {"required_text": _filled("watermark_field", "last_watermark_value")}


def audit_rules() -> Rules:
    counts = F.lit(True)
    for name in ("source_row_count", "target_row_count"):
        counts = counts & (F.col(name).isNull() | (F.col(name) >= 0))
    return {
        "counts": counts,
        "duration": F.col("duration_seconds") >= 0,
        "load_strategy": F.col("load_strategy").isNull() | _code("load_strategy", STRATEGIES),
        "required_text": _filled("pipeline_run_id", "pipeline_name"),
        "run_type": _code("run_type", RUN_TYPES),
        "status": _code("status", STATUS_PRECEDENCE),
        "time": F.col("end_time") >= F.col("start_time"),
    }


def contract_violations(df: DataFrame, rules: Rules, table: str, key: Column) -> DataFrame:
    """One row per broken rule, found in a single pass without a shuffle.

    As with a SQL check constraint, a rule that comes out as unknown holds.
    """
    broken = F.array_compact(
        F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    )
    return df.select(
        F.lit(table).alias("table_name"),
        key.cast("string").alias("row_key"),
        F.explode(broken).alias("rule"),
    )


def unique_violations(df: DataFrame, keys: list[str], table: str, rule: str) -> DataFrame:
    """Key values that occur more than once.

    Texts are compared without case and trailing blanks; missing values count as
    equal to each other.
    """
    grouping = [
        (match_key(F.col(k)) if df.schema[k].dataType.typeName() == "string" else F.col(k)).alias(k)
        for k in keys
    ]
    return (
        df.groupBy(*grouping)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.concat_ws(
                "|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys]
            ).alias("row_key"),
            "row_count",
        )
    )


def reference_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, rule: str, key: Column
) -> DataFrame:
    """Child rows whose reference names no parent, compared without case; a missing one is legal."""
    name, match = "_reference", "_match"
    known = parent.select(match_key(F.col(parent_column).cast("string")).alias(match))
    return (
        child.select(key.cast("string").alias("row_key"), F.col(column).alias(name))
        .where(F.col(name).isNotNull())
        .withColumn(match, match_key(F.col(name).cast("string")))
        .join(known, match, "left_anti")
        .select("row_key", F.lit(rule).alias("rule"), F.col(name).cast("string").alias("reference"))
    )
