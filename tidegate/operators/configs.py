"""Control tables: views over them, gaps, paging, seeding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import AMBIGUOUS_SEED, INVALID_CONFIG_PAGE_SIZE, LoadError
from tidegate.functions.text import match_key
from tidegate.operators.positions import dense_positions
from tidegate.schemas import CONFIG, INITIAL_WATERMARK

IDENTITY = ("source_system", "source_schema", "source_object")

NAMED_KEYS = 20  # keys that a refusal names

# fixed values: page size limits
LARGEST_PAGE = 5000
DEFAULT_PAGE = 1000


def watermark_view(configs: DataFrame, state: DataFrame) -> DataFrame:
    """State rows with the names of the object they belong to."""
    names = configs.select("ingestion_config_id", *IDENTITY, "load_strategy")
    return names.join(state, "ingestion_config_id")


def watermark_gaps(configs: DataFrame, state: DataFrame) -> DataFrame:
    """Incremental configs without state, or whose state is for another field."""
    stored = state.select(
        "ingestion_config_id", F.col("watermark_field").alias("state_field"), "last_watermark_value"
    )
    joined = (
        configs.where(F.upper("load_strategy") == "INCREMENTAL")
        .select("ingestion_config_id", "source_system", "source_object", "watermark_field")
        .join(stored, "ingestion_config_id", "left")
    )
    gap = F.when(F.col("state_field").isNull(), "MISSING").when(
        ~F.col("state_field").eqNullSafe(F.col("watermark_field")), "FIELD_MISMATCH"
    )
    return joined.withColumn("gap", gap).where(F.col("gap").isNotNull())


def missing_state(configs: DataFrame, state: DataFrame) -> DataFrame:
    """First state rows for incremental configs that have none; others stay as they are."""
    eligible = configs.where(
        (F.upper("load_strategy") == "INCREMENTAL")
        & F.upper("ingestion_pattern").isin("DATABASE", "FILE")
    )
    return eligible.join(state, "ingestion_config_id", "left_anti").select(
        "ingestion_config_id",
        "watermark_field",
        F.lit(INITIAL_WATERMARK).alias("last_watermark_value"),
    )


def checked_page_size(size: int) -> int:
    if not 1 <= size <= LARGEST_PAGE:
        raise LoadError(INVALID_CONFIG_PAGE_SIZE, f"{size} is outside 1..{LARGEST_PAGE}")
    return size


def page_count(scope: DataFrame, size: int = DEFAULT_PAGE) -> DataFrame:
    """Number of requests and of the pages they fill."""
    checked_page_size(size)
    return scope.agg(F.count(F.lit(1)).alias("active_config_count")).withColumn(
        "page_count", F.expr(f"(active_config_count + {size - 1}) div {size}")
    )


def config_page(scope: DataFrame, page: int, size: int = DEFAULT_PAGE) -> DataFrame:
    """One page of requests in id order."""
    checked_page_size(size)
    return scope.orderBy("config_id").offset(page * size).limit(size)


STAMPS = ("created_at", "updated_at")


def _merged(current: DataFrame, seed: DataFrame, key: list[str]) -> DataFrame:
    """Both sides of each key in one row: structs ``cur`` and ``new``, their numbers of rows.

    One grouping stands for the full outer join; keys compare without case.
    """
    names = [match_key(F.col(name)).alias(f"_key_{name}") for name in key]
    whole = lambda df: F.struct(*df.columns)
    none = lambda df: F.lit(None).cast(df.select(whole(df)).schema[0].dataType)
    both = current.select(*names, whole(current).alias("cur"), none(seed).alias("new")).unionByName(
        seed.select(*names, none(current).alias("cur"), whole(seed).alias("new"))
    )
    return both.groupBy(*[f"_key_{name}" for name in key]).agg(
        F.any_value("cur", True).alias("cur"), F.any_value("new", True).alias("new"),
        F.count("cur").alias("in_current"), F.count("new").alias("in_seed"),
    )


def _ambiguous(merged: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    return merged.where((F.col("in_current") > 1) | (F.col("in_seed") > 1)).select(
        *[F.col(f"_key_{name}").alias(name) for name in key], "in_current", "in_seed"
    )


def ambiguous_configs(current: DataFrame, seed: DataFrame) -> DataFrame:
    """Config keys that one side has more than once, spellings without case counted together."""
    key = list(IDENTITY)
    return _ambiguous(_merged(current.select(*key), seed.select(*key), key), key)


def _checked(merged: DataFrame, key: list[str]) -> DataFrame:
    """The merge, stored once, or a refusal that names keys found twice on a side."""
    merged = merged.checkpoint()
    doubled = _ambiguous(merged, key).orderBy(*key).limit(NAMED_KEYS).collect()
    if doubled:
        told = "; ".join(".".join(str(row[name]) for name in key if row[name] is not None) for row in doubled)
        raise LoadError(AMBIGUOUS_SEED, f"more than one row for {told}")
    return merged


def upsert_configs(
    current: DataFrame, seed: DataFrame, protected: str | None = None, now: Column | None = None
) -> DataFrame:
    """The config table after seeding: matches updated, missing rows added.

    A key that either side has twice is refused before anything is written.  Rows of the
    ``protected`` source system are only ever added.  New rows are numbered upwards from
    the largest id in use; their number comes from their place among the new rows, so it
    does not depend on how Spark splits them.  With ``now`` the result has ``created_at``
    and ``updated_at``: kept rows keep theirs, a change sets the second, a new row both.
    """
    key = list(IDENTITY)
    settings = [f.name for f in CONFIG.fields if f.name not in ("ingestion_config_id", *IDENTITY)]
    for name in STAMPS if now is not None else ():
        if name not in current.columns:
            current = current.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    stamps = list(STAMPS) if now is not None else []
    merged = _checked(
        _merged(current.select("ingestion_config_id", *key, *settings, *stamps), seed.select(*key, *settings), key), key
    )
    guarded = (
        match_key(F.col("cur.source_system")) == F.lower(F.lit(protected))
        if protected
        else F.lit(False)
    )
    touched = F.col("new").isNotNull() & ~guarded
    stamped = lambda at: [
        F.when(at, now).otherwise(F.col(f"cur.{name}")).alias(name) if name == "updated_at"
        else F.col(f"cur.{name}").alias(name)
        for name in stamps
    ]
    updated = merged.where(F.col("cur").isNotNull()).select(
        "cur.ingestion_config_id",
        *[F.col(f"cur.{name}") for name in IDENTITY],
        *[
            F.when(touched, F.col(f"new.{name}")).otherwise(F.col(f"cur.{name}")).alias(name)
            for name in settings
        ],
        *stamped(touched),
        F.when(touched, "UPDATED").otherwise("KEPT").alias("change"),
    )
    missing = merged.where(F.col("cur").isNull()).select("new.*")
    last_id = current.agg(F.max("ingestion_config_id")).first()[0] or 0
    numbered = dense_positions(missing, key, "_place")
    added = numbered.select(
        (F.col("_place") + last_id).cast("int").alias("ingestion_config_id"),
        *IDENTITY,
        *settings,
        *[now.alias(name) for name in stamps],
        F.lit("ADDED").alias("change"),
    )
    return updated.unionByName(added)


def upsert_connections(current: DataFrame, seed: DataFrame) -> DataFrame:
    """The connections after seeding: references in the seed replaced, new ones added.

    A reference that either side has twice is refused.
    """
    columns = ["connection_ref", "connection_type", "connection_settings"]
    merged = _checked(_merged(current.select(*columns), seed.select(*columns), columns[:1]), columns[:1])
    known = F.col("cur").isNotNull()
    return merged.select(
        F.when(known, F.col("cur.connection_ref")).otherwise(F.col("new.connection_ref")).alias("connection_ref"),
        *[F.coalesce(f"new.{name}", f"cur.{name}").alias(name) for name in columns[1:]],
    )
