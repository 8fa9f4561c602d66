"""Run requests: validation of envelopes, normalised items, run scope, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import (
    AMBIGUOUS_RUN_SCOPE,
    ARRAY_EXPECTED,
    BAD_REQUEST_FIELDS,
    DUPLICATE_REQUEST,
    NO_ACTIVE_CONFIGS,
    OBJECT_EXPECTED,
    LoadError,
)
from tidegate.functions.documents import bracketed, kind_of, opens_with
from tidegate.functions.once import computed_once
from tidegate.functions.text import duplicate_list, match_key
from tidegate.schemas import RUN_TYPES

LARGEST_ID = 2**31 - 1


def _config_id(fields: Column) -> Column:
    """The id where it is a JSON integer in INT range above zero, else NULL."""
    value = fields["config_id"]
    number = F.try_variant_get(value, "$", "bigint")
    usable = (kind_of(value) == "BIGINT") & number.between(1, LARGEST_ID)
    return F.when(usable, number.cast("int"))


def _run_type(fields: Column) -> Column:
    """The upper-cased run type where it is a known text, else NULL."""
    text = F.upper(F.try_variant_get(fields["run_type"], "$", "string"))
    return F.when(text.isin(*RUN_TYPES), text)


def _bound_is_legal(fields: Column, key: str) -> Column:
    return F.coalesce(kind_of(fields[key]), F.lit("VOID")).isin("STRING", "VOID")


def _parsed(envelopes: DataFrame, text: str) -> DataFrame:
    """Add whether the text is an array, and its items as maps.

    The items are NULL as a whole when one of them is no object.
    """
    document = computed_once(envelopes, _document=bracketed(F.col(text)))
    is_array = (
        opens_with(F.col(text), "[")
        & F.col("_document").isNotNull()
        & F.try_variant_get("_document", "$[1]", "variant").isNull()
    )
    return computed_once(
        document,
        _is_array=F.coalesce(is_array, F.lit(False)),
        _items=F.try_variant_get("_document", "$[0]", "array<map<string,variant>>"),
    ).drop("_document")


def _repeated(ids: Column) -> Column:
    """Values that occur more than once, in order, each named once."""
    start = F.struct(
        F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("found")
    )

    def step(seen: Column, one: Column) -> Column:
        again = (seen["last"] == one) & ~F.array_contains(seen["found"], one)
        found = F.when(again, F.array_append(seen["found"], one)).otherwise(seen["found"])
        return F.struct(one.alias("last"), found.alias("found"))

    return F.aggregate(F.array_sort(ids), start, step, lambda seen: seen["found"])


def validate_requests(envelopes: DataFrame, text: str = "request_json") -> DataFrame:
    """Each envelope with the number of its first failing check, or NULL.

    Checks, in order: a JSON array; of objects; with well-formed fields; without
    a repeated config id.  Everything is computed inside the envelope's own row:
    nothing is exploded, so nothing is shuffled.
    """
    facts = F.transform(
        "_items",
        lambda item: F.struct(
            item.isNull().alias("not_object"),
            _config_id(item).alias("id"),
            (
                _run_type(item).isNotNull()
                & _bound_is_legal(item, "lower_bound")
                & _bound_is_legal(item, "upper_bound")
            ).alias("well_formed"),
        ),
    )
    checked = computed_once(_parsed(envelopes, text), _facts=facts)
    ids = F.transform("_facts", lambda fact: fact["id"])
    bad = F.exists("_facts", lambda fact: fact["id"].isNull() | ~fact["well_formed"])
    error = (
        F.when(~F.col("_is_array"), ARRAY_EXPECTED)
        .when(
            F.col("_facts").isNull() | F.exists("_facts", lambda fact: fact["not_object"]),
            OBJECT_EXPECTED,
        )
        .when(bad, BAD_REQUEST_FIELDS)
        .when(F.size(F.array_distinct(ids)) < F.size(ids), DUPLICATE_REQUEST)
    )
    judged = computed_once(checked, error_code=error)
    named = F.transform(_repeated(ids), lambda one: one.cast("string"))
    listed = F.when(
        F.col("error_code") == DUPLICATE_REQUEST, duplicate_list(F.array_join(named, ", "))
    )
    return computed_once(judged, duplicate_ids=listed).select(
        *envelopes.columns, "error_code", "duplicate_ids"
    )


def request_items(envelopes: DataFrame, key: str, text: str = "request_json") -> DataFrame:
    """One row per item of the envelopes, missing and null bounds as empty text.

    Meant for envelopes that passed validation: items without a usable id or run
    type keep NULL there.
    """
    items = _parsed(envelopes, text).select(key, F.posexplode("_items").alias("item_no", "_item"))
    item = F.col("_item")
    bound = lambda name: F.coalesce(
        F.try_variant_get(item[name], "$", "string"), F.lit("")
    )
    return items.select(
        key,
        "item_no",
        _config_id(item).alias("config_id"),
        _run_type(item).alias("run_type"),
        bound("lower_bound").alias("lower_bound"),
        bound("upper_bound").alias("upper_bound"),
    )


def duplicate_requests(items: DataFrame, key: str) -> DataFrame:
    """Config ids asked for more than once in one envelope."""
    counted = items.groupBy(key, "config_id").agg(F.count(F.lit(1)).alias("request_count"))
    return counted.where(F.col("request_count") > 1)


def active_configs(configs: DataFrame, source_system: str = "") -> DataFrame:
    """Active configs as REGULAR requests, optionally of one source system."""
    chosen = configs.where(F.col("is_active"))
    wanted = (source_system or "").strip()
    if wanted:
        chosen = chosen.where(match_key(F.col("source_system")) == F.lower(F.lit(wanted)))
    return chosen.select(
        F.col("ingestion_config_id").alias("config_id"),
        F.lit("REGULAR").alias("run_type"),
        F.lit("").alias("lower_bound"),
        F.lit("").alias("upper_bound"),
    )


def resolve_scope(
    configs: DataFrame, source_system: str = "", requests: DataFrame | None = None
) -> DataFrame:
    """The requests of one run: the explicit ones, or all active configs in scope."""
    explicit = requests is not None and not requests.isEmpty()
    if explicit and (source_system or "").strip():
        raise LoadError(AMBIGUOUS_RUN_SCOPE, "both a source system and explicit requests given")
    if explicit:
        return requests
    scope = active_configs(configs, source_system)
    if scope.isEmpty():
        raise LoadError(NO_ACTIVE_CONFIGS, "nothing is active in the run scope")
    return scope


# fixed values: the outcomes of the execution decision
CONFIG_NOT_FOUND = "CONFIG_NOT_FOUND"
INACTIVE = "INACTIVE"
INVALID_REQUEST = "INVALID_REQUEST"
INVALID_TARGET = "INVALID_TARGET"
UNSUPPORTED = "UNSUPPORTED"


def _bounds_fit(strategy: Column) -> Column:
    """Bounds are required for an incremental backfill and refused otherwise."""
    low, high = (F.trim(F.coalesce(F.col(n), F.lit(""))) for n in ("lower_bound", "upper_bound"))
    needs_bounds = (F.upper("run_type") == "BACKFILL") & (strategy == "INCREMENTAL")
    return F.when(needs_bounds, (low != "") & (high != "")).otherwise((low == "") & (high == ""))


def execution_decision(
    requests: DataFrame, configs: DataFrame, connections: DataFrame
) -> DataFrame:
    """Decide what happens to each request; the first rule that applies wins.

    Joins are plain equi-joins: sizes decide at run time whether a side is broadcast.
    """
    config = configs.select(
        F.col("ingestion_config_id").alias("config_id"),
        "ingestion_pattern",
        "load_strategy",
        "is_active",
        "target_conn_ref",
    )
    target = connections.select(
        match_key(F.col("connection_ref")).alias("_target_key"),
        F.col("connection_type").alias("_target_type"),
    )
    # the small join first: config with its target, then the requests
    known = config.join(
        target, match_key(F.col("target_conn_ref")) == F.col("_target_key"), "left"
    ).withColumn("_found", F.lit(True))
    pattern, strategy = F.upper("ingestion_pattern"), F.upper("load_strategy")
    decision = (
        F.when(F.col("_found").isNull(), CONFIG_NOT_FOUND)
        .when(~F.col("is_active"), INACTIVE)
        .when(~(F.upper("run_type").isin(*RUN_TYPES) & _bounds_fit(strategy)), INVALID_REQUEST)
        .when(
            F.coalesce(F.upper("_target_type"), F.lit("")) != "LAKEHOUSE",
            INVALID_TARGET,
        )
        .when(pattern.isin("DATABASE", "FILE"), pattern)
        .otherwise(UNSUPPORTED)
    )
    status = F.when(decision == INACTIVE, "SKIPPED").when(
        ~decision.isin("DATABASE", "FILE"), "FAILED"
    )
    return (
        requests.join(known, "config_id", "left")
        .withColumn("decision", decision)
        .withColumn("terminal_status", status)
        .select(*requests.columns, "ingestion_pattern", "load_strategy", "decision",
                "terminal_status")
    )
