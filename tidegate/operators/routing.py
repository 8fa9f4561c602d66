"""Connection resolution, adapter routes and extraction options."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import (
    INVALID_COPY_OPTIONS,
    INVALID_SOURCE_OPTIONS,
    UNSUPPORTED_DATABASE_ROUTE,
    UNSUPPORTED_FILE_FORMAT,
    UNSUPPORTED_FILE_ROUTE,
)
from tidegate.functions.documents import is_json_object, kind_of, with_key
from tidegate.functions.text import match_key

# fixed values: the supported connection type and strategy pairs per pattern
ROUTES = {
    "DATABASE": ["SQL_SERVER|FULL", "SQL_SERVER|INCREMENTAL"],
    "FILE": ["SFTP|FULL", "SFTP|INCREMENTAL"],
}
ROUTED_FORMATS = ["DELIMITED_TEXT"]
# fixed values: the options of delimited text and their kinds
FILE_OPTIONS = {
    "file_name_pattern": "STRING",
    "delimiter": "STRING",
    "has_header": "BOOLEAN",
    "encoding": "STRING",
    "quote": "STRING",
    "escape": "STRING",
}


def resolve_connections(
    configs: DataFrame, connections: DataFrame, how: str = "inner"
) -> DataFrame:
    """Configs joined to the source and the target role of the connections, without case.

    With a left join, configs whose reference is missing stay, with no connection type.
    """

    def role(name: str) -> DataFrame:
        return connections.select(
            match_key(F.col("connection_ref")).alias(f"_{name}_key"),
            F.col("connection_type").alias(f"{name}_connection_type"),
            F.col("connection_settings").alias(f"{name}_connection_settings"),
        )

    for name in ("source", "target"):
        key = match_key(F.col(f"{name}_conn_ref"))
        configs = configs.join(role(name), key == F.col(f"_{name}_key"), how).drop(f"_{name}_key")
    return configs


def route_key(connection_type: Column, strategy: Column) -> Column:
    return F.concat_ws("|", F.upper(connection_type), F.upper(strategy))


def route_objects(resolved: DataFrame, formats: Iterable[str] = ROUTED_FORMATS) -> DataFrame:
    """Add the route of each resolved config, or the code why there is none.

    ``formats`` are those the reader registry in use can read. The file format is tested before the route, so an unreadable format is
    reported as such whatever its connection.
    """
    key = route_key(F.col("source_connection_type"), F.col("load_strategy"))
    pattern = F.upper("ingestion_pattern")
    is_file, is_table = pattern == "FILE", pattern == "DATABASE"
    readable = F.coalesce(F.upper("file_format").isin(*formats), F.lit(False))
    error = (
        F.when(is_file & ~readable, UNSUPPORTED_FILE_FORMAT)
        .when(is_file & ~key.isin(*ROUTES["FILE"]), UNSUPPORTED_FILE_ROUTE)
        .when(is_table & ~key.isin(*ROUTES["DATABASE"]), UNSUPPORTED_DATABASE_ROUTE)
    )
    return resolved.withColumns(
        {
            "route": F.when((is_file | is_table) & error.isNull(), key),
            "route_error": error,
        }
    )


def check_copy_options(configs: DataFrame, column: str = "copy_options") -> DataFrame:
    """Normalised extraction options, or the code for an unusable combination.

    No options mean no range split and parallelism left to Spark, written as 0
    here and never passed on.
    """
    text = F.col(column)
    options = F.try_parse_json(text)
    member = lambda name: F.try_variant_get(options, f"$.{name}", "variant")
    option = F.upper(F.try_variant_get(options, "$.partition_option", "string"))
    range_column = F.try_variant_get(options, "$.partition_column", "string")
    copies = F.try_variant_get(options, "$.parallel_copies", "bigint")
    copies_kind = kind_of(member("parallel_copies"))
    copies_legal = (
        copies_kind.isNull() | (copies_kind == "VOID")
        | F.coalesce((copies_kind == "BIGINT") & (copies > 0), F.lit(False))
    )
    chosen = F.coalesce(option, F.lit("NONE"))
    has_column = F.coalesce(F.length(F.trim(range_column)) > 0, F.lit(False))
    legal = text.isNull() | (
        is_json_object(text)
        & copies_legal
        & ((chosen == "NONE") | ((chosen == "DYNAMIC_RANGE") & has_column))
    )
    return configs.withColumns(
        {
            "partition_option": F.when(legal, chosen),
            "partition_column": F.when(legal & (chosen == "DYNAMIC_RANGE"), F.trim(range_column)),
            "parallel_copies": F.when(legal, F.coalesce(copies, F.lit(0))),
            "copy_error": F.when(~legal, INVALID_COPY_OPTIONS),
        }
    )


def set_parallel_copies(configs: DataFrame, copies: int, column: str = "copy_options") -> DataFrame:
    """The configs with the number of parallel copies set in their options.

    The other options keep their values and types.  A text that is no JSON object stays as it
    is and is reported by the check of the options; without options the object is a new one.
    """
    text = F.coalesce(column, F.lit("{}"))
    changed = with_key(F.when(is_json_object(text), text), "parallel_copies", F.lit(copies).cast("bigint"))
    return configs.withColumn(column, F.when(is_json_object(text), changed).otherwise(F.col(column)))


def check_file_options(configs: DataFrame, column: str = "source_options") -> DataFrame:
    """The reader options of file configs, or the code for a text that is no JSON object.

    ``file_options`` is a struct of the known options, empty where one is of another kind, so
    that a reader sees it as missing; ``file_members`` has every member as text, for readers
    with options of their own.
    """
    text = F.col(column)
    options = F.try_parse_json(text)

    def typed(name: str, kind: str) -> Column:
        path = f"$.{name}"
        is_kind = kind_of(F.try_variant_get(options, path, "variant")) == kind
        return F.when(is_kind, F.try_variant_get(options, path, kind.lower())).alias(name)

    legal = is_json_object(text)
    is_file = F.upper("ingestion_pattern") == "FILE"
    known = F.struct(*[typed(name, kind) for name, kind in FILE_OPTIONS.items()])
    return configs.withColumns(
        {
            "file_options": F.when(is_file & legal, known),
            "file_members": F.when(is_file & legal, F.from_json(text, "map<string,string>")),
            "file_option_error": F.when(is_file & ~legal, INVALID_SOURCE_OPTIONS),
        }
    )
