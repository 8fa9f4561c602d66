"""Control, audit and request tables derived from the test tables.

Each frame exists twice: as a DataFrame here and as SQL in ``frames_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.temporal import seconds_crossed

FLOOR_DATE = "1999-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(number: Column, values: list[str | None]) -> Column:
    """Value chosen by the number modulo the length of the list."""
    choice = None
    for place, value in enumerate(values):
        here = F.pmod(number, F.lit(len(values))) == place
        choice = F.when(here, F.lit(value)) if choice is None else choice.when(here, F.lit(value))
    return choice


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def hour_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH':00:00'")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit rows: one per event, all five statuses, names to be cleaned."""
    kind, key, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    rows = F.get_json_object("props", "$.k").cast("bigint")
    counted = F.when(key % 7 != 0, rows)
    status = (
        F.when(kind.isin("purchase", "click"), "SUCCESS")
        .when(kind == "view", "SKIPPED")
        .when(kind == "error", "FAILED")
        .when(user % 2 == 0, "CANCELLED")
        .otherwise("WARN")
    )
    end = F.col("ts") + F.make_dt_interval(
        secs=(F.floor("value") + F.lit(0.5)).cast("decimal(18,6)")
    )
    failed = kind == "error"
    return table(spark, folder, "events").select(
        key.alias("ingestion_log_id"),
        (user % 8 + 1).cast("int").alias("ingestion_config_id"),
        F.concat(F.lit("B"), F.date_format("ts", "yyyyMMddHH")).alias("batch_id"),
        F.concat(F.lit("R"), text("event_id")).alias("pipeline_run_id"),
        F.lit("object_load").alias("pipeline_name"),
        F.when(key % 10 == 0, "BACKFILL").otherwise("REGULAR").alias("run_type"),
        pick(user, ["SHOP", " CARRIER ", "BENCH", "   ", "shop"]).alias("source_system"),
        pick(user, [None, "", "sales"]).alias("source_schema"),
        F.concat(F.lit("obj_"), text(user % 5)).alias("source_object"),
        F.when(key % 4 == 0, "FULL").otherwise("INCREMENTAL").alias("load_strategy"),
        hour_text(F.col("ts")).alias("processing_lower_bound"),
        hour_text(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("processing_upper_bound"),
        counted.alias("source_row_count"),
        counted.alias("target_row_count"),
        status.alias("status"),
        F.when(failed & (key % 3 == 0), "WATERMARK_CONFLICT")
        .when(failed, "SOURCE_QUERY_FAILED")
        .alias("error_code"),
        F.when(failed, F.concat(F.lit("failed after "), text(rows), F.lit(" rows"))).alias(
            "error_message"
        ),
        F.col("ts").alias("start_time"),
        end.alias("end_time"),
        seconds_crossed(F.col("ts"), end).alias("duration_seconds"),
    )


# Extraction options by nation; the rest have none.
COPY_OPTIONS: list[str | None] = [
    None,
    '{"partition_option":"NONE"}',
    '{"partition_option":"DYNAMIC_RANGE","partition_column":"line_id"}',
    '{"partition_option":"DYNAMIC_RANGE","partition_column":"line_id","parallel_copies":8}',
    '{"partition_option":"NONE","parallel_copies":0}',
    '{"partition_option":"DYNAMIC_RANGE"}',
    '{"partition_option":"PHYSICAL_PARTITIONS"}',
    "not json",
    "[1]",
    '{"parallel_copies":"8"}',
    '{"parallel_copies":2.5}',
]
FILE_OPTIONS = (
    '{"file_name_pattern":"part-*.csv","delimiter":",","has_header":true,'
    '"encoding":"UTF-8","quote":"\\"","escape":"\\\\"}'
)


def configs(spark: SparkSession, folder: str) -> DataFrame:
    """Config rows: one per customer, some of them breaking a rule."""
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    is_file = segment.isin("FURNITURE", "HOUSEHOLD")
    is_table = segment.isin("AUTOMOBILE", "BUILDING")
    incremental = F.col("c_acctbal") < 5000
    copy_options = F.lit(None).cast("string")
    for place, options in enumerate(COPY_OPTIONS):
        if options is not None:
            copy_options = F.when(nation == place, options).otherwise(copy_options)
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).cast("int").alias("ingestion_config_id"),
        F.when(segment == "AUTOMOBILE", "SHOP")
        .when(segment == "BUILDING", "shop ")
        .when(is_file, "CARRIER")
        .otherwise("BENCH")
        .alias("source_system"),
        F.concat(F.lit("C"), text("c_nationkey")).alias("source_conn_ref"),
        F.when(is_table & (nation != 13), "sales")
        .when(is_table, "\t ")
        .alias("source_schema"),
        F.concat(F.lit("obj_"), text("c_custkey")).alias("source_object"),
        F.when(is_file & (nation != 14), "/outbound/feed/").alias("source_path"),
        F.when(is_table, "DATABASE").when(is_file, "FILE").otherwise("API").alias(
            "ingestion_pattern"
        ),
        F.when(segment == "HOUSEHOLD", "DELIMITED_TEXT")
        .when((segment == "FURNITURE") & (nation != 15), "PARQUET")
        .alias("file_format"),
        F.when(is_file & (nation == 12), '{"delimiter":","} more')
        .when(is_file, FILE_OPTIONS)
        .alias("source_options"),
        copy_options.alias("copy_options"),
        F.when(is_file, F.when(nation == 16, " ").otherwise("landing/feed/")).alias("landing_path"),
        F.concat(F.lit("L"), text("c_nationkey")).alias("target_conn_ref"),
        F.lit("bronze").alias("target_schema"),
        F.when(nation == 17, " \n").otherwise(F.concat(F.lit("t_"), text("c_custkey"))).alias(
            "target_table"
        ),
        F.when(incremental, "INCREMENTAL").otherwise("FULL").alias("load_strategy"),
        F.when(incremental & (nation == 18), None)
        .when(incremental & is_file & (nation == 9), "file_name")
        .when(incremental & is_file, "last_modified_time")
        .when(incremental, "updated_at")
        .alias("watermark_field"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def connections(spark: SparkSession, folder: str) -> DataFrame:
    """Two connections per nation: source ``C<n>`` and target ``L<n>``; none of nation 19."""
    nation = table(spark, folder, "nation").where(F.col("n_name") != "NATION_19")
    region = F.col("n_regionkey")
    source = nation.select(
        F.concat(F.lit("C"), text("n_nationkey")).alias("connection_ref"),
        F.when(region.isin(0, 1), "SQL_SERVER")
        .when(region.isin(2, 3), "sftp")
        .otherwise("LAKEHOUSE")
        .alias("connection_type"),
        F.concat(F.lit('{"connectionId":"'), F.col("n_name"), F.lit('"}')).alias(
            "connection_settings"
        ),
    )
    target = nation.select(
        F.concat(F.lit("L"), text("n_nationkey")).alias("connection_ref"),
        F.when(region == 4, "FTP").otherwise("LAKEHOUSE").alias("connection_type"),
        F.when(region == 3, "[]").otherwise('{"itemId":"lake"}').alias("connection_settings"),
    )
    return source.unionByName(target)


def source_max(spark: SparkSession, folder: str) -> DataFrame:
    """Upper bound of each table source: the customer's latest order."""
    return (
        table(spark, folder, "orders")
        .groupBy((F.col("o_custkey") + 1).cast("int").alias("config_id"))
        .agg(day_text(F.max("o_orderdate")).alias("source_upper_bound"))
    )


def state(spark: SparkSession, folder: str) -> DataFrame:
    """Checkpoints: none of nation 3, another field for nation 5, equal to the
    source's bound for nation 7 (with a trailing mark for nation 8)."""
    nation = F.col("c_nationkey")
    bound = source_max(spark, folder)
    floor = F.date_add(F.lit(FLOOR_DATE).cast("date"), (F.col("c_custkey") % 1500).cast("int"))
    value = (
        F.when((nation == 7) & F.col("source_upper_bound").isNotNull(), F.col("source_upper_bound"))
        .when(
            (nation == 8) & F.col("source_upper_bound").isNotNull(),
            F.concat("source_upper_bound", F.lit("Z")),
        )
        .when(nation == 20, F.lit(" \t"))
        .otherwise(F.concat(text(floor), F.lit("T00:00:00")))
    )
    field = F.when(nation == 5, "another_field").when(
        F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "last_modified_time"
    ).otherwise("updated_at")
    return (
        table(spark, folder, "customer")
        .where((F.col("c_acctbal") < 5000) & (nation != 3))
        .withColumn("config_id", (F.col("c_custkey") + 1).cast("int"))
        .join(bound, "config_id", "left")
        .select(
            F.col("config_id").alias("ingestion_config_id"),
            field.alias("watermark_field"),
            value.alias("last_watermark_value"),
            F.lit(None).cast("string").alias("last_successful_batch_id"),
            F.lit(None).cast("string").alias("last_successful_pipeline_run_id"),
            F.lit(None).cast("timestamp_ntz").alias("watermark_updated_at"),
        )
    )


def run_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests: one per order; urgent ones are backfills, some are malformed."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    backfill = priority.isin("1-URGENT", "2-HIGH")
    unknown = (priority == "5-LOW") & (status == "F")
    low = day_text(F.col("o_orderdate"))
    moved = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 3 - 1).cast("int"))
    high = F.concat(text(moved), F.lit("T00:00:00"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_custkey") + 1 + F.when(unknown, 1_000_000_000).otherwise(0))
        .cast("int")
        .alias("config_id"),
        F.when(backfill, "BACKFILL").when(priority == "3-MEDIUM", "regular").otherwise("REGULAR")
        .alias("run_type"),
        F.when(backfill & status.isin("F", "O"), low)
        .when((priority == "3-MEDIUM") & (status == "O"), low)
        .otherwise("")
        .alias("lower_bound"),
        F.when(backfill & (status == "F"), high).otherwise("").alias("upper_bound"),
    )


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Request texts: one per event, in eight shapes, most of them wrong."""
    one, two = text(F.col("user_id") + 1), text(F.col("user_id") + 1001)
    shape = F.pmod("event_id", F.lit(8))

    def doc(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    request = (
        F.when(
            shape == 0,
            doc(' [{"config_id":', one, ',"run_type":"REGULAR"},{"config_id":', two,
                ',"run_type":"backfill","lower_bound":"2024-01-01T00:00:00Z",'
                '"upper_bound":null}]'),
        )
        .when(shape == 1, doc('[{"config_id":"', one, '","run_type":"REGULAR"}]'))
        .when(
            shape == 2,
            doc('[{"config_id":', pick(F.col("user_id"), ["0", "-4", "7.0", "99999999999"]),
                ',"run_type":"REGULAR"}]'),
        )
        .when(shape == 3, doc('[{"config_id":', one, "}]"))
        .when(
            shape == 4,
            doc('[{"config_id":', one, ',"run_type":"BACKFILL","lower_bound":5}]'),
        )
        .when(shape == 5, doc('[{"config_id":', one, ',"run_type":"REGULAR"},"', two, '"]'))
        .when(
            shape == 6,
            F.when(F.col("event_type") == "view", doc('{"config_id":', one, "}"))
            .when(F.col("event_type") == "click", doc("[", one))
            .when(F.col("event_type") == "error", doc("[] ", one)),
        )
        .otherwise(
            doc('[{"config_id":', one, ',"run_type":"REGULAR"},{"config_id":', two,
                ',"run_type":"REGULAR"},{"config_id":', one,
                ',"run_type":"BACKFILL"},{"config_id":', two, ',"run_type":"REGULAR"}]')
        )
    )
    return table(spark, folder, "events").select("event_id", request.alias("request_json"))


def finalize_inputs(
    spark: SparkSession, folder: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Finalize requests (with replays), the audit they meet, and the state."""
    events = table(spark, folder, "events")
    key, kind = F.col("event_id"), F.col("event_type")
    low = F.when(key % 3 == 0, "2023-12-31T00:00:00").otherwise("2024-01-01T00:00:00")
    high = F.when(key % 13 == 0, None).when(key % 11 == 0, low).otherwise(
        F.concat(F.lit("H"), text("event_id"))
    )
    status = (
        F.when(kind.isin("purchase", "click"), "SUCCESS")
        .when(kind == "view", "SKIPPED")
        .when(kind == "error", "FAILED")
        .otherwise("CANCELLED")
    )
    length = F.when(key % 17 == 0, -2).otherwise(3)
    base = events.select(
        (key * 2).alias("call_order"),
        (F.col("user_id") + 1).cast("int").alias("ingestion_config_id"),
        F.concat(F.lit("B"), F.date_format("ts", "yyyyMMddHH")).alias("batch_id"),
        F.concat(F.lit("R"), text("event_id")).alias("pipeline_run_id"),
        F.lit("object_load").alias("pipeline_name"),
        F.lit("REGULAR").alias("run_type"),
        *[
            F.lit(None).cast("string").alias(name)
            for name in ("source_system", "source_conn_ref", "source_schema", "source_object",
                         "landing_path", "target_conn_ref", "target_schema", "target_table")
        ],
        F.lit("INCREMENTAL").alias("load_strategy"),
        F.lit("updated_at").alias("watermark_field"),
        low.alias("processing_lower_bound"),
        high.alias("processing_upper_bound"),
        F.lit(None).cast("bigint").alias("source_row_count"),
        F.lit(None).cast("bigint").alias("target_row_count"),
        status.alias("status"),
        F.when(kind == "error", "SOURCE_QUERY_FAILED").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=length)).alias("end_time"),
        ((status == "SUCCESS") | ((kind == "error") & (key % 5 == 0))).alias("advance_watermark"),
        kind.alias("_kind"),
    )
    again = base.where(F.col("_kind").isin("purchase", "view")).withColumns(
        {
            # some replays come with the order of the call they repeat
            "call_order": F.col("call_order") + F.when(
                (F.col("_kind") == "purchase") & (F.col("call_order") % 4 == 0), 0
            ).otherwise(1),
            "status": F.when(F.col("_kind") == "view", "SUCCESS").otherwise(F.col("status")),
        }
    )
    requests = base.unionByName(again).drop("_kind")
    recorded = base.where(F.col("_kind") == "signup").withColumn(
        "status",
        F.when(F.col("call_order") % 8 == 0, "WARN").otherwise(F.col("status")),
    )
    current = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).cast("int").alias("ingestion_config_id"),
        F.lit("updated_at").alias("watermark_field"),
        F.when(F.col("c_acctbal") < 0, "2022-02-02T00:00:00")
        .otherwise("2024-01-01T00:00:00")
        .alias("last_watermark_value"),
        F.lit(None).cast("string").alias("last_successful_batch_id"),
        F.lit(None).cast("string").alias("last_successful_pipeline_run_id"),
        F.lit(None).cast("timestamp_ntz").alias("watermark_updated_at"),
    )
    return requests, recorded.drop("_kind"), current
