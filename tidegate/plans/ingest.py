"""The load cycle: requests in, tables appended, one audit row per object out.

One plan decides about all requested objects.  Each object that runs is a Spark
job of its own; several are submitted at a time.  A page holds at most 5000
objects, and their outcomes are judged together at the end.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidegate.errors import (
    BRONZE_CLEANUP_FAILED,
    BRONZE_CLEANUP_INCOMPLETE,
    CONNECTION_NOT_FOUND,
    DUPLICATE_REQUEST,
    LANDING_CLEANUP_FAILED,
    LANDING_COPY_FAILED,
    LOAD_FAILED,
    SOURCE_QUERY_FAILED,
    LoadError,
    VersionTaken,
)
from tidegate.functions.text import (
    CLEANUP_MESSAGE_LIMIT, MESSAGE_LIMIT, PAIRED_MESSAGE_LIMIT, is_folder_name,
)
from tidegate.operators import bronze, finalize, landing, recovery, requests, routing, windows
from tidegate.operators.configs import (
    DEFAULT_PAGE,
    LARGEST_PAGE,
    checked_page_size,
    config_page,
    page_count,
)
from tidegate.operators.lineage import stamp_file_lineage, stamp_lineage, utc_now_text
from tidegate.plans.store import ControlStore
from tidegate.schemas import FINALIZE_REQUEST, RUN_REQUEST
from tidegate.session import local_frame
from tidegate.sources.files import discover, modified_window
from tidegate.sources.readers import READERS, named_read_failure, reader_for
from tidegate.sources.tables import upper_bound, window_rows

ENVELOPE = StructType(
    [StructField("envelope_id", IntegerType()), StructField("request_json", StringType())]
)
SOURCE_BOUND = StructType(
    [StructField("config_id", IntegerType()), StructField("source_upper_bound", StringType())]
)

PUBLISH_ATTEMPTS = 60
NAMED_FAILURES = 20  # clean-up failures that an error message names

TableSource = Callable[[Row], DataFrame]


@dataclass
class LoadCycle:
    """Everything one batch needs.

    ``open_table`` returns the source table of a config row, which carries the
    connection settings and the checked extraction options; see ``read_jdbc``.
    """

    spark: SparkSession
    store: ControlStore
    configs: DataFrame
    connections: DataFrame
    lake: str
    open_table: TableSource
    file_root: str = ""
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    registry: dict = field(default_factory=lambda: READERS)
    objects_at_once: int = 8

    def run_scope(
        self, request_json: str = "[]", source_system: str = "", page_size: int = DEFAULT_PAGE
    ) -> None:
        """Run explicit requests, or all active configs of a source system, page by page."""
        checked_page_size(page_size)
        envelope = local_frame(self.spark, [(0, request_json)], ENVELOPE)
        verdict = requests.validate_requests(envelope).first()
        if verdict.error_code is not None:
            raise LoadError(
                str(verdict.error_code), f"run requests refused; {verdict.duplicate_ids or ''}"
            )
        items = requests.request_items(envelope, "envelope_id").select(*RUN_REQUEST.fieldNames())
        scope = requests.resolve_scope(self.configs, source_system, items)
        pages = page_count(scope, page_size).first().page_count
        for page in range(pages):
            self.run(config_page(scope, page, page_size))

    def run(self, wanted: DataFrame) -> DataFrame:
        """Run the requests and return their outcomes after the audit is committed."""
        started = utc_now_text()
        base = self.store.version()
        plans = self._plan(wanted, started, base)
        with ThreadPoolExecutor(self.objects_at_once) as submitters:
            calls = list(submitters.map(lambda plan: self._finish(*plan, started), plans))
        judged = self._publish(local_frame(self.spark, calls, FINALIZE_REQUEST))
        self._compensate(judged)
        return judged.outcomes()

    def _publish(self, facts: DataFrame) -> finalize.Finalized:
        """Judge the loads against the latest control tables and publish the result.

        A concurrent cycle may publish first.  The loads are then judged again, on
        the state it left; whoever lost the checkpoint ends as a conflict.
        """
        for attempt in range(PUBLISH_ATTEMPTS):
            base = self.store.version()
            judged = finalize.finalize(
                facts, self.store.audit(base), self.store.state(base), self.configs
            ).settled()
            try:
                self.store.commit(base, judged.audit_rows(), judged.new_state(utc_now_text()[:-1]))
                return judged
            except VersionTaken:
                if attempt + 1 == PUBLISH_ATTEMPTS:
                    raise
                time.sleep(1)
        raise AssertionError("unreachable")

    def _plan(
        self, wanted: DataFrame, started: str, base: int
    ) -> list[tuple[Row, Row | None, Exception | None]]:
        """Decision, route, options and window of each request, as driver rows."""
        decided = requests.execution_decision(wanted, self.configs, self.connections)
        routed = routing.check_copy_options(
            routing.route_objects(
                routing.resolve_connections(self.configs, self.connections, "left"),
                list(self.registry),
            )
        )
        detail = routing.check_file_options(routed).withColumnRenamed("ingestion_config_id", "config_id").drop(
            "ingestion_pattern", "load_strategy"
        )
        rows = decided.join(detail, "config_id", "left").limit(LARGEST_PAGE + 1).collect()
        checked_page_size(max(1, len(rows)))
        if len({row.config_id for row in rows}) < len(rows):
            raise LoadError(str(DUPLICATE_REQUEST), "a config is requested more than once")
        needs_bound = [
            row
            for row in rows
            if row.decision == "DATABASE"
            and row.route == "SQL_SERVER|INCREMENTAL"
            and row.run_type.upper() == "REGULAR"
        ]
        with ThreadPoolExecutor(self.objects_at_once) as submitters:
            found = dict(submitters.map(self._source_bound, needs_bound))
        failures = {n: value for n, value in found.items() if isinstance(value, Exception)}
        limits = [(n, value) for n, value in found.items() if n not in failures]
        windowed = windows.plan_windows(
            wanted, self.configs, self.store.state(base),
            local_frame(self.spark, limits, SOURCE_BOUND), started,
        ).collect()
        by_id = {row.config_id: row for row in windowed}
        return [(row, by_id.get(row.config_id), failures.get(row.config_id)) for row in rows]

    def _source_bound(self, row: Row) -> tuple[int, str | None | Exception]:
        """The source's highest value as text, or the failure of looking it up."""
        try:
            bound = upper_bound(self.open_table(row), row.watermark_field)
            text = F.col("upper_bound")
            if bound.schema["upper_bound"].dataType != StringType():
                text = F.date_format(text, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            return row.config_id, bound.select(text).first()[0]
        except Exception as failure:  # other objects go on
            return row.config_id, failure

    def _verdict(
        self, row: Row, window: Row | None, lookup_failure: Exception | None
    ) -> tuple[str, str | None]:
        """How the object ends without a load, or PROCESS."""
        if row.terminal_status:
            return row.terminal_status, None if row.terminal_status == "SKIPPED" else row.decision
        if row.source_connection_type is None:
            return "FAILED", CONNECTION_NOT_FOUND
        if row.route_error:
            return "FAILED", row.route_error
        if lookup_failure:
            return "FAILED", SOURCE_QUERY_FAILED
        if window.window_class != "PROCESS":
            return window.window_class, window.window_error
        if row.decision == "DATABASE" and row.copy_error:
            return "FAILED", row.copy_error
        if row.decision == "FILE" and row.file_option_error:
            return "FAILED", row.file_option_error
        return "PROCESS", None

    def _finish(
        self, row: Row, window: Row | None, lookup_failure: Exception | None, started: str
    ) -> dict:
        """Load one object and describe how it ended, from its own start to its own end."""
        began = datetime.now(timezone.utc).replace(tzinfo=None)
        run_id = str(uuid.uuid4())
        low = window.processing_lower_bound if window else None
        high = window.processing_upper_bound if window else None
        status, code = self._verdict(row, window, lookup_failure)
        message = str(lookup_failure)[:MESSAGE_LIMIT] if lookup_failure else None
        count, leaf = 0, None
        if status == "PROCESS":
            try:
                if row.decision == "FILE":
                    leaf = landing.landing_leaf(
                        f"{self.lake}/{row.landing_path.strip('/')}", started[:10],
                        row.config_id, self.batch_id, run_id,
                    )
                    loaded = self._load_files(row, window, run_id, leaf)
                else:
                    loaded = self._load_table(row, window, run_id)
                status, count = ("SKIPPED", 0) if loaded is None else ("SUCCESS", loaded)
            except Exception as failure:  # every failure ends in an audit row
                status, count = "FAILED", None
                code, message = self._clean_up(row, run_id, failure)
        may_advance = bool(window and window.may_advance) and status == "SUCCESS"
        return {
            "ingestion_config_id": row.config_id,
            "batch_id": self.batch_id,
            "pipeline_run_id": run_id,
            "pipeline_name": "object_load",
            "run_type": row.run_type.upper(),
            "source_system": row.source_system,
            "source_conn_ref": row.source_conn_ref,
            "source_schema": row.source_schema,
            "source_object": row.source_object,
            "landing_path": leaf,
            "target_conn_ref": row.target_conn_ref,
            "target_schema": row.target_schema,
            "target_table": row.target_table,
            "load_strategy": row.load_strategy,
            "watermark_field": row.watermark_field,
            "processing_lower_bound": low,
            "processing_upper_bound": high,
            "source_row_count": count,
            "target_row_count": count,
            "status": status,
            "error_code": code,
            "error_message": message,
            "start_time": began,
            "end_time": datetime.now(timezone.utc).replace(tzinfo=None),
            "advance_watermark": may_advance,
            "call_order": row.config_id,
        }

    def _target(self, row: Row) -> str:
        schema = bronze.checked_segment("target_schema", row.target_schema)
        return f"{self.lake}/{schema}/{bronze.checked_segment('target_table', row.target_table)}"

    def _load_table(self, row: Row, window: Row, run_id: str) -> int:
        rows = self.open_table(row)
        if row.load_strategy == "INCREMENTAL":
            rows = window_rows(
                rows, row.watermark_field,
                window.processing_lower_bound, window.processing_upper_bound,
            )
        stamped = stamp_lineage(rows, self.batch_id, run_id, utc_now_text())
        return bronze.append_execution(stamped, self._target(row))

    def _load_files(self, row: Row, window: Row, run_id: str, leaf: str) -> int | None:
        """Land the files of the window, check the counts, append; None without files."""
        options = {**row.file_members, **row.file_options.asDict()}
        reader = reader_for(row.file_format, self.registry)
        root = f"{self.file_root}{row.source_path}".rstrip("/")
        found = discover(self.spark, root, options.get("file_name_pattern") or "*")
        if row.load_strategy == "INCREMENTAL":
            found = modified_window(
                found, window.processing_lower_bound, window.processing_upper_bound
            )
        try:
            manifest = landing.land_files(self.spark, found, root, leaf).checkpoint()
            gate = landing.landing_gate(manifest, landing.landed_files(self.spark, leaf)).first()
            if gate.outcome == "FAILED":
                raise LoadError(
                    gate.error_code,
                    f"{gate.files_read} files of {gate.bytes_read} bytes found,"
                    f" {gate.files_written} of {gate.bytes_written} landed",
                )
        except Exception as failure:
            self._remove_landing(row, run_id, leaf, failure)
            if isinstance(failure, LoadError):
                raise
            raise LoadError(LANDING_COPY_FAILED, str(failure)) from failure
        if gate.outcome == "SKIPPED":
            return None
        if gate.bytes_read == 0:
            return 0
        rows = stamp_file_lineage(reader(self.spark, leaf, options), leaf, row.source_path)
        stamped = stamp_lineage(rows, self.batch_id, run_id, utc_now_text(), with_date=True)
        return bronze.append_execution(stamped, self._target(row))

    def _remove_landing(self, row: Row, run_id: str, leaf: str, failure: Exception) -> None:
        try:
            landing.delete_landing(self.spark, leaf, row.config_id, self.batch_id, run_id)
        except Exception as second:
            raise LoadError(
                LANDING_CLEANUP_FAILED,
                f"{str(failure)[:PAIRED_MESSAGE_LIMIT // 2]}"
                f" | cleanup: {str(second)[:CLEANUP_MESSAGE_LIMIT]}",
            ) from failure

    def _clean_up(self, row: Row, run_id: str, failure: Exception) -> tuple[str, str]:
        """Remove what a failed write left behind; returns the audit code and message."""
        named = named_read_failure(failure)
        code = named.code if isinstance(named, LoadError) else LOAD_FAILED
        try:
            bronze.delete_execution(self.spark, self._target(row), self.batch_id, run_id)
        except Exception as second:
            cut = PAIRED_MESSAGE_LIMIT
            return BRONZE_CLEANUP_FAILED, f"load: {str(named)[:cut]} | cleanup: {str(second)[:cut]}"
        return code, str(named)[:MESSAGE_LIMIT]

    def _compensate(self, judged: finalize.Finalized) -> None:
        """Remove the rows and landed files of executions that lost the checkpoint."""
        lost = judged.judged.where(F.col("outcome") == finalize.CONFLICT)
        failed = self._remove_executions(lost).orderBy("pipeline_run_id").limit(NAMED_FAILURES).collect()
        if failed:
            told = "; ".join(f"{row.code}: {row.message}" for row in failed)
            raise LoadError(failed[0].code, told[:MESSAGE_LIMIT])

    def _remove_executions(self, lost: DataFrame) -> DataFrame:
        """Table rows, and landed files where there are any, of all given executions.

        Tasks remove them; the frame that comes back has a row for each that failed.
        """
        names = [F.col("target_schema"), F.col("target_table")]
        place = F.concat_ws("/", F.lit(bronze.qualified(self.spark, self.lake)), *names)
        safe = is_folder_name(names[0]) & is_folder_name(names[1])
        targets = lost.withColumn("target", F.when(safe, place)).checkpoint()
        removed = bronze.delete_executions(targets).checkpoint()
        kept = removed.where(F.col("outcome").isin(BRONZE_CLEANUP_FAILED, BRONZE_CLEANUP_INCOMPLETE)).select(
            "pipeline_run_id", F.col("outcome").alias("code"), "message"
        )
        # the landed files of rows that are still there stay as well
        cleared = targets.join(kept.select("pipeline_run_id"), "pipeline_run_id", "left_anti")
        return kept.unionByName(landing.delete_landings(self.spark, cleared).checkpoint())

    def recover(self, uncertain: DataFrame) -> DataFrame:
        """Settle executions whose finalisation answer was lost.

        ``uncertain`` names config, batch, run, pattern, target and landing path.
        Only executions with a confirmed conflict in the audit lose their data.
        Returns the final error of each.
        """
        try:
            audit = self.store.audit()
        except Exception:  # an audit that cannot be read confirms nothing
            audit = None
        judged = recovery.recovery_actions(uncertain, audit).checkpoint()
        database = F.col("action") == recovery.CLEAN_TABLE
        landed = F.when(database, F.lit(None)).otherwise(F.col("landing_path"))
        failed = self._remove_executions(
            judged.where(F.col("action") != recovery.KEEP).withColumn("landing_path", landed)
        )
        codes = failed.groupBy("pipeline_run_id").agg(F.min("code").alias("_failed"))
        final = F.coalesce("_failed", "final_error")
        return (
            judged.join(codes, "pipeline_run_id", "left")
            .withColumn("final_error", final)
            .select(*judged.columns)
        )
