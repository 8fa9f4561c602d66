"""Finalisation, recovery and the versioned control tables."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidegate.errors import LoadError
from tidegate.operators.finalize import finalize
from tidegate.operators.recovery import recovery_actions
from tidegate.plans.store import ControlStore
from tidegate.schemas import AUDIT, CONFIG, FINALIZE_REQUEST, STATE
from tidegate.session import local_frame

START = datetime(2026, 1, 1)
LOW = "2026-10-08T10:00:00.1234567"


def call(order, run, **change):
    row = {field.name: None for field in FINALIZE_REQUEST}
    row.update(
        ingestion_config_id=1, batch_id="B", pipeline_run_id=run, pipeline_name="p",
        run_type="REGULAR", load_strategy="INCREMENTAL", watermark_field="u",
        processing_lower_bound=LOW, processing_upper_bound="H" + run, status="SUCCESS",
        start_time=START, end_time=START + timedelta(seconds=5), advance_watermark=True,
        call_order=order,
    )
    row.update(change)
    return row


def judge(spark, calls, audit=None, stored=LOW):
    state = local_frame(spark, [(1, "u", stored, None, None, None)], STATE)
    known = audit if audit is not None else local_frame(spark, [], AUDIT)
    configs = local_frame(
        spark,
        [(1, "S", "C", "s", "o", "/path", "DATABASE", None, None, None, None, "L", "t", "t",
          "INCREMENTAL", "u", True)],
        CONFIG,
    )
    return finalize(local_frame(spark, calls, FINALIZE_REQUEST), known, state, configs)


def outcomes(result):
    rows = result.outcomes().orderBy("call_order").collect()
    return [(r.outcome, r.error_number) for r in rows]


def values(result):
    return [r.last_watermark_value for r in result.new_state("2026-01-02").collect()]


def test_success_advances(spark):
    result = judge(spark, [call(1, "a")])
    assert outcomes(result) == [("RECORDED", None)]
    audit = result.audit_rows().first()
    assert (audit.status, audit.source_path, audit.duration_seconds) == ("SUCCESS", "/path", 5)
    state = result.new_state("2026-01-02T00:00:00").first()
    assert (state.last_watermark_value, state.last_successful_pipeline_run_id) == ("Ha", "a")


def test_guard_compares_texts(spark):
    """The same instant with a trailing mark is another text, so it conflicts."""
    result = judge(spark, [call(1, "a", processing_lower_bound=LOW + "Z")])
    assert outcomes(result) == [("CONFLICT", 51006)]
    audit = result.audit_rows().first()
    assert (audit.status, audit.error_code) == ("FAILED", "WATERMARK_CONFLICT")
    assert values(result) == [LOW]


def test_one_winner_per_config(spark):
    result = judge(spark, [call(3, "c"), call(1, "a"), call(2, "b")])
    assert outcomes(result) == [("RECORDED", None), ("CONFLICT", 51006), ("CONFLICT", 51006)]
    assert values(result) == ["Ha"]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"end_time": START - timedelta(seconds=2)}, 51000),
        ({"status": "FAILED"}, 51003),
        ({"processing_upper_bound": None}, 51004),
        ({"watermark_field": None}, 51004),
        ({"processing_upper_bound": LOW}, 51005),
        ({"advance_watermark": False, "processing_upper_bound": LOW}, None),
        ({"advance_watermark": False, "status": "FAILED", "error_code": "X"}, None),
        ({"watermark_field": "other"}, 51006),
    ],
)
def test_argument_errors(spark, change, expected):
    result = judge(spark, [call(1, "a", **change)])
    assert [number for _, number in outcomes(result)] == [expected]
    written = result.audit_rows().count()
    assert written == (0 if expected in (51000, 51003, 51004, 51005) else 1)


def test_repeating_a_call(spark):
    first = judge(spark, [call(1, "a")])
    audit = first.audit_rows()
    again = judge(
        spark,
        [call(1, "a"), call(2, "b", pipeline_run_id="a", status="SKIPPED", advance_watermark=False)],
        audit, stored="Ha",
    )
    assert outcomes(again) == [("NO_OP", None), ("REJECTED", 51007)]
    assert values(again) == ["Ha"] and again.audit_rows().count() == 0


def test_repeats_inside_one_call(spark):
    lost = {"processing_lower_bound": "stale"}
    result = judge(
        spark,
        [
            call(1, "a"), call(2, "a"), call(3, "a", error_code="X"),
            call(4, "b", **lost), call(5, "b", **lost),
            call(6, "c", processing_upper_bound=LOW), call(7, "c", advance_watermark=False),
        ],
    )
    assert outcomes(result) == [
        ("RECORDED", None), ("NO_OP", None), ("REJECTED", 51007),
        # the audit of b says FAILED, so the same SUCCESS call no longer matches
        ("CONFLICT", 51006), ("REJECTED", 51007),
        # an invalid first call leaves no audit behind
        ("REJECTED", 51005), ("RECORDED", None),
    ]


def test_one_audit_row_for_one_run_and_order(spark):
    same = judge(spark, [call(1, "a"), call(1, "a"), call(1, "a")])
    assert sorted(o for o, _ in outcomes(same)) == ["NO_OP", "NO_OP", "RECORDED"]
    assert same.audit_rows().count() == 1 and values(same) == ["Ha"]
    other = judge(spark, [call(1, "a"), call(1, "a", error_code="X"), call(1, "a", error_code="Y")])
    assert sorted(o for o, _ in outcomes(other)) == ["RECORDED", "REJECTED", "REJECTED"]
    assert other.audit_rows().count() == 1


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.sampled_from(["SUCCESS", "FAILED", "SKIPPED"])),
        min_size=1, max_size=6,
    )
)
def test_judging_twice_changes_nothing(spark, picks):
    calls = [
        call(n, run, status=status, advance_watermark=status == "SUCCESS")
        for n, (run, status) in enumerate(picks)
    ]
    first = judge(spark, calls).settled()
    state_after = values(first)[0]
    second = judge(spark, calls, first.audit_rows(), stored=state_after)
    assert second.audit_rows().count() == 0
    assert values(second) == [state_after]


def test_recovery(frame):
    audit = frame(
        "ingestion_config_id int, batch_id string, pipeline_run_id string, status string,"
        " error_code string",
        (1, "B", "done", "SUCCESS", None),
        (1, "B", "lost", "FAILED", "WATERMARK_CONFLICT"),
        (1, "B", "bad", "FAILED", "OTHER_ERROR"),
    )
    uncertain = frame(
        "n int, ingestion_config_id int, batch_id string, pipeline_run_id string,"
        " ingestion_pattern string",
        (0, 1, "B", "done", "FILE"), (1, 1, "B", "lost", "DATABASE"), (2, 1, "B", "lost", "file"),
        (3, 1, "B", "bad", "FILE"), (4, 1, "B", "gone", "FILE"), (5, 2, "B", "lost", "FILE"),
    )
    rows = recovery_actions(uncertain, audit).orderBy("n").collect()
    assert [(r.outcome_class, r.action, r.final_error) for r in rows] == [
        ("COMMITTED_SUCCESS", "KEEP", "FINALIZE_RESPONSE_FAILED_COMMITTED"),
        ("CONFIRMED_CONFLICT", "CLEAN_TABLE", "WATERMARK_CONFLICT"),
        ("CONFIRMED_CONFLICT", "CLEAN_TABLE_AND_LANDING", "WATERMARK_CONFLICT"),
        ("OTHER", "KEEP", "FINALIZE_OUTCOME_UNCONFIRMED"),
        ("OTHER", "KEEP", "FINALIZE_OUTCOME_UNCONFIRMED"),
        ("OTHER", "KEEP", "FINALIZE_OUTCOME_UNCONFIRMED"),
    ]
    unread = recovery_actions(uncertain, None).collect()
    assert {(r.action, r.final_error) for r in unread} == {
        ("KEEP", "FINALIZE_OUTCOME_LOOKUP_FAILED")
    }


def test_one_writer_per_version(spark, folder):
    store = ControlStore(spark, folder + "/control")
    assert store.version() == 0 and store.audit().count() == 0
    result = judge(spark, [call(1, "a")])
    assert store.commit(0, result.audit_rows(), result.new_state("2026-01-02")) == 1
    with pytest.raises(LoadError) as second:
        store.commit(0, result.audit_rows(), result.new_state("2026-01-02"))
    assert second.value.code == "WATERMARK_CONFLICT"
    assert [r.pipeline_run_id for r in store.audit().collect()] == ["a"]
    assert store.state().first().last_watermark_value == "Ha"


def test_incomplete_version_is_invisible(spark, folder):
    store = ControlStore(spark, folder + "/control")
    result = judge(spark, [call(1, "a")])
    store.commit(0, result.audit_rows(), result.new_state("2026-01-02"))
    # a writer claims version 2, writes its audit and dies before the state
    files, marker = store._path("claims/version=2")
    files.create(marker, False).close()
    result.audit_rows().write.parquet(f"{store.root}/audit/version=2")
    assert store.version() == 1 and store.audit().count() == 1
    store.release(2)
    with pytest.raises(ValueError):
        store.release(1)
    assert store.commit(1, result.audit_rows(), result.new_state("2026-01-03")) == 2
