"""Envelope validation, run scope and decisions."""

import json

import pytest

from tidegate.errors import LoadError
from tidegate.operators import requests

GOOD = {"config_id": 5, "run_type": "BACKFILL", "lower_bound": "a", "upper_bound": None}


def errors(frame, *texts):
    rows = frame("n int, request_json string", *enumerate(texts))
    result = requests.validate_requests(rows).orderBy("n").collect()
    return [row.error_code for row in result]


def test_first_failing_check_wins(frame):
    assert errors(
        frame,
        json.dumps([GOOD]),
        "[]",
        None,
        "",
        "{}",
        "[1",
        "[] []",
        '[{"config_id":1}] more',
        "[],[]",
        json.dumps([GOOD, 7]),
        "[null]",
        '["{}"]',
        json.dumps([{"config_id": "x"}, 3]),
    ) == [None, None, 51010, 51010, 51010, 51010, 51010, 51010, 51010, 51011, 51011, 51011, 51011]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"config_id": "5"}, 51012),
        ({"config_id": 0}, 51012),
        ({"config_id": -3}, 51012),
        ({"config_id": 5.5}, 51012),
        ({"config_id": True}, 51012),
        ({"config_id": None}, 51012),
        ({"config_id": 2**31 - 1}, None),
        ({"config_id": 2**31}, 51012),
        ({"config_id": 10**25}, 51012),
        ({"run_type": "backfill"}, None),
        ({"run_type": "OTHER"}, 51012),
        ({"run_type": 1}, 51012),
        ({"run_type": None}, 51012),
        ({"lower_bound": 5}, 51012),
        ({"lower_bound": {}}, 51012),
        ({"upper_bound": "2026"}, None),
        ({"unknown_key": [1, 2]}, None),
    ],
)
def test_field_rules(frame, change, expected):
    assert errors(frame, json.dumps([{**GOOD, **change}])) == [expected]


def test_integer_must_be_written_as_one(frame):
    text = '[{"config_id":%s,"run_type":"REGULAR"}]'
    assert errors(frame, text % "1.0", text % "1e0", text % "1") == [51012, 51012, None]


def test_duplicates_are_listed_once_and_cut(frame):
    some = [{**GOOD, "config_id": n} for n in (9, 4, 9, 4, 9, 1)]
    many = [{**GOOD, "config_id": n} for n in list(range(1000, 2000)) * 2]
    rows = frame("n int, request_json string", (0, json.dumps(some)), (1, json.dumps(many)))
    first, second = requests.validate_requests(rows).orderBy("n").collect()
    assert (first.error_code, first.duplicate_ids) == (51013, "4, 9")
    assert second.error_code == 51013
    assert second.duplicate_ids.endswith(" ...") and len(second.duplicate_ids) == 1804


def test_a_large_envelope_is_judged_in_linear_steps(frame):
    items = [{**GOOD, "config_id": n + 1} for n in range(5000)]
    assert errors(frame, json.dumps(items)) == [None]


def test_missing_bounds_become_empty_text(frame):
    rows = frame(
        "n int, request_json string",
        (0, '[{"config_id":1,"run_type":"regular"},{"config_id":2,"run_type":"BACKFILL",'
            '"lower_bound":null,"upper_bound":"u"}]'),
    )
    items = requests.request_items(rows, "n").orderBy("item_no").collect()
    assert [tuple(i)[2:] for i in items] == [(1, "REGULAR", "", ""), (2, "BACKFILL", "", "u")]


CONFIG = (
    "ingestion_config_id int, source_system string, ingestion_pattern string,"
    " load_strategy string, is_active boolean, target_conn_ref string"
)


def test_scope(frame):
    configs = frame(
        CONFIG,
        (1, "SHOP", "DATABASE", "FULL", True, "L"),
        (2, "shop  ", "FILE", "FULL", True, "L"),
        (3, "SHOP", "FILE", "FULL", False, "L"),
        (4, "O'NEIL", "FILE", "FULL", True, "L"),
    )
    ids = lambda df: sorted(r.config_id for r in df.collect())
    assert ids(requests.resolve_scope(configs)) == [1, 2, 4]
    assert ids(requests.resolve_scope(configs, "  ")) == [1, 2, 4]
    assert ids(requests.resolve_scope(configs, " Shop ")) == [1, 2]
    assert ids(requests.resolve_scope(configs, "O'NEIL")) == [4]
    explicit = requests.active_configs(configs, "SHOP")
    with pytest.raises(LoadError) as both:
        requests.resolve_scope(configs, "SHOP", explicit)
    assert both.value.code == "AMBIGUOUS_RUN_SCOPE"
    with pytest.raises(LoadError) as none:
        requests.resolve_scope(configs, "nobody")
    assert none.value.code == "NO_ACTIVE_CONFIGS"
    assert ids(requests.resolve_scope(configs, "", explicit)) == [1, 2]


def test_decision_order(frame):
    configs = frame(
        CONFIG,
        (1, "S", "DATABASE", "INCREMENTAL", True, "L"),
        (2, "S", "FILE", "FULL", True, "L"),
        (3, "S", "DATABASE", "FULL", False, "X"),
        (4, "S", "DATABASE", "FULL", True, "X"),
        (5, "S", "API", "FULL", True, "L"),
        (6, "S", "DATABASE", "FULL", True, "none"),
    )
    connections = frame(
        "connection_ref string, connection_type string", ("L", "Lakehouse"), ("X", "SFTP")
    )
    asked = frame(
        "n int, config_id int, run_type string, lower_bound string, upper_bound string",
        (0, 1, "regular", "", ""),
        (1, 1, "REGULAR", "a", ""),
        (2, 1, "BACKFILL", "a", "b"),
        (3, 1, "BACKFILL", "a", " "),
        (4, 2, "BACKFILL", "", ""),
        (5, 2, "BACKFILL", "a", "b"),
        (6, 3, "BACKFILL", "a", ""),
        (7, 4, "REGULAR", "", None),
        (8, 5, "REGULAR", "", ""),
        (9, 99, "REGULAR", "", ""),
        (10, 6, "REGULAR", "", ""),
        (11, 1, "OTHER", "", ""),
    )
    rows = requests.execution_decision(asked, configs, connections).orderBy("n").collect()
    assert [(r.decision, r.terminal_status) for r in rows] == [
        ("DATABASE", None),
        ("INVALID_REQUEST", "FAILED"),
        ("DATABASE", None),
        ("INVALID_REQUEST", "FAILED"),
        ("FILE", None),
        ("INVALID_REQUEST", "FAILED"),
        ("INACTIVE", "SKIPPED"),
        ("INVALID_TARGET", "FAILED"),
        ("UNSUPPORTED", "FAILED"),
        ("CONFIG_NOT_FOUND", "FAILED"),
        ("INVALID_TARGET", "FAILED"),
        ("INVALID_REQUEST", "FAILED"),
    ]


def test_validation_needs_no_shuffle_and_no_python(frame, plan):
    rows = frame("n int, request_json string", (0, "[]"))
    text = plan(requests.validate_requests(rows))
    assert "Exchange" not in text and "Python" not in text
