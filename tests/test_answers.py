"""Literal truth tables for parsing untrusted JSON answers (Python semantics)."""

import pytest

from helpers import rows
from vetline.functions.answers import parse_answers

CASES = [
    # raw, status, is_vacancy, score, stack
    ('{"is_vacancy": true, "match_score": 85}', "ok", True, 85, []),
    ('{"is_vacancy": true, "match_score": -5}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": 120}', "ok", True, 100, []),
    ('{"is_vacancy": true, "match_score": 99999999999}', "ok", True, 100, []),
    ('{"is_vacancy": true, "match_score": 85.7}', "ok", True, 85, []),
    ('{"is_vacancy": true, "match_score": -0.9}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": "85"}', "ok", True, 85, []),
    ('{"is_vacancy": true, "match_score": " 85 "}', "ok", True, 85, []),
    ('{"is_vacancy": true, "match_score": "+85"}', "ok", True, 85, []),
    ('{"is_vacancy": true, "match_score": "85.7"}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": "abc"}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": ""}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": null}', "ok", True, 0, []),
    ('{"is_vacancy": true}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": [1]}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": {"a": 1}}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": true}', "ok", True, 1, []),
    ('{"is_vacancy": true, "match_score": false}', "ok", True, 0, []),
    ('{"is_vacancy": true, "match_score": 1e400}', "crash", None, None, None),
    ('{"is_vacancy": "false", "match_score": 80}', "ok", True, 80, []),      # non-empty string is truthy
    ('{"is_vacancy": 0, "match_score": 80}', "ok", False, 80, []),
    ('{"is_vacancy": [], "match_score": 80}', "ok", False, 80, []),
    ('{"is_vacancy": {}, "match_score": 80}', "ok", False, 80, []),
    ('{"is_vacancy": [0], "match_score": 80}', "ok", True, 80, []),
    ('{"is_vacancy": false, "is_vacancy": true, "match_score": 7}', "ok", True, 7, []),  # last key wins
    ('', "parse_error", False, 0, []),
    (None, "ok", False, 0, []),                         # no content -> {} -> defaults
    ('null', "crash", None, None, None),
    ('"x"', "crash", None, None, None),
    ('[{"match_score": 5}]', "crash", None, None, None),
    ('{}{}', "parse_error", False, 0, []),
    ('{},{}', "parse_error", False, 0, []),
    ('{"a": 1} thanks', "parse_error", False, 0, []),
    ('{"a": 1}] junk [', "parse_error", False, 0, []),
    ('```json\n{"is_vacancy": true}\n```', "parse_error", False, 0, []),
    ('  {"is_vacancy": true, "match_score": 90}\n ', "ok", True, 90, []),
    ('{"is_vacancy": true, "stack": ["Go", null, "", "Kafka", 0, 3, true]}', "ok", True, 0, ["Go", "Kafka", "3", "True"]),
    ('{"is_vacancy": true, "stack": "Go"}', "ok", True, 0, ["G", "o"]),
    ('{"is_vacancy": true, "stack": 5}', "crash", None, None, None),
    ('{"is_vacancy": true, "stack": 0}', "ok", True, 0, []),
    ('{"is_vacancy": true, "stack": {"b": 1, "a": 2}}', "ok", True, 0, ["a", "b"]),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, r) for i, (r, *_) in enumerate(CASES)], "msg_id long, raw string")
    return {r["msg_id"]: r for r in rows(parse_answers(df))}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_answer_case(parsed, i):
    raw, status, vac, score, stack = CASES[i]
    r = parsed[i]
    assert r["parse_status"] == status, raw
    assert r["is_vacancy"] == vac, raw
    assert r["match_score"] == score, raw
    assert r["stack"] == stack, raw


def test_defaults_and_stub(spark):
    df = spark.createDataFrame([(1, '{"is_vacancy": true, "title": 5, "grade": "", "reasoning": "  ok \\n",'
                                    ' "red_flags": ["x", ""], "should_apply": 1}'), (2, "not json")],
                               "msg_id long, raw string")
    got = {r["msg_id"]: r for r in rows(parse_answers(df))}
    a = got[1]
    assert (a["title"], a["company"], a["grade"], a["salary"], a["remote"]) == ("5", "", "unknown", "", "unknown")
    assert a["reasoning"] == "ok" and a["red_flags"] == ["x"] and a["should_apply"] is True
    b = got[2]
    assert b["parse_status"] == "parse_error" and b["reasoning"] == "parse_error"
    assert (b["is_vacancy"], b["match_score"], b["grade"], b["remote"]) == (False, 0, "unknown", "unknown")


def test_filter_after_parse_is_not_pushed_into_parse(spark):
    df = spark.createDataFrame([(1, '{"is_vacancy": true}')], "msg_id long, raw string")
    plan = parse_answers(df).filter("parse_status = 'ok'")._jdf.queryExecution().optimizedPlan().toString()
    # the filter stays above the generator that emits the parsed fields
    assert plan.index("Filter") < plan.index("Generate")
