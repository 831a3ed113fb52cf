"""The retry policy of the model client, run inside the scorer tasks."""

import json

from pyspark.sql import functions as F

from helpers import rows
from vetline.operators import evaluate
from vetline.plans import jobs

# scripted statuses per message tag; "conn" raises a connection error, "bug" any other error
SCRIPT = {"a": [429, 429, 200], "b": [503, 503, 503, 200], "c": [400, 200], "d": [None, 200],
          "e": ["conn", "conn", "conn"], "f": ["bug"], "g": [200]}
ANSWER = json.dumps({"is_vacancy": True, "match_score": 90, "title": "Role"})


def fake_call():
    tries = {}

    def call(request):
        tag = request.split("<message>\n", 1)[1][0]
        i = tries.get(tag, 0)
        tries[tag] = i + 1
        step = SCRIPT[tag][i]
        if step == "conn":
            raise ConnectionError("refused")
        if step == "bug":
            raise ValueError("client bug")
        return step, (ANSWER if step == 200 else None), {"input_tokens": 10, "output_tokens": 5}
    return call


def _messages(spark):
    text = " is a long enough message text with letters in it, surely"
    data = [(1, i, "chan", tag + text, "live") for i, tag in enumerate(SCRIPT)]
    return spark.createDataFrame(data, "chat_id long, msg_id long, chat_title string, text string, source string")


def test_retrying_scorer_outcomes(spark):
    df = _messages(spark).withColumn("chat_username", F.lit(None).cast("string")) \
        .withColumn("chat_first_name", F.lit(None).cast("string")) \
        .withColumn("msg_date", F.lit(None).cast("timestamp"))
    ev = evaluate.evaluate_with(df, evaluate.retrying_scorer(fake_call(), sleep=lambda s: None))
    got = {r["msg_id"]: (r["call_status"], r["attempts"], r["backoff_s"], r["attempt_statuses"], r["parse_status"])
           for r in rows(ev)}
    assert got == {
        0: ("ok", 3, 3, [429, 429, 200], "ok"),
        1: ("transient", 3, 7, [503, 503, 503], None),
        2: ("crash", 1, 0, [400], None),
        3: ("ok", 2, 1, [None, 200], "ok"),
        4: ("transient", 3, 7, [None, None, None], None),
        5: ("crash", 1, 0, [0], None),
        6: ("ok", 1, 0, [200], "ok"),
    }
    tokens = {r["msg_id"]: r["input_tokens"] for r in rows(ev)}
    assert tokens[0] == 10 and tokens[1] is None


def test_retrying_scorer_routes(spark):
    arrivals = _messages(spark).select("chat_id", "msg_id", F.lit(None).cast("timestamp").alias("msg_date"),
                                       "text", "chat_title", F.lit(None).cast("string").alias("chat_username"),
                                       F.lit(None).cast("string").alias("chat_first_name"), "source")
    seen = spark.createDataFrame([], "chat_id long, msg_id long, is_vacancy int, score int, posted int, "
                                     "title string, ts long")
    routed = jobs.triage_plan(arrivals, seen, jobs.batch_evaluator(
        evaluate.retrying_scorer(fake_call(), sleep=lambda s: None)))
    got = {r["msg_id"]: (r["disposition"], r["recorded"]) for r in rows(routed)}
    assert got == {0: ("posted", True), 1: ("transient", False), 2: ("crash", True), 3: ("posted", True),
                   4: ("transient", False), 5: ("crash", True), 6: ("posted", True)}


def test_scorer_may_leave_out_optional_columns(spark):
    def minimal(batches):
        import pandas as pd
        for pdf in batches:
            yield pd.DataFrame({"chat_id": pdf["chat_id"], "msg_id": pdf["msg_id"],
                                "raw": ['{"is_vacancy": true, "match_score": 75}'] * len(pdf),
                                "http_status": [200] * len(pdf)})

    df = _messages(spark).withColumn("chat_username", F.lit(None).cast("string")) \
        .withColumn("chat_first_name", F.lit(None).cast("string")) \
        .withColumn("msg_date", F.lit(None).cast("timestamp"))
    got = rows(evaluate.evaluate_with(df, minimal))
    assert len(got) == len(SCRIPT)
    assert all(r["call_status"] == "ok" and r["match_score"] == 75 and r["input_tokens"] is None
               and r["error"] is None and r["attempt_statuses"] is None for r in got)


def test_scorer_answering_twice_keeps_one_row(spark):
    def twice(batches):
        import pandas as pd
        for pdf in batches:
            one = pd.DataFrame({"chat_id": pdf["chat_id"], "msg_id": pdf["msg_id"],
                                "raw": ['{"is_vacancy": true, "match_score": 10}'] * len(pdf),
                                "http_status": [200] * len(pdf)})
            two = one.assign(raw=['{"is_vacancy": true, "match_score": 90}'] * len(pdf))
            yield pd.concat([one, two])

    df = _messages(spark).withColumn("chat_username", F.lit(None).cast("string")) \
        .withColumn("chat_first_name", F.lit(None).cast("string")) \
        .withColumn("msg_date", F.lit(None).cast("timestamp"))
    got = rows(evaluate.evaluate_with(df, twice))
    assert len(got) == len(SCRIPT) and {r["match_score"] for r in got} == {90}
