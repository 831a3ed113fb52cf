"""Retry sequences (E2), rule files (E3), and the message stream (S1)."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline.operators import evaluate
from vetline.plans import jobs
from vetline.sources import fixtures as fx
from vetline.sources import messages as msgs
from vetline.streaming import triage_stream as ts
from vetline import schemas


@pytest.mark.parametrize("statuses,want", [
    ([200], ("ok", 1, 0)),
    ([429, 200, 500], ("ok", 2, 1)),
    ([None, 503, 200], ("ok", 3, 3)),
    ([401, 200, 200], ("crash", 1, 0)),
    ([503, 400, 200], ("crash", 2, 1)),
    ([429, 500, None], ("transient", 3, 7)),
])
def test_attempt_outcomes(spark, statuses, want):
    df = spark.createDataFrame([(1, 1, statuses)], "chat_id long, msg_id long, attempt_statuses array<int>")
    r = rows(evaluate.attempt_outcomes(df))[0]
    assert (r["call_status"], r["attempts"], r["backoff_s"]) == want


def test_load_rules_and_scores(spark):
    f = tempfile.NamedTemporaryFile("w", suffix=".json", delete=False)
    json.dump([{"rule_id": 1, "kind": "signal", "pattern": "Go", "weight": 50},
               {"rule_id": 2, "kind": "blocker", "pattern": "(?i)relocation", "weight": 0}], f)
    f.close()
    rules = evaluate.load_rules(f.name)
    df = spark.createDataFrame([(1, "Go dev"), (2, "Go dev, Relocation needed"), (3, "Java")], "doc_id long, text string")
    got = {r["doc_id"]: r["rule_score"] for r in rows(evaluate.rule_scores(df, rules, keys=("doc_id",)))}
    assert got == {1: 80, 2: 29, 3: 30}
    with pytest.raises(ValueError):
        evaluate.Rule(9, "maybe", "x", 1)


def test_message_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="vetline-msgs-")
    m = fx.fx_messages(spark, SF001).select(*[f.name for f in schemas.MESSAGES.fields])
    for i, part in enumerate(m.randomSplit([0.5, 0.5], seed=3)):
        part.write.mode("append").parquet(d)
    seen = fx.fx_seen(spark, SF001)
    out = ts.run_available_now(spark, ts.triage_stream(msgs.read_messages(spark, d, streaming=True), seen), "t_s1")
    streamed = sorted(map(str, rows(spark.read.parquet(out).select("chat_id", "msg_id", "disposition"))))
    batch = jobs.triage_plan(msgs.read_messages(spark, d), seen, jobs.rules_evaluator())
    batch = batch.filter("disposition <> 'dedup_skip'").select("chat_id", "msg_id", "disposition")
    # the stream keeps the first arrival of a key; dispositions do not depend on which
    assert streamed == sorted(map(str, rows(batch)))


def test_message_stream_with_batch_scorer_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="vetline-msgs-scorer-")
    m = fx.fx_messages(spark, SF001).select(*[f.name for f in schemas.MESSAGES.fields])
    for part in m.randomSplit([0.5, 0.5], seed=5):
        part.write.mode("append").parquet(d)
    seen = fx.fx_seen(spark, SF001)
    scorer = jobs.batch_evaluator(fx.fx_scorer)
    plan = ts.triage_stream(msgs.read_messages(spark, d, streaming=True), seen, evaluator=scorer)
    out = ts.run_available_now(spark, plan, "t_s2")
    streamed = sorted(map(str, rows(spark.read.parquet(out).select("chat_id", "msg_id", "disposition", "score"))))
    batch = jobs.triage_plan(msgs.read_messages(spark, d), seen, scorer)
    batch = batch.filter("disposition <> 'dedup_skip'").select("chat_id", "msg_id", "disposition",
                                                               F.col("out_score").alias("score"))
    assert streamed == sorted(map(str, rows(batch)))
    assert {r["disposition"] for r in rows(spark.read.parquet(out))} >= {"transient", "crash", "parse_error"}


def test_stream_with_pruned_seen_equals_full_seen(spark):
    from vetline.sources.tables import read_seen
    d = tempfile.mkdtemp(prefix="vetline-msgs-pruned-")
    m = fx.fx_messages(spark, SF001).select(*[f.name for f in schemas.MESSAGES.fields])
    m.write.parquet(d + "/in")
    seen_path = d + "/seen"
    # half of the messages were recorded by an earlier run (after they were posted)
    half = msgs.read_messages(spark, d + "/in").filter(F.col("msg_id") % 2 == 0)
    jobs.run_triage(spark, half, seen_path, d + "/matches", run_ts=1735689600, first_run=True)
    since = jobs.seen_horizon(msgs.read_messages(spark, d + "/in"))
    outs = []
    for name, seen in (("full", read_seen(spark, seen_path)), ("pruned", read_seen(spark, seen_path, since))):
        plan = ts.triage_stream(msgs.read_messages(spark, d + "/in", streaming=True), seen)
        out = ts.run_available_now(spark, plan, "t_prune_" + name)
        outs.append(sorted(map(str, rows(spark.read.parquet(out).select("chat_id", "msg_id", "disposition")))))
    assert outs[0] == outs[1] and len(outs[0]) > 0
