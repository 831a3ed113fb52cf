"""The triage job end to end: sinks, re-runs, compaction, cheap-before-costly."""

import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline.operators import dedup, evaluate
from vetline.plans import jobs
from vetline.sources import fixtures as fx
from vetline.sources import messages as msgs
from vetline.sources.tables import read_matches, read_seen, read_seen_log


def _paths():
    d = tempfile.mkdtemp(prefix="vetline-job-")
    return f"{d}/seen", f"{d}/matches", f"{d}/channels_out"


def test_rules_job_twice_finds_nothing_new(spark):
    seen, matches, ch_out = _paths()
    arrivals = fx.fx_messages(spark, SF001)
    r1 = jobs.run_triage(spark, arrivals, seen, matches, run_ts=100, first_run=True)
    d1 = {r["disposition"]: r["count"] for r in rows(spark.read.parquet(r1.routed_path).groupBy("disposition").count())}
    assert sum(d1.values()) == 200 and "dedup_skip" not in d1
    assert spark.read.parquet(seen).count() == 200
    assert spark.read.parquet(matches).count() == d1.get("posted", 0)
    r2 = jobs.run_triage(spark, arrivals, seen, matches, run_ts=200, first_run=True)
    d2 = {r["disposition"]: r["count"] for r in rows(spark.read.parquet(r2.routed_path).groupBy("disposition").count())}
    assert d2 == {"dedup_skip": 200}
    assert spark.read.parquet(seen).count() == 200


def test_batch_scorer_job_retries_only_transient(spark):
    seen, matches, ch_out = _paths()
    arrivals = fx.fx_messages(spark, SF001)
    ev = jobs.batch_evaluator(fx.fx_scorer)
    r1 = spark.read.parquet(jobs.run_triage(spark, arrivals, seen, matches, evaluator=ev, run_ts=1, first_run=True).routed_path)
    transient = r1.filter("disposition = 'transient'").count()
    assert transient > 0
    # the scorer was never asked about junk rows
    assert r1.filter("disposition = 'too_short'").filter(F.col("http_status").isNotNull()).count() == 0
    r2 = spark.read.parquet(jobs.run_triage(spark, arrivals, seen, matches, evaluator=ev, run_ts=2, first_run=True).routed_path)
    got = {r["disposition"]: r["count"] for r in rows(r2.groupBy("disposition").count())}
    assert got == {"transient": transient, "dedup_skip": 200 - transient}
    assert r2.filter("disposition = 'dedup_skip'").filter(F.col("http_status").isNotNull()).count() == 0
    out = tempfile.mkdtemp(prefix="vetline-compact-") + "/seen"
    c = spark.read.parquet(jobs.compact_seen(spark, seen, out))
    assert c.count() == 200 - transient
    assert c.select("chat_id", "msg_id").distinct().count() == c.count()
    assert "dt" in c.columns
    # the compacted table keeps the log's layout: the next run appends to it
    r3 = spark.read.parquet(jobs.run_triage(spark, arrivals, out, matches, evaluator=ev, run_ts=3, first_run=True).routed_path)
    got = {r["disposition"]: r["count"] for r in rows(r3.groupBy("disposition").count())}
    assert got == {"transient": transient, "dedup_skip": 200 - transient}
    assert spark.read.parquet(out).count() == 200 - transient


def test_channel_snapshot_touched(spark):
    seen, matches, ch_out = _paths()
    ch_in = tempfile.mkdtemp(prefix="vetline-ch-") + "/channels"
    fx.fx_directory(spark, SF001).select("chat_id", F.col("handle").alias("username"), F.col("handle").alias("title"),
                                         F.lit(None).cast("bigint").alias("last_msg_ts")).write.parquet(ch_in)
    jobs.run_triage(spark, fx.fx_messages(spark, SF001), seen, matches, run_ts=77, first_run=True,
                    channels_path=ch_in, channels_out=ch_out)
    got = rows(spark.read.parquet(ch_out))
    assert len(got) == 20 and all(r["last_msg_ts"] == 77 for r in got)


def test_scorer_called_once_per_evaluated_message(spark):
    seen, matches, _ = _paths()
    calls = spark.sparkContext.accumulator(0)

    def counting(batches):
        for pdf in batches:
            calls.add(len(pdf))
            yield from fx.fx_scorer(iter([pdf]))

    res = jobs.run_triage(spark, fx.fx_messages(spark, SF001), seen, matches,
                          evaluator=jobs.batch_evaluator(counting), run_ts=5, first_run=True)
    routed = spark.read.parquet(res.routed_path)
    evaluated = routed.filter(~F.col("disposition").isin("too_short", "dedup_skip")).count()
    assert calls.value == evaluated


def test_job_keeps_only_allowlisted_chats(spark):
    seen, matches, _ = _paths()
    allowed = spark.createDataFrame([(0,), (4,)], "chat_id long")
    res = jobs.run_triage(spark, fx.fx_messages(spark, SF001), seen, matches, run_ts=1, first_run=True, allowed=allowed)
    chats = {r["chat_id"] for r in rows(spark.read.parquet(res.routed_path).select("chat_id").distinct())}
    assert chats == {0, 4}


def test_transient_messages_retried_from_the_retry_table(spark):
    seen, matches, _ = _paths()
    d = tempfile.mkdtemp(prefix="vetline-retry-")
    arrivals = fx.fx_messages(spark, SF001)
    r1 = jobs.run_triage(spark, arrivals, seen, matches, evaluator=jobs.batch_evaluator(fx.fx_scorer),
                         run_ts=1, first_run=True, retry_out=f"{d}/r1")
    routed1 = spark.read.parquet(r1.routed_path)
    transient = {(r["chat_id"], r["msg_id"]) for r in rows(routed1.filter("disposition = 'transient'"))}
    assert transient
    pending = spark.read.parquet(r1.retry_path)
    assert {(r["chat_id"], r["msg_id"]) for r in rows(pending)} == transient

    def always_ok(batches):
        import json

        import pandas as pd
        for pdf in batches:
            yield pd.DataFrame({"chat_id": pdf["chat_id"], "msg_id": pdf["msg_id"],
                                "raw": [json.dumps({"is_vacancy": False, "match_score": 0})] * len(pdf),
                                "http_status": [200] * len(pdf)})

    nothing_new = arrivals.limit(0)
    r2 = jobs.run_triage(spark, nothing_new, seen, matches, evaluator=jobs.batch_evaluator(always_ok), run_ts=2, first_run=True,
                         retry_in=r1.retry_path, retry_out=f"{d}/r2")
    got = {(r["chat_id"], r["msg_id"]): r["disposition"] for r in rows(spark.read.parquet(r2.routed_path))}
    assert set(got) == transient and set(got.values()) == {"not_vacancy"}
    assert spark.read.parquet(r2.retry_path).count() == 0
    # every message is recorded exactly once after both runs
    s = spark.read.parquet(seen)
    assert s.count() == s.select("chat_id", "msg_id").distinct().count() == 200


def test_first_run_registers_channels(spark):
    seen, matches, ch_out = _paths()
    regs = fx.fx_directory(spark, SF001).select("chat_id", F.col("handle").alias("username"),
                                                F.col("handle").alias("title"))
    jobs.run_triage(spark, fx.fx_messages(spark, SF001), seen, matches, run_ts=77, first_run=True,
                    channels_out=ch_out, registrations=regs)
    got = {r["chat_id"]: r for r in rows(spark.read.parquet(ch_out))}
    assert len(got) == 20 and all(r["last_msg_ts"] == 77 for r in got.values())
    # a later run re-registers one chat with a new title: the title changes,
    # the activity time stays (nothing new is recorded in that run)
    one = next(iter(got))
    ch_out2 = ch_out + "2"
    jobs.run_triage(spark, fx.fx_messages(spark, SF001), seen, matches, run_ts=99, first_run=True, channels_path=ch_out,
                    channels_out=ch_out2, registrations=spark.createDataFrame(
                        [(one, "renamed", "New title")], "chat_id long, username string, title string"))
    got2 = {r["chat_id"]: r for r in rows(spark.read.parquet(ch_out2))}
    assert got2[one]["title"] == "New title" and got2[one]["last_msg_ts"] == 77
    assert len(got2) == 20


def test_seen_check_pruned_to_recent_days(spark):
    seen, matches, _ = _paths()
    arrivals = fx.fx_messages(spark, SF001)
    run1 = 1735689600                      # 2025-01-01, after every message date
    jobs.run_triage(spark, arrivals, seen, matches, run_ts=run1, first_run=True)
    since = jobs.seen_horizon(arrivals)
    assert since is not None and since < run1
    r2 = jobs.run_triage(spark, arrivals, seen, matches, run_ts=run1 + 86400, first_run=True, seen_since=since)
    got = {r["disposition"]: r["count"] for r in rows(spark.read.parquet(r2.routed_path).groupBy("disposition").count())}
    assert got == {"dedup_skip": 200}
    # the seen check lists only the days since the horizon
    plan = jobs.triage_plan(arrivals, read_seen_log(spark, seen, since), jobs.rules_evaluator())
    p = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in p
    # a message without a date forces the full check
    undated = arrivals.limit(3).withColumn("msg_date", F.lit(None).cast("timestamp"))
    assert jobs.seen_horizon(arrivals.unionByName(undated)) is None


def test_replayed_run_gives_one_card_per_message(spark):
    seen, matches, _ = _paths()
    arrivals = fx.fx_messages(spark, SF001)
    jobs.run_triage(spark, arrivals, seen, matches, run_ts=1735689600, first_run=True)
    # a replay (the outcome append of the first run lost): the same cards again
    jobs.run_triage(spark, arrivals, seen + "_lost", matches, run_ts=1735689700, first_run=True)
    raw = spark.read.parquet(matches)
    keys = raw.select("chat_id", "msg_id").distinct().count()
    assert keys > 0 and raw.count() == 2 * keys
    cards = read_matches(spark, matches)
    assert cards.count() == keys
    assert {r["ts"] for r in rows(cards)} == {1735689700}
    assert read_matches(spark, matches, since_epoch=1735689650).count() == keys


def test_scorer_concurrency_gives_the_same_result(spark):
    arrivals = fx.fx_messages(spark, SF001)
    seen = spark.createDataFrame([], "chat_id long, msg_id long, is_vacancy int, score int, posted int, "
                                     "title string, ts long")
    base = jobs.triage_plan(arrivals, seen, jobs.batch_evaluator(fx.fx_scorer))
    limited = jobs.triage_plan(arrivals, seen, jobs.batch_evaluator(fx.fx_scorer, concurrency=3))
    pick = ["chat_id", "msg_id", "disposition", "out_score"]
    assert sorted(map(str, rows(limited.select(*pick)))) == sorted(map(str, rows(base.select(*pick))))
    assert limited.count() == arrivals.select("chat_id", "msg_id").distinct().count()


def _state(spark, seen, matches, channels):
    return [sorted(map(str, rows(df))) for df in (read_seen(spark, seen), read_matches(spark, matches), spark.read.parquet(channels))]


@pytest.mark.parametrize("sink", ["matches", "channels_out", "retry", "seen"])
def test_a_failed_sink_is_made_up_by_the_next_run(spark, sink, monkeypatch):
    """Whatever write fails, running again gives the tables of a run that did not fail."""
    from pyspark.sql.readwriter import DataFrameWriter
    arrivals = fx.fx_messages(spark, SF001)
    chans = fx.fx_directory(spark, SF001).select("chat_id", F.col("handle").alias("username"), F.col("handle").alias("title"))
    ok, broken = (tempfile.mkdtemp(prefix="vetline-sinks-") for _ in "ab")

    def run(d):
        jobs.run_triage(spark, arrivals, f"{d}/seen", f"{d}/matches", evaluator=jobs.batch_evaluator(fx.fx_scorer), run_ts=1735689600,
                        first_run=True, channels_out=f"{d}/channels_out", registrations=chans, retry_out=f"{d}/retry")
    run(ok)
    real = DataFrameWriter.parquet

    def failing(self, path, *a, **k):
        if path.startswith(broken) and path.endswith(sink):
            raise OSError("disk full")
        return real(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        run(broken)
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    run(broken)
    assert _state(spark, f"{ok}/seen", f"{ok}/matches", f"{ok}/channels_out") == _state(
        spark, f"{broken}/seen", f"{broken}/matches", f"{broken}/channels_out")
    assert spark.read.parquet(f"{ok}/retry").count() == spark.read.parquet(f"{broken}/retry").count() > 0


def test_missing_outcome_table_is_an_error_after_the_first_run(spark):
    with pytest.raises(FileNotFoundError):
        jobs.run_triage(spark, fx.fx_messages(spark, SF001), "/tmp/no/such/table", "/tmp/no/such/matches", run_ts=1)


def test_scorer_is_started_once_per_partition(spark):
    calls = spark.sparkContext.accumulator(0)
    batches = spark.sparkContext.accumulator(0)

    def scorer(frames):
        calls.add(1)
        for pdf in frames:
            batches.add(1)
            yield from fx.fx_scorer(iter([pdf]))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        df = evaluate.evaluate_with(dedup.first_arrivals(msgs.normalize(fx.fx_messages(spark, SF001))).coalesce(1), scorer)
        got = rows(df.select("chat_id", "msg_id", "call_status"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert calls.value == 1 and batches.value > 20 and len(got) == 200
    assert {r["call_status"] for r in got} == {"ok", "transient", "crash"}


def test_scorer_that_reads_ahead_and_leaves_out_answers(spark):
    import pandas as pd

    def scorer(frames):
        every = list(frames)            # reads all, answers backwards, not for every message
        for pdf in reversed(every):
            some = pdf[pdf["msg_id"] % 3 != 0]
            yield pd.DataFrame({"chat_id": some["chat_id"], "msg_id": some["msg_id"], "raw": ["{}"] * len(some), "http_status": [200] * len(some)})
    df = evaluate.evaluate_with(dedup.first_arrivals(msgs.normalize(fx.fx_messages(spark, SF001))).coalesce(2), scorer)
    got = {r["msg_id"]: r["call_status"] for r in rows(df.select("msg_id", "call_status"))}
    assert len(got) == 200 and all((s == "ok") == (i % 3 != 0) for i, s in got.items())


def test_overlapping_calls_give_the_same_answers():
    import threading
    import time

    import pandas as pd
    busy, most, lock = [0], [0], threading.Lock()

    def call(request):
        with lock:
            busy[0] += 1
            most[0] = max(most[0], busy[0])
        time.sleep(0.01)
        with lock:
            busy[0] -= 1
        return (503 if request == "r3" else 200), request, None
    pdf = pd.DataFrame({"chat_id": range(12), "msg_id": range(12), "request": [f"r{i}" for i in range(12)]})
    one, four = (next(iter(evaluate.retrying_scorer(call, sleep=lambda s: None, parallel=n)(iter([pdf])))) for n in (1, 4))
    assert one.equals(four) and 1 < most[0] <= 4
