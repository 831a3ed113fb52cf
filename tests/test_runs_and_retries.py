"""Run numbers, drains without a clock, the retry ledger, backfill marks."""

import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline import schemas
from vetline.operators import dedup, evaluate
from vetline.plans import jobs
from vetline.sources import fixtures as fx
from vetline.sources import messages as msgs
from vetline.sources.tables import claim_run, read_dead, read_seen, read_seen_log
from vetline.streaming import triage_stream as ts


def conversations(spark):
    return spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")


def drain(spark, d, first=False, **kw):
    return ts.drain_to_tables(spark, ts.conversation_stream(spark, f"{d}/in", 2), f"{d}/q", f"{d}/seen", f"{d}/matches", first_run=first, **kw)


def test_run_numbers_follow_each_other(spark):
    d = tempfile.mkdtemp(prefix="vetline-runs-")
    assert [claim_run(spark, f"{d}/seen") for _ in range(3)] == [1, 2, 3]
    # a log from before there were claims, its runs numbered by a clock
    old = spark.createDataFrame([(1, 1, 1, 1, 0, "t", 5, 10**18)], schemas.SEEN_LOG)
    old.write.parquet(f"{d}/old")
    assert claim_run(spark, f"{d}/old") == 10**18 + 1


def test_a_clock_that_steps_back_loses_nothing(spark, monkeypatch):
    """Each drain sees an earlier clock than the one before; every message is handled once all the same."""
    import time
    d = tempfile.mkdtemp(prefix="vetline-clock-")
    conv = conversations(spark)
    clock = iter([2e9, 1.5e9, 1e9, 5e8])
    monkeypatch.setattr(time, "time", lambda: next(clock))
    parts = conv.randomSplit([0.4, 0.3, 0.3], seed=5)
    for k, part in enumerate(parts):
        part.write.mode("append").parquet(f"{d}/in")
        assert drain(spark, d, first=k == 0) == k
    assert drain(spark, d) is None
    seen = read_seen_log(spark, f"{d}/seen")
    assert seen.count() == conv.count() == seen.select(*schemas.SEEN_KEY).distinct().count()
    assert {r["run"]: r["ts"] for r in rows(seen.select("run", "ts").distinct())} == {1: 2 * 10**9, 2: 15 * 10**8, 3: 10**9}


def test_the_later_run_wins_whatever_its_clock(spark):
    d = tempfile.mkdtemp(prefix="vetline-late-")
    m = fx.fx_messages(spark, SF001).filter("msg_id = 1").limit(1)

    def scorer(score):
        return lambda df, mask: evaluate.evaluate_with_rules(df, mask=mask).withColumn("match_score", F.lit(score))
    jobs.run_triage(spark, m, f"{d}/seen", f"{d}/matches", scorer(11), run_ts=2000, first_run=True)
    # done again by a driver whose clock is behind, with nothing in its seen check
    jobs.run_triage(spark, m, f"{d}/seen", f"{d}/matches", scorer(22), run_ts=1000, seen_since=10**9)
    got = rows(read_seen(spark, f"{d}/seen"))
    assert len(got) == 1 and got[0]["ts"] == 1000 and read_seen_log(spark, f"{d}/seen").count() == 2


@pytest.mark.parametrize("fails_at", ["dispositions/run=0", "seen", "progress"])
def test_a_drain_done_again_keeps_what_was_decided(spark, monkeypatch, fails_at):
    """Before the commit it is done again, with what has come in since; after it, only ended."""
    from pyspark.sql.readwriter import DataFrameWriter
    d = tempfile.mkdtemp(prefix="vetline-redo-")
    first, second = conversations(spark).randomSplit([0.6, 0.4], seed=2)
    first.write.parquet(f"{d}/in")
    real, calls = DataFrameWriter.parquet, {"n": 0}

    def failing(self, path, *a, **k):
        calls["n"] += path.endswith(fails_at)
        if path.endswith(fails_at) and (fails_at != "progress" or calls["n"] == 2):
            raise OSError("disk full")
        return real(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        drain(spark, d, first=True)
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    second.write.mode("append").parquet(f"{d}/in")
    while drain(spark, d, first=True) is not None:
        pass
    told = ts.read_dispositions(spark, f"{d}/q")
    assert told.filter("disposition = 'dedup_skip'").count() == 0
    n = first.count() + second.count()
    if fails_at == "progress":      # what came in after the commit belongs to the drain that ended without it
        n -= second.count()
    assert told.count() == told.select(*schemas.SEEN_KEY).distinct().count() == n
    assert read_seen_log(spark, f"{d}/seen").count() == n


def test_live_handling_drains_until_it_is_stopped():
    now, waits = [0.0], []
    found = iter([1, None, 2, None])

    def one():
        now[0] += 4
        return next(found)
    assert ts.keep_draining(one, 10, stop=lambda: len(waits) == 3, clock=lambda: now[0], wait=waits.append) == 2
    assert waits == [6, 6, 6]


def ledger_run(spark, d, k, arrivals, down, run_ts, **kw):
    def ev(df, mask):
        e = evaluate.evaluate_with_rules(df, mask=mask)
        return e.withColumn("call_status", F.when(F.col("msg_id").isin(*down), F.when(mask, F.lit("transient"))).otherwise(F.col("call_status")))
    return jobs.run_triage(spark, arrivals, f"{d}/seen", f"{d}/matches", ev, run_ts=run_ts, first_run=not k, retry_in=f"{d}/retry/{k - 1}" if k else None,
                           retry_out=f"{d}/retry/{k}", dead_out=f"{d}/dead", **kw)


def test_tries_waits_and_dead_letters(spark):
    d = tempfile.mkdtemp(prefix="vetline-ledger-")
    m = dedup.first_arrivals(fx.fx_messages(spark, SF001)).filter("msg_id < 20").filter(F.length(F.trim("text")) >= 40)
    ids = sorted(r["msg_id"] for r in rows(m))
    a, b, c = ids[:3]
    none = m.limit(0)
    kw = dict(max_tries=3, retry_wait_s=100)

    def ledger(k):
        return {r["msg_id"]: (r["tries"], r["due"]) for r in rows(spark.read.schema(schemas.RETRY).parquet(f"{d}/retry/{k}"))}
    ledger_run(spark, d, 0, m.union(m), [a, b, c], 1000, **kw)       # two copies of each
    assert ledger(0) == {x: (1, 1100) for x in (a, b, c)}
    ledger_run(spark, d, 1, none, [a, b, c], 1050, **kw)             # not due yet
    assert ledger(1) == ledger(0)
    ledger_run(spark, d, 2, m.filter(F.col("msg_id") == c), [a, b], 1060, **kw)      # one arrives again and is decided
    assert ledger(2) == {x: (1, 1100) for x in (a, b)}
    ledger_run(spark, d, 3, none, [a, b], 1100, **kw)
    assert ledger(3) == {x: (2, 1300) for x in (a, b)}
    ledger_run(spark, d, 4, none, [a], 1400, **kw)                   # one is decided, one given up
    assert ledger(4) == {}
    assert [(r["msg_id"], r["tries"], r["run"]) for r in rows(read_dead(spark, f"{d}/dead"))] == [(a, 3, 5)]
    assert {r["msg_id"] for r in rows(read_seen(spark, f"{d}/seen"))} == set(ids) - {a}
    ledger_run(spark, d, 5, m.filter(F.col("msg_id") == a), [a], 1500, **kw)         # it arrives again: starts anew
    assert ledger(5) == {a: (1, 1600)}
    with pytest.raises(ValueError):
        jobs.run_triage(spark, none, f"{d}/seen", f"{d}/matches", run_ts=1, max_tries=2)


def test_waits_double_up_to_a_day(spark):
    m = fx.fx_messages(spark, SF001).filter("msg_id = 1").limit(1).select(*[f.name for f in schemas.MESSAGES.fields])
    routed = m.select(*schemas.SEEN_KEY, F.lit("transient").alias("disposition"))
    for tries, wait in ((0, 60), (1, 120), (5, 1920), (20, 86400), (4000, 86400)):
        pending = m.select("*", F.lit(tries).alias("tries"), F.lit(0).cast("bigint").alias("due"))
        got = rows(jobs.retry_ledger(m, routed, 5, 60, pending))
        assert [(r["tries"], r["due"]) for r in got] == [(tries + 1, 5 + wait)]


# ---- backfill marks ----------------------------------------------------------------
def test_a_second_backfill_reads_only_what_is_newer(spark):
    """With marks it decides the same as one that reads everything again, from fewer rows."""
    d = tempfile.mkdtemp(prefix="vetline-marks-")
    m = dedup.first_arrivals(fx.fx_messages(spark, SF001)).drop("source")
    directory, sources = fx.fx_directory(spark, SF001), fx.fx_directory(spark, SF001).select(
        F.lit("id").alias("kind"), F.lit(None).cast("string").alias("username"), "chat_id", F.monotonically_increasing_id().alias("pos"))

    def down(df, mask):
        e = evaluate.evaluate_with_rules(df, mask=mask)
        return e.withColumn("call_status", F.when(F.col("msg_id") % 13 == 4, F.when(mask, F.lit("transient"))).otherwise(F.col("call_status")))

    def run(name, k, upto, evaluator, marks):
        kw = dict(marks_in=f"{d}/{name}-marks{k - 1}", marks_out=f"{d}/{name}-marks{k}") if marks else {}
        history = m.filter(F.col("msg_id") < upto)
        return jobs.run_backfill(spark, sources, directory, history, fx.BASE_EPOCH, f"{d}/{name}/seen", f"{d}/{name}/matches", cap=7,
                                 evaluator=evaluator, run_ts=100 + k, first_run=not k, **kw)
    values = ["chat_id", "msg_id", "is_vacancy", "score", "posted", "title", "ts"]
    read = {}
    for name, marks in (("whole", False), ("marked", True)):
        run(name, 0, 120, down, marks)
        last = run(name, 1, 160, None, marks)
        last = run(name, 2, 10**9, None, marks)
        read[name] = spark.read.parquet(last.routed_path).count()
    got = [sorted(map(str, rows(read_seen(spark, f"{d}/{n}/seen").select(*values)))) for n in ("whole", "marked")]
    assert got[0] == got[1]
    assert 0 < read["marked"] < read["whole"]
    # an earlier cutoff goes deeper: marks made at a later one do not count
    marks = spark.read.schema(schemas.MARKS).parquet(f"{d}/marked-marks2")
    deep = msgs.backfill(m, fx.BASE_EPOCH - 10**8, 10**6, marks=marks)
    assert deep.count() == m.count()


def test_marks_stay_below_what_is_transient(spark):
    taken = spark.createDataFrame([(1, 5), (1, 9), (2, 4), (3, 8)], "chat_id long, msg_id long")
    routed = spark.createDataFrame([(1, 5, "transient"), (1, 9, "posted"), (2, 4, "posted")], "chat_id long, msg_id long, disposition string")
    before = spark.createDataFrame([(3, 7, 10), (4, 6, 10), (5, 6, 99)], schemas.MARKS)
    assert {(r["chat_id"], r["msg_id"], r["cutoff"]) for r in rows(msgs.next_marks(taken, routed, 50, before))} == {
        (1, 4, 50), (2, 4, 50), (3, 8, 50), (4, 6, 50)}
