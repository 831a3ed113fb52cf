"""Streaming equals batch; allow-list loading and resolution."""

import json
import os
import tempfile

import pytest

from helpers import SF001, rows
from vetline.sources import allowlist
from vetline.streaming import triage_stream as ts


def test_stream_equals_batch_over_split_files(spark):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    d = tempfile.mkdtemp(prefix="vetline-stream-in-")
    # several files; the first rows arrive again in a later file
    for i, part in enumerate(conv.randomSplit([0.3, 0.3, 0.4], seed=7)):
        part.write.mode("overwrite").parquet(f"{d}/f{i}")
    dup_keys = conv.orderBy("conv_id", "turn").limit(20)
    dup_keys.write.mode("overwrite").parquet(f"{d}/f9")
    files = []
    for i in (0, 1, 2, 9):
        files += [os.path.join(f"{d}/f{i}", f) for f in os.listdir(f"{d}/f{i}") if f.endswith(".parquet")]
    flat = tempfile.mkdtemp(prefix="vetline-stream-flat-")
    for k, f in enumerate(sorted(files, key=lambda p: ("f9" in p, p))):
        os.link(f, f"{flat}/part-{k:04d}.parquet")
    src = ts.as_messages(spark.readStream.schema(ts.CONVERSATION_SCHEMA).option("maxFilesPerTrigger", 2).parquet(flat))
    seen = ts.first_turns_seen(spark, SF001)
    out = ts.run_available_now(spark, ts.triage_stream(src, seen), "test_stream")
    streamed = sorted(map(str, rows(spark.read.parquet(out).select(*ts.OUTPUT_COLS))))
    batch = ts.triage_stream(ts.as_messages(conv), seen).select(*ts.OUTPUT_COLS)
    assert streamed == sorted(map(str, rows(batch)))
    assert len(streamed) == conv.count() - seen.count()
    # the run kept its dedup state in RocksDB; the session setting is back
    ckpt = out[: -len("/data")].removeprefix("file:") + "/_checkpoint/offsets"
    first = sorted(os.listdir(ckpt), key=lambda f: int(f) if f.isdigit() else -1)[-1]
    assert "RocksDBStateStoreProvider" in open(os.path.join(ckpt, first)).read()
    assert "RocksDB" not in (spark.conf.get(ts.STATE_STORE_KEY, None) or "")


def _write(obj):
    f = tempfile.NamedTemporaryFile("w", suffix=".json", delete=False)
    json.dump(obj, f)
    f.close()
    return f.name


def test_load_sources(spark):
    p = _write({"chats": ["@src0", " @src1 ", "@missing", -1001000000002, 4, True]})
    got = rows(allowlist.load_sources(spark, p).orderBy("pos"))
    assert [(r["kind"], r["username"], r["chat_id"]) for r in got] == [
        ("handle", "@src0", None), ("handle", "@src1", None), ("handle", "@missing", None),
        ("id", None, -1001000000002), ("id", None, 4), ("id", None, 1)]


@pytest.mark.parametrize("bad", [{"chats": []}, {"other": [1]}, {"chats": [" "]}, {"chats": [1.5]}])
def test_load_sources_errors(spark, bad):
    with pytest.raises(Exception):
        allowlist.load_sources(spark, _write(bad)).collect()


def test_resolve(spark):
    srcs = allowlist.load_sources(spark, _write({"chats": ["@SRC0", "src5", "@nope", 4]}))
    directory = spark.createDataFrame([(0, "src0"), (4, "src4"), (-1001000000005, "src5")], "chat_id long, handle string")
    res, unres = allowlist.resolve(srcs, directory)
    assert sorted(r["chat_id"] for r in rows(res)) == [-1001000000005, 0, 4]
    assert [r["username"] for r in rows(unres)] == ["@nope"]
    m = spark.createDataFrame([(0, 1), (7, 2)], "chat_id long, msg_id long")
    assert [r["chat_id"] for r in rows(allowlist.allowlisted(m, res))] == [0]


def test_messages_from_records(spark):
    import datetime

    from vetline.sources import messages as msgs
    recs = [
        (b"k1", json.dumps({"chat_id": -1001, "msg_id": 5, "text": "hello",
                            "msg_date": "2024-01-02T03:04:05Z"}).encode(), datetime.datetime(2024, 5, 1)),
        (b"k2", json.dumps({"chat_id": 7, "msg_id": 6, "text": "x", "source": "backfill"}).encode(),
         datetime.datetime(2024, 5, 2)),
        (b"k3", b"not json", datetime.datetime(2024, 5, 3)),
        (b"k4", json.dumps({"text": "no key"}).encode(), datetime.datetime(2024, 5, 3)),
    ]
    df = spark.createDataFrame(recs, "key binary, value binary, timestamp timestamp")
    got = {r["msg_id"]: r for r in rows(msgs.messages_from_records(df))}
    assert set(got) == {5, 6}
    assert got[5]["chat_id"] == -1001 and got[5]["source"] == "live"
    assert got[5]["msg_date"].strftime("%Y-%m-%d %H:%M:%S") == "2024-01-02 03:04:05"
    assert got[6]["source"] == "backfill" and got[6]["msg_date"].strftime("%Y-%m-%d") == "2024-05-02"


def test_record_stream_through_triage(spark):
    from pyspark.sql import functions as F

    from vetline.sources import fixtures as fx
    from vetline.sources import messages as msgs
    d = tempfile.mkdtemp(prefix="vetline-records-")
    m = fx.fx_messages(spark, SF001).drop("date_s")
    recs = m.select(F.col("msg_id").cast("string").cast("binary").alias("key"),
                    F.to_json(F.struct(*m.columns)).cast("binary").alias("value"),
                    F.current_timestamp().alias("timestamp"))
    recs.write.parquet(d + "/in")
    stream = msgs.messages_from_records(
        spark.readStream.schema("key binary, value binary, timestamp timestamp").parquet(d + "/in"))
    seen = spark.createDataFrame([], "chat_id long, msg_id long")
    out = ts.run_available_now(spark, ts.triage_stream(stream, seen), "t_records")
    got = spark.read.parquet(out)
    assert got.count() == m.select("chat_id", "msg_id").distinct().count()


def test_stream_into_tables_resumes_and_scores_transient_again(spark):
    """A second run reads only new files; what was transient is scored again; a
    table of part files and one of a single file give equal rows."""
    from pyspark.sql import functions as F

    from vetline.operators import evaluate
    from vetline.sources.tables import read_seen
    conv = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    one, many = (tempfile.mkdtemp(prefix="vetline-live-") for _ in "ab")
    conv.coalesce(1).write.parquet(f"{one}/in")
    conv.repartition(3).write.parquet(f"{many}/in")
    down = {"n": 0}

    def evaluator(df, mask):
        down["n"] += 1
        e = evaluate.evaluate_with_rules(df, mask=mask)
        if down["n"] > 1:
            return e
        return e.withColumn("call_status", F.when(F.col("chat_id") % 5 == 0, F.when(mask, F.lit("transient"))).otherwise(F.col("call_status")))

    def run(d, first, ev=None):
        return ts.drain_to_tables(spark, ts.conversation_stream(spark, f"{d}/in", 2), f"{d}/q", f"{d}/seen", f"{d}/matches", ev, first_run=first)
    assert run(one, True) == 0 and run(one, False) is None
    assert run(many, True, evaluator) == 0
    told = ts.read_dispositions(spark, f"{many}/q")
    n = told.count()
    waiting = told.filter("disposition = 'transient'").select("chat_id", "msg_id").distinct().count()
    assert waiting > 0 and read_seen(spark, f"{many}/seen").count() == conv.count() - waiting
    conv.limit(3).write.mode("append").parquet(f"{many}/in")
    assert run(many, False, evaluator) == 1     # three repeats, and what was waiting; nothing else is read again
    last = ts.read_dispositions(spark, f"{many}/q").filter("run = 1")
    assert waiting <= last.count() <= waiting + 3 and last.filter("disposition = 'transient'").count() == 0
    assert ts.read_dispositions(spark, f"{many}/q").count() == n + last.count()
    assert run(many, False, evaluator) is None
    values = ["chat_id", "msg_id", "is_vacancy", "score", "posted", "title"]
    assert sorted(map(str, rows(read_seen(spark, f"{many}/seen").select(*values)))) == sorted(
        map(str, rows(read_seen(spark, f"{one}/seen").select(*values))))


def test_records_and_outcomes_without_a_key_are_rejected_with_a_reason(spark):
    from vetline.operators import state
    from vetline.sources import messages as msgs
    recs = spark.createDataFrame([('{"chat_id": 1, "msg_id": 2, "text": "x"}',), ("nonsense",), ('{"chat_id": 1}',), ('{"msg_id": 1}',), (None,)],
                                 "value string")
    assert msgs.messages_from_records(recs).count() == 1
    assert sorted(r["reason"] for r in rows(msgs.rejected_records(recs))) == [
        "chat_id is missing", "msg_id is missing", "not a message", "not a message"]
    outs = spark.createDataFrame([(1, 2, True, 5, False, "t", 1), (None, 2, True, 5, False, "t", 1), (1, None, True, 5, False, "t", 1)],
                                 "chat_id long, msg_id long, is_vacancy boolean, score int, posted boolean, title string, ts long")
    assert state.seen_rows(outs).count() == 1
    assert sorted(r["reason"] for r in rows(state.rejected_outcomes(outs))) == ["chat_id is null", "msg_id is null"]
