"""Upsert semantics of the outcome and channel tables."""

from helpers import SF001, rows
from vetline import schemas
from vetline.operators import state
from vetline.sources import fixtures as fx
from vetline.sources.tables import evolve


def test_seen_upsert_replace_and_idempotent(spark):
    cur = spark.createDataFrame([(1, 1, 1, 80, 1, "a", 10), (1, 2, 0, 5, 0, None, 10)], schemas.SEEN)
    b = spark.createDataFrame([(1, 1, None, None, 0, None, 20), (2, 9, 1, 90, 1, "n", 20)], schemas.SEEN)
    once = state.upsert_seen(cur, b)
    twice = state.upsert_seen(once, b)
    got = {(r["chat_id"], r["msg_id"]): r for r in rows(once)}
    assert got[(1, 1)]["is_vacancy"] is None and got[(1, 1)]["title"] is None and got[(1, 1)]["ts"] == 20
    assert got[(1, 2)]["score"] == 5 and len(got) == 3
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice)))


def test_seen_rows_flags(spark):
    df = spark.createDataFrame([(1, 1, True, 70, True, "t", 5), (1, 2, None, None, None, None, 5),
                                (None, 3, False, 1, False, None, 5)],
                               "chat_id long, msg_id long, is_vacancy boolean, score int, posted boolean,"
                               " title string, ts long")
    got = sorted(rows(state.seen_rows(df)), key=lambda r: r["msg_id"])
    assert [(r["is_vacancy"], r["posted"]) for r in got] == [(1, 1), (None, 0)]


def test_channels_upsert_preserves_last_msg_ts(spark):
    cur = spark.createDataFrame([(1, "u1", "T1", 100), (2, "u2", "T2", 200)], schemas.CHANNELS)
    regs = spark.createDataFrame([(1, None, "New"), (3, "u3", "T3")], "chat_id long, username string, title string")
    got = {r["chat_id"]: r for r in rows(state.upsert_channels(cur, regs))}
    assert (got[1]["username"], got[1]["title"], got[1]["last_msg_ts"]) == (None, "New", 100)
    assert got[2]["title"] == "T2" and got[3]["last_msg_ts"] is None


def test_touch_ignores_unregistered(spark):
    cur = spark.createDataFrame([(1, "u1", "T1", 100)], schemas.CHANNELS)
    t = spark.createDataFrame([(1, 150), (1, 120), (9, 999)], "chat_id long, ts long")
    got = rows(state.touch_channels(cur, t))
    assert len(got) == 1 and got[0]["last_msg_ts"] == 150


def test_schema_evolve(spark):
    old = spark.createDataFrame([(1, 1, 5, 0, 10)], schemas.SEEN_V1)
    new = fx.fx_seen(spark, SF001).limit(3)
    e = evolve(old, new)
    assert e.columns == [f.name for f in schemas.SEEN.fields]
    r = [x for x in rows(e) if x["msg_id"] == 1 and x["chat_id"] == 1][0]
    assert r["is_vacancy"] is None and r["title"] is None


def test_read_seen_old_and_new_files(spark):
    import tempfile

    from pyspark.sql import functions as F

    from vetline.sources.tables import read_seen
    d = tempfile.mkdtemp(prefix="vetline-seen-versions-") + "/seen"
    old = spark.createDataFrame([(1, 1, 50, 0, 10)], "chat_id long, msg_id long, score int, posted int, ts long")
    new = spark.createDataFrame([(1, 2, 1, 90, 1, "Role", 20)], schemas.SEEN)
    # the newer file is written first: schema inference could pick either footer
    new.withColumn("dt", F.lit("2024-01-02")).write.partitionBy("dt").parquet(d)
    old.withColumn("dt", F.lit("2024-01-01")).write.mode("append").partitionBy("dt").parquet(d)
    got = {r["msg_id"]: (r["is_vacancy"], r["score"], r["title"]) for r in rows(read_seen(spark, d))}
    assert got == {1: (None, 50, None), 2: (1, 90, "Role")}
