"""Edge cases: empty tables, orphans, zero-hour backfill, NULL scores."""

from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline import schemas
from vetline.operators import dedup
from vetline.plans import reports
from vetline.sources import fixtures as fx
from vetline.sources import messages as msgs


def test_empty_seen(spark):
    empty = spark.createDataFrame([], schemas.SEEN)
    o = rows(reports.overall_stats(empty))[0]
    assert (o["total"], o["vacancies"], o["not_vacancies"], o["posted"], o["last_ts"]) == (0, 0, 0, 0, None)
    ch = spark.createDataFrame([(1, "u", "T", None)], schemas.CHANNELS)
    cs = rows(reports.channel_stats(ch, empty))[0]
    assert (cs["total"], cs["vacancies"], cs["posted"], cs["avg_score"], cs["max_score"]) == (0, 0, 0, None, 0)
    assert rows(reports.list_messages(empty, ch)) == []


def test_orphan_and_null_scores(spark):
    seen = spark.createDataFrame([(1, 1, 1, None, 0, "a", 10), (1, 2, 1, None, 0, None, 11),
                                  (99, 3, 1, 80, 1, "orphan", 12)], schemas.SEEN)
    ch = spark.createDataFrame([(1, None, "T", 5)], schemas.CHANNELS)
    cs = rows(reports.channel_stats(ch, seen))
    assert len(cs) == 1 and cs[0]["avg_score"] is None and cs[0]["max_score"] == 0 and cs[0]["total"] == 2
    lm = rows(reports.list_messages(seen, ch))
    orphan = [r for r in lm if r["chat_id"] == 99][0]
    assert orphan["channel_title"] is None and orphan["channel_username"] is None
    assert [r["msg_id"] for r in lm] == [3, 2, 1]
    rec = rows(reports.render_recent(reports.recent_matches(seen, ch)))
    assert rec[0]["channel"] == "99" and rec[0]["title"] == "orphan"


def test_posted_le_vacancies_le_total(spark):
    o = rows(reports.overall_stats(fx.fx_seen(spark, SF001)))[0]
    assert o["posted"] <= o["vacancies"] <= o["total"]


def test_zero_hour_backfill_is_empty(spark):
    m = dedup.first_arrivals(msgs.normalize(fx.fx_messages(spark, SF001)))
    assert msgs.backfill(m, None).count() == 0


def test_backfill_null_dates_pass(spark):
    df = spark.createDataFrame([(1, 5, None), (1, 4, 50), (1, 3, None), (2, 9, None)],
                               "chat_id long, msg_id long, date_s long")
    got = sorted((r["chat_id"], r["msg_id"]) for r in rows(msgs.backfill(df, 100, cap=10)))
    assert got == [(1, 5), (2, 9)]
    got = sorted((r["chat_id"], r["msg_id"]) for r in rows(msgs.backfill(df, 10, cap=2)))
    assert got == [(1, 4), (1, 5), (2, 9)]


def test_union_arrivals_and_primary(spark):
    live = spark.createDataFrame([(1, 1, "x")], "chat_id long, msg_id long, text string") \
        .withColumn("msg_date", F.lit(None).cast("timestamp"))
    back = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "chat_id long, msg_id long, text string") \
        .withColumn("msg_date", F.lit(None).cast("timestamp"))
    u = dedup.mark_primary(dedup.union_arrivals(live, back))
    got = sorted((r["msg_id"], r["source"], r["primary"]) for r in rows(u))
    assert got == [(1, "backfill", False), (1, "live", True), (2, "backfill", True)]


def test_listing_label_reads_message_title_first(spark):
    seen = spark.createDataFrame([(1, 1, 1, 90, 1, "Role", 10), (1, 2, 0, 5, 0, None, 9)], schemas.SEEN)
    ch = spark.createDataFrame([(1, "u", "Chan", 5)], schemas.CHANNELS)
    got = {r["msg_id"]: r["channel"] for r in rows(reports.render_listing(reports.list_messages(seen, ch)))}
    assert got == {1: "Role (@u)", 2: "Chan (@u)"}


def test_channel_table_rendering(spark):
    seen = spark.createDataFrame([(1, 1, 1, 85, 1, "a", 1704067200), (1, 2, 1, 70, 0, None, 10),
                                  (2, 3, 0, 5, 0, None, 11)], schemas.SEEN)
    ch = spark.createDataFrame([(1, "u1", "Alpha", 1704067200), (2, None, "beta", 0), (3, None, None, None)],
                               schemas.CHANNELS)
    got = {r["chat_id"]: (r["rank"], r["channel"], r["avg_score"], r["max_score"], r["last"])
           for r in rows(reports.render_channels(reports.channel_ranking(ch, seen)))}
    assert got == {3: (1, "?", "—", 0, "—"), 1: (2, "Alpha (@u1)", "77.5", 85, "2024-01-01 00:00 UTC"),
                   2: (3, "beta", "—", 0, "—")}
