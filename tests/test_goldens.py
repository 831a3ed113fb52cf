"""Golden numbers of the fixture tables (FIXTURES.md)."""

from pyspark.sql import functions as F

from helpers import SF001, SF01, rows
from vetline.functions import text as tx
from vetline.plans import reports
from vetline.plans.catalog import QUERIES
from vetline.sources import fixtures as fx


def test_overall_stats_golden(spark):
    for d, want in ((SF001, (1000, 401, 398, 110, 1706657176)), (SF01, (10000, 3998, 3988, 966, 1706659032))):
        r = rows(QUERIES["overall_stats"](spark, d))[0]
        assert (r["total"], r["vacancies"], r["not_vacancies"], r["posted"], r["last_ts"]) == want
        # invariants: posted <= vacancies <= total; total = vac + not_vac + null
        nulls = fx.fx_seen(spark, d).filter(F.col("is_vacancy").isNull()).count()
        assert r["total"] == r["vacancies"] + r["not_vacancies"] + nulls


def test_channel_stats_golden(spark):
    for d, want in ((SF001, (150, 135, 15, 671.6, 1500)), (SF01, (1500, 1350, 150, 6380.6, 14943))):
        cs = rows(QUERIES["channel_stats"](spark, d))
        with_avg = [r["avg_score"] for r in cs if r["avg_score"] is not None]
        got = (len(cs), sum(1 for r in cs if r["total"] == 0), len(with_avg), round(sum(with_avg), 1),
               sum(r["max_score"] for r in cs))
        assert got == want


def test_channel_stats_sorted_nocase(spark):
    cs = rows(QUERIES["channel_stats"](spark, SF001))
    keys = [((r["title"] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")),
             r["chat_id"]) for r in cs]
    assert keys == sorted(keys)


def test_per_channel_sums_equal_overall(spark):
    cs = rows(QUERIES["channel_stats"](spark, SF001))
    o = rows(QUERIES["overall_stats"](spark, SF001))[0]
    assert sum(r["total"] for r in cs) == o["total"]
    assert sum(r["posted"] for r in cs) == o["posted"]


def test_messages_golden(spark):
    m = fx.fx_messages(spark, SF001)
    assert m.count() == 213
    assert m.select("chat_id", "msg_id").distinct().count() == 200
    assert m.select("chat_id").distinct().count() == 20
    assert m.filter(F.col("source") == "live").count() == 133
    assert m.filter(tx.source_link("chat_id", "msg_id").isNotNull()).count() == 157
    fall = m.filter(tx.chat_title("chat_title", "chat_username", "chat_first_name", "chat_id")
                    == F.col("chat_id").cast("string")).select("chat_id", "msg_id").distinct()
    assert fall.count() == 40
    assert rows(QUERIES["markdown_escape"](spark, SF001)) and \
        QUERIES["markdown_escape"](spark, SF001).filter("n_escaped > 0").count() == 7


def test_backfill_take_while_golden(spark):
    for d, want in ((SF001, (183, 19)), (SF01, (352, 20))):
        b = QUERIES["backfill_scan"](spark, d)
        assert (b.count(), b.select("chat_id").distinct().count()) == want
    # a plain filter keeps more: take-while is a prefix, not a filter
    m = fx.fx_messages(spark, SF001).select("chat_id", "msg_id", "date_s").distinct()
    assert m.filter(F.col("date_s") >= fx.BASE_EPOCH).count() == 197


def test_dispositions_golden(spark):
    want = {SF001: dict(too_short=5, transient=110, crash=4, not_vacancy=11, below_threshold=48, posted=22),
            SF01: dict(too_short=11, transient=584, crash=20, not_vacancy=56, below_threshold=226, posted=103)}
    for d, w in want.items():
        got = {r["disposition"]: r["count"] for r in rows(QUERIES["dispositions"](spark, d).groupBy("disposition").count())}
        assert got == w


def test_parse_status_golden(spark):
    got = {r["disposition"]: r["n"] for r in rows(QUERIES["parse_status"](spark, SF01))}
    assert got == dict(parse_error=2000, crash=1000, not_vacancy=2000, below_threshold=3313, posted=1687)


def test_rule_match_counts(spark):
    h = QUERIES["rule_hits"](spark, SF001).groupBy("rule_id").count()
    assert {r["rule_id"]: r["count"] for r in rows(h)} == {1: 140, 2: 38, 3: 104, 4: 15, 5: 5}


def test_listing_limits_and_order(spark):
    seen, ch = fx.fx_seen(spark, SF01), fx.fx_channels(spark, SF01)
    lm = rows(reports.list_messages(seen, ch, limit=300))
    assert len(lm) == 300
    keys = [(r["ts"], r["chat_id"], r["msg_id"]) for r in lm]
    assert keys == sorted(keys, reverse=True)
    # unknown filter type falls back to all
    assert reports.normalize_filter("bogus") == "all"
    assert len(rows(reports.list_messages(seen, ch, filter_type="bogus"))) == 200
