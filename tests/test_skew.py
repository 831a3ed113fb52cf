"""Hot keys: one message copied many times, one outcome key logged many times.

The aggregate plans must give what brute force (ranking every arrival) gives.
"""

from collections import Counter

from pyspark.sql import functions as F

from helpers import rows
from vetline.operators import dedup


def _arrivals(spark):
    hot = [(1, 1, "live" if i % 3 else "backfill", f"t{i}") for i in range(3000)]
    rest = [(2, 5, "backfill", "a"), (2, 5, "backfill", "b"), (3, 7, "live", "c"), (4, 8, "other", "d"),
            (4, 8, "backfill", "e")]
    return (spark.createDataFrame(hot + rest, "chat_id long, msg_id long, source string, text string")
            .withColumn("msg_date", F.lit(None).cast("timestamp")))


def test_arrival_counts_equal_brute_force(spark):
    a = _arrivals(spark)
    brute = Counter()
    for r in rows(dedup.mark_primary(a)):
        brute[(r["chat_id"], r["msg_id"], r["source"], "p" if r["primary"] else "d")] += 1
    got = Counter()
    for r in rows(dedup.arrival_counts(a)):
        if r["n_primary"]:
            got[(r["chat_id"], r["msg_id"], r["source"], "p")] += r["n_primary"]
        if r["n"] - r["n_primary"]:
            got[(r["chat_id"], r["msg_id"], r["source"], "d")] += r["n"] - r["n_primary"]
    assert got == brute
    # exactly one primary per key
    per_key = Counter()
    for r in rows(dedup.arrival_counts(a)):
        per_key[(r["chat_id"], r["msg_id"])] += r["n_primary"]
    assert set(per_key.values()) == {1}


def test_arrival_counts_plan_combines_map_side(spark):
    plan = dedup.arrival_counts(_arrivals(spark))._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate runs before the first exchange; no per-arrival sort
    assert "partial_count" in plan


def test_seen_check_with_hot_outcome_key(spark):
    seen = spark.createDataFrame([(1, 1)] * 2000 + [(2, 5)], "chat_id long, msg_id long")
    msgs = spark.createDataFrame([(1, 1), (2, 5), (3, 7)], "chat_id long, msg_id long")
    assert sorted((r["chat_id"], r["msg_id"]) for r in rows(dedup.unseen(msgs, seen))) == [(3, 7)]
    assert sorted((r["chat_id"], r["msg_id"]) for r in rows(dedup.already_seen(msgs, seen))) == [(1, 1), (2, 5)]
    flagged = {(r["chat_id"], r["msg_id"]): r["in_seen"] for r in rows(dedup.flag_seen(msgs, seen, msgs))}
    assert flagged == {(1, 1): True, (2, 5): True, (3, 7): False}


def _brute_backfill(data, cutoff, cap):
    out = []
    for chat in {c for c, _, _ in data}:
        taken = 0
        for _, mid, date in sorted((r for r in data if r[0] == chat), key=lambda r: -r[1]):
            if taken >= cap:
                break
            taken += 1
            if date is not None and date < cutoff:
                break
            out.append((chat, mid))
    return sorted(out)


def test_backfill_hot_chat_equals_take_while(spark):
    from vetline.sources import messages as msgs
    # chat 1 holds most rows, spread over many input partitions; old messages
    # appear out of order (every 37th) and some dates are NULL
    data = [(1, i, None if i % 11 == 0 else (10 if i % 37 == 0 else 1000 + i)) for i in range(5000)]
    data += [(2, i, 5 if i == 3 else 2000) for i in range(10)] + [(3, 1, None)]
    df = spark.createDataFrame(data, "chat_id long, msg_id long, date_s long").repartition(16)
    for cutoff, cap in ((500, 200), (500, 50), (5000, 200), (0, 3)):
        got = sorted((r["chat_id"], r["msg_id"]) for r in rows(msgs.backfill(df, cutoff, cap=cap)))
        assert got == _brute_backfill(data, cutoff, cap), (cutoff, cap)


def test_channel_stats_with_a_hot_channel_equals_brute_force(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from vetline import schemas
    from vetline.plans import reports
    rnd = random.Random(7)
    data = []
    for i in range(6000):
        chat = 1 if i < 4000 else rnd.randint(2, 40)       # chat 1 holds two thirds of the rows
        vac = rnd.choice([None, 0, 1])
        data.append((chat, i, vac, rnd.randint(0, 100), int(vac == 1 and rnd.random() < 0.5), None, i))
    seen = spark.createDataFrame(data, schemas.SEEN).repartition(12)
    ch = spark.createDataFrame([(c, None, f"c{c}", None) for c in range(1, 45)], schemas.CHANNELS)
    got = {r["chat_id"]: (r["total"], r["vacancies"], r["posted"], r["avg_score"], r["max_score"])
           for r in rows(reports.channel_stats(ch, seen))}
    want = {}
    for c in range(1, 45):
        rs = [r for r in data if r[0] == c]
        vs = [r[3] for r in rs if r[2] == 1]
        avg = None if not vs else float(Decimal(sum(vs)) / Decimal(len(vs)))
        avg = None if avg is None else float(Decimal(repr(avg)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
        want[c] = (len(rs), len(vs), sum(r[4] for r in rs), avg, max(vs) if vs else 0)
    assert got == want
    plan = reports.channel_stats(ch, seen)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_seen_flag_paths_agree(spark):
    from vetline.sources import fixtures as fx
    from helpers import SF001
    msgs_ = dedup.first_arrivals(fx.fx_messages(spark, SF001))
    seen = fx.fx_messages(spark, SF001).filter(F.col("source") == "live").select("chat_id", "msg_id")
    small = dedup.flag_seen(msgs_, seen, candidate_keys=msgs_)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = dedup.flag_seen(msgs_, seen, candidate_keys=msgs_)
        large_rows = rows(large.select("chat_id", "msg_id", "in_seen"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    none = dedup.flag_seen(msgs_, seen)
    pick = lambda d: sorted(map(str, rows(d.select("chat_id", "msg_id", "in_seen"))))
    assert pick(small) == sorted(map(str, large_rows)) == pick(none)
    assert {r["in_seen"] for r in rows(small)} == {True, False}


def test_upsert_reads_the_outcome_table_once(spark):
    from helpers import SF001
    from vetline.operators import state
    from vetline.plans.catalog import _seen_batches
    from vetline.sources import fixtures as fx
    cur = fx.fx_seen(spark, SF001)
    b1, b2 = _seen_batches(spark, SF001)
    got = state.upsert_seen(cur, b1, b2)
    want = {(r["chat_id"], r["msg_id"]): r for r in rows(cur)}
    for b in (b1, b2):
        for r in rows(b):
            k = (r["chat_id"], r["msg_id"])
            if k not in want or want[k]["ts"] is None or r["ts"] >= want[k]["ts"]:
                want[k] = r
    assert sorted(map(str, rows(got.select(*next(iter(want.values()))))) ) == sorted(map(str, want.values()))
