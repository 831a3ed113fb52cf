"""Consecutive positions in a total order (display rank) without one task."""

import contextlib

from pyspark.sql import functions as F

from helpers import SF01, rows
from vetline.operators.order import ranked
from vetline.plans import reports
from vetline.sources import fixtures as fx


@contextlib.contextmanager
def uncoalesced(spark):
    """Keep every range partition (AQE would merge small ones into one), so
    the per-partition offsets are exercised."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def test_ranked_equals_sorted_positions(spark):
    data = [(i, None if i % 97 == 0 else f"t{(i * 7919) % 1000:04d}") for i in range(5000)]
    df = spark.createDataFrame(data, "id long, title string").repartition(13)
    with uncoalesced(spark):
        r = ranked(df, F.col("title").asc_nulls_first(), F.col("id").desc())
        assert r.rdd.getNumPartitions() > 1
        got = [(x["rank"], x["id"]) for x in rows(r)]
    want = sorted(data, key=lambda t: (t[1] is not None, t[1] or "", -t[0]))
    assert sorted(got) == [(i + 1, t[0]) for i, t in enumerate(want)]
    # the result keeps the sorted layout: collected rows are in rank order
    assert [g[0] for g in got] == list(range(1, len(data) + 1))


def test_ranked_uses_several_partitions(spark):
    df = spark.range(0, 20000).select(F.col("id"), (F.col("id") % 101).alias("k"))
    with uncoalesced(spark):
        r = ranked(df, "k", "id")
        assert r.rdd.getNumPartitions() > 1
        mx = r.agg(F.max("rank").alias("m"), F.countDistinct("rank").alias("d")).first()
    assert mx["m"] == 20000 and mx["d"] == 20000


def test_channel_ranking_order_matches_channel_stats(spark):
    ch, seen = fx.fx_channels(spark, SF01), fx.fx_seen(spark, SF01)
    by_rank = [x["chat_id"] for x in sorted(rows(reports.channel_ranking(ch, seen)), key=lambda x: x["rank"])]
    assert by_rank == [x["chat_id"] for x in rows(reports.channel_stats(ch, seen))]
