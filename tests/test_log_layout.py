"""The outcome log in buckets, reports kept up to date, compaction of days."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline import schemas
from vetline.operators import dedup
from vetline.plans import jobs, report_cells, reports
from vetline.sources import fixtures as fx
from vetline.sources import seen_table
from vetline.sources.tables import latest_seen, read_seen, read_seen_log


def log_of(spark, seed, n=400, keys=80, runs=5):
    rnd = random.Random(seed)
    data = [(k % 7, k, rnd.choice([0, 1, None]), rnd.choice([None, 0, 50, 100]), rnd.randint(0, 1), rnd.choice(["a", None]), 86400 * rnd.randint(1, 9), rnd.randint(1, runs))
            for k in (rnd.randrange(keys) for _ in range(n))]
    return spark.createDataFrame(data, schemas.SEEN_LOG)


def test_a_large_batch_does_not_shuffle_a_bucketed_log(spark):
    d = tempfile.mkdtemp(prefix="vetline-buckets-")
    seen_table.rebucket(fx.fx_seen(spark, SF001).withColumn("run", F.lit(1).cast("bigint")), f"{d}/seen", 4)
    seen_table.append_bucketed(fx.fx_seen(spark, SF001).limit(50).select("*", F.lit(2).cast("bigint").alias("run"), F.lit("2024-03-01").cast("date").alias("dt")), f"{d}/seen", 4)
    batch = fx.fx_seen(spark, SF001).select("chat_id", "msg_id").union(spark.range(500).select((F.col("id") % 9).alias("chat_id"), F.col("id") + 10**6))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = seen_table.read_bucketed(spark, f"{d}/seen", 4)
        flagged = dedup.flag_seen(batch, log, batch)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        got = {r["in_seen"]: r["count"] for r in rows(flagged.groupBy("in_seen").count())}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan
    # between the log's scan and the joins stands no exchange: only the batch is dealt, once for each join
    assert plan.count("Exchange hashpartitioning") == 2
    scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
    lines = plan.splitlines()
    depth, above = scan.index("FileScan"), []
    for line in reversed(lines[:lines.index(scan)]):
        at = len(line) - len(line.lstrip(" :+-*("))
        if at < depth:
            above.append(line)
            depth = at
    assert above and not any("Exchange" in x for x in above)
    assert got == {True: 1000, False: 500}
    # the folder is a plain log too
    assert read_seen_log(spark, f"{d}/seen").count() == 1050


def test_a_bucketed_run_decides_as_a_plain_one(spark):
    d = tempfile.mkdtemp(prefix="vetline-bucket-run-")
    m = fx.fx_messages(spark, SF001)
    got = {}
    for name, kw in (("plain", {}), ("bucketed", {"seen_buckets": 4})):
        for k in range(2):
            some = m.filter("msg_id < 150") if not k else m
            jobs.run_triage(spark, some, f"{d}/{name}/seen", f"{d}/{name}/matches", run_ts=1735689600 + k, first_run=not k, dispositions_out=f"{d}/{name}/told{k}", **kw)
        got[name] = [sorted(map(str, rows(x))) for x in (spark.read.parquet(f"{d}/{name}/told1"), read_seen(spark, f"{d}/{name}/seen"))]
    assert got["plain"] == got["bucketed"] and "dedup_skip" in "".join(got["plain"][0])
    with pytest.raises(ValueError, match="4"):
        seen_table.open_seen(spark, f"{d}/bucketed/seen", 8)
    with pytest.raises(ValueError, match="not in buckets"):
        seen_table.open_seen(spark, f"{d}/plain/seen", 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_cells_equal_a_full_recompute_after_replays(spark, seed):
    """Runs come in any order, write rows twice and replace rows of earlier runs; the reports stay those of the log."""
    d = tempfile.mkdtemp(prefix="vetline-cells-")
    log = log_of(spark, seed).cache()
    channels = spark.createDataFrame([(c, f"u{c}", f"T{c}", None) for c in range(9)], schemas.CHANNELS)
    before = log.limit(0)
    for step, run in enumerate([2, 1, 5, 3, 4]):
        new = log.filter(F.col("run") == run)
        if step == 2:
            new = new.union(new)
        report_cells.append_run(spark, f"{d}/cells", before, new, step)
        before = before.union(new)
        cells = report_cells.read_cells(spark, f"{d}/cells")
        latest = latest_seen(before)
        assert rows(report_cells.overall_stats(cells)) == rows(reports.overall_stats(latest))
        assert sorted(map(str, rows(report_cells.channel_stats(channels, cells)))) == sorted(map(str, rows(reports.channel_stats(channels, latest, ordered=False))))
        assert rows(cells.filter("n < 0")) == []
    # a run done again replaces its cells; compacted cells say the same, and later runs go on there
    want = sorted(map(str, rows(cells)))
    report_cells.append_run(spark, f"{d}/cells", before.filter("run <> 4"), log.filter("run = 4"), 4)
    assert sorted(map(str, rows(report_cells.read_cells(spark, f"{d}/cells")))) == want
    assert report_cells.compact_cells(spark, f"{d}/cells", f"{d}/small") == 4
    assert sorted(map(str, rows(report_cells.read_cells(spark, f"{d}/small")))) == want
    assert rows(report_cells.overall_stats(report_cells.read_cells(spark, f"{d}/none"))) == rows(reports.overall_stats(log.limit(0)))


def test_the_job_keeps_cells(spark):
    d = tempfile.mkdtemp(prefix="vetline-cells-job-")
    m = fx.fx_messages(spark, SF001)
    for k, some in enumerate((m.filter("msg_id < 100"), m)):
        jobs.run_triage(spark, some, f"{d}/seen", f"{d}/matches", run_ts=100 + k, first_run=not k, cells_out=f"{d}/cells")
    assert rows(report_cells.overall_stats(report_cells.read_cells(spark, f"{d}/cells"))) == rows(reports.overall_stats(read_seen(spark, f"{d}/seen")))


def files_of(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_compaction_touches_only_days_with_replaced_rows(spark):
    d = tempfile.mkdtemp(prefix="vetline-days-")
    day = 86400

    def write(data):
        spark.createDataFrame([(1, m, 1, s, 0, "t", ts, run) for m, s, ts, run in data], schemas.SEEN_LOG).withColumn(
            "dt", F.to_date(F.timestamp_seconds("ts"))).write.mode("append").partitionBy("dt").parquet(f"{d}/seen")
    write([(1, 10, day, 1), (2, 20, day, 1), (3, 30, 2 * day, 1), (4, 40, 3 * day, 1)])
    write([(1, 11, 4 * day, 2), (4, 41, 4 * day, 2), (5, 50, 4 * day, 2)])      # of day 3 nothing stays
    write([(6, 60, 5 * day, 3)] * 2)                                            # written twice
    before, latest = files_of(f"{d}/seen"), sorted(map(str, rows(read_seen(spark, f"{d}/seen"))))
    assert jobs.compact_days(spark, f"{d}/seen") == ["1970-01-02", "1970-01-04", "1970-01-05", "1970-01-06"]
    after = files_of(f"{d}/seen")
    assert {f for f in before if "dt=1970-01-03" in f} == {f for f in after if "dt=1970-01-03" in f and after[f] == before[f]}
    assert not any("dt=1970-01-04" in f for f in after)
    assert sorted(map(str, rows(read_seen(spark, f"{d}/seen")))) == latest
    assert read_seen_log(spark, f"{d}/seen").count() == 6
    assert jobs.compact_days(spark, f"{d}/seen") == [] and files_of(f"{d}/seen") == after


@pytest.mark.parametrize("seed", [3, 4])
def test_compacted_days_equal_the_latest_rows(spark, seed):
    d = tempfile.mkdtemp(prefix="vetline-days-")
    log = log_of(spark, seed)
    log.withColumn("dt", F.to_date(F.timestamp_seconds("ts"))).write.partitionBy("dt").parquet(f"{d}/seen")
    want = sorted(map(str, rows(read_seen(spark, f"{d}/seen"))))
    jobs.compact_days(spark, f"{d}/seen")
    left = read_seen_log(spark, f"{d}/seen")
    assert sorted(map(str, rows(left.drop("run")))) == want
