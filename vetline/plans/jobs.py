"""The triage job: messages in, outcome/match/channel tables out.

Stages (cheap before costly):
  normalise -> in-batch dedup -> flag keys already in ``seen`` -> junk filter
  -> evaluate (rules, or a user scorer) -> route
The routed rows are written once to the shared checkpoint folder (the
scorer must not run again per sink, and the lineage is cut there, so a lost
executor only recomputes from that table); then the sinks are projections:
  matches   one card per posted message
  channels  new snapshot with last activity touched
  retry     ledger of what is still transient: tries made, next try due
  dead      messages given up after their last try
  dispositions  what the run decided, one row per message
  seen      append-only log of outcome rows (latest-wins on read/compaction),
            written last: it is the commit of the run
Every sink is a plain Parquet write through Spark's output committer: a
failed task is retried; a re-run after a failed job may append the same
outcome rows again, which the latest-wins read and compaction absorb
(``matches`` is at-least-once, as publishing is).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from vetline import schemas, session
from vetline.schemas import SEEN_KEY
from vetline.functions import text as tx
from vetline.operators import cards, dedup, evaluate, route, state
from vetline.plans import report_cells
from vetline.sources import messages as msgs
from vetline.sources import seen_table
from vetline.sources.allowlist import allowlisted, resolve
from vetline.sources.tables import claim_run, latest_seen, no_rows, read_channels, read_seen_log, table_or_empty


def rules_evaluator(rules=evaluate.FX_RULES, threshold: int = route.DEFAULT_THRESHOLD):
    return lambda df, mask: evaluate.evaluate_with_rules(df, rules, threshold=threshold, mask=mask)


def batch_evaluator(batch_fn, concurrency: int | None = None):
    return lambda df, mask: evaluate.evaluate_with(df, batch_fn, concurrency, mask=mask)


def triage_plan(arrivals: DataFrame, seen: DataFrame, evaluator, threshold: int = route.DEFAULT_THRESHOLD,
                min_len: int = tx.MIN_TEXT_LEN, allowed: DataFrame | None = None) -> DataFrame:
    """Routed rows, one per distinct message, ``dedup_skip`` included; lazy.

    One pass: the scorer is asked only for rows that are new and worth it
    (``mask``), every other row flows past it, and ``route`` assigns the
    disposition; no branch re-reads or re-shuffles the input.  ``allowed``
    (resolved sources) keeps only messages of allow-listed chats.
    """
    if allowed is not None:
        arrivals = allowlisted(arrivals, allowed)
    n = msgs.normalize(arrivals)
    first = dedup.flag_seen(dedup.first_arrivals(n), seen, candidate_keys=arrivals.select(*SEEN_KEY))
    base = first.select("chat_id", "msg_id", "source", "chat_title", "text", "in_seen",
                        tx.worth_evaluating("text", min_len).alias("worth"))
    evaluated = evaluator(base, ~F.col("in_seen") & F.col("worth"))
    return route.route(evaluated, threshold, min_len, seen_col="in_seen", worth_col="worth")


@dataclass
class TriageResult:
    routed_path: str
    seen_path: str
    matches_path: str
    channels_path: str | None
    retry_path: str | None = None
    run: int | None = None


def run_triage(spark: SparkSession, arrivals: DataFrame, seen_path: str, matches_path: str,
               evaluator: Callable[[DataFrame, object], DataFrame] | None = None, *, run_ts: int,
               channels_path: str | None = None, channels_out: str | None = None,
               threshold: int = route.DEFAULT_THRESHOLD, allowed: DataFrame | None = None,
               retry_in: str | None = None, retry_out: str | None = None,
               registrations: DataFrame | None = None, seen_since: int | None = None,
               first_run: bool = False, run_id: int | None = None, max_tries: int | None = None, retry_wait_s: int = 0,
               dead_out: str | None = None, dispositions_out: str | None = None, seen_buckets: int | None = None,
               cells_out: str | None = None) -> TriageResult:
    """One triage run.  ``seen_path``/``matches_path`` are appended to;
    ``channels_out`` receives the channel snapshot: the table at
    ``channels_path``, with ``registrations`` (``chat_id, username, title``,
    e.g. the resolved sources) upserted, then touched by this run's recorded
    messages.  ``run_ts`` is the processing time (epoch seconds) that the rows
    carry; ``run_id`` orders the runs (default: the next number of the outcome log,
    ``claim_run``, so a driver whose clock is behind does not lose latest-wins).
    Tables that are not there are an error unless this is the ``first_run``.

    The outcome append is the commit: cards, channels and the retry
    snapshot are written before it.  A run that fails at any sink has recorded
    nothing, so the next run does all of it again; its cards collapse with
    those already written (``read_matches``), and snapshots are overwritten.

    A ``transient`` message is not recorded, so it is evaluated again when
    it arrives again.  For sources that do not deliver a message twice (a
    stream, a one-shot export), ``retry_out`` receives the messages still
    transient after this run, and the next run passes that folder as
    ``retry_in``: its messages join the arrivals.  ``retry_out`` is a new
    folder per run (a snapshot, not a log), so the retry set never grows with
    messages that have since been recorded.  The ledger carries the tries made
    and when the next is due: ``retry_wait_s`` after the first, doubled each
    time up to a day; what is not due waits there, unless it arrives again.
    A message that is transient for the ``max_tries``-th time moves to the log at
    ``dead_out`` instead (``read_dead``); if it arrives again later, it starts anew.

    ``dispositions_out`` receives what was decided, before the commit, so a run
    that is done again after its commit need not (and must not) write it.

    ``seen_buckets`` keeps the outcome log in so many buckets of its key
    (``sources.seen_table``), so that a batch too large to broadcast does not
    shuffle the log.  ``cells_out`` receives the run's cells of the reports
    (``plans.report_cells``).

    ``seen_since`` (epoch seconds, e.g. from ``seen_horizon``) limits the
    seen check to outcome rows recorded since then -- older days of the log
    are pruned, not read.  Only pass it when records are written after the
    messages are posted (processing time), so no older record can match."""
    session.configure(spark)
    if max_tries is not None and not dead_out:
        raise ValueError("max_tries needs a table for the messages given up (dead_out)")
    run_id = claim_run(spark, seen_path) if run_id is None else int(run_id)
    evaluator = evaluator or rules_evaluator(threshold=threshold)
    if seen_buckets:
        seen = seen_table.read_bucketed(spark, seen_path, seen_buckets, seen_since)
    else:
        seen = _there(spark, seen_path, first_run, schemas.SEEN_LOG, lambda: read_seen_log(spark, seen_path, seen_since))
    if retry_in:
        pending = spark.read.schema(schemas.RETRY).parquet(retry_in)
        arrivals = arrivals.unionByName(pending.filter(is_due(run_ts)).drop("tries", "due"), allowMissingColumns=True)
    routed_path = session.scratch_path(spark, "routed")
    # no sink uses the message text
    triage_plan(arrivals, seen, evaluator, threshold, allowed=allowed).drop("text").write.parquet(routed_path)
    routed = spark.read.parquet(routed_path)

    if dispositions_out:
        routed.select(
            "chat_id", "msg_id", "source", "disposition", F.col("out_is_vacancy").alias("is_vacancy"), F.col("out_score").alias("score"),
            F.col("out_posted").alias("posted"), F.col("out_title").alias("title")).write.mode("overwrite").parquet(dispositions_out)
    new_seen = state.seen_rows(routed.filter("recorded").select(
        "chat_id", "msg_id", F.col("out_is_vacancy").alias("is_vacancy"), F.col("out_score").alias("score"),
        F.col("out_posted").alias("posted"), F.col("out_title").alias("title"), F.lit(int(run_ts)).alias("ts")))
    day = _day()
    # both logs are partitioned by day of the processing time: readers of
    # recent rows prune old days, and compaction can rewrite day by day
    cards.match_cards(routed).withColumn("ts", F.lit(int(run_ts)).cast("bigint")).select("*", day) \
        .write.mode("append").partitionBy("dt").parquet(matches_path)
    if channels_out:
        channels = no_rows(spark, schemas.CHANNELS)
        if channels_path:
            channels = _there(spark, channels_path, first_run, schemas.CHANNELS, lambda: read_channels(spark, channels_path))
        if registrations is not None:
            channels = state.upsert_channels(channels, registrations)
        state.touch_channels(channels, new_seen).write.mode("overwrite").parquet(channels_out)
    if retry_out:
        ledger = retry_ledger(arrivals, routed, run_ts, retry_wait_s, pending if retry_in else None)
        if max_tries is not None:
            dead = F.col("tries") >= int(max_tries)
            ledger.filter(dead).select("*", F.lit(run_id).cast("bigint").alias("run"), F.to_date(tx.from_epoch(F.lit(int(run_ts)))).alias("dt")) \
                .write.mode("append").partitionBy("dt").parquet(dead_out)
            ledger = ledger.filter(~dead)
        ledger.write.mode("overwrite").parquet(retry_out)
    recorded = new_seen.withColumn("run", F.lit(run_id).cast("bigint"))
    if cells_out:       # against the whole log: an older row of a key may be out of the seen check's reach
        whole = seen_table.read_bucketed(spark, seen_path, seen_buckets) if seen_buckets else table_or_empty(spark, schemas.SEEN_LOG, seen_path)
        report_cells.append_run(spark, cells_out, whole.filter(F.col("run") != run_id), recorded, run_id)
    if seen_buckets:
        seen_table.append_bucketed(recorded.select("*", day), seen_path, seen_buckets)
    else:
        recorded.select("*", day).write.mode("append").partitionBy("dt").parquet(seen_path)
    return TriageResult(routed_path, seen_path, matches_path, channels_out, retry_out, run_id)


# ---- fixed values -------------------------------------------------------------
LONGEST_WAIT_S = 86400      # between two tries of a message
# -------------------------------------------------------------------------------


def is_due(now: int):
    return F.coalesce(F.col("due"), F.lit(0)) <= F.lit(int(now))


def retry_ledger(arrivals: DataFrame, routed: DataFrame, run_ts: int, wait_s: int = 0, pending: DataFrame | None = None) -> DataFrame:
    """What waits for another try after a run: its transient messages (first
    arrivals, one row each) with one try more than in ``pending``, the ledger
    before, and the rows of that ledger which were not due and did not arrive."""
    msg_cols = [f.name for f in schemas.MESSAGES.fields]
    transient = routed.filter(F.col("disposition") == "transient").select(*SEEN_KEY)
    again = dedup.first_arrivals(arrivals.select(*msg_cols).join(transient, SEEN_KEY, "left_semi"))
    if pending is None:
        again = again.withColumn("before", F.lit(0))
    else:
        again = again.join(pending.groupBy(*SEEN_KEY).agg(F.max(F.coalesce("tries", F.lit(0))).alias("before")), SEEN_KEY, "left")
    tries = F.coalesce("before", F.lit(0)) + 1
    wait = F.least(F.lit(float(LONGEST_WAIT_S)), F.lit(float(wait_s)) * F.pow(F.lit(2.0), tries - 1)).cast("bigint")
    ledger = again.select(*msg_cols, tries.cast("int").alias("tries"), (F.lit(int(run_ts)) + wait).alias("due"))
    if pending is not None:
        ledger = ledger.unionByName(pending.filter(~is_due(run_ts)).join(routed.select(*SEEN_KEY), SEEN_KEY, "left_anti"))
    return ledger


def run_backfill(spark: SparkSession, sources: DataFrame, directory: DataFrame, history: DataFrame, cutoff_epoch: int,
                 seen_path: str, matches_path: str, live: DataFrame | None = None, cap: int = msgs.BACKFILL_CAP,
                 date_col: str = "date_s", marks_in: str | None = None, marks_out: str | None = None, **triage) -> TriageResult:
    """The start of the service as one job: resolve the allow-list against the
    directory (an allow-list of which nothing resolves is an error), register
    what resolves, read the history of those chats back to the cutoff, join it
    with the ``live`` messages and triage all of it.  ``triage`` goes to
    ``run_triage``.

    ``marks_out`` receives how far each chat was read (``MARKS``); with that folder
    as ``marks_in`` a later backfill reads only what is newer.  A mark stays
    below the oldest message still transient, so what a full scan would
    try again is read again."""
    resolved, _ = resolve(sources, directory, require_any=True)
    marks = table_or_empty(spark, schemas.MARKS, marks_in) if marks_in else None
    history = msgs.backfill(allowlisted(history, resolved), cutoff_epoch, cap, date_col, marks, resolved)
    arrivals = dedup.union_arrivals(history.limit(0) if live is None else live, history)
    registrations = resolved.select("chat_id", F.col("handle").alias("username"), F.col("handle").alias("title")).distinct()
    result = run_triage(spark, arrivals, seen_path, matches_path, registrations=registrations,
                        allowed=resolved.select("chat_id"), **triage)
    if marks_out:
        msgs.next_marks(history, spark.read.parquet(result.routed_path), cutoff_epoch, marks).write.mode("overwrite").parquet(marks_out)
    return result


def compact_seen(spark: SparkSession, seen_path: str, out_path: str) -> str:
    """Latest row per key of the append log, written as a new table with the
    log's layout (partitioned by day of ``ts``), so later runs append to it.

    The aggregate leaves rows hashed by key, so every task would hold every
    day and write a file per day; ``REBALANCE`` on the day groups each day's
    rows before the write, and AQE splits a large day over several tasks
    (no single task for a hot day), so the file count follows the data."""
    log = read_seen_log(spark, seen_path)
    top = log.agg(F.max("run")).first()[0]
    latest = latest_seen(log).withColumn("run", F.lit(top).cast("bigint"))
    latest.select("*", _day()).hint("rebalance", "dt").write.partitionBy("dt").parquet(out_path)
    return out_path


def compact_days(spark: SparkSession, seen_path: str) -> list[str]:
    """Compact in place only the days of the plain log that hold rows replaced
    since (or written twice); returns those days.  Files of the other days are
    not touched.

    The rows that stay are first written to the shared scratch folder, then they
    replace their days (dynamic partition overwrite), then days of which no row
    stays are removed.  A run that fails between loses nothing that
    is not in that folder, whose name the error carries.  No other run may append
    meanwhile.
    """
    log = spark.read.schema(schemas.T.StructType([*schemas.SEEN_LOG.fields, schemas.T.StructField("dt", schemas.T.DateType())])).parquet(seen_path)
    values = [f.name for f in schemas.SEEN.fields if f.name not in (*SEEN_KEY, "ts")]
    rows = log.groupBy(*SEEN_KEY).agg(F.max(F.struct(F.coalesce("run", F.lit(0)).alias("_order"), "ts", *values, "run", "dt")).alias("w"),
                                      F.count(F.lit(1)).alias("n"), F.collect_set("dt").alias("days"))
    rows = rows.select("*", "w.dt")
    # one row per day that holds a row too many
    dirty = [r["d"] for r in rows.filter("n > 1").select(F.explode("days").alias("d")).distinct().collect()]
    if not dirty:
        return []
    kept = session.scratch_path(spark, "compacted-days")
    rows.filter(F.col("dt").isin(dirty)).select(*SEEN_KEY, *[F.col(f"w.{c}").alias(c) for c in [*values, "ts", "run"]], "dt").hint(
        "rebalance", "dt").write.partitionBy("dt").parquet(kept)
    stay = spark.read.schema(log.schema).parquet(kept)
    try:
        stay.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(seen_path)
        gone = set(dirty) - {r["dt"] for r in stay.select("dt").distinct().collect()}
        for day in gone:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{seen_path}/dt={day}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception as e:
        raise RuntimeError(f"compaction stopped; the rows of the days {sorted(map(str, dirty))} are in {kept}") from e
    return sorted(map(str, dirty))


def _day():
    return F.to_date(tx.from_epoch("ts")).alias("dt")


def seen_horizon(arrivals: DataFrame, margin_s: int = 86400) -> int | None:
    """Earliest record time an outcome row of these messages can have: the
    oldest message date less ``margin_s`` (clock skew), as one aggregate
    over the batch.  None when a message has no date (then the whole
    outcome table must be checked) or the batch is empty."""
    r = arrivals.agg(F.min(F.unix_seconds(F.col("msg_date"))).alias("lo"),
                     F.count(F.when(F.col("msg_date").isNull(), 1)).alias("undated")).first()
    if r is None or r["lo"] is None or r["undated"]:
        return None
    return int(r["lo"]) - int(margin_s)


def _there(spark: SparkSession, path: str, first_run: bool, schema, read: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; only on the first run may there be none."""
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        if not first_run:
            raise FileNotFoundError(f"no table at {path}; pass first_run=True for the run that makes it") from e
    return no_rows(spark, schema)
