"""Triage as a Structured Streaming query.

``drain_to_tables`` is one scheduled run of the live service.  A file-sink
query with a named checkpoint takes the new messages into an inbox (exactly
once, partitioned by the number of the drain), then the batch job (``plans.jobs.run_triage``) handles what is new in
it: it appends the outcome log and the cards, touches the channels and keeps
what is still transient for the next run.  The outcome log is the dedup
state, so it survives restarts, a transient message is scored again when it
arrives again or with the next run, and nothing grows in a state store.  A
run that failed anywhere is made up by the next one.

``triage_stream`` is the plan alone, without those sinks: dispositions of a
stream whose messages arrive once or whose first arrival decides.

No ``foreachBatch``: it would open a callback server in the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import schemas, session
from vetline.functions import text as tx
from vetline.operators import dedup, evaluate, route
from vetline.schemas import SEEN_KEY
from vetline.sources import messages as msgs
from vetline.sources.tables import claim_run, table_or_empty

OUTPUT_COLS = ["chat_id", "msg_id", "source", "disposition", "is_vacancy", "score", "posted", "title"]


def triage_stream(stream: DataFrame, seen: DataFrame, rules: Sequence[evaluate.Rule] = evaluate.FX_RULES,
                  threshold: int = route.DEFAULT_THRESHOLD,
                  evaluator: Callable[[DataFrame, Column], DataFrame] | None = None) -> DataFrame:
    """Streaming plan: one routed row per new message.

    Messages carry no usable event time (late messages are always accepted),
    so no watermark is set: the dedup state keeps every key seen by this
    query, like the outcome table itself (use the RocksDB state store
    provider at scale; it spills to local disk and checkpoints to the shared
    folder; each scheduled ``availableNow`` run starts a fresh checkpoint,
    so the state holds one run's keys).  Keys already in the outcome table
    are removed by the stream-static anti join.

    ``evaluator(df, mask)`` is the batch job's scorer hook (rules by
    default; a user batch scorer runs through ``mapInPandas``, which works
    on a stream too); it is asked only for rows that pass the junk filter.

    Every micro-batch reads ``seen`` again.  Pass
    ``read_seen(spark, path, since_epoch=...)`` with the oldest date a
    message of this query can have (query start for live messages, the
    backfill cutoff for backfilled ones, less a margin): records are written
    after messages are posted, so older days of the log cannot match and are
    pruned from every micro-batch's read.
    """
    n = msgs.normalize(stream).dropDuplicates(SEEN_KEY)
    fresh = dedup.unseen(n, seen).withColumn("worth", tx.worth_evaluating("text"))
    if evaluator is None:
        def evaluator(df, mask):
            return evaluate.evaluate_with_rules(df, rules, threshold=threshold, mask=mask)
    routed = route.route(evaluator(fresh, F.col("worth")), threshold, worth_col="worth")
    return routed.select("chat_id", "msg_id", "source", "disposition",
                         F.col("out_is_vacancy").alias("is_vacancy"), F.col("out_score").alias("score"),
                         F.col("out_posted").alias("posted"), F.col("out_title").alias("title"))


# ---- fixed values ------------------------------------------------------------
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# -------------------------------------------------------------------------------


def run_available_now(spark: SparkSession, plan: DataFrame, name: str, rocksdb_state: bool = True, out: str | None = None) -> str:
    """Drain the stream once into a Parquet folder; returns the folder.
    ``out`` names the run's folder (data and checkpoint): a later run with
    the same one reads only what is new.  Without it the folder is a fresh one
    under the checkpoint root.

    The dedup state of the run lives in the RocksDB state store (off-heap,
    spills to local disk, snapshots to the checkpoint folder), chosen for
    this query only: the session's setting is restored when it ends.
    """
    out = out or session.scratch_path(spark, name)
    old = spark.conf.get(STATE_STORE_KEY, None)
    if rocksdb_state:
        spark.conf.set(STATE_STORE_KEY, ROCKSDB_STATE_STORE)
    try:
        q = (plan.writeStream.format("parquet").outputMode("append")
             .option("path", out + "/data").option("checkpointLocation", out + "/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        if rocksdb_state:
            if old is None:
                spark.conf.unset(STATE_STORE_KEY)
            else:
                spark.conf.set(STATE_STORE_KEY, old)
    if q.exception() is not None:
        raise q.exception()
    return out + "/data"


CONVERSATION_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


INBOX = schemas.T.StructType([*schemas.MESSAGES.fields, schemas.T.StructField("drain", schemas.L)])
DISPOSITIONS = ("chat_id long, msg_id long, source string, disposition string, is_vacancy int, score int, posted int, "
                "title string, run long")
# a row when a drain begins, with its number in the outcome log, and another one when it is over
PROGRESS = "drain long, run long, done boolean"


def _mark(spark: SparkSession, path: str, drain: int, run: int, done: bool) -> None:
    row = spark.range(1).select(F.lit(drain).cast("bigint").alias("drain"), F.lit(run).cast("bigint").alias("run"), F.lit(done).alias("done"))
    row.coalesce(1).write.mode("append").parquet(path)


def drain_to_tables(spark: SparkSession, stream: DataFrame, base: str, seen_path: str, matches_path: str,
                    evaluator: Callable[[DataFrame, Column], DataFrame] | None = None,
                    threshold: int = route.DEFAULT_THRESHOLD, allowed: DataFrame | None = None,
                    channels_path: str | None = None, first_run: bool = False, run_ts: int | None = None,
                    max_tries: int | None = None, retry_wait_s: int = 0) -> int | None:
    """Take what is new in a message stream and triage it into the outcome
    log, the card log and (with ``channels_path``, a folder) channel snapshots;
    returns the drain's number, None when there was nothing to do.

    ``base`` belongs to this stream: offsets, the inbox, and each drain's
    retry ledger, dispositions and progress, and the messages given up after
    ``max_tries`` (folder ``dead``).  ``run_ts`` is the processing time (now).
    ``first_run`` allows for tables not there yet.

    No clock decides what is new: the inbox is partitioned by the number of the
    drain that took a message in, and that number grows only when a drain is over.
    So what a failed drain had taken in, and what the next one adds, is
    triaged together, and a drain reads its own partition only.  A drain that
    failed before its commit (the outcome append) is done again under the same
    run number; one that failed after it only ends: its dispositions, ledger
    and snapshots were written before the commit.
    """
    from vetline.plans import jobs
    session.configure(spark)
    now = int(time.time()) if run_ts is None else int(run_ts)
    progress = f"{base}/progress"
    last = table_or_empty(spark, PROGRESS, progress).agg(
        F.max(F.when(F.col("done"), F.col("drain"))).alias("done"), F.max("drain").alias("begun"), F.max_by("run", "drain").alias("run")).first()
    drain = 0 if last["done"] is None else last["done"] + 1
    claimed = last["run"] if last["begun"] == drain else None
    query = (stream.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MESSAGES.fields],
                           F.lit(drain).cast("bigint").alias("drain"))
             .writeStream.format("parquet").partitionBy("drain").option("path", f"{base}/inbox").option("checkpointLocation", f"{base}/offsets")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    new = table_or_empty(spark, INBOX, f"{base}/inbox").filter(F.col("drain") == drain).drop("drain")
    retry_in = f"{base}/retry/{drain - 1}" if drain else None
    if claimed is None:
        if new.isEmpty() and (retry_in is None or spark.read.schema(schemas.RETRY).parquet(retry_in).filter(jobs.is_due(now)).isEmpty()):
            return None
        run = claim_run(spark, seen_path)
        _mark(spark, progress, drain, run, False)
    else:
        run = claimed
    if claimed is None or table_or_empty(spark, schemas.SEEN_LOG, seen_path).filter(F.col("run") == run).isEmpty():
        jobs.run_triage(
            spark, new, seen_path, matches_path, evaluator, run_ts=now, threshold=threshold, allowed=allowed, run_id=run,
            retry_in=retry_in, retry_out=f"{base}/retry/{drain}", max_tries=max_tries, retry_wait_s=retry_wait_s,
            dead_out=f"{base}/dead", dispositions_out=f"{base}/dispositions/run={drain}", first_run=first_run and not drain,
            channels_path=(f"{channels_path}/run={drain - 1}" if drain else f"{channels_path}/start") if channels_path else None,
            channels_out=f"{channels_path}/run={drain}" if channels_path else None)
    _mark(spark, progress, drain, run, True)
    return drain


def keep_draining(drain: Callable[[], int | None], every_s: float, stop: Callable[[], bool] = lambda: False,
                  clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep) -> int:
    """Live handling: ``drain`` (a call of ``drain_to_tables``) every ``every_s``
    seconds until ``stop`` says so; returns how many drains had something to do.
    A drain that takes longer is followed at once; one that fails ends the loop,
    and the next start goes on where it was."""
    done = 0
    while not stop():
        began = clock()
        done += drain() is not None
        rest = every_s - (clock() - began)
        if rest > 0 and not stop():
            wait(rest)
    return done


def read_dispositions(spark: SparkSession, base: str) -> DataFrame:
    """What the runs of a drained stream decided (column ``run``)."""
    return spark.read.schema(DISPOSITIONS).parquet(f"{base}/dispositions")


def conversation_stream(spark: SparkSession, path: str, max_files_per_trigger: int = msgs.MAX_FILES_PER_TRIGGER) -> DataFrame:
    """The conversations table at ``path`` (a file, or a folder of part files)
    read as a file stream, shaped as messages: ``chat_id = conv_id``, ``msg_id
    = turn``.  A micro-batch reads ``max_files_per_trigger`` new files at most."""
    return as_messages(spark.readStream.schema(CONVERSATION_SCHEMA)
                       .option("maxFilesPerTrigger", int(max_files_per_trigger)).parquet(path))


def as_messages(conv: DataFrame) -> DataFrame:
    return conv.select(
        F.col("conv_id").alias("chat_id"), F.col("turn").alias("msg_id"),
        F.lit(None).cast("timestamp").alias("msg_date"), "text",
        F.lit(None).cast("string").alias("chat_title"), F.lit(None).cast("string").alias("chat_username"),
        F.lit(None).cast("string").alias("chat_first_name"), F.lit("live").alias("source"))


def first_turns_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome keys of an earlier run: the opening turn of every conversation."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return c.filter(F.col("turn") == 0).select(F.col("conv_id").alias("chat_id"), F.col("turn").alias("msg_id"))
