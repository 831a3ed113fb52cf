"""Outcome and channel tables with upsert semantics, as aggregate plans.

Parquet has no in-place update; the outcome table is an append log read
latest-wins (compaction rewrites it).  A batch of new outcome rows,
registrations or touches is reduced per key first, then joined once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline import schemas
from vetline.schemas import SEEN_KEY
from vetline.sources.tables import conform

SEEN_VALUE_COLS = ["is_vacancy", "score", "posted", "title"]


def seen_rows(outcomes: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Project routed outcomes to the outcome-table schema (K1 row shape).

    Booleans become 0/1 with NULL kept; ``posted`` defaults to 0; rows with a
    NULL key are not recordable and are left out.
    """
    def flag(c):
        return F.when(F.col(c).isNull(), F.lit(None)).when(F.col(c).cast("boolean"), 1).otherwise(0)

    return outcomes.filter(F.col("chat_id").isNotNull() & F.col("msg_id").isNotNull()).select(
        "chat_id", "msg_id",
        flag("is_vacancy").cast("int").alias("is_vacancy"),
        F.col("score").cast("int").alias("score"),
        F.coalesce(flag("posted"), F.lit(0)).cast("int").alias("posted"),
        F.col("title").cast("string").alias("title"),
        F.col(ts_col).cast("bigint").alias("ts"),
    )


def rejected_outcomes(outcomes: DataFrame) -> DataFrame:
    """Outcome rows that cannot be recorded, with the ``reason``: the key
    columns of the outcome table may not be NULL."""
    return outcomes.filter(F.col("chat_id").isNull() | F.col("msg_id").isNull()).withColumn(
        "reason", F.when(F.col("chat_id").isNull(), F.lit("chat_id is null")).otherwise(F.lit("msg_id is null")))


def upsert_seen(current: DataFrame, *batches: DataFrame) -> DataFrame:
    """Insert-or-replace by ``(chat_id, msg_id)``: the latest write replaces all
    columns.  Later batches win over earlier ones at equal ``ts``; a batch
    row wins over the current row at equal ``ts``.

    The batches are reduced to their latest row per key, then one full outer
    join reads the outcome table once.
    """
    cur = conform(current, schemas.SEEN)
    log = None
    for i, b in enumerate(batches, start=1):
        part = conform(b, schemas.SEEN).withColumn("_batch", F.lit(i))
        log = part if log is None else log.unionByName(part)
    if log is None:
        return cur
    values = SEEN_VALUE_COLS + ["ts"]
    side = latest_per_key(log, keep_order=True).select(
        *SEEN_KEY, *[F.col(c).alias(f"_b_{c}") for c in values + ["_batch"]])
    here = cur.withColumn("_here", F.lit(True))
    j = here.join(side, SEEN_KEY, "full")
    take = F.col("_b__batch").isNotNull() & (F.col("_here").isNull() | F.col("ts").isNull()
                                             | F.coalesce(F.col("_b_ts") >= F.col("ts"), F.lit(False)))
    return j.select(*SEEN_KEY, *[F.when(take, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) for c in values])


def latest_per_key(log: DataFrame, order_cols=("run", "ts", "_batch"), keep_order: bool = False) -> DataFrame:
    """Latest row per key of an append log (max over an ordering struct).  The
    row of the latest ``run`` wins; values decide only among rows of one key,
    run and time, which one run never writes."""
    order = [c for c in order_cols if c in log.columns]
    w = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in SEEN_VALUE_COLS])).alias("w")
    extra = [F.col(f"w.{c}").alias(c) for c in order if c != "ts"] if keep_order else []
    return (log.groupBy("chat_id", "msg_id").agg(w)
            .select("chat_id", "msg_id", *[F.col(f"w.{c}").alias(c) for c in SEEN_VALUE_COLS],
                    F.col("w.ts").alias("ts"), *extra))


def upsert_channels(current: DataFrame, registrations: DataFrame) -> DataFrame:
    """Insert; on conflict replace ``username`` and ``title`` (even by NULL)
    and keep ``last_msg_ts``.  Among several registrations of one chat the one
    with the highest ``seq`` (if given) wins."""
    reg = registrations.withColumn("_seq", F.col("seq") if "seq" in registrations.columns else F.lit(0))
    old = conform(current, schemas.CHANNELS).select(
        "chat_id", F.lit(0).alias("_src"), F.lit(0).alias("_seq"), "username", "title", "last_msg_ts")
    new = reg.select("chat_id", F.lit(1).alias("_src"), F.col("_seq").cast("int").alias("_seq"),
                     F.col("username").cast("string"), F.col("title").cast("string"),
                     F.lit(None).cast("bigint").alias("last_msg_ts"))
    return (old.unionByName(new).filter(F.col("chat_id").isNotNull())
            .groupBy("chat_id")
            .agg(F.max(F.struct("_src", "_seq", "username", "title")).alias("w"),
                 F.max("last_msg_ts").alias("last_msg_ts"))
            .select("chat_id", F.col("w.username").alias("username"), F.col("w.title").alias("title"),
                    "last_msg_ts"))


def touch_channels(channels: DataFrame, touched: DataFrame) -> DataFrame:
    """Set ``last_msg_ts`` to the newest ``ts`` recorded for each channel;
    messages of unregistered chats change nothing.

    The touches (one row per recorded message) are reduced to one row per
    chat by a hash aggregate (partial per partition, so a busy chat collapses
    map-side), then joined to the channel dimension."""
    t = touched.groupBy("chat_id").agg(F.max(F.col("ts").cast("bigint")).alias("_t"))
    ch = conform(channels, schemas.CHANNELS)
    return (ch.join(t, "chat_id", "left")
            .select("chat_id", "username", "title", F.greatest("last_msg_ts", "_t").alias("last_msg_ts")))
