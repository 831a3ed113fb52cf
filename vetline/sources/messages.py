"""Message ingest: batch/stream reads, normalisation, bounded backfill scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetline import schemas
from vetline.functions import text as tx

# ---- fixed values ------------------------------------------------------------
BACKFILL_CAP = 200        # newest messages read per source
# -------------------------------------------------------------------------------
MAX_FILES_PER_TRIGGER = 1000
BACKFILL_SALTS = 32       # tasks over which the newest messages of one chat are first looked for


def read_messages(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Messages in Parquet under ``path``, with the fixed schema (no
    inference); ``streaming`` gives the Structured Streaming source.

    A stream reads at most ``max_files_per_trigger`` new files per
    micro-batch (``availableNow`` still drains everything, batch by batch),
    which bounds a micro-batch -- and with it the copies of one message that
    the streaming dedup sends to one task."""
    if streaming:
        return (spark.readStream.schema(schemas.MESSAGES)
                .option("maxFilesPerTrigger", int(max_files_per_trigger)).parquet(path))
    return spark.read.schema(schemas.MESSAGES).parquet(path)


def messages_from_records(records: DataFrame, value_col: str = "value", time_col: str | None = "timestamp",
                          source: str = "live") -> DataFrame:
    """Messages from a record stream of JSON values, e.g. the ``value`` bytes
    of ``spark.readStream.format("kafka")`` (the connector package is needed
    on the cluster) -- one JSON object per record with the message fields.
    Parsed with the fixed schema (no inference); a record without a message
    date takes the record time; ``source`` defaults to ``live``.  A record
    that is not a message (malformed JSON, or no ``chat_id``/``msg_id``) has
    no key to dedup or record by: ``rejected_records`` returns those, with
    the reason.  Works on a stream or a batch alike."""
    body = F.from_json(F.col(value_col).cast("string"), schemas.MESSAGES).alias("m")
    has_time = time_col is not None and time_col in records.columns
    out = records.select(body, *([F.col(time_col).alias("_rec_ts")] if has_time else [])).select("m.*", *(
        ["_rec_ts"] if has_time else []))
    cols = {"source": F.coalesce(F.col("source"), F.lit(source))}
    if has_time:
        cols["msg_date"] = F.coalesce(F.col("msg_date"), F.col("_rec_ts").cast("timestamp"))
    return (out.filter(F.col("chat_id").isNotNull() & F.col("msg_id").isNotNull())
            .withColumns(cols).select(*[f.name for f in schemas.MESSAGES.fields]))


def rejected_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """The records ``messages_from_records`` cannot use: the columns of
    ``records`` and the ``reason``, for a rejects table."""
    body = F.from_json(F.col(value_col).cast("string"), schemas.MESSAGES)
    m = records.withColumn("_m", body)
    reason = (F.when(F.col("_m").isNull() | (F.col("_m.chat_id").isNull() & F.col("_m.msg_id").isNull()), F.lit("not a message"))
              .when(F.col("_m.chat_id").isNull(), F.lit("chat_id is missing"))
              .when(F.col("_m.msg_id").isNull(), F.lit("msg_id is missing")))
    return m.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_m")


def normalize(messages: DataFrame) -> DataFrame:
    """Stripped text (NULL -> ''), display title, and text length."""
    return messages.withColumns({
        "text": tx.strip_ws("text"),
        # live messages title their chat by title/username/first name; the
        # backfill scan by the source entity's title/username/id
        "chat_title": F.when(F.col("source") == "backfill",
                             tx.backfill_title("chat_title", "chat_username", "chat_id"))
                       .otherwise(tx.chat_title("chat_title", "chat_username", "chat_first_name", "chat_id")),
    }).withColumn("n_chars", F.length("text").cast("bigint"))


def backfill(messages: DataFrame, cutoff_epoch: int | None, cap: int = BACKFILL_CAP,
             date_col: str = "date_s", marks: DataFrame | None = None, chats: DataFrame | None = None) -> DataFrame:
    """Per chat, newest first: take messages *until* the first one older than
    the cutoff (a prefix, not a filter: an old message hides everything older
    in id order), reading at most ``cap`` messages.  NULL dates pass.

    Plan: ``row_number() <= cap`` is planned with a per-partition group limit
    before the shuffle, so even a chat holding a third of all rows sends at
    most ``cap`` rows per map partition.  It is taken in two steps, first per
    chat and salt, so that those rows of a hot chat meet in ``BACKFILL_SALTS``
    tasks and only ``cap`` rows of each in one.  The stop point (newest old
    message among the ``cap`` newest) is then a window over at most ``cap``
    rows on the same partitioning, with no join back to the input.

    ``marks`` (``MARKS``: how far each chat was read before) leaves out what is
    not newer: the marks, one row per chat, join the scan, and their least message
    id goes to it as a filter, which skips row groups of a history in order of
    ids.  A mark made at a later cutoff than this one does not count.  What is
    left of a chat gives the same new messages as the whole: those at or below
    the mark among its ``cap`` newest were read before.  ``chats`` are the chats
    that ``messages`` may hold (default: looked up in them).
    """
    if cutoff_epoch is None:
        return messages.limit(0)
    if marks is not None:
        messages = _newer(messages, marks, int(cutoff_epoch), chats)
    salt = F.pmod(F.xxhash64("msg_id"), F.lit(BACKFILL_SALTS))
    salted = messages.withColumn("_salt", salt)
    newest = F.col("msg_id").desc()
    some = salted.withColumn("_rn", F.row_number().over(Window.partitionBy("chat_id", "_salt").orderBy(newest))).filter(
        F.col("_rn") <= int(cap)).drop("_rn", "_salt")
    head = some.withColumn("_rn", F.row_number().over(Window.partitionBy("chat_id").orderBy(newest))).filter(F.col("_rn") <= int(cap))
    old = F.col(date_col) < F.lit(int(cutoff_epoch))
    stop = F.max(F.when(old, F.col("msg_id"))).over(Window.partitionBy("chat_id"))
    return (head.withColumn("_stop", stop)
            .filter(F.col("_stop").isNull() | (F.col("msg_id") > F.col("_stop")))
            .drop("_rn", "_stop"))


def _newer(messages: DataFrame, marks: DataFrame, cutoff_epoch: int, chats: DataFrame | None) -> DataFrame:
    valid = marks.filter(F.col("cutoff") <= cutoff_epoch).groupBy("chat_id").agg(F.max("msg_id").alias("_mark"))
    low = valid.agg(F.min("_mark"), F.count("*")).first()
    if not low[1]:
        return messages
    # chats without a mark are read whole, so the filter on the scan holds only where every chat has one
    here = (messages if chats is None else chats).select("chat_id").distinct()
    if here.join(valid, "chat_id", "left_anti").isEmpty():
        messages = messages.filter(F.col("msg_id") > F.lit(low[0]))
    return messages.join(valid, "chat_id", "left").filter(F.col("_mark").isNull() | (F.col("msg_id") > F.col("_mark"))).drop("_mark")


def next_marks(taken: DataFrame, routed: DataFrame, cutoff_epoch: int, before: DataFrame | None = None) -> DataFrame:
    """How far each chat has been read after a backfill took ``taken``: its
    newest message, or the one before its oldest transient message of ``routed``;
    chats of which nothing was taken keep the mark ``before``."""
    waiting = routed.filter(F.col("disposition") == "transient").groupBy("chat_id").agg((F.min("msg_id") - 1).alias("_below"))
    top = taken.groupBy("chat_id").agg(F.max("msg_id").alias("_top"))
    new = top.join(waiting, "chat_id", "left").select("chat_id", F.least("_top", "_below").alias("msg_id"), F.lit(int(cutoff_epoch)).alias("cutoff"))
    if before is None:
        return new
    old = before.filter(F.col("cutoff") <= int(cutoff_epoch)).groupBy("chat_id").agg(F.max("msg_id").alias("msg_id"))
    return new.unionByName(old.join(new.select("chat_id"), "chat_id", "left_anti").withColumn("cutoff", F.lit(int(cutoff_epoch))))
