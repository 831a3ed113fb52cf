"""Deduplication against the outcome table (J1/J2) and within a batch (U1).

``seen`` is keyed by (chat_id, msg_id); both the anti and the semi join hash
on the pair, which spreads even a very busy channel over all partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetline.schemas import SEEN_KEY

# ---- fixed values ------------------------------------------------------------
# Which arrival of a message is processed when it arrives more than once in a
# batch: live before backfill (the live handler is registered first).
SOURCE_RANK = {"live": 0, "backfill": 1}
# -------------------------------------------------------------------------------


def _source_rank():
    r = F.lit(len(SOURCE_RANK))
    for s, i in sorted(SOURCE_RANK.items(), key=lambda kv: -kv[1]):
        r = F.when(F.col("source") == s, F.lit(i)).otherwise(r)
    return r


def union_arrivals(live: DataFrame, backfill: DataFrame) -> DataFrame:
    """Live and backfill messages as one frame tagged with ``source``."""
    return (live.withColumn("source", F.lit("live"))
            .unionByName(backfill.withColumn("source", F.lit("backfill")), allowMissingColumns=True))


def mark_primary(arrivals: DataFrame) -> DataFrame:
    """Flag one arrival per key as ``primary`` (live first, then the oldest
    date, then the lowest text); the rest are in-batch duplicates."""
    w = Window.partitionBy(*SEEN_KEY).orderBy(_source_rank(), F.col("msg_date").asc_nulls_last(),
                                              F.col("text").asc_nulls_last())
    return arrivals.withColumn("primary", F.row_number().over(w) == 1)


def arrival_counts(arrivals: DataFrame) -> DataFrame:
    """Per (key, source): ``n`` arrivals, of which ``n_primary`` (0 or 1) is
    the one processed; the rest are in-batch duplicates.

    Counts ``mark_primary`` would give without ranking every arrival: copies
    collapse in a partial aggregate before the shuffle (a message arriving
    millions of times costs one row per map partition), and the primary
    source per key is then picked over at most one row per source.  Sources
    of equal rank are ordered by name."""
    per_source = arrivals.groupBy(*SEEN_KEY, "source").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(_source_rank().alias("r"), F.col("source").alias("s"))
    best = F.min(rank).over(Window.partitionBy(*SEEN_KEY))
    is_primary = F.coalesce(best == rank, F.lit(False))
    return per_source.withColumn("n_primary", F.when(is_primary, 1).otherwise(0).cast("bigint"))


def first_arrivals(arrivals: DataFrame) -> DataFrame:
    """One row per key.  ``row_number() = 1`` is planned with a partial
    per-partition group limit before the shuffle, so duplicates are dropped
    map-side."""
    w = Window.partitionBy(*SEEN_KEY).orderBy(_source_rank(), F.col("msg_date").asc_nulls_last(),
                                              F.col("text").asc_nulls_last())
    return arrivals.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def seen_keys(seen: DataFrame) -> DataFrame:
    """Distinct keys of the outcome table.  An append log may hold many rows
    of one key; the partial aggregate collapses them map-side, and the join
    that follows reuses its hash partitioning on the key (no extra shuffle),
    so no task receives all copies of one key."""
    return seen.select(*SEEN_KEY).distinct()


def unseen(messages: DataFrame, seen: DataFrame) -> DataFrame:
    """Messages whose key is not in the outcome table (left anti)."""
    return messages.join(seen_keys(seen), SEEN_KEY, "left_anti")


def already_seen(messages: DataFrame, seen: DataFrame) -> DataFrame:
    """Messages whose key is in the outcome table (left semi): ``dedup_skip``."""
    return messages.join(seen_keys(seen), SEEN_KEY, "left_semi")


def flag_seen(messages: DataFrame, seen: DataFrame, candidate_keys: DataFrame | None = None) -> DataFrame:
    """Add ``in_seen``: whether the key is already in the outcome table.

    One keyed left join instead of an anti plus a semi join.  The outcome
    table is the largest input and grows with every run.  ``candidate_keys``
    (e.g. the key columns of the raw arrivals scan) lets it go through a semi
    join first, so that only keys of this batch are made distinct and joined
    back; the planner broadcasts the candidates, or shuffles, by their bytes
    (from the scan's statistics, or at run time).
    """
    keys = seen.select(*SEEN_KEY)
    if candidate_keys is not None:
        keys = keys.join(candidate_keys.select(*SEEN_KEY), SEEN_KEY, "left_semi")
    keys = keys.distinct().withColumn("in_seen", F.lit(True))
    return (messages.join(keys, SEEN_KEY, "left")
            .withColumn("in_seen", F.coalesce(F.col("in_seen"), F.lit(False))))
