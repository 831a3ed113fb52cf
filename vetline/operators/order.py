"""Consecutive positions in a total order, without a single-task window.

``row_number() over (order by ...)`` with no partition moves every row into
one task.  Here the rows are range-sorted (each partition holds one slice of
the order), the sorted result is checkpointed once to the shared checkpoint
folder (so partition contents and their order are fixed, also when a task is
re-run after an executor loss), and a row's position is the number of rows in
the partitions before its own -- one count per partition, a table bounded by
the partition count -- plus its index inside its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetline import session

# one offset row per partition is broadcast; far above any real partition count
MAX_PARTITIONS = 1_000_000


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """``df`` plus ``name``: 1, 2, ... in the given (total) order.  Executes
    the sort once (eager checkpoint); the result keeps the sorted layout
    (partition i holds the i-th slice, in order), as the offsets are joined
    by broadcast without another shuffle."""
    session.checkpoint_root(df.sparkSession)
    fixed = df.orderBy(*order).checkpoint(eager=True)
    n_parts = fixed.rdd.getNumPartitions()
    if n_parts > MAX_PARTITIONS:
        raise RuntimeError(f"ranked(): {n_parts} partitions exceed {MAX_PARTITIONS}")
    pid = F.spark_partition_id()
    # monotonically_increasing_id = partition index << 33 | index inside the partition
    local = fixed.select("*", pid.alias("_pid"),
                         (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("_pos"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_pos") + 1).cast("bigint").alias(name)))
