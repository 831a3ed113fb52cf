"""Reports kept up to date run by run.

A cell counts the outcome rows of one (run time, chat, vacancy flag, posted
flag, score).  Cells are sums, so those of a run are added to those before; a
row that replaces an earlier one of its key takes that one out again, as a count
of -1.  A run needs only the log's rows of its own keys for that.  The reports of
``plans.reports`` follow from the cells alone: counts, averages and, scores
being few, exact maxima, which could not be taken back from a kept maximum.

One run gives a chat as many cells as it has different outcomes (303 kinds at
most), however many messages those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import schemas
from vetline.schemas import SEEN_KEY
from vetline.sources.tables import conform, latest_seen, table_or_empty

CELL = ["ts", "chat_id", "is_vacancy", "posted", "score"]
CELLS = schemas.T.StructType([f for name in CELL for f in schemas.SEEN.fields if f.name == name]
                             + [schemas.T.StructField("n", schemas.L)])


def cells_of(rows: DataFrame, sign: int = 1) -> DataFrame:
    return rows.groupBy(*CELL).agg((F.count(F.lit(1)) * sign).alias("n"))


def summed(*cells: DataFrame) -> DataFrame:
    """Cells added up; what is zero goes."""
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    return out.groupBy(*CELL).agg(F.sum("n").alias("n")).filter("n <> 0")


def cells_of_run(log_before: DataFrame, new_rows: DataFrame) -> DataFrame:
    """What a run changes: the latest rows of its keys with it, less those
    without it.  A replayed row that loses against a later run changes nothing;
    rows written again by the same run are counted once."""
    new_rows = conform(new_rows, schemas.SEEN_LOG)
    keys = new_rows.select(*SEEN_KEY).distinct()
    touched = conform(log_before, schemas.SEEN_LOG).join(keys, SEEN_KEY, "left_semi")
    return summed(cells_of(latest_seen(touched.unionByName(new_rows))), cells_of(latest_seen(touched), -1))


def append_run(spark: SparkSession, path: str, log_before: DataFrame, new_rows: DataFrame, run: int) -> None:
    """Add a run's cells to the table at ``path``; a run done again replaces its own."""
    cells_of_run(log_before, new_rows).write.mode("overwrite").parquet(f"{path}/run={int(run)}")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return summed(table_or_empty(spark, CELLS, path))


def compact_cells(spark: SparkSession, path: str, out_path: str) -> int:
    """All runs so far as one, written anew as run ``upto``; later runs are appended there."""
    upto = table_or_empty(spark, schemas.T.StructType([*CELLS.fields, schemas.T.StructField("run", schemas.L)]), path).agg(F.max("run")).first()[0]
    read_cells(spark, path).write.parquet(f"{out_path}/run={upto}")
    return upto


def _n(cond) -> F.Column:
    return F.coalesce(F.sum(F.when(cond, F.col("n")).otherwise(0)), F.lit(0)).cast("bigint")


def overall_stats(cells: DataFrame) -> DataFrame:
    """As ``reports.overall_stats``."""
    return cells.agg(_n(F.lit(True)).alias("total"), _n(F.col("is_vacancy") == 1).alias("vacancies"),
                     _n(F.col("is_vacancy") == 0).alias("not_vacancies"), _n(F.col("posted") == 1).alias("posted"),
                     F.max("ts").cast("bigint").alias("last_ts"))


def channel_stats(channels: DataFrame, cells: DataFrame) -> DataFrame:
    """As ``reports.channel_stats``, unordered."""
    vac = F.col("is_vacancy") == 1
    scored = vac & F.col("score").isNotNull()
    per_chat = cells.groupBy("chat_id").agg(
        _n(F.lit(True)).alias("_total"), _n(vac).alias("_vac"), _n(F.col("posted") == 1).alias("_posted"),
        (F.sum(F.when(scored, F.col("n") * F.col("score"))) / F.sum(F.when(scored, F.col("n")))).alias("_avg"),
        F.max(F.when(vac, F.col("score")).otherwise(0)).alias("_max"))
    zero = F.lit(0).cast("bigint")
    return channels.select("chat_id", "username", "title", "last_msg_ts").join(per_chat, "chat_id", "left").select(
        "chat_id", "username", "title", "last_msg_ts", F.coalesce("_total", zero).alias("total"), F.coalesce("_vac", zero).alias("vacancies"),
        F.coalesce("_posted", zero).alias("posted"), F.round("_avg", 1).alias("avg_score"), F.coalesce("_max", F.lit(0)).cast("int").alias("max_score"))
