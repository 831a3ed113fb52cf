"""The outcome log as a bucketed table.

The seen check joins a run's keys with the whole log.  Kept in buckets of the
key, the log is read as it lies: a batch too large to broadcast is shuffled
into the log's buckets, and the log is not shuffled at all.  The files are those
of the plain log (Parquet by day), so everything that reads the folder goes on
working.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import schemas
from vetline.schemas import SEEN_KEY
from vetline.sources.tables import _since, conform, table_or_empty

BUCKETS = 512           # of a large log; a bucket of a day is one file for each run that writes it, until it is compacted


def open_seen(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """The table over the folder at ``path``, made where it is not there;
    returns its name.  The count of buckets is written beside the folder when it
    is made: files of one count read with another would be joined wrongly, so
    another one is an error."""
    kept = [r["n"] for r in table_or_empty(spark, "made boolean, n int", f"{path}_buckets").select("n").distinct().collect()]
    if not kept:
        if not table_or_empty(spark, schemas.SEEN_LOG, path).isEmpty():
            raise ValueError(f"the log at {path} is not in buckets; write it anew (rebucket)")
        spark.range(1).select(F.lit(True).alias("made")).coalesce(1).write.mode("errorifexists").parquet(f"{path}_buckets/n={int(buckets)}")
    elif kept != [int(buckets)]:
        raise ValueError(f"the log at {path} lies in {kept} buckets, not in {buckets}")
    name = "vetline_seen_" + hashlib.md5(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SEEN_LOG.fields)
        key = ", ".join(SEEN_KEY)
        at = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}, dt DATE) USING parquet PARTITIONED BY (dt) CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {int(buckets)} BUCKETS LOCATION '{at}'")
        if not table_or_empty(spark, schemas.SEEN_LOG, path).isEmpty():
            spark.sql(f"MSCK REPAIR TABLE {name}")      # the days that are there
    return name


def read_bucketed(spark: SparkSession, path: str, buckets: int = BUCKETS, since_epoch: int | None = None) -> DataFrame:
    return conform(_since(spark.table(open_seen(spark, path, buckets)), since_epoch), schemas.SEEN_LOG)


def append_bucketed(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append ``SEEN_LOG`` rows with their day ``dt``: dealt by the key into
    as many tasks as buckets, each of which writes one file a day."""
    name = open_seen(rows.sparkSession, path, buckets)
    cols = [f.name for f in schemas.SEEN_LOG.fields]
    rows.select(*cols, "dt").repartition(int(buckets), *SEEN_KEY).write.insertInto(name)


def rebucket(log: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A log (with ``ts``) written as a new bucketed one."""
    from vetline.functions.text import from_epoch
    append_bucketed(conform(log, schemas.SEEN_LOG).withColumn("dt", F.to_date(from_epoch("ts"))), path, buckets)
