"""Typed reads of the outcome/channel tables, with additive schema evolution."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetline import schemas
from vetline.functions.text import from_epoch


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_or_empty(spark: SparkSession, schema, path: str) -> DataFrame:
    """A table with its fixed schema; empty before anything was written to ``path``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return no_rows(spark, schema)


def no_rows(spark: SparkSession, schema) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so nothing runs for it."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(1).select([F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where("false")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a target schema; columns the frame lacks become NULL.

    This is the additive migration of the outcome table: rows written before
    ``is_vacancy`` and ``title`` existed read back with NULL there.
    """
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def evolve(*frames: DataFrame, schema: T.StructType = schemas.SEEN) -> DataFrame:
    """Union frames written under different schema versions into ``schema``."""
    out = None
    for df in frames:
        df = conform(df, schema)
        out = df if out is None else out.unionByName(df)
    return out


def _since(df: DataFrame, since_epoch: int | None) -> DataFrame:
    if since_epoch is None:
        return df
    cond = F.col("ts") >= F.lit(int(since_epoch))
    if "dt" in df.columns:
        cond = (F.col("dt") >= F.to_date(from_epoch(F.lit(int(since_epoch))))) & cond
    return df.filter(cond)


def read_seen_log(spark: SparkSession, path: str, since_epoch: int | None = None) -> DataFrame:
    """The append log at ``path`` as written, replayed rows included, with
    its fixed schema: columns that older files lack read back NULL.  No schema
    inference or footer merge over the (many) files of the log.

    With ``since_epoch`` only rows recorded at or after it are read; on the
    day-partitioned log that is a partition filter (older days are not
    listed or opened), else a pushed ``ts`` filter."""
    return conform(_since(spark.read.schema(schemas.SEEN_LOG).parquet(path), since_epoch), schemas.SEEN_LOG)


def read_seen(spark: SparkSession, path: str, since_epoch: int | None = None) -> DataFrame:
    """The outcome table: the latest row of each key of the log (what reports
    read).  A seen check needs keys only and can read the log itself."""
    return latest_seen(read_seen_log(spark, path, since_epoch))


def latest_seen(log: DataFrame) -> DataFrame:
    """The row written last for each key: of the latest run, then time.  The
    aggregate is partial per partition, so copies collapse before the shuffle."""
    values = [f.name for f in schemas.SEEN.fields if f.name not in (*schemas.SEEN_KEY, "ts")]
    order = [F.coalesce(F.col("run"), F.lit(0)).alias("run"), F.col("ts")]
    return (log.groupBy(*schemas.SEEN_KEY).agg(F.max(F.struct(*order, *values)).alias("w"))
            .select(*schemas.SEEN_KEY, *[F.col(f"w.{c}").alias(c) for c in [*values, "ts"]]))


def claim_run(spark: SparkSession, seen_path: str) -> int:
    """The next run number of the outcome log at ``seen_path``, claimed in the
    folder beside it: one more than any run before, whatever the clock says.
    Two drivers that claim at once do not get one number: the second write
    fails."""
    claims = f"{seen_path}_runs"
    last = table_or_empty(spark, "claimed boolean, run long", claims).agg(F.max("run")).first()[0]
    if last is None:        # a log from before there were claims
        last = table_or_empty(spark, schemas.SEEN_LOG, seen_path).agg(F.max("run")).first()[0]
    run = 1 if last is None else int(last) + 1
    spark.range(1).select(F.lit(True).alias("claimed")).coalesce(1).write.mode("errorifexists").parquet(f"{claims}/run={run}")
    return run


def read_dead(spark: SparkSession, path: str) -> DataFrame:
    """The messages given up after their last try, one row each (a run done
    again may write a message twice)."""
    cols = [f.name for f in schemas.RETRY.fields if f.name not in schemas.SEEN_KEY]
    df = spark.read.schema(schemas.T.StructType([*schemas.RETRY.fields, schemas.T.StructField("run", schemas.L)])).parquet(path)
    return (df.groupBy(*schemas.SEEN_KEY).agg(F.max(F.struct("run", "tries", "due", *[c for c in cols if c not in ("tries", "due")])).alias("w"))
            .select(*schemas.SEEN_KEY, "w.*"))


def read_matches(spark: SparkSession, path: str, since_epoch: int | None = None) -> DataFrame:
    """The match (card) sink for a consumer that delivers cards: one row per
    message.  The sink is at-least-once (a re-run after a failed job appends
    the same cards again); the latest card per key is kept by an aggregate
    (partial per partition, so copies collapse before the shuffle).  With
    ``since_epoch`` only days since then are read (partition filter)."""
    df = _since(spark.read.schema(schemas.MATCHES).parquet(path), since_epoch)
    cols = [f.name for f in schemas.MATCHES.fields if f.name not in schemas.SEEN_KEY]
    latest = F.max(F.struct(F.col("ts"), *[F.col(c) for c in cols if c != "ts"])).alias("w")
    return (df.groupBy(*schemas.SEEN_KEY).agg(latest)
            .select(*schemas.SEEN_KEY, *[F.col(f"w.{c}").alias(c) for c in cols]))


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.schema(schemas.CHANNELS).parquet(path), schemas.CHANNELS)
