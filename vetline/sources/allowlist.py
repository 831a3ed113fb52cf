"""The source allow-list: load, normalise, resolve against a chat directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.functions.text import PY_WHITESPACE


def _handle_key(c: Column) -> Column:
    """Handles resolve case-insensitively, with or without a leading '@'."""
    return F.lower(F.regexp_replace(c, "^@", ""))


def normalize_entries(entries: DataFrame, entry_col: str = "entry", pos_col: str = "pos") -> DataFrame:
    """One JSON value per row -> (pos, kind, username, chat_id).

    Integers (JSON booleans count as 0/1, as Python's bool is an int) are chat
    ids; strings are stripped handles and must not be blank; anything else is
    ``invalid``.
    """
    v = F.try_parse_json(F.col(entry_col))
    t = F.schema_of_variant(v)
    is_int = t.isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    s = F.btrim(F.expr(f"try_variant_get(try_parse_json({entry_col}), '$', 'string')"), F.lit(PY_WHITESPACE))
    as_long = F.expr(f"try_variant_get(try_parse_json({entry_col}), '$', 'bigint')")
    as_bool = F.expr(f"try_variant_get(try_parse_json({entry_col}), '$', 'boolean')")
    kind = (F.when(is_int, F.lit("id")).when(t == "BOOLEAN", F.lit("id"))
            .when((t == "STRING") & (F.length(s) > 0), F.lit("handle")).otherwise(F.lit("invalid")))
    return entries.select(
        F.col(pos_col).alias("pos"), kind.alias("kind"),
        F.when(kind == "handle", s).alias("username"),
        F.when(is_int, as_long).when(t == "BOOLEAN", F.when(as_bool, 1).otherwise(0))
         .cast("bigint").alias("chat_id"),
    )


def load_sources(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read ``{"chats": [...]}``; require a non-empty array; with ``strict``
    any invalid entry fails the job (the service refuses to start on it)."""
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    arr = doc.select(F.expr("try_variant_get(v, '$.chats', 'array<variant>')").alias("a"))
    arr = arr.select(F.when(F.coalesce(F.size("a"), F.lit(0)) > 0, F.col("a"))
                     .otherwise(F.raise_error(F.lit(f"{path} must contain a non-empty 'chats' array"))).alias("a"))
    entries = arr.select(F.posexplode("a").alias("pos", "e")).select("pos", F.to_json("e").alias("entry"))
    out = normalize_entries(entries)
    if strict:
        out = out.withColumn("kind", F.when(F.col("kind") != "invalid", F.col("kind"))
                             .otherwise(F.raise_error(F.concat(F.lit(f"Invalid source entry in {path} at "),
                                                               F.col("pos").cast("string")))))
    return out


def resolve(sources: DataFrame, directory: DataFrame, require_any: bool = False) -> tuple[DataFrame, DataFrame]:
    """Match valid allow-list entries to the chat directory (chat_id, handle):
    handles by case-folded name, ids by chat id.  Returns (resolved, unresolved).

    The planner chooses the joins by the sides' bytes.  With ``require_any`` an allow-list
    of which nothing resolves is an error.
    """
    valid = sources.filter(F.col("kind") != "invalid")
    d = directory.select("chat_id", "handle", _handle_key(F.col("handle")).alias("hkey"))
    by_handle = (d.join(valid.filter(F.col("kind") == "handle")
                        .select("pos", _handle_key(F.col("username")).alias("hkey")), "hkey")
                 .select("pos", "chat_id", "handle"))
    by_id = (d.join(valid.filter(F.col("kind") == "id").select("pos", "chat_id"), "chat_id")
             .select("pos", "chat_id", "handle"))
    resolved = by_handle.unionByName(by_id)
    unresolved = valid.join(resolved.select("pos"), "pos", "left_anti")
    if require_any and resolved.limit(1).count() == 0:
        raise RuntimeError("No sources could be resolved")
    return resolved, unresolved


def allowlisted(messages: DataFrame, resolved: DataFrame) -> DataFrame:
    """Messages of resolved sources only (left semi on chat_id)."""
    ids = resolved.select("chat_id").distinct()
    return messages.join(ids, "chat_id", "left_semi")
