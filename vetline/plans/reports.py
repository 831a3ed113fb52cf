"""Reporting queries over the outcome (``seen``) and ``channels`` tables.

All are lazy DataFrames.  Plan shape, by design:
* overall/dashboard: one global aggregate (partial per partition, one tiny
  final task);
* channel stats: aggregate ``seen`` by ``chat_id`` *before* the outer join
  (Catalyst does not push an aggregate below an outer join), so only one row
  per chat crosses into the join; AQE turns it into a broadcast at runtime
  when that side is small;
* listings: filter (pushed to the Parquet scan) -> top-k
  (``TakeOrderedAndProject``: k rows per partition) -> join of the k rows with
  a size-checked broadcast of the channel dimension.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions import text as tx
from vetline import session

# ---- fixed values ---------------------------------------------------------
FILTER_TYPES = ("all", "vacancies", "not_vacancies", "posted")
LIST_LIMIT = 200          # list_messages default
LIST_PAGE_LIMIT = 300     # limit the listing page asks for
RECENT_LIMIT = 20         # recent_matches default
RECENT_PAGE_LIMIT = 30    # limit the front page asks for
FILTER_LABELS = {"all": "All messages", "vacancies": "Vacancies", "not_vacancies": "Not vacancies",
                 "posted": "Posted matches"}
CARD_LABELS = (("Total seen", "all"), ("Vacancies", "vacancies"),
               ("Not vacancies", "not_vacancies"), ("Posted (matched)", "posted"),
               ("Channels tracked", None))
# ---------------------------------------------------------------------------


def _count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): a NULL condition counts 0."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def overall_stats(seen: DataFrame) -> DataFrame:
    """One row: total, vacancies, not_vacancies, posted, last_ts.  An empty
    table gives zeros and a NULL ``last_ts``."""
    return seen.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(_count_if(F.col("is_vacancy") == 1), F.lit(0).cast("bigint")).alias("vacancies"),
        F.coalesce(_count_if(F.col("is_vacancy") == 0), F.lit(0).cast("bigint")).alias("not_vacancies"),
        F.coalesce(_count_if(F.col("posted") == 1), F.lit(0).cast("bigint")).alias("posted"),
        F.max("ts").cast("bigint").alias("last_ts"),
    )


def nocase_key(c) -> Column:
    """SQLite ``COLLATE NOCASE``: folds ASCII A-Z only."""
    return F.translate(tx.col(c), string.ascii_uppercase, string.ascii_lowercase)


def channel_stats(channels: DataFrame, seen: DataFrame, ordered: bool = True) -> DataFrame:
    """Per registered channel: message count, vacancies, posted, average and
    maximum vacancy score, last activity; channels without messages give zeros.
    Sorted by case-folded title (ASCII only), then ``chat_id``."""
    vac = F.col("is_vacancy") == 1
    per_chat = seen.groupBy("chat_id").agg(
        F.count("msg_id").alias("_total"),
        _count_if(vac).alias("_vac"),
        _count_if(F.col("posted") == 1).alias("_posted"),
        F.avg(F.when(vac, F.col("score"))).alias("_avg"),
        F.max(F.when(vac, F.col("score")).otherwise(0)).alias("_max"),
    )
    out = channels.select("chat_id", "username", "title", "last_msg_ts").join(per_chat, "chat_id", "left").select(
        "chat_id", "username", "title", "last_msg_ts",
        F.coalesce("_total", F.lit(0).cast("bigint")).alias("total"),
        F.coalesce("_vac", F.lit(0).cast("bigint")).alias("vacancies"),
        F.coalesce("_posted", F.lit(0).cast("bigint")).alias("posted"),
        F.round("_avg", 1).alias("avg_score"),
        F.coalesce("_max", F.lit(0)).cast("int").alias("max_score"),
    )
    if ordered:
        out = out.orderBy(nocase_key("title").asc_nulls_first(), F.col("chat_id").asc())
    return out


def channel_ranking(channels: DataFrame, seen: DataFrame) -> DataFrame:
    """Channel statistics with ``rank``, the display position in the page's
    order (case-folded title, NULL first, then ``chat_id``), computed without
    moving all channels into one task."""
    from vetline.operators.order import ranked
    return ranked(channel_stats(channels, seen, ordered=False),
                  nocase_key("title").asc_nulls_first(), F.col("chat_id").asc())


def dashboard_cards(seen: DataFrame, channels: DataFrame) -> DataFrame:
    """The five summary cards in long form (label, value, filter link).

    Both inputs are reduced in one aggregate over their union: no join."""
    s = seen.select(F.lit(1).alias("n_seen"), F.col("is_vacancy"), F.col("posted"),
                    F.lit(0).alias("n_chan"))
    c = channels.select(F.lit(0).alias("n_seen"), F.lit(None).cast("int").alias("is_vacancy"),
                        F.lit(None).cast("int").alias("posted"), F.lit(1).alias("n_chan"))
    one = s.unionByName(c).agg(
        F.sum("n_seen").cast("bigint").alias("v0"),
        _count_if(F.col("is_vacancy") == 1).alias("v1"),
        _count_if(F.col("is_vacancy") == 0).alias("v2"),
        _count_if(F.col("posted") == 1).alias("v3"),
        F.sum("n_chan").cast("bigint").alias("v4"),
    )
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("card"),
                 F.coalesce(F.col(f"v{i}"), F.lit(0).cast("bigint")).alias("value"),
                 F.lit(ftype).cast("string").alias("filter_type"))
        for i, (label, ftype) in enumerate(CARD_LABELS)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def normalize_filter(filter_type: str | None) -> str:
    """Unknown filter types fall back to ``all``."""
    return filter_type if filter_type in FILTER_TYPES else "all"


def _listing_filter(seen: DataFrame, filter_type: str, channel_id: int | None) -> DataFrame:
    ft = normalize_filter(filter_type)
    if ft == "vacancies":
        seen = seen.filter(F.col("is_vacancy") == 1)
    elif ft == "not_vacancies":
        seen = seen.filter(F.col("is_vacancy") == 0)
    elif ft == "posted":
        seen = seen.filter(F.col("posted") == 1)
    if channel_id is not None:
        seen = seen.filter(F.col("chat_id") == F.lit(int(channel_id)).cast("bigint"))
    return seen


def _newest_first(df: DataFrame, limit: int) -> DataFrame:
    # ts ties broken by chat_id, msg_id (deterministic top-k)
    return df.orderBy(F.col("ts").desc_nulls_last(), F.col("chat_id").desc_nulls_last(),
                      F.col("msg_id").desc_nulls_last()).limit(int(limit))


def _with_channel(top: DataFrame, channels: DataFrame, cols) -> DataFrame:
    """Label the top-k rows with their channel.  The channel dimension is
    never shuffled for k rows: the k rows are fixed once (a checkpoint of k
    rows, so the top-k is not computed twice), the dimension streams through
    a broadcast of their keys (k at most, by the limit), and the two tiny
    sides are joined."""
    ch = channels.select("chat_id", F.col("username").alias("channel_username"),
                         F.col("title").alias("channel_title"))
    session.checkpoint_root(top.sparkSession)
    fixed = top.checkpoint(eager=True)
    labels = ch.join(F.broadcast(fixed.select("chat_id").distinct()), "chat_id", "left_semi")
    return fixed.join(F.broadcast(labels), "chat_id", "left").select(*cols)


LIST_COLS = ["ts", "chat_id", "channel_username", "channel_title", "title", "score",
             "is_vacancy", "posted", "msg_id"]
RECENT_COLS = ["ts", "chat_id", "channel_username", "channel_title", "title", "score", "msg_id"]


def list_messages(seen: DataFrame, channels: DataFrame, filter_type: str = "all",
                  channel_id: int | None = None, limit: int = LIST_LIMIT) -> DataFrame:
    """Newest outcome rows matching the listing filter, with channel names."""
    top = _newest_first(_listing_filter(seen, filter_type, channel_id)
                        .select("ts", "chat_id", "msg_id", "title", "score", "is_vacancy", "posted"), limit)
    top = top.select("ts", "chat_id", "msg_id", "title", "score",
                     F.col("is_vacancy").cast("boolean").alias("is_vacancy"),
                     (F.col("posted") != 0).alias("posted"))
    return _with_channel(top, channels, LIST_COLS)


def recent_matches(seen: DataFrame, channels: DataFrame, limit: int = RECENT_LIMIT) -> DataFrame:
    top = _newest_first(seen.filter(F.col("posted") == 1)
                        .select("ts", "chat_id", "msg_id", "title", "score"), limit)
    return _with_channel(top, channels, RECENT_COLS)


def render_listing(rows: DataFrame) -> DataFrame:
    """Display columns of a listing row: time, channel label, title, score,
    status tags and the link to the original message."""
    return rows.select(
        "chat_id", "msg_id",
        tx.fmt_ts("ts").alias("time"),
        # the label reads the row's "title" before the channel title, and in a
        # listing row that is the message title: kept as the service shows it
        tx.channel_label(F.coalesce(tx.nonempty("title"), F.col("channel_title")), "channel_username")
          .alias("channel"),
        tx.dash_if_empty("title").alias("title"),
        tx.dash_if_empty("score").alias("score"),
        tx.status_tags(F.col("posted").cast("int"), F.col("is_vacancy").cast("int")).alias("tags"),
        F.coalesce(tx.source_link("chat_id", "msg_id"), F.lit(tx.DASH)).alias("link"),
    )


def render_channels(stats: DataFrame) -> DataFrame:
    """Display columns of the channel table: label, counts, average score
    (dash when there is none), maximum score, last activity; ``rank`` (the
    row's position) is kept when present."""
    keep = ["rank"] if "rank" in stats.columns else []
    return stats.select(
        "chat_id", *keep,
        tx.channel_label("title", "username").alias("channel"),
        "total", "vacancies", "posted",
        F.coalesce(F.col("avg_score").cast("string"), F.lit(tx.DASH)).alias("avg_score"),
        "max_score",
        tx.fmt_ts("last_msg_ts").alias("last"),
    )


def render_recent(rows: DataFrame) -> DataFrame:
    """Display columns of the recent-matches table."""
    return rows.select(
        "chat_id", "msg_id",
        tx.fmt_ts("ts").alias("time"),
        F.coalesce(tx.nonempty("channel_title"), F.col("chat_id").cast("string")).alias("channel"),
        tx.dash_if_empty("title").alias("title"),
        F.col("score"),
        tx.source_link("chat_id", "msg_id").alias("link"),
    )


def list_page_title(channels: DataFrame, filter_type: str = "all", channel_id: int | None = None) -> DataFrame:
    """Title of a drill-down listing: ``<channel label> · <filter label>``
    (one row; the label is looked up by key, not by scanning statistics)."""
    flabel = FILTER_LABELS[normalize_filter(filter_type)]
    if channel_id is None:
        return channels.sparkSession.range(1).select(F.lit(flabel).alias("title"))
    ch = channels.filter(F.col("chat_id") == F.lit(int(channel_id)).cast("bigint"))
    # a global aggregate always yields one row (NULL label when unknown)
    return (ch.agg(F.first(tx.channel_label("title", "username"), ignorenulls=True).alias("label"))
            .select(F.concat_ws(" · ", F.col("label"), F.lit(flabel)).alias("title")))


def list_page_titles(channels: DataFrame) -> DataFrame:
    """The drill-down title of every channel under each filter type
    (``<channel label> · <filter label>``); the four filter labels are an
    exploded literal array, not a join."""
    types = F.array(*[F.struct(F.lit(ft).alias("filter_type"), F.lit(FILTER_LABELS[ft]).alias("flabel"))
                      for ft in FILTER_TYPES])
    return (channels.select("chat_id", tx.channel_label("title", "username").alias("label"),
                            F.explode(types).alias("f"))
            .select("chat_id", F.col("f.filter_type").alias("filter_type"),
                    F.concat_ws(" · ", F.col("label"), F.col("f.flabel")).alias("title")))
