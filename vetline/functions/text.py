"""Scalar text expressions: normalisation, junk test, titles, links, rendering.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions``, so they compile into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (behaviour the results must reproduce) -------------------
# Characters Python's str.strip() removes (str.isspace): U+0009-U+000D,
# U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "".join(chr(c) for c in range(0x09, 0x0E))
    + "".join(chr(c) for c in range(0x1C, 0x21))
    + "\u0085\u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Python's [^\W\d_] (a letter) in Java regex terms.
LETTER_CLASS = r"[\p{L}\p{Nl}\p{No}]"
# Minimum text length before a message is worth evaluating.
MIN_TEXT_LEN = 40
# Markdown characters escaped in cards: backslash, asterisk, underscore,
# backtick, opening bracket.
MD_SPECIAL = r"([\\*_`\[])"
# Link to a message of a channel whose id starts with -100.
LINK_PREFIX = "https://t.me/c/"
CHANNEL_ID_PREFIX = "-100"
# Placeholders used in listings and cards.
DASH = "—"
# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``(x or "").strip()``: NULL becomes '', Unicode whitespace trimmed."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(PY_WHITESPACE))


def has_letter(c) -> Column:
    return col(c).rlike(LETTER_CLASS)


def worth_evaluating(c, min_len: int = MIN_TEXT_LEN) -> Column:
    """Junk prefilter: long enough and containing at least one letter."""
    return (F.length(col(c)) >= F.lit(min_len)) & has_letter(c)


def nonempty(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def chat_title(title, username, first_name, chat_id) -> Column:
    """First non-empty of title, username, first name, else the id text."""
    return F.coalesce(nonempty(title), nonempty(username), nonempty(first_name),
                      col(chat_id).cast("string"), F.lit("unknown"))


def registration_title(title, username, chat_id) -> Column:
    """Title stored when a channel is registered: title, username or id."""
    return F.coalesce(nonempty(title), nonempty(username), col(chat_id).cast("string"))


def backfill_title(title, username, chat_id) -> Column:
    return F.coalesce(nonempty(title), nonempty(username), col(chat_id).cast("string"), F.lit("?"))


def source_link(chat_id, msg_id) -> Column:
    s = col(chat_id).cast("string")
    return F.when(col(chat_id).isNotNull() & col(msg_id).isNotNull() & s.startswith(CHANNEL_ID_PREFIX),
                  F.concat(F.lit(LINK_PREFIX), F.substring(s, 5, 1 << 20), F.lit("/"),
                           col(msg_id).cast("string")))


def md_escape(c) -> Column:
    """One regex pass equals the chained replaces (backslash first)."""
    return F.regexp_replace(col(c), MD_SPECIAL, r"\\$1")


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ wall-clock read as UTC (floor)."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") \
        if isinstance(ts, str) else F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def from_epoch(c) -> Column:
    """Epoch seconds to a UTC wall-clock TIMESTAMP_NTZ (session time zone free)."""
    return F.timestamp_add("SECOND", col(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def fmt_ts(c) -> Column:
    """``YYYY-MM-DD HH:MM UTC``; NULL or 0 renders as a dash."""
    return F.when(F.coalesce(col(c), F.lit(0)) == 0, F.lit(DASH)).otherwise(
        F.concat(F.date_format(from_epoch(c), "yyyy-MM-dd HH:mm"), F.lit(" UTC")))


def channel_label(title, username) -> Column:
    t = F.coalesce(nonempty(title), F.lit("?"))
    return F.when(nonempty(username).isNotNull(), F.concat(t, F.lit(" (@"), col(username), F.lit(")"))).otherwise(t)


def status_tags(posted, is_vacancy) -> Column:
    """'posted' first, then 'vacancy' / 'not vacancy'; none gives a dash."""
    tags = F.array_compact(F.array(
        F.when(F.coalesce(col(posted), F.lit(0)) != 0, F.lit("posted")),
        F.when(col(is_vacancy) == 1, F.lit("vacancy")).when(col(is_vacancy) == 0, F.lit("not vacancy")),
    ))
    return F.when(F.size(tags) == 0, F.lit(DASH)).otherwise(F.array_join(tags, " "))


def clamp_score(c) -> Column:
    """``max(0, min(100, int(x)))`` for a numeric score: NULL or NaN (no
    integer) gives 0; otherwise bound to 0..100, then truncate toward zero.
    (``least``/``greatest`` skip NULLs and order NaN above every number, so
    both are handled first.)"""
    v = col(c).cast("double")
    return (F.when(v.isNull() | F.isnan(v), F.lit(0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), v)).cast("int")))


def dash_if_empty(c) -> Column:
    return F.coalesce(nonempty(col(c).cast("string")), F.lit(DASH))


def parse_channel(c) -> Column:
    """Id-or-handle parse of a configured channel: stripped; a leading '-' or
    all digits means a numeric id (NULL ``chat_id`` with ``valid`` false when
    it is not a number), anything else is a handle."""
    s = F.btrim(col(c), F.lit(PY_WHITESPACE))
    numeric = s.startswith("-") | s.rlike(r"^[0-9]+\z")
    as_id = s.try_cast("bigint")
    return F.struct(F.when(numeric, as_id).alias("chat_id"),
                    F.when(~numeric, s).alias("username"),
                    (~numeric | as_id.isNotNull()).alias("valid"))
