"""Fixed schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

L, I, S, B = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
STRS = T.ArrayType(T.StringType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# incoming messages (live stream or backfill scan)
MESSAGES = _st(("chat_id", L), ("msg_id", L), ("msg_date", T.TimestampType()), ("text", S),
               ("chat_title", S), ("chat_username", S), ("chat_first_name", S), ("source", S))

# typed evaluation of one message (scorer output after parsing)
EVALUATIONS = _st(("chat_id", L), ("msg_id", L), ("status", S), ("is_vacancy", B), ("title", S),
                  ("company", S), ("stack", STRS), ("grade", S), ("salary", S), ("remote", S),
                  ("match_score", I), ("reasoning", S), ("red_flags", STRS), ("should_apply", B))

# outcome table: one row per (chat_id, msg_id) after compaction
SEEN = _st(("chat_id", L), ("msg_id", L), ("is_vacancy", I), ("score", I), ("posted", I),
           ("title", S), ("ts", L))

# messages that wait for another try: tries made so far, and when (epoch seconds) the next one is due
RETRY = T.StructType([*MESSAGES.fields, T.StructField("tries", I, True), T.StructField("due", L, True)])

# how far the history of each chat has been read, and back to which cutoff
MARKS = _st(("chat_id", L), ("msg_id", L), ("cutoff", L))

# the append log behind it: ``run`` grows with every run, so that the row written last is known
SEEN_LOG = T.StructType([*SEEN.fields, T.StructField("run", L, True)])

# seen before the additive migration (is_vacancy and title added later)
SEEN_V1 = _st(("chat_id", L), ("msg_id", L), ("score", I), ("posted", I), ("ts", L))

# channel dimension
CHANNELS = _st(("chat_id", L), ("username", S), ("title", S), ("last_msg_ts", L))

# published cards
MATCHES = _st(("chat_id", L), ("msg_id", L), ("score", I), ("card", S), ("source_link", S), ("ts", L))

# allow-list entries, a handle or a numeric id
SOURCES = _st(("username", S), ("chat_id", L))

# scoring rules (the profile checklist)
RULES = _st(("rule_id", I), ("kind", S), ("pattern", S), ("weight", I))

SEEN_KEY = ["chat_id", "msg_id"]
