"""Deterministic outcome/message/answer tables derived from the given tables.

The triage service reads chat messages and model answers from live services; the
test tables have none of these shapes, so each fixture is a projection of a
given table (see FIXTURES.md).  All are lazy DataFrames: their work grows with
the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.functions.text import clamp_score, epoch_seconds
from vetline.operators.state import touch_channels
from vetline.sources.tables import read_table

# ---- fixed values of the fixture definitions (FIXTURES.md) ----------------
VACANCY_EVENTS = ("purchase", "signup")
NON_VACANCY_EVENTS = ("view", "click")
BASE_EPOCH = 1704067200          # 2024-01-01 00:00:00 UTC
SECONDS_PER_DOC = 60
OUT_OF_ORDER_SHIFT = 3456000     # 40 days back for doc_id % 97 = 5
CHANNEL_ID_BASE = 1001000000000  # chat_id = -(base + n) gives -100... ids
# --------------------------------------------------------------------------


def fx_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome table from ``events``: one row per event."""
    ev = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    vac = et.isin(*VACANCY_EVENTS)
    sc = clamp_score("value")
    return ev.select(
        F.col("user_id").alias("chat_id"),
        F.col("event_id").alias("msg_id"),
        F.when(vac, 1).when(et.isin(*NON_VACANCY_EVENTS), 0).cast("int").alias("is_vacancy"),
        F.when(et != "error", sc).alias("score"),
        F.when(vac & (sc >= 70), 1).otherwise(0).alias("posted"),
        F.when(vac, F.concat(et, F.lit(" "), F.col("event_id").cast("string"))).alias("title"),
        epoch_seconds("ts").alias("ts"),
    )


def fx_channels_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension from ``customer`` before any message touched it."""
    cu = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return cu.select(
        k.alias("chat_id"),
        F.when(k % 3 != 0, F.concat(F.lit("u"), k.cast("string"))).alias("username"),
        F.when(k % 2 == 0, F.lower("c_name")).otherwise(F.upper("c_name")).alias("title"),
        F.lit(None).cast("bigint").alias("last_msg_ts"),
    )


def fx_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels with ``last_msg_ts`` set by the channel touch over ``fx_seen``."""
    return touch_channels(fx_channels_base(spark, sf_dir), fx_seen(spark, sf_dir))


def _src_n() -> Column:
    return F.substring("source", 4, 1 << 20).cast("bigint")


def fx_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming messages from ``documents``: some arrive live, some by backfill,
    some both (duplicates on the key)."""
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    n = _src_n()
    d = F.col("doc_id")
    date_s = (F.lit(BASE_EPOCH) + d * SECONDS_PER_DOC
              - F.when(d % 97 == 5, F.lit(OUT_OF_ORDER_SHIFT)).otherwise(F.lit(0)))
    arrivals = F.array_compact(F.array(
        F.when(d % 3 != 0, F.lit("live")),
        F.when((d % 3 == 0) | (d % 10 == 0), F.lit("backfill")),
    ))
    return doc.select(
        F.when(n % 4 == 0, n).otherwise(-(F.lit(CHANNEL_ID_BASE) + n)).alias("chat_id"),
        d.alias("msg_id"),
        F.timestamp_seconds(date_s).alias("msg_date"),
        date_s.alias("date_s"),
        F.col("text"),
        F.when(n % 5 == 1, F.lit("")).when(n % 5 == 2, F.lit(None))
         .otherwise(F.concat(F.lit("src"), n.cast("string"))).alias("chat_title"),
        F.when(n % 5 == 1, F.concat(F.lit("h"), n.cast("string"))).alias("chat_username"),
        F.lit(None).cast("string").alias("chat_first_name"),
        F.explode(arrivals).alias("source"),
    )


def fx_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat directory: the distinct (chat_id, handle) of the message sources."""
    doc = read_table(spark, sf_dir, "documents").select("source")
    n = _src_n()
    return doc.select(
        F.when(n % 4 == 0, n).otherwise(-(F.lit(CHANNEL_ID_BASE) + n)).alias("chat_id"),
        F.col("source").alias("handle"),
    ).distinct()


def fx_allowlist_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow-list entries as JSON values, one per row, derived from the sources.

    Per source ``srcN`` by ``N % 5``: 0 the numeric chat id, 1 ``"@srcN"``,
    2 ``" @srcN "`` (needs stripping), 3 ``"@missingN"`` (unresolvable),
    4 the ``-100...`` id as a number.  Plus invalid entries for ``N % 7 = 6``:
    a blank string and a float.
    """
    n = _src_n()
    src = read_table(spark, sf_dir, "documents").select(n.alias("n")).distinct()
    ch_id = F.when(F.col("n") % 4 == 0, F.col("n")).otherwise(-(F.lit(CHANNEL_ID_BASE) + F.col("n")))
    m = F.col("n") % 5
    ns = F.col("n").cast("string")
    entry = (F.when(m == 0, ch_id.cast("string"))
             .when(m == 1, F.concat(F.lit('"@src'), ns, F.lit('"')))
             .when(m == 2, F.concat(F.lit('" @src'), ns, F.lit(' "')))
             .when(m == 3, F.concat(F.lit('"@missing'), ns, F.lit('"')))
             .otherwise(ch_id.cast("string")))
    bad = F.col("n") % 7 == 6
    entries = F.array_compact(F.array(
        F.struct((F.col("n") * 10).alias("pos"), entry.alias("entry")),
        F.when(bad, F.struct((F.col("n") * 10 + 1).alias("pos"), F.lit('"  "').alias("entry"))),
        F.when(bad, F.struct((F.col("n") * 10 + 2).alias("pos"), F.concat(ns, F.lit(".5")).alias("entry"))),
    ))
    return src.select(F.explode(entries).alias("e")).select("e.*")


def fx_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed evaluations: distinct messages + ``labels`` (missing label means the
    model was unavailable)."""
    msgs = fx_messages(spark, sf_dir).select("chat_id", "msg_id", "source").dropDuplicates(["chat_id", "msg_id"])
    lab = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("msg_id"), "quality", "toxic")
    m = F.col("msg_id")
    return msgs.select("chat_id", "msg_id").join(lab, "msg_id", "left").select(
        "chat_id", "msg_id",
        F.when(m % 50 == 7, "crash").when(F.col("quality").isNull(), "transient").otherwise("ok").alias("status"),
        (F.col("quality") == 1).alias("is_vacancy"),
        F.concat(F.lit("Role "), m.cast("string")).alias("title"),
        F.lit("").alias("company"),
        F.array().cast("array<string>").alias("stack"),
        F.lit("unknown").alias("grade"),
        F.lit("").alias("salary"),
        F.lit("unknown").alias("remote"),
        ((m * 37) % 101).cast("int").alias("match_score"),
        F.lit("").alias("reasoning"),
        F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")).alias("red_flags"),
        F.lit(False).alias("should_apply"),
    )


def fx_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model answers, ten shapes by ``event_id % 10``."""
    ev = read_table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"-?[0-9]+", 0).cast("bigint").cast("string")
    k3 = (F.regexp_extract("props", r"-?[0-9]+", 0).cast("bigint") * 3).cast("string")
    m = F.col("event_id") % 10
    head = F.lit('{"is_vacancy": true, "match_score": ')
    raw = (F.when(m == 0, F.concat(F.lit("```json\n"), head, k, F.lit("}\n```")))
           .when(m == 1, F.concat(head, k, F.lit("} thanks")))
           .when(m == 2, F.concat(head, F.lit('"'), k, F.lit('"}')))
           .when(m == 3, F.concat(head, k, F.lit(".5}")))
           .when(m == 4, F.concat(head, k3, F.lit("}")))
           .when(m == 5, F.concat(head, F.lit("-"), k, F.lit("}")))
           .when(m == 6, F.concat(F.lit('{"match_score": '), k, F.lit(', "title": 7, "company": null, "grade": "wizard", '
                                                                       '"remote": "moon", "should_apply": true}')))
           .when(m == 7, F.concat(F.lit('[{"match_score": '), k, F.lit("}]")))
           .when(m == 8, F.concat(head, k, F.lit(', "title": "Dev '), k, F.lit('", "company": "Acme", "stack": ["Go", null, "", "Kafka"], '
                                                 '"grade": "senior", "salary": "'), k3, F.lit(' EUR", "remote": "full", "reasoning": " One. Two! Three? Four. ", '
                                                 '"red_flags": ["late '), k, F.lit('", ""], "should_apply": "false"}')))
           .otherwise(F.lit('{"is_vacancy": false, "match_score": 0}')))
    return ev.select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("msg_id"), raw.alias("raw"))


def fx_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-call results: HTTP status (NULL for a connection error)."""
    ev = read_table(spark, sf_dir, "events")
    r = F.col("event_id") % 8
    status = (F.when(r == 0, 429).when(r == 1, 500).when(r == 2, 503).when(r == 3, F.lit(None))
              .when(r == 4, 400).when(r == 5, 401).otherwise(200)).cast("int")
    return ev.select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("msg_id"),
                     status.alias("http_status"),
                     F.when(r == 3, F.lit("connection")).alias("error"))


def fx_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token usage reported per call."""
    ev = read_table(spark, sf_dir, "events")
    e = F.col("event_id")
    return ev.select(F.col("user_id").alias("chat_id"), e.alias("msg_id"),
                     (e % 700).alias("input_tokens"), (e % 600).alias("output_tokens"),
                     (e % 5 * 100).alias("cache_read_tokens"), (e % 3 * 50).alias("cache_create_tokens"))


def fx_scorer(batches):
    """Deterministic stand-in for the model service (a user batch scorer).

    Per message, by ``msg_id % 8`` the call fails with 429, a connection
    error (no status) or 400, else returns 200; the answer text depends on
    ``msg_id % 5`` and the text length ``n``:
    0 a vacancy scored ``n % 101`` with title/stack/grade/remote,
    1 not a vacancy, 2 not JSON, 3 a vacancy with string values,
    4 a vacancy scored ``(7 n) % 150`` with a red flag.
    """
    import json

    import pandas as pd
    for pdf in batches:
        out = []
        for cid, mid, text in zip(pdf["chat_id"], pdf["msg_id"], pdf["text"]):
            n = len(text)
            status = {0: 429, 3: None, 5: 400}.get(mid % 8, 200)
            m = mid % 5
            if m == 0:
                raw = json.dumps({"is_vacancy": True, "match_score": n % 101, "title": f"Role {mid}",
                                  "stack": ["Go", ""], "grade": "senior", "remote": "full"})
            elif m == 1:
                raw = json.dumps({"is_vacancy": False, "match_score": 0})
            elif m == 2:
                raw = "not json"
            elif m == 3:
                raw = json.dumps({"is_vacancy": "yes", "match_score": str(n % 101)})
            else:
                raw = json.dumps({"is_vacancy": True, "match_score": (7 * n) % 150, "red_flags": ["relocation"]})
            out.append((cid, mid, raw if status == 200 else None, status,
                        "connection" if status is None else None, n, 100, 0, 0))
        yield pd.DataFrame(out, columns=["chat_id", "msg_id", "raw", "http_status", "error", "input_tokens",
                                         "output_tokens", "cache_read_tokens", "cache_create_tokens"])


def _status_code(e):
    r = e % 8
    return (F.when(r == 0, 429).when(r == 1, 500).when(r == 2, 503).when(r == 3, F.lit(None))
            .when(r == 4, 400).when(r == 5, 401).otherwise(200)).cast("int")


def fx_call_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls with up to three attempts: attempt ``i`` (0-based) of
    event ``e`` returns the status ``fx_calls`` gives event ``e + i``."""
    ev = read_table(spark, sf_dir, "events")
    e = F.col("event_id")
    return ev.select(F.col("user_id").alias("chat_id"), e.alias("msg_id"),
                     F.array(_status_code(e), _status_code(e + 1), _status_code(e + 2)).alias("attempt_statuses"))


def fx_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile text per part: sections, checklists and a table whose items
    name the part, its type, brand and size."""
    p = read_table(spark, sf_dir, "part")
    text = F.format_string(
        "# Profile\n\n## 1. Grade\n\n**Middle**\n\n- not a rule\n\n## 5. Work Format\n\n| Option | Status |\n|---|---|\n| %s | Priority |\n"
        "| %s | No - not considering |\n| %s only | Hard blocker |\n\n## 8. Hard Blockers - not wanted\n\n### Roles\n"
        "- Requires %s / %s as core skill\n- x\n\n## 10. Evaluation\n\n**Immediate disqualifiers (match_score < 30):**\n"
        "- %s (licence), %s or size %s\n\n**Mismatch (match_score < 40):**\n* %s\n\n**Strong signals (match_score 75+):**\n"
        "- Mentions of %s, %s or platform\n- AI/ML product\n",
        "p_name", "p_type", "p_brand", "p_name", "p_type", "p_brand", "p_type", F.col("p_size").cast("string"), "p_type", "p_name", "p_brand")
    return p.select(F.col("p_partkey").alias("profile_id"), text.alias("text"))
