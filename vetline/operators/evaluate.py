"""Evaluation: the scorer hook (E1), call outcomes (E2), rule scoring (E3).

The default scorer is a rule table matched against the whole text.  Rules are
job parameters (the profile's checklist), compiled into one column
expression (``operators.rule_index``): one projection, no join, no shuffle, and the
work per text follows the rules that may match it, not the count of rules.  A user-supplied batch function (for example a
model client) runs through ``mapInPandas``: Arrow batches, one client per
partition, the partition count acting as the concurrency limit.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetline.functions.answers import FIELDS as PARSED_FIELDS, parse_answers
from vetline.operators.rule_index import matched_rules

# ---- fixed values -------------------------------------------------------------
# Call outcome classes: 2xx ok; 429, >= 500 or no status (connection error)
# retried and, after the last attempt, transient; any other status: crash.
MAX_ATTEMPTS = 3
BACKOFF_BASE_S = 1          # waits 1, 2, 4 s after failed attempts
RATE_LIMITED = 429
# Request text handed to the scorer for one message.
REQUEST_TEMPLATE = ("<source_chat>{chat_title}</source_chat>\n<message>\n{text}\n</message>\n\n"
                    "Return ONLY valid JSON matching the schema.")
# Rule scoring: base score, caps for a hard mismatch and for a blocker.
BASE_SCORE = 30
HARD_CAP = 39
BLOCKER_CAP = 29
RULE_KINDS = ("signal", "hard", "blocker")
# -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    rule_id: int
    kind: str          # signal | hard | blocker
    pattern: str       # Java regex, matched anywhere in the text
    weight: int

    def __post_init__(self):
        if self.kind not in RULE_KINDS:
            raise ValueError(f"rule {self.rule_id}: unknown kind {self.kind!r}")


# The scoring rules used with the test prose (FIXTURES.md, fx_rules).
FX_RULES: tuple[Rule, ...] = (
    Rule(1, "signal", "the", 25),
    Rule(2, "signal", "que", 30),
    Rule(3, "signal", "der", 20),
    Rule(4, "hard", "[0-9]", -20),
    Rule(5, "blocker", "@", -40),
)


def load_rules(path: str) -> tuple[Rule, ...]:
    """Rules from a JSON file ``[{"rule_id":..,"kind":..,"pattern":..,"weight":..}]``."""
    with open(path, encoding="utf-8") as f:
        items = json.load(f)
    if not isinstance(items, list) or not items:
        raise RuntimeError(f"{path} must contain a non-empty list of rules")
    return tuple(Rule(int(r["rule_id"]), str(r["kind"]), str(r["pattern"]), int(r["weight"])) for r in items)


def rule_hits(df: DataFrame, rules: Sequence[Rule] = FX_RULES, text_col: str = "text",
              keys: Sequence[str] = ("chat_id", "msg_id")) -> DataFrame:
    """One row per (message, matching rule)."""
    return (df.select(*keys, F.explode(matched_rules(rules, F.col(text_col))).alias("h"))
            .select(*keys, "h.rule_id", "h.kind", "h.pattern", "h.weight"))


def _summed(hits: Column) -> Column:
    """Weights, signals, hard rules and blockers among the rules that match, in one walk over them."""
    start = F.struct(F.lit(BASE_SCORE).alias("total"), *[F.lit(0).alias(k) for k in RULE_KINDS])
    return F.aggregate(hits, start, lambda s, h: F.struct(
        (s["total"] + h["weight"]).alias("total"), *[(s[k] + F.when(h["kind"] == k, 1).otherwise(0)).alias(k) for k in RULE_KINDS]))


def score_columns(hits: str = "_hits", sums: str = "_sums") -> dict[str, Column]:
    """Score columns of the rule scorer from the rules that match and their
    sums, which are columns of projections below (``_scored``), so that the
    patterns are matched once for all of them.

    score = clamp(base + sum of matched weights), capped at 39 if any hard
    rule matched and at 29 if any blocker matched.
    """
    total, signal, hard, blocker = (F.col(f"{sums}.{k}") for k in ("total", *RULE_KINDS))
    score = F.greatest(F.lit(0), F.least(F.lit(100), total, F.when(hard > 0, F.lit(HARD_CAP)), F.when(blocker > 0, F.lit(BLOCKER_CAP))))
    flags = F.transform(F.filter(F.col(hits), lambda h: h["kind"] != "signal"), lambda h: F.concat(h["kind"], F.lit(":"), h["pattern"]))
    return {"n_signals": signal, "any_hard": hard > 0, "any_blocker": blocker > 0, "raw_score": total, "rule_score": score, "rule_flags": flags}


def _scored(df: DataFrame, rules: Sequence[Rule], text: Column, on: Column | None = None) -> DataFrame:
    hits = matched_rules(rules, text)
    bound = df.withColumn("_hits", hits if on is None else F.when(on, hits))
    return bound.withColumn("_sums", _summed(F.col("_hits")))


def rule_scores(df: DataFrame, rules: Sequence[Rule] = FX_RULES, text_col: str = "text",
                keys: Sequence[str] = ("chat_id", "msg_id")) -> DataFrame:
    return _scored(df.select(*keys, F.col(text_col).alias("_text")), rules, F.col("_text")).select(
        *keys, *[c.alias(k) for k, c in score_columns().items()])


def evaluate_with_rules(df: DataFrame, rules: Sequence[Rule] = FX_RULES, text_col: str = "text",
                        threshold: int = 70, mask: Column | None = None) -> DataFrame:
    """Rule scorer as an evaluation: a message matching any signal is a
    vacancy; flags are the matched hard/blocker rules.  Rows outside ``mask``
    are not evaluated (NULL evaluation; the patterns do not run for them)."""
    on = mask if mask is not None else F.lit(True)
    bound = _scored(df.withColumn("_on", on), rules, F.col(text_col), F.col("_on"))
    c = score_columns()

    def m(col: Column) -> Column:
        return F.when(F.col("_on"), col)

    return bound.select(
        *df.columns,
        m(F.lit("ok")).alias("call_status"),
        m(F.lit("ok")).alias("parse_status"),
        m(c["n_signals"] > 0).alias("is_vacancy"),
        m(F.lit("")).alias("title"), m(F.lit("")).alias("company"),
        m(F.array().cast("array<string>")).alias("stack"),
        m(F.lit("unknown")).alias("grade"), m(F.lit("")).alias("salary"), m(F.lit("unknown")).alias("remote"),
        m(c["rule_score"]).alias("match_score"),
        m(F.lit("")).alias("reasoning"),
        m(c["rule_flags"]).alias("red_flags"),
        m((c["rule_score"] >= threshold) & (F.size(c["rule_flags"]) == 0)).alias("should_apply"),
    )


# ---- model calls ---------------------------------------------------------------------

def call_outcome(status: Column) -> Column:
    """ok | transient | crash from the final HTTP status of a call (NULL = no
    response, e.g. a connection error)."""
    return (F.when(status.between(200, 299), F.lit("ok"))
            .when(status.isNull() | (status == RATE_LIMITED) | (status >= 500), F.lit("transient"))
            .otherwise(F.lit("crash")))


def call_outcomes(calls: DataFrame, status_col: str = "http_status", mask: Column | None = None) -> DataFrame:
    """Outcome, attempts made and back-off slept, when every attempt of a call
    returns the same status.  Rows outside ``mask`` made no call (NULLs)."""
    out = call_outcome(F.col(status_col))
    if mask is not None:
        out = F.when(mask, out)
    backoff = sum(BACKOFF_BASE_S * 2 ** i for i in range(MAX_ATTEMPTS))
    return calls.select(
        "*",
        out.alias("call_status"),
        F.when(out == "transient", MAX_ATTEMPTS).when(out.isNotNull(), 1).alias("attempts"),
        F.when(out == "transient", backoff).when(out.isNotNull(), 0).alias("backoff_s"),
    )


def attempt_outcomes(calls: DataFrame, statuses_col: str = "attempt_statuses") -> DataFrame:
    """Outcome of a call from the statuses of its successive attempts (NULL
    element = no response).  Attempts stop at the first 2xx (ok) or the first
    non-retryable status (crash); after ``MAX_ATTEMPTS`` retryable failures
    the call is transient.  The back-off slept is 1, 2, 4 s after each failed
    retryable attempt (the last one included)."""
    outcome, attempts, backoff = _attempt_columns(F.col(statuses_col))
    return calls.select("*", outcome.alias("call_status"), attempts.alias("attempts"), backoff.alias("backoff_s"))


def _attempt_columns(statuses: Column) -> tuple[Column, Column, Column]:
    """(outcome, attempts, back-off seconds) from per-attempt statuses."""
    s = F.slice(statuses, 1, MAX_ATTEMPTS)
    ok_at = F.array_position(F.transform(s, lambda x: F.coalesce(x.between(200, 299), F.lit(False))), True)
    crash_at = F.array_position(F.transform(s, lambda x: F.coalesce(
        ~x.between(200, 299) & (x != RATE_LIMITED) & (x < 500), F.lit(False))), True)
    first_ok = (ok_at > 0) & ((crash_at == 0) | (ok_at < crash_at))
    outcome = (F.when(first_ok, F.lit("ok")).when(crash_at > 0, F.lit("crash"))
               .when(F.size(s) >= MAX_ATTEMPTS, F.lit("transient")))
    attempts = F.when(first_ok, ok_at).when(crash_at > 0, crash_at).when(F.size(s) >= MAX_ATTEMPTS,
                                                                          F.lit(MAX_ATTEMPTS))
    # waits after the failed retryable attempts: 2^0 + ... + 2^(k-1)
    retried = F.when(outcome == "transient", F.lit(MAX_ATTEMPTS)).otherwise(attempts - 1)
    backoff = (F.pow(F.lit(2), retried) - 1).cast("int")
    return outcome, attempts.cast("int"), F.when(outcome.isNotNull(), backoff)


def _retryable(status) -> bool:
    return status is None or status == RATE_LIMITED or status >= 500


class Rate:
    """At most ``calls_per_s`` calls and ``tokens_per_s`` tokens on average, with a
    burst of ``burst_s`` seconds' worth.  Two buckets that fill with time: a
    call takes one from the first before it starts, and its tokens, known when it
    is over, from the second, which may fall below zero; the next call waits
    until neither is short.  Safe to use from threads."""

    def __init__(self, calls_per_s: float | None = None, tokens_per_s: float | None = None, burst_s: float = 1.0,
                 clock: Callable[[], float] | None = None, sleep: Callable[[float], None] | None = None):
        import threading
        import time
        if any(r is not None and r <= 0 for r in (calls_per_s, tokens_per_s)) or burst_s <= 0:
            raise ValueError("rates are positive")
        self.clock, self.sleep, self.lock = clock or time.monotonic, sleep or time.sleep, threading.Lock()
        self.rates = {"calls": calls_per_s, "tokens": tokens_per_s}
        # a bucket holds one call at least, else none could start
        self.most = {k: r and max(r * burst_s, 1.0) for k, r in self.rates.items()}
        self.left, self.at = dict(self.most), self.clock()

    def _fill(self) -> None:
        now = self.clock()
        for k, r in self.rates.items():
            if r is not None:
                self.left[k] = min(self.most[k], self.left[k] + r * max(0.0, now - self.at))
        self.at = now

    def start(self) -> None:
        """Waits until a call may start, and takes it."""
        while True:
            with self.lock:
                self._fill()
                short = [(need - self.left[k]) / r for k, r, need in (("calls", self.rates["calls"], 1.0), ("tokens", self.rates["tokens"], 0.0))
                         if r is not None and self.left[k] < need - 1e-9]
                if not short:
                    if self.rates["calls"] is not None:
                        self.left["calls"] -= 1
                    return
            self.sleep(max(short))

    def used(self, tokens: int) -> None:
        if self.rates["tokens"] is not None:
            with self.lock:
                self.left["tokens"] -= tokens


def retrying_scorer(call: Callable, max_attempts: int = MAX_ATTEMPTS, backoff_base_s: float = BACKOFF_BASE_S,
                    sleep: Callable[[float], None] | None = None, parallel: int = 1, rate: Callable[[], Rate] | None = None) -> Callable[[Iterator], Iterator]:
    """Batch scorer (for ``evaluate_with``) from a per-message client call,
    with the service's retry policy.

    ``call(request) -> (http_status, raw, usage)``: ``http_status`` None means
    no response; ``usage`` is a dict of token counts (``input_tokens``,
    ``output_tokens``, ``cache_read_tokens``, ``cache_create_tokens``) or
    None.  A raised ``OSError`` (connection refused, timeout) also counts as
    no response; any other exception as a failed call that is not retried
    (status 0, classified ``crash``).  A retryable failure (429, >= 500, no
    response) waits ``backoff_base_s * 2**attempt`` seconds -- 1, 2, 4 --
    after each attempt, the last one included, up to ``max_attempts``; any
    other status ends the call.  Every attempt's status is kept in
    ``attempt_statuses``, so outcome, attempts and back-off follow from them.
    Runs inside the tasks; at most ``parallel`` calls of a partition overlap
    (``call`` must then be safe to use from threads), so one message that
    waits for its retry does not hold up the others.  ``rate`` makes the limit of a
    partition (``Rate``): every attempt waits for it, and ``concurrency``
    partitions together make at most so many times its calls and tokens.
    """
    def run(batches):
        import time
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd
        wait = sleep or time.sleep
        limit = rate() if rate else None

        def one(message):
            cid, mid, request = message
            statuses, raw, usage, error = [], None, None, None
            for attempt in range(max_attempts):
                try:
                    if limit:
                        limit.start()
                    status, answer, used = call(request)
                    if limit and used:
                        limit.used((used.get("input_tokens") or 0) + (used.get("output_tokens") or 0))
                except OSError as e:
                    status, answer, used, error = None, None, None, type(e).__name__
                except Exception as e:  # noqa: BLE001 -- recorded as a crashed call
                    statuses.append(0)
                    error = type(e).__name__
                    break
                statuses.append(None if status is None else int(status))
                if status is not None and 200 <= status <= 299:
                    raw, usage, error = answer, used, None
                    break
                if not _retryable(status):
                    break
                wait(backoff_base_s * 2 ** attempt)
            u = usage or {}
            return (cid, mid, raw, statuses[-1], error, u.get("input_tokens"), u.get("output_tokens"),
                    u.get("cache_read_tokens"), u.get("cache_create_tokens"), statuses)

        with ThreadPoolExecutor(max_workers=max(1, int(parallel))) as pool:
            for pdf in batches:
                messages = zip(pdf["chat_id"], pdf["msg_id"], pdf["request"])
                out = list(pool.map(one, messages) if parallel > 1 else map(one, messages))
                yield pd.DataFrame(out, columns=[f.name for f in ANSWER_SCHEMA.fields])
    return run


def inference_request(chat_title: Column, text: Column) -> Column:
    head, rest = REQUEST_TEMPLATE.split("{chat_title}")
    mid, tail = rest.split("{text}")
    return F.concat(F.lit(head), chat_title, F.lit(mid), text, F.lit(tail))


ANSWER_SCHEMA = T.StructType([
    T.StructField("chat_id", T.LongType()), T.StructField("msg_id", T.LongType()),
    T.StructField("raw", T.StringType()), T.StructField("http_status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("input_tokens", T.LongType()), T.StructField("output_tokens", T.LongType()),
    T.StructField("cache_read_tokens", T.LongType()), T.StructField("cache_create_tokens", T.LongType()),
    # statuses of the successive attempts, when the scorer reports them
    T.StructField("attempt_statuses", T.ArrayType(T.IntegerType())),
])


def evaluate_with(df: DataFrame, batch_fn: Callable[[Iterator], Iterator], concurrency: int | None = None,
                  mask: Column | None = None) -> DataFrame:
    """Run a user scorer over Arrow batches and parse its answers.

    ``batch_fn`` receives an iterator of pandas frames with the input columns
    (at least ``chat_id, msg_id, chat_title, text``) plus ``request`` and
    yields frames with the columns of ``ANSWER_SCHEMA`` (missing ones are
    NULL).  It is called once per partition, with the iterator of all its
    batches, so a client is set up once; it may read ahead.  Only rows inside
    ``mask`` are handed to it; the others pass with NULL answers.  Answers
    are matched back to their messages in the task, so the input columns (all
    but ``text``) travel on without a join.  ``concurrency``
    partitions bound the parallel clients.  Persist the output (checkpoint or
    write) before it feeds more than one sink, so the scorer runs once per
    message.
    """
    on = mask if mask is not None else F.lit(True)
    # the text goes to Python only for rows that are scored, and does not come
    # back (callers keep a precomputed junk flag instead)
    carried_in = [c for c in df.columns if c not in ("text", "request")]
    req = df.select(*carried_in, F.when(on, F.col("text")).alias("text"),
                    F.when(on, inference_request(F.col("chat_title"), F.col("text"))).alias("request"),
                    on.alias("_evaluate"))
    if concurrency:
        req = req.repartition(int(concurrency))
    key = ["chat_id", "msg_id"]
    names = [f.name for f in ANSWER_SCHEMA.fields]
    carried = [f for f in req.schema.fields if f.name not in names and f.name not in ("request", "text")]
    schema = T.StructType(ANSWER_SCHEMA.fields + carried)
    out_names = [f.name for f in schema.fields]

    def run(batches):
        import pandas as pd
        pending: dict[int, tuple] = {}      # batch: rows to carry, keys not answered yet, answers so far
        batch_of: dict[tuple, int] = {}
        ready: list = []

        def feed():
            for n, pdf in enumerate(batches):
                keep = pdf[key + [f.name for f in carried]]
                todo = pdf[pdf["_evaluate"].fillna(False).astype(bool)]
                if not len(todo):
                    ready.append(joined(keep, []))
                    continue
                keys = set(zip(todo["chat_id"], todo["msg_id"]))
                batch_of.update(dict.fromkeys(keys, n))
                pending[n] = keep, keys, []
                yield todo

        def joined(keep, outs):
            ans = pd.concat(outs, ignore_index=True) if outs else pd.DataFrame(columns=names)
            # one answer per message (the last one a scorer gives), so a row is never duplicated
            ans = ans.drop_duplicates(subset=key, keep="last")
            merged = keep.merge(ans, on=key, how="left")
            # columns a scorer leaves out (and unscored rows) are NULL, typed
            for f in ANSWER_SCHEMA.fields:
                c = f.name
                if c in key:
                    continue
                if isinstance(f.dataType, (T.LongType, T.IntegerType)):
                    merged[c] = pd.to_numeric(merged[c], errors="coerce").astype("Int64")
                elif isinstance(f.dataType, T.ArrayType):
                    merged[c] = pd.Series([None if v is None or (isinstance(v, float) and v != v) else list(v)
                                           for v in merged[c]], index=merged.index, dtype=object)
                else:
                    merged[c] = merged[c].astype(object).where(merged[c].notna(), None)
            return merged.reindex(columns=out_names)

        # the scorer is started once for the partition and may read ahead; a batch goes on when it is answered
        for out in batch_fn(feed()):
            out = out.reindex(columns=names)
            of = [batch_of.get(k) for k in zip(out["chat_id"], out["msg_id"])]
            for n in dict.fromkeys(x for x in of if x in pending):
                part = out[[x == n for x in of]]
                keep, keys, outs = pending[n]
                outs.append(part)
                keys.difference_update(zip(part["chat_id"], part["msg_id"]))
                if not keys:
                    ready.append(joined(keep, outs))
                    del pending[n]
            batch_of = {k: n for k, n in batch_of.items() if n in pending}
            while ready:
                yield ready.pop(0)
        for _ in feed():        # what the scorer did not ask for
            pass
        for keep, _, outs in pending.values():      # messages the scorer gave no answer for
            ready.append(joined(keep, outs))
        yield from ready

    answers = req.mapInPandas(run, schema)
    answers = call_outcomes(answers, mask=F.col("_evaluate"))
    # reported attempts decide when present (e.g. 429, 429, 200 is ok after three attempts)
    a_out, a_att, a_back = _attempt_columns(F.col("attempt_statuses"))
    has = F.col("_evaluate") & F.col("attempt_statuses").isNotNull()
    answers = answers.withColumns({"call_status": F.when(has, a_out).otherwise(F.col("call_status")),
                                   "attempts": F.when(has, a_att).otherwise(F.col("attempts")),
                                   "backoff_s": F.when(has, a_back).otherwise(F.col("backoff_s"))})
    parsed = parse_answers(answers, "raw")
    strs = F.array().cast("array<string>")
    return parsed.select(
        *[c for c in parsed.columns if c not in ("_evaluate",) + PARSED_FIELDS + ("parse_status",)],
        # an answer exists only when the call succeeded
        *[F.when(F.col("_evaluate") & (F.col("call_status") == "ok"), F.col(c)).alias(c)
          for c in ("parse_status",) + PARSED_FIELDS])
