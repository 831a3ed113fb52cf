"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads the given tables (or fixtures Spark derives from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import schemas, session
from vetline.functions import text as tx
from vetline.functions.answers import parse_answers
from vetline.operators import cards, dedup, evaluate, route, state
from vetline.plans import report_cells, reports
from vetline.sources import allowlist
from vetline.sources import fixtures as fx
from vetline.sources import messages as msgs
from vetline.sources import seen_table
from vetline.sources.profile import profile_rules
from vetline.sources.tables import evolve, read_channels, read_dead, read_matches, read_seen, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---- reports -----------------------------------------------------------------
@register("overall_stats")
def q_overall_stats(spark, d):
    return reports.overall_stats(fx.fx_seen(spark, d))


@register("channel_stats")
def q_channel_stats(spark, d):
    return reports.channel_stats(fx.fx_channels(spark, d), fx.fx_seen(spark, d))


@register("channel_ranking")
def q_channel_ranking(spark, d):
    return reports.channel_ranking(fx.fx_channels(spark, d), fx.fx_seen(spark, d))


@register("dashboard_cards")
def q_dashboard_cards(spark, d):
    return reports.dashboard_cards(fx.fx_seen(spark, d), fx.fx_channels(spark, d))


def _listing(filter_type, channel_id=None, limit=reports.LIST_LIMIT):
    def q(spark, d):
        return reports.list_messages(fx.fx_seen(spark, d), fx.fx_channels(spark, d),
                                     filter_type=filter_type, channel_id=channel_id, limit=limit)
    return q


register("list_messages")(_listing("all"))
register("list_vacancies")(_listing("vacancies"))
register("list_not_vacancies")(_listing("not_vacancies"))
register("list_posted")(_listing("posted"))
register("list_by_channel")(_listing("vacancies", channel_id=7, limit=reports.LIST_PAGE_LIMIT))


@register("message_listing")
def q_message_listing(spark, d):
    rows = reports.list_messages(fx.fx_seen(spark, d), fx.fx_channels(spark, d),
                                 filter_type="all", limit=reports.LIST_PAGE_LIMIT)
    return reports.render_listing(rows)


@register("recent_matches")
def q_recent_matches(spark, d):
    return reports.recent_matches(fx.fx_seen(spark, d), fx.fx_channels(spark, d))


@register("list_page_titles")
def q_list_page_titles(spark, d):
    return reports.list_page_titles(fx.fx_channels(spark, d))


@register("channel_table")
def q_channel_table(spark, d):
    """The front page's channel table, rendered, in page order (``rank``)."""
    return reports.render_channels(reports.channel_ranking(fx.fx_channels(spark, d), fx.fx_seen(spark, d)))


@register("recent_table")
def q_recent_table(spark, d):
    """The front page's recent-matches table, rendered, at the page's limit."""
    return reports.render_recent(reports.recent_matches(fx.fx_seen(spark, d), fx.fx_channels(spark, d),
                                                        limit=reports.RECENT_PAGE_LIMIT))


# ---- shared pieces -------------------------------------------------------------
BACKFILL_CUTOFF = fx.BASE_EPOCH     # cutoff used with the fixtures
BACKFILL_TEST_CAP = 20              # binds at sf0.01 (50 messages per chat)
MIGRATION_EPOCH = 1705276800        # 2024-01-15: outcome rows before it lack the new columns


def _normalized(spark, d):
    return msgs.normalize(fx.fx_messages(spark, d))


def _distinct_messages(spark, d):
    return dedup.first_arrivals(_normalized(spark, d))


def _resolution(spark, d):
    return allowlist.resolve(allowlist.normalize_entries(fx.fx_allowlist_entries(spark, d)),
                             fx.fx_directory(spark, d))


# ---- ingest and text -------------------------------------------------------------
@register("messages_normalized")
def q_messages_normalized(spark, d):
    return _normalized(spark, d).select("chat_id", "msg_id", "source", "chat_title", "text", "n_chars")


@register("prefilter")
def q_prefilter(spark, d):
    n = _normalized(spark, d)
    return n.filter(tx.worth_evaluating("text")).select("chat_id", "msg_id", "source", "n_chars")


@register("chat_titles")
def q_chat_titles(spark, d):
    m = fx.fx_messages(spark, d).select("chat_id", "chat_title", "chat_username", "chat_first_name").distinct()
    return m.select(
        "chat_id",
        tx.chat_title("chat_title", "chat_username", "chat_first_name", "chat_id").alias("live_title"),
        tx.registration_title("chat_title", "chat_username", "chat_id").alias("registration_title"),
        tx.backfill_title("chat_title", "chat_username", "chat_id").alias("backfill_title"),
    )


@register("source_links")
def q_source_links(spark, d):
    m = fx.fx_messages(spark, d).select("chat_id", "msg_id").distinct()
    return m.select("chat_id", "msg_id", tx.source_link("chat_id", "msg_id").alias("link"))


@register("markdown_escape")
def q_markdown_escape(spark, d):
    m = fx.fx_messages(spark, d).select("chat_id", "msg_id", "text").distinct()
    esc = tx.md_escape("text")
    return m.select("chat_id", "msg_id", esc.alias("escaped"),
                    (F.length(esc) - F.length("text")).cast("bigint").alias("n_escaped"))


@register("sources_normalized")
def q_sources_normalized(spark, d):
    return allowlist.normalize_entries(fx.fx_allowlist_entries(spark, d))


@register("resolved_sources")
def q_resolved_sources(spark, d):
    return _resolution(spark, d)[0]


@register("unresolved_sources")
def q_unresolved_sources(spark, d):
    return _resolution(spark, d)[1]


@register("allowlisted_messages")
def q_allowlisted_messages(spark, d):
    resolved, _ = _resolution(spark, d)
    return allowlist.allowlisted(fx.fx_messages(spark, d), resolved).select("chat_id", "msg_id", "source")


# ---- dedup, backfill, state ------------------------------------------------------
def _backfill_pass(spark, d):
    """The backfill pass after the live pass: live arrivals are recorded."""
    n = _normalized(spark, d)
    live_seen = n.filter(F.col("source") == "live").select("chat_id", "msg_id")
    incoming = dedup.first_arrivals(n.filter(F.col("source") == "backfill"))
    return incoming, live_seen


@register("unseen_messages")
def q_unseen_messages(spark, d):
    incoming, seen = _backfill_pass(spark, d)
    return dedup.unseen(incoming, seen).select("chat_id", "msg_id", "source", "n_chars")


@register("dedup_skips")
def q_dedup_skips(spark, d):
    incoming, seen = _backfill_pass(spark, d)
    return dedup.already_seen(incoming, seen).select("chat_id", "msg_id", "source")


def _backfilled(spark, d):
    m = _distinct_messages(spark, d)
    return msgs.backfill(m, BACKFILL_CUTOFF, cap=BACKFILL_TEST_CAP)


@register("backfill_scan")
def q_backfill_scan(spark, d):
    b = _backfilled(spark, d)
    return b.select("chat_id", "msg_id", "date_s",
                    tx.backfill_title(F.col("chat_title"), F.col("chat_username"), F.col("chat_id")).alias("title"))


@register("backfill_scan_default")
def q_backfill_scan_default(spark, d):
    """The backfill scan at the service's default cap (200 per source)."""
    b = msgs.backfill(_distinct_messages(spark, d), BACKFILL_CUTOFF, cap=msgs.BACKFILL_CAP)
    return b.select("chat_id", "msg_id", "date_s",
                    tx.backfill_title(F.col("chat_title"), F.col("chat_username"), F.col("chat_id")).alias("title"))


@register("backfill_counts")
def q_backfill_counts(spark, d):
    counts = _backfilled(spark, d).groupBy("chat_id").agg(F.count(F.lit(1)).alias("n_scanned"))
    return (fx.fx_directory(spark, d).join(counts, "chat_id", "left")
            .select("chat_id", "handle", F.coalesce("n_scanned", F.lit(0).cast("bigint")).alias("n_scanned")))


def _seen_batches(spark, d):
    ev = read_table(spark, d, "events")
    ts = tx.epoch_seconds("ts")
    rescored = ev.filter(F.col("value") > 300).select(
        F.col("user_id").alias("chat_id"), F.col("event_id").alias("msg_id"),
        F.lit(True).alias("is_vacancy"), F.lit(100).alias("score"), F.lit(True).alias("posted"),
        F.lit("rescored").alias("title"), (ts + 86400).alias("ts"))
    marked = ev.filter((F.col("event_type") == "click") & (F.col("value") < 1)).select(
        F.col("user_id").alias("chat_id"), F.col("event_id").alias("msg_id"),
        F.lit(None).cast("boolean").alias("is_vacancy"), F.lit(None).cast("int").alias("score"),
        F.lit(False).alias("posted"), F.lit(None).cast("string").alias("title"), ts.alias("ts"))
    return state.seen_rows(rescored), state.seen_rows(marked)


@register("seen_upsert")
def q_seen_upsert(spark, d):
    b1, b2 = _seen_batches(spark, d)
    return state.upsert_seen(fx.fx_seen(spark, d), b1, b2)


@register("channels_upsert")
def q_channels_upsert(spark, d):
    chats = fx.fx_messages(spark, d).select("chat_id", "chat_title", "chat_username").distinct()
    regs = chats.select("chat_id", F.col("chat_username").alias("username"),
                        tx.registration_title("chat_title", "chat_username", "chat_id").alias("title"),
                        F.lit(0).alias("seq"))
    # a later registration (customers with a negative balance re-registered) wins
    cu = read_table(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("chat_id"), F.lit(None).cast("string").alias("username"),
        F.col("c_name").alias("title"), F.lit(1).alias("seq"))
    return state.upsert_channels(fx.fx_channels(spark, d), regs.unionByName(cu))


@register("channels_touch")
def q_channels_touch(spark, d):
    touches = fx.fx_seen(spark, d).select("chat_id", "ts").unionByName(
        fx.fx_messages(spark, d).select("chat_id", F.col("date_s").alias("ts")))
    return state.touch_channels(fx.fx_channels_base(spark, d), touches)


@register("schema_evolve")
def q_schema_evolve(spark, d):
    s = fx.fx_seen(spark, d)
    old = s.filter(F.col("ts") < MIGRATION_EPOCH).select(*[f.name for f in schemas.SEEN_V1.fields])
    new = s.filter(F.col("ts") >= MIGRATION_EPOCH)
    return evolve(old, new)


# ---- answers and scoring ---------------------------------------------------------
@register("score_clamp")
def q_score_clamp(spark, d):
    ev = read_table(spark, d, "events")
    raw = F.col("value") - 50
    return ev.select(F.col("event_id").alias("msg_id"), raw.alias("raw_score"), tx.clamp_score(raw).alias("score"))


def _parsed(spark, d):
    return parse_answers(session.spread(fx.fx_answers(spark, d)))


@register("parsed_answers")
def q_parsed_answers(spark, d):
    p = _parsed(spark, d)
    return p.select("chat_id", "msg_id", "parse_status", "is_vacancy", "title", "company",
                    F.array_join("stack", "|").alias("stack"), F.size("stack").alias("n_stack"),
                    "grade", "salary", "remote", "match_score", "reasoning",
                    F.array_join("red_flags", "|").alias("red_flags"), "should_apply")


@register("parse_status")
def q_parse_status(spark, d):
    p = _parsed(spark, d)
    dispo = (F.when(F.col("parse_status") != "ok", F.col("parse_status"))
             .when(~F.col("is_vacancy"), F.lit("not_vacancy"))
             .when(F.col("match_score") < route.DEFAULT_THRESHOLD, F.lit("below_threshold"))
             .otherwise(F.lit("posted")))
    return p.groupBy(dispo.alias("disposition")).agg(F.count(F.lit(1)).alias("n"))


@register("contract_checks")
def q_contract_checks(spark, d):
    return route.contract_checks(_parsed(spark, d))


@register("call_outcomes")
def q_call_outcomes(spark, d):
    return evaluate.call_outcomes(fx.fx_calls(spark, d)).drop("error")


@register("call_attempts")
def q_call_attempts(spark, d):
    calls = evaluate.attempt_outcomes(fx.fx_call_attempts(spark, d))
    return calls.select("chat_id", "msg_id", F.array_join(F.transform("attempt_statuses", lambda x: F.coalesce(
        x.cast("string"), F.lit("none"))), ",").alias("statuses"), "call_status", "attempts", "backoff_s")


@register("inference_requests")
def q_inference_requests(spark, d):
    m = _distinct_messages(spark, d).filter(tx.worth_evaluating("text"))
    return m.select("chat_id", "msg_id",
                    evaluate.inference_request(F.col("chat_title"), F.col("text")).alias("request"))


@register("rule_hits")
def q_rule_hits(spark, d):
    return evaluate.rule_hits(read_table(spark, d, "documents"), keys=("doc_id",))


@register("rule_scores")
def q_rule_scores(spark, d):
    return evaluate.rule_scores(read_table(spark, d, "documents"), keys=("doc_id",)).drop("rule_flags")


@register("usage_totals")
def q_usage_totals(spark, d):
    u = fx.fx_usage(spark, d)
    return u.groupBy("chat_id").agg(
        F.count(F.lit(1)).alias("calls"),
        *[F.sum(c).cast("bigint").alias(c) for c in
          ("input_tokens", "output_tokens", "cache_read_tokens", "cache_create_tokens")])


# ---- routing and end to end -------------------------------------------------------
def _routed_fx(spark, d):
    """Distinct messages evaluated by the fixture model results (fx_eval)."""
    m = _distinct_messages(spark, d)
    ev = fx.fx_eval(spark, d).withColumnRenamed("status", "call_status") \
        .withColumn("parse_status", F.lit("ok"))
    return route.route(m.join(ev, ["chat_id", "msg_id"]))


def _outcome_cols():
    return [F.col("out_is_vacancy").alias("is_vacancy"), F.col("out_score").alias("score"),
            F.col("out_posted").alias("posted"), F.col("out_title").alias("title")]


@register("dispositions")
def q_dispositions(spark, d):
    r = _routed_fx(spark, d)
    return r.select("chat_id", "msg_id", "disposition", *_outcome_cols(), "recorded")


@register("disposition_funnel")
def q_disposition_funnel(spark, d):
    # arrivals counted per (key, source) before any join: copies of one
    # message never reach a single task as rows
    counts = dedup.arrival_counts(_normalized(spark, d).select("chat_id", "msg_id", "source"))
    r = _routed_fx(spark, d).select("chat_id", "msg_id", F.col("disposition").alias("first_disposition"))
    per = counts.join(r, ["chat_id", "msg_id"], "left")
    repeat = (F.when(F.col("first_disposition") == "transient", F.lit("transient"))
              .otherwise(F.lit("dedup_skip")))
    parts = F.array(
        F.struct(F.col("first_disposition").alias("disposition"), F.col("n_primary").alias("n")),
        F.struct(repeat.alias("disposition"), (F.col("n") - F.col("n_primary")).alias("n")))
    return (per.select("source", F.explode(parts).alias("p")).filter(F.col("p.n") > 0)
            .groupBy("source", F.col("p.disposition").alias("disposition"))
            .agg(F.sum("p.n").cast("bigint").alias("n")))


@register("match_cards")
def q_match_cards(spark, d):
    return cards.match_cards(_routed_fx(spark, d))


def triage(arrivals, seen, rules=evaluate.FX_RULES, threshold=route.DEFAULT_THRESHOLD):
    """Normalise -> in-batch dedup -> flag seen -> rule scorer -> route."""
    from vetline.plans import jobs
    routed = jobs.triage_plan(arrivals, seen, jobs.rules_evaluator(rules, threshold), threshold)
    return routed.select("chat_id", "msg_id", "source", "disposition", *_outcome_cols())


@register("triage_end_to_end")
def q_triage_end_to_end(spark, d):
    return triage(fx.fx_messages(spark, d), fx.fx_seen(spark, d))


@register("scorer_hook")
def q_scorer_hook(spark, d):
    """E1 with a user batch scorer (Arrow batches via mapInPandas): a
    deterministic stand-in for the model service."""
    from vetline.plans import jobs
    routed = jobs.triage_plan(fx.fx_messages(spark, d), spark.createDataFrame([], schemas.SEEN),
                              jobs.batch_evaluator(fx.fx_scorer))
    return routed.select("chat_id", "msg_id", "disposition", *_outcome_cols())


# ---- logs, sources and the assembled jobs ------------------------------------------
def _replayed_log(spark, d):
    """An outcome log in which clicks were recorded by run 1, again by run 2 with another
    score, and view events by run 2 and (a late replay) by run 1 once more."""
    s = fx.fx_seen(spark, d)
    one, two = s.withColumn("run", F.lit(1).cast("bigint")), s.withColumn("run", F.lit(2).cast("bigint"))
    again = two.filter(F.col("msg_id") % 4 == 1).withColumn("score", (F.col("msg_id") % 100).cast("int"))
    late = one.filter(F.col("msg_id") % 4 == 2).withColumn("score", F.lit(1)).withColumn("posted", F.lit(1))
    return one.unionByName(again).unionByName(two.filter(F.col("msg_id") % 4 == 2)).unionByName(late)


@register("seen_latest")
def q_seen_latest(spark, d):
    """The outcome table behind a log with replayed rows, written to and read from the log."""
    path = session.scratch_path(spark, "seen-log")
    _replayed_log(spark, d).write.parquet(path)
    return read_seen(spark, path)


@register("overall_stats_log")
def q_overall_stats_log(spark, d):
    path = session.scratch_path(spark, "seen-log")
    _replayed_log(spark, d).write.parquet(path)
    return reports.overall_stats(read_seen(spark, path))


@register("seen_since")
def q_seen_since(spark, d):
    """Rows recorded since a day, from the day-partitioned log (older days are not read)."""
    path = session.scratch_path(spark, "seen-days")
    (fx.fx_seen(spark, d).select("*", F.lit(1).cast("bigint").alias("run"), F.to_date(tx.from_epoch("ts")).alias("dt"))
     .hint("rebalance", "dt").write.partitionBy("dt").parquet(path))
    return read_seen(spark, path, since_epoch=MIGRATION_EPOCH)


@register("channel_scan")
def q_channel_scan(spark, d):
    """The channel table written and read back with its fixed schema."""
    path = session.scratch_path(spark, "channels")
    fx.fx_channels(spark, d).write.parquet(path)
    return read_channels(spark, path)


@register("allowlist_file")
def q_allowlist_file(spark, d):
    """The allow-list as its JSON file, read and checked."""
    path = session.scratch_path(spark, "allowlist")
    entries = fx.fx_allowlist_entries(spark, d).filter(~F.col("entry").isin('"  "') & ~F.col("entry").endswith(".5"))
    one = entries.agg(F.sort_array(F.collect_list(F.struct("pos", "entry"))).alias("e"))     # a file of one array
    one.select(F.concat(F.lit('{"chats": ['), F.array_join(F.transform("e", lambda x: x["entry"]), ", "), F.lit("]}"))) \
        .coalesce(1).write.text(path)
    return allowlist.load_sources(spark, path)


@register("channel_arguments")
def q_channel_arguments(spark, d):
    """A command's channel argument as an id or a handle."""
    a = fx.fx_directory(spark, d).select(F.explode(F.array(
        F.col("chat_id").cast("string"), F.col("handle"), F.concat(F.lit(" @"), F.col("handle"), F.lit(" ")),
        F.concat(F.lit("+"), F.abs("chat_id").cast("string")))).alias("argument")).distinct()
    return a.select("argument", tx.parse_channel("argument").alias("p")).select("argument", "p.*")


@register("list_unknown_type")
def q_list_unknown_type(spark, d):
    """An unknown listing filter shows everything."""
    return reports.list_messages(fx.fx_seen(spark, d), fx.fx_channels(spark, d), filter_type="no such filter")


@register("union_arrivals")
def q_union_arrivals(spark, d):
    """Live and backfilled messages as one frame tagged by where they came from."""
    m = fx.fx_messages(spark, d)
    both = dedup.union_arrivals(m.filter(F.col("source") == "live").drop("source"),
                                m.filter(F.col("source") == "backfill").drop("source", "chat_first_name"))
    return both.groupBy("chat_id", "source").agg(F.count(F.lit(1)).alias("n"), F.min("msg_id").alias("first"), F.max("msg_id").alias("last"))


@register("empty_answers")
def q_empty_answers(spark, d):
    """Answers without content are read as empty objects."""
    a = fx.fx_answers(spark, d).withColumn("raw", F.when(F.col("msg_id") % 10 < 5, F.col("raw")))
    return parse_answers(a.filter(F.col("raw").isNull())).select(
        "chat_id", "msg_id", "parse_status", "is_vacancy", "grade", "remote", "match_score", F.size("stack").alias("n_stack"))


@register("backfill_job")
def q_backfill_job(spark, d):
    """The start of the service: resolve, register, backfill, join with live messages, triage; its outcome table."""
    from vetline.plans import jobs
    out = session.scratch_path(spark, "backfill-job")
    m = fx.fx_messages(spark, d)
    jobs.run_backfill(
        spark, allowlist.normalize_entries(fx.fx_allowlist_entries(spark, d)), fx.fx_directory(spark, d),
        dedup.first_arrivals(m.filter(F.col("source") == "backfill")).drop("source"), BACKFILL_CUTOFF, f"{out}/seen", f"{out}/matches",
        live=m.filter(F.col("source") == "live").drop("source"), cap=BACKFILL_TEST_CAP, run_ts=BACKFILL_CUTOFF, first_run=True,
        channels_out=f"{out}/channels")
    return read_seen(spark, f"{out}/seen")


@register("profile_rules")
def q_profile_rules(spark, d):
    """S4: the scoring rules that profile texts state."""
    return profile_rules(fx.fx_profiles(spark, d))


@register("rule_hits_many")
def q_rule_hits_many(spark, d):
    """J8 with many rules: every longer word of the benchmark is one; the documents each is found in."""
    words = read_table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{6,}"), F.lit(0))).alias("w"))
    rules = [evaluate.Rule(k, "signal", r["w"], 1) for k, r in enumerate(words.distinct().orderBy("w").collect())]
    hits = evaluate.rule_hits(read_table(spark, d, "documents"), rules, keys=("doc_id",))
    return hits.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


# run times of three runs, and when a try may follow
LEDGER_RUNS, LEDGER_WAIT_S, LEDGER_TRIES = (1000, 1150, 1400), 100, 3


@register("retry_ledger")
def q_retry_ledger(spark, d):
    """E2 over three runs: a call's status follows the message and the run, and four of eight are transient; a
    fifth of the messages arrive with the last run.  What became of each message."""
    from vetline.plans import jobs
    out = session.scratch_path(spark, "ledger")
    m = fx.fx_messages(spark, d)
    late = F.col("msg_id") % 5 == 4
    for k, now in enumerate(LEDGER_RUNS):
        def scorer(df, mask, k=k):
            e = evaluate.evaluate_with_rules(df, mask=mask)
            return e.withColumn("call_status", F.when((F.col("msg_id") + k) % 8 < 4, F.when(mask, F.lit("transient"))).otherwise(F.col("call_status")))
        arrivals = m.filter(~late) if k == 0 else m.filter(late) if k == 2 else m.limit(0)
        jobs.run_triage(spark, arrivals, f"{out}/seen", f"{out}/matches", scorer, run_ts=now, first_run=not k, retry_in=f"{out}/retry/{k - 1}" if k else None,
                        retry_out=f"{out}/retry/{k}", dead_out=f"{out}/dead", max_tries=LEDGER_TRIES, retry_wait_s=LEDGER_WAIT_S)
    none = F.lit(None)
    seen = read_seen(spark, f"{out}/seen").select("chat_id", "msg_id", F.lit("recorded").alias("state"), none.cast("int").alias("tries"), F.col("ts").alias("at"))
    waiting = spark.read.schema(schemas.RETRY).parquet(f"{out}/retry/2").select("chat_id", "msg_id", F.lit("waiting").alias("state"), "tries", F.col("due").alias("at"))
    dead = read_dead(spark, f"{out}/dead").select("chat_id", "msg_id", F.lit("given up").alias("state"), "tries", none.cast("bigint").alias("at"))
    return seen.unionByName(waiting).unionByName(dead)


@register("backfill_marked")
def q_backfill_marked(spark, d):
    """S2 twice: the second backfill, of a history that has grown, reads only what is newer than the marks of the first."""
    from vetline.plans import jobs
    out = session.scratch_path(spark, "backfill-marked")
    m = dedup.first_arrivals(fx.fx_messages(spark, d)).drop("source")
    directory = fx.fx_directory(spark, d)
    sources = directory.select(F.col("chat_id").alias("pos"), F.lit("id").alias("kind"), F.lit(None).cast("string").alias("username"), "chat_id")
    upto = m.agg(F.max("msg_id")).first()[0] * 6 // 10
    for k, history in enumerate((m.filter(F.col("msg_id") <= upto), m)):
        jobs.run_backfill(spark, sources, directory, history, BACKFILL_CUTOFF, f"{out}/seen", f"{out}/matches", cap=BACKFILL_TEST_CAP,
                          marks_in=f"{out}/marks/{k - 1}", marks_out=f"{out}/marks/{k}", run_ts=100 * (k + 1), first_run=not k)
    return read_seen(spark, f"{out}/seen")


@register("triage_bucketed")
def q_triage_bucketed(spark, d):
    """J1 against an outcome log in buckets of its key: what a run decided."""
    from vetline.plans import jobs
    out = session.scratch_path(spark, "bucketed")
    seen_table.rebucket(fx.fx_seen(spark, d).withColumn("run", F.lit(1).cast("bigint")), f"{out}/seen", 8)
    jobs.run_triage(spark, fx.fx_messages(spark, d), f"{out}/seen", f"{out}/matches", run_ts=MIGRATION_EPOCH, seen_buckets=8,
                    dispositions_out=f"{out}/told")
    return spark.read.parquet(f"{out}/told")


def _cells_of_replays(spark, d):
    """The cells of a log that is written in three runs, with replaced rows and a late replay."""
    path = session.scratch_path(spark, "cells")
    s = fx.fx_seen(spark, d)
    one, two = s.withColumn("run", F.lit(1).cast("bigint")), s.withColumn("run", F.lit(2).cast("bigint"))
    again = two.filter(F.col("msg_id") % 4 == 1).withColumn("score", (F.col("msg_id") % 100).cast("int")).unionByName(two.filter(F.col("msg_id") % 4 == 2))
    late = one.filter(F.col("msg_id") % 4 == 2).withColumn("score", F.lit(1)).withColumn("posted", F.lit(1))
    report_cells.append_run(spark, path, one.limit(0), one, 1)
    report_cells.append_run(spark, path, one, again, 2)
    report_cells.append_run(spark, path, one.unionByName(again), late, 3)
    return report_cells.read_cells(spark, path)


@register("overall_stats_cells")
def q_overall_stats_cells(spark, d):
    """A1 kept up to date run by run."""
    return report_cells.overall_stats(_cells_of_replays(spark, d))


@register("channel_stats_cells")
def q_channel_stats_cells(spark, d):
    """A2 kept up to date run by run."""
    return report_cells.channel_stats(fx.fx_channels(spark, d), _cells_of_replays(spark, d))


@register("seen_compacted_days")
def q_seen_compacted_days(spark, d):
    """W2: the replayed log after its days with replaced rows were compacted in place; its rows as they lie."""
    from vetline.plans import jobs
    path = session.scratch_path(spark, "seen-days")
    log = _replayed_log(spark, d).withColumn("ts", F.col("ts") + F.when(F.col("run") == 2, 86400).otherwise(0))
    log.select("*", F.to_date(tx.from_epoch("ts")).alias("dt")).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    jobs.compact_days(spark, path)
    return spark.read.schema(schemas.SEEN_LOG).parquet(path).select(*[f.name for f in schemas.SEEN_LOG.fields])


# ---- streaming -------------------------------------------------------------------
STREAM_DOWN = 50        # conversations with this remainder of 50 find the scorer unavailable


def _stream_evaluator(df, mask):
    e = evaluate.evaluate_with_rules(df, mask=mask)
    return e.withColumn("call_status", F.when(F.col("chat_id") % STREAM_DOWN == 7, F.when(mask, F.lit("transient")))
                        .otherwise(F.col("call_status")))


@register("stream_triage")
def q_stream_triage(spark, d):
    """The live service over the conversations as several files, 20 messages of which arrive twice; opening
    turns are in the outcome log, and for some conversations the scorer is unavailable.  What was decided last
    for each message that was not skipped."""
    from vetline.streaming import triage_stream as ts
    base = session.scratch_path(spark, "stream")
    conv = read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    conv.repartition(4).write.parquet(f"{base}/in")
    (ts.first_turns_seen(spark, d).select("*", F.lit(0).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("run"),
                                          F.lit("1970-01-01").cast("date").alias("dt")).write.partitionBy("dt").parquet(f"{base}/seen"))
    def drain():
        ts.drain_to_tables(spark, ts.conversation_stream(spark, f"{base}/in", max_files_per_trigger=3), f"{base}/live",
                           f"{base}/seen", f"{base}/matches", _stream_evaluator)
    drain()
    # the fixture's repeats: 20 messages arrive once more, in a file of their own; the next run goes on where the first was
    conv.filter(F.col("turn") > 0).orderBy("conv_id", "turn").limit(20).write.mode("append").parquet(f"{base}/in")
    drain()
    told = ts.read_dispositions(spark, f"{base}/live").filter(F.col("disposition") != "dedup_skip")
    values = [c for c in ts.OUTPUT_COLS if c not in ("chat_id", "msg_id")]
    last = F.max(F.struct("run", *values)).alias("w")
    return told.groupBy("chat_id", "msg_id").agg(last).select("chat_id", "msg_id", *(F.col(f"w.{c}").alias(c) for c in values))


@register("stream_cards")
def q_stream_cards(spark, d):
    """X2: the cards a drained stream leaves for the messages it posts, beside their rows of the outcome log."""
    from vetline.streaming import triage_stream as ts
    base = session.scratch_path(spark, "stream-cards")
    read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text").repartition(2).write.parquet(f"{base}/in")
    ts.drain_to_tables(spark, ts.conversation_stream(spark, f"{base}/in"), f"{base}/live", f"{base}/seen", f"{base}/matches", first_run=True, run_ts=BACKFILL_CUTOFF)
    cards_ = read_matches(spark, f"{base}/matches").select("chat_id", "msg_id", F.col("score").alias("card_score"), "card", "source_link")
    return read_seen(spark, f"{base}/seen").join(cards_, schemas.SEEN_KEY, "left").select(
        "chat_id", "msg_id", "is_vacancy", "score", "posted", "ts", "card_score", "card", "source_link")
