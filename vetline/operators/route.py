"""Disposition routing (E4) and answer-contract checks (F8/F9).

One ``CASE`` chain assigns exactly one disposition per message; the outcome
row, the published card and the funnel are projections of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions.text import MIN_TEXT_LEN, worth_evaluating

# ---- fixed values -------------------------------------------------------------
DEFAULT_THRESHOLD = 70
DISPOSITIONS = ("dedup_skip", "too_short", "transient", "crash", "parse_error",
                "not_vacancy", "below_threshold", "posted")
GRADES = ("junior", "middle", "senior", "staff", "lead", "unknown")
REMOTES = ("full", "hybrid", "onsite", "unknown")
MAX_REASONING_SENTENCES = 2
# a sentence ends at a run of . ! ? or an ellipsis followed by whitespace or the end
SENTENCE_END = r"[.!?\u2026]+(?:[ \t\n\r\f]|\z)"
SENTENCE_STOP = r"[.!?\u2026]\z"
# -------------------------------------------------------------------------------


def n_sentences(text: Column) -> Column:
    """Sentences in a (stripped) text: terminated ones plus an unterminated tail."""
    tail = F.when((F.length(text) > 0) & ~text.rlike(SENTENCE_STOP), 1).otherwise(0)
    return F.regexp_count(text, F.lit(SENTENCE_END)) + tail


def disposition(text: Column, call_status: Column, parse_status: Column, is_vacancy: Column,
                score: Column, threshold: int = DEFAULT_THRESHOLD, min_len: int = MIN_TEXT_LEN,
                in_seen: Column | None = None, worth: Column | None = None) -> Column:
    """``text`` may be None when ``worth`` (the junk-filter flag) is given."""
    worth = worth if worth is not None else worth_evaluating(text, min_len)
    first = F.when(in_seen, F.lit("dedup_skip")).when(~worth, F.lit("too_short")) \
        if in_seen is not None else F.when(~worth, F.lit("too_short"))
    return (first
            .when(call_status == "transient", F.lit("transient"))
            .when((call_status == "crash") | (parse_status == "crash"), F.lit("crash"))
            .when(parse_status == "parse_error", F.lit("parse_error"))
            .when(~F.coalesce(is_vacancy, F.lit(False)), F.lit("not_vacancy"))
            .when(score < F.lit(threshold), F.lit("below_threshold"))
            .otherwise(F.lit("posted")))


def route(evaluated: DataFrame, threshold: int = DEFAULT_THRESHOLD, min_len: int = MIN_TEXT_LEN,
          text_col: str = "text", seen_col: str | None = None, worth_col: str | None = None) -> DataFrame:
    """Add ``disposition`` and the outcome columns it implies.

    Expects ``call_status``, ``parse_status``, ``is_vacancy``, ``match_score``
    and ``title`` (and, with ``seen_col``, a flag for keys already recorded:
    ``dedup_skip``).  ``recorded`` is false for ``transient`` (left unrecorded
    so the message is retried by a later run) and for ``dedup_skip``.
    """
    d = disposition(None if worth_col else F.col(text_col), F.col("call_status"), F.col("parse_status"),
                    F.col("is_vacancy"), F.col("match_score"), threshold, min_len,
                    F.col(seen_col) if seen_col else None, F.col(worth_col) if worth_col else None)
    e = evaluated.withColumn("disposition", d)
    dc = F.col("disposition")
    vac = dc.isin("below_threshold", "posted")
    return e.select(
        "*",
        F.when(vac, 1).when(dc.isin("too_short", "parse_error", "not_vacancy"), 0).cast("int").alias("out_is_vacancy"),
        F.when(dc.isin("parse_error", "not_vacancy", "below_threshold", "posted"), F.col("match_score"))
         .cast("int").alias("out_score"),
        F.when(dc == "posted", 1).when(dc != "dedup_skip", 0).alias("out_posted"),
        F.when(vac, F.col("title")).alias("out_title"),
        (~dc.isin("transient", "dedup_skip")).alias("recorded"),
    )


def contract_checks(parsed: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Data-quality counts of parsed answers against the answer contract:
    enum domains, score range, ``should_apply`` versus the apply rule
    (score >= threshold and no red flags), non-vacancies with a score, and
    reasoning longer than two sentences.  Only ``ok`` answers count; the
    condition sits inside each aggregate (one pass, no filter)."""
    ok = F.col("parse_status") == "ok"
    rule = (F.col("match_score") >= threshold) & (F.size("red_flags") == 0)

    def n(c):
        return F.sum(F.when(ok & c, 1).otherwise(0)).cast("bigint")

    return parsed.agg(
        n(F.lit(True)).alias("answers"),
        n(~F.col("grade").isin(*GRADES)).alias("bad_grade"),
        n(~F.col("remote").isin(*REMOTES)).alias("bad_remote"),
        n((F.col("match_score") < 0) | (F.col("match_score") > 100)).alias("bad_score"),
        n(F.col("should_apply") != rule).alias("apply_mismatch"),
        n(rule).alias("apply_by_rule"),
        n(F.col("is_vacancy")).alias("vacancies"),
        # a non-vacancy is a stub with score 0; reasoning is at most 2 sentences
        n(~F.col("is_vacancy") & (F.col("match_score") != 0)).alias("scored_non_vacancy"),
        n(n_sentences(F.col("reasoning")) > MAX_REASONING_SENTENCES).alias("long_reasoning"),
    )
