"""Published match cards (P7): one Markdown text per posted message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions.text import DASH, md_escape, nonempty, source_link

# ---- fixed values: the card template -------------------------------------------
# *{title or Vacancy}*[ — {company}]
# Score: {score}/100 · grade: {grade or unknown} · remote: {remote or unknown}
# Stack: {stack joined by ", " or —}
# Salary: {salary or —}
# Red flags: {red flags joined by ", " or —}
# (empty line)
# {reasoning}
# (empty line)
# Source: {chat title}[ · {link}]
DEFAULT_TITLE = "Vacancy"
UNKNOWN = "unknown"
SEP = " · "
COMPANY_SEP = " — "
# ----------------------------------------------------------------------------------


def _or(c: Column, default: str) -> Column:
    return F.coalesce(nonempty(c), F.lit(default))


def _joined(arr: Column) -> Column:
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, F.array_join(arr, ", ")).otherwise(F.lit(DASH))


def card_text(title, company, score, grade, remote, stack, salary, red_flags, reasoning, chat_title,
              link) -> Column:
    header = F.concat(F.lit("*"), md_escape(_or(title, DEFAULT_TITLE)), F.lit("*"),
                      F.when(nonempty(company).isNotNull(), F.concat(F.lit(COMPANY_SEP), md_escape(company)))
                      .otherwise(F.lit("")))
    line2 = F.concat(F.lit("Score: "), score.cast("string"), F.lit("/100" + SEP + "grade: "),
                     md_escape(_or(grade, UNKNOWN)), F.lit(SEP + "remote: "), md_escape(_or(remote, UNKNOWN)))
    src = F.concat(F.lit("Source: "), md_escape(chat_title),
                   F.when(link.isNotNull(), F.concat(F.lit(SEP), link)).otherwise(F.lit("")))
    return F.concat_ws("\n", header, line2,
                       F.concat(F.lit("Stack: "), md_escape(_joined(stack))),
                       F.concat(F.lit("Salary: "), md_escape(_or(salary, DASH))),
                       F.concat(F.lit("Red flags: "), md_escape(_joined(red_flags))),
                       F.lit(""), md_escape(F.coalesce(reasoning, F.lit(""))), F.lit(""), src)


def match_cards(routed: DataFrame) -> DataFrame:
    """Cards for the ``posted`` dispositions (the match sink's rows)."""
    p = routed.filter(F.col("disposition") == "posted")
    link = source_link("chat_id", "msg_id")
    return p.select(
        "chat_id", "msg_id", F.col("match_score").alias("score"),
        card_text(F.col("title"), F.col("company"), F.col("match_score"), F.col("grade"), F.col("remote"),
                  F.col("stack"), F.col("salary"), F.col("red_flags"), F.col("reasoning"),
                  F.col("chat_title"), link).alias("card"),
        link.alias("source_link"),
    )
