"""The candidate profile document (S4).

The profile is configuration: one markdown file.  Its text is read
whole and must not be blank.  ``profile_rules`` reads the scoring rules out of
its checklists, and ``load_profile_rules`` hands them to the scorer
(``vetline.operators.evaluate.Rule``) as job parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import session
from vetline.functions.text import PY_WHITESPACE


def load_profile(spark: SparkSession, path: str) -> str:
    """Stripped profile text; fails when the file is empty or blank."""
    df = spark.read.text(path, wholetext=True).select(F.btrim("value", F.lit(PY_WHITESPACE)).alias("t"))
    row = df.first()
    text = row["t"] if row else ""
    if not text:
        raise RuntimeError(f"Profile file is empty: {path}")
    return text


# ---- fixed values -------------------------------------------------------------
# A checklist's heading tells what its items are: "(match_score < 30)" blocks,
# "(match_score < 40)" is a hard mismatch, "(match_score 75+)" is a signal.
BLOCKER_BELOW = 30
BLOCKER_WEIGHT, HARD_WEIGHT = -40, -20
BASE_SCORE = 30
SIGNALS_TO_REACH = 3        # strong signals that lift the base score to the stated one
# table rows by the status in their second cell
HARD_STATUS, BLOCKER_STATUS = "no", "hard blocker"
# -------------------------------------------------------------------------------

_SECTION = r"\n(?=## )"
_LIST = r"\n(?=\*\*|### )"
_ITEM = r"(?m)^[ \t]*[-*] +([^\n]*[^\s])"
_ROW = r"(?m)^\|[ \t]*([^|\n]*[^|\s])[ \t]*\|[ \t]*([^|\n]*[^|\s])[ \t]*\|[ \t]*$"


def _terms(item: Column) -> Column:
    """The alternatives an item names: what stands before a parenthesis,
    between slashes, commas and "or"; those of two code points and more."""
    head = F.regexp_replace(item, r"\(.*$", "")
    parts = F.split(head, r"\s*/\s*|\s*,\s*|\s+or\s+")
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"^(?:Requires|Mentions of|Roles that require)\s+", ""))),
                    lambda x: F.char_length(x) >= 2)


def profile_rules(profiles: DataFrame, id_col: str = "profile_id", text_col: str = "text") -> DataFrame:
    """The scoring rules a profile's text states: ``(id, rule_id, section,
    heading, kind, pattern, weight)``, numbered from 1 as they stand.

    A profile is Markdown: ``## 8. Section``; in it checklists under ``**Heading**``
    or ``### Heading`` with ``- items``, and tables.  What a checklist says follows from
    its heading's ``match_score`` (above), else items are blockers in a
    section named for blockers, and nothing elsewhere.  A table row
    is a blocker or a hard mismatch by its second cell.  Each alternative
    an item names is one rule, a case-insensitive pattern at word boundaries, so the
    rule index finds it by its text.  Null or blank texts state none.

    One profile is one row, read whole; its rules are shuffled, to be numbered, and before
    that the profiles of a scan of few splits, to be parsed on all cores.
    """
    profiles = session.spread(profiles)
    text = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\r\n?", "\n")
    sections = profiles.select(F.col(id_col), F.posexplode(F.split(F.concat(F.lit("\n"), text), _SECTION)).alias("s", "part"))
    sections = sections.select(id_col, "s", "part", F.trim(F.regexp_extract("part", r"^## +(?:\d+\. *)?([^\n]*)", 1)).alias("section"))
    lists = sections.select(id_col, "s", "section", F.posexplode(F.split("part", _LIST)).alias("l", "list"))
    heading = F.trim(F.regexp_extract("list", r"^(?:\*\*|### )([^\n]*?):?(?:\*\*)?[ \t]*(?:\n|$)", 1))
    lists = lists.select(id_col, "s", "l", "section", heading.alias("heading"), "list")
    items = F.transform(F.regexp_extract_all("list", F.lit(_ITEM), F.lit(1)), lambda x: F.struct(F.lit(None).cast("string").alias("status"), x.alias("item")))
    first, second = (F.regexp_extract_all("list", F.lit(_ROW), F.lit(k)) for k in (1, 2))
    table = F.transform(F.arrays_zip(first.alias("a"), second.alias("b")), lambda r: F.struct(r["b"].alias("status"), r["a"].alias("item")))
    each = lists.select(id_col, "s", "l", "section", "heading", F.posexplode(F.concat(items, table)).alias("k", "x"))
    below = F.regexp_extract("heading", r"match_score *< *(\d+)", 1)
    above = F.regexp_extract("heading", r"match_score *(\d+)\+", 1)
    status = F.lower(F.col("x.status"))
    kind = (F.when(status.isNotNull(), F.when(status.contains(BLOCKER_STATUS), "blocker").when(status.rlike(rf"^{HARD_STATUS}\b"), "hard"))
            .when(below != "", F.when(below.cast("int") <= BLOCKER_BELOW, "blocker").otherwise("hard"))
            .when(above != "", "signal")
            .when(F.lower("section").contains("blocker"), "blocker"))
    weight = (F.when(F.col("kind") == "signal", F.ceil((above.cast("int") - BASE_SCORE) / SIGNALS_TO_REACH).cast("int"))
              .when(F.col("kind") == "hard", HARD_WEIGHT).otherwise(BLOCKER_WEIGHT))
    told = each.select("*", kind.alias("kind")).filter("kind is not null").select(
        id_col, "s", "l", "k", "section", "heading", "kind", weight.alias("weight"), F.posexplode(_terms(F.col("x.item"))).alias("t", "term"))
    # a boundary where the term ends in a word character
    quoted = F.regexp_replace("term", r"([^\p{L}\p{N} ])", r"\\$1")
    pattern = F.concat(F.lit("(?i)"), F.when(F.col("term").rlike(r"^\w"), r"\b").otherwise(""), quoted, F.when(F.col("term").rlike(r"\w$"), r"\b").otherwise(""))
    rows = told.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("s", "l", "k", "t", "section", "heading", "kind", pattern.alias("pattern"), "weight"))).alias("r"))
    return rows.select(id_col, F.posexplode("r").alias("p", "x")).select(
        id_col, (F.col("p") + 1).alias("rule_id"), "x.section", "x.heading", "x.kind", "x.pattern", "x.weight")


def load_profile_rules(spark: SparkSession, path: str) -> tuple:
    """The rules of the profile at ``path`` for the scorer; none is an error.
    One profile's rules come to the driver: they are the job's parameters."""
    from vetline.operators.evaluate import Rule
    df = spark.createDataFrame([(0, load_profile(spark, path))], "profile_id int, text string")
    rules = tuple(Rule(r["rule_id"], r["kind"], r["pattern"], r["weight"]) for r in profile_rules(df).orderBy("rule_id").collect())
    if not rules:
        raise RuntimeError(f"Profile states no rules: {path}")
    return rules
