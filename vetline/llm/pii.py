"""Personal data by weak supervision.

Patterns propose spans.  Labelers (strict patterns and checksums, known forms,
the words before a span, what it touches, a gazetteer) vote on each: personal,
not, or nothing.  Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; its posteriors train a final classifier, a
naive Bayes over a span's form, which decides on the spans that no strict rule
settles.  Spans told by their signs (addresses of machines, numbers, keys) and spans
told by their words (names, street addresses) have labelers and a classifier
each.  Spans of the strict rules always stay; others are added where they overlap none.

The gazetteer is a table of words and what they are, joined to the different
words of the proposed names and addresses; it may be of any size.

Everything runs as DataFrame expressions.  To the driver come the counts of
vote patterns (3 ** 5 rows at most) and of form values (some dozens).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetline.llm import common as c

# ---- fixed values --------------------------------------------------------------
BASE = ("email", "ip", "card", "phone")         # in the order of reports
ADDED = ("secret", "local", "name", "address")
WORDY = ("name", "address")                     # told by their words
# titles before a name, and a capitalised word
TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Sir|Herr|Frau|Mme|Mlle|Monsieur|Madame|Sr|Sra|Don)\.?\x20"
WORD = r"\p{Lu}[\p{L}'\u2019-]*+(?![\p{L}\p{N}])"
# The first four are the stated patterns.  A run is tried from its first sign only (or from where the last match
# ended) and never given back: the same matches, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{12,}+",
    "local": r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{3,4}(?![0-9])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{TITLE}{WORD}(?:\x20{WORD})*+|{WORD}(?:\x20{WORD})++)",
    "address": rf"(?<![\p{{L}}\p{{N}}])(?:[0-9]{{1,5}}[a-z]?,?\x20(?:(?:rue|avenue|calle|via)\x20)?(?:d(?:e|u|es)\x20)?(?:la\x20)?{WORD}(?:\x20{WORD})*+"
               rf"|{WORD}(?:\x20{WORD})*+,?\x20[0-9]{{1,5}}[a-z]?(?![\p{{L}}\p{{N}}]))",
}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"
PERSONAL_WORDS = r"(?i)\b(?:e-?mail|mail|contact|call|phone|tel|fax|mobile|ip|host|card|visa|iban|account|password|passwd|pwd|token|secret|key|api|login|user)\W*$"
OTHER_WORDS = r"(?i)\b(?:version|v|section|chapter|figure|fig|table|page|isbn|issn|release|build|rev|no|commit|sha|md5|id)\W*$"
KNOWN_FORMS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]+|sk-[A-Za-z0-9]+|xox[abp]-.*|\+?1?[\x20.-]?\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|4[0-9]{15}|5[1-5][0-9]{14}|.*@.*\.(?:com|net|org|edu|gov|io|de|fr|es|uk))$"
KNOWN_HARMLESS = r"^(?:0\.0\.0\.0|127\.0\.0\.1|255\.255\.255\.255|(?:19|20)[0-9]{2}[\x20-](?:19|20)[0-9]{2}|([0-9])(?:[\x20-]?\1)*+)$"
NAME_WORDS = r"(?i)(?:\b(?:name|name is|dear|regards|sincerely|signed|patient|author|nom|nombre|geehrter?|cher|ch\u00e8re|estimad[oa])[\s:,]*)$"
ADDRESS_WORDS = r"(?i)\b(?:address|lives at|living at|resident of|adresse|wohnt in|wohnhaft|habite au|demeurant|direcci\u00f3n|domicilio|vive en)[\s:,]*$"
STREET_FORM = r"(?i)(?:stra\u00dfe|strasse|gasse|allee|platz|weg)\x20[0-9]+[a-z]?$"
# What a word is: names and titles speak for a name, streets and places for an address; places and bodies speak against a name.
GAZETTEER = {
    "given": "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan "
             "jessica sarah karen peter paul mark anna maria laura emma sophie marie jean pierre louis fran\u00e7ois jacques nicolas camille "
             "julie claire hans klaus j\u00fcrgen stefan wolfgang heike sabine petra ursula andreas jos\u00e9 juan carlos luis antonio manuel "
             "carmen isabel luc\u00eda elena",
    "family": "smith johnson williams brown jones miller davis wilson taylor anderson martin bernard dubois durand moreau lefebvre m\u00fcller "
              "schmidt schneider fischer weber meyer wagner becker garc\u00eda fern\u00e1ndez gonz\u00e1lez rodr\u00edguez l\u00f3pez mart\u00ednez s\u00e1nchez p\u00e9rez",
    "title": "mr mrs ms dr prof sir herr frau mme mlle monsieur madame sr sra don",
    "street": "street road avenue lane drive boulevard square court highway st rd ave blvd rue calle avenida plaza paseo via",
    "place": "london paris berlin madrid vienna zurich rome hamburg munich lyon marseille barcelona sevilla york angeles chicago boston "
             "houston toronto sydney",
    "body": "license university company corporation inc ltd gmbh foundation department ministry institute bank",
}
LABELERS = ("strict", "known", "context", "touching", "mixed")
BELIEF = 0.5            # of the labelers of names and addresses
WORDY_LABELERS = ("known", "context", "touching", "gazetteer")
# ---------------------------------------------------------------------------------


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits (at most 19) pass the Luhn test."""
    def add(s, d, i):
        twice = d * (1 + F.pmod(i, F.lit(2)))
        return s + twice - F.when(twice > 9, 9).otherwise(0)
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(each, F.lit(0), lambda s, x: add(s, x["d"], x["i"])) % 10 == 0


def candidates(texts: DataFrame) -> DataFrame:
    """Matches of all patterns in ``(t1, t2, text)``: kind, ``start``, ``stop``
    (code points), the match, what stands before it (40 code points at most,
    from the match before) and the code point after it."""
    digit, at, plus = (F.col("text").rlike(p) for p in ("[0-9]", "@", r"\+"))
    named = F.col("text").rlike(PATTERNS["name"])
    asked = {"email": at, "ip": digit, "card": digit, "phone": plus, "secret": digit, "local": digit, "name": named, "address": digit}

    def of(kind: str) -> Column:
        p = F.lit(PATTERNS[kind])
        return F.when(asked[kind], F.struct(F.lit(kind).alias("kind"), F.regexp_extract_all("text", p, F.lit(0)).alias("m"),
                                            F.split("text", PATTERNS[kind], -1).alias("parts")))
    some = texts.where(digit | at | plus | named).select("t1", "t2", F.explode(F.array(*map(of, PATTERNS))).alias("k")).where(
        "size(k.m) > 0").select("t1", "t2", "k.*")
    parts = F.transform("parts", lambda x: F.struct(F.char_length(x).alias("n"), F.right(x, F.lit(40)).alias("before"),
                                                    F.left(x, F.lit(1)).alias("first")))
    each = some.select("t1", "t2", "kind", "m", parts.alias("parts")).select(
        "t1", "t2", "kind", "m", "parts", F.posexplode("m").alias("i", "match")).select(
        "t1", "t2", "kind", "i", "match", F.col("parts")[F.col("i")]["n"].alias("n"), F.col("parts")[F.col("i")]["before"].alias("before"),
        F.col("parts")[F.col("i") + 1]["first"].alias("after")).distinct()      # copies of one text give the same rows
    upto = F.sum(F.col("n") + F.char_length("match")).over(
        Window.partitionBy("t1", "t2", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return each.withColumn("stop", upto).withColumn("start", F.col("stop") - F.char_length("match")).drop("n", "i")


def gazetteer(spark: SparkSession) -> DataFrame:
    """The fixed words as a table (``word``, lower-cased, and ``what``)."""
    each = (F.struct(F.lit(w).alias("word"), F.lit(k).alias("what")) for k, ws in GAZETTEER.items() for w in ws.split())
    return spark.range(1).select(F.inline(F.array(*each)))


def _heard(found: DataFrame, words: DataFrame) -> DataFrame:
    """``(kind, match, gazetteer)`` of the different names and addresses that have a word in the gazetteer:
    1, -1, or 0 where its words speak for and against."""
    different = found.where(F.col("kind").isin(*WORDY)).select("kind", "match").distinct()
    tokens = F.array_distinct(F.split(F.lower("match"), r"[^\p{L}]+"))
    listed = words.select(F.lower(F.col("word").cast("string")).alias("word"), F.col("what").cast("string").alias("what")).distinct()
    what = F.col("what")
    says = F.when(F.col("kind") == "name", F.when(what.isin("given", "family", "title"), 1).when(what.isin("place", "body", "street"), -1)).otherwise(
        F.when(what.isin("street", "place"), 1).when(what.isin("body", "given"), -1))
    return different.select("kind", "match", F.explode(tokens).alias("word")).join(listed, "word").groupBy("kind", "match").agg(
        F.signum(F.coalesce(F.max(says), F.lit(0)) + F.coalesce(F.min(says), F.lit(0))).cast("int").alias("gazetteer"))


def votes(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the labelers' votes (1 personal, -1 not, 0 none) and ``base``, whether a strict rule settles it.
    Names and addresses on which no labeler has a say are left out: any two capitalised words are proposed."""
    m, kind, digits = F.col("match"), F.col("kind"), F.col("digits")
    n = F.char_length("digits")
    found = found.withColumn("digits", _digits(m))
    strict = F.when(kind == "email", True).when(kind == "ip", m.rlike(OCTETS)).when(
        kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits))).when(kind == "phone", n.between(8, 15))
    found = found.withColumn("base", F.coalesce(strict, F.lit(False)) & kind.isin(*BASE))
    touching = F.col("before").rlike(r"[\p{L}\p{N}_]$") | F.col("after").rlike(r"^[\p{L}\p{N}_]")
    letters = F.regexp_replace(m, "[^A-Za-z]", "")
    found = found.join(_heard(found, words), ["kind", "match"], "left")
    wordy = kind.isin(*WORDY)
    before = F.col("before")
    voted = found.withColumns({
        "gazetteer": F.coalesce("gazetteer", F.lit(0)),
        "strict": F.when(F.col("base"), 1).when(kind.isin(*BASE), -1).otherwise(0),
        "known": F.when(wordy, m.rlike(STREET_FORM).cast("int")).when(m.rlike(KNOWN_HARMLESS), -1).when(m.rlike(KNOWN_FORMS), 1).otherwise(0),
        "context": F.when(kind == "name", before.rlike(NAME_WORDS).cast("int")).when(kind == "address", before.rlike(ADDRESS_WORDS).cast("int"))
        .when(before.rlike(PERSONAL_WORDS), 1).when(before.rlike(OTHER_WORDS), -1).otherwise(0),
        "touching": F.when(touching, -1).otherwise(0),
        "mixed": F.when(kind != "secret", 0).when((n >= 4) & (F.char_length(letters) >= 4), 1).otherwise(-1),
    })
    return voted.where(~wordy | (F.col("known") != 0) | (F.col("context") != 0) | (F.col("gazetteer") != 0))


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 60, belief: float = 0.0) -> tuple[float, list[dict], dict[tuple[int, ...], float]]:
    """Expectation-maximisation with two classes and labelers independent
    given the class: share of class 1, P(vote | class) of each labeler, and
    the posterior of class 1 of each vote pattern.  ``belief`` in the start values
    (labelers are better than chance) counts like that share of all votes, and with it
    a silent labeler tells nothing of the class; labelers that seldom speak
    together need both, as who is silent would else part the classes."""
    width = len(next(iter(patterns))) if patterns else 0
    share = 0.5
    start = {1: {1: 0.6, 0: 0.3, -1: 0.1}, 0: {1: 0.1, 0: 0.3, -1: 0.6}}
    said = [start] * width
    each = belief * sum(patterns.values())
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for p in patterns:
            one = math.log(share) + sum(math.log(said[k][1][v]) for k, v in enumerate(p) if v or not belief)
            two = math.log(1 - share) + sum(math.log(said[k][0][v]) for k, v in enumerate(p) if v or not belief)
            post[p] = 1 / (1 + math.exp(min(max(two - one, -700), 700)))
        total = sum(patterns.values())
        share = min(max(sum(n * post[p] for p, n in patterns.items()) / total, 0.01), 0.99) if total else share
        for k in range(width):
            said[k] = dict(said[k])
            for y in (0, 1):
                w = {v: 1.0 + each * start[y][v] for v in (1, 0, -1)}        # one pseudo vote each
                for p, n in patterns.items():
                    w[p[k]] += n * (post[p] if y else 1 - post[p])
                if belief:
                    w[0] = 0.0
                said[k][y] = {v: x / sum(w.values()) for v, x in w.items()}
    return share, said, post


def _form(wordy: bool) -> dict[str, Column]:
    """The form of a span, in few values each."""
    if wordy:
        n = F.size(F.split("match", " "))
        return {"kind": F.col("kind"), "words": F.least(n, F.lit(6)).cast("string"), "digits": F.col("match").rlike("[0-9]").cast("string"),
                **{k: F.col(k).cast("string") for k in WORDY_LABELERS}}
    m = F.col("match")
    size = F.char_length("match")
    return {"kind": F.concat("kind", F.when(F.col("kind").isin(*BASE), F.col("base").cast("string")).otherwise("")),
            "length": F.least(F.floor(size / 6), F.lit(8)).cast("string"),
            "digits": F.floor(4 * F.char_length("digits") / size).cast("string"),
            "case": F.concat(m.rlike("[a-z]").cast("string"), m.rlike("[A-Z]").cast("string")),
            "signs": m.rlike(r"[^A-Za-z0-9]").cast("string"),
            "word": F.col("context").cast("string"), "edge": F.col("touching").cast("string"), "list": F.col("known").cast("string")}


def _log_odds(voted: DataFrame, labelers: tuple[str, ...], form: dict[str, Column], belief: float = 0.0) -> Column:
    """The log-odds of the naive Bayes that the posteriors of the vote patterns train."""
    patterns = {tuple(r[:-1]): r[-1] for r in voted.groupBy(*labelers).count().collect()}
    _, _, post = reliabilities(patterns, belief=belief)
    told = voted.sparkSession.createDataFrame([(*p, x) for p, x in post.items()], ", ".join(f"{x} int" for x in labelers) + ", posterior double")
    soft = voted.join(F.broadcast(told), list(labelers))        # at most 3 ** 5 rows
    each = F.array(*(F.struct(F.lit(k).alias("f"), x.alias("v")) for k, x in form.items()))
    sums = soft.select(F.inline(each), "posterior").groupBy("f", "v").agg(
        F.sum("posterior").alias("one"), F.sum(1 - F.col("posterior")).alias("two")).collect()
    ones = sum(r["one"] for r in sums) / len(form)
    twos = sum(r["two"] for r in sums) / len(form)
    score = F.lit(math.log((ones + 1) / (twos + 1)))
    for k, x in form.items():
        own = [r for r in sums if r["f"] == k]
        odds = {r["v"]: math.log((r["one"] + 0.5) / (ones + 0.5 * len(own))) - math.log((r["two"] + 0.5) / (twos + 0.5 * len(own))) for r in own}
        if odds:
            table = F.create_map(*(F.lit(e) for pair in odds.items() for e in pair))
            score = score + F.coalesce(F.element_at(table, x), F.lit(0.0))
    return score


def spans(docs: DataFrame, text_col: str = "text", words: DataFrame | None = None) -> DataFrame:
    """``(t1, t2, kind, start, stop, match, base, score)``: the strict spans and
    those the classifier adds, of every different text (t1 and t2 are its
    hashes); ``score`` is the classifier's log-odds.  ``words`` is a gazetteer
    ``(word, what)`` in place of the fixed one, ``what`` of its kinds."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    texts = docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"), text.alias("text"))
    proposed = c.stored(candidates(texts), "candidates")
    voted = c.stored(votes(proposed, gazetteer(spark) if words is None else words), "votes")
    wordy = F.col("kind").isin(*WORDY)
    score = F.when(wordy, _log_odds(voted.where(wordy), WORDY_LABELERS, _form(True), BELIEF)).otherwise(
        _log_odds(voted.where(~wordy), LABELERS, _form(False)))
    scored = voted.withColumn("score", score)
    # added spans overlap no strict one, nor an added one that begins before
    order = Window.partitionBy("t1", "t2").orderBy("start", F.desc("stop"), "kind")
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    base_stop, base_start = F.when(F.col("base"), F.col("stop")), F.when(F.col("base"), F.col("start"))
    sure = scored.where("base or score > 0").withColumns({
        "s": F.coalesce(F.max(base_stop).over(before), F.lit(0)), "e": F.min(base_start).over(behind)})
    sure = sure.where(F.col("base") | ((F.col("s") <= F.col("start")) & (F.col("e").isNull() | (F.col("e") >= F.col("stop")))))
    sure = sure.withColumn("s", F.coalesce(F.max(F.when(~F.col("base"), F.col("stop"))).over(before), F.lit(0))).where(
        F.col("base") | (F.col("s") <= F.col("start")))
    return sure.select("t1", "t2", "kind", "start", "stop", "match", "base", "score")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: DataFrame | None = None) -> DataFrame:
    """One row per input row: id, counts of the strict spans by kind, the hash
    of their list and the list of all spans (kind:start:end in code points, by
    kind as listed, then start, comma-joined).

    A null text is empty.  Repeated rows have the same spans; a null id is an
    id like any other; other columns are not read.  ``words`` is as in ``spans``.
    """
    text = F.col(text_col).cast("string")
    found = spans(docs, text_col, words)
    rank = F.array_position(F.array(*(F.lit(k) for k in (*BASE, *ADDED))), F.col("kind"))
    name = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    listed = F.struct(rank.alias("rank"), "start", "stop", name.alias("name"))
    per_text = found.groupBy("t1", "t2").agg(       # of one text
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE),
        F.sort_array(F.collect_list(F.when(F.col("base"), listed))).alias("strict"),
        F.sort_array(F.collect_list(listed)).alias("whole"))
    joined = {x: F.array_join(F.transform(x, lambda s: s["name"]), ",") for x in ("strict", "whole")}
    per_text = per_text.select("t1", "t2", *(f"n_{k}" for k in BASE), joined["strict"].alias("strict"), joined["whole"].alias("spans"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"))
    out = rows.join(per_text, ["t1", "t2"], "left")
    return out.select(F.col("id").alias(id_col), *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
                      F.sha2(F.coalesce("strict", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
