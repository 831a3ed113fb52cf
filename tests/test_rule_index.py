"""Many rules in one pass, rules from a profile, the rate limit."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SF001, rows
from vetline.operators import evaluate, rule_index as ri
from vetline.sources import profile

RULES = [r"the", r"que", r"[0-9]{2,}", r"@", r"(?i)Remote", r"\bJava\b", r"Java(?:Script)?", r"a+b?cd", r"(?i)\bc\+\+", r"x|yy", r"^Go", r"end$", r"re.?location",
         r"a{2}b", r"prefix", r"prefixes", r"pre", r"né", r"(?i)né", r"\Qa.b\E", r"foo\.bar", r"z*", r"[ab]cd", r"tail\d+", r"q\+{1,2}ty", r"very longish piece"]
TEXTS = ["the queue", "REMOTE job at 42 @ Go", "Go end", "JavaScript and Java", "aabcd aab", "c++ C++ relocation re-location", "prefixes", "prefi pre", "né NÉ",
         "foo.bar fooxbar", "", None, "tail7", "q+ty q++ty", "a very longish piece of text", "xx yy", "a.b", "日本 remote"]


def test_pieces_of_patterns():
    want = {"the": ("the", False, True), r"\bJava\b": ("Java", False, False), "(?i)Remote": ("remote", True, False), r"a+b?cd": ("cd", False, False),
            r"(?i)\bc\+\+": ("c++", True, False), "x|yy": None, r"Java(?:Script)?": None, r"re.?location": ("location", False, False),
            r"foo\.bar": ("foo.bar", False, False), "[0-9]{2,}": None, r"(?i)né": None, "né": ("né", False, True), r"\Qa.b\E": None, "z*": None, "[ab]cd": ("cd", False, False),
            r"tail\d+": ("tail", False, False), r"a{2}b": None, r"ab+": ("ab", False, False), r"abc?": ("ab", False, False), r"q\+{1,2}ty": ("ty", False, False)}
    assert {p: ri.required_piece(p) for p in want} == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab.+é", min_size=1, max_size=5), min_size=1, max_size=8), st.text(alphabet="ab.+é", max_size=20))
def test_prefix_tree_finds_the_longest_piece(pieces, text):
    pattern = re.compile(f"(?=({ri.prefix_tree(sorted(set(pieces)))}))")
    found = {m.start(): m[1] for m in pattern.finditer(text)}
    for i in range(len(text)):
        here = [p for p in pieces if text.startswith(p, i)]
        assert found.get(i) == max(here, key=len, default=None)


@pytest.mark.parametrize("few", [0, 99])
def test_index_equals_matching_each_rule(spark, few):
    rules = [evaluate.Rule(100 + k, evaluate.RULE_KINDS[k % 3], p, k) for k, p in enumerate(RULES)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id int, text string")
    got = {r["doc_id"]: [h["rule_id"] for h in r["h"]] for r in rows(df.select("doc_id", ri.matched_rules(rules, F.col("text"), few).alias("h")))}
    each = df.select("doc_id", *[F.coalesce(F.col("text").rlike(p), F.lit(False)).alias(f"r{k}") for k, p in enumerate(RULES)])
    assert got == {r["doc_id"]: [100 + k for k in range(len(RULES)) if r[f"r{k}"]] for r in rows(each)}
    assert {100, 101} <= set(got[0]) and got[TEXTS.index(None)] == []


def test_a_thousand_rules_on_whole_documents(spark):
    """Scores and flags equal those of each rule matched by itself, and the constant table is not parsed per row."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    words = [r["w"] for r in docs.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{4,9}"), F.lit(0))).alias("w")).distinct().orderBy(F.crc32(F.col("w").cast("binary"))).limit(1000).collect()]
    rnd = random.Random(4)
    rules = [evaluate.Rule(k, rnd.choice(evaluate.RULE_KINDS), rnd.choice(["", "(?i)", r"\b"]) + w, rnd.randint(-5, 5)) for k, w in enumerate(words)]
    out = evaluate.rule_scores(docs, rules, keys=("doc_id",))
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: r for r in rows(out)}
    for doc_id, text in [(r["doc_id"], r["text"]) for r in rows(docs.limit(40))]:
        hit = [r for r in rules if text is not None and re.search(r.pattern, text)]
        total = 30 + sum(r.weight for r in hit)
        score = max(0, min([100, total] + [39] * any(r.kind == "hard" for r in hit) + [29] * any(r.kind == "blocker" for r in hit)))
        assert (got[doc_id]["raw_score"], got[doc_id]["rule_score"]) == (total, score)
        assert got[doc_id]["rule_flags"] == [f"{r.kind}:{r.pattern}" for r in hit if r.kind != "signal"]
        assert got[doc_id]["n_signals"] == sum(r.kind == "signal" for r in hit)


def test_patterns_are_matched_once_per_text(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rules = [*evaluate.FX_RULES, evaluate.Rule(6, "hard", "[x-z]q", -1)]
    for df in (evaluate.rule_scores(docs, rules, keys=("doc_id",)), evaluate.evaluate_with_rules(docs, rules, mask=F.col("doc_id") % 2 == 0)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("[x-z]q") == 2        # the match and the pattern told with it


# ---- profile -----------------------------------------------------------------------
TEXT = """# Someone

## 4. Work Format

| Option | Status |
|---|---|
| Remote | Priority |
| Relocation required | No - not considering |
| US hours only | Hard blocker |

## 8. Hard Blockers - What I Do NOT Want

### Roles
- Analyst roles requiring BPMN, UML or EPC
- C++/Rust (kernel)

## 10. Evaluation

**Immediate disqualifiers (match_score < 30):**
- Requires BPMN / UML as core skill

**Strong signals (match_score 75+):**
- Mentions of SaaS, super app or platform
- AI

**Reasoning language:** Russian
- not in a checklist of scores
"""


def test_rules_of_a_profile(spark):
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, " "), (4, TEXT.replace("\n", "\r\n")), (5, "- loose item\n## 3. Other\n- x")], "profile_id int, text string")
    got = {}
    for r in rows(profile.profile_rules(df).orderBy("profile_id", "rule_id")):
        got.setdefault(r["profile_id"], []).append((r["kind"], r["pattern"], r["weight"]))
    want = [("hard", r"(?i)\bRelocation required\b", -20), ("blocker", r"(?i)\bUS hours only\b", -40),
            ("blocker", r"(?i)\bAnalyst roles requiring BPMN\b", -40), ("blocker", r"(?i)\bUML\b", -40), ("blocker", r"(?i)\bEPC\b", -40),
            ("blocker", r"(?i)\bC\+\+", -40), ("blocker", r"(?i)\bRust\b", -40), ("blocker", r"(?i)\bBPMN\b", -40), ("blocker", r"(?i)\bUML as core skill\b", -40),
            ("signal", r"(?i)\bSaaS\b", 15), ("signal", r"(?i)\bsuper app\b", 15), ("signal", r"(?i)\bplatform\b", 15), ("signal", r"(?i)\bAI\b", 15)]
    assert got == {1: want, 4: want}


def test_profiles_of_one_split_are_parsed_on_all_cores(spark):
    df = spark.createDataFrame([(i, TEXT) for i in range(40)], "profile_id int, text string").coalesce(1)
    got = profile.profile_rules(df)
    assert "RoundRobinPartitioning" in got._jdf.queryExecution().toString()
    assert got.count() == 40 * 13


def test_a_profile_scores_messages(spark, tmp_path):
    at = tmp_path / "profile.md"
    at.write_text(TEXT)
    rules = profile.load_profile_rules(spark, str(at))
    df = spark.createDataFrame([(1, "AI SaaS platform"), (2, "saas, bpmn needed"), (3, "super app, relocation required"), (4, "AIR")], "doc_id int, text string")
    assert {r["doc_id"]: r["rule_score"] for r in rows(evaluate.rule_scores(df, rules, keys=("doc_id",)))} == {1: 75, 2: 5, 3: 25, 4: 30}
    at.write_text("## 1. Nothing\n- x")
    with pytest.raises(RuntimeError):
        profile.load_profile_rules(spark, str(at))


# ---- rate --------------------------------------------------------------------------
class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        assert s > 0
        self.now += s


def test_calls_and_tokens_stay_under_their_rates():
    clock = Clock()
    rate = evaluate.Rate(calls_per_s=2, burst_s=2, clock=clock, sleep=clock.sleep)
    starts = []
    for _ in range(20):
        rate.start()
        starts.append(clock.now)
    assert starts[:4] == [0] * 4 and starts[4:7] == [0.5, 1.0, 1.5]        # a burst of 2 s, then the rate
    for i, s in enumerate(starts):
        assert sum(s <= t < s + 1 for t in starts[i:]) <= 2 + 4
    clock = Clock()
    rate = evaluate.Rate(tokens_per_s=100, clock=clock, sleep=clock.sleep)
    for _ in range(10):
        rate.start()
        rate.used(250)      # known after the call; the next one waits
    assert clock.now == pytest.approx((9 * 250 - 100) / 100)
    clock.now = 1e6
    rate.start()
    assert clock.now == 1e6
    with pytest.raises(ValueError):
        evaluate.Rate(calls_per_s=0)


def test_a_scorer_waits_for_its_rate():
    import pandas as pd
    clock = Clock()
    scorer = evaluate.retrying_scorer(lambda request: (429 if request == "r1" else 200, request, {"input_tokens": 5, "output_tokens": 5}),
                                      sleep=lambda s: None, rate=lambda: evaluate.Rate(calls_per_s=1, clock=clock, sleep=clock.sleep))
    pdf = pd.DataFrame({"chat_id": range(4), "msg_id": range(4), "request": [f"r{i}" for i in range(4)]})
    out = next(iter(scorer(iter([pdf]))))
    assert [len(s) for s in out["attempt_statuses"]] == [1, 3, 1, 1]
    assert clock.now == pytest.approx(5)        # six attempts, one at once
