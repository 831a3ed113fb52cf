"""Scalar expressions and the disposition truth table."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from vetline.functions import text as tx
from vetline.operators import cards, route


def one(spark, col, schema, value):
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first()["x"]


def test_strip_matches_python(spark):
    samples = ["  a b\t", "\u3000\u00a0x\u2028", None, "\x1c\x1dy\x85", "\u200bz"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r["x"] for r in df.select(tx.strip_ws("t").alias("x")).collect()]
    assert got == [(s or "").strip() for s in samples]


@pytest.mark.parametrize("text,keep", [("a" * 40, True), ("a" * 39, False), ("1" * 50, False),
                                       ("²" + "1" * 45, True), ("_" * 45, False), ("é" + " " * 45, True)])
def test_prefilter(spark, text, keep):
    assert one(spark, tx.worth_evaluating("t"), "t string", text) is keep


def test_titles(spark):
    df = spark.createDataFrame([(1, "", "h", None), (2, None, None, "Ann"), (3, None, "", ""), (4, "T", "u", "f")],
                               "id long, title string, username string, first string")
    got = [r["x"] for r in df.orderBy("id").select(tx.chat_title("title", "username", "first", "id").alias("x")).collect()]
    assert got == ["h", "Ann", "3", "T"]


def test_source_link_and_escape(spark):
    df = spark.createDataFrame([(-1001234, 5), (-99, 5), (7, 1), (None, 1)], "c long, m long")
    got = [r["x"] for r in df.select(tx.source_link("c", "m").alias("x")).collect()]
    assert got == ["https://t.me/c/1234/5", None, None, None]
    s = "a\\b*c_d`e[f]"
    py = s.replace("\\", "\\\\").replace("*", "\\*").replace("_", "\\_").replace("`", "\\`").replace("[", "\\[")
    assert one(spark, tx.md_escape("t"), "t string", s) == py


def test_fmt_ts_label_tags(spark):
    assert one(spark, tx.fmt_ts("t"), "t long", 0) == "—"
    assert one(spark, tx.fmt_ts("t"), "t long", None) == "—"
    assert one(spark, tx.fmt_ts("t"), "t long", 1706657176) == "2024-01-30 23:26 UTC"
    df = spark.createDataFrame([("T", "u"), ("", None), (None, "u")], "t string, u string")
    assert [r["x"] for r in df.select(tx.channel_label("t", "u").alias("x")).collect()] == ["T (@u)", "?", "? (@u)"]
    df = spark.createDataFrame([(1, 1), (0, 0), (0, None), (1, None)], "p int, v int")
    assert [r["x"] for r in df.select(tx.status_tags("p", "v").alias("x")).collect()] == \
        ["posted vacancy", "not vacancy", "—", "posted"]


TRUTH = [  # text, call, parse, is_vacancy, score -> disposition, (is_vacancy, score, posted, title)
    ("short", "ok", "ok", True, 90, "too_short", (0, None, 0, None)),
    ("x" * 45, "transient", "ok", True, 90, "transient", None),
    ("x" * 45, "crash", "ok", True, 90, "crash", (None, None, 0, None)),
    ("x" * 45, "ok", "crash", None, None, "crash", (None, None, 0, None)),
    ("x" * 45, "ok", "parse_error", False, 0, "parse_error", (0, 0, 0, None)),
    ("x" * 45, "ok", "ok", False, 55, "not_vacancy", (0, 55, 0, None)),
    ("x" * 45, "ok", "ok", True, 69, "below_threshold", (1, 69, 0, "T")),
    ("x" * 45, "ok", "ok", True, 70, "posted", (1, 70, 1, "T")),
]


def test_disposition_truth_table(spark):
    df = spark.createDataFrame([(i, t, c, p, v, s, "T") for i, (t, c, p, v, s, *_) in enumerate(TRUTH)],
                               "i int, text string, call_status string, parse_status string, is_vacancy boolean,"
                               " match_score int, title string")
    got = {r["i"]: r for r in rows(route.route(df))}
    for i, (*_, dispo, out) in enumerate(TRUTH):
        r = got[i]
        assert r["disposition"] == dispo
        assert r["recorded"] is (out is not None)
        if out is not None:
            assert (r["out_is_vacancy"], r["out_score"], r["out_posted"], r["out_title"]) == out


def test_card_text(spark):
    df = spark.createDataFrame([("posted", -1001000000002, 9, "Go_dev", "ACME*", 88, "senior", "", ["Go", "k8s"],
                                 "", [], "Fits [well]", "Chan")],
                               "disposition string, chat_id long, msg_id long, title string, company string,"
                               " match_score int, grade string, remote string, stack array<string>, salary string,"
                               " red_flags array<string>, reasoning string, chat_title string")
    card = rows(cards.match_cards(df))[0]["card"]
    assert card == ("*Go\\_dev* — ACME\\*\nScore: 88/100 · grade: senior · remote: unknown\nStack: Go, k8s\n"
                    "Salary: —\nRed flags: —\n\nFits \\[well]\n\nSource: Chan · https://t.me/c/1000000002/9")


REASONINGS = [
    ("", 0), ("Go + Kafka match, senior, remote", 1), ("Go + Kafka match. Senior, remote.", 2),
    ("One. Two! Three?", 3), ("Needs 3.5 years of Java. No remote", 2), ("Wait... what? ok", 3),
    ("Требуют Java, твой основной — Go; remote нет.", 1), ("A… B… C", 3), ("No stop at end!!", 1),
]


def test_reasoning_sentences_spark_and_duckdb(spark):
    import duckdb

    import oracle_queries
    from vetline.operators import route
    df = spark.createDataFrame([(t,) for t, _ in REASONINGS], "reasoning string")
    got = [r["n"] for r in rows(df.select(route.n_sentences(F.col("reasoning")).alias("n")))]
    assert got == [n for _, n in REASONINGS]
    con = duckdb.connect()
    for text, n in REASONINGS:
        sql = "SELECT " + oracle_queries._SENTENCES.format(x="$1")
        assert con.execute(sql, [text]).fetchone()[0] == n, text


def test_contract_checks_counts_stub_scores_and_long_reasoning(spark):
    from vetline.functions.answers import parse_answers
    from vetline.operators import route
    raw = ['{"is_vacancy": false, "match_score": 0}', '{"is_vacancy": false, "match_score": 12}',
           '{"is_vacancy": true, "match_score": 80, "reasoning": "One. Two. Three."}',
           '{"is_vacancy": true, "match_score": 80, "reasoning": "Fits. Remote."}']
    df = spark.createDataFrame([(i, i, r) for i, r in enumerate(raw)], "chat_id long, msg_id long, raw string")
    c = rows(route.contract_checks(parse_answers(df)))[0]
    assert (c["answers"], c["scored_non_vacancy"], c["long_reasoning"]) == (4, 1, 1)
