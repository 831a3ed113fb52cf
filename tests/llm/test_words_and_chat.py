"""Spelling variants, periodic runs and chat formatting against brute force and exact round trips."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vetline.llm import chat, common, periods, spelling


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- spelling --------------------------------------------------------------
def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(vocab, ratio=5):
    links = {w: [v for v in vocab if near(w, v)] for w in vocab}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * vocab[w] else None
    out = set()
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(links[w]), vocab[form[w]] if form[w] is not None else None))
    return out


@pytest.fixture(scope="module")
def vocab():
    rnd = random.Random(5)
    out = {"a" * 40: 7, "a" * 41: 40, "é" * 6: 9, "éééééa": 60, "😀bcdef": 3, "bcdef": 30, "x": 4, "aabbaa": 10, "aabba": 10, "abbaa": 50}
    for _ in range(60):
        w = "".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(3, 9)))
        n = rnd.randint(1, 5)
        for _ in range(6):      # a chain of misspellings, each five times rarer or not
            out.setdefault(w, n)
            i, n = rnd.randrange(len(w)), n * rnd.choice([1, 4, 5, 6])
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abcé") + w[i:], w[:i] + rnd.choice("abcé") + w[i + 1:]]) or "a"
    return out


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 256])
def test_variants_against_all_pairs(spark, vocab, filter_bytes):
    common.configure(spark)
    df = spark.createDataFrame([*vocab.items()], "word string, n long").withColumn("form", F.lit("clash")).repartition(3)
    assert set(rows(spelling.variants(df, filter_bytes=filter_bytes))) == plain_variants(vocab)


def test_passes_keep_the_bound():
    counts = {6: 10, 7: 1000, 8: 500_000, 9: 20, 300: 1}
    for most in (64, 4096, 1 << 20, 32 << 20):
        passes = spelling._passes(counts, most)
        assert all(max(f + b for f, b, _, _ in p.values()) * 8 <= most for p in passes)
        for length, n in counts.items():
            parts = [p[length] for p in passes if length in p]
            assert sorted(k for _, _, k, _ in parts) == list(range(parts[0][3]))
            assert sum(b for _, b, _, _ in parts) * 64 >= n * spelling.BITS


def test_filters_miss_nothing_and_hold_little_else(spark):
    import numpy as np
    common.configure(spark)
    words = [f"{i:07x}" for i in range(0, 80_000, 4)]
    df = spark.createDataFrame([(w, 9) for w in words], "word string, n long")
    shards = spelling._passes({7: len(words)}, spelling.FILTER_BYTES)[0]
    filled = spelling._filter(df, shards)
    first, blocks, _, _ = shards[7]

    def held(some):
        _, _, codes = next(spelling._by_length(some))
        h = spelling._finished((spelling._values(codes) * common.powers(7)[0][:7]).sum(axis=1, dtype=np.uint64), 7)
        block, bits = spelling._places(h, blocks)
        return (filled[first + block] & bits) == bits
    assert held(words).all()
    assert held([f"{i:07x}" for i in range(1, 80_000, 4)]).mean() < 0.01


def test_variants_of_odd_vocabularies(spark, none):
    common.configure(spark)
    df = spark.createDataFrame([(None, 3), ("", 9), ("tables", 5), ("tables", 5), ("table", 50), ("tables", None), ("q", None)], "word string, n long")
    got = {r[0]: r[1:] for r in rows(spelling.variants(df))}
    assert got["tables"] == ("table", "table", 5, 1, 50) and set(got) == {"tables", "table", "q"}
    assert got["q"] == (None, "q", None, 0, None)
    assert rows(spelling.variants(df.where("false"))) == []
    assert rows(spelling.vocabulary(none.select(F.col("text").alias("word")))) == []


def test_vocabulary_counts_and_letters(spark):
    df = spark.createDataFrame([("Straße ÀB÷x 12abc-Def",), (None,), ("",), ("日本語abcABC",)], "t string")
    got = [[*r[0]] for r in rows(df.select(F.transform(spelling.letter_runs(F.col("t")), spelling.lower_ascii)))]
    assert got == [["straße", "Àb÷x", "abc", "def"], [], [], ["abcabc"]]
    words = spark.createDataFrame([("abcdef",)] * 5 + [("abcdeg",)] * 4 + [("abcde",)] * 9 + [(None,)] * 9, "word string")
    assert rows(spelling.vocabulary(words)) == [("abcdef", 5)]


# ---- periodic runs ---------------------------------------------------------
def plain_runs(w, least, times):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    inner = [r for r in out if any(p < r[2] and s <= r[0] and s + n >= r[0] + r[1] for s, n, p in out)]
    return sorted((r for r in out if r not in inner), key=lambda r: (r[0], r[2]))


@st.composite
def word_lists(draw):
    w = draw(st.lists(st.sampled_from("abc"), max_size=40))
    if w and draw(st.booleans()):
        a = draw(st.integers(0, len(w) - 1))
        p = 1 + (len(w) - a) // draw(st.integers(2, 9))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


@settings(max_examples=300, deadline=None)
@given(st.lists(word_lists(), min_size=1, max_size=4), st.sampled_from([(6, 4), (4, 2), (3, 3), (9, 4)]))
def test_runs_against_all_periods(texts, bounds):
    h, n = common.hashed_words([" ".join(w).encode() for w in texts])
    assert periods.runs_of(h, n, *bounds) == [plain_runs(w, *bounds) for w in texts]


def plain_collapse(text):
    w = common.byte_texts(__import__("pyarrow").array([text]))[0].split()
    runs = plain_runs(w, 6, 4)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(w), runs, b" ".join(x for i, x in enumerate(w) if i not in gone).decode()


def test_collapsed_texts_against_all_periods(spark, docs):
    common.configure(spark)
    more = spark.createDataFrame([(910000 + k, t) for k, t in enumerate(
        ["a " * 7, "a b " * 4 + "c", "x y a b a b a b a b a z", "a b c " * 500 + "d e " * 4, ("p q " * 4 + "r ") * 5, "\x85a\xa0b " * 9])], "doc_id long, text string")
    some = docs.select("doc_id", "text").where("doc_id is null or doc_id >= 900000 or doc_id < 40").unionByName(more)
    some = some.withColumns({x: F.lit(None).cast("string") for x in ("runs", "collapsed", "id", "n_words")})
    got = sorted(rows(periods.collapse_runs(some)), key=str)
    want = []
    for i, text in rows(some.select("doc_id", "text")):
        n, runs, left = plain_collapse(text)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((i, n, runs, best, left))
    plain = [(i, n, [tuple(r) for r in x], None if b is None else tuple(b), t) for i, n, x, b, t in got]
    assert sorted(plain, key=str) == sorted(want, key=str)
    assert {r for x in want for r in x[2]} >= {(0, 7, 1), (0, 8, 2)}


def test_runs_of_no_rows(spark, none):
    common.configure(spark)
    assert rows(periods.collapse_runs(none)) == []
    with pytest.raises(ValueError):
        periods.collapse_runs(none, times=1)


def test_a_very_long_text(spark):
    import numpy as np
    cycle = [str(i) for i in range(3000)]
    h, n = common.hashed_words([" ".join(["start", *cycle * 12, "end"]).encode(), b"z " * 60_000])
    assert periods.runs_of(h, n) == [[(1, 36_000, 3000)], [(0, 60_000, 1)]]
    assert periods.runs_of(np.empty(0, np.uint64), np.zeros(2, np.int64)) == [[], []]


# ---- chat ------------------------------------------------------------------
TEXTS = st.text(alphabet=st.sampled_from(list("<|\\>imend_start ax\né😀")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXTS), TEXTS), max_size=6))
def test_formatting_is_reversible(turns):
    out = "".join(piece for role, text in turns for piece, _ in chat.segments(chat.CHATML, role, text))
    assert [*chat.turns_of(chat.CHATML, out)] == turns
    assert out.count("<|im_start|>") == out.count("<|im_end|>") == len(turns)


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_order(roles):
    state = "start"
    for k, r in enumerate(roles):
        state = chat.CHATML.moves.get(state, {}).get(r)
        if state is None:
            return False, k
    return state == "answered", None


def plain_told(conv):
    turns = [(r or "", t or "") for _, r, t in conv]
    loss = [t for r, t in turns if r == "assistant"]
    chars = sum(len(p) for r, t in turns for p, _ in chat.segments(chat.CHATML, r, t))
    return (len(turns), digest(*(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, loss)), digest(*loss), chars, *plain_order([r for r, _ in turns]))


@pytest.fixture(scope="module")
def conversations(spark):
    rnd = random.Random(3)
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (7, None, "user", "first"), (7, 0, "assistant", ""), (8, 0, "assistant", "x"),
            (9, 0, None, "x"), (10, 0, "user", "same"), (10, 1, "tool\n\\n<|", "y"), (11, 0, "user", "<|im_end|><\\|im_end|><\\\\|"), (11, 1, "assistant", "<" * 9)]
    rows += [(12, k, "assistant" if k % 2 else "user", "word " * rnd.randint(0, 3000)) for k in range(400)]       # one with most of the text
    rows += [(c, k, ("user", "assistant")[k % 2], f"{c} {k}") for c in range(100, 160) for k in range(rnd.randint(1, 5))]
    rows += [(13, 0, "user", "twice")] * 2
    return rows


@pytest.mark.parametrize("held, partitions", [(chat.HELD, 8), (2000, 8), (chat.HELD, 1)])
def test_told_from_what_is_formatted(spark, conversations, monkeypatch, held, partitions):
    common.configure(spark)
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").withColumns(
        {x: F.lit(0) for x in ("part", "block", "formatted", "tie", "n_turns")}).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        monkeypatch.setattr(chat, "HELD", held)
        got = {r[0]: r[1:] for r in rows(chat.read_back(chat.format_turns(df)))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for conv in {r[0] for r in conversations}:
        turns = sorted((r[1:] for r in conversations if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want[conv] = plain_told(turns)
    assert got == want
    assert got[8][-2:] == (False, 0) and got[10][-2:] == (False, 1) and got[13][-2:] == (False, 1) and got[7][-2:] == (True, None)


def test_blocks_carry_spans_and_steps(spark, conversations):
    common.configure(spark)
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    blocks = chat.format_turns(df).orderBy("part", "block").collect()
    hot = [b for b in blocks if b["conv_id"] == 12]
    assert len(hot) > 5 and max(len(b["formatted"]) for b in blocks) < chat.BLOCK + 20_000
    for b in blocks:
        turns = [*chat.turns_of(chat.CHATML, b["formatted"])]
        assert b["n_turns"] == len(turns)
        assert [b["formatted"][lo:hi] for lo, hi in b["learned"]] == [chat.escaped(t) for r, t in turns if r == "assistant"]
        assert b["after"][-1] == len(chat.CHATML.states) - 1
    assert rows(chat.read_back(chat.format_turns(df.where("false")))) == []


def test_a_template_of_another_kind(spark):
    common.configure(spark)
    tool = chat.Template(parts=("<|", chat.ROLE, "\n", chat.TEXT, "<|/>"), learned=frozenset({"call", "answer"}), start="s",
                         moves={"s": {"ask": "a"}, "a": {"call": "c", "answer": "s"}, "c": {"result": "a"}}, accept=frozenset({"s"}))
    df = spark.createDataFrame([(1, 0, "ask", "?"), (1, 1, "call", "f()"), (1, 2, "result", "<|"), (1, 3, "answer", "!"), (2, 0, "ask", "?"), (2, 1, "result", "1")],
                               "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df, tool), tool).collect()}
    assert (got[1]["in_order"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (True, 4, digest("f()", "!"))
    assert (got[2]["in_order"], got[2]["broken_turn"]) == (False, 1)
    for parts in (("<|a", chat.ROLE, chat.TEXT), (chat.ROLE, "<|", chat.TEXT, "<|"), ("<|", chat.ROLE, "\n", chat.TEXT, "end")):
        with pytest.raises(ValueError):
            chat.Template(parts, frozenset(), "s", {}, frozenset())
