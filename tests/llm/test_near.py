"""Near-duplicates, repeated windows and lines against plain versions."""

import contextlib
import hashlib
import itertools
import random
import threading
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

from vetline.llm import common, embeddings, lines, minhash, substring


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        self.up[self.find(x)] = self.find(y)


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)]) if 0 < len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def plain_components(ids, pairs):
    s = Sets(len(ids))
    for a, b in pairs:
        s.join(a, b)
    low = {}
    for i, x in enumerate(ids):
        r = s.find(i)
        if x is not None:
            low[r] = min(low.get(r, x), x)
    return [low.get(s.find(i)) for i in range(len(ids))]


def plain_near(texts, width, percent):
    sets = [shingles(t, width) for _, t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, plain_components([d for d, _ in texts], pairs)


def test_minhash_against_all_pairs(docs, texts, none):
    for width, percent in ((3, 85), (5, 80)):
        sets, comp = plain_near(texts, width, percent)
        comp = [c if s else d for c, s, (d, _) in zip(comp, sets, texts)]
        got = minhash.near_duplicates(docs, shingle=width, percent=percent).collect()
        want = Counter((d, len(s), c, d is not None and d == c) for (d, _), s, c in zip(texts, sets, comp))
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_dense_group(spark):
    """Many copies with several edits each: all rounds of the comparison are needed."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, comp = plain_near(rows, 3, 85)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == {d: c for (d, _), c in zip(rows, comp)}


def test_minhash_one_of_each(docs, texts, none):
    out = minhash.one_of_each(docs)
    assert out.columns == docs.columns
    sets, comp = plain_near(texts, 3, 85)
    groups = Counter()
    got = [(r.doc_id, r.text) for r in out.collect()]
    key = {}
    for (d, t), s, c in zip(texts, sets, comp):
        if s:
            key[(d, t)] = (c, d) if c is None else c
    for x in got:
        if x in key:
            groups[key[x]] += 1
    assert set(groups) == set(key.values()) and set(groups.values()) == {1}
    assert Counter(x for x in got if not shingles(x[1], 3)) == Counter(x for x in texts if not shingles(x[1], 3))
    assert minhash.one_of_each(none).count() == 0


def test_tensored_bands_miss_rate():
    """Pairs at the threshold share a table as often as stated."""
    rng = np.random.default_rng(3)
    sign = minhash.Signer(minhash.SUB_KEYS, minhash.SUB_SIZE)
    met = 0
    for _ in range(300):
        x = rng.integers(0, 2**63, 185, dtype=np.uint64)
        a, b = np.unique(x[:170]), np.unique(np.concatenate([x[:155], x[170:]]))     # 155 of 185 shared
        (a1, b1, s1), (a2, b2, s2) = sign(a), sign(b)
        met += bool((a1 == a2).any() and (b1 == b2).any())
        assert np.bitwise_count((s1 ^ s2).view(np.uint64)).sum() <= minhash.SKETCH_DIFFER
    assert met == 300


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges], "a long, b long").repartition(7)
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(80)} | {200: 200, 201: 200, 202: 200}
    assert common.components(df.where("false")).count() == 0


def test_components_stop_once_they_are_stars(spark, monkeypatch):
    """Found components are not gone over again: each round's tasks stay in the driver's memory."""
    stored, names = common.stored, []
    monkeypatch.setattr(common, "stored", lambda df, name: names.append(name) or stored(df, name))
    stars = spark.createDataFrame([(100 * i, 100 * i + j) for i in range(20) for j in range(1, 9)], "a long, b long").repartition(5)
    assert {(r.node, r.component) for r in common.components(stars).collect()} == {(100 * i + j, 100 * i) for i in range(20) for j in range(9)}
    assert len(names) == 1
    joined = stars.unionByName(spark.createDataFrame([(108, 205), (301, 100)], "a long, b long"))
    got = {r.node: r.component for r in common.components(joined).collect()}
    assert got == {100 * i + j: 100 if i in (1, 2, 3) else 100 * i for i in range(20) for j in range(9)}


def test_substring_against_counted_windows(docs, texts, none):
    for window, seed in ((35, 10), (6, 2)):
        words = [(t or "").encode().split() for _, t in texts]
        count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
        want = Counter()
        for (d, _), w in zip(texts, words):
            keep = [True] * len(w)
            for i in range(len(w) - window + 1):
                if count[tuple(w[i:i + window])] > 1:
                    keep[i:i + window] = [False] * window
            kept = b" ".join(x for x, k in zip(w, keep) if k)
            want[(d, len(w), keep.count(False), hashlib.sha256(kept).hexdigest(), kept.decode())] += 1
        got = substring.remove_repeats(docs, window=window, seed=seed).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == want
    assert substring.remove_repeats(none).count() == 0


def test_least_grams_are_the_last_of_the_least():
    rng = np.random.default_rng(1)
    for size in (1, 5, 40, 3000):
        g = rng.integers(0, 9, size, dtype=np.uint64) << np.uint64(40)
        for wide in (1, 3, 7):
            want = [i + wide - 1 - int(np.argmin(g[i:i + wide][::-1])) for i in range(len(g) - wide + 1)]
            assert substring.Runs._least(g, wide).tolist() == want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def varied(rng, line, n):
    s = list(line)
    for _ in range(n):
        p, how = rng.randrange(len(s)), rng.random()
        if how < 0.3:
            del s[p]
        elif how < 0.6:
            s.insert(p, rng.choice("abcé "))
        else:
            s[p] = rng.choice("abcé ")
    return "".join(s)


def test_banded_distance_against_plain(spark):
    from pyspark.sql import functions as F
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(4, 14)))
        b = varied(rng, a, rng.randint(0, 4)) or "a"
        if abs(len(a) - len(b)) <= 2:
            rows.append((a, b, edit_distance(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int").withColumns({"x": F.split("a", ""), "y": F.split("b", "")}).repartition(3)
    got = df.select("d", lines.banded_distance(F.col("x"), F.col("y"), 2).alias("g")).collect()
    assert len(got) > 200 and all((r.g == r.d) if r.d <= 2 else r.g > 2 for r in got)


def test_line_dedup_against_all_pairs(spark, docs, texts, none):
    rng = random.Random(6)
    made = ["A line that stands in many documents, as it is or nearly so", "Another one of the lines that come again and again é"]
    rows = [(800000 + i, "\n".join([varied(rng, rng.choice(made), rng.randint(0, 3)), "", f"its own line {i}", "short"])) for i in range(60)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    every = [*texts, *rows]
    df = docs.select("doc_id", "text").unionByName(extra)
    occ = {}            # (place, line)
    for d, t in every:
        for k, x in enumerate(t.split("\n") if t is not None else []):
            x = x.strip(" \t\n\x0b\f\r")
            if len(x) >= 8:
                occ[(d if d is not None else 2**63 - 1, t, k)] = x
    # documents of one id are told apart by their texts' hashes, so that order is not stated here
    ids = Counter(d for d, _ in set(every))
    first = {}
    for place in sorted(occ, key=lambda p: (p[0], p[2])):
        first.setdefault(occ[place], place)
    later = set()
    for a, b in itertools.combinations(sorted(first, key=lambda x: (first[x][0], first[x][2])), 2):
        if min(len(a), len(b)) >= 30 and abs(len(a) - len(b)) <= 2 and b not in later:
            # cheap: shared characters first
            if sum((Counter(a) & Counter(b)).values()) >= max(len(a), len(b)) - 2 and edit_distance(a, b) <= 2:
                later.add(b)
    want = defaultdict(list)
    for (d, t, k), x in occ.items():
        if first[x] != (d, t, k) or x in later:
            want[(d, t)].append(k)
    got = lines.report(df).collect()
    assert len(got) == len(every)
    told = {}
    for r in got:
        told.setdefault(r.doc_id, set()).add((r.n_lines, r.removed, r.n_removed))
    for d, t in set(every):
        if ids[d] == 1 and d is not None:
            no = sorted(want.get((d, t), []))
            assert told[d] == {(len(t.split("\n")) if t is not None else 0, ",".join(map(str, no)), len(no))}
    assert lines.report(none).count() == 0
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    byid = {r.doc_id: r.text for r in kept.collect()}
    assert byid[900001] is None and byid[900002] == "" and 900011 in byid and "number 1" not in byid[900011]
    assert lines.without_repeats(none).count() == 0


def test_segments_find_every_like_line():
    """Every pair within the edits shares a key: by the probes' own arithmetic."""
    rng = random.Random(8)

    def keys(line, edits, own):
        out, parts, n = set(), edits + 1, len(line)
        for i, right, shift, lower in lines._probes(edits):
            if (own and (lower or shift)) or (lower and n % lines.CLASS >= edits):
                continue
            size = (n // lines.CLASS - lower) * lines.CLASS // parts
            lo = (n - (parts - i) * size if right else i * size) + shift
            if size and lo >= 0 and lo + size <= n:
                out.add((size, i, line[lo:lo + size]))
        return out
    for edits in (1, 2, 3):
        for _ in range(3000):
            a = "".join(rng.choice("ab") for _ in range(rng.randint(12, 36)))
            b = varied(rng, a, edits)
            if edit_distance(a, b) <= edits and min(len(a), len(b)) >= lines.CLASS + edits + 1:
                long, short = (a, b) if len(a) >= len(b) else (b, a)
                assert keys(long, edits, False) & keys(short, edits, True)


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((260, 12))
    x[100:180] = x[0] + 0.12 * rng.standard_normal((80, 12))
    x[180:200] = x[5] * rng.uniform(0.5, 3, (20, 1))
    x[200:210] = x[7]
    x[210:230] = x[8] + 0.2 * rng.standard_normal((20, 12))
    rows = [(1000 - i if i % 50 else None, [float(v) for v in r], i, "z") for i, r in enumerate(x)]
    odd = [(5000, None, 0, ""), (5001, [], 0, ""), (5002, [0.0] * 12, 0, ""), (5003, [float("nan")] + [1.0] * 11, 0, ""),
           (5004, [float("inf")] + [1.0] * 11, 0, ""), (5005, [None] + [1.0] * 11, 0, ""), (5006, [1.0, 2.0], 0, ""), (5007, [2.0, 4.0], 0, ""),
           (5008, [1e300] * 12, 0, ""), (5009, [1e-300] * 12, 0, "")]
    rows += odd + rows[100:103]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int, node string").repartition(5)
    good = []
    for i, r in enumerate(rows):
        v = r[1]
        if v and all(e is not None and np.isfinite(e) for e in v) and any(v):
            good.append((i, np.array(v) / np.abs(v).max()))
    links = Counter()
    pairs = []
    for (i, u), (j, w) in itertools.combinations(good, 2):
        if len(u) == len(w) and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= 0.95:
            links[i] += 1
            links[j] += 1
            pairs.append((i, j))
    comp = plain_components([r[0] for r in rows], pairs)
    want = Counter((r[0], links[i], c, r[0] is not None and r[0] == c) for i, (r, c) in enumerate(zip(rows, comp)))
    for tile in (2048, 20):
        got = embeddings.near_duplicates(df, tile=tile).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert embeddings.near_duplicates(df.where("false")).count() == 0


class Shuffled:
    """The bytes of the shuffle files seen meanwhile, as Spark may drop them early."""

    def __init__(self, spark):
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        self.dirs, self.sizes, self.over = [d.getPath() for d in dirs], {}, threading.Event()
        self.before = set(self.look())
        self.thread = threading.Thread(target=self.watch)

    def look(self) -> dict[str, int]:
        return {f.name: f.stat().st_size for d in self.dirs for f in Path(d).glob("*/shuffle_*.data")}

    def watch(self):
        while not self.over.wait(0.05):
            with contextlib.suppress(OSError):      # a file may go meanwhile
                self.sizes.update(self.look())

    def __enter__(self):
        self.thread.start()
        return self

    def __exit__(self, *error):
        self.over.set()
        self.thread.join()

    def bytes(self) -> int:
        return sum(n for f, n in self.sizes.items() if f not in self.before)


def test_embeddings_on_disk_grow_with_the_rows(spark):
    """Spread-out vectors are near in no few coordinates, so every block meets every other: none is shuffled for that."""
    rng = np.random.default_rng(21)
    x = rng.standard_normal((2000, 96))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 600, 2):      # pairs about the threshold, and some at it
        aside = x[i + 1] - (x[i + 1] @ x[i]) * x[i]
        cos = 0.95 + rng.choice([0, 1e-12, -1e-12, 1e-6, -1e-6, 1e-4, -1e-4, 3e-3, -3e-3, 0.04])
        x[i + 1] = cos * x[i] + (1 - cos ** 2) ** 0.5 * aside / np.linalg.norm(aside)
    x[600:660] = x[0] * rng.uniform(1e-9, 1e9, (60, 1))     # one direction
    x[700:900] = x[1] + 0.02 * rng.standard_normal((200, 96))
    x[1000:1500] = x[1000:1500].astype(np.float32)
    vectors = [*x, *rng.standard_normal((100, 3))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    linked = np.zeros((len(vectors), len(vectors)), bool)
    for part in (slice(0, 2000), slice(2000, 2100)):
        unit = embeddings._unit(np.stack(vectors[part]))
        linked[part, part] = np.einsum("ik,jk->ij", unit, unit, optimize=False) >= 0.95
    np.fill_diagonal(linked, False)
    unsure = np.flatnonzero(np.abs(np.einsum("ij,ij->i", x[:600:2], x[1:600:2]) - 0.95) < 1e-14)    # told by the last bit
    for i in 2 * unsure:
        u = embeddings._unit(x[i:i + 2])
        linked[i, i + 1] = linked[i + 1, i] = np.einsum("ij,ij->i", u[:1], u[1:])[0] >= 0.95
    comp = plain_components(list(range(len(vectors))), [tuple(p) for p in np.argwhere(np.triu(linked)).tolist()])
    with Shuffled(spark) as shuffled:
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, tile=60).collect()}
    assert got == {i: (int(n), k) for i, (n, k) in enumerate(zip(linked.sum(1), comp))}
    assert shuffled.bytes() < 9 * 2000 * 96 * 8, shuffled.bytes()       # all other blocks' vectors before
