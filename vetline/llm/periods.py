"""Periodic runs by descending-LCP Kruskal.

Of each text the suffixes (by words) are sorted and the longest common prefix
(LCP) of neighbours is found.  Neighbours are united by decreasing LCP with
union-find; every class holds its positions in order.  When two classes unite
at an LCP of ``l``, positions i < j that become adjacent at a distance d = j - i
within ``l`` seed a run: the words from i for l + d words have period d.

A run is found once, from its first position: i and i + d share exactly l
words, and nothing that shares as many stands between them, else the run had
a smaller period, which unites at a larger LCP.  A seed whose stretch goes on
to the left is inside of that run and goes.

LCPs too small for any run of the least length are not united, and texts none
of whose grams of that many words repeats are not sorted at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

LEAST = 6               # words of a run at least
TIMES = 4               # periods of a run at least
BYTES = 1 << 20         # of text handled at once, or one text


def _heads(changed: np.ndarray) -> np.ndarray:
    """For each element the index of the first of its group."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _tied(changed: np.ndarray) -> np.ndarray:
    """Whether an element's group has another one."""
    return ~(changed & np.append(changed[1:], True))


def suffix_ranks(h: np.ndarray, of: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of every suffix of each text among all; those of one text together.
    Prefix doubling over the suffixes that are still tied."""
    order = np.lexsort((h, of))
    changed = np.append(True, (h[order[1:]] != h[order[:-1]]) | (of[order[1:]] != of[order[:-1]]))
    rank = np.empty(len(h), np.int64)
    rank[order] = _heads(changed)
    at, k = order[_tied(changed)], 1
    while len(at):
        after = at + k
        key = np.where(after < ends[of[at]], rank[np.minimum(after, len(h) - 1)], -1)
        first = rank[at]
        order = np.lexsort((key, first))
        at, key, first = at[order], key[order], first[order]
        outer = np.append(True, first[1:] != first[:-1])
        changed = outer | np.append(True, key[1:] != key[:-1])
        rank[at] = first + _heads(changed) - _heads(outer)
        at, k = at[_tied(changed)], 2 * k
    return rank


def _shared(spans: c.Spans, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` share, ``most`` at most."""
    lo, hi = np.zeros(len(a), np.int64), most.copy()
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = spans(a, a + mid) == spans(b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def _seeds(place: list[int], entries: list[tuple[int, int]], times: int) -> list[tuple[int, int, int]]:
    """``(i, d, l)``: the positions that become adjacent when neighbours t and
    t + 1 of ``place`` unite, for ``(t, l)`` by falling l, where d * (times - 1) <= l."""
    parent = list(range(len(place)))
    sets = [[p] for p in place]
    found = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def met(i: int, j: int, shared: int) -> None:
        if (j - i) * (times - 1) <= shared:
            found.append((i, j - i, shared))

    for t, shared in entries:
        x, y = find(t), find(t + 1)
        if len(sets[x]) < len(sets[y]):
            x, y = y, x
        large, small = sets[x], sets[y]
        parent[y], sets[y] = x, None
        for k, p in enumerate(small):
            i = bisect_left(large, p)
            # adjacent in the united class: none of the smaller one stands between
            if i and (not k or small[k - 1] < large[i - 1]):
                met(large[i - 1], p, shared)
            if i < len(large) and (k + 1 == len(small) or small[k + 1] > large[i]):
                met(p, large[i], shared)
        if len(small) == 1:
            insort(large, small[0])
        else:
            large += small
            large.sort()
    return found


def runs_of(h: np.ndarray, n: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each text, by start, then
    period; ``h`` are the word hashes of all texts, ``n`` how many each has."""
    out = [[] for _ in n]
    shortest = min(max(least, times * q) - q for q in range(1, least + 1))       # words shared by the first two periods at least
    ends = np.cumsum(n)
    of = np.repeat(np.arange(len(n)), n)

    def repeats(h, of, ends):
        """Texts with a gram of ``shortest`` words twice, and the grams' hashes."""
        at = np.arange(max(len(h) - shortest + 1, 0))
        at = at[at + shortest <= ends[of[at]]]
        grams = c.mixed(c.Spans(h)(at, at + shortest) + of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(grams)
        return np.unique(of[at[order[1:]][grams[order[1:]] == grams[order[:-1]]]])

    some = repeats(h, of, ends)
    if not len(some):
        return out
    # only the texts with repeats go on
    h, n = h[np.isin(of, some)], n[some]
    ends = np.cumsum(n)
    begin, of = ends - n, np.repeat(np.arange(len(n)), n)
    rank = suffix_ranks(h, of, ends)
    suffix = np.empty(len(h), np.int64)
    suffix[rank] = np.arange(len(h))
    a, b = suffix[:-1], suffix[1:]
    pair = np.flatnonzero((of[a] == of[b]) & (np.maximum(a, b) + shortest <= ends[of[a]]))
    spans = c.Spans(h)
    pair = pair[spans(a[pair], a[pair] + shortest) == spans(b[pair], b[pair] + shortest)]
    lcp = _shared(spans, a[pair], b[pair], ends[of[a[pair]]] - np.maximum(a[pair], b[pair]))
    falling = np.argsort(-lcp, kind="stable")
    nodes = np.unique(np.append(pair, pair + 1))
    found = _seeds(suffix[nodes].tolist(), list(zip(np.searchsorted(nodes, pair[falling]).tolist(), lcp[falling].tolist())), times)
    if not found:
        return out
    i, d, shared = np.array(found, np.int64).T
    whole = shared + d >= np.maximum(least, times * d)
    whole &= (i == begin[of[i]]) | (h[i - 1] != h[i + d - 1])       # goes on no further to the left
    for text, start, length, period in sorted(zip(of[i[whole]].tolist(), i[whole].tolist(), (shared + d)[whole].tolist(), d[whole].tolist())):
        out[some[text]].append((start - int(begin[text]), length, period))
    for x in out:
        x.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods; of equals the first, then the one with the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, [s + q for s, _, q in runs], 1)
        np.add.at(edge, [s + n for s, n, _ in runs], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
    return b" ".join(words).decode("utf-8", "replace")


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN), ("collapsed", pa.string())])


def _run_struct(r):
    return None if r is None else dict(zip(("start", "length", "period"), r))


def _find(least: int, times: int):
    def some_at_a_time(texts):
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held > BYTES or i + 1 == len(texts):
                yield start, texts[start:i + 1]
                start, held = i + 1, 0

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for start, texts in some_at_a_time(c.byte_texts(batch.column(1))):
                found = runs_of(*c.hashed_words(texts), least, times)
                words = [t.split() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(texts)), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([[_run_struct(r) for r in x] for x in found], pa.list_(_RUN)),
                     pa.array([_run_struct(strongest(x)) for x in found], _RUN),
                     pa.array([_collapsed(w, x) for w, x in zip(words, found)], pa.string())], schema=_OUT)
    return run


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per input row: its id, ``n_words``, ``runs`` (start, length and
    period in words, by start, then period), ``strongest`` (the run of most
    periods; null without runs) and ``collapsed`` (the words joined by one
    space, without those that a run holds after its first period).

    A run is a maximal stretch of at least ``least`` words and ``times`` of its
    smallest period.  Words are maximal runs without ASCII white space,
    unchanged; null or blank text has none.  Rows are handled each by itself:
    repeated rows give repeated rows, a null id stays null, and an empty table
    gives none.  Other columns are not read.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    run = "struct<start:bigint,length:bigint,period:bigint>"
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _find(least, times), f"id long, n_words long, runs array<{run}>, strongest {run}, collapsed string")
    return found.withColumnRenamed("id", id_col)
