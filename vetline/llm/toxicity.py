"""Toxicity by nearest labelled examples, exact TF-IDF cosine over a block-max inverted index.

Terms are all words of a bounded labelled sample and those short byte grams that the sample
ties to the label (chi-square); document frequencies come from the whole corpus.  Words
and grams that speak for label 1 weigh ``EMPHASIS`` times their idf, so one coded
word in a long text is not drowned by what else the text is about.  The
labelled vectors form an inverted index whose postings are cut into blocks of
like examples, with the largest weight of each term in each block; blocks of common
terms are also held in full, as rows, which several queries multiply at once in
single precision.  A query visits the blocks of the highest bounds first, then
those whose bounds allow more, and
compares in whole each example that the rounding leaves: the neighbours
are exactly those of a full comparison.  The index is bounded by the sample
(``SAMPLE`` examples) and sent to every task.

The neighbours vote, weighted by cosine; a monotone map from votes to shares of
label 1 among the examples themselves (each without its own vote, nor
those of its copies) calibrates the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c
from vetline.llm import vectors as v

SAMPLE = 10_000         # labelled documents at most
EMPHASIS = 100.0        # weight of a term that speaks for label 1
LEAST_CHI2 = 25.0       # of such a term's tie to the label
LEAST_EXAMPLES = 5      # with label 1 that hold it
NEIGHBOURS = 25
BLOCK = 256             # examples in a block
FIRST = 2               # blocks searched before the others
COMMON = 16             # a term that one place in so many holds has a row of all places too (the neighbours do not depend on it)
AT_ONCE = 64            # queries that multiply the rows together
MEMORY = 1024           # different queries remembered per task, or those of one batch of texts
BYTES = 1 << 20         # of text searched for terms at once
THRESHOLD = 0.3


def chosen_terms(texts: list[bytes], y: np.ndarray) -> np.ndarray:
    """Words and grams that speak for label 1, strongest first."""
    def short(x: np.ndarray) -> np.ndarray:
        return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def counted(some: list[bytes], of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        grams, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        if of is not None:
            maybe = np.zeros(1 << 20, bool)         # only terms of ``of`` are wanted; most others are told apart by 20 bits
            maybe[short(of)] = True
        for i in range(0, len(some), 500):
            all_ = (v.terms_in([t])[0] for t in some[i:i + 500])
            own = np.concatenate([np.unique(x if of is None else x[maybe.take(short(x).view(np.int64))]) for x in all_])
            got, m = np.unique(own, return_counts=True)
            both, at = np.unique(np.concatenate([grams, got]), return_inverse=True)
            grams, n = both, np.bincount(at, np.concatenate([n, m]), len(both)).astype(np.int64)
        return grams, n

    ones, a = counted([t for t, label in zip(texts, y) if label])
    within = (ones >= v.WORD) | np.all([(ones >> np.uint64(8 * i)) & np.uint64(255) != 32 for i in range(1, v.GRAM - 1)], axis=0)    # one word
    ones, a = ones[within & (a >= LEAST_EXAMPLES)], a[within & (a >= LEAST_EXAMPLES)].astype(float)
    zeros, m = counted([t for t, label in zip(texts, y) if not label], ones)
    at = np.minimum(np.searchsorted(zeros, ones), max(len(zeros) - 1, 0))
    b = np.where(zeros[at] == ones, m[at], 0).astype(float) if len(zeros) else np.zeros(len(ones))
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = np.nan_to_num((n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (n1 * n0 * (a + b) * (n1 + n0 - a - b)))
    chi2[a * n0 <= b * n1] = 0
    order = np.lexsort((ones, -chi2))
    return ones[order[chi2[order] >= LEAST_CHI2]]


class Terms:
    """Numbers of known words (as hashed) and, after them, of known byte grams."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.__setstate__((np.sort(words), np.sort(grams)))

    def __getstate__(self):
        return self.words, self.grams

    def __setstate__(self, known: tuple[np.ndarray, np.ndarray]):
        self.words, self.grams = known
        self.size = max(1, len(self.words) + len(self.grams))
        self.maybe = np.zeros(1 << 16, bool)        # most grams are told apart by 16 bits
        self.maybe[self._short(self.grams)] = True
        self.starts = np.minimum(np.searchsorted(self.words, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)), max(len(self.words) - 1, 0))

    @staticmethod
    def _short(g: np.ndarray) -> np.ndarray:
        return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)

    def _word_rows(self, seen: np.ndarray) -> np.ndarray:
        """Where words stand or would stand: from the first with their 20 highest bits, step by step."""
        row = self.starts.take((seen >> np.uint64(44)).view(np.int64))
        todo, last = np.arange(len(seen)), len(self.words) - 1
        while len(todo := todo[(row[todo] < last) & (self.words.take(row[todo]) < seen[todo])]):
            row[todo] += 1
        return row

    def found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and count of each term in each text, by text and term."""
        if not texts:
            return (np.empty(0, np.int64),) * 3
        seen, n = c.hashed_words([t.translate(v._FOLD) for t in texts])
        of, term = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(self.words):
            row = self._word_rows(seen)
            sure = self.words.take(row) == seen
            of, term = np.repeat(np.arange(len(texts)), n)[sure], row[sure]
        if len(self.grams):
            g, ends = v.packed_grams(texts)
            few = np.flatnonzero(self.maybe.take(self._short(g).view(np.int64)))
            row = np.minimum(np.searchsorted(self.grams, g[few]), len(self.grams) - 1)
            sure = self.grams[row] == g[few]
            of, term = np.append(of, np.searchsorted(ends, few[sure], "right")), np.append(term, row[sure] + len(self.words))
        both, n = np.unique(of * self.size + term, return_counts=True)
        return both // self.size, both % self.size, n


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers from lo[i], n[i] of them, for each i in order."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - n), n)


class Index:
    """Block-max inverted index over ``n`` sparse unit vectors, given as example,
    term and weight by example and term."""

    def __init__(self, n: int, size: int, example: np.ndarray, term: np.ndarray, weight: np.ndarray, block: int = BLOCK):
        self.n, self.size, self.block, self.blocks = n, size, block, max(1, -(-n // block))
        # terms are numbered anew, the commonest first, so that lookups stay close together
        self.renumbered = np.empty(size, np.int64)
        held = np.bincount(term, minlength=size)
        self.renumbered[np.argsort(-held, kind="stable")] = np.arange(size)
        term = self.renumbered[term]
        # examples that share common words lie in one block, so that its bounds are tight
        near = np.zeros((n, min(size, 48)), bool)
        near[example[term < 48], term[term < 48]] = True
        self.order = np.lexsort(near.T[::-1])
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        # forward: terms of each place; inverted: places of each term
        by_place = np.lexsort((term, place[example]))
        self.own_term, self.own_weight = term[by_place].astype(np.int32), weight[by_place].astype(np.float32)
        self.own = np.searchsorted(place[example][by_place], np.arange(n + 1))
        by_term = np.lexsort((place[example], term))
        self.place, self.weight = place[example][by_term].astype(np.int32), weight[by_term].astype(np.float32)
        self.from_term = np.searchsorted(term[by_term], np.arange(size + 1))
        # cells: the postings of one term in one block, and their largest weight
        of = term[by_term] * self.blocks + self.place // block
        self.cell = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.empty(0, np.int64)
        self.cell_block = (of[self.cell] % self.blocks).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, self.cell) if len(of) else np.empty(0, np.float32)
        self.from_cell = np.searchsorted(of[self.cell] // self.blocks, np.arange(size + 1))
        self.cell = np.append(self.cell, len(of))
        # the blocks of common terms in full (COMMON times the postings at most); a sum of q products in single precision
        # is off by less than q + 2 roundings of it, and it is 1 at most
        self.common = np.count_nonzero(held * COMMON >= self.blocks * block)
        self.rows = np.zeros((self.common, self.blocks * block), np.float32)
        some = term < self.common
        self.rows[term[some], place[example[some]]] = weight[some]
        self.off = (self.common + 2) * 2.0 ** -23

    def _whole(self, places: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Cosines of the query with whole examples."""
        lo, n = self.own[places], self.own[places + 1] - self.own[places]
        where = _ranges(lo, n)
        return np.bincount(np.repeat(np.arange(len(places)), n), dense.take(self.own_term.take(where)) * self.own_weight.take(where), len(places))

    def _sums(self, cell: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Products of cells' postings with their terms' part of the query, added up by block and place."""
        lo = self.cell[cell]
        n = self.cell[cell + 1] - lo
        where = _ranges(lo, n)
        return np.bincount(self.place.take(where), np.repeat(q, n) * self.weight.take(where), self.blocks * self.block).reshape(self.blocks, self.block)

    def _best(self, places: np.ndarray, cosines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.order[places], -np.round(cosines, 9)))
        best = best[cosines[best] > 0][:k]
        return places[best], cosines[best]

    def rough(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each query (terms and weights), what common terms add to its cosine
        with each place, by block, to within ``off``."""
        of, term = np.repeat(np.arange(len(queries)), [len(t) for t, _ in queries]), self.renumbered[np.concatenate([t for t, _ in queries])]
        some, x = term < self.common, np.zeros((len(queries), self.common), np.float32)
        x[of[some], term[some]] = np.concatenate([q for _, q in queries])[some]
        return (x @ self.rows).reshape(-1, self.blocks, self.block)

    def nearest(self, terms: np.ndarray, q: np.ndarray, k: int, dense: np.ndarray | None = None,
                rough: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The examples with the k highest positive cosines (ties: lower
        number) and these cosines.  ``dense`` is all zeros, one for each term, and
        is left so; ``rough`` is this query's part of ``rough()``."""
        rough = self.rough([(terms, q)])[0] if rough is None else rough
        terms = self.renumbered[terms]
        dense = np.zeros(self.size) if dense is None else dense
        dense[terms] = q
        lo = self.from_cell[terms]
        n = self.from_cell[terms + 1] - lo
        cell, part = _ranges(lo, n), np.repeat(q, n)
        most, block = part * self.most.take(cell), self.cell_block.take(cell)
        bound = np.bincount(block, most, self.blocks)
        near = np.zeros(self.blocks, bool)
        near[np.argsort(-bound, kind="stable")[:FIRST]] = True
        rare = np.repeat(terms >= self.common, n)
        some = np.flatnonzero(rare & near.take(block))
        sums = rough + self._sums(cell.take(some), part.take(some))
        kth = max(0.0, np.partition(sums[near].ravel(), -k)[-k] - self.off) if near.sum() * self.block >= k else 0.0
        left = (bound >= kth - 1e-6) & (bound > 0) & ~near
        if left.any():
            some = np.flatnonzero(rare & left.take(block))
            sums += self._sums(cell.take(some), part.take(some))
        at = np.flatnonzero(left | near)
        sums = sums[at]
        if sums.size >= k:          # a k-th sum bounds the k-th cosine
            kth = max(kth, np.partition(sums.ravel(), -k)[-k] - self.off)
        i, j = np.nonzero((sums >= kth - self.off - 1e-6) & (sums > 0))
        places = at[i] * self.block + j
        places, cosines = self._best(places, self._whole(places, dense), k)
        dense[terms] = 0
        return self.order[places], cosines


def voted(y: np.ndarray, cosines: np.ndarray, prior: float) -> float:
    """Share of label 1 weighted by closeness; ``prior`` counts like a weak neighbour."""
    w = 1.0 / (1.05 - np.minimum(cosines, 1.0))
    return float(((w * y).sum() + prior) / (w.sum() + 1.0))


def calibration(votes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Monotone steps (pool adjacent violators): votes and shares of label 1."""
    order = np.argsort(votes, kind="stable")
    sums, ns, xs = [], [], []
    for s, t in zip(votes[order], y[order]):
        sums.append(float(t))
        ns.append(1.0)
        xs.append([s, s])
        while len(ns) > 1 and sums[-2] / ns[-2] >= sums[-1] / ns[-1]:
            total, n, (_, high) = sums.pop(), ns.pop(), xs.pop()
            sums[-1] += total
            ns[-1] += n
            xs[-1] = [xs[-1][0], high]
    x = np.array([e for pair in xs for e in pair])
    share = np.repeat(np.array(sums) / np.array(ns), 2)
    return x, share


def weighed(of: np.ndarray, term: np.ndarray, n: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Weights of terms in unit vectors: (1 + log count) times the term's own."""
    x = (1 + np.log(n)) * weight[term]
    norm = np.sqrt(np.bincount(of, x * x, rows))
    return x / np.where(norm > 0, norm, 1)[of]


def _packed(x: np.ndarray) -> bytes:
    """Integers of 32 bits, their highest bytes first, compressed."""
    return zlib.compress(np.ascontiguousarray(x.astype(">i4").view(np.uint8).reshape(-1, 4).T), 1)


def _unpacked(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(x), np.uint8).reshape(4, -1).T).view(">i4").ravel().astype(np.int64)


class Model:
    """Terms, weights, labelled vectors and calibration; bounded by the sample.
    The index is built anew where it is used."""

    def __init__(self, terms: Terms, weight: np.ndarray, rows: list[tuple[int, bytes, int]]):
        self.terms, self.term_weight = terms, weight
        self.ids = [r[0] for r in rows]
        self.y = np.array([r[2] for r in rows], np.float64)
        parts = [terms.found([t for _, t, _ in rows[i:i + 200]]) for i in range(0, len(rows), 200)]
        of = np.concatenate([p[0] + 200 * i for i, p in enumerate(parts)] or [np.empty(0, np.int64)])
        term, n = (np.concatenate([p[j] for p in parts] or [np.empty(0, np.int64)]) for j in (1, 2))
        some = weighed(of, term, n, weight, len(rows)) > 0
        # the vectors as terms (each the difference from the one before) and counts, packed: the model passes through the driver
        self.held = np.bincount(of[some], minlength=len(rows)).astype(np.int32)
        self.packed = _packed(np.diff(term[some], prepend=0)), _packed(n[some])
        of, term, x = self.entries()
        starts = np.searchsorted(of, np.arange(len(rows) + 1))
        bare = starts[1:] == starts[:-1]
        self.prior = float((self.y.sum() + 0.5) / (len(self.y) + 1))
        # a text without any term scores as the examples without any
        self.bare = float((self.y[bare].sum() + 20 * min(self.prior, 0.02)) / (bare.sum() + 20))
        votes, labels, same = [], [], {}
        for i in np.flatnonzero(~bare):
            lo, hi = starts[i], starts[i + 1]
            same.setdefault(c.id128(term[lo:hi].tobytes() + x[lo:hi].tobytes()), []).append(i)
        copies = list(same.values())
        queries = [(term[starts[i]:starts[i + 1]].astype(np.int64), x[starts[i]:starts[i + 1]].astype(np.float64)) for i, *_ in copies]
        for own, (near, cos) in zip(copies, self.nearest(queries, [NEIGHBOURS + len(own) for own in copies])):
            other = ~np.isin(near, own)         # each without its own copies
            votes.append(voted(self.y[near[other][:NEIGHBOURS]], cos[other][:NEIGHBOURS], self.prior))
            labels.append(self.y[own].mean())
        self.curve = calibration(np.array(votes), np.array(labels)) if votes else None

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items() if k not in ("index", "dense")}

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Example, term and weight of the vectors, by example and term."""
        of, (term, n) = np.repeat(np.arange(len(self.held)), self.held), map(_unpacked, self.packed)
        term = np.cumsum(term)
        return of, term, weighed(of, term, n, self.term_weight, len(self.held)).astype(np.float32)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms and weights) the numbers and cosines of the k nearest examples."""
        if "index" not in self.__dict__:
            self.index = Index(len(self.y), self.terms.size, *self.entries())
            self.dense = np.zeros(self.terms.size)
        for i in range(0, len(queries), AT_ONCE):
            some = queries[i:i + AT_ONCE]
            for (terms, q), n, rough in zip(some, k[i:i + AT_ONCE], self.index.rough(some)):
                yield self.index.nearest(terms, q, n, self.dense, rough)

    def several(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[int], list[float]]]:
        """Scores and neighbours of texts given as terms and counts."""
        queries = [(terms, weighed(np.zeros(len(terms), np.int64), terms, n, self.term_weight, 1)) for terms, n in texts]
        for near, cos in self.nearest(queries, [NEIGHBOURS] * len(queries)):
            if not len(near):
                yield self.bare, [], []
                continue
            vote = voted(self.y[near], cos, self.prior)
            p = float(np.interp(vote, *self.curve)) if self.curve is not None else vote
            yield min(max(p, 0.0), 1.0), [self.ids[i] for i in near], [float(s) for s in cos]

    def scores(self, texts: list[bytes], memory: dict) -> list[tuple[float, list[int], list[float]]]:
        """Score of each text, and the neighbours that gave it; ``memory``
        spares equal queries."""
        out = [(self.bare, [], [])] * len(texts)
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end]) < BYTES):
                held += len(texts[end])
                end += 1
            of, term, n = self.terms.found(texts[at:end])
            cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else ()
            keys, new = [], {}
            for lo, hi in zip(cuts, np.append(cuts[1:], len(of)) if len(of) else ()):
                keys.append((at + of[lo], c.id128(term[lo:hi].tobytes() + n[lo:hi].tobytes())))
                if keys[-1][1] not in memory:
                    new.setdefault(keys[-1][1], (term[lo:hi], n[lo:hi]))
            known = {key: memory[key] for _, key in keys if key not in new} | dict(zip(new, self.several(list(new.values()))))
            if len(memory) + len(new) > MEMORY:
                memory.clear()
            memory.update(known)
            for i, key in keys:
                out[i] = known[key]
            at = end
        return out


def _frequencies(docs: DataFrame, text_col: str, terms: Terms) -> tuple[int, np.ndarray]:
    """Documents, and documents with each term, over the whole corpus: each task
    adds up its own rows, and one sum for each term reaches the driver."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        n, df = 0, np.zeros(terms_size + 1, np.int64)
        for batch in batches:
            texts, at = c.byte_texts(batch.column(0)), 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) < BYTES):
                    held += len(texts[end])
                    end += 1
                df += np.bincount(known.value.found(texts[at:end])[1], minlength=terms_size + 1)
                at = end
            n += batch.num_rows
        df[terms_size] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["f", "n"])

    terms_size = terms.size
    sums = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    known.destroy()
    out = np.zeros(terms_size + 1, np.int64)
    out[sums.column("f").to_numpy()] = sums.column("n").to_numpy()
    return int(out[terms_size]), out[:terms_size]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        modulus: int = 4, held_out: int = 2, sample: int = SAMPLE) -> Model:
    rows = v.labelled_sample(docs, labels, label, modulus, held_out, sample, id_col, text_col)

    def known(some: list[tuple[int, str, int]]) -> tuple[Terms, np.ndarray]:
        """All words of the sample, the grams that speak for label 1, and the
        numbers of the words and grams that do."""
        y, texts = np.array([r[2] for r in some]), [t.encode() for _, t, _ in some]
        speaking = chosen_terms(texts, y) if len(y) and 0 < y.sum() < len(y) else np.empty(0, np.uint64)
        words = np.empty(0, np.uint64)
        for i in range(0, len(texts), 500):
            words = np.union1d(words, c.hashed_words([t.translate(v._FOLD) for t in texts[i:i + 500]])[0])
        terms = Terms(words, speaking[speaking < v.WORD])
        marked = np.isin(words | v.WORD, speaking[speaking >= v.WORD])
        return terms, np.append(np.flatnonzero(marked), np.arange(len(words), len(words) + len(terms.grams)))

    terms, speaking = v.fitted(rows, known)
    n, df = _frequencies(docs, text_col, terms)
    weight = np.log((1 + n) / (1 + df)).astype(np.float32)
    weight[speaking] = (weight[speaking] + 1) * EMPHASIS
    return v.fitted(rows, lambda some: Model(terms, weight, [(i, t.encode(), y) for i, t, y in some]))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
             modulus: int = 4, held_out: int = 2, sample: int = SAMPLE, threshold: float = THRESHOLD,
             evidence: bool = True) -> DataFrame:
    """Each row's id with ``held_out`` (its fold gave no labels), ``score`` (0 to
    1, higher: label 1 likelier), ``predicted`` and, as ``evidence``, the ids and
    cosines of the neighbours.  A text without any known term that tells texts
    apart (an empty or null one too) scores as such examples do and has no neighbours.  Without usable labels
    every score is the prior.  A null id is not held out; repeated rows
    score alike; other columns are not read.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(fit(docs, labels, label, id_col, text_col, modulus, held_out, sample))

    def run(batches):
        m, memory = model.value, {}
        for b in batches:
            got = m.scores(c.byte_texts(b.column(1)), memory)
            columns = [b.column(0), pa.array([g[0] for g in got], pa.float64())]
            if evidence:
                columns += [pa.array([g[1] for g in got], pa.list_(pa.int64())), pa.array([g[2] for g in got], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "score"] + ["neighbours", "cosines"] * evidence
    schema = "id long, score double" + (", neighbours array<long>, cosines array<double>" if evidence else "")
    told = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    fold = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(modulus)) == held_out, F.lit(False))
    return told.select(F.col("id").alias(id_col), fold.alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"), *names[2:])
