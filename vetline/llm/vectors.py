"""TF-IDF vectors over bounded vocabularies, for the two classifiers."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

CACHED_WORDS = 120_000      # per Python worker
_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]{2,}"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"\d+")
_SAME = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Letters by case, digits as one, the rest as it is; runs collapse."""
    if word.isalpha():          # the common cases without patterns
        if word.islower():
            return "a"
        if word.istitle() and len(word) > 1:
            return "Aa"
    s = _LOWER.sub("a", _DIGIT.sub("9", word[:64]))
    return _SAME.sub(r"\1\1", _UPPER.sub("AA", s)) if len(s) > 1 else s


class WordFeatures:
    """Feature numbers of words, in flat arrays behind a bounded index."""

    def __init__(self, of_word: Callable[[str], Sequence[int]]):
        self.of_word = of_word
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {}
        self.starts, self.lens, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int64), 0

    def _add(self, words: list[str]) -> None:
        got = list(map(self.of_word, words))
        n = np.fromiter(map(len, got), np.int64, len(got))
        i, total = len(self.index), int(n.sum())
        while i + len(got) > len(self.lens):
            self.starts, self.lens = np.resize(self.starts, 2 * len(self.lens)), np.resize(self.lens, 2 * len(self.lens))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lens[i:i + len(got)] = n
        self.starts[i:i + len(got)] = self.used + np.cumsum(n) - n
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), np.int64, total)
        self.used += total
        self.index.update(zip(words, range(i, i + len(got))))

    def numbers(self, words: list[str]) -> np.ndarray:
        """The index of each word, in order."""
        at = list(map(self.index.get, words))
        if None in at:
            if len(self.index) > CACHED_WORDS:
                self._clear()
            self._add([w for w in dict.fromkeys(words) if w not in self.index])
            at = [self.index[w] for w in words]
        return np.array(at, np.int64)

    def counts(self, at: np.ndarray, size: int) -> np.ndarray:
        """How often the words of these numbers have each feature."""
        n = self.lens[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self.starts[at] - (ends - n), n)
        return np.bincount(self.flat[where], minlength=size).astype(np.float32)


GRAM = 5                    # bytes; at most 8
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def packed_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``GRAM``-byte grams of texts (A-Z lower-cased; ASCII signs and white
    space are one kind of edge, which is also before and after a text), packed
    into integers, and where those of each text end."""
    gap = b" " * (GRAM - 1)
    raw = gap + b"".join(t.translate(_FOLD) + gap for t in texts) + b" " * (8 - GRAM)
    eights = np.ndarray(len(raw) - 7, ">u8", raw, strides=(1,))
    return eights.astype(np.uint64) >> np.uint64(64 - 8 * GRAM), np.cumsum(np.array([len(t) + GRAM - 1 for t in texts], np.int64))


def byte_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of texts, and the text of each."""
    grams, ends = packed_grams(texts)
    return grams, np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))


WORD = np.uint64(1 << 63)   # marks the hash of a whole word


def terms_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte grams and whole words of texts, and the text of each."""
    grams, of = byte_grams(texts)
    words, n = c.hashed_words([t.translate(_FOLD) for t in texts])
    return np.concatenate([grams, words | WORD]), np.concatenate([of, np.repeat(np.arange(len(texts)), n)])


@lru_cache(20_000)
def hashed(feature: str, size: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % size


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length ((1 + log tf) * idf), or zero."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def document_frequencies(docs: DataFrame, text_col: str, presence: Callable[[], Callable[[list], np.ndarray]],
                         size: int) -> tuple[int, np.ndarray]:
    """Documents, and documents with each feature, over the whole corpus: each
    task adds up its own rows, and ``size`` sums reach the driver.  ``presence``
    makes, in a task, a function from texts to the sums over them."""
    def run(batches):
        count, n = presence(), 0
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += count(batch.column(0))
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(np.append(df, n))], names=["f", "n"])

    sums = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 1, np.int64)
    for r in sums.collect():
        out[r["f"]] = r["n"]
    return int(out[size]), out[:size]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, limit: int,
                    id_col: str, text_col: str) -> DataFrame:
    """At most ``limit`` labelled documents outside the held-out fold, in hash
    order of their ids, as a stored table (k, t, y): id, text, label.  Repeated
    label rows of one id count once, by the larger label; repeated documents
    by one of their texts."""
    sure = labels.select(F.col(id_col).cast("long").alias("k"), F.col(label).cast("int").alias("y")).where(
        "k is not null and y in (0, 1)").where(F.pmod(F.crc32(F.col("k").cast("string")), F.lit(modulus)) != held_out)
    chosen = sure.groupBy("k").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    # labels may name rows that the documents lack, so the sample is of ids that are there
    there = texts.select("k").distinct().join(chosen, "k").orderBy(F.xxhash64("k"), "k").limit(limit)
    # the sample is bounded by ``limit`` ids: small enough to send to every task
    rows = texts.join(F.broadcast(there), "k").groupBy("k", "y").agg(F.max("t").alias("t"))
    return c.stored(rows.select("k", "t", "y"), "sample")


def fitted(sample: DataFrame, fit: Callable[[list[tuple[int, str, int]]], object]) -> object:
    """What ``fit`` makes of the bounded sample (rows in order of their ids),
    in one task; only the result reaches the driver, as an Arrow batch, which its
    JVM passes on as it is (a row of a pickled result would be copied several times)."""
    def run(batches):
        rows = sorted(r for b in batches for r in zip(*(col.to_pylist() for col in b.columns)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])
    return pickle.loads(sample.coalesce(1).mapInArrow(run, "model binary").toArrow().column("model")[0].as_buffer())
