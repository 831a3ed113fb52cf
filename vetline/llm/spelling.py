"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near when one inserted, deleted or replaced code point turns one
into the other.  Every word makes its neighbourhood: itself without one code
point, and with one replaced by a later one of the alphabet (the other half of
the replacements, and the insertions, are made by the other word of a pair).
No neighbourhood is shuffled: each edit is looked up in blocked Bloom filters
of the vocabulary, one for each length, which are broadcast; only edits that a
filter holds go on to an exact join with the vocabulary, which takes out what
the filters hold by chance.

A filter's size follows the count of words of its length.  Filters are
broadcast ``filter_bytes`` at a time: lengths that fit together share a pass,
and a length that is larger by itself is cut into slices by hash with a pass
each, so no pass sends more, whatever the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5               # times as frequent as a word its form is, at least
BITS = 24               # of a filter for each word
FILTER_BYTES = 32 << 20
EDITS = 1 << 19         # looked up at once

_U = np.uint64


# ---- words -----------------------------------------------------------------
def letter_runs(text: Column) -> Column:
    """Maximal runs of Latin letters (and what else stands from U+00C0 to U+00FF); null: none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[A-Za-zÀ-ÿ]+"), F.lit(0))


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, upper, upper.lower()))


def vocabulary(words: DataFrame, word_col: str = "word", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the distinct words of ``least_chars`` code points and
    ``least_count`` rows.  Null words count for nothing."""
    word = F.col(word_col).cast("string").alias("word")
    counted = words.select(word).where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


# ---- filters ---------------------------------------------------------------
def _by_length(words: list[str]):
    """``(length, indexes, code points as a matrix)`` of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths[lengths > 0]).tolist():
        which = np.flatnonzero(lengths == n)
        text = "".join([words[i] for i in which])
        yield n, which, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(-1, n)


def _values(codes: np.ndarray) -> np.ndarray:
    return c.mixed(codes.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(11))


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return c.mixed(sums + _U(length * 0xD6E8FEB86659FD93 % 2**64))


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits of a hash: five of a block's 64."""
    block = ((hashes >> _U(40)) * _U(blocks)) >> _U(24) if blocks <= 1 << 24 else hashes % _U(blocks)
    bits = np.zeros(len(hashes), _U)
    for k in range(5):
        bits |= _U(1) << ((hashes >> _U(6 * k)) & _U(63))
    return block.astype(np.int64), bits


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (c.mixed(hashes + _U(7)) % _U(slices)).astype(np.int64)


def _passes(counts: dict[int, int], filter_bytes: int) -> list[dict[int, tuple[int, int, int, int]]]:
    """For each pass: length -> (first block, blocks, slice, slices)."""
    most = max(filter_bytes // 8, 1)
    out, used = [], most + 1
    for length, n in sorted(counts.items()):
        blocks = -(-n * BITS // 64)
        slices = -(-blocks // most)
        for k in range(slices):
            size = -(-blocks // slices)
            if used + size > most or slices > 1:
                out.append({})
                used = 0
            out[-1][length] = (used, size, k, slices)
            used = used + size if slices == 1 else most + 1
    return out


def _bits(shards: dict):
    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, _, codes in _by_length(words):
                if length not in shards:
                    continue
                first, blocks, part, slices = shards[length]
                h = _finished((_values(codes) * c.powers(length)[0][:length]).sum(axis=1, dtype=_U), length)
                h = h[_slice_of(h, slices) == part]
                block, bits = _places(h, blocks)
                order = np.argsort(block, kind="stable")
                block, bits = block[order], bits[order]
                if len(block):
                    head = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                    yield pa.RecordBatch.from_arrays([pa.array(first + block[head]), pa.array(np.bitwise_or.reduceat(bits, head).view(np.int64))],
                                                     names=["block", "bits"])
    return run


def _filter(vocab: DataFrame, shards: dict) -> np.ndarray:
    """The blocks of one pass: at most ``filter_bytes``, merged before they are collected."""
    size = max(first + blocks for first, blocks, _, _ in shards.values())
    merged = vocab.select("word").mapInArrow(_bits(shards), "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
    table = merged.toArrow()
    out = np.zeros(size, _U)
    out[table.column("block").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return out


# ---- neighbourhoods --------------------------------------------------------
def _probe(filters, shards: dict, alphabet: str):
    letters = np.frombuffer(alphabet.encode("utf-32-le"), np.uint32)
    letter_values = _values(letters)

    def held(hashes: np.ndarray, length: int, filled: np.ndarray) -> np.ndarray:
        first, blocks, part, slices = shards[length]
        block, bits = _places(hashes, blocks)
        hit = (filled[first + block] & bits) == bits
        return hit & (_slice_of(hashes, slices) == part) if slices > 1 else hit

    def neighbours(words: list[str], filled: np.ndarray):
        for length, which, codes in _by_length(words):
            up, down = c.powers(length + 1)
            values = _values(codes)
            terms = values * up[:length]
            whole = terms.sum(axis=1, dtype=_U)
            if length in shards:        # one replaced by a later letter
                step = max(1, EDITS // len(letters))
                for i in range(length):
                    for at in range(0, len(which), step):
                        old = codes[at:at + step, i]
                        w, a = np.nonzero(letters[None, :] > old[:, None])
                        sums = whole[at + w] + (letter_values[a] - values[at + w, i]) * up[i]
                        hit = np.flatnonzero(held(_finished(sums, length), length, filled))
                        for x, y in zip((at + w[hit]).tolist(), a[hit].tolist()):
                            word = words[which[x]]
                            yield word, word[:i] + alphabet[y] + word[i + 1:]
            if length - 1 in shards:    # one deleted, the last of equal neighbours
                before = np.zeros(len(which), _U)
                for i in range(length):
                    after = whole - before - terms[:, i]
                    use = np.flatnonzero(codes[:, i] != codes[:, i + 1]) if i + 1 < length else np.arange(len(which))
                    sums = before[use] + after[use] * down[1]
                    hit = use[held(_finished(sums, length - 1), length - 1, filled)]
                    for x in hit.tolist():
                        word = words[which[x]]
                        yield word, word[:i] + word[i + 1:]
                    before = before + terms[:, i]

    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("edit", pa.string())])

    def run(batches):
        filled = filters.value
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            count = dict(zip(words, n))
            yield from c.rebatched(((w, count[w], e) for w, e in neighbours(words, filled)), schema)
    return run


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(word, near, near_n)`` for each two near words, both ways round, of a
    stored ``vocab (word, n)`` with one row per word."""
    spark = vocab.sparkSession
    # one row per length, and one per letter: bounded by the longest word and the alphabet
    counts = {r["length"]: r["n"] for r in vocab.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    counts.pop(0, None)
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("x")).distinct().collect()
    alphabet = "".join(sorted(r["x"] for r in letters if r["x"]))
    exact = None
    for shards in _passes(counts, filter_bytes):
        lengths = sorted({n for x in shards for n in (x, x + 1)})
        probing = vocab.where(F.char_length("word").isin(lengths))
        filters = spark.sparkContext.broadcast(_filter(vocab.where(F.char_length("word").isin(sorted(shards))), shards))
        positives = probing.select("word", "n").mapInArrow(_probe(filters, shards, alphabet), "word string, n long, edit string")
        # written before the next pass, so that one pass's filters are held at a time
        found = c.stored(positives.join(vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit"), "near-words")
        filters.destroy()
        exact = found if exact is None else exact.unionByName(found)
    if exact is None:
        return vocab.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    return exact.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")).unionByName(
        exact.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for each word with a form: the end of its forms.  The
    steps taken double with each round; counts grow by ``ratio`` at each step,
    so a handful of rounds ends any chain."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = c.stored(now, "roots")
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(onward, "root", "left")
        if moved.where("next is not null").isEmpty():
            return now
        now = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(vocab: DataFrame, ratio: int = RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per word of ``vocab (word, n)``: ``word``, ``form`` (its near
    word of largest n, of equals the first in code-point order, where that n is
    ``ratio`` times the word's at least; else null), ``root`` (the end of its
    chain of forms; the word itself without one), ``n``, ``n_near`` (near
    words) and ``form_n``.

    Null and empty words go, words of several rows are one whose n is the
    largest; an empty vocabulary gives no rows.  Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    word, n = F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")
    words = c.stored(vocab.select(word, n).where("word <> ''").groupBy("word").agg(F.max("n").alias("n")), "vocabulary")
    best = near_words(words, filter_bytes).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("back"), F.col("near").alias("near"))).alias("best"))
    told = words.join(best, "word", "left")
    good = -F.col("best.back") >= ratio * F.col("n")
    told = c.stored(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.back")).alias("form_n")), "variants")
    rooted = told.join(_roots(told.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
