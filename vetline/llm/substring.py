"""Substring dedup by seed and extend.

Seeds.  A window is ``window`` consecutive words.  Among its ``seed``-word grams
the one with the least hash (the last of equals) is its anchor; equal windows
have equal anchors at equal offsets, so only documents that share an anchor can
share a window.  Consecutive windows of one document with the same anchor
position form a run: the anchor with all that it extends over, to both sides.

Extension.  Runs meet by anchor.  Where whole runs are equal, the repeat
extends over both of them and nothing is compared word by word.  For an
anchor whose runs differ, one run of each content is cut into its windows,
and windows found twice give how far the match extends within the run.  The
union over adjacent runs is the maximal repeats of at least ``window`` words.

No pair of documents is formed: equal runs and equal windows are counted, so a
passage that a third of all documents share costs no more than any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

WINDOW = 35
SEED = 10
BLOCK = 1 << 15         # positions whose least grams are found at once
BYTES = 1 << 20         # of text handled at once


class Runs:
    """The runs of some texts: text, anchor hash and position, first and last
    window, all positions counted from the first word of the text."""

    def __init__(self, texts: list[bytes], window: int, seed: int):
        h, n = c.hashed_words(texts)
        ends = np.cumsum(n)
        self.begin = ends - n
        self.spans = c.Spans(h)
        at = np.arange(len(h))
        self.of = np.repeat(np.arange(len(texts)), n)
        first = at[:max(len(h) - window + 1, 0)]
        first = first[first + window <= np.repeat(ends, n)[first]]       # windows within one text
        grams = self.spans(at[:max(len(h) - seed + 1, 0)], at[:max(len(h) - seed + 1, 0)] + seed)
        anchor = self._least(grams, window - seed + 1)[first] if len(first) else first
        cut = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (self.of[first[1:]] != self.of[first[:-1]]))) if len(first) else first
        self.lo = first[cut]
        self.hi = np.append(first[cut[1:] - 1], first[-1:]) if len(first) else first
        self.at = anchor[cut]
        self.anchor = grams[self.at]

    @staticmethod
    def _least(g: np.ndarray, wide: int) -> np.ndarray:
        """Position of the least of every ``wide`` values, the last of equals."""
        out = np.empty(max(len(g) - wide + 1, 0), np.int64)
        low = np.uint64(2 * BLOCK - 1)
        for i in range(0, len(out), BLOCK):
            x = g[i:i + BLOCK + wide - 1]
            # leading bits, then the place in the block from the right
            x = (x & ~low) | (low - np.arange(len(x), dtype=np.uint64))
            done, step = 1, x
            while done < wide:
                more = min(done, wide - done)
                step = np.minimum(step[:len(step) - more], step[more:])
                done += more
            out[i:i + BLOCK] = i + (low - (step & low)).astype(np.int64)
        return out

    def contents(self, window: int) -> np.ndarray:
        """Hash of each run's words and of the anchor's place in it."""
        return c.mixed(self.spans(self.lo, self.hi + window) + (self.at - self.lo).astype(np.uint64))


def _some_at_a_time(texts: list[bytes]):
    """Slices of about ``BYTES`` of text."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held > BYTES:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _anchors(window: int, seed: int):
    def run(batches):
        for batch in batches:
            for _, some in _some_at_a_time(c.byte_texts(batch.column(0))):
                yield pa.RecordBatch.from_arrays([pa.array(Runs(some, window, seed).anchor.view(np.int64))], names=["anchor"])
    return run


def _seeds(window: int, seed: int):
    def run(batches):
        for batch in batches:
            t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start, some in _some_at_a_time(c.byte_texts(batch.column(2))):
                r = Runs(some, window, seed)
                of = r.of[r.lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (t1[start + of], t2[start + of], r.anchor.view(np.int64), r.contents(window).view(np.int64),
                                           (r.lo - r.begin[of]).astype(np.int32), (r.hi - r.begin[of]).astype(np.int32))],
                    names=["t1", "t2", "anchor", "content", "lo", "hi"])
    return run


def _windows(window: int):
    names = ["t1", "t2", "anchor", "weight", "open", "at", "hash"]

    def run(batches):
        for batch in batches:
            t1, t2, jobs = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_pylist()
            for start, some in _some_at_a_time(c.byte_texts(batch.column(2))):
                h, words = c.hashed_words(some)
                spans, begin = c.Spans(h), np.cumsum(words) - words
                work = [(i, w) for i in range(len(some)) for w in jobs[start + i]]
                text = np.array([i for i, _ in work], np.int64)
                lo = np.array([w["lo"] for _, w in work], np.int64)
                n = np.array([w["hi"] for _, w in work], np.int64) - lo + 1
                of = np.repeat(np.arange(len(work)), n)
                at = lo[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]
                where = begin[text[of]] + at
                columns = [t1[start + text[of]], t2[start + text[of]], np.array([w["anchor"] for _, w in work], np.int64)[of],
                           np.array([w["total"] for _, w in work], np.int64)[of], np.array([w["open"] for _, w in work], bool)[of],
                           at.astype(np.int32), spans(where, where + window).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)
    return run


def _kept(window: int, with_text: bool):
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
                       + [("kept_text", pa.string()), ("repeats", pa.list_(pa.list_(pa.int64())))] * with_text)

    def run(batches):
        def rows():
            for batch in batches:
                for a, b, text, covered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                               c.byte_texts(batch.column(2)), batch.column(3).to_pylist()):
                    words = text.split()
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [x["lo"] for x in covered], 1)
                    np.add.at(edge, [x["hi"] + window for x in covered], -1)
                    keep = np.cumsum(edge)[:-1] == 0
                    kept = b" ".join([words[i] for i in np.flatnonzero(keep)])
                    row = a, b, int((~keep).sum()), hashlib.sha256(kept).hexdigest()
                    if with_text:
                        turn = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
                        row += kept.decode("utf-8", "replace"), turn.reshape(-1, 2).tolist()
                    yield row
        yield from c.rebatched(rows(), schema, 512)
    return run


def _plain(with_text: bool):
    schema = pa.schema([("row_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n_words", pa.int64()),
                        ("all_sha256", pa.string())] + [("all_text", pa.string())] * with_text)

    def run(batches):
        def rows():
            for batch in batches:
                for i, a, b, text in zip(*(batch.column(k).to_pylist() for k in range(3)), c.byte_texts(batch.column(3))):
                    words = text.split()
                    kept = b" ".join(words)
                    row = i, a, b, len(words), hashlib.sha256(kept).hexdigest()
                    yield row + (kept.decode("utf-8", "replace"),) if with_text else row
        yield from c.rebatched(rows(), schema, 512)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   seed: int = SEED, with_text: bool = True) -> DataFrame:
    """One row per input row: its id, ``n_words``, ``n_removed``, ``kept_sha256``
    (kept words joined by one space) and, ``with_text``, ``kept_text`` and
    ``repeats`` (removed word ranges [start, end)).

    A word goes when a window that covers it also starts anywhere else, in
    this document or another, as judged on the input.  Words are maximal runs
    without ASCII white space, unchanged; null or blank text has none.
    Repeated rows are documents that repeat each other; a null id is a row
    like any other.  Other columns are not read.
    """
    if not 1 <= seed <= window:
        raise ValueError("the seed must fit in the window")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")
    content = ["t1", "t2"]
    seeds = base.select("t1", "t2", "text").mapInArrow(
        _seeds(window, seed), "t1 long, t2 long, anchor long, content long, lo int, hi int")
    # anchors that occur more than once, and their runs: one row for each text (t1, t2) that has it, with its copies
    anchors = base.select("text").mapInArrow(_anchors(window, seed), "anchor long")
    often = anchors.groupBy("anchor").count().where("count > 1").select("anchor")
    met = c.stored(seeds.join(often, "anchor").groupBy("anchor", "content", "t1", "t2", "lo", "hi").agg(
        F.count("*").alias("copies")), "met")
    wanted = met.select(*content).distinct()
    texts = c.stored(base.groupBy(*content).agg(F.first("text").alias("text")).join(wanted, content), "texts")
    # equal runs: the repeat extends over all of them
    alike = met.groupBy("anchor", "content").agg(F.sum("copies").alias("total"), F.min(F.struct("t1", "t2", "lo", "hi")).alias("r"))
    alike = c.stored(alike, "alike")
    full = met.join(alike.where("total > 1").select("anchor", "content"), ["anchor", "content"]).select("t1", "t2", "lo", "hi")
    # anchors with runs of several contents, one of which occurs once: how far do they match?
    differ = alike.groupBy("anchor").agg(F.count("*").alias("n"), F.min("total").alias("least")).where("n > 1 and least = 1")
    work = alike.join(differ.select("anchor"), "anchor").select(
        "r.t1", "r.t2", F.struct("anchor", "total", (F.col("total") == 1).alias("open"), "r.lo", "r.hi").alias("w"))
    work = work.groupBy(*content).agg(F.collect_list("w").alias("work"))        # of one text
    windows = c.stored(texts.join(work, content).select("t1", "t2", "text", "work").mapInArrow(
        _windows(window), "t1 long, t2 long, anchor long, weight long, open boolean, at int, hash long"), "windows")
    twice = windows.groupBy("anchor", "hash").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor", "hash")
    partly = windows.where("open").join(twice, ["anchor", "hash"]).select("t1", "t2", F.col("at").alias("lo"), F.col("at").alias("hi"))
    covered = full.unionByName(partly).groupBy(*content).agg(F.collect_list(F.struct("lo", "hi")).alias("covered"))
    more = ", kept_text string, repeats array<array<long>>" if with_text else ""
    kept = texts.join(covered, content).select("t1", "t2", "text", "covered").mapInArrow(
        _kept(window, with_text), "t1 long, t2 long, n_removed long, kept_sha256 string" + more)
    plain = base.mapInArrow(_plain(with_text), "row_id long, t1 long, t2 long, n_words long, all_sha256 string"
                            + (", all_text string" if with_text else ""))
    out = plain.join(kept, content, "left")
    columns = [F.col("row_id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
               F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256")]
    if with_text:
        columns += [F.coalesce("kept_text", "all_text").alias("kept_text"),
                    F.coalesce("repeats", F.array().cast("array<array<long>>")).alias("repeats")]
    return out.select(*columns)
