"""Quality by nearest neighbours among labelled latent-semantic vectors.

Terms are word shapes, hashed words and signs of repetition; documents are
TF-IDF vectors over them (document frequencies from the whole corpus), reduced
by a truncated singular value decomposition of a bounded labelled sample.  The
labelled vectors (``SAMPLE`` x ``RANK`` floats) are sent to every task, which
computes the exact cosine of each of its documents with all of them, block by
block; the nearest vote, weighted by similarity.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import vectors as v

SAMPLE = 6000       # labelled documents at most
RANK = 48           # latent dimensions
NEIGHBOURS = 40
BLOCK = 128         # documents per product
SHAPES, WORDS, SIGNS = 2048, 1024, 24
SIZE = SHAPES + WORDS + SIGNS
THRESHOLD = 0.3


def _word(word: str) -> tuple[int, int]:
    return v.hashed(v.shape(word), SHAPES), SHAPES + crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS


class Counts:
    """Term counts of a text."""

    def __init__(self):
        self.words = v.WordFeatures(_word)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        at = self.words.numbers(words)
        out = self.words.counts(at, SIZE)
        signs = out[SHAPES + WORDS:]
        again = int((at[1:] == at[:-1]).sum())                          # words said again at once
        lines = [x for x in (text or "").split("\n") if x.strip()]
        signs[0], signs[1] = again, len(lines) - len(set(lines))        # lines said again
        if words:
            signs[2 + min(int(6 * len(np.unique(at)) / len(words)), 5)] = 1     # share of different words
            signs[8 + min(len(words).bit_length() // 2, 7)] = 1                 # length
            signs[16 + min(int(16 * again / len(words)), 7)] = 4                # share said again
        return out


def latent(x: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors (features x rank) by subspace iteration."""
    rank = max(1, min(rank, *x.shape))
    q = np.random.default_rng(seed).standard_normal((x.shape[0], min(rank + 16, x.shape[0]))).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(x @ (x.T @ q))
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 1e-6, norm, np.inf)


def vote(near: np.ndarray, y: np.ndarray, k: int, prior: float) -> np.ndarray:
    """Share of label 1 among the k most similar, weighted by similarity, drawn
    to the prior by one neighbour's weight; nothing similar: the prior."""
    k = min(k, near.shape[1])
    at = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.empty((len(near), 0), int)
    w = np.maximum(np.take_along_axis(near, at, axis=1), 0) ** 4
    return ((w * y[at]).sum(axis=1) + 0.1 * prior) / (w.sum(axis=1) + 0.1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        modulus: int = 5, held_out: int = 0, sample: int = SAMPLE) -> dict:
    """The model: inverse document frequencies, latent directions, labelled
    vectors, labels and prior, all of bounded size."""
    rows = v.labelled_sample(docs, labels, label, modulus, held_out, sample, id_col, text_col)

    def presence():
        count = Counts()
        return lambda texts: sum((count(t) > 0).astype(np.int64) for t in texts.to_pylist()) + np.zeros(SIZE, np.int64)

    n, df = v.document_frequencies(docs, text_col, presence, SIZE)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    return v.fitted(rows, lambda some: train(some, idf))


def train(rows: list[tuple[int, str, int]], idf: np.ndarray) -> dict:
    if not rows:
        return {"idf": idf, "basis": np.zeros((SIZE, 1), np.float32), "x": np.zeros((0, 1), np.float32),
                "y": np.zeros(0, np.float32), "prior": 0.5}
    count = Counts()
    x = np.concatenate([v.tf_idf(np.stack([count(t) for _, t, _ in rows[i:i + BLOCK]]), idf) for i in range(0, len(rows), BLOCK)])
    basis = latent(x, RANK)
    y = np.array([y for _, _, y in rows], np.float32)
    return {"idf": idf, "basis": basis, "x": unit(x @ basis), "y": y, "prior": float((y.sum() + 1) / (len(y) + 2))}


def scorer(model: dict):
    """A function from texts to scores."""
    count = Counts()
    labelled = np.ascontiguousarray(model["x"].T)

    def score(texts: list) -> np.ndarray:
        out = []
        for i in range(0, len(texts), BLOCK):
            x = v.tf_idf(np.stack([count(t) for t in texts[i:i + BLOCK]]), model["idf"])
            out.append(vote(unit(x @ model["basis"]) @ labelled, model["y"], NEIGHBOURS, model["prior"]))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)
    return score


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             modulus: int = 5, held_out: int = 0, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Each row's id with ``held_out`` (its fold gave no labels), ``score`` (0 to
    1, higher: label 1 likelier) and ``predicted``.  A null text scores as an
    empty one; without usable labels every score is 0.5.  A null id is not
    held out.  Repeated rows score alike; other columns are not read.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(fit(docs, labels, label, id_col, text_col, modulus, held_out, sample))
    def run(batches):
        score = scorer(model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(b.column(1).to_pylist()), pa.float64())], names=["id", "score"])

    told = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, score double")
    fold = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(modulus)) == held_out, F.lit(False))
    return told.select(F.col("id").alias(id_col), fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             modulus: int = 5, held_out: int = 0, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` predicts as label 1."""
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(fit(docs, labels, label, id_col, text_col, modulus, held_out, sample))
    at = docs.columns.index(text_col)

    def run(batches):
        score = scorer(model.value)
        for b in batches:
            keep = [score(b.column(at).slice(i, BLOCK).to_pylist()) >= threshold for i in range(0, b.num_rows, BLOCK)]
            yield b.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
