"""Shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import session

# the white space that separates words
ASCII_SPACE = " \t\n\x0b\f\r"


# Rows of an Arrow batch at most: texts can be long, and a batch is held by the executor and its Python worker at once.
ARROW_ROWS = 1000


def configure(spark: SparkSession) -> SparkSession:
    """The package's session settings, and bounded Arrow batches."""
    session.configure(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the cluster's shared folder and read it
    back: cuts the lineage, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = session.scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null: empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every k consecutive word hashes, in order (len(h) - k + 1)."""
    n = len(h) - k + 1
    out = np.full(max(n, 0), np.uint64(0x9E3779B97F4A7C15 + seed))
    for i in range(k if n > 0 else 0):
        out = mixed(out * np.uint64(0x100000001B3) + h[i:i + n])
    return out


_R = np.random.default_rng(11)
_VALUES = _R.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: tuple[np.ndarray, ...] = (np.ones(1, np.uint64),) * 2


def powers(n: int) -> tuple[np.ndarray, ...]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n.  Only
    the longest are kept, which begin with all shorter ones: a Python worker lives on
    after its task."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS = ()        # the old go before the new are made
        _POWERS = tuple(np.append(np.uint64(1), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64))
                        for b in (_BASE, pow(_BASE, -1, 2**64)))
    return _POWERS


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _VALUES[buf]


class Spans:
    """Hashes of any spans of a sequence of hashes, by sums of their powers."""

    def __init__(self, h: np.ndarray):
        up, self.down = powers(len(h) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(h * up[:len(h)], dtype=np.uint64))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(x) for x in ASCII_SPACE]] = True


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and how many each has."""
    raw = b" ".join(texts) + b" "
    buf = np.frombuffer(raw, np.uint8)
    space = _IS_SPACE[buf]
    edge = np.flatnonzero(np.append(~space[0], space[1:] != space[:-1]))
    starts, ends = edge[0::2], edge[1::2]           # the last sign is a space, so every word ends
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    n = np.diff(np.append(0, np.searchsorted(starts, text_ends)))
    return Spans(byte_values(buf))(starts, ends), n


def id128(parts: bytes) -> bytes:
    return xxhash.xxh3_128_digest(parts)


def rebatched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows from tuples."""
    rows = iter(rows)
    while chunk := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*chunk), schema)], schema=schema)


# ---- connected components ------------------------------------------------------
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same components with one edge per node of each batch (to the
    smallest node of its component within the batch)."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = inverse[:len(a)], inverse[len(a):]
        low = np.arange(len(nodes))
        while True:
            least = np.minimum(low[x], low[y])
            new = low.copy()
            np.minimum.at(new, low[x], least)
            np.minimum.at(new, low[y], least)
            new = new[new]
            if (new == low).all():
                break
            low = new
        keep = low != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low[keep]]), pa.array(nodes[keep])], names=["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)`` (long ids):
    the smallest node reachable.

    Alternating large-star and small-star rounds, until every edge leads from the
    smallest node of its component.  Edges are contracted per
    Arrow batch first, minima are pre-aggregated before their shuffle, and
    the joins on a node are ordinary sort-merge joins that AQE splits when
    one node holds many edges.  Each star is written to the shared folder, so that
    no plan holds another's: the driver keeps something of every task and plan.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        if large:
            moved = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            moved = both.where("v < u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
                low.where("m < u").select(F.col("m").alias("a"), F.col("u").alias("b")))
        return stored(moved.where("a <> b").distinct(), "edges")

    def settled(e: DataFrame) -> bool:
        """Whether no node ends two edges, or ends one and begins another (edges are distinct, a < b)."""
        ends = e.select(F.col("b").alias("u"), F.lit(1).alias("end")).unionByName(e.select(F.col("a").alias("u"), F.lit(0).alias("end")))
        return not ends.groupBy("u").agg(F.sum("end").alias("n"), F.min("end").alias("low")).select(
            F.count_if(F.expr("n > 1 or n = 1 and low = 0"))).first()[0]

    now = stored(edges.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
                 .where("a <> b").mapInArrow(_contract, "a long, b long").distinct(), "edges")
    for _ in range(max_rounds):
        if settled(now):
            break
        now = star(star(now, True), False)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
