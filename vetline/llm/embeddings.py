"""Embedding near-duplicates by cells around sampled vectors.

Vectors are dealt to cells, each around one of the table's vectors (a pivot), and
stored once, in blocks of bounded size.  The blocks are then read in pairs, from where
they are stored, so what is shuffled and written grows with the table and not with
the pairs.

Of two vectors at the threshold, one lies within half their distance of the plane
between their two pivots, whichever cells they were dealt to.  So each vector visits
the cells whose planes are that near, and is compared with their members only.
Vectors are turned so that their coordinates go from the most to the least varying
(principal axes of the whole table; dot products stay).  For a cell and its visitors,
products over the leading coordinates come first; with the norms of what is left they
bound the cosine, and only pairs that can still reach the threshold go on to further
coordinates.  What is too near to the threshold for single precision is decided by
the cosine of the given components in double precision.

Equal vectors are one class, so copies are not compared.  A pair of blocks returns the
number of links of each class and one edge for each class it joins to others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline import session
from vetline.llm import common as c

THRESHOLD = 0.95
TILE = 1 << 17          # vectors in a block at most
TILE_BYTES = 12 << 20   # bytes of their components at most (one vector at least)
LEAST = 2048            # vectors in a block of a small table
PIVOT_BYTES = 16 << 20  # bytes of all pivots, about, at most
JOBS = 12               # over which the pairs of blocks are dealt
STEPS = (24, 40)        # coordinates after which pairs are given up
SLACK = 1e-4            # for single precision in the bounds
PAIRS = 1 << 18         # pairs carried on at once
PRODUCTS = 1 << 20      # products at once, with pivots
BOUNDS = 1 << 17        # bounds at once
TOGETHER = 6            # blocks that one task compares with another, of many

Pivots = dict[int, tuple[int, np.ndarray]]      # by dimension: the number of the first cell, and a row for each cell


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors (scaled first, so that squares stay finite)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _narrow(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components in single precision, and which of them that leaves as they are."""
    with np.errstate(over="ignore"):
        out = x.astype(np.float32)
    return out, out == x


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, lists of doubles, as bytes (in single precision where that loses nothing) and dimension."""
    for b in batches:
        lists = b.column(b.num_columns - 1)
        x, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)
        starts = np.append(0, ends[:-1])
        narrow, same = _narrow(x)
        if same.all():
            raw = narrow.tobytes()
            v = [raw[4 * s:4 * e] for s, e in zip(starts, ends)]
        else:
            v = [(narrow if same[s:e].all() else x)[s:e].tobytes() for s, e in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(v, pa.binary()), pa.array((ends - starts).astype(np.int32))],
                                         names=[*b.schema.names[:-1], "v", "d"])


def _matrix(parts: list[bytes], d: int) -> np.ndarray:
    """Vectors of ``d`` components from their bytes."""
    if all(len(x) == 4 * d for x in parts):
        return np.frombuffer(b"".join(parts), np.float32).reshape(-1, d)
    return np.stack([np.frombuffer(x, np.float32 if len(x) == 4 * d else np.float64) for x in parts]).astype(np.float64)


def _by_dimension(dims: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for d in np.unique(dims):
        yield int(d), np.flatnonzero(dims == d)


# ---- cells and blocks ----------------------------------------------------------
def _pivots(sample: DataFrame) -> Pivots:
    """Unit vectors of the sample (t1, t2, v, d), in the order of their hashes."""
    got = sample.dropDuplicates(["t1", "t2"]).toArrow().sort_by([("d", "ascending"), ("t1", "ascending"), ("t2", "ascending")])
    v, out, first = got.column("v").to_pylist(), {}, 0
    for d, at in _by_dimension(got.column("d").to_numpy()):
        out[d] = first, _unit(_matrix([v[i] for i in at], d).astype(np.float64)).astype(np.float32)
        first += len(at)
    return out


def _dealt(pivots: Pivots):
    """The cell of each vector: that of the pivot nearest by its cosine; a dimension
    without pivots is one cell, numbered by its negative."""
    def nearest(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        best, top = np.full(len(x), -np.inf, np.float32), np.zeros(len(x), np.int64)
        step = max(1, PRODUCTS // len(x))
        out = np.empty(len(x) * min(step, len(rows)), np.float32)
        for lo in range(0, len(rows), step):
            part = rows[lo:lo + step]
            s = np.matmul(x, part.T, out=out[:len(x) * len(part)].reshape(len(x), -1))
            at = s.argmax(axis=1)
            here = s[np.arange(len(x)), at]
            more = here > best
            best[more], top[more] = here[more], at[more] + lo
        return top

    def run(batches):
        for b in batches:
            dims, v = b.column("d").to_numpy(), b.column("v").to_pylist()
            cell = -dims.astype(np.int32)
            for d, at in _by_dimension(dims):
                if d in pivots:
                    first, rows = pivots[d]
                    cell[at] = first + nearest(_unit(_matrix([v[i] for i in at], d).astype(np.float64)).astype(np.float32), rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])
    return run


BLOCK = "t1 binary, t2 binary, low binary, told binary, copies binary, cell binary, d binary, v binary, wide boolean, block long"


def _blocks(tile: int):
    """Rows (t1, t2, low_id, copies, v, d, cell) as blocks of ``tile`` and ``TILE_BYTES``
    at most, in order of their cells; a row of a block's number times 2**32 and its place is its node."""
    def block(rows: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        cell = t.column("cell").to_numpy()
        order = np.lexsort((cell, t.column("d").to_numpy()))
        t, cell = t.take(pa.array(order)), cell[order]
        dims, v = t.column("d").to_numpy(), t.column("v").to_pylist()
        wide = sum(map(len, v)) > 4 * int(dims.sum())
        raw = b"".join(x if len(x) == 8 * d else np.frombuffer(x, np.float32).astype(np.float64).tobytes() for x, d in zip(v, dims.tolist())) if wide else b"".join(v)
        low = t.column("low_id").combine_chunks()
        one = [t.column("t1").to_numpy(), t.column("t2").to_numpy(), low.fill_null(0).to_numpy(), low.is_valid().to_numpy(zero_copy_only=False),
               t.column("copies").to_numpy(), cell.astype(np.int32), dims.astype(np.int32)]
        return pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in one), pa.array([raw], pa.binary()), pa.array([wide]),
                                           pa.array([number])], names=[x.split()[0] for x in BLOCK.split(", ")])

    def run(batches):
        number = TaskContext.get().partitionId() << 12
        held, n, size = [], 0, 0
        for b in batches:
            bytes_of = np.cumsum(np.fromiter(map(len, b.column("v").to_pylist()), np.int64, b.num_rows))
            at = 0
            while at < b.num_rows:
                before = int(bytes_of[at - 1]) if at else 0
                fits = min(tile - n, int(np.searchsorted(bytes_of, before + TILE_BYTES - size, side="right")) - at, b.num_rows - at)
                if fits <= 0 and held:
                    yield block(held, number)
                    number, held, n, size = number + 1, [], 0, 0
                    continue
                fits = max(fits, 1)
                held.append(b.slice(at, fits))
                n, size, at = n + fits, size + int(bytes_of[at + fits - 1]) - before, at + fits
        if held:
            yield block(held, number)
    return run


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks without their vectors."""
    for b in batches:
        for r in b.to_pylist():
            t1, t2, low, copies = (np.frombuffer(r[x], np.int64) for x in ("t1", "t2", "low", "copies"))
            known = np.frombuffer(r["told"], bool)
            yield pa.RecordBatch.from_arrays([pa.array((r["block"] << 32) + np.arange(len(t1))), pa.array(t1), pa.array(t2),
                                              pa.array(low, mask=~known), pa.array(copies)], names=["node", "t1", "t2", "low_id", "copies"])


def _vectors(d: pa.Array, v: pa.Array, wide: bool) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Of a block, by dimension: where its rows are, and its vectors."""
    dims, raw = np.frombuffer(d.as_buffer(), np.int32), np.frombuffer(v.as_buffer(), np.float64 if wide else np.float32)
    ends = np.cumsum(dims, dtype=np.int64)
    for k, at in _by_dimension(dims):       # rows are in order of their dimension
        lo, hi = int(at[0]), int(at[-1]) + 1
        yield k, slice(lo, hi), raw[ends[lo] - k:ends[hi - 1]].reshape(-1, k)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of coordinates, of the unit vectors of blocks, by dimension."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for i in range(b.num_rows):
            for d, _, x in _vectors(b.column("d")[i], b.column("v")[i], b.column("wide")[i].as_py()):
                for lo in range(0, len(x), max(1, PRODUCTS // d)):
                    u = _unit(x[lo:lo + max(1, PRODUCTS // d)].astype(np.float64))
                    sums[d] = sums.get(d, 0) + u.T @ u
    for d, s in sums.items():
        i, j = np.indices(s.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(i.ravel().astype(np.int32)),
                                          pa.array(j.ravel().astype(np.int32)), pa.array(s.ravel())], names=["d", "i", "j", "s"])


def _axes(blocks: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the principal axes, most varying first; d * d sums reach the driver."""
    sums = blocks.select("d", "v", "wide").mapInArrow(_moments, "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["d"], np.zeros((r["d"], r["d"])))[r["i"], r["j"]] = r["s"]
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for d, m in out.items()}


# ---- pairs of blocks -----------------------------------------------------------
class _Side:
    """The vectors of a block that have ``d`` components, turned, and their cells."""

    def __init__(self, x: np.ndarray, cell: np.ndarray, copies: np.ndarray, node: np.ndarray, axes: np.ndarray, first: int, pivots: np.ndarray):
        n, d = x.shape
        self.x, self.copies, self.node = x, copies, node
        self.turned = np.empty((n, d), np.float32)
        for lo in range(0, n, max(1, PRODUCTS // d)):
            part = slice(lo, lo + max(1, PRODUCTS // d))
            size = np.einsum("ij,ij->i", x[part], x[part])
            if (size > 1e-12).all() and (size < 1e12).all():        # squares are safe in single precision
                self.turned[part] = (x[part] @ axes.astype(x.dtype)) / np.sqrt(size)[:, None]
            else:
                self.turned[part] = _unit(x[part].astype(np.float64)) @ axes
        self.cuts = [*(s for s in STEPS if s < d), d]
        self.rests = [np.linalg.norm(self.turned[:, k:], axis=1) for k in self.cuts]
        # with the norm of the rest as one more coordinate, the leading product is the bound
        self.lead = np.column_stack([self.turned[:, :self.cuts[0]], self.rests[0]])
        cells, starts = np.unique(cell, return_index=True)
        self.starts = np.append(starts, n)
        self.of = np.repeat(np.arange(len(cells)), np.diff(self.starts))
        self.pivots = pivots[cells - first] if cells[0] >= 0 else np.zeros((1, d), np.float32)
        self.own = np.einsum("ij,ij->i", self.turned, self.pivots[self.of])

    def visits(self, other: _Side, reach: float) -> np.ndarray:
        """Which vectors (columns) are within ``reach`` of the planes between their pivots and those of the other's cells (rows)."""
        gap = np.sqrt(np.maximum(0, np.square(other.pivots).sum(1)[:, None] + np.square(self.pivots).sum(1)[None, :]
                                 - 2 * other.pivots @ self.pivots.T) + 1e-5)
        out = np.empty((len(other.pivots), len(self.x)), bool)
        low = self.own - np.float32(_slack(self.x.shape[1]))
        step = max(1, PRODUCTS // len(other.pivots))
        held = np.empty(len(other.pivots) * min(step, len(self.x)), np.float32)
        for k, (lo, hi) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            near = (reach * gap[:, k:k + 1]).astype(np.float32)
            for at in range(lo, hi, step):
                part = slice(at, min(at + step, hi))
                s = np.matmul(other.pivots, self.turned[part].T, out=held[:len(other.pivots) * (part.stop - at)].reshape(len(other.pivots), -1))
                s += near
                np.greater_equal(s, low[None, part], out=out[:, part])
        return out


def _slack(d: int) -> float:
    return max(SLACK, 2e-7 * d)


def _survivors(a: _Side, b: _Side, visits: np.ndarray, threshold: float, counted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of vectors of ``a`` and members of the cells of ``b`` that they visit, without those that ``counted`` tells."""
    d = a.x.shape[1]
    least = np.float32(threshold - _slack(d))
    held, over = np.empty(BOUNDS, np.float32), np.empty(BOUNDS + 8, bool)
    for k, (s, e) in enumerate(zip(b.starts[:-1], b.starts[1:])):
        guests, members, h = np.flatnonzero(visits[k]), b.lead[s:e].T, int(e - s)
        step = max(1, BOUNDS // h)
        if len(held) < h:
            held, over = np.empty(h, np.float32), np.empty(h + 8, bool)
        for lo in range(0, len(guests), step):
            some = guests[lo:lo + step]
            n = len(some) * h
            bound = held[:n]
            np.matmul(a.lead[some], members, out=bound.reshape(len(some), h))
            np.greater_equal(bound, least, out=over[:n])
            over[n:n + 8] = False
            # most are below, so eight are looked at as one
            hits = np.flatnonzero(over[:-(-n // 8) * 8].view(np.uint64))
            hits = (hits[:, None] * 8 + np.arange(8)).ravel()
            hits = hits[over[hits]]
            for at in range(0, len(hits), PAIRS):
                hit = hits[at:at + PAIRS]
                i, j = some[hit // h], s + hit % h
                new = ~counted(i, j)
                i, j, p = i[new], j[new], bound[hit[new]]
                p = p - a.rests[0][i] * b.rests[0][j]
                for m in range(1, len(a.cuts)):
                    cut = slice(a.cuts[m - 1], a.cuts[m])
                    p = p + np.einsum("ij,ij->i", a.turned[i, cut], b.turned[j, cut])
                    keep = p + a.rests[m][i] * b.rests[m][j] >= least
                    i, j, p = i[keep], j[keep], p[keep]
                sure = p >= threshold + _slack(d)
                doubt = np.flatnonzero(~sure)
                if len(doubt):
                    u, w = (_unit(x.astype(np.float64)) for x in (a.x[i[doubt]], b.x[j[doubt]]))
                    sure[doubt] = np.einsum("ij,ij->i", u, w) >= threshold
                yield i[sure], j[sure]


def _meet(axes: dict[int, np.ndarray], pivots: Pivots, threshold: float):
    reach = ((2 - 2 * threshold) ** 0.5 + 1e-9) / 2      # half the distance of unit vectors at the threshold

    def sides(b: pa.RecordBatch, i: int, x: str) -> dict[int, _Side]:
        cell, copies = (np.frombuffer(b.column(x + y)[i].as_buffer(), t) for y, t in (("cell", np.int32), ("copies", np.int64)))
        node = (b.column(x + "block")[i].as_py() << 32) + np.arange(len(cell))
        return {d: _Side(v, cell[at], copies[at], node[at], axes[d], *pivots.get(d, (0, None)))
                for d, at, v in _vectors(b.column(x + "d")[i], b.column(x + "v")[i], b.column(x + "wide")[i].as_py())}

    def compared(a: _Side, b: _Side) -> Iterator[pa.RecordBatch]:
        there = a.visits(b, reach)
        # a pair found from both sides counts once
        runs = [(a, b, there, lambda i, j: (i == j) | (i > j) & there[a.of[i], j])] if a is b else [
            (a, b, there, lambda i, j: np.zeros(len(i), bool)), (b, a, b.visits(a, reach), lambda i, j: there[b.of[i], j])]
        edges, held = [], 0
        links = {id(x): np.zeros(len(x.x), np.int64) for x in (a, b)}
        for x, y, visits, counted in runs:
            for i, j in _survivors(x, y, visits, threshold, counted):
                np.add.at(links[id(x)], i, y.copies[j])
                np.add.at(links[id(y)], j, x.copies[i])
                edges.append(np.stack([x.node[i], y.node[j]]))
                held += len(i)
                if held > 4 * PAIRS:
                    edges, held = [_joined(edges)], 0
        for x in {id(x): x for x in (a, b)}.values():
            some = np.flatnonzero(links[id(x)])
            yield x.node[some], x.node[some], links[id(x)][some]
        if edges:
            low, high = _joined(edges)
            yield low, high, np.zeros(len(low), np.int64)

    def run(batches):
        last, left = None, {}
        for b in batches:
            for i in range(b.num_rows):
                p, q = b.column("a_block")[i].as_py(), b.column("b_block")[i].as_py()
                if p != last:
                    last, left = p, sides(b, i, "a_")
                right = left if p == q else sides(b, i, "b_")
                for d in left.keys() & right.keys():
                    for cols in compared(left[d], right[d]):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["a", "b", "links"])
    return run


def _joined(edges: list[np.ndarray]) -> np.ndarray:
    """One edge for each node that the edges join to a smaller one."""
    a, b = np.concatenate(edges, axis=1)
    got = next(iter(c._contract([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])])))
    return np.stack([got.column(0).to_numpy(), got.column(1).to_numpy()])


@contextmanager
def _one_by_one(spark: SparkSession) -> Iterator[None]:
    """Each block is a split of its own, and each pair a batch."""
    conf = {"spark.sql.files.maxPartitionBytes": str(4 * TILE_BYTES), "spark.sql.files.openCostInBytes": str(4 * TILE_BYTES),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _found(blocks: DataFrame, kernel) -> DataFrame:
    """What the kernel returns for all pairs of blocks, also of one with itself.  Pairs
    are read from the stored blocks: no block is shuffled."""
    spark, schema = blocks.sparkSession, "a long, b long, links long"
    path = session.scratch_path(spark, "links")
    spark.createDataFrame([], schema).write.parquet(path)
    numbers = sorted(r["block"] for r in blocks.select("block").distinct().collect())
    size = max(16, -(-len(numbers) // JOBS))
    read = ("block", "cell", "copies", "d", "v", "wide")
    with _one_by_one(spark):
        for at in range(0, len(numbers), size):
            here = numbers[at:at + size]
            left = blocks.where(F.col("block").between(here[0], here[-1])).select(*(F.col(x).alias("a_" + x) for x in read))
            right = blocks.where(F.col("block") >= here[0]).select(*(F.col(x).alias("b_" + x) for x in read))
            if len(numbers) > 8 * TOGETHER:
                right = right.coalesce(-(-(len(numbers) - at) // TOGETHER))
            pairs = left.hint("shuffle_replicate_nl").join(right, F.col("a_block") <= F.col("b_block"))
            pairs.mapInArrow(kernel, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    tile: int = TILE) -> DataFrame:
    """One row per input row: id, ``n_links`` (rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (id = component_id).

    Rows are linked when their cosine is at least ``threshold``.  A vector that
    is null, empty, zero or holds a null or non-finite component links with
    nothing, nor do vectors of different dimensions.  Repeated rows are rows
    with equal vectors.  A row with a null id links as any row does; its
    component is the smallest id linked, null when there is none, and it is
    not ``kept``.  Other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be a cosine above 0")
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    good = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.select("id", F.when(good, F.col("v")).alias("v")).select(
        "id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("t1"), F.xxhash64(F.lit(7), "v").alias("t2"))
    spark, kinds = table.sparkSession, "t1 long, t2 long"

    def packed(some):
        return some.where("t1 is not null").select("id", "t1", "t2", "v").mapInArrow(_packed, f"id long, {kinds}, v binary, d int")
    n = table.count()
    d = max([1, *(r["d"] for r in rows.where("t1 is not null").select(F.size("v").alias("d")).limit(100).collect())])
    # cells: as many as make dealing about as dear as comparing; pivots: those of the table's classes that a hash tells
    cells = max(1, min(round(n ** (2 / 3) / 3), PIVOT_BYTES // (4 * d)))
    pivots = _pivots(packed(rows.where(F.pmod("t1", F.lit(max(1, round(n / cells)))) == 0)).drop("id"))
    classes = packed(rows).groupBy("t1", "t2").agg(F.min("id").alias("low_id"), F.count("*").alias("copies"), F.first("v").alias("v"), F.first("d").alias("d"))
    dealt = classes.mapInArrow(_dealt(pivots), f"{kinds}, low_id long, copies long, v binary, d int, cell int")
    most = max(1, min(tile * 3 // 4, max(LEAST, n // 8), TILE_BYTES * 3 // (16 * d)))
    parts = max(1, -(-n // most))
    path = session.scratch_path(spark, "blocks")
    dealt.repartition(parts, "cell").mapInArrow(_blocks(tile), BLOCK).write.partitionBy("block").option("compression", "none").parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)
    axes = _axes(blocks)
    found = _found(blocks, _meet(axes, {d: (first, (x @ axes[d]).astype(np.float32)) for d, (first, x) in pivots.items() if d in axes}, threshold))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    comp = c.components(found.where("a <> b").select("a", "b"))
    nodes = blocks.select("block", "t1", "t2", "low", "told", "copies").mapInArrow(_nodes, f"node long, {kinds}, low_id long, copies long")
    of = nodes.join(comp, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = of.groupBy("component").agg(F.min("low_id").alias("component_id"))
    told = of.join(low, "component").select("t1", "t2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("id", "t1", "t2").join(told, ["t1", "t2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
