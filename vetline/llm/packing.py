"""Packing of tokenised documents into fixed-length sequences by linear grouping.

1. Every document becomes token ids plus an end id; longer than the capacity,
   it is cut into full pieces and a rest.
2. Pieces longer than ``small`` are sorted by length and cut into groups of equal
   cardinality; each length counts as the largest of its group.
3. Over those few sizes, configurations (which sizes share a sequence) are
   chosen on the driver from group counts alone: at most ``capacity`` lengths.
4. Actual pieces take the configurations' places by their rank in the group.
5. The short pieces are best-fitted into what is left, in shards of bounded size.

What reaches the driver is the histogram of lengths (at most ``capacity`` rows).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetline.llm import common as c
from vetline.llm.token_ids import TokenIds

CAPACITY = 4096
SMALL = 1024            # longer pieces are packed by configurations
GROUPS = 256            # groups of equal cardinality
SHARD_PIECES = 60_000   # pieces best-fitted together


def _tokenised(path: str, capacity: int, end_id: int, with_ids: bool):
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        ids_of = TokenIds(path)

        def rows():
            for batch in batches:
                for key, own in zip(batch.column(0).to_pylist(), ids_of(batch.column(1).to_pylist())):
                    ids = np.append(own, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start:start + capacity]
                        row = key, k, start, len(piece), zlib.crc32(piece.tobytes())
                        yield row + (piece.astype(np.int32),) if with_ids else row
        yield from c.rebatched(rows(), schema, 1024 if with_ids else 8192)
    return run


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, with their ids if asked for."""
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        _tokenised(tokenizer, capacity, end_id, with_ids), schema).withColumnRenamed("id", id_col)


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """``({size index: how often}, how many sequences)``: the largest size left
    opens a configuration, the rest is filled as full as the counts left
    allow (subset sums over the sizes), and it is used as often as they last."""
    left = list(counts)
    out = []
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    while any(left):
        first = next(i for i in order if left[i])
        room = capacity - sizes[first]
        # reach[s] = (previous sum, size index) of a fullest filling
        reach: dict[int, tuple[int, int]] = {0: (0, -1)}
        for i in order:
            free = left[i] - (i == first)
            if free <= 0 or sizes[i] > room:
                continue
            for s in sorted(reach):
                for k in range(1, free + 1):
                    if (t := s + k * sizes[i]) > room or t in reach:
                        break
                    reach[t] = (t - sizes[i], i)
            if room in reach:
                break
        s, pattern = max(reach), {first: 1}
        while s:
            s, i = reach[s]
            pattern[i] = pattern.get(i, 0) + 1
        times = max(1, min(left[i] // n for i, n in pattern.items()))
        for i, n in pattern.items():
            left[i] -= n * times
        out.append((pattern, times))
    return out


def best_fit(sizes, bins, room, capacity: int, new_bin):
    """Longest first, each into the fullest sequence that takes it; ``bins`` and
    ``room`` are parallel, ``new_bin()`` names a further one."""
    by_room: dict[int, list] = {}
    for b, r in zip(bins, room):
        by_room.setdefault(int(r), []).append(b)
    rooms, out = sorted(by_room), [None] * len(sizes)
    for i in np.argsort(-np.asarray(sizes, dtype=np.int64), kind="stable"):
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            r = rooms[at]
            b = by_room[r].pop()
            if not by_room[r]:
                del by_room[r], rooms[at]
        else:
            r, b = capacity, new_bin()
        out[i] = b
        if r > size:
            if r - size not in by_room:
                by_room[r - size] = []
                insort(rooms, r - size)
            by_room[r - size].append(b)
    return out


def place(cut: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS,
          shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``cut`` (a stored table with ``length`` and a unique long ``piece_key``)
    with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    if not (0 < small <= capacity):
        raise ValueError("small must be between 1 and the capacity")
    hist = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}     # at most ``capacity`` rows
    n_large = sum(n for s, n in hist.items() if s > small)
    n_all = sum(hist.values())
    shards = max(1, -(-n_all // shard_pieces))
    # groups of equal cardinality over the lengths, longest first
    each = max(1, -(-n_large // groups))
    at, before, tops = 0, [], []
    for s in sorted((s for s in hist if s > small), reverse=True):
        before.append((s, at))
        first_group = -(-at // each)
        tops += [s] * (-(-(at + hist[s]) // each) - first_group)
        at += hist[s]
    counts = [each] * (len(tops) - 1) + [n_large - each * (len(tops) - 1)] if tops else []
    # groups of one size are one size to the configurations
    places, base = [], 0
    by_size: dict[int, list[int]] = {}
    for g, s in enumerate(tops):
        by_size.setdefault(s, []).append(g)
    sizes = sorted(by_size, reverse=True)
    starts = {s: each * by_size[s][0] for s in sizes}
    used = {s: 0 for s in sizes}
    for pattern, times in configurations(sizes, [sum(counts[g] for g in by_size[s]) for s in sizes], capacity):
        for i, n in pattern.items():
            s = sizes[i]
            lo = starts[s] + used[s]
            places.append((lo, lo + n * times - 1, times, base))
            used[s] += n * times
        base += times
    salt = F.pmod(F.xxhash64("piece_key"), F.lit(shards)).cast("int")
    keyed = cut.select("piece_key", "length", salt.alias("salt"))
    large, rest = keyed.where(F.col("length") > small), keyed.where(F.col("length") <= small)
    placed = None
    if n_large:
        # position among all large pieces, longest first: counts of (length, salt) before, and a number within
        run = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
        cells = large.groupBy("length", "salt").count().withColumn("cell_at", F.coalesce(F.sum("count").over(run), F.lit(0)))
        lengths = spark.createDataFrame(before, "length long, length_at long")     # at most ``capacity`` rows
        cells = cells.join(F.broadcast(lengths), "length").select("length", "salt", (F.col("cell_at") + F.col("length_at")).alias("base"))
        numbered = large.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("piece_key")) - 1)
        ranked = numbered.join(cells, ["length", "salt"]).select("piece_key", "length", (F.col("base") + F.col("k")).alias("rank"))
        placed = ranked.mapInArrow(_look_up(places), "piece_key long, length long, bin long")
        placed = c.stored(placed, "placed")
    piece_bins = placed
    if n_all > n_large:
        none = spark.createDataFrame([], "piece_key long, length long, bin long")
        rooms = (placed if placed is not None else none).groupBy("bin").agg((capacity - F.sum("length")).alias("room")).where(
            "room > 0").select(F.pmod(F.xxhash64("bin"), F.lit(shards)).cast("int").alias("salt"), "bin",
                               F.col("room").alias("size"), F.lit(None).cast("long").alias("piece_key"))
        todo = rest.select("salt", F.lit(None).cast("long").alias("bin"), F.col("length").alias("size"), "piece_key")
        fitted = rooms.unionByName(todo).groupBy("salt").applyInArrow(
            _fit(capacity, base, shards), "piece_key long, length long, bin long")
        piece_bins = fitted if placed is None else placed.unionByName(fitted)
    if piece_bins is None:
        piece_bins = spark.createDataFrame([], "piece_key long, length long, bin long")
    inside = Window.partitionBy("bin").orderBy(F.desc("length"), "piece_key")
    spots = piece_bins.select("piece_key", F.col("bin").alias("sequence_id"),
                              (F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"))
    return cut.join(spots, "piece_key").drop("piece_key")


def _look_up(places):
    """Sequence of each rank: which configuration's range it is in (the table
    of ranges is bounded by groups and capacity, whatever the input)."""
    lo, _, times, base = (np.array(x, np.int64) for x in zip(*sorted(places)))

    def run(batches):
        for b in batches:
            rank = b.column(2).to_numpy()
            at = np.searchsorted(lo, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(base[at] + (rank - lo[at]) % times[at])], names=["piece_key", "length", "bin"])
    return run


def _fit(capacity: int, base: int, shards: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        piece = table.column("piece_key")
        some, rooms = table.filter(piece.is_valid()).sort_by("piece_key"), table.filter(piece.is_null()).sort_by("bin")
        made = iter(range(base + key[0].as_py(), 2**62, shards))
        bins = best_fit(some.column("size").to_numpy(), rooms.column("bin").to_pylist(), rooms.column("size").to_pylist(),
                        capacity, lambda: next(made))
        return pa.table({"piece_key": some.column("piece_key"), "length": some.column("size"), "bin": pa.array(bins, pa.int64())})
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = 1, with_ids: bool = True, **options) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, (``ids``,)
    ``sequence_id`` and ``offset``; the pieces of a sequence fill it from 0
    without gaps.  A null or empty text is its end id alone.  Every row is a
    document of its own, whatever its id (null and repeated ones included);
    other columns are not read.
    """
    cut = c.stored(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids)
                   .withColumn("piece_key", F.monotonically_increasing_id()), "pieces")
    return place(cut, capacity, **options)
