"""MinHash near-duplicate detection with tensored bands.

A plain scheme with T tables of r values each computes T * r minhashes per
document.  Here two collections A and B of ``m`` sub-keys (``k`` minhashes each)
are computed, and table (i, j) is keyed by the pair (A_i, B_j): m * m tables of
2k values from only 2 * m * k minhashes.  A pair of documents with similarity s
shares a table unless every A_i or every B_j differs, so it is missed with
probability at most 2 * (1 - s**k) ** m: 2e-5 at s = 0.85 with k = 2, m = 9.

Documents with equal shingle sets are one class; only classes meet in tables.
Every candidate is confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

SUB_KEYS = 9
SUB_SIZE = 2
SKETCH_BITS = 128
BLOCK = 1024            # documents of a bucket compared in one task with as many others
SKETCH_DIFFER = 28      # at similarity 0.85 a pair differs in 9.6 +- 3 of the 128 bits


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; fewer
    words: the whole sequence as one; no words: empty."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = c.word_hashes(words)
    return np.unique(c.gram_hashes(h, width) if len(words) >= width else c.gram_hashes(h, len(words), seed=len(words)))


class Signer:
    """Sub-keys and a one-bit sketch of a shingle set."""

    def __init__(self, m: int, k: int):
        self.m, self.k = m, k
        r = np.random.default_rng(20240517)
        n = max(2 * m * k, SKETCH_BITS)
        self.mult = r.integers(1, 2**63, size=(n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = r.integers(0, 2**63, size=(n, 1), dtype=np.uint64)

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = np.full(len(self.mult), np.uint64(2**64 - 1))
        for i in range(0, len(s), 512):     # blocks that stay in the cache
            x = s[None, i:i + 512] * self.mult
            x += self.add
            np.minimum(low, x.min(axis=1), out=low)
        parts = c.mixed(low[:2 * self.m * self.k]).reshape(2 * self.m, self.k)
        key = np.arange(2 * self.m, dtype=np.uint64) + np.uint64(1)
        for j in range(self.k):
            key = c.mixed(key * np.uint64(0x100000001B3) + parts[:, j])
        bits = (c.mixed(low[:SKETCH_BITS]) & np.uint64(1)).astype(np.uint8)
        return key[:self.m], key[self.m:], np.packbits(bits).view(np.int64)


def _signed(shingle: int, m: int, k: int):
    schema = pa.schema([("row_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n", pa.int64()),
                        ("set_id", pa.binary()), ("s1", pa.int64()), ("s2", pa.int64()), ("sub", pa.list_(pa.int64()))])

    def run(batches):
        sign = Signer(m, k)

        def rows():
            for batch in batches:
                for row, t1, t2, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), c.byte_texts(batch.column(3))):
                    s = shingle_set(text.lower().split(), shingle)      # bytes.lower: A-Z only
                    if not len(s):
                        yield row, t1, t2, 0, None, 0, 0, []
                        continue
                    a, b, sk = sign(s)
                    yield (row, t1, t2, len(s), c.id128(s.tobytes()), int(sk[0]), int(sk[1]),
                           np.concatenate([a, b]).view(np.int64))
        yield from c.rebatched(rows(), schema, 1024)
    return run


def _confirm(shingle: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last: dict[int, np.ndarray] = {}

        def grams(node, text):
            if node not in last:
                if len(last) >= 64:
                    last.clear()
                last[node] = shingle_set(text.lower().split(), shingle)
            return last[node]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i, j, x, y in zip(a, b, c.byte_texts(batch.column(2)), c.byte_texts(batch.column(3))):
                x, y = grams(i, x), grams(j, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], schema=schema)
    return run


def _grams(shingle: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.lower().split(), shingle) for t in c.byte_texts(batch.column(1))]
            for i in range(0, len(sets), 200):
                some = sets[i:i + 200]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(some).view(np.int64)),
                     pa.array(np.repeat(batch.column(0).to_numpy()[i:i + 200], [len(x) for x in some]))], names=["gram", "node"])
    return run


def _mixed_buckets(met: DataFrame, comp: DataFrame) -> DataFrame:
    """``(key, node, comp)`` of the buckets with nodes of several components."""
    labelled = met.select("key", "node").join(comp, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("comp"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    return labelled.join(mixed, "key")


def _possible(percent: int):
    """Whether shingles of their own leave a pair room for the threshold:
    |a & b| <= min(n - u) and <= (n_a + n_b - u_a - u_b) / 2."""
    n = F.col("a_n") + F.col("b_n")
    most = F.least(2 * (F.col("a_n") - F.col("a_u")), 2 * (F.col("b_n") - F.col("b_u")), n - F.col("a_u") - F.col("b_u"))
    return most * (100 + percent) >= 2 * percent * n


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle_set(t.lower().split(), shingle).tobytes() for t in c.byte_texts(batch.column(1))])],
                names=["node", "grams"])
    return run


def _met(percent: int):
    """Links that join different components, between the two blocks of a
    bucket of the i-th sub-key; pairs that share an earlier one met there."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, _, p, q = (k.as_py() for k in key)
        own, node, comp, n, u = (table.column(x).to_numpy() for x in ("own", "node", "comp", "n", "u"))
        order = np.argsort(node, kind="stable")
        sketch = np.stack([table.column(x).to_numpy().view(np.uint64) for x in ("s1", "s2")], axis=1)
        earlier = np.array(table.column("sub").to_pylist(), np.int64)[:, :i]
        grams = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        left, right = order[own[order] == p], order[own[order] == q]
        comp, links = comp.copy(), []
        for at, x in enumerate(left):
            ys = right[at + 1:] if p == q else right
            ys = ys[(comp[ys] != comp[x]) & (100 * np.minimum(n[x], n[ys]) >= percent * np.maximum(n[x], n[ys]))]
            total = n[x] + n[ys]
            most = np.minimum(np.minimum(2 * (n[x] - u[x]), 2 * (n[ys] - u[ys])), total - u[x] - u[ys])
            ys = ys[most * (100 + percent) >= 2 * percent * total]
            ys = ys[np.bitwise_count(sketch[ys] ^ sketch[x]).sum(axis=1) <= SKETCH_DIFFER]
            ys = ys[~(earlier[ys] == earlier[x]).any(axis=1)]
            for y in ys:
                if comp[y] == comp[x]:
                    continue
                both = len(np.intersect1d(grams[x], grams[y], assume_unique=True))
                if 100 * both >= percent * (n[x] + n[y] - both):
                    links.append((node[x], node[y]))
                    comp[comp == comp[y]] = comp[x]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _shared_subs(nodes: DataFrame) -> DataFrame:
    """``node`` and ``sub``, its sub-keys (``i``, ``s``) that other nodes have too.
    Nodes that share a key of the tensor product share both its sub-keys, so the
    others, most of them, are left out before the product."""
    subs = nodes.select("node", F.posexplode("sub").alias("i", "s"))
    shared = subs.groupBy("i", "s").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("i", "s")
    return subs.join(shared, ["i", "s"]).groupBy("node").agg(F.collect_list(F.struct("i", "s")).alias("sub"))


def _keys(subs: DataFrame, m: int) -> DataFrame:
    """The tensor product: one ``key`` for each pair of a node's sub-keys of A and B."""
    a, b = (F.explode(F.expr(f"filter(sub, x -> x.i {of} {m})")).alias(name) for of, name in (("<", "a"), (">=", "b")))
    return subs.select("node", "sub", a).select("node", "a", b).select(
        "node", F.xxhash64(F.col("a.i") * m + F.col("b.i") - m, "a.s", "b.s").alias("key"))


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, sub_keys: int, sub_size: int) -> tuple[DataFrame, DataFrame]:
    """The rows (``row_id``, hashes ``t1`` and ``t2`` of the text, ``n``
    shingles, ``set_id``) and the component (a number) of each ``set_id``.

    Three rounds find the links that components need.  Every member of a
    table's bucket is compared with the bucket's smallest member; where several
    components remain, with the member closest to all; then members of
    different components with each other, unless set sizes, sketches or
    shingles that only one document has rule the pair out.  So a group of copies
    is not expanded into its pairs, and no pair of a shared bucket that could
    join two components is left out.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")
    signed = c.stored(base.mapInArrow(
        _signed(shingle, sub_keys, sub_size),
        "row_id long, t1 long, t2 long, n long, set_id binary, s1 long, s2 long, sub array<long>"), "signed")
    # one node per distinct set, numbered when written
    nodes = c.stored(signed.where("n > 0").groupBy("set_id").agg(
        F.min("row_id").alias("low_id"), F.first(F.struct("n", "s1", "s2", "t1", "t2", "sub")).alias("x"))
        .select(F.monotonically_increasing_id().alias("node"), "set_id", "low_id", "x.*"), "nodes")
    m = sub_keys
    keys = _keys(c.stored(_shared_subs(nodes), "shared_subs"), m)
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    met = c.stored(keys.join(shared.select("key", "low"), "key"), "met")
    wanted = nodes.join(met.select("node").distinct(), "node").select("node", "t1", "t2")
    texts = c.stored(base.select("t1", "t2", "text").join(wanted, ["t1", "t2"]).dropDuplicates(["node"])
                     .select("node", "text"), "texts")
    about = nodes.select("node", "n", "s1", "s2")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select([F.col(x).alias(name if x == "node" else f"{name}_{x}") for x in df.columns])

    def likely():
        """Set sizes and sketches that allow the threshold."""
        differ = F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1"))) + F.bit_count(F.col("a_s2").bitwiseXOR(F.col("b_s2")))
        return (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & (differ <= SKETCH_DIFFER)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        return c.stored(pairs.join(side(texts, "a"), "a").join(side(texts, "b"), "b")
                        .select("a", "b", "a_text", "b_text")
                        .mapInArrow(_confirm(shingle, percent), "a long, b long"), name)

    def joined(comp: DataFrame) -> DataFrame:
        """Components found so far, as links to their smallest nodes: later rounds go on from there."""
        return comp.select(F.col("component").alias("a"), F.col("node").alias("b"))

    stars = met.where("low < node").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    stars = c.stored(stars.join(side(about, "a"), "a").join(side(about, "b"), "b").where(likely()).select("a", "b"), "stars")
    first = c.components(confirmed(stars, "links"))
    # Second round, in buckets that still hold several components.  Shingles that no other document there has
    # count towards the difference of any pair, so the member with the fewest of its own is the one closest to
    # whatever the others copy, and a pair with too many between them cannot be linked.
    left = c.stored(_mixed_buckets(met, first).join(about, "node"), "left")
    own = texts.join(left.select("node").distinct(), "node").mapInArrow(_grams(shingle), "gram long, node long").groupBy(
        "gram").agg(F.count("*").alias("df"), F.min("node").alias("node")).where("df = 1").groupBy("node").agg(
        F.count("*").alias("u"))
    left = left.join(own, "node", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    left = c.stored(left.where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")), "left_own")
    center = left.groupBy("key").agg(F.min(F.struct("u", "node")).alias("c")).select("key", F.col("c.node").alias("c"))
    again = left.join(center, "key").select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).where(
        "a < b").distinct().join(stars, ["a", "b"], "left_anti")
    facts = left.select("node", "n", "s1", "s2", "u").distinct()
    again = c.stored(again.join(side(facts, "a"), "a").join(side(facts, "b"), "b").where(likely() & _possible(percent))
                     .select("a", "b"), "again")
    second = c.components(joined(first).unionByName(confirmed(again, "again_links")))
    # Last, all pairs of different components that share a sub-key of A (so all that share a table): blocks of
    # such a bucket meet in tasks of bounded size, which return one link for each two components they join.
    rest = _mixed_buckets(left.select("key", "node"), second).select("node", "comp").distinct().join(facts, "node")
    rest = c.stored(rest.join(nodes.select("node", "sub"), "node").join(
        texts.mapInArrow(_sets(shingle), "node long, grams binary"), "node"), "rest")
    spread = rest.select("*", F.posexplode(F.slice("sub", 1, m)).alias("i", "a"))
    sizes = spread.groupBy("i", "a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
                                         F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").drop("x", "y")
    dealt = spread.join(sizes, ["i", "a"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "i", "a", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "comp", "n", "u",
        "s1", "s2", "sub", "grams")
    cross = c.stored(dealt.groupBy("i", "a", "p", "q").applyInArrow(_met(percent), "a long, b long"), "cross_links")
    comp = c.components(joined(second).unionByName(cross))
    return signed, nodes.join(comp, "node", "left").select("set_id", "low_id", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    percent: int = 85, sub_keys: int = SUB_KEYS, sub_size: int = SUB_SIZE) -> DataFrame:
    """One row per input row: its id, ``n_shingles``, ``component_id`` (smallest
    id reachable over links) and ``kept`` (id = component_id).

    Two documents are linked when 100 * |intersection| >= percent * |union| of
    their sets of ``shingle``-word shingles (A-Z lower-cased).  A document with
    fewer words is one shingle; without words or text it is linked with
    nothing.  Repeated rows are documents with equal sets.  A row with a null
    id links others as any row does; its component is the smallest id linked,
    null when there is none, and it is not ``kept``.  Other columns of
    ``docs`` are not read.
    """
    signed, reached = _linked(docs, id_col, text_col, shingle, percent, sub_keys, sub_size)
    lowest = reached.groupBy("component").agg(F.min("low_id").alias("component_id"))
    final = reached.join(lowest, "component").select("set_id", "component_id")
    out = signed.select("row_id", "n", "set_id").join(final, "set_id", "left")
    component = F.when(F.col("n") == 0, F.col("row_id")).otherwise(F.col("component_id"))
    return out.select(F.col("row_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("row_id") == component, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                percent: int = 85, sub_keys: int = SUB_KEYS, sub_size: int = SUB_SIZE) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the
    smallest id (null last; of one id, the text with the smallest hash).
    Rows without words stay."""
    text = F.col(text_col).cast("string")
    signed, reached = _linked(docs, id_col, text_col, shingle, percent, sub_keys, sub_size)
    last = F.lit(2**63 - 1)
    who = F.struct(F.coalesce("row_id", last).alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"))
    winners = signed.where("n > 0").join(reached.select("set_id", "component"), "set_id").groupBy("component").agg(
        F.min(who).alias("w")).select("w.*")
    bare = signed.where("n = 0").select(*(F.col(x).alias(f"__{x}") for x in ("t1", "t2"))).distinct()
    keyed = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), last), "__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(7), text)})
    key = ["__id", "__t1", "__t2"]
    one = keyed.join(winners, key, "left_semi").dropDuplicates(key)
    return one.unionByName(keyed.join(bare, key[1:], "left_semi")).select(*docs.columns)
