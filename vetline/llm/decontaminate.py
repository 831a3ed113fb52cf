"""Benchmark decontamination by spaced seeds.

A mask keeps some positions of a short stretch of words and ignores the others.
The kept words of every position of every training text and test item are
hashed; equal hashes (same mask) are hits, and around each hit the text and
the item are compared word by word on their common diagonal.  An item leaks into
a text when a stretch of ``min(16, length of the item)`` of its words stands
there with at most a fifth of them (rounded down) replaced.

The three masks together find every such stretch: whichever words are
replaced, one mask fits somewhere between them (see the test).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
STRETCH = 16            # words that must stand together
REPLACED = 5            # one in so many of them may be another
LEAST_WORDS = 8         # shorter items are no evidence
BROADCAST_SEEDS = 2_000_000     # test seeds, or hashes of texts, sent to every task at most; beyond, both sides are shuffled
NO_ID = -2**63          # stands for a null id in keys


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, position and hash of every mask at every position of ``w`` (words)."""
    n = F.size("w")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    masks = F.array(*(F.struct(F.lit(k), *(F.lit(o) for o in m)) for k, m in enumerate(MASKS)))
    offsets = [f"o{i}" for i in range(len(MASKS[0]))]
    at = df.select("*", F.explode(places).alias("at")).select("*", F.inline(masks).alias("mask", *offsets))
    fits = at.where(F.col("at") + F.col(offsets[-1]) < F.size("w"))
    return fits.select(*keep, "at", F.xxhash64("mask", *(F.get("w", F.col("at") + F.col(o)) for o in offsets)).alias("seed"))


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(7), text).alias("__t2")]


def _cut(w: str, size: Column) -> Column:
    """The words of ``w`` that stand beside an item's ``size`` words on a diagonal."""
    lo = F.greatest("diagonal", F.lit(0))
    return F.slice(w, lo + 1, F.greatest(F.col("diagonal") + size - lo, F.lit(0)))


def _leaking(texts: DataFrame, key: list[str], benchmark: DataFrame, item_col: str, item_text_col: str, broadcast_seeds: int) -> DataFrame:
    """``(key, item, best, all, start, item_words, stretch)`` of the best
    diagonal of each item that leaks into a text of ``(key, text)``."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(NO_ID)).alias("item"), words(F.col(item_text_col).cast("string")).alias("iw")).where(
        F.size("iw") >= LEAST_WORDS).distinct()
    items = c.stored(items.withColumn("ik", F.monotonically_increasing_id()), "items")
    test = _seeds(items.select("ik", F.size("iw").alias("size"), F.col("iw").alias("w")), ["ik", "size"])
    test = test.select("ik", "size", F.col("at").alias("item_at"), "seed")
    split = texts.select(*key, words(F.col("text")).alias("w"))
    diagonal = (F.col("at") - F.col("item_at")).alias("diagonal")
    if test.count() <= broadcast_seeds:     # a benchmark is small, but its size is not taken on trust
        items = F.broadcast(items)
        hits = _seeds(split, [*key, "w"]).join(F.broadcast(test), "seed").select(*key, "ik", "size", diagonal, "w").select(
            *key, "ik", "diagonal", _cut("w", F.col("size")).alias("dw"))
        beside = hits.distinct()
    else:       # seeds are shuffled without the words, which are fetched for the texts with hits
        hits = c.stored(_seeds(split, key).join(test, "seed").select(*key, "ik", "size", diagonal).distinct(), "hits")
        per_text = hits.groupBy(*key).agg(F.collect_list(F.struct("ik", "size", "diagonal")).alias("hits"))     # of one text
        found = split.join(per_text, key).dropDuplicates(key).select(*key, "w", F.explode("hits").alias("hit"))
        beside = found.select(*key, "w", "hit.*").select(*key, "ik", "diagonal", _cut("w", F.col("size")).alias("dw"))
    beside = beside.join(items, "ik").select(*key, "item", "diagonal", F.size("iw").alias("item_words"), "iw", "dw",
                                             F.least(F.lit(STRETCH), F.size("iw")).alias("stretch"))
    same = F.transform("iw", lambda x, k: F.when(
        F.get("dw", (k + F.least(F.col("diagonal"), F.lit(0))).cast("int")) == x, 1).otherwise(0))
    flags = c.stored(beside.select(*key, "item", "diagonal", "item_words", "stretch", same.alias("same")), "beside")
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"), F.lit(0).alias("k"), F.lit(0).alias("all"))

    def step(s, x):
        gone = F.when(s["k"] >= F.col("stretch"), F.get("same", s["k"] - F.col("stretch"))).otherwise(0)
        return F.struct((s["sum"] + x - gone).alias("sum"), F.greatest(s["best"], s["sum"] + x - gone).alias("best"),
                        (s["k"] + 1).alias("k"), (s["all"] + x).alias("all"))

    scored = flags.select(*key, "item", "diagonal", "item_words", "stretch", F.aggregate("same", start, step).alias("r"))
    sure = scored.where(F.col("r.best") >= F.col("stretch") - F.floor(F.col("stretch") / REPLACED))
    best = sure.groupBy(*key, "item").agg(F.max(F.struct(
        F.col("r.best").alias("best"), F.col("r.all").alias("all"), (-F.col("diagonal")).alias("back"), "item_words", "stretch")).alias("b"))
    return best.select(*key, "item", "b.best", "b.all", (-F.col("b.back")).alias("start"), "b.item_words", "b.stretch")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row per document and item that leaks into it: ids, ``item_words``,
    ``matched_words`` (equal words on the best diagonal), ``best_stretch`` (most
    equal words in a stretch), ``stretch`` (its length) and ``start`` (word of
    the document beside the item's first; negative where the item begins earlier).

    Null texts have no words; items under ``LEAST_WORDS`` words leak nowhere.
    Repeated rows (one id, one text) of either table count once; a null id is an
    id like any other.  Of an item's diagonals the one with the best
    stretch counts, then most equal words, then the first.  Items of one
    id and different texts are compared each and counted as one.  Other
    columns are not read.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), *_text_key(text), text.alias("text"))
    best = _leaking(texts, ["doc", "__t1", "__t2"], benchmark, item_col, item_text_col, broadcast_seeds)
    return best.select(F.expr(f"nullif(doc, {NO_ID})").alias(id_col), F.expr(f"nullif(item, {NO_ID})").alias(item_col),
                       F.col("item_words").cast("long").alias("item_words"), F.col("all").cast("long").alias("matched_words"),
                       F.col("best").cast("long").alias("best_stretch"), F.col("stretch").cast("long").alias("stretch"),
                       F.col("start").cast("long").alias("start")).distinct()


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """``docs``, all columns, without the rows into whose text an item leaks."""
    text = F.col(text_col).cast("string")
    key = ["__t1", "__t2"]
    found = c.stored(_leaking(docs.select(*_text_key(text), text.alias("text")), key, benchmark, item_col, item_text_col, broadcast_seeds)
                     .select(*key).distinct(), "leaking")
    if found.count() <= broadcast_seeds:
        found = F.broadcast(found)
    return docs.withColumns({"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(7), text)}).join(found, key, "left_anti").select(*docs.columns)
