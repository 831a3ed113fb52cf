"""Line dedup by a segment-partition edit join.

Two lines are alike when they are equal, or both have ``least_fuzzy`` code points
and at most ``edits`` insertions, deletions and replacements turn one into the
other.  A line is removed when an equal or a like line stands earlier.

Of ``edits + 1`` segments of a line at least one stands unchanged in every like
line, shifted by no more than the edits before and after it allow.  Each line
puts its segments into an index by class of lengths, place and content, and
probes the index of its own class, and of the next smaller one where lines up
to ``edits`` shorter may be in it, with the substrings that may be a segment.
Keys that only one line has go first, as counts; what is left is joined, pairs
whose characters differ too much go within the join, and each further pair is
compared by a banded bit-parallel edit distance: the band's 2 * edits + 1 cells
of a column are bits of two integers.

Only the distinct lines meet in the join, so a line of which a third of all rows
are copies counts once; its rows are counted before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

EDITS = 2
LEAST = 8               # code points of a line that takes part
LEAST_FUZZY = 30        # and of one compared by edit distance
CLASS = 8               # lengths whose lines are cut alike


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two arrays of characters, right up to ``edits`` and
    above it otherwise; needs ``|size(a) - size(b)| <= edits <= size(a)``."""
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1)
    last = F.size(a)

    def inverse(x):
        return F.bitwise_not(x).bitwiseAND(full)

    def column(s, ch):
        j = s["j"]
        equal = F.lit(0)
        for k in range(width):      # bit k is row j - edits + k
            equal = equal + F.when(F.get(a, F.when(j - edits + k >= 1, j - edits + k - 1).otherwise(last)) == ch, 1 << k).otherwise(0)

        def diagonal(eq):
            d = ((eq.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(eq).bitwiseOR(s["vn"]).bitwiseAND(full)
            return _let(d, horizontal)

        def horizontal(d):
            up = s["vn"].bitwiseOR(inverse(d.bitwiseOR(s["vp"])))
            return _let(F.struct(d.alias("d"), up.alias("hp"), d.bitwiseAND(s["vp"]).alias("hn")), vertical)

        def vertical(x):
            down = F.shiftright(x["d"], 1)
            row = last - j + edits      # of the last row, once the band has reached it
            step = F.when(j <= last - edits, 1 - F.shiftright(x["d"], width - 1)).otherwise(
                F.getbit(x["hp"], row).cast("int") - F.getbit(x["hn"], row).cast("int"))
            return F.struct(x["hn"].bitwiseOR(inverse(down.bitwiseOR(x["hp"]))).alias("vp"),
                            down.bitwiseAND(x["hp"]).alias("vn"), (s["score"] + step).alias("score"), (j + 1).alias("j"))
        return _let(equal, diagonal)

    # the score is that of the band's lowest diagonal; it can fall by no more than ``edits`` later
    lost = 2 * edits + F.size(b) - last
    start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("score"), F.lit(1).alias("j"))
    return F.aggregate(b, start, lambda s, ch: F.when(s["score"] > lost, s).otherwise(column(s, ch)), lambda s: s["score"])


def _alike(x: Column, y: Column, most: Column, end) -> Column:
    """How many characters two strings share at one end, ``most`` at most, by
    halving; ``end(string, k)`` is the k characters there."""
    def more(k, power):
        wider = k + power
        return F.when((wider <= most) & (end(x, wider) == end(y, wider)), wider).otherwise(k)
    powers = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int")),
                         lambda i: F.call_function("shiftleft", F.lit(1), F.ceil(F.log2(most + 1)).cast("int") - i))
    return F.aggregate(powers, F.lit(0), more)


def _probes(edits: int) -> list[tuple[int, int, int, int]]:
    """``(segment, from_right, shift, lower)``: where a line may hold a segment
    of a like line that is no longer.  Segments in the left half are counted
    from the left end, the others from the right; ``lower`` is 1 for the
    boundaries of the next smaller class of lengths.  (i, _, 0, 0) are the
    line's own segments."""
    out = []
    for i in range(edits + 1):
        right = 2 * i > edits
        near = edits - i if right else i        # edits there may be between the end and the segment
        other = i if right else edits - i
        lo, hi = (-near, min(near, other)) if right else (-min(near, other), near)
        out += [(i, int(right), s, lower) for s in range(lo, hi + 1) for lower in (0, 1)]
    return out


def segment_keys(found: DataFrame, edits: int) -> DataFrame:
    """``(key, role, h1)`` of the lines: role 0 for their own segments, 1 for
    substrings that may be segments of another line.

    Lines of a class of lengths (``CLASS`` apart) have segments of one length,
    so one substring probes the index for all lengths of the class; a line
    whose length is the start of its class probes the class before too.
    """
    parts = edits + 1
    # characters of one width, so that a substring is found at once
    wide = found.select("h1", "n", F.encode("line", "UTF-32").alias("w"))
    probes = F.array(*(F.struct(*(F.lit(x) for x in p)) for p in _probes(edits)))
    spots = wide.select("*", F.inline(probes).alias("i", "from_right", "shift", "lower")).where(f"lower = 0 or n % {CLASS} < {edits}")
    size = f"cast((n div {CLASS} - lower) * {CLASS} div {parts} as int)"
    at = spots.withColumn("size", F.expr(size)).withColumn(
        "lo", F.expr(f"if(from_right = 1, n - ({parts} - i) * size, i * size) + shift"))
    at = at.where("size > 0 and lo >= 0 and lo + size <= n")
    return at.select(F.xxhash64("size", "i", F.expr("substring(w, 4 * lo + 1, 4 * size)")).alias("key"),
                     F.expr("if(lower = 0 and shift = 0, 0, 1)").alias("role"), "h1")


def _occurrences(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """Lines that take part: place (in order of ids, null last; texts of one
    id by their hashes), trimmed line, its length and hashes."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"),
                       F.posexplode(F.split(text, "\n")).alias("no", "raw"))
    rows = rows.select("id", "t1", "t2", "no", F.btrim("raw", F.lit(c.ASCII_SPACE)).alias("line")).withColumn("n", F.char_length("line"))
    place = F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("id"), "t1", "t2", "no")
    return rows.where(F.col("n") >= least).select(
        place.alias("place"), "line", "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def _spoken(line: Column) -> Column:
    """128 bits, each the parity of some characters: an edit flips two at most."""
    def flip(s, ch):
        bit = F.xxhash64(ch)
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
        left = F.pmod(F.shiftright(bit, 8), F.lit(2)) == 0
        return F.struct(F.when(left, s["p1"].bitwiseXOR(one)).otherwise(s["p1"]).alias("p1"),
                        F.when(left, s["p2"]).otherwise(s["p2"].bitwiseXOR(one)).alias("p2"))
    zero = F.lit(0).cast("long")
    return F.aggregate(F.split(line, ""), F.struct(zero.alias("p1"), zero.alias("p2")), flip)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST,
             least_fuzzy: int = LEAST_FUZZY) -> DataFrame:
    """``(id, t1, t2, removed, n_near)``: for each document that loses lines
    their numbers from 0, and how many of them are no plain repeats."""
    if not 0 <= edits < CLASS or least_fuzzy < CLASS + edits + 1:
        raise ValueError("fuzzy lines must be longer than the edits allowed and a class of lengths")
    found = _occurrences(docs, id_col, text_col, least)
    h = ["h1", "h2"]
    classes = c.stored(found.groupBy(*h).agg(F.min("place").alias("first"), F.count("*").alias("copies")), "classes")
    keys = segment_keys(found.where(F.col("n") >= least_fuzzy), edits)
    # half of a line's hash is enough here: lines that share it are all looked at
    shared = keys.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x < y").select("key")
    met = c.stored(keys.join(shared.hint("shuffle_hash"), "key").distinct(), "met")
    wanted = met.select("h1").distinct().join(classes, "h1").select(*h, "first")
    texts = found.where(F.col("n") >= least_fuzzy).select(*h, "line", "n").join(wanted, h).groupBy(*h).agg(F.first(F.struct("first", "line", "n")).alias("x"))
    texts = c.stored(texts.select(F.monotonically_increasing_id().alias("node"), *h, "x.*", _spoken(F.col("x.line")).alias("p")), "lines")
    side = met.join(texts.select("h1", "node", "p.p1", "p.p2", "n"), "h1").select("key", "role", "node", "p1", "p2", "n")
    side = c.stored(side, "sides")
    a, b = (side.select([F.col(x).alias(f"{s}_{x}") for x in side.columns]) for s in "ab")
    differ = F.bit_count(F.col("a_p1").bitwiseXOR(F.col("b_p1"))) + F.bit_count(F.col("a_p2").bitwiseXOR(F.col("b_p2")))
    pairs = a.join(b, (F.col("a_key") == F.col("b_key")) & (F.col("a_role") <= F.col("b_role")) & (F.col("a_role") + F.col("b_role") < 2)
                   & (F.col("a_node") != F.col("b_node")) & ((F.col("b_role") == 1) | (F.col("a_node") < F.col("b_node")))
                   & (F.abs(F.col("a_n") - F.col("b_n")) <= edits) & (differ <= 2 * edits))
    pairs = c.stored(pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct(), "pairs")
    ends = texts.select("node", "line", "n", "first", *h)
    both = pairs.join(ends.select([F.col(x).alias("a" if x == "node" else f"a_{x}") for x in ends.columns]), "a").join(
        ends.select([F.col(x).alias("b" if x == "node" else f"b_{x}") for x in ends.columns]), "b")
    # what is equal at both ends needs no comparison, but for ``edits`` characters that the band starts from
    left = F.greatest(_alike(F.col("a_line"), F.col("b_line"), F.least("a_n", "b_n"), F.left) - edits, F.lit(0))
    both = c.stored(both.withColumn("skip", left), "both")
    cut = {f"{s}_line": F.substring(f"{s}_line", F.col("skip") + 1, F.col(f"{s}_n") - F.col("skip")) for s in "ab"}
    both = both.withColumns(cut).withColumns({f"{s}_n": F.char_length(f"{s}_line") for s in "ab"})
    right = F.greatest(_alike(F.col("a_line"), F.col("b_line"), F.least("a_n", "b_n"), F.right) - edits, F.lit(0))
    both = c.stored(both.withColumn("skip", right), "both")
    chars = {x: F.split(F.left(f"{s}_line", F.col(f"{s}_n") - F.col("skip")), "") for x, s in (("x", "a"), ("y", "b"))}
    both = c.stored(both.withColumns(chars).drop("a_line", "b_line"), "both")
    both = both.where(banded_distance(F.col("x"), F.col("y"), edits) <= edits)

    def hashes(s: str) -> Column:
        return F.struct(F.col(f"{s}_h1").alias("h1"), F.col(f"{s}_h2").alias("h2"))

    later = F.when(F.col("a_first") < F.col("b_first"), hashes("b")).otherwise(hashes("a"))
    near = c.stored(both.select(later.alias("l")).select("l.h1", "l.h2").distinct().withColumn("near", F.lit(True)), "near")
    told = classes.join(near, h, "left").where("copies > 1 or near")
    gone = found.select("place", *h).join(told, h).where("place <> first or near")
    return gone.groupBy("place.id", "place.t1", "place.t2").agg(
        F.sort_array(F.collect_list("place.no")).alias("removed"),
        F.count_if(F.col("place") == F.col("first")).alias("n_near"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, ``n_lines`` (parts between newlines; a null
    text has none), ``n_removed``, ``n_near`` (removed without an equal line
    before it) and ``removed`` (line numbers from 0, comma-joined).

    Lines are compared without outer ASCII white space; those under ``least``
    code points, blank ones among them, stay.  "Earlier" is by id (null ids
    last), then line.  Repeated rows (one id, one text) are one document
    and share its result.  Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    gone = repeated(docs, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("place_id"),
                       F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"),
                       F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines"))
    out = rows.join(gone.withColumnRenamed("id", "place_id"), ["place_id", "t1", "t2"], "left")
    return out.select(F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, with repeated lines taken out of the text; rows
    of which no text is left, though they had some, go."""
    text = F.col(text_col).cast("string")
    gone = repeated(docs, id_col, text_col, **options).select(
        F.col("id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), F.col("removed").alias("__removed"))
    keyed = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)),
                              "__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(7), text)})
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("__removed"), i)), "\n")
    out = keyed.join(gone, ["__id", "__t1", "__t2"], "left").withColumn(
        text_col, F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(kept))
    blank = F.btrim(F.col(text_col), F.lit(c.ASCII_SPACE)) == ""
    return out.where(F.col("__removed").isNull() | ~blank).select(*docs.columns)
