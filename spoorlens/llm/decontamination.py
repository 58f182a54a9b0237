"""Benchmark passages in documents, by SimHash of item-sized windows.

Texts are lower-cased and cut into words at white space and ASCII punctuation; shingles
are five words. A window of an item's length that is ``SIMILARITY`` alike shares most of
its shingles with the item, and at least one unbroken part of them at the same distance
from the start. Shingles of documents are therefore looked up among those of the items,
and a window is fingerprinted where enough of them line up; at the ends of a text the
first or last window is, and the whole text where it is shorter than the item. Fingerprints of windows and
of items of that length meet in a multi-index: 64 bits are cut into ``BLOCKS`` blocks,
items are indexed under each block and under it with each bit changed. Within
``RADIUS`` bits one block differs in one bit at most, so every such pair meets. Then the
weighted Jaccard similarity over shingles, weight being how often one occurs, decides.

DataFrame functions only. Shingles of items are broadcast where they are few and joined
with a shuffle and split hot keys otherwise; texts move once, to the windows found.

Null and empty texts and items match nothing, nor do items of fewer than five words.
Repeated documents are reported row by row if their keys differ, and once otherwise;
repeated items likewise. Further columns are not read. Null keys are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.llm.common import Staging, named_texts, text_of
from spoorlens.operators.skew import keyed_join

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS = 8
WIDTH = 64 // BLOCKS
# So many different shingles of items are looked up without a join.
LOOKED_UP = 20_000
# White space and ASCII punctuation.
BREAK = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), BREAK), lambda w: w != "")


def shingled(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with one hash per five-word shingle in place of the text."""
    others = [c for c in df.columns if c != text]
    hashed = df.select(*others, F.transform(_words(text), lambda w: F.xxhash64(w)).alias("_w"))
    n = F.greatest(F.size("_w") - (SHINGLE - 1), F.lit(0))
    parts = F.arrays_zip(*[F.slice("_w", i + 1, n).alias(str(i)) for i in range(SHINGLE)])
    return hashed.select(
        *others, F.transform(parts, lambda s: F.xxhash64(*[s[str(i)] for i in range(SHINGLE)])).alias("shingles")
    )


def _occurrences(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingles of ``rows`` with their places; where few are wanted, only those.

    Few are looked up inside the array of a text, before it becomes rows: nearly all
    texts then give none. More are left to the join that follows, which checks for
    itself what it broadcasts.
    """
    few = [r[0] for r in wanted.limit(LOOKED_UP + 1).collect()]
    every = rows.select("t1", "t2", F.size("shingles").alias("n"), "shingles")
    if len(few) > LOOKED_UP:
        return every.select("t1", "t2", "n", F.posexplode("shingles").alias("at", "h"))
    listed = ", ".join(f"{h}L" for h in few) or "NULL"
    found = F.expr(
        f"CASE WHEN exists(shingles, h -> h IN ({listed})) THEN "
        f"filter(transform(shingles, (h, i) -> struct(i AS at, h AS h)), x -> x.h IN ({listed})) END"
    )
    return every.select("t1", "t2", "n", F.inline(found))


def least_in_line(shingles: int, similarity: float = SIMILARITY) -> int:
    """Shingles that line up at least in one window this alike.

    Of k shingles on both sides at least 2k * s / (1 + s) are shared. A change of a word
    breaks four shingles or more, so the lost ones bound the changes, and the shared
    ones lie in at most one part more than there are changes.
    """
    shared = 2 * shingles * similarity / (1 + similarity)
    changes = (shingles - shared) / (SHINGLE - 1)
    return max(1, math.floor(shared / (math.floor(changes) + 1) - 1e-9))


def fingerprint(shingles: Column) -> Column:
    """Bits set in over half the shingle hashes, as a long."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.lit(1)).otherwise(0)

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(
        bits, F.struct(F.lit(0).cast("long").alias("v")),
        lambda s, x: F.struct(F.shiftleft(s["v"], 1).bitwiseOR(x.cast("long")).alias("v")),
        lambda s: s["v"],
    )


def _block(prints: Column, n: int) -> Column:
    return F.shiftrightunsigned(prints, n * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays of shingles."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    shared_sets = F.size(F.array_intersect(a, b))

    def times(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    shared_counts = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x))
    )
    shared = F.when(plain, shared_sets).otherwise(shared_counts)
    return shared / (F.size(a) + F.size(b) - shared)


def matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
    similarity: float = SIMILARITY, radius: int = RADIUS, by_text: bool = False,
) -> DataFrame:
    """Pairs of document and item with the best window: its first word, its words, the
    bits by which fingerprints differ, and the similarity. ``by_text`` gives the 128-bit
    name of the text (t1, t2) in place of the key."""
    ids = ["t1", "t2"] if by_text else ["key"]
    if radius >= 2 * BLOCKS:
        raise ValueError(f"the index finds all within {2 * BLOCKS - 1} bits")
    stage = Staging(docs.sparkSession)
    plain = named_texts(docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text")))
    known = stage.put(
        shingled(items.select(F.col(f"`{item_key}`").cast("long").alias("item"), text_of(text).alias("text")))
        .filter(F.size("shingles") > 0).select(
            "item", "shingles", F.size("shingles").alias("k"), fingerprint(F.col("shingles")).alias("item_print")
        ), "items",
    )
    # Where shingles of items occur, by the window start that they stand for. Equal texts
    # have equal windows, so these go by the name of the text.
    asked = stage.put(known.select("k", F.posexplode("shingles").alias("i", "item_h"), "item").distinct(), "asked")
    seen = _occurrences(shingled(plain.drop("key")), asked.select("item_h").distinct())
    # Passages cut off at either end of a text line up outside it; the first or last window
    # stands for them, and the whole text where it is shorter than the item.
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("i"), F.col("n") - F.col("k"))).alias("start")
    lined = keyed_join(seen, asked, [("h", "item_h")], how="inner").select("t1", "t2", "k", "item", start, "n", "at")
    # As in least_in_line, per item and shingles of the window.
    shared = (F.col("k") + F.least("k", "n")) * similarity / (1 + similarity)
    floor = F.greatest(F.lit(1), F.floor(shared / (F.floor((F.col("k") - shared) / (SHINGLE - 1)) + 1) - 1e-9))
    windows = (
        lined.filter((F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + F.col("k")) & (F.col("n") >= F.col("k") * similarity - 1e-9))
        .groupBy("t1", "t2", "item", "k", "n", "start").agg(F.count_distinct("at").alias("c")).filter(F.col("c") >= floor)
        .groupBy("t1", "t2").agg(F.collect_set(F.struct("k", "start")).alias("windows"))
    )
    windows = stage.put(windows, "windows")
    found = shingled(plain.join(windows, ["t1", "t2"]).select(*ids, "windows", "text"))
    each = found.select(*ids, "shingles", F.explode("windows").alias("w")).select(
        *ids, "w.k", "w.start", F.slice("shingles", F.col("w.start") + 1, F.col("w.k")).alias("part")
    )
    printed = stage.put(each.select("*", fingerprint(F.col("part")).alias("print")), "prints")

    blocks = F.array(*[F.struct(F.lit(n).alias("block"), _block(F.col("print"), n).alias("value")) for n in range(BLOCKS)])
    near = F.array(*[
        F.struct(F.lit(n).alias("item_block"), _block(F.col("item_print"), n).bitwiseXOR(F.lit(flip)).alias("item_value"))
        for n in range(BLOCKS) for flip in [0, *[1 << b for b in range(WIDTH)]]
    ])
    index = known.select("item", F.col("k").alias("item_k"), "item_print", F.col("shingles").alias("item_part"), F.explode(near).alias("x")).select(
        "item", "item_k", "item_print", "item_part", "x.item_block", "x.item_value"
    )
    probes = printed.select(*ids, "k", "start", "part", "print", F.explode(blocks).alias("p")).select(
        *ids, "k", "start", "part", "print", "p.block", "p.value"
    )
    bits = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    met = keyed_join(
        probes, index, [("k", "item_k"), ("block", "item_block"), ("value", "item_value")], how="inner", condition=bits <= radius,
    )
    # A pair may meet in several blocks: it counts in the first where it does.
    agree = F.array(*[
        F.bit_count(_block(F.col("print"), n).bitwiseXOR(_block(F.col("item_print"), n))) <= 1 for n in range(BLOCKS)
    ])
    once = met.filter(F.array_position(agree, F.lit(True)) - 1 == F.col("block"))
    scored = once.select(
        *ids, "item", "start", (F.size("part") + SHINGLE - 1).alias("words"), bits.alias("bits"),
        _similarity(F.col("part"), F.col("item_part")).alias("similarity"),
    ).filter(F.col("similarity") >= similarity)
    best = scored.groupBy(*ids, "item").agg(
        F.max(F.struct("similarity", (-F.col("bits")).alias("b"), (-F.col("start")).alias("s"), "words")).alias("m")
    )
    return best.select(
        *(ids if by_text else [F.col("key").alias(key)]), F.col("item").alias(item_key), (-F.col("m.s")).alias("start"), "m.words",
        (-F.col("m.b")).alias("bits"), "m.similarity",
    )
