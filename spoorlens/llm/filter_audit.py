"""What each filter of a set removes, in every order of application.

Five filters (``LETTERS``) fail a document by counts over its whole text, or because a
smaller doc_id has the same text. ``measure`` makes the counts with a byte transducer: a
table maps bytes to classes, a second one maps (state, class) to what the step emits (a
word begins, a code point, a capital, a symbol). A state is "in a word" or "between
words" and depends on the byte before alone, so the steps of a whole Arrow buffer are
looked up at once. Word spans go into an open hash table over (text, bytes); a span counts
as known only after its bytes were compared with those of the entry that it met.

A document's failures are one bit mask. Counts per part and mask, 32 of them, decide all
120 orders: a step removes the masks that hold its bit and none of an earlier filter's.

Documents meet their copies by a 128-bit name of the text: equal rows are counted first,
the lowest doc_id per name is an aggregate, and rows find it by (name, doc_id), so a text
with very many copies is spread over all tasks. Labels are joined by ``skew.keyed_join``.

Null texts are empty, a null part is the empty string, a null doc_id has no smaller one
and no label. Rows with one doc_id and one text are counted one by one and none is the
other's copy; several labels of a doc_id count as the highest. Without documents there are
no parts and no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.llm.common import Staging, slices_by_size, text_of
from spoorlens.operators.skew import keyed_join

LETTERS = "ABCDE"
SLICE_BYTES = 2 << 20
MOST_CHUNKS = 8

# Classes of bytes.
GAP, CAPITAL, SYMBOL, OTHER, INNER = range(5)
# What a step emits, as bits.
WORD, POINT, UPPER, SIGN = 1, 2, 4, 8


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = GAP
    table[ord("A"):ord("Z") + 1] = CAPITAL
    table[[ord(c) for c in "#$%&*|"]] = SYMBOL
    table[0x80:0xC0] = INNER  # second to fourth bytes of a character
    return table


def _emissions() -> np.ndarray:
    """By 8 * state + class; state 0 is between words, 1 in a word."""
    table = np.zeros(16, np.uint8)
    for state in (0, 1):
        for kind in (GAP, CAPITAL, SYMBOL, OTHER, INNER):
            begins = WORD if kind != GAP and state == 0 else 0
            point = POINT if kind != INNER else 0
            table[8 * state + kind] = begins | point | {CAPITAL: UPPER, SYMBOL: SIGN}.get(kind, 0)
    return table


CLASS = _classes()
EMITS = _emissions()
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def transduce(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over texts that lie one after another in ``data``; ``ends`` has their
    borders, the first one included. Emissions per byte, starts and ends of words."""
    kinds = CLASS[data]
    state = (kinds != GAP).astype(np.uint8)  # after each byte
    before = np.zeros(len(data) + 1, np.uint8)
    before[1:] = state
    before[ends] = 0  # each text begins between words
    emits = EMITS[(before[:-1] << 3) | kinds]
    starts = np.flatnonzero(emits & WORD)
    # A word ends where the next byte is not in it, or its text ends.
    stops = np.flatnonzero(state & ~_continues(kinds, ends, len(data)) & 1) + 1
    return emits, starts, stops


def _continues(kinds: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    after = np.zeros(n + 1, np.uint8)
    after[:n] = kinds != GAP
    after[ends] = 0
    return after[1:]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def first_of_their_text(data: np.ndarray, texts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each span whether its bytes are new in its text, by a verified hash table.

    ``data`` has eight more bytes than the texts. Bytes are read as 64-bit words, the last
    one masked; spans beyond ``MOST_CHUNKS`` words are hashed and compared one by one.
    """
    n = len(starts)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def chunk(which: np.ndarray, k: int) -> np.ndarray:
        return eight[starts[which] + 8 * k] & _MASKS[np.minimum(lengths[which] - 8 * k, 8)]

    every = np.arange(n)
    head = chunk(every, 0)
    hashes = _mixed(head ^ _mixed(texts.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + lengths.astype(np.uint64)))
    for k in range(1, MOST_CHUNKS):
        more = np.flatnonzero(lengths > 8 * k)
        if not len(more):
            break
        hashes[more] = _mixed(hashes[more] + chunk(more, k))
    for i in np.flatnonzero(lengths > 8 * MOST_CHUNKS).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]].data, int(hashes[i]))

    def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        equal = (texts[a] == texts[b]) & (lengths[a] == lengths[b]) & (head[a] == head[b])
        for k in range(1, MOST_CHUNKS):
            more = np.flatnonzero(equal & (lengths[a] > 8 * k))
            if not len(more):
                break
            equal[more] = chunk(a[more], k) == chunk(b[more], k)
        for i in np.flatnonzero(equal & (lengths[a] > 8 * MOST_CHUNKS)).tolist():
            x, y, size = starts[a[i]], starts[b[i]], lengths[a[i]]
            equal[i] = x == y or data[x:x + size].tobytes() == data[y:y + size].tobytes()
        return equal

    bits = max(4, int(2 * n).bit_length())
    slots = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    table = np.full(1 << bits, -1, np.int64)
    new = np.zeros(n, bool)
    open_ = every
    while len(open_):
        at = slots[open_]
        free = table[at] < 0
        table[at[free]] = open_[free]
        owner = table[at]
        new[open_[owner == open_]] = True
        missed = ~same(open_, owner)
        open_ = open_[missed]
        slots[open_] = (at[missed] + 1) & ((1 << bits) - 1)
    return new


def counts(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text; ``data`` has eight more bytes than the last of ``ends``."""
    ends = ends.astype(np.int64)
    rows, size = len(ends) - 1, int(ends[-1])
    emits, starts, stops = transduce(data[:size], ends)
    filled = np.flatnonzero(np.diff(ends) > 0)

    def summed(bit: int) -> np.ndarray:
        out = np.zeros(rows, np.int64)
        if len(filled):
            out[filled] = np.add.reduceat((emits & bit) != 0, ends[filled], dtype=np.int64)
        return out

    texts = np.searchsorted(ends, starts, "right") - 1
    new = first_of_their_text(data, texts, starts, stops - starts) if len(starts) else np.zeros(0, bool)
    return {
        "n_words": np.bincount(texts, minlength=rows).astype(np.int64),
        "n_distinct": np.bincount(texts[new], minlength=rows).astype(np.int64),
        "n_points": summed(POINT), "n_capitals": summed(UPPER), "n_symbols": summed(SIGN),
    }


COUNTS = ["n_words", "n_distinct", "n_points", "n_capitals", "n_symbols"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, with the counts; columns of their names are replaced."""
    kept = [c for c in docs.columns if c != text and c not in COUNTS]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], text_of(f"`{text}`").alias("text"))
    schema = rows.drop("text").schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, ends in slices_by_size(whole, len(kept), SLICE_BYTES):
                found = counts(np.concatenate((data, np.zeros(8, np.uint8))), ends)
                columns = [*batch.columns[:-1], *[pa.array(found[name], pa.int64()) for name in COUNTS]]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *COUNTS])

    return rows.mapInArrow(work, schema)


def own_failures() -> Column:
    """Bits of the filters that look at the document alone, A to D."""
    tests = [
        F.col("n_words") < 50,
        100 * F.col("n_distinct") < 65 * F.col("n_words"),
        100 * F.col("n_capitals") > 5 * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    out = F.lit(0)
    for bit, test in enumerate(tests):
        out = out + F.when(test, 1 << bit).otherwise(0)
    return out


def failures(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """key, part, mask and the number ``n`` of equal rows."""
    stage = Staging(docs.sparkSession)
    body = text_of(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2"), body.alias("text"),
    )
    measured = measure(rows).select("key", "part", "t1", "t2", own_failures().alias("own"))
    rows = stage.put(measured.groupBy("key", "part", "t1", "t2", "own").agg(F.count("*").alias("n")), "audit")
    first = rows.groupBy("t1", "t2").agg(F.min("key").alias("first"))
    first = first.select(F.col("t1").alias("f1"), F.col("t2").alias("f2"), "first")
    same = (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2")) & (F.col("key") == F.col("first"))
    copy = F.col("key").isNotNull() & F.col("first").isNull()
    return rows.join(first, same, "left").select(
        "key", "part", (F.col("own") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"), "n"
    )


def histogram(failed: DataFrame, labels: DataFrame, label_key: str) -> DataFrame:
    """Per part, arrays by mask: documents, good ones, toxic ones."""
    known = labels.groupBy(F.col(f"`{label_key}`").cast("long").alias("label_key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = keyed_join(failed, known, [("key", "label_key")])
    slim = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )

    def by_mask(name: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask") == m, F.col(name)).otherwise(0)) for m in range(1 << len(LETTERS))])

    return slim.groupBy("part").agg(*[by_mask(name).alias(name) for name in ("n", "good", "toxic")])


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
    label_key: str = "doc_id",
) -> DataFrame:
    """One row per part, order of the filters and step."""
    counted = histogram(failures(docs, key, text, part), labels, label_key)
    steps = []
    for order in permutations(range(len(LETTERS))):
        before = 0
        for step, bit in enumerate(order, 1):
            steps.append(("".join(LETTERS[b] for b in order), step, 1 << bit, before))
            before |= 1 << bit
    kind = "array<struct<filter_order:string,step:int,own:int,before:int>>"
    plan = F.from_json(F.lit(_json(steps)), kind)
    each = counted.withColumn("at", F.explode(plan)).select("part", "n", "good", "toxic", "at.*")

    def total(of: str, chosen) -> Column:
        """Sum of an array over the masks that are chosen."""
        picked = F.transform(F.col(of), lambda v, m: F.when(chosen(m), v).otherwise(0))
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, v: a + v)

    def fails(m: Column) -> Column:
        return m.bitwiseAND(F.col("own")) != 0

    def earlier(m: Column) -> Column:
        return m.bitwiseAND(F.col("before")) != 0

    # In an order chosen at random, each filter that a document fails is the first of them
    # equally often.
    orders = len(steps) // len(LETTERS)
    share = F.transform(F.col("n"), lambda v, m: F.when(fails(m), v * F.lit(orders) / F.bit_count(m)).otherwise(0.0).cast("long"))
    return each.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total("n", lambda m: fails(m) & ~earlier(m)).alias("removed"),
        total("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~earlier(m)).alias("good_lost"),
        total("toxic", lambda m: fails(m) & ~earlier(m)).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("long"), lambda a, v: a + v).alias("shapley"),
    )


def _json(steps: list[tuple[str, int, int, int]]) -> str:
    parts = [f'{{"filter_order":"{o}","step":{s},"own":{own},"before":{before}}}' for o, s, own, before in steps]
    return "[" + ",".join(parts) + "]"
