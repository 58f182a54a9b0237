"""SimHash near-duplicates by deletion-variant signatures.

Texts get a 64-bit fingerprint of their word shingles. Fingerprints link if they differ
in ``radius`` bits or fewer. They are cut into ``radius // 2 + 1`` segments, so that one
segment of linked fingerprints differs in one bit at most. Each segment is indexed once
per bit with that bit left out; fingerprints that share such a variant meet in a bucket
and are compared there. Equal fingerprints are merged first.

A bucket gives a spanning forest of its links, not all pairs: components stay the same,
and a group of many near copies costs a row per member. Buckets beyond ``BUCKET`` rows
are cut again by variants of the other segments, down to a bounded size; no link is lost.

Null and empty texts, and texts without a word, have fingerprint zero and are linked
like others. Repeated rows are documents of their own. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.llm.common import Staging, text_of

BITS = 64
BUCKET = 4096


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text, unsigned."""
    words = text.lower().split()  # of bytes: A to Z, and the six characters between words
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Sums of up to 255 rows fit a byte, which is many times faster than wider sums.
    whole = len(bits) // 255 * 255
    ones = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        ones += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(bits), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """Key and fingerprint (as signed long) of every document."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            prints = np.fromiter(
                (fingerprint(t.as_py().encode(), shingle, seed) for t in texts), dtype=np.uint64, count=len(texts)
            )
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prints.view(np.int64))], ["key", "print"])

    return rows.mapInArrow(work, "key long, print long")


def _variants(segment: Column, number: int, width: int) -> Column:
    """Keys of a segment: one per bit, with that bit cleared."""
    return F.array(*[
        F.lit((number * BITS + w) << 40).bitwiseOR(segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << w))))
        for w in range(width)
    ])


def _segment(prints: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(prints, low).bitwiseAND(F.lit((1 << width) - 1))


def _forest(prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, int]]:
    """Links that connect what is within the radius: neighbours, and the print they are
    linked to."""
    left = prints
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ np.uint64(at)) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                yield found, at
                queue.extend(found.tolist())


def _links_in_buckets(rows: DataFrame, radius: int, most: int | None) -> DataFrame:
    """Links within each bucket of (bucket, print), and the rows of buckets with more
    than ``most`` prints, which are passed on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, over = None, [], False

        def close() -> tuple[list, list]:
            prints = np.concatenate(held) if held else np.empty(0, np.uint64)
            a, b = [], []
            if not over and len(prints) > 1:
                for found, at in _forest(prints, radius):
                    a.append(found)
                    b.append(np.full(len(found), at, np.uint64))
            return a, b

        def batch_of(a: list, b: list, keys: np.ndarray | None = None, prints: np.ndarray | None = None):
            if keys is not None:
                n = len(keys)
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(prints.view(np.int64)), pa.nulls(n, pa.int64())], ["bucket", "a", "b"]
                )
            x, y = np.concatenate(a), np.concatenate(b)
            low, high = np.minimum(x, y), np.maximum(x, y)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(x), pa.int64()), pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], ["bucket", "a", "b"]
            )

        for batch in batches:
            keys = batch.column("bucket").to_numpy()
            prints = batch.column("print").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            bounds = [0, *cuts.tolist(), len(keys)]
            # Only the first group of a batch can go on from the one before.
            out_a, out_b = [], []
            for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                if lo == hi:
                    continue
                if held_key is None or keys[lo] != held_key:
                    a, b = close()
                    out_a += a
                    out_b += b
                    held_key, held, over = keys[lo], [], False
                    if hi - lo == 1 and i < len(bounds) - 2:
                        continue
                held.append(prints[lo:hi])
                if most is not None and (over or sum(map(len, held)) > most):
                    over = True
                    passed = np.concatenate(held)
                    yield batch_of([], [], np.full(len(passed), held_key, np.int64), passed)
                    held = []
            if out_a:
                yield batch_of(out_a, out_b)
        a, b = close()
        if a:
            yield batch_of(a, b)

    met = rows.repartition("bucket").sortWithinPartitions("bucket", "print")
    return met.mapInArrow(work, "bucket long, a long, b long")


def links(prints: DataFrame, radius: int = 3, bucket_rows: int = BUCKET) -> DataFrame:
    """Links (a, b) between different prints that connect all within the radius.

    ``prints`` has one row per distinct print. Several buckets may give the same link.
    """
    if not 2 <= radius <= 15:
        raise ValueError("radius must be 2 to 15")
    stage = Staging(prints.sparkSession)
    parts = radius // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    segments = [(edges[i], edges[i + 1] - edges[i]) for i in range(parts)]
    keys = F.concat(*[_variants(_segment(F.col("print"), low, width), n, width) for n, (low, width) in enumerate(segments)])
    met = stage.put(_links_in_buckets(prints.select(F.explode(keys).alias("bucket"), "print"), radius, bucket_rows), "met")
    found = met.filter("bucket IS NULL").select("a", "b")
    large = met.filter("bucket IS NOT NULL").select("bucket", F.col("a").alias("print"))
    if large.isEmpty():
        return found
    # A print is in the bucket of segment n; of the others, cut in halves, one half
    # differs in one bit at most, as radius bits are spread over more than radius / 2 halves.
    number = F.shiftright("bucket", 40 + 6)
    again = F.array().cast("array<bigint>")
    for n in range(parts):
        halves = [(low + i * (width // 2), width // 2 if i == 0 else width - width // 2)
                  for m, (low, width) in enumerate(segments) if m != n for i in range(2)]
        inner = F.concat(*[_variants(_segment(F.col("print"), low, width), h, width) for h, (low, width) in enumerate(halves)])
        again = F.when(number == n, inner).otherwise(again)
    finer = large.select("bucket", "print", F.explode(again).alias("inner")).select(
        F.xxhash64("bucket", "inner").alias("bucket"), "print"
    )
    rest = _links_in_buckets(finer, radius, None).select("a", "b")
    return found.unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): every node that has a link, with the lowest node
    it can reach.

    Alternating large-star and small-star steps, each an aggregation and a join; every
    round is staged, so lineage stays short and nothing is gathered on the driver.
    """
    stage = Staging(edges.sparkSession)

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
            pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        )
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        joined = both.join(low, "a")
        if large:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select("b", "low").unionByName(low.select(F.col("a").alias("b"), "low")).select(
                F.col("b").alias("a"), F.col("low").alias("b")
            )
        return out.filter("a <> b").distinct()

    now = stage.put(edges.filter("a <> b").distinct(), "links")
    before = None
    while True:
        middle = stage.put(star(now, True), "stars")
        after = stage.put(star(middle, False), "stars")
        mark = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        stage.drop(now, middle)
        now = after
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = mark


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3,
) -> DataFrame:
    """Key, fingerprint and component of every document; the component is the lowest
    key that can be reached over links. Null keys stay, but name no component."""
    stage = Staging(docs.sparkSession)
    prints = stage.put(fingerprints(docs, key, text, shingle), "prints")
    classes = stage.put(prints.groupBy("print").agg(F.min("key").alias("first")), "classes")
    reached = stage.put(components(links(classes.select("print"), radius)), "reached")
    named = classes.join(reached, classes["print"] == reached["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = stage.put(named.join(firsts, "component").select("print", "component_id"), "labels")
    return prints.join(labels, "print").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
