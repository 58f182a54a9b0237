"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity``. Pieces are dealt by hash into
groups of bounded size. Each group is packed best-fit decreasing, and dual feasible
functions give a lower bound on the bins that its lengths need: a function that maps
lengths so that no full bin exceeds one bounds the count by the sum of mapped lengths.
A group whose count equals its bound is certified to be optimal and stays. The others
give up the documents of all bins that have room left; these are dealt anew into larger
groups, so that gaps of several groups meet, and packed again. What does not lower the
count is discarded.

Null texts are empty and hold the end token alone. Repeated rows are packed one by one,
null doc_ids as well. Further columns of the input are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm.common import Staging, text_of

CAPACITY = 1024
END_ID = 2
GROUP_ROWS = 16_384
MOST_GROUP_ROWS = 262_144
ROUNDS = 4
PIECES = 2_000
TOKENIZER = "byte_bpe_50k"


@lru_cache(maxsize=2)
def encoding(name: str):
    """A byte-level BPE from a vocabulary of ranks, with the ids of the tokenizer file of
    the same name (both forms hold one vocabulary, and the same split pattern)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)}
    )


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(at, capacity) for at in range(first, n, capacity)]


def tokenize(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
) -> DataFrame:
    """Pieces of every document: key, piece, start, length, and the ids, four bytes each,
    the lowest first."""
    names = ["key", "piece", "start", "length", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(tokenizer)
        end = np.array([END_ID], dtype="<u4")

        def made(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names)

        for batch in batches:
            out: list[list] = [[] for _ in names]
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                ids = np.concatenate((encoder.encode_to_numpy(t, allowed_special="all"), end)).astype("<u4", copy=False)
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    for column, value in zip(out, (k, piece, start, length, ids[start:start + length].tobytes())):
                        column.append(value)
                if len(out[0]) >= PIECES:
                    yield made(out)
                    out = [[] for _ in names]
            yield made(out)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(work, "key long, piece int, start long, length long, ids binary")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that these lengths need at least: the best of a family of dual feasible
    functions, with integers only.

    One function takes lengths above capacity - t as whole bins and ignores those below
    t. Another rounds (k + 1) * x / capacity down and divides by k, but leaves lengths
    that make it whole. Their compositions are dual feasible as well.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    t = np.arange(capacity // 2 + 1)[:, None]
    clipped = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
    best = int(-(-(clipped @ counts).max() // capacity))
    for k in range(1, 9):
        scaled = (k + 1) * clipped
        mapped = np.where(scaled % capacity == 0, k * clipped, scaled // capacity * capacity)
        best = max(best, int(-(-(mapped @ counts).max() // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the room left per bin.

    Open bins are kept by room left; one integer has a bit per room that occurs, so the
    tightest bin is its lowest set bit from the length on.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    present = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = present >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                present ^= 1 << room
        else:
            room, chosen = capacity, len(rooms)
            rooms.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        room -= need
        rooms[chosen] = room
        if room:
            by_room[room].append(chosen)
            present |= 1 << room
    return bins, offsets, np.array(rooms, np.int64)


def _packed(dealt: DataFrame, capacity: int, round_: int, columns: list[str]) -> DataFrame:
    """Each group packed by itself: bin, offset, room of the bin, bins and bound of the group."""
    kinds = {name: kind for name, kind in dealt.dtypes}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    schema += ", sequence_id long, offset long, room long, group_bins long, group_bound long, first_of_bin boolean"

    def work(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        out = group[columns].copy()
        out["sequence_id"] = (round_ << 56) + (int(group["_group"].iloc[0]) << 32) + bins
        out["offset"] = offsets
        out["room"] = rooms[bins]
        out["group_bins"] = len(rooms)
        out["group_bound"] = lower_bound(lengths, capacity)
        out["first_of_bin"] = offsets == 0
        return out

    return dealt.groupBy("_group").applyInPandas(work, schema)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
    most_group_rows: int = MOST_GROUP_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset, and
    bins and bound of the group that a piece was packed in last."""
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset", "group_bins", "group_bound")]
    stage = Staging(pieces.sparkSession)
    numbered = stage.put(
        pieces.select(*own).withColumn("_deal", F.xxhash64(F.monotonically_increasing_id(), F.lit(0))), "pieces"
    )
    columns = [*own, "_deal"]
    result = [*own, "sequence_id", "offset", "group_bins", "group_bound"]
    # Full pieces are bins of their own, at their bound; their numbers are negative.
    full = F.col("length") >= capacity
    done = [numbered.filter(full).select(
        *own, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(1).cast("long").alias("group_bins"), F.lit(1).cast("long").alias("group_bound"),
    )]
    open_rows, before = numbered.filter(~full), None
    for round_ in range(rounds):
        n = open_rows.count()
        if n == 0:
            break
        groups = -(-n // min(group_rows << (2 * round_), most_group_rows))
        dealt = open_rows.select(*columns, F.pmod(F.xxhash64("_deal", F.lit(round_)), F.lit(groups)).alias("_group"))
        now = stage.put(_packed(dealt, capacity, round_, columns), "packed")
        if before is not None:
            bins = now.filter("first_of_bin").count()
            if bins >= before.filter("first_of_bin").count():
                break
        gap = (F.col("group_bins") > F.col("group_bound")) & (F.col("room") > 0)
        done.append(now.filter(~gap).select(*result))
        before = now.filter(gap)
        open_rows = before.select(*columns)
        if groups == 1:  # one group already: the same rows would be packed the same way
            break
    if before is not None:
        done.append(before.select(*result))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
) -> DataFrame:
    """Token pieces of ``docs`` with their ids and their place in sequences.

    Lengths alone are packed; the ids join their places once these are known.
    """
    stage = Staging(docs.sparkSession)
    pieces = tokenize(docs, key, text, capacity, tokenizer).withColumn("row", F.monotonically_increasing_id())
    pieces = stage.put(pieces, "token-pieces")
    places = pack(pieces.select("row", "length"), capacity).select(F.col("row").alias("placed"), "sequence_id", "offset")
    whole = pieces.join(places, F.col("row") == F.col("placed"))
    return whole.select(F.col("key").alias(key), "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences of what ``pack_documents`` has placed: sequence_id, ids, and their
    number. A sequence has one piece per token at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), ""))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
