"""Packing: token pieces against the tokenizer, whole placement, bounds."""

import random
import zlib

import numpy as np
import pytest

from spoorlens.llm import packing
from spoorlens.session import staged


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "made"):
        reference_ids.made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return reference_ids.made.encode(text or "", add_special_tokens=False).ids + [2]


def placed_whole(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(spark):
    some = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [None, "", " ", "a <|endoftext|> b", "x" * 9000, "word " * 5000, "😀é́\r\n\t", "z"] + some + ["z", "z"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "z", 1), (7, "z", 1)], "doc_id long, text string, length int")
    placed = staged(packing.pack_documents(docs), "placed")
    out = placed.collect()
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in out), key=str)
    want = []
    for d, t in [*enumerate(texts), (None, "z"), (7, "z")]:
        ids = reference_ids(t)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)] if len(ids) > first else [0, len(ids)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((d, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert got == sorted(want, key=str)
    bins = placed_whole(out, 1024)
    assert bins <= packing.lower_bound(np.array([r["length"] for r in out]), 1024) + 1
    # Sequences hold the ids of their pieces, one after another.
    built = packing.sequences(placed).collect()
    assert len(built) == bins
    of = {}
    for r in sorted(out, key=lambda r: r["offset"]):
        of[r["sequence_id"]] = of.get(r["sequence_id"], b"") + bytes(r["ids"])
    assert {r["sequence_id"]: bytes(r["ids"]) for r in built} == of
    assert all(len(r["ids"]) == 4 * r["length"] <= 4096 for r in built)


def test_exchange_lowers_the_count(spark):
    rng = random.Random(3)
    lengths = [rng.randint(200, 700) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    out = packing.pack(pieces, 1024, group_rows=100, most_group_rows=5000)
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(3000))
    alone = packing.pack(pieces, 1024, group_rows=100, most_group_rows=100, rounds=1).collect()
    assert placed_whole(rows, 1024) < placed_whole(alone, 1024)


@pytest.mark.parametrize("seed", range(20))
def test_lower_bound_holds(seed):
    """Lengths cut from full bins need at most that many."""
    rng = random.Random(seed)
    lengths, bins = [], rng.randint(1, 12)
    for _ in range(bins):
        left = 64
        while left:
            n = min(left, rng.randint(1, 64))
            lengths.append(n)
            left -= n
    assert packing.lower_bound(np.array(lengths), 64) == bins
    some = np.array(lengths)[:: 2]
    found, offsets, rooms = packing.best_fit_decreasing(some, 64)
    assert packing.lower_bound(some, 64) <= len(rooms)


def test_bound_sees_pairs_that_do_not_fit():
    assert packing.lower_bound(np.array([520] * 10), 1024) == 10
    assert packing.lower_bound(np.array([344] * 9), 1024) == 5
    assert packing.lower_bound(np.array([400] * 10 + [624] * 10), 1024) == 10


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs).count() == 0
