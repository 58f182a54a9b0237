"""SimHash: fingerprints, links and components against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from conftest import rows

from spoorlens.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        if 2 * ones > len(shingles):
            out |= 1 << bit
    return out


def brute_components(pairs):
    """Lowest key reachable by links of three bits or fewer."""
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(pairs)), 2):
        if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= 3:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (key, _) in enumerate(pairs):
        groups.setdefault(root(i), []).append(key)
    return {i: min([k for k in groups[root(i)] if k is not None], default=None) for i in range(len(pairs))}


EDGES = [None, "", " \t\n", "one", "one two", "A b C", "a b c", "x " * 2000, "word " * 300, "ÄÖ äö ÄÖ"]


def test_documents_match_brute_force(spark):
    some = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(150).collect()]
    texts = some + EDGES + some[:20] + [t.replace("the", "teh", 1) for t in some[:60]]
    docs = spark.createDataFrame(
        [(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, "lone", "x", 7), (3, "again", "x", 7)],
        "doc_id long, text string, print string, component long",
    )
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    pairs = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    named = brute_components(pairs)
    want = sorted(((k, f"{p:016x}", named[i]) for i, (k, p) in enumerate(pairs)), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def close_prints(n, seed, flips):
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = base
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << bit
        out.add(x)
    return out


@pytest.mark.parametrize("bucket_rows", [4096, 5])
@pytest.mark.parametrize("radius", [3, 4])
def test_links_connect_all_within_radius(spark, bucket_rows, radius):
    prints = sorted(close_prints(120, 1, 4) | close_prints(120, 2, 7) | close_prints(5, 3, 40))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {frozenset(r) for r in rows(simhash.links(df, radius, bucket_rows).distinct())}
    at = dict(zip(signed, prints))
    for a, b in map(tuple, found):
        assert bin(at[a] ^ at[b]).count("1") <= radius

    def roots(pairs):
        parent = {p: p for p in signed}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in pairs:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        return {p: root(p) for p in signed}

    every = [(a, b) for a, b in itertools.combinations(signed, 2) if bin(at[a] ^ at[b]).count("1") <= radius]
    assert roots(map(tuple, found)) == roots(every)


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (500, 502), (7, 7)]
    random.Random(4).shuffle(chain)
    got = dict(rows(simhash.components(spark.createDataFrame(chain, "a long, b long"))))
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}
