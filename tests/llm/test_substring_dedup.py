"""Repeated word windows against a table of all windows."""

import hashlib
import random

import pytest

from spoorlens.llm import substring_dedup as s


def brute(rows, width=13):
    docs = [(k if k is not None else s.LAST_KEY, (t or "").encode().split()) for k, t in rows]
    lowest = {}
    for k, w in docs:
        for p in range(len(w) - width + 1):
            name = tuple(w[p:p + width])
            lowest[name] = min(k, lowest.get(name, k))
    out = []
    for (key, _), (k, w) in zip(rows, docs):
        gone = set()
        for p in range(len(w) - width + 1):
            if lowest[tuple(w[p:p + width])] < k:
                gone.update(range(p, p + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ü."]
    few = ["a", "b"]

    def text(n, v=vocabulary):
        return " ".join(rng.choice(v) for _ in range(n))

    passages = [text(n) for n in (12, 13, 14, 20, 40, 200)]
    rows = [(0, None), (1, ""), (2, "one"), (3, text(12)), (4, "the " * 300), (5, "the " * 200), (6, text(400, few)), (7, text(400, few))]
    for i in range(10, 110):
        parts = [text(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            p = p[rng.randint(0, 3):]
            parts += [" ".join(p), text(rng.randint(0, 30))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(200 + i, rows[20 + i][1]) for i in range(8)] + [(300 + i, rows[30 + i][1].replace("w7", "x", 1)) for i in range(20)]
    rows += [(15, rows[40][1]), (15, rows[40][1]), (None, rows[41][1]), (None, rows[41][1]), (None, text(30)), (-5, rows[50][1] + " end")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,limits", [(1, {}), (2, {"shard_words": 100}), (3, {"anchor_segments": 2})])
def test_matches_brute_force(spark, seed, limits):
    rows = corpus(seed)
    docs = spark.createDataFrame([(k, t, "c", 1) for k, t in rows], "doc_id long, text string, key string, rank int")
    out = s.repeated_windows(docs, **limits).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out), key=str)
    assert got == brute(rows)
    assert all(sum(x["b"] - x["a"] for x in r["spans"]) == r["n_removed"] for r in out)


def test_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    out = s.repeated_windows(docs).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out), key=str) == want


def test_no_documents(spark):
    assert s.repeated_windows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_automaton_gives_lowest_keys(seed):
    rng = random.Random(seed)
    texts = [([rng.randrange(3) for _ in range(rng.randint(1, 40))], rng.randrange(10)) for _ in range(8)]
    a = s.Automaton()
    for w, k in texts:
        a.add(w, k)
    a.settle()
    for width in (1, 2, 4):
        query = [rng.randrange(4) for _ in range(60)]
        want = []
        for p in range(len(query) - width + 1):
            part = query[p:p + width]
            want.append(min((k for w, k in texts if any(w[q:q + width] == part for q in range(len(w) - width + 1))), default=s.LAST_KEY))
        assert a.lowest_keys(query, width) == want
