"""Benchmark passages against a comparison of every window with every item."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spoorlens.llm import decontamination as d


def words(text):
    return [w for w in re.split(d.BREAK, (text or "").lower()) if w]


def jaccard(a, b):
    x = Counter(tuple(a[i:i + 5]) for i in range(len(a) - 4))
    y = Counter(tuple(b[i:i + 5]) for i in range(len(b) - 4))
    top = sum((x & y).values())
    return top / (sum(x.values()) + sum(y.values()) - top)


def brute(docs, items):
    """Best similarity of each pair that reaches the threshold."""
    out = {}
    for k, t in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            if len(v) < 5:
                continue
            best = max((jaccard(w[p:p + len(v)], v) for p in range(len(w) - len(v) + 1)), default=0)
            if best >= 0.8:
                out[k, i] = max(best, out.get((k, i), 0))
    return out


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([5, 8, 14, 20, 30, 45, 60]))) for i in range(30)] + [(90, "too short"), (91, None), (92, "")]
    items += [(93, "a b a b a b a b a b a b"), (5, items[5][1])]
    docs = [(0, None), (1, ""), (2, "w1 w2"), (3, "a b a b a b a b a b a b a"), (4, "a b " * 200)]
    for k in range(10, 90):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            w = items[rng.randrange(30)][1].split()
            change = rng.random()
            at = rng.randrange(len(w))
            if change < 0.3:
                w[at] = "changed"
            elif change < 0.5:
                w.insert(at, "more")
            elif change < 0.6:
                del w[at]
            parts += [rng.choice([" ", ", ", "\n"]).join(w).title(), text(rng.randint(0, 20))]
        docs.append((k, " ".join(parts)))
    return docs + [(200, docs[20][1]), (20, docs[20][1]), (20, docs[30][1])], items


@pytest.mark.parametrize("seed,looked_up", [(1, 20_000), (2, 3)])
def test_matches_brute_force(spark, monkeypatch, seed, looked_up):
    monkeypatch.setattr(d, "LOOKED_UP", looked_up)
    docs, items = cases(seed)
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, item_id int, k int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.matches(df, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    assert len(got) == len(rows)
    want = brute(docs, items)
    # The fingerprint bounds what is found: all within the radius, and nothing else.
    for pair, s in got.items():
        assert abs(want[pair] - s) < 1e-12
    missing = {p for p in want if p not in got}
    assert len(missing) <= 0.02 * len(want), (missing, len(want))
    assert {p for p in want if want[p] == 1.0} <= set(got)
    assert all(r["bits"] <= d.RADIUS for r in rows)


def test_least_in_line():
    assert d.least_in_line(1) == 1
    for k in range(1, 200):
        assert 1 <= d.least_in_line(k) <= k


def test_null_keys_and_nothing(spark):
    text = " ".join(f"x{i}" for i in range(20))
    docs = spark.createDataFrame([(None, "so " + text), (3, "clean words only here and there")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [tuple(r)[:4] for r in d.matches(docs, bench).collect()] == [(None, 1, 1, 20)]
    assert d.matches(docs.limit(0), bench).count() == 0
    assert d.matches(docs, bench.limit(0)).count() == 0


def test_passages_cut_at_the_ends_of_a_text(spark):
    rng = random.Random(5)
    items = [(n, [f"i{n}x{j}" for j in range(n)]) for n in (13, 14, 23, 24, 30, 45, 60)]
    docs, parts = [], {}
    for n, w in items:
        for cut in (0, 1, 2):
            for rest in (0, 1, 40):
                for end in ("front", "back", "both"):
                    around = [f"r{rng.getrandbits(60)}" for _ in range(rest)]
                    if end == "front":
                        text = w[cut:] + around
                    elif end == "back":
                        text = around + w[:n - cut]
                    else:
                        text = w[cut:n - cut]
                    parts[len(docs)] = text
                    docs.append((len(docs), " ".join(text)))
    want = {}
    for k, t in parts.items():
        for n, w in items:
            size = min(n, len(t))
            s = max(jaccard(t[p:p + size], w) for p in range(len(t) - size + 1))
            if s >= 0.8:
                want[k, n] = s, size
    rows = d.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string"),
    ).collect()
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["words"]) for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want)
    for pair, (s, size) in got.items():
        assert abs(s - want[pair][0]) < 1e-12 and size == want[pair][1]

    def bits(words):
        hashes = spark.createDataFrame([(" ".join(words),)], "text string")
        return d.shingled(hashes).select(d.fingerprint(F.col("shingles")).alias("p")).first()["p"]

    for k, n in set(want) - set(got):
        w, t, size = dict(items)[n], parts[k], want[k, n][1]
        starts = [p for p in range(len(t) - size + 1) if jaccard(t[p:p + size], w) >= 0.8]
        assert all(bin((bits(t[p:p + size]) ^ bits(w)) & (2**64 - 1)).count("1") > d.RADIUS for p in starts), (k, n)
