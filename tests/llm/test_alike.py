"""Near-duplicates by Jaccard similarity against a comparison of all pairs."""

import itertools
import random
import tempfile

import numpy as np
import pytest

import corpus_pipeline
from spoorlens.llm import alike


def shingle_set(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute_firsts(rows):
    """Lowest key of each component of (key, text)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])) > 0:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return {min(rows[j][0] for j in range(len(rows)) if root(j) == r) for r in {root(i) for i in range(len(rows))}}


def corpus(seed):
    rng = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [None, "", " \n", "one", "One", "one two three", "a b c d e f", "x " * 300]

    def text(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    def changed(w, times):
        w = list(w)
        for _ in range(times):
            at = rng.randrange(len(w))
            kind = rng.random()
            w[at:at + (kind < 0.7)] = [] if kind < 0.2 else [f"new{rng.random()}"]
        return w

    for n in (30, 60, 200, 200, 500):
        base = text(n)
        texts.append(" ".join(base))
        texts += [" ".join(changed(base, rng.randint(1, max(2, n // 30)))) for _ in range(8)]
    # Large groups: tight, and at the bound.
    for n, most, members in ((100, 1, 40), (120, 3, 40)):
        base = text(n)
        texts += [" ".join(changed(base, rng.randint(1, most))) for _ in range(members)]
    texts += [" ".join(text(rng.randint(5, 60))) + " " + common for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,meet", [(1, 16), (2, 3), (3, 16)])
def test_stage_matches_all_pairs(spark, monkeypatch, seed, meet):
    monkeypatch.setattr(alike, "MEET", meet)
    monkeypatch.setattr(alike, "FREQUENT", 4 if seed < 3 else 10**6)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert got == brute_firsts(rows)


@pytest.mark.parametrize("n,changes", [(200, 1), (200, 2), (200, 4), (500, 5), (500, 10)])
def test_copies_with_changed_words_go(spark, n, changes):
    rng = random.Random(n + changes)
    rows = []
    for k in range(0, 60, 2):
        w = [f"w{rng.randrange(9999)}" for _ in range(n)]
        other = list(w)
        for at in rng.sample(range(n), changes):
            other[at] = f"new{rng.random()}"
        rows += [(k, " ".join(w)), (k + 1, " ".join(other))]
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert got == set(range(0, 60, 2))


def test_verdicts_follow_the_text_not_the_doc_id(spark):
    rng = random.Random(8)

    def text(n):
        return [f"w{rng.randrange(9999)}" for _ in range(n)]

    a, b, c, d, item = text(150), text(150), text(150), text(150), text(20)
    leak = " ".join(c[:50] + item + c[50:])
    rows = [
        (None, " ".join(a)), (None, " ".join(a + ["end"])), (None, " ".join(a)),
        (5, " ".join(b)), (5, " ".join(b + ["end"])), (None, " ".join(["begin"] + b)), (5, " ".join(d)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert len(got) == 3 and (5, rows[6][1]) in got
    assert sum(k is None for k, _ in got) == 1 and sum(k == 5 for k, _ in got) == 2
    assert not {t for k, t in got if k is None} & {rows[5][1]}
    folder = tempfile.mkdtemp(prefix="run-")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame([(None, leak), (None, rows[0][1]), (5, leak), (5, rows[3][1])], "doc_id long, text string")
    left = {tuple(r) for r in corpus_pipeline.drop_benchmark_passages(spark, docs, folder).collect()}
    assert left == {(None, rows[0][1]), (5, rows[3][1])}


def test_prints_bound_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(300):
        sizes = rng.integers(1, 1500, 3)
        common, one, two = [rng.integers(-2**63, 2**63 - 1, k) for k in sizes]
        x, y = np.unique(np.concatenate((common, one))), np.unique(np.concatenate((common, two)))
        prints = [np.frombuffer(alike.parities(s), np.uint64) for s in (x, y)]
        while len(prints[0]) != len(prints[1]):
            k = int(len(prints[1]) > len(prints[0]))
            half = len(prints[k]) // 2
            prints[k] = prints[k][:half] ^ prints[k][half:]
        assert int(np.bitwise_count(prints[0] ^ prints[1]).sum()) <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("few, leaders", [(0, 1), (2, 2), (8, 8)])
def test_turns_find_all_links_of_crowds(spark, monkeypatch, few, leaders):
    monkeypatch.setattr(alike, "FEW", few)
    monkeypatch.setattr(alike, "LEADERS", leaders)
    monkeypatch.setattr(alike, "MEET", 3)
    rng = random.Random(7)
    # Chains of near copies, each alike to the next ones only, behind one common passage.
    texts = []
    for base in range(3):
        words = [f"b{base}w{i}" for i in range(60)]
        for step in range(9):
            texts.append(" ".join(["same", "five", "words", "come", "first", *words]))
            words[rng.randrange(60)] = f"n{base}x{step}"
    texts += [" ".join(["same", "five", "words", "come", "first", *[f"o{k}w{i}" for i in range(30)]]) for k in range(8)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["first"] for r in alike.first_of_each(frame).collect()}
    assert found == brute_firsts(rows)


def test_prints_never_tell_alike_sets_apart():
    rng = np.random.default_rng(5)
    apart = 0
    for n in (1, 4, 30, 250, 256, 257, 300, 2_000, 40_000):
        for shared in (1.0, 0.96, 0.9, 0.89, 0.7, 0.2):
            both = rng.integers(-(1 << 63), 1 << 63, size=int(n * shared))
            one, two = (np.unique(np.concatenate((both, rng.integers(-(1 << 63), 1 << 63, size=extra)))) for extra in (n - len(both), (n - len(both)) // 2))
            if not len(one) or not len(two):
                continue
            told = alike.told_apart(len(one), alike.parities(one), len(two), alike.parities(two))
            is_alike = 9 * len(np.intersect1d(one, two)) >= 4 * (len(one) + len(two))
            assert not (told and is_alike)
            apart += told
    assert apart >= 8


def test_stage_goes_through_simhash(spark, monkeypatch):
    """What fingerprints link is taken from them; only what is alike stays linked."""
    rng = random.Random(11)
    rows = []
    for k in range(0, 40, 2):
        w = [f"w{rng.randrange(9999)}" for _ in range(300)]
        rows += [(k, " ".join(w)), (k + 1, " ".join([*w, "end"]))]
    # One shingle many times over gives both the same fingerprint; few of their shingles are the same.
    rows += [(40, "a a a " * 200 + " ".join(f"x{i}" for i in range(40))), (41, "a a a " * 200 + " ".join(f"y{i}" for i in range(40)))]
    calls, given = [], alike.simhash.links
    monkeypatch.setattr(alike.simhash, "links", lambda prints, *a, **k: calls.append(prints.count()) or given(prints, *a, **k))
    found = []
    pairs_of = alike._by_fingerprint
    monkeypatch.setattr(alike, "_by_fingerprint", lambda *a: found.append(pairs_of(*a).collect()) or pairs_of(*a))
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert calls and len(found[0]) >= 15
    assert got == brute_firsts(rows) == {*range(0, 42, 2), 41}


@pytest.mark.parametrize("few", [0, 8, 100])
def test_forest_connects_what_is_alike(monkeypatch, few):
    monkeypatch.setattr(alike, "FEW", few)
    rng = np.random.default_rng(few)
    for size in (1, 2, 5, 60):
        base = rng.integers(-(1 << 62), 1 << 62, 90)
        sets = [np.unique(np.concatenate((rng.permutation(base)[:rng.integers(78, 91)], rng.integers(0, 1 << 62, rng.integers(0, 12))))) for _ in range(size)]
        sets += [np.unique(rng.integers(0, 1 << 62, 50)) for _ in range(3)]
        labels = rng.integers(0, size + 1, len(sets))

        def parts(links):
            root = list(range(len(sets)))

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i

            same = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if labels[i] == labels[j]]
            for i, j in [*links, *same]:
                root[max(find(i), find(j))] = min(find(i), find(j))
            return [find(i) for i in range(len(sets))]

        links = alike.forest(labels, sets)
        every = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
                 if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))]
        assert set(links) <= {*every, *[(j, i) for i, j in every]}
        assert parts(links) == parts(every) and len(links) < len(set(labels.tolist()))
