"""Repeated byte strings against a table of all windows, and ranks against groups."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from spoorlens.llm import suffix_array
from spoorlens.llm.common import Staging
from spoorlens.llm.ranks import rerank


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter()
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]] += 1
    out = []
    for d in data:
        removed = bytearray(len(d))
        end = 0
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                for x in range(max(end, p), p + length):
                    removed[x] = 1
                end = p + length
        spans = sum(1 for i, x in enumerate(removed) if x and (i == 0 or not removed[i - 1]))
        kept = bytes(b for b, x in zip(d, removed) if not x)
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    passages = [words(rng, n, vocabulary) for n in (70, 75, 80, 90, 100, 160, 300)]
    texts = [None, "", "short", "x" * 399, "y" * 400, "y" * 401, "z" * 3000, "ab" * 700, words(rng, 2000, ["a", "b"])]
    for _ in range(60):
        parts = [words(rng, rng.randint(0, 120), vocabulary)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 4)
            parts += [p[cut:] if rng.random() < 0.5 else p[:len(p) - cut], words(rng, rng.randint(0, 60), vocabulary)]
        texts.append("".join(parts))
    # Exact and near copies, and repeats inside one text.
    for t in texts[12:20]:
        texts.append(t)
        if len(t) > 900:
            texts.append(t[:450] + "#" + t[450:])
            texts.append(t[1:] + t)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, uid int")
    got = {r["doc_id"]: r for r in suffix_array.repeats(docs).collect()}
    for i, want in enumerate(brute(texts, 400)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i
        assert sum(s["b"] - s["a"] for s in r["spans"]) == r["n_removed"]
    assert len(got) == len(texts)


def test_repeated_rows_and_null_keys(spark):
    rng = random.Random(9)
    long = words(rng, 150, ["one", "two", "three", "four", "five", "sixth"])
    rows = [(7, long)] * 4 + [(None, long), (None, None), (None, "q"), (8, long[5:] + "!"), (8, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.repeats(docs).collect())
    want = sorted((str(d), *b) for (d, _), b in zip(rows, brute([t for _, t in rows], 400)))
    assert got == want


def test_equal_rows_lead_for_the_passages_they_share(spark):
    rows = []
    for seed in range(40):
        rng = random.Random(seed)
        text, other = ("".join(rng.choice("abcdefghij ") for _ in range(20_000)) for _ in range(2))
        at, size = rng.randrange(500, 19_000), rng.randint(400, 450)
        key = None if seed % 2 else seed
        rows += [(key, text)] * 4 + [(1000 + seed, other[:9000] + text[at:at + size] + other[9000:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.repeats(docs).collect())
    assert got == sorted((str(d), *b) for (d, _), b in zip(rows, brute([t for _, t in rows], 400)))


def ends_of_passages():
    """Passages with other bytes, or some of the same, on either side of them."""
    rng = random.Random(5)
    texts = []
    for k, copies in enumerate([2, 2, 3, 9, 30]):
        passage = words(rng, 130, [f"w{k}x{i}" for i in range(200)])
        for c in range(copies):
            before, after = (words(rng, 40, [f"v{i}" for i in range(500)]) for _ in range(2))
            cut, more = rng.randint(0, 60), "same here " * (c % 3)
            texts.append(before + more + passage[cut:len(passage) - rng.randint(0, 60)] + more + after)
        texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("crowd", [500, 3])
def test_ends_of_passages_are_told_by_their_sides(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_array, "CROWD", crowd)
    sorted_alone = []

    def counting(rows, keys, place, stage, carry=()):
        if place == ["uid", "p"]:
            sorted_alone.append(rows.count())
        return rerank(rows, keys, place, stage, carry)

    monkeypatch.setattr(suffix_array, "rerank", counting)
    texts = ends_of_passages()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.repeats(docs).collect()}
    want = brute(texts, 400)
    assert got == dict(enumerate(want)) and sum(w[1] > 0 for w in want) > 40
    # Windows of few places are not hashed one by one.
    assert len(sorted_alone) == 1
    if crowd == 500:
        assert sorted_alone[0] < 1000


def test_equal_windows_of_a_stretch_go_on_once(spark, monkeypatch):
    """Texts that say a few words over and over hold no boundary, or no other ones."""
    sorted_alone = []

    def counting(rows, keys, place, stage, carry=()):
        if place == ["uid", "p"]:
            sorted_alone.append(rows.count())
        return rerank(rows, keys, place, stage, carry)

    monkeypatch.setattr(suffix_array, "rerank", counting)
    rng = random.Random(11)
    texts = ["x" * 3000, "y" * 400, "y" * 401, "z" * 399]
    for k in range(12):
        word = "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) + " "
        once = words(rng, 90, [f"u{i}" for i in range(400)])
        texts += [word * 700, once + word * 300, word * 200 + "!" + word * 200 + once]
    # What repeats in one text stands for itself in another, and once in a third.
    texts += [texts[7][:400], "q" + texts[10][3:403] + "q", texts[4][1:450]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.repeats(docs).collect()}
    assert got == dict(enumerate(brute(texts, 400)))
    assert len(sorted_alone) == 1 and sorted_alone[0] < 25_000, sorted_alone


def test_texts_are_judged_in_one_pass(spark, monkeypatch):
    """Sides, and what is known without them, come from one reading of the texts."""
    passes = []
    plain = suffix_array._arrow

    def counting(work, rows, schema):
        if "text" in rows.columns:
            passes.append(work.__name__)
        return plain(work, rows, schema)

    monkeypatch.setattr(suffix_array, "_arrow", counting)
    docs = spark.createDataFrame(list(enumerate(ends_of_passages())), "doc_id long, text string")
    assert suffix_array.repeats(docs).filter("n_removed > 0").count() > 40
    assert len(passes) == 3, passes


def test_places_of_a_run_against_all_their_windows():
    rng = random.Random(3)
    for turn in range(300):
        need = rng.randint(1, 12)
        places = []
        for _ in range(rng.randint(2, suffix_array.PAIRWISE)):
            n = rng.randint(1, min(9, need + 1))
            side = bytes(rng.choice(b"ab" if turn % 2 else b"aaaab") for _ in range(need + n - 1))
            places.append(suffix_array.Place(rng.randint(n - 1, need), n, side))
        windows = [{d: (d, x.side[x.d - d:x.d - d + x.need]) for d in range(x.least, x.d + 1)} for x in places]
        seen = Counter(w for found in windows for w in found.values())
        suffix_array._meet_all(places)
        for x, found in zip(places, windows):
            assert {d for low, high in x.found for d in range(low, high + 1)} == {d for d, w in found.items() if seen[w] > 1}


def test_no_documents(spark):
    assert suffix_array.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table_at_the_smallest_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    want = brute([r["text"] for r in rows], 400)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array.repeats(docs).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, want)}


@pytest.mark.parametrize("n,keys", [(0, 5), (1, 1), (400, 1), (400, 40), (600, 2000)])
def test_ranks(spark, n, keys):
    rng = random.Random(n)
    rows = [(rng.randrange(keys), rng.randrange(3), i, i * 2) for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "a long, b long, p long, c int")
        out = rerank(df, ["a", "b"], ["p"], Staging(spark), ["c"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups, ranks = defaultdict(set), defaultdict(set)
    for a, b, p, _ in rows:
        groups[a, b].add(p)
    for r in out:
        ranks[r["rank"]].add(r["p"])
        assert r["c"] == r["p"] * 2
    assert [ranks[x] for x in sorted(ranks)] == [groups[k] for k in sorted(groups) if len(groups[k]) > 1]
