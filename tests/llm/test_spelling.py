"""Spelling variants against plain comparison of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import rows
from spoorlens.llm import spelling
from spoorlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def brute(docs):
    """Near words by deletion: two words are near if one is the other without a code point,
    or both are the same without the one at the same place."""
    words = brute_words(docs)
    near = {w: set() for w in words}
    places = {}
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            if short in words:
                near[w].add(short)
                near[short].add(w)
            places.setdefault((i, short), []).append(w)
    for group in places.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def got(df):
    return sorted(rows(df, "word", "form", "root", "n", "n_near", "form_n"))


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def test_acceptors_enumerate_each_pair_once():
    rng = np.random.default_rng(2)
    for size, letters in ((4, "ab"), (5, "abc"), (3, "abcdefgh")):
        for _ in range(60):
            short = sorted({"".join(rng.choice(list(letters), size)) for _ in range(30)})
            long = sorted({"".join(rng.choice(list(letters), size + 1)) for _ in range(30)})
            machine = spelling.Acceptors()
            q, r = machine.add(short), machine.add(long)
            assert machine.sizes[q] == len(short) and machine.sizes[r] == len(long)
            pairs = machine.by_replacing(q)
            assert sorted(pairs) == [(i, j) for i in range(len(short)) for j in range(i + 1, len(short)) if distance_one(short[i], short[j])]
            pairs = machine.by_inserting(q, r)
            assert sorted(pairs) == [(i, j) for i in range(len(short)) for j in range(len(long)) if distance_one(short[i], long[j])]


def test_states_are_minimal():
    machine = spelling.Acceptors()
    machine.add(["aax", "aay", "bax", "bay", "cax", "cay"])
    assert len(machine.arcs) == 4  # final, before x or y, before a, initial


@pytest.mark.parametrize("most", [(1000, 250_000), (3, 250_000), (1, 250_000), (1000, 40)])
def test_near_words_equal_brute_force(spark, most):
    rng = np.random.default_rng(11)
    words = {"".join(rng.choice(list("abé"), rng.integers(5, 9))) for _ in range(500)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "abcdefghij", "abcdefghi", "bcdefghij", "abcdefghijk", "w" * 2000, "w" * 2001}
    docs = [(i, " ".join([w.replace("a", "A") if i % 2 else w for w in words for _ in range(int(rng.integers(1, 4)))])) for i in range(6)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, word string")
    assert got(spelling.spelling_variants(frame, most_words=most[0], most_points=most[1])) == brute(docs)


def test_chains_lead_to_their_root(spark):
    counts = {"abcdefgh": 400, "abcdefgx": 160, "abcdefyx": 70, "abcdezyx": 30, "abcdezy": 12, "bcdezy": 3, "abcdezyxx": 30, "tieaa": 3, "tieab": 6, "tieac": 6}
    docs = [(None, " ".join(w for w, n in counts.items() for _ in range(n)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert got(spelling.spelling_variants(frame)) == want
    roots = {r[0]: r[2] for r in want}
    assert len(set(roots.values())) < len(roots) and max(r[4] for r in want) > 1


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "1234 \t"), (None, "Ähnlich ähnlich ÄHNLICH Straße straße strasse"), (4, "x" * 50_000 + " " + "x" * 50_001), (4, "Word" * 9)] * 3
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(spelling.spelling_variants(frame)) == brute(docs)
    assert got(spelling.spelling_variants(frame.limit(0))) == []


def test_query_on_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert got(QUERIES["op11_spelling_variants"](spark, FOLDER)) == want and any(r[1] for r in want)
