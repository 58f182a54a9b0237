"""The byte transducer and the audit against plain loops; the query has SQL."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.llm import filter_audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORDS.findall(text)
    return (len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)))


def counted(texts):
    data = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, data)])
    found = filter_audit.counts(np.frombuffer(b"".join(data) + bytes(8), np.uint8), ends)
    return list(zip(*[found[name].tolist() for name in filter_audit.COUNTS]))


def test_transducer_equals_plain_counts():
    rng = np.random.default_rng(5)
    letters = list("aabbAZ#$%&*| \n\t\x0b\x0c\r-") + ["é", "日", "🙂", " ", "\x00"]
    texts = ["", " ", "a", "a a A a", "x" * 90 + " " + "x" * 90 + " " + "x" * 89 + "y", "é é  日 日", "one"]
    texts += ["".join(rng.choice(letters, rng.integers(0, 200))) for _ in range(300)]
    texts += [" ".join("w" * int(n) + str(n % 3) for n in rng.integers(1, 120, 300)), "z" * 100_000, "ab " * 50_000]
    assert counted(texts) == [brute_counts(t) for t in texts]
    assert counted([]) == [] and counted(["", ""]) == [(0, 0, 0, 0, 0)] * 2


def test_spans_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit, "_mixed", lambda h: h * np.uint64(0))
    texts = ["a b c a b dd dd ee " + "long" * 30 + " " + "long" * 29 + "lonG " + "long" * 30, "a b", "a a"]
    assert counted(texts) == [brute_counts(t) for t in texts]


def brute_audit(docs, labels):
    masks = []
    for key, text, part in docs:
        text = text or ""
        n, distinct, points, capitals, symbols = brute_counts(text)
        copy = key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in docs)
        failed = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * points, symbols > 0, copy]
        good = any(k == key and k is not None and q == 1 for k, q, _ in labels)
        toxic = any(k == key and k is not None and x == 1 for k, _, x in labels)
        masks.append((part or "", {c for c, f in zip("ABCDE", failed) if f}, good, toxic))
    out, shares = [], {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                late = [m for m in own if letter in m[1] and m[1] & set(order[:step - 1])]
                only = [m for m in own if m[1] == {letter}]
                shares[part, letter] = shares.get((part, letter), 0) + len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(late), len(only),
                            sum(m[2] for m in gone), sum(m[3] for m in gone), letter))
    return sorted((*r[:-1], shares[r[0], r[-1]]) for r in out)


def test_odd_rows_equal_brute_force(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, words, "s"), (2, words, "s"), (2, words, "s"), (3, words, None), (None, words, "s"), (None, words, "t"),
        (4, None, "t"), (5, "", ""), (6, "A# b", "t"), (6, "A# b", "s"), (7, "a " * 100, "t"), (8, words.upper(), "s"),
        (9, words + " #", "s"), (10, words + " x", "u"), (-5, words.upper(), "u"), (11, "x" * 200_000, "s"),
    ]
    labels = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (6, None, 1), (None, 1, 1), (10, 1, None), (99, 1, 1)]
    frame = spark.createDataFrame(
        [(*d, "x", 7, 8, 9) for d in docs], "doc_id long, text string, source string, part string, n long, t1 long, mask int"
    )
    marks = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, key string")
    got = rows(filter_audit.audit(frame, marks))
    assert got == brute_audit(docs, labels)
    assert filter_audit.audit(frame.filter(F.lit(False)), marks).count() == 0
    assert {r[8] for r in rows(filter_audit.audit(frame, marks.limit(0)))} == {0}
