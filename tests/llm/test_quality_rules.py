"""Quality rules: measurements by hand, policies and ablations."""

from conftest import rows

from spoorlens.llm import quality_rules as q


def measured(text):
    import re

    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [line for line in t.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines),
            len(lines) - len(set(lines)), len(covered), len(re.findall("[A-Z]", t)))


TEXTS = [
    None, "", " \n\t ", "one two", "a b c d e a b c d e", "a a a a a a a a a a", "x\ny\nx\n\n\nx",
    "# $ % & | < > *", "Äpfel und Öl\x0bund\x0cmehr 😀 ends", "w " * 30_000, "WHY SHOUT SO LOUD AT THE END OF THE DAY NOW",
    "a b c d e f a b c d e g b c d e f h", " ".join(str(i) for i in range(5000)), "line\r\nline\r\nline",
]


def test_measures(spark):
    docs = spark.createDataFrame(
        [(i, t, 5, "z") for i, t in enumerate(TEXTS)] + [(None, "same", 1, "z"), (None, "same", 1, "z")],
        "doc_id long, text string, n_words long, lines string",
    )
    got = {r["doc_id"]: tuple(r[c] for c in q.MEASURES) for r in q.ledger(docs).collect() if r["doc_id"] is not None}
    assert got == {i: measured(t) for i, t in enumerate(TEXTS)}
    assert q.ledger(docs).count() == len(TEXTS) + 2


def test_policies_and_ablations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ledger = q.ledger(docs).cache()
    for policy, mask in q.POLICIES.items():
        kept = {r["doc_id"] for r in q.apply_policy(ledger, policy).filter("kept").collect()}
        bits = {r["doc_id"]: r["failed_bits"] for r in ledger.collect()}
        assert kept == {d for d, b in bits.items() if b & mask == 0}
        for r in q.ablations(ledger, policy).collect():
            assert r["failed"] == sum(b & r["bit"] != 0 for b in bits.values())
            assert r["kept"] == len(kept)
            assert r["kept_without_it"] == sum(b & mask & ~r["bit"] == 0 for b in bits.values())
            assert r["removed_by_it_alone"] == r["kept_without_it"] - r["kept"]


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows(q.apply_policy(q.ledger(docs))) == [] and rows(q.ablations(q.ledger(docs))) == []
