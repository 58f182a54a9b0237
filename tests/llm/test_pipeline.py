"""The pipeline stage by stage against brute force, and end to end."""

import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import plan
from spoorlens.llm.queries import QUERIES
from spoorlens.session import staged

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import test_alike as near  # noqa: E402
import test_decontamination as leaks  # noqa: E402
import test_packing as packs  # noqa: E402
import test_quality_rules as rules  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def good(text):
    n, chars, symbols, lines, again, repeats, capitals = rules.measured(text)
    return not (n < 10 or 100 * repeats > 20 * n or 100 * symbols > 30 * n or 100 * again > 30 * lines
                or chars < 2 * n or chars > 20 * n or 100 * capitals > 60 * chars)


def first_of_each(rows):
    """Rows whose text is the first of its component; doc_ids and texts are all different."""
    firsts = near.brute_firsts([(r[0], r[1]) for r in rows])
    return sorted((r for r in rows if r[0] in firsts), key=str)


def without_passages(rows):
    data = [(r[1] or "").encode() for r in rows]
    seen = {}
    for d in data:
        for p in range(len(d) - 399):
            w = d[p:p + 400]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r, d in zip(rows, data):
        hits = [p for p in range(len(d) - 399) if seen[d[p:p + 400]] > 1]
        gone = {x for p in hits for x in range(p, p + 400)}
        kept, at = "", 0
        text = (r[1] or "")
        for i, c in enumerate(text):
            size = len(c.encode())
            if not gone.issuperset(range(at, at + size)):
                kept += c
            at += size
        if kept.split():
            out.append((r[0], kept, r[2], r[3], len(kept)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs.append(staged(step(spark, docs[-1], FOLDER), "stage"))
    return docs


def test_stages_match_brute_force(spark, stages):
    for df in stages:
        assert df.columns == COLUMNS
    given = rows_of(stages[0])
    ruled = [r for r in given if good(r[1])]
    assert rows_of(stages[1]) == ruled and 0 < len(ruled) < len(given)
    single = first_of_each(ruled)
    assert rows_of(stages[2]) == single and len(single) < len(ruled)
    cut = without_passages(single)
    assert rows_of(stages[3]) == cut
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {k for k, _ in leaks.brute([(r[0], r[1]) for r in cut], items)}
    clean = [r for r in cut if r[0] not in bad]
    assert rows_of(stages[4]) == clean and bad


def test_run_packs_what_is_left(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r[0]: r[1] for r in rows_of(stages[4])}
    assert {r["doc_id"] for r in out} == set(texts)
    lengths = {}
    for r in out:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {k: len(packs.reference_ids(t)) for k, t in texts.items()}
    packs.placed_whole(out, 1024)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(120))
    docs = spark.createDataFrame(
        [(1, long, "en", "s", 1, 5), (1, long, "en", "s", 1, 5), (2, None, "en", "s", 1, 5), (None, long + " x y z", None, None, None, 5),
         (3, "", "en", "s", 0, 5), (4, " ".join(f"ü{i}" for i in range(400)), "en", "s", 1, 5)],
        "doc_id long, text string, lang string, source string, n_chars long, n_words int",
    )
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = staged(step(spark, docs, FOLDER), "stage")
        assert docs.columns[-1] == "n_words", name
    left = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    # Equal rows are one document, and the text without a doc_id is a near copy of it.
    assert [k for k, _ in left] == [1, 4] and left[0][1] == long
    empty = docs.filter(F.lit(False))
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, FOLDER).count() == 0


def test_columns_may_have_any_name(spark):
    """Names that the stages use themselves, and their values, come through unharmed."""
    extra = ["key", "t1", "t2", "_t1", "_t2", "n1", "n2", "id", "row", "spans", "first", "f1", "f2", "kept", "c", "h", "_held_at", "failed_bits"]
    passage = " ".join(f"shared{i}" for i in range(80))
    texts = [" ".join(f"w{k}x{i}" for i in range(150)) for k in range(5)]
    texts += [texts[0] + " more", texts[1] + " " + passage, passage + " " + texts[2][:500], None, ""]
    given = [(i, t, "en", "s", 1, *[f"{c}{i}" for c in extra]) for i, t in enumerate(texts)]
    columns = ["doc_id", "text", "lang", "source", "n_chars", *extra]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra))
    kept = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = staged(step(spark, docs, FOLDER), "stage")
        assert docs.columns == columns
        found = docs.collect()
        assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in extra)
        kept.append(sorted(r["doc_id"] for r in found))
    # Texts 1, 6 and 7 lie in others to the last byte, and of text 2 the end is left.
    assert kept == [[0, 1, 2, 3, 4, 5, 6, 7], [0, 1, 2, 3, 4, 6, 7], [0, 2, 3, 4], [0, 2, 3, 4]]
    assert "shared" not in "".join(r["text"] for r in found)
    assert corpus_pipeline.pack_sequences(spark, docs, FOLDER).count() >= 4


def test_rules_are_computed_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = plan(corpus_pipeline.apply_quality_rules(spark, docs, FOLDER))
    alone = plan(QUERIES["op5_quality_rules"](spark, FOLDER))
    for call in ("split(", "xxhash64("):
        assert text.count(call) <= 2 * alone.count(call), call
