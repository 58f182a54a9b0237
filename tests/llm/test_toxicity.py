"""FTRL: held-out accuracy, sparsity, and odd rows."""

import numpy as np
import pytest

from spoorlens.llm import toxicity
from spoorlens.llm.queries import op2_toxicity_ftrl


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    out = op2_toxicity_ftrl(spark, folder)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in toxic]) > 0.8
    assert np.mean([r["predicted"] for r in clean]) < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert out.count() == 10_000


def fitted(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "x", y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, score string, toxic int")
    labels = docs.select("doc_id", "toxic")
    return docs, toxicity.fit(toxicity.training_rows(docs, labels), **more)


def test_odd_rows_are_scored(spark):
    docs, model = fitted(spark, [("you vile brute", 1), ("a calm day", 0)] * 200)
    assert 0 < len(model.places) < 200
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "vile, BRUTE!"), (4, "calm"), (None, "you vile brute"), (5, "day " * 100_000), (5, "calm")],
        "doc_id long, text string",
    )
    got = [tuple(r) for r in toxicity.score(odd, model).collect()]
    assert len(got) == 7
    by = dict(got[:4])
    assert by[1] == by[2] and by[3] > 0.5 > by[4]
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]


def test_training_rows_are_bounded_and_merged(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(50)] + [(3, 1)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert len(rows) == 50 and [r["label"] for r in rows if r["text"] == "t3"] == [1.0]
    assert toxicity.training_rows(docs, labels, most=7).count() == 7


@pytest.mark.parametrize("l1", [0.5, 4.0])
def test_one_step_of_ftrl_matches_the_formulas(l1):
    f = toxicity.Ftrl(alpha=0.5, beta=1.0, l1=l1, l2=0.1)
    z, n = np.array([-5.0, 0.2, 1.0]), np.array([4.0, 1.0, 9.0])
    w = []
    for i in range(3):
        if i < 2 and abs(z[i]) <= l1:
            w.append(0.0)
        else:
            shrink = np.sign(z[i]) * l1 - z[i] if i < 2 else -z[i]
            w.append(shrink / ((1 + np.sqrt(n[i])) / 0.5 + 0.1))
    g = 1 / (1 + np.exp(-sum(w))) - 1.0
    want_z = [z[i] + g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / 0.5 * w[i] for i in range(3)]
    f.learn(z, n, np.array([0, 1, 2]), 1.0)
    assert np.allclose(z, want_z) and np.allclose(n, np.array([4.0, 1.0, 9.0]) + g * g)
