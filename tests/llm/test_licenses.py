"""Licence scan: notices in the tables, variants that the fit has not seen, plain lines."""

import random

import pytest

from spoorlens.llm import licenses
from spoorlens.llm.queries import op1_license_scan

# As they stand in the test tables.
NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
}


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(20)) for _ in range(300)]
    return licenses.fit(lines)


def test_every_notice_of_the_table_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = {r["doc_id"]: sorted({f for n, f in NOTICES.items() if n in r["text"]}) for r in docs}
    got = {r["doc_id"]: r["families"] for r in op1_license_scan(spark, "/root/testdata/sf0.01").collect()}
    assert sum(map(bool, want.values())) > 30
    assert got == want


def test_changed_notices(spark, model):
    texts = {
        1: "intro line\nThis project is licensed under the terms of the MIT license, see below.\nend",
        2: "  LICENSED UNDER CC BY-NC 4.0!  ",
        3: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published",
        4: "The driver lost a license. Nothing was released under the bridge.",
        5: "Licensed under CC BY 4.0.\nReleased under the MIT License.",
        6: None,
        7: "",
        8: "word " * 100_000,
        9: "The general public was licensed under a new version of the law.",
    }
    docs = spark.createDataFrame([*texts.items(), (None, texts[2]), (1, texts[1])], "doc_id long, text string")
    rows = licenses.scan(docs, model).collect()
    got = {r["doc_id"]: r["families"] for r in rows}
    assert len(rows) == 11
    assert got == {1: ["mit"], 2: ["cc-by-nc-4.0"], 3: ["gpl-3.0"], 4: [], 5: ["cc-by-4.0", "mit"], 6: [], 7: [], 8: [], 9: [], None: ["cc-by-nc-4.0"]}
    first = next(r for r in rows if r["doc_id"] == 1)
    assert first["paragraph"] == 1 and first["probability"] > 0.5 and first["similarity"] >= 0.8 and first["n_paragraphs"] == 3
    assert licenses.scan(docs.limit(0), model).count() == 0


def test_unknown_takes_what_is_left(model):
    import numpy as np

    chance = licenses.probabilities(np.array([[-9.0] * len(licenses.FAMILIES), [9.0] + [-9.0] * (len(licenses.FAMILIES) - 1)]), model)
    assert np.allclose(chance.sum(axis=1), 1)
    assert chance[0].argmax() == len(licenses.FAMILIES) and chance[1].argmax() == 0


def test_several_notices_and_notices_in_long_lines(spark, model):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    notice = "Released under the MIT License."
    long_one = licenses.TEMPLATES["gpl-3.0"][1]
    texts = {
        1: ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", ["apache-2.0", "mit"]),
        2: (f"{prose(900)} {notice} {prose(700)}", ["mit"]),
        3: (f"{prose(333)} {long_one} {prose(2000)} Licensed under CC BY 4.0. {prose(5)}", ["cc-by-4.0", "gpl-3.0"]),
        4: (prose(5000), []),
        **{10 + n: (template, [family]) for n, (family, template) in enumerate((f, t) for f, ts in licenses.TEMPLATES.items() for t in ts)},
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.scan(docs, model).collect()}
    assert got == {k: want for k, (_, want) in texts.items()}


def test_windows_hold_every_template_whole():
    longest = max(len(licenses.tokens(t)) for ts in licenses.TEMPLATES.values() for t in ts)
    assert licenses.WINDOW // 2 >= longest
    for n in (1, 60, 61, 120, 121, 500):
        parts, lines = licenses.paragraphs(" ".join(f"w{i}" for i in range(n)) + "\n\nend")
        held = [set(p) for p, line in zip(parts, lines) if line == 0]
        assert set().union(*held) == {f"w{i}".encode() for i in range(n)} and max(map(len, parts)) <= licenses.WINDOW
        assert lines[-1] == 2 and parts[-1] == [b"end"]
