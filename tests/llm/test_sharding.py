"""Histogram sort: balanced bytes, gapless slots, hot texts and repeated rows."""

import zlib

import pytest

from spoorlens.llm import sharding

CASES = {
    "plain": [(i, "x" * (i % 50)) for i in range(2000)],
    "hot text": [(i, "same text") for i in range(1500)] + [(i, f"own {i}") for i in range(500)],
    "repeated rows": [(7, "same row")] * 900 + [(None, None)] * 300 + [(i, "") for i in range(100)],
    "one long text": [(0, "y" * 200_000)] + [(i, "z" * 20) for i in range(1, 400)],
    "few": [(1, "a"), (2, None)],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_shards(spark, name):
    docs = spark.createDataFrame([(d, t, "s") for d, t in CASES[name]], "doc_id long, text string, slot string")
    out = sharding.shard_documents(docs, shards=8).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(CASES[name], key=str)
    sizes = [0] * 8
    slots = [[] for _ in range(8)]
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    if out:
        largest = max(r["size"] for r in out)
        want = sum(sizes) / 8
        assert max(abs(s - want) for s in sizes) <= 2 * max(largest, 0.001 * want)


def test_query_columns(spark):
    from spoorlens.llm.queries import op10_histogram_sharding

    out = op10_histogram_sharding(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in out.collect():
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert out.count() == len(texts)
