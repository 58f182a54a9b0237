"""Documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written as Parquet and read again, and all
but the last return the columns of ``documents``. ``run`` applies them to a folder of
tables. A verdict belongs to a text, by its 128-bit name, whatever its doc_id:

1. quality rules: documents that fail a rule of the policy go
2. near-duplicates, by SimHash and then by five-word shingles of which 0.8 or more agree:
   the lowest doc_id of each component stays
3. repeated passages: bytes in strings of 400 that occur elsewhere are cut, whole
   characters at a time, and a document without a word left goes
4. benchmark decontamination: documents that hold a benchmark item go
5. packing into sequences of 1024 tokens

Null texts fail the quality rules. A row without a doc_id comes after those that have
one; equal rows are one document from stage 2 on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spoorlens.llm import alike, decontamination, packing, quality_rules, suffix_array
from spoorlens.llm.common import Staging, held_together, ship, text_of

# Hashes, tokens and packing have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    judged = quality_rules.apply_policy(quality_rules.ledger(rows, keep=("row",)))
    return held_together(judged, "kept").select("row.*")


def by_text(docs: DataFrame) -> DataFrame:
    """Whole rows in a struct, so that names of their columns clash with none here, with
    doc_id, text and the 128-bit name of the text."""
    text = text_of()
    return docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text).alias("n1"), F.xxhash64(F.lit(1), text).alias("n2"),
    )


def same_text() -> Column:
    return (F.col("n1") == F.col("t1")) & (F.col("n2") == F.col("t2"))


def plain_id(name: str) -> list[Column]:
    """An id that may be null as two columns that are not."""
    return [F.coalesce(name, F.lit(0)).alias("id_or_0"), F.col(name).isNull().alias("no_id")]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = alike.first_of_each(docs.select("doc_id", "text"))
    leads = F.col("key").eqNullSafe(F.col("first")) & (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2"))
    # The keys of the join are plain columns, so that its exchange of whole rows serves
    # the removal of equal rows as well.
    names = found.filter(leads).select(F.col("t1").alias("n1"), F.col("t2").alias("n2"), *plain_id("key")).distinct()
    same = ["n1", "n2", "id_or_0", "no_id"]
    kept = by_text(docs).select("row", "n1", "n2", *plain_id("id")).join(names, same, "left_semi")
    return kept.dropDuplicates(same).select("row.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = suffix_array.repeats(docs.select("doc_id", "text"))
    spans = found.filter("n_removed > 0").select("t1", "t2", "spans").dropDuplicates(["t1", "t2"])
    joined = by_text(docs).join(spans, same_text(), "left").select("row", "spans")
    at, schema = docs.columns.index("text"), docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row").flatten()
            texts = columns[at].to_pylist()
            for i, found in enumerate(batch.column("spans").to_pylist()):
                if found:
                    data = texts[i].encode()
                    whole = [suffix_array.whole_characters(data, s["a"], s["b"]) for s in found]
                    texts[i] = suffix_array.keep_outside(data, [s for s in whole if s[0] < s[1]]).decode()
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    left = joined.mapInArrow(cut, schema)
    # A document that held no passage stays as it is.
    return left.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontamination.matches(docs.select("doc_id", "text"), items, by_text=True).select("t1", "t2").distinct()
    return by_text(docs).join(bad, same_text(), "left_anti").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs.select("doc_id", "text")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", apply_quality_rules),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is staged."""
    stage = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        after = stage.put(step(spark, docs, sf_dir), name.replace(" ", "-"))
        stage.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
