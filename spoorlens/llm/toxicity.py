"""Toxicity by FTRL-proximal logistic regression.

Features are hashed word 1-grams, 2-grams and pairs with a word between (skip-grams),
and beginnings of words, present or not. FTRL-proximal keeps per coordinate the sum of squared gradients, which
sets its rate, and an adjusted gradient sum, from which the weight follows; its L1 term
leaves most weights at zero, so that what is broadcast is a short list.

The fit uses at most ``MAX_TRAIN`` labelled rows, chosen by hash of the key, in
``LEARNERS`` partitions at most. In each pass every partition learns from the common state and
the states are averaged: those coordinates whose gradient sum has come half way to a
weight, as n-grams of single texts would fill the table and never count. Scores read
every word of every text.

Null and empty texts get the score of the intercept. Labels with several rows per key
count as toxic if one does; null labels are not used. Repeated rows are scored one by
one. Without any labelled row all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm.common import Staging, text_of
from spoorlens.llm.hashing import WordIds, buckets, combine, ngrams, tokens

BITS = 20
MAX_TRAIN = 20_000
LEARNERS = 8
ROWS_PER_LEARNER = 500
PASSES = 5
STEMS = (4, 5)  # bytes at the beginning of words


@dataclass(frozen=True)
class Ftrl:
    """alpha and beta of the rates, and the strengths of L1 and L2."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, z: np.ndarray, n: np.ndarray, features: np.ndarray, label: float) -> None:
        """One row; the last place of the state is the intercept, which has no L1."""
        zf, nf = z[features], n[features]
        w = self.weights(zf, nf)
        w[-1] = -zf[-1] / ((self.beta + np.sqrt(nf[-1])) / self.alpha + self.l2)
        p = 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, w.sum()))))
        g = p - label
        z[features] = zf + g - (np.sqrt(nf + g * g) - np.sqrt(nf)) / self.alpha * w
        n[features] = nf + g * g


@dataclass(frozen=True)
class Model:
    """Places and values of the weights that are not zero, and the intercept."""

    places: np.ndarray
    values: np.ndarray
    intercept: float
    bits: int
    fitted: bool = True


def features_of(text: str, ids: WordIds, bits: int) -> np.ndarray:
    words = tokens(text)
    if not words:
        return np.empty(0, np.int64)
    numbers = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    parts = ngrams(numbers, 2, skip=True)
    # Words that share a stem: their beginnings, each once per text.
    for n in STEMS:
        starts = {w[:n] for w in words if len(w) >= n}
        if starts:
            parts.append(combine([np.fromiter(map(ids.__getitem__, starts), np.uint64, len(starts))], 200 + n))
    return buckets(np.concatenate(parts), bits)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """Text and label of at most ``most`` labelled documents, lowest hash of the key first.

    The keys are chosen from the labels alone, so that the texts are only filtered by a
    list of bounded size."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id"), text_of().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("double").alias("label"), F.xxhash64("doc_id", "text").alias("order"))


def fit(rows: DataFrame, ftrl: Ftrl = Ftrl(), bits: int = BITS, learners: int = LEARNERS, passes: int = PASSES) -> Model:
    """Fit on (text, label, order); the caller bounds the number of rows."""
    spark = rows.sparkSession
    stage = Staging(spark)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            found = [np.unique(features_of(t, ids, bits)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array(found, pa.list_(pa.int64()))], ["order", "label", "features"]
            )

    made = stage.put(rows.mapInArrow(extract, "order long, label double, features array<long>"), "features")
    known = made.count()
    if known == 0:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, bits, False)
    learners = min(learners, -(-known // ROWS_PER_LEARNER))
    examples = stage.put(made.repartition(learners, "order").sortWithinPartitions("order"), "examples")
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(passes):
        seen = np.flatnonzero(n)
        state = spark.sparkContext.broadcast((seen, z[seen], n[seen]))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places, common_z, common_n = state.value
            own_z, own_n = np.zeros(size), np.zeros(size)
            own_z[places], own_n[places] = common_z, common_n
            rows = 0
            for batch in batches:
                rows += len(batch)
                lists = batch.column("features")
                flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                for i, label in enumerate(batch.column("label").to_pylist()):
                    ftrl.learn(own_z, own_n, np.append(flat[at[i]:at[i + 1]], size - 1), label)
            if rows:
                # What is far from a weight, such as n-grams of one text, is forgotten.
                seen = np.append(np.flatnonzero(np.abs(own_z[:-1]) > ftrl.l1 / 2), size - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen), pa.array(own_z[seen]), pa.array(own_n[seen]), pa.array(np.full(len(seen), rows))],
                    ["place", "z", "n", "rows"],
                )

        learned = stage.put(examples.mapInArrow(learn, "place long, z double, n double, rows long"), "states")
        total = learned.filter(F.col("place") == size - 1).agg(F.sum("rows")).first()[0]
        # A learner that has no state for a coordinate counts as zero in the average.
        mean = learned.groupBy("place").agg(
            (F.sum(F.col("z") * F.col("rows")) / total).alias("z"), (F.sum(F.col("n") * F.col("rows")) / total).alias("n")
        ).toPandas()  # coordinates near or beyond a weight, 2 ** bits + 1 at the very most
        z, n = np.zeros(size), np.zeros(size)
        z[mean["place"]], n[mean["place"]] = mean["z"], mean["n"]
        stage.drop(learned)
        state.unpersist()
    weights = ftrl.weights(z[:-1], n[:-1])
    places = np.flatnonzero(weights)
    intercept = -z[-1] / ((ftrl.beta + np.sqrt(n[-1])) / ftrl.alpha + ftrl.l2)
    return Model(places, weights[places].astype(np.float32), float(intercept), bits)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = np.zeros(1 << m.bits, np.float32)
        table[m.places] = m.values
        ids = WordIds()
        for batch in batches:
            out = np.empty(len(batch))
            for i, t in enumerate(batch.column("text").to_pylist()):
                found = features_of(t, ids, m.bits)
                found = np.unique(found[table[found] != 0])
                out[i] = table[found].sum(dtype=np.float64) + m.intercept
            scores = 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))) if m.fitted else np.zeros(len(out))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores)], ["key", "score"])

    return rows.mapInArrow(work, "key long, score double").withColumnRenamed("key", key)


def is_held_out(key: str = "doc_id"):
    """Rows by which a fit is judged and from which it learns nothing."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0
