"""Repeated word windows by suffix automata of reference shards.

A window is ``width`` consecutive words of a document. Words covered by a window that
also starts in a document with a smaller key are removed.

The reference is the corpus itself. So that each document meets only the shards that can
match it, windows are routed by content: a window belongs to the anchor that its lowest
hashed 4-gram is, equal windows thus to equal anchors, and consecutive windows with one
anchor make a segment. Anchors that occur once match nothing and end there. The distinct
segments of an anchor, with the lowest key of each, form the reference; a shard is a run
of anchors with a bounded number of words, and gets one suffix automaton. The segments
of documents are streamed through it, and matching statistics give the lowest key that
holds each window. That builds every automaton in the task that reads it, where sending
each automaton to all documents would take a pass over the corpus per shard.

An anchor with more than ``ANCHOR_SEGMENTS`` distinct segments would outgrow its shard.
Its segments are cut to single windows, which meet by a 128-bit hash; nothing is left out.

Equal word sequences are one document with a lowest key: later ones are covered whole.
Null texts have no words. Rows without a key come after all others. Repeated rows do not
remove each other, as their keys are equal. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm.common import Staging, named_texts, squeezed, text_of, unsqueezed
from spoorlens.llm.hashing import WordIds, combine
from spoorlens.llm.ranks import rerank
from spoorlens.operators.skew import keyed_join

WIDTH = 13
GRAM = 4
SHARD_WORDS = 60_000
ANCHOR_SEGMENTS = 4_000
LAST_KEY = (1 << 63) - 1
PLACE_MASK = np.uint64((1 << 30) - 1)  # a text has fewer words than that


def segments(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and end of windows of each segment."""
    grams = combine([ids[i:len(ids) - GRAM + 1 + i] for i in range(GRAM)], 50)
    choice = width - GRAM + 1
    # Lowest of each ``choice`` values in a row, by minima over 1, 2, 4, ... of them. The
    # place is in the low bits, counted down, so that the last of several equal hashes
    # wins, which is the same one in every copy of the window.
    places = np.arange(len(grams), dtype=np.uint64)
    lowest = (grams & ~PLACE_MASK) | (PLACE_MASK - places)
    reach = 1
    while reach < choice:
        step = min(reach, choice - reach)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        reach += step
    anchor = (PLACE_MASK - (lowest & PLACE_MASK)).astype(np.int64)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    return grams[anchor[starts]], starts, np.append(starts[1:], len(anchor))


class Automaton:
    """Suffix automaton of several word sequences; a state knows the lowest key of the
    documents in which its strings end."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.key = [LAST_KEY]

    def _state(self, length: int, key: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.key.append(key)
        return len(self.link) - 1

    def _split(self, at: int, word: bytes, whole: int, key: int) -> int:
        """The part of state ``whole`` that ``at`` leads to by ``word``, as its own state."""
        part = self._state(self.length[at] + 1, key)
        self.next[part] = dict(self.next[whole])
        self.link[part] = self.link[whole]
        self.link[whole] = part
        while at != -1 and self.next[at].get(word) == whole:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def add(self, words: list[bytes], key: int) -> None:
        length, link, follow = self.length, self.link, self.next
        last = 0
        for word in words:
            there = follow[last].get(word)
            if there is not None:  # the string is known: its end counts for this key too
                if length[there] != length[last] + 1:
                    there = self._split(last, word, there, key)
                elif key < self.key[there]:
                    self.key[there] = key
                last = there
                continue
            made = self._state(length[last] + 1, key)
            at = last
            while at != -1 and word not in follow[at]:
                follow[at][word] = made
                at = link[at]
            if at != -1:
                whole = follow[at][word]
                link[made] = whole if length[whole] == length[at] + 1 else self._split(at, word, whole, LAST_KEY)
            last = made

    def settle(self) -> None:
        """Give each state the lowest key of all states whose strings end in its own."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            above = self.link[state]
            if self.key[state] < self.key[above]:
                self.key[above] = self.key[state]

    def lowest_keys(self, words: list[bytes], width: int) -> list[int]:
        """For each window of ``words`` the lowest key of a document that holds it.

        Goes along the words with the longest suffix that the reference knows."""
        length, link, follow = self.length, self.link, self.next
        state = matched = 0
        out = []
        for n, word in enumerate(words, 1):
            while state and word not in follow[state]:
                state = link[state]
                matched = length[state]
            if word in follow[state]:
                state = follow[state][word]
                matched += 1
            while length[link[state]] >= width if state else False:
                state = link[state]
                matched = length[state]
            if n >= width:
                out.append(self.key[state] if matched >= width else LAST_KEY)
        return out


def _words(text: bytes, ids: WordIds) -> tuple[list[bytes], np.ndarray]:
    words = text.split()  # bytes: exactly the six characters that end a word
    return words, np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))


def _parse(docs: DataFrame, width: int) -> DataFrame:
    schema = "uid long, key long, t1 long, t2 long, s1 long, s2 long, n_words long, whole string, anchors array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        ids = WordIds()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column("text"):
                words, numbers = _words(text.as_py().encode(), ids)
                joined = b" ".join(words)
                name = np.frombuffer(xxhash.xxh3_128_digest(joined), np.int64)
                anchors = segments(numbers, width)[0].view(np.int64) if len(words) >= width else []
                row = [uid, int(name[0]), int(name[1]), len(words), hashlib.sha256(joined).hexdigest(), anchors]
                uid += 1
                for column, value in zip(out, row):
                    column.append(value)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], long), *[batch.column(c) for c in ("key", "t1", "t2")], pa.array(out[1], long), pa.array(out[2], long),
                 pa.array(out[3], long), pa.array(out[4], pa.string()), pa.array(out[5], pa.list_(long))],
                ["uid", "key", "t1", "t2", "s1", "s2", "n_words", "whole", "anchors"],
            )

    return named_texts(docs).mapInArrow(work, schema)


def _cut_segments(live: DataFrame, width: int) -> DataFrame:
    """The live segments of each document: what names them, first window, and their words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            ranks, firsts, sizes, names, words = [], [], [], [], []
            digest = xxhash.xxh3_128_digest
            for chosen, z in zip(batch.column("chosen"), batch.column("z")):
                parts, numbers = _words(unsqueezed(z.as_py()), ids)
                _, starts, ends = segments(numbers, width)
                i = chosen.values.field("i").to_numpy()
                joined = b" ".join(parts)
                at = np.cumsum([0, *[len(w) + 1 for w in parts]])
                cut = [joined[a:b] for a, b in zip(at[starts[i]].tolist(), (at[ends[i] + width - 1] - 1).tolist())]
                words += cut
                names += map(digest, cut)
                ranks.append(chosen.values.field("rank").to_numpy())
                firsts.append(starts[i])
                sizes.append(len(i))
            if not words:
                continue
            name = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            uid, key = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("uid", "key"))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in (np.concatenate(ranks), name[:, 0], name[:, 1], uid, key)],
                 pa.array(np.concatenate(firsts), pa.int32()), pa.array(words, pa.binary())],
                ["rank", "s1", "s2", "uid", "key", "first", "words"],
            )

    return live.mapInArrow(work, "rank long, s1 long, s2 long, uid long, key long, first int, words binary")


def _stream(reference: DataFrame, width: int, shard_words: int) -> DataFrame:
    """Lowest key per window of each distinct segment."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(shard: list[tuple]) -> pa.RecordBatch:
            automaton = Automaton()
            words = [r[3].split(b" ") for r in shard]
            for r, w in zip(shard, words):
                automaton.add(w, r[4])
            automaton.settle()
            best = [automaton.lowest_keys(w, width) for w in words]
            return pa.RecordBatch.from_arrays(
                [*[pa.array([r[i] for r in shard], pa.int64()) for i in range(3)], pa.array(best, pa.list_(pa.int64()))],
                ["rank", "s1", "s2", "best"],
            )

        shard: list[tuple] = []  # whole anchors
        size = 0
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("rank", "s1", "s2", "words", "key")]):
                if size >= shard_words and shard[-1][0] != r[0]:
                    yield answer(shard)
                    shard, size = [], 0
                shard.append(r)
                size += r[3].count(b" ") + 1
        if shard:
            yield answer(shard)

    ordered = reference.select("rank", "s1", "s2", "words", "key").repartition("rank").sortWithinPartitions("rank")
    return ordered.mapInArrow(work, "rank long, s1 long, s2 long, best array<long>")


def _by_window(reference: DataFrame, width: int) -> DataFrame:
    """The same for segments of crowded anchors: single windows meet by their hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for rank, s1, s2, key, words in zip(*[batch.column(c).to_pylist() for c in ("rank", "s1", "s2", "key", "words")]):
                parts = words.split(b" ")
                at = np.cumsum([0, *[len(w) + 1 for w in parts]]).tolist()
                for n in range(len(parts) - width + 1):
                    name = np.frombuffer(xxhash.xxh3_128_digest(words[at[n]:at[n + width] - 1]), np.int64)
                    for column, value in zip(out, (rank, s1, s2, key, n, int(name[0]), int(name[1]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], ["rank", "s1", "s2", "key", "n", "w1", "w2"]
            )

    names = ["rank", "s1", "s2"]
    windows = reference.select(*names, "key", "words").mapInArrow(
        work, "rank long, s1 long, s2 long, key long, n long, w1 long, w2 long"
    )
    lowest = windows.groupBy("w1", "w2").agg(F.min("key").alias("lowest"))
    return windows.join(lowest, ["w1", "w2"]).groupBy(*names).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "lowest"))), lambda x: x["lowest"]).alias("best")
    )


def repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
    shard_words: int = SHARD_WORDS, anchor_segments: int = ANCHOR_SEGMENTS,
) -> DataFrame:
    """Per document: key, n_words, n_removed, kept_sha256 and removed spans of words."""
    stage = Staging(docs.sparkSession)
    plain = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST_KEY)).alias("key"), text_of(text).alias("text"),
    )
    parsed = stage.put(_parse(plain, width), "parsed")
    anchors = parsed.select("uid", F.posexplode("anchors").alias("i", "k1"))
    found = rerank(anchors, ["k1"], ["uid", "i"], stage)
    rows = stage.put(parsed.drop("anchors"), "rows")
    stage.drop(parsed)
    # Equal sequences: the one with the lowest key stands for all.
    first = F.struct("key", "uid", "t1", "t2")
    classes = stage.put(
        rows.groupBy("s1", "s2").agg(F.min(first).alias("f")).select("s1", "s2", "f.key", "f.uid", "f.t1", "f.t2"), "classes"
    )
    # Anchors that repeat beyond the copies of one sequence.
    once = found.join(classes.select("uid"), "uid", "left_semi").withColumnRenamed("rank", "k1")
    again = rerank(once, ["k1"], ["uid", "i"], stage)
    stage.drop(found)
    chosen = again.groupBy("uid").agg(F.collect_list(F.struct("i", "rank")).alias("chosen"))
    asked = stage.put(classes.join(chosen, "uid").select("uid", "key", "t1", "t2", "chosen"), "asked")
    stage.drop(again)
    live = stage.put(
        squeezed(plain).join(asked, ["key", "t1", "t2"]).select("uid", "key", "chosen", "z").dropDuplicates(["uid"]), "live"
    )
    stage.drop(asked)
    cut = stage.put(_cut_segments(live, width), "segments")
    names = ["rank", "s1", "s2"]
    reference = stage.put(cut.groupBy(*names).agg(F.min("key").alias("key"), F.first("words").alias("words")), "reference")
    # Anchors that outgrow a shard: one row per so many segments at most.
    crowded = stage.put(
        reference.groupBy("rank").agg(F.count("*").alias("n")).filter(F.col("n") > anchor_segments)
        .select(F.col("rank").alias("crowd")), "crowded",
    )
    marked = keyed_join(reference, crowded, [("rank", "crowd")])
    streamed = stage.put(_stream(marked.filter("crowd IS NULL"), width, shard_words), "streamed")
    best = streamed.select(*names, "best")
    if not crowded.isEmpty():
        best = best.unionByName(_by_window(marked.filter("crowd IS NOT NULL").drop("crowd"), width))
    # Windows of a document whose lowest key is below its own, as starts.
    hits = cut.select(*names, "uid", "key", "first").join(best, names).select(
        "uid", F.filter(F.transform("best", lambda b, n: F.when(b < F.col("key"), F.col("first") + n)), lambda p: p.isNotNull()).alias("at")
    ).filter(F.size("at") > 0)
    starts = hits.groupBy("uid").agg(F.flatten(F.collect_list("at")).alias("at"))
    found_spans = live.select("uid", "z").join(starts, "uid")

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, removed, digests, spans = [], [], [], []
            for uid, at, z in zip(*[batch.column(c) for c in ("uid", "at", "z")]):
                words = unsqueezed(z.as_py()).split()
                gone = np.zeros(len(words) + 1, np.int64)
                places = np.unique(at.values.to_numpy())
                np.add.at(gone, places, 1)
                np.add.at(gone, places + width, -1)
                covered = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
                uids.append(uid.as_py())
                removed.append(int(covered.sum()))
                digests.append(hashlib.sha256(b" ".join(w for w, c in zip(words, covered.tolist()) if not c)).hexdigest())
                spans.append([{"a": a, "b": b} for a, b in edges.reshape(-1, 2).tolist()])
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, kind)],
                ["uid", "n_removed", "kept", "spans"],
            )

    verdicts = stage.put(
        found_spans.mapInArrow(verdict, "uid long, n_removed long, kept string, spans array<struct<a:int,b:int>>"), "verdicts"
    )
    stage.drop(live, cut, reference, streamed, crowded)
    known = classes.join(verdicts, "uid", "left").select("s1", "s2", F.col("key").alias("first_key"), "n_removed", "kept", "spans")
    none = F.array().cast("array<struct<a:int,b:int>>")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n_words").cast("int").alias("b")))
    copy = (F.col("key") > F.col("first_key")) & (F.col("n_words") >= width)
    return rows.join(known, ["s1", "s2"]).select(
        F.when(F.col("key") != LAST_KEY, F.col("key")).alias(key), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
