"""Near-duplicate texts by exact Jaccard similarity of five-word shingles.

Two texts link if their sets of shingles are ``4 / 5`` alike or more. Texts that SimHash
links (``simhash``: fingerprints, deletion variants, forest of each bucket) are compared
whole first, and those that are alike make the first components. A copy with changed
words is often more than three bits away, so what is still apart meets by shingles, and
no pair is lost: the shingles of every text are put in one order, and two texts this
alike share one of the first n - ceil(4n/5) + 1 of n (prefix filter).
What two can share is bounded by their lengths, by how many of these shingles they share
and by the place of the last one, as anything else they share comes after it, and by
prints, a parity bit per so many shingles; pairs that the bounds leave are compared
whole. Any order gives the same result; here shingles that are frequent in a sample come
last, so that common lines bring few texts together.

Where many texts meet, a crowd, all are compared with the first one. Those that are then
in another component than a member that their prints do not tell apart are brought
together with their sets, and the task that has them gives a spanning forest of their
links: rows go with the number of texts of a crowd, not with its pairs.
Texts with equal sets are merged before. Sets are kept as 64-bit hashes.

Words are as in ``simhash``: bytes between white space, A to Z lowered. A text of fewer
than five words is one shingle; texts without a word are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm import simhash
from spoorlens.llm.common import Staging, text_of
from spoorlens.llm.simhash import components
from spoorlens.operators.skew import fits_in_memory

SHINGLE = 5
# Texts of which the frequent shingles are taken, and how often one occurs there.
SAMPLE = 10_000
FREQUENT = 4
LISTED = 100_000
# Texts to be compared whole are looked up by broadcast up to so many, three longs each.
NAMED_ROWS = 4_000_000
# Where more texts meet they are compared in steps.
MEET = 16
# Texts of a crowd that all others of it are compared with first.
LEADERS = 1
# Texts up to which sets are compared one by one, without an index of their shingles.
FEW = 8


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the different shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(SHINGLE, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b]) for a, b in zip(starts.tolist(), ends[k - 1:].tolist())]
    return np.unique(np.array(hashes, dtype=np.uint64).view(np.int64))


def parities(found: np.ndarray) -> bytes:
    """A bit for every shingle hash modulo a power of two, at least the number of shingles
    and 256: whether an odd number of them fall there. Two prints differ in no more bits
    than there are shingles in one set only. Halves of a print give the next smaller one."""
    bits = 256
    while bits < len(found):
        bits *= 2
    odd = np.bincount((found & (bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.empty(0, np.int64))


def _sets(texts: DataFrame) -> DataFrame:
    """Class and shingles of (text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py().encode()) for t in batch.column("text")]
            names = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), _lists(found)], ["c", "set"])

    return texts.mapInArrow(work, "c long, set array<long>")


def _as_bytes(sets: DataFrame) -> DataFrame:
    """Sets as bytes of their hashes, which take a task the least time to read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [s.values.to_numpy().tobytes() for s in batch.column("set")]
            yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(packed, pa.binary())], ["c", "set"])

    return sets.mapInArrow(work, "c long, set binary")


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of different texts, and how often."""
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    sample = texts.filter(F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    counted = (
        _sets(sample).dropDuplicates(["c"]).select(F.explode("set").alias("h")).groupBy("h").count()
        .filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "h").limit(LISTED)
    )
    listed = sorted((r["h"], r["count"]) for r in counted.collect())
    return np.array([h for h, _ in listed], np.int64), np.array([n for _, n in listed], np.int64)


def _prefixes(rows: DataFrame, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Key and name of the text of every row, its class, its number of shingles, those by
    which it meets others, its print and its SimHash fingerprint."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = shared.value
        for batch in batches:
            names, sizes, firsts, marks, simhashes = [], [], [], [], []
            for text in batch.column("text"):
                data = text.as_py().encode()
                found = shingles(data)
                simhashes.append(simhash.fingerprint(data))
                n = len(found)
                if len(listed) and n:
                    at = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
                    often = np.where(listed[at] == found, counts[at], 0)
                    ordered = found[np.lexsort((found, often))]
                else:
                    ordered = found
                names.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(n)
                marks.append(parities(found))
                firsts.append(ordered[: n - (4 * n + 4) // 5 + 1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "t1", "t2")), pa.array(np.array(names, np.uint64).view(np.int64)),
                 pa.array(sizes, pa.int32()), _lists(firsts), pa.array(marks, pa.binary()),
                 pa.array(np.array(simhashes, np.uint64).view(np.int64))],
                ["key", "t1", "t2", "c", "n", "firsts", "print", "simhash"],
            )

    return rows.mapInArrow(work, "key long, t1 long, t2 long, c long, n int, firsts array<long>, print binary, simhash long")


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of rows that are sorted by the first one, whole groups at a time."""
    held: list[list[np.ndarray]] = []  # parts of the last group, which can go on
    for batch in batches:
        if len(batch) == 0:
            continue
        now = [
            np.array(batch.column(x).to_pylist(), object) if pa.types.is_binary(batch.column(x).type)
            else batch.column(x).to_numpy().astype(np.int64) for x in columns
        ]
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last == 0 and (not held or held[-1][0][-1] == now[0][0]):
            held.append(now)
            continue
        whole = [np.concatenate(x) for x in zip(*held, [x[:last] for x in now])]
        if len(whole[0]):
            yield whole
        held = [[x[last:] for x in now]]
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _met(rows: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) of different components that share an h of (h, c, n, at,
    label), with sizes and places (n, at of a; m, to of b), a row per h. Where more than
    ``MEET`` meet, only pairs with the first, and the rows themselves with b null."""
    names = ["h", "a", "b", "n", "at", "m", "to"]

    def pairs_of(c, n, at, labels, i, j):
        may = (9 * np.minimum(n[i], n[j]) >= 4 * (n[i] + n[j])) & (labels[i] != labels[j])
        i, j = i[may], j[may]
        turned = c[i] > c[j]
        i, j = np.where(turned, j, i), np.where(turned, i, j)
        return c[i], c[j], n[i], at[i], n[j], at[j]

    def members(h, c, n, at):
        none = pa.nulls(len(h), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), none, pa.array(n), pa.array(at), none, none], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, c, n, at, labels in _groups(batches, ["h", "c", "n", "at", "label"]):
            cuts = np.flatnonzero(np.diff(h)) + 1
            lo = np.concatenate(([0], cuts))
            size = np.diff(np.append(lo, len(h)))
            found = []
            small = size <= MEET
            # Small groups together: neighbours at every distance.
            for step in range(1, MEET):
                of = np.repeat(np.where(small, size, 0), size)
                place = np.arange(len(h)) - np.repeat(lo, size)
                i = np.flatnonzero(place + step < of)
                if len(i) == 0:
                    break
                found.append(pairs_of(c, n, at, labels, i, i + step))
            for g in np.flatnonzero(~small).tolist():
                own = np.arange(lo[g], lo[g] + size[g])
                if (labels[own] == labels[own[0]]).all():
                    continue
                # The lowest classes lead: in all groups of near copies they are mostly the same ones.
                for k, lead in enumerate(own[:LEADERS].tolist()):
                    rest = own[k + 1:]
                    found.append(pairs_of(c, n, at, labels, np.full(len(rest), lead), rest))
                yield members(h[own], c[own], n[own], at[own])
            if found:
                arrays = [pa.array(np.concatenate(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(arrays[0]), pa.int64()), *arrays], names)

    dealt = rows.select("h", "c", "n", "at", "label").repartition("h").sortWithinPartitions("h", "c")
    return dealt.mapInArrow(work, ", ".join(f"`{x}` long" for x in names))


class Crowd:
    """The classes that meet by one shingle, sorted by class, and which may be alike."""

    def __init__(self, c, n, at, labels, prints):
        self.c, self.n, self.at, self.labels = c, n, at, labels
        self.words = np.array([len(p) // 8 for p in prints])
        own = [np.frombuffer(p, np.uint64) for p in prints]
        # Prints by length; those twice as long are folded to be compared with shorter ones.
        self.tables = {}
        for w in np.unique(self.words).tolist():
            which = np.flatnonzero((self.words == w) | (self.words == 2 * w))
            self.tables[w] = which, np.stack([own[k] if len(own[k]) == w else own[k][:w] ^ own[k][w:] for k in which.tolist()])
        self.own = own

    def partners(self, i: int) -> np.ndarray:
        """Members of other components that may be alike to member i."""
        out = []
        w = int(self.words[i])
        for size in (w, w // 2):
            if size not in self.tables:
                continue
            which, table = self.tables[size]
            mine = self.own[i] if size == w else self.own[i][:size] ^ self.own[i][size:]
            if size != w:  # the others were compared at their own length
                shorter = self.words[which] == size
                which, table = which[shorter], table[shorter]
            both = self.n[i] + self.n[which]
            shared = -(-4 * both // 9)  # at least so many
            may = (self.labels[which] != self.labels[i]) & (np.minimum(self.n[i] - self.at[i], self.n[which] - self.at[which]) >= shared)
            which, table = which[may], table[may]
            differ = np.bitwise_count(table ^ mine).sum(axis=1)
            out.append(which[differ <= (both - 2 * shared)[may]])
        return np.concatenate(out)


def _still_open(rows: DataFrame) -> DataFrame:
    """The rows (h, c, label) of (h, c, n, at, label, print) that share their h with a class
    of another component that may be alike."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, c, n, at, labels, prints in _groups(batches, ["h", "c", "n", "at", "label", "print"]):
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(h)) + 1, [len(h)]))
            left = np.zeros(len(h), bool)
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                kinds, kind = np.unique(labels[x:y], return_inverse=True)
                if len(kinds) == 1:
                    continue
                crowd = Crowd(c[x:y], n[x:y], at[x:y], labels[x:y], prints[x:y])
                # Members of the largest component are met from the other side.
                largest = np.bincount(kind).argmax()
                for i in np.flatnonzero(kind != largest).tolist():
                    found = crowd.partners(i)
                    if len(found):
                        left[x + i] = True
                        left[x + found] = True
            if left.any():
                yield pa.RecordBatch.from_arrays([pa.array(v[left]) for v in (h, c, labels)], ["h", "c", "label"])

    dealt = rows.select("h", "c", "n", "at", "label", "print").repartition("h").sortWithinPartitions("h", "c")
    return dealt.mapInArrow(work, "h long, c long, label long")


class Postings:
    """Which of some members have a shingle."""

    def __init__(self, members: np.ndarray, sets: list[np.ndarray]):
        self.members, self.sets = members, sets
        if len(members) > FEW:
            values = np.concatenate([sets[i] for i in members.tolist()])
            order = np.argsort(values, kind="stable")
            self.values = values[order]
            self.owners = np.repeat(members, [len(sets[i]) for i in members.tolist()])[order]

    def shared(self, one: np.ndarray) -> np.ndarray:
        """Shingles that each member shares with a set; others have zero."""
        out = np.zeros(len(self.sets), np.int64)
        if len(self.members) <= FEW:
            for i in self.members.tolist():
                out[i] = len(np.intersect1d(one, self.sets[i], assume_unique=True))
            return out
        first = np.searchsorted(self.values, one, "left")
        size = np.searchsorted(self.values, one, "right") - first
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.bincount(self.owners[at], minlength=len(out))


def forest(labels: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all members that are alike, as far as their components do not."""
    sizes = np.array([len(s) for s in sets])
    left = np.arange(len(sets))
    index = Postings(left, sets)
    out, queue = [], []
    while len(left):
        if not queue:
            own = labels[left] == labels[left[0]]
            queue, left = left[own].tolist(), left[~own]
            continue
        at = queue.pop()
        if 2 * len(left) < len(index.members):
            index = Postings(left, sets)
        found = left[9 * index.shared(sets[at])[left] >= 4 * (sizes[left] + sizes[at])]
        if len(found):
            kinds, first = np.unique(labels[found], return_index=True)
            out += [(at, j) for j in found[first].tolist()]
            joined = np.isin(labels[left], kinds)
            queue += left[joined].tolist()
            left = left[~joined]
    return out


def _links_in_crowds(rows: DataFrame) -> DataFrame:
    """Links (a, b) of (h, c, label, set) in each crowd, by all shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, c, labels, sets in _groups(batches, ["h", "c", "label", "set"]):
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(h)) + 1, [len(h)]))
            a, b = [], []
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for i, j in forest(labels[x:y], [np.frombuffer(s, np.int64) for s in sets[x:y]]):
                    a.append(c[x + i])
                    b.append(c[x + j])
            if a:
                one, two = np.array(a), np.array(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["a", "b"])

    return rows.repartition("h").sortWithinPartitions("h", "c").mapInArrow(work, "a long, b long")


def _bounded(met: DataFrame) -> DataFrame:
    """All pairs of classes that met, with ``may`` false where the shingles by which they
    met show that they are not alike."""
    pairs = met.filter("b IS NOT NULL").groupBy("a", "b", "n", "m").agg(
        F.count("*").alias("shared"), F.min("at").alias("first_a"), F.min("to").alias("first_b"),
        F.max("at").alias("last_a"), F.max("to").alias("last_b"),
    )
    # Where many met, not every pair has a row: as many as that may be shared besides.
    crowds = met.filter("b IS NULL").groupBy("a").agg(F.count("*").alias("crowd"))
    for side in ("a", "b"):
        pairs = pairs.join(crowds.select(F.col("a").alias(side), F.col("crowd").alias(f"crowd_{side}")), side, "left")
    besides = F.least(F.coalesce("crowd_a", F.lit(0)), F.coalesce("crowd_b", F.lit(0)))
    after = F.least(F.col("n") - F.col("last_a"), F.col("m") - F.col("last_b")) - 1
    most = F.least(F.col("shared") + after, F.least(F.col("n") - F.col("first_a"), F.col("m") - F.col("first_b"))) + besides
    return pairs.select("a", "b", (9 * most >= 4 * (F.col("n") + F.col("m"))).alias("may"))


def told_apart(n: int, one: bytes, m: int, two: bytes) -> bool:
    """Whether prints show that sets of n and m shingles are not alike."""
    short = min(len(one), len(two))

    def folded(mark: bytes) -> int:
        bits, size = int.from_bytes(mark, "little"), len(mark)
        while size > short:
            size //= 2
            bits = (bits >> 8 * size) ^ (bits & ((1 << 8 * size) - 1))
        return bits

    shared = -(-4 * (n + m) // 9)  # at least so many, if alike
    return (folded(one) ^ folded(two)).bit_count() > n + m - 2 * shared


def _open(pairs: DataFrame, prefixes: DataFrame, stage: Staging) -> DataFrame:
    """The pairs of classes that their prints do not tell apart, so that few sets are needed."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    marks = stage.put(prefixes.select("c", "n", "print").join(wanted, "c", "left_semi").dropDuplicates(["c"]), "marks")
    one = marks.select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("print").alias("print_a"))
    two = marks.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("print").alias("print_b"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("n_a", "print_a", "n_b", "print_b")]
            left = pa.array([not told_apart(*row) for row in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(left)

    found = stage.put(pairs.join(one, "a").join(two, "b").mapInArrow(work, "a long, b long"), "open")
    stage.drop(marks)
    return found


def _sets_of(wanted: DataFrame, prefixes: DataFrame, rows: DataFrame, stage: Staging) -> DataFrame:
    """Shingles of the classes ``wanted`` (c). One row of each class gives them."""
    one_row = F.min(F.struct("t1", "t2", "key")).alias("r")
    named = stage.put(
        prefixes.join(wanted, "c", "left_semi").groupBy("c").agg(one_row)
        .select("c", F.col("r.t1").alias("w1"), F.col("r.t2").alias("w2"), F.col("r.key").alias("w")), "named",
    )
    same = (F.col("t1") == F.col("w1")) & (F.col("t2") == F.col("w2")) & F.col("key").eqNullSafe(F.col("w"))
    chosen = rows.join(F.broadcast(named) if fits_in_memory(named, NAMED_ROWS) else named, same)
    # Equal rows give one. Texts are exchanged for that, as their shingles take more room.
    sets = stage.put(_sets(chosen.select("c", "text").dropDuplicates(["c"]).select("text")), "sets")
    stage.drop(named)
    return sets


def _alike(pairs: DataFrame, prefixes: DataFrame, rows: DataFrame, stage: Staging) -> DataFrame:
    """The pairs of classes that are alike, by all their shingles."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), prefixes, rows, stage)
    one = sets.select(F.col("c").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("c").alias("b"), F.col("set").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(one, "a").join(two, "b")
    found = stage.put(both.filter(9 * shared >= 4 * (F.size("set_a") + F.size("set_b"))).select("a", "b"), "alike")
    stage.drop(sets)
    return found


def _by_fingerprint(prefixes: DataFrame, stage: Staging) -> DataFrame:
    """Pairs of classes (a, b) that connect all that SimHash links: classes of one
    fingerprint with the first of them, and the first ones of linked fingerprints."""
    known = stage.put(prefixes.filter("n > 0").select("simhash", "c").distinct(), "fingerprints")
    firsts = stage.put(known.groupBy("simhash").agg(F.min("c").alias("lead")), "leads")
    same = known.join(firsts, "simhash").select(F.col("c").alias("x"), F.col("lead").alias("y"))
    linked = simhash.links(firsts.select(F.col("simhash").alias("print"))).distinct()
    one = firsts.select(F.col("simhash").alias("a"), F.col("lead").alias("x"))
    two = firsts.select(F.col("simhash").alias("b"), F.col("lead").alias("y"))
    near = linked.join(one, "a").join(two, "b").select("x", "y")
    pairs = same.unionByName(near).filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    found = stage.put(pairs.distinct(), "linked")
    stage.drop(known, firsts)
    return found


def _merged(reached: DataFrame, links: DataFrame, stage: Staging) -> DataFrame:
    """Components after further links."""
    edges = reached.select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = stage.put(components(edges.unionByName(links)), "reached")
    stage.drop(reached, links)
    return joined


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and 128-bit name of the text (t1, t2) of every row, and those of the first row
    of its component (first, f1, f2): the lowest key, null last, then the lowest name.
    Equal rows count once."""
    stage = Staging(docs.sparkSession)
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))
    named = plain.select("*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    prefixes = stage.put(_prefixes(named, _frequent(plain.select("text"))), "prefixes")
    linked = _by_fingerprint(prefixes, stage)
    first_links = _alike(linked, prefixes, named, stage)
    reached = stage.put(components(first_links), "reached")
    stage.drop(linked, first_links)
    label = F.coalesce("component", "c").alias("label")
    classes = prefixes.select("c", "n", "firsts").filter("n > 0").dropDuplicates(["c"])
    labelled = classes.join(reached.withColumnRenamed("node", "c"), "c", "left").select("c", "n", "firsts", label)
    met = stage.put(_met(labelled.select("c", "n", "label", F.posexplode("firsts").alias("at", "h"))), "met")
    pairs = stage.put(_bounded(met), "pairs")
    near = _open(pairs.filter("may").select("a", "b"), prefixes, stage)
    stage.drop(pairs)
    reached = _merged(reached, _alike(near, prefixes, named, stage), stage)
    stage.drop(near)
    large = met.filter("b IS NULL").select("h", F.col("a").alias("c"), "n", "at")
    if not large.isEmpty():
        crowds = large.select("c").distinct()
        marks = prefixes.select("c", "print").join(crowds, "c", "left_semi").dropDuplicates(["c"])
        labels = marks.join(reached.withColumnRenamed("node", "c"), "c", "left").select("c", "print", label)
        left = stage.put(_still_open(large.join(labels, "c")), "open")
        if not left.isEmpty():
            sets = _sets_of(left.select("c").distinct(), prefixes, named, stage)
            whole_sets = left.join(_as_bytes(sets), "c").select("h", "c", "label", "set")
            reached = _merged(reached, stage.put(_links_in_crowds(whole_sets), "links"), stage)
            stage.drop(sets)
        stage.drop(left)
    stage.drop(met)
    whole = stage.put(
        prefixes.select("key", "t1", "t2", "c").distinct().join(reached.withColumnRenamed("node", "c"), "c", "left")
        .select("key", "t1", "t2", F.coalesce("component", "c").alias("component")), "members",
    )
    stage.drop(prefixes, reached)
    order = F.struct(F.col("key").isNull().alias("no"), F.col("key").alias("first"), F.col("t1").alias("f1"), F.col("t2").alias("f2"))
    leads = whole.groupBy("component").agg(F.min(order).alias("m"))
    return whole.join(leads, "component").select("key", "t1", "t2", "m.first", "m.f1", "m.f2")
