"""Spelling variants of a corpus' words, by composition of finite-state machines.

The words are the runs of Latin letters, A to Z lower-cased, that occur often enough. Two
words are near if one inserted, deleted or replaced code point lies between them, that is
if the vocabulary acceptor, composed with a one-edit transducer and the acceptor again,
accepts the pair. A word's form is its most frequent near word, if that is at least twice
as frequent, and its root is where forms lead to.

The composition is cut into partitions by the state that the acceptor is in before the
edit. Of a pair whose shorter word has m code points, either the first m // 2 agree or
all of the others; the second case is the first one for words read backwards. So a word
enters the partitions of its first and of its last half, once as the shorter and once as
the longer word. A partition builds the minimal acceptors of its words' rests, all states
in one register, and enumerates accepted pairs from the states: the edit comes where the
words part, so each pair is met once, and what follows the edit is the intersection of two
states' languages, which is kept per pair of states. Words are found by the number of
words that a state accepts. A partition gives, per word, the number of near words and the
best of them, never a list of pairs.

A partition of more than ``MOST_WORDS`` words or ``MOST_POINTS`` code points is cut by the
place of the edit and the states on both its sides: words agree in what is left when the
code point at that place is deleted. Such a group has a word per letter of the alphabet
and one more.

Null texts and texts without letters have no words; a null doc_id counts as an empty one.
Repeated rows count again. Ties between near words go to the smaller word in code-point
order. Only key and text are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.llm.common import Staging, text_of
from spoorlens.operators.skew import keyed_join

NO_LETTER = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 5
MIN_COUNT = 3
SLIP = 97
MOST_WORDS = 1000
MOST_POINTS = 250_000

# Kinds of groups.
ACCEPTOR, REPLACE, INSERT = 0, 1, 2


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    slip: int = SLIP,
) -> DataFrame:
    """Distinct words and how often they occur. In one of about ``slip`` runs, chosen by
    a checksum of key and run, one code point is left out."""
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.split(text_of(f"`{text}`"), NO_LETTER)).alias("run"),
    ).filter(F.length("run") >= min_length)
    # Words in lower case throughout are left as they are; lower() may change more letters.
    small = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    hashed = runs.select(small.alias("run"), F.crc32(F.concat("key", F.lit(":"), small).cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


class Acceptors:
    """Minimal acceptors of word lists, with one register of states.

    The words of a list have one length, so state 0, without arcs, is the only final one.
    A state's arcs lead to a state and to the number of words that come before.
    """

    def __init__(self):
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.sizes = [1]
        self.register: dict[tuple, int] = {(): 0}
        self.shared: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.replaced: dict[int, list[tuple[int, int]]] = {}
        self.inserted: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def add(self, words: list[str]) -> int:
        """Initial state of the acceptor of sorted, distinct words of one length."""
        path: list[dict[str, int]] = [{}]
        last = ""
        for word in words:
            same = 0
            while same < len(last) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path += [{} for _ in word[same:]]
            last = word
        self._close(path, last, 0)
        return self._state(path[0])

    def _close(self, path: list[dict[str, int]], word: str, depth: int) -> None:
        for at in range(len(path) - 1, depth, -1):
            path[at - 1][word[at - 1]] = self._state(path.pop())

    def _state(self, node: dict[str, int]) -> int:
        signature = tuple(node.items())
        found = self.register.get(signature)
        if found is None:
            found = self.register[signature] = len(self.arcs)
            before, arcs = 0, {}
            for letter, target in signature:
                arcs[letter] = (target, before)
                before += self.sizes[target]
            self.arcs.append(arcs)
            self.sizes.append(before)
        return found

    def common(self, q: int, r: int) -> list[tuple[int, int]]:
        """Strings that both states accept, as their numbers in each."""
        if q == r:
            return [(i, i) for i in range(self.sizes[q])]
        found = self.shared.get((q, r))
        if found is None:
            found, other = [], self.arcs[r]
            for letter, (target, before) in self.arcs[q].items():
                if letter in other:
                    opposite, skipped = other[letter]
                    found += [(i + before, j + skipped) for i, j in self.common(target, opposite)]
            self.shared[q, r] = found
        return found

    def by_replacing(self, q: int) -> list[tuple[int, int]]:
        """Pairs of words of one state that differ in one place."""
        found = self.replaced.get(q)
        if found is None:
            found, arcs = [], list(self.arcs[q].values())
            for k, (target, before) in enumerate(arcs):
                found += [(i + before, j + before) for i, j in self.by_replacing(target)]
                for opposite, skipped in arcs[k + 1:]:
                    found += [(i + before, j + skipped) for i, j in self.common(target, opposite)]
            self.replaced[q] = found
        return found

    def by_inserting(self, q: int, r: int) -> list[tuple[int, int]]:
        """Pairs of a word of q and one of r that has one code point more."""
        found = self.inserted.get((q, r))
        if found is None:
            found, short = [], self.arcs[q]
            for letter, (target, skipped) in self.arcs[r].items():
                if not short and not target:  # both words end
                    found.append((0, skipped))
                for other, (left, before) in short.items():
                    if other == letter:  # no edit here
                        found += [(i + before, j + skipped) for i, j in self.by_inserting(left, target)]
                    elif other in self.arcs[target]:
                        right, more = self.arcs[target][other]
                        found += [(i + before, j + skipped + more) for i, j in self.common(left, right)]
            self.inserted[q, r] = found
        return found


Found = dict[str, tuple[int, int, str]]  # near words, the best one's count, the best one


def _tell(found: dict[str, list], a: str, b: str, counts: dict[str, int]) -> None:
    for word, other in ((a, b), (b, a)):
        new = (-counts[other], other)
        held = found.get(word)
        if held is None:
            found[word] = [1, new]
        else:
            held[0] += 1
            if new < held[1]:
                held[1] = new


def accepted(words: dict[str, int], m: int, backwards: bool) -> dict[str, list]:
    """Near words of one partition, with words of m and m + 1 code points."""
    start = m - m // 2 if backwards else m // 2
    rests: dict[int, list[tuple[str, str]]] = {m: [], m + 1: []}
    for word in words:
        rests[len(word)].append(((word[::-1] if backwards else word)[start:], word))
    for own in rests.values():
        own.sort()
    short, long = rests[m], rests[m + 1]
    found: dict[str, list] = {}
    if not short:
        return found
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * m + 1000))
    machine = Acceptors()
    q = machine.add([rest for rest, _ in short])
    for i, j in machine.by_replacing(q):
        _tell(found, short[i][1], short[j][1], words)
    if long:
        r = machine.add([rest for rest, _ in long])
        for i, j in machine.by_inserting(q, r):
            a, b = short[i][1], long[j][1]
            if not backwards or a[:m // 2] != b[:m // 2]:
                _tell(found, a, b, words)
    return found


def around_one_place(kind: int, words: dict[str, int], m: int, backwards: bool, at: int) -> dict[str, list]:
    """Near words of a group that agree in all but the code point at one place."""
    found: dict[str, list] = {}
    ordered = sorted(words, key=lambda w: (-words[w], w))
    if kind == REPLACE:
        if len(ordered) > 1:
            for word in ordered:
                best = ordered[0] if word != ordered[0] else ordered[1]
                found[word] = [len(ordered) - 1, (-words[best], best)]
        return found
    for a in ordered:
        if len(a) != m:
            continue
        u = a[::-1] if backwards else a
        for b in ordered:
            if len(b) == m + 1:
                v = b[::-1] if backwards else b
                if u[at:at + 1] != v[at] and (not backwards or a[:m // 2] != b[:m // 2]):
                    _tell(found, a, b, words)
    return found


GROUP = ["kind", "backwards", "m", "at", "part"]


def _halves(words: DataFrame, min_length: int) -> DataFrame:
    """The four partitions of each word: halves, as shorter and as longer word."""
    size = F.length("word")

    def part(m: Column, backwards: bool) -> Column:
        half = F.floor(m / 2).cast("int")
        key = F.substring(F.reverse("word"), F.lit(1), m - half) if backwards else F.substring("word", F.lit(1), half)
        return F.struct(
            F.lit(ACCEPTOR).alias("kind"), F.lit(backwards).alias("backwards"), m.cast("int").alias("m"),
            F.lit(0).alias("at"), key.alias("part"),
        )

    own = [part(size, False), part(size, True)]
    both = F.when(size > min_length, F.array(*own, part(size - 1, False), part(size - 1, True))).otherwise(F.array(*own))
    return words.select(F.explode(both).alias("g"), "word", "n").select("g.*", "word", "n")


def _by_place(rows: DataFrame) -> DataFrame:
    """Rows of large partitions, by each place that an edit can have."""
    way = F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word"))
    half = F.floor(F.col("m") / 2).cast("int")
    first = F.when(F.col("backwards"), F.col("m") - half).otherwise(half)
    short = F.length("word") == F.col("m")

    def without(e: Column) -> Column:
        return F.concat(F.substring(F.col("way"), F.lit(1), e), F.substring(F.col("way"), e + 2, F.length("way")))

    def place(kind: int, e: Column, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), e.alias("at"), key.alias("part"))

    replaced = F.when(short, F.transform(F.sequence("first", F.col("m") - 1), lambda e: place(REPLACE, e, without(e))))
    gone = F.transform(F.sequence("first", "m"), lambda e: place(INSERT, e, F.when(F.col("short"), F.col("way")).otherwise(without(e))))
    each = F.explode(F.concat(F.coalesce(replaced, F.array().cast("array<struct<kind:int,at:int,part:string>>")), gone))
    return (
        rows.withColumns({"way": way, "first": first, "short": short})
        .select("backwards", "m", "word", "n", each.alias("p"))
        .select("p.kind", "backwards", "m", "p.at", "p.part", "word", "n")
    )


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups lie one after another; a group may go over several batches."""

    def rows() -> Iterable[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in [*GROUP, "word", "n"]])

    names = ["word", "n_near", "best_n", "best"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    out: list[list] = [[] for _ in names]
    for (kind, backwards, m, at, _), members in groupby(rows(), key=lambda r: r[:5]):
        words = {r[5]: r[6] for r in members}
        if len(words) < 2:
            continue
        found = accepted(words, m, backwards) if kind == ACCEPTOR else around_one_place(kind, words, m, backwards, at)
        for word, (n, (best_n, best)) in found.items():
            for column, value in zip(out, (word, n, -best_n, best)):
                column.append(value)
        if len(out[0]) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
            out = [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)


def near_words(
    words: DataFrame, min_length: int = MIN_LENGTH, most_words: int = MOST_WORDS, most_points: int = MOST_POINTS
) -> DataFrame:
    """word, ``n_near``, and count and name of the best near word, for words that have one.
    ``words`` (word, n) is read several times."""
    rows = _halves(words, min_length)
    large = (
        rows.groupBy("backwards", "m", "part").agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("points"))
        .filter((F.col("words") > most_words) | (F.col("points") > most_points))
        .select(F.col("backwards").alias("large_way"), F.col("m").alias("large_m"), F.col("part").alias("large_part"))
    )
    marked = keyed_join(rows, large, [("backwards", "large_way"), ("m", "large_m"), ("part", "large_part")])
    whole = F.col("large_m").isNull()
    groups = marked.filter(whole).select(*GROUP, "word", "n").unionByName(_by_place(marked.filter(~whole)))
    dealt = groups.repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = dealt.mapInArrow(_enumerate, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")
    )


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """``words`` with number of near words, form and the form's count."""
    joined = words.join(near, "word", "left")
    better = F.col("best_n") >= 2 * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n"),
    )


def roots(formed: DataFrame, stage: Staging) -> DataFrame:
    """Root of each word that has a form, by pointer doubling.

    Counts at least double from form to form, so chains are short: the number of rounds
    goes with the logarithm of the logarithm of the largest count.
    """
    reached = stage.put(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = reached.select(F.col("word").alias("stop"), F.col("root").alias("beyond"))
        jumped = keyed_join(reached, step, [("root", "stop")]).select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        )
        after = stage.put(jumped, "spelling-roots")
        stage.drop(reached)
        reached = after
        if after.filter("moved").isEmpty():
            return after.select("word", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    most_words: int = MOST_WORDS, most_points: int = MOST_POINTS,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words of the corpus."""
    stage = Staging(docs.sparkSession)
    words = stage.put(vocabulary(docs, key, text, min_length, min_count), "spelling-words")
    formed = stage.put(forms(words, near_words(words, min_length, most_words, most_points)), "spelling-forms")
    stage.drop(words)
    ends = roots(formed, stage).withColumnRenamed("word", "ended")
    joined = formed.join(ends, F.col("word") == F.col("ended"), "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
