"""Repeated byte strings by distributed prefix doubling.

A byte is removed if a string of ``length`` bytes over it also starts elsewhere, in the
same text or another. Sorting all suffixes of a corpus costs many times its size, so the
suffix array is built over a sparse set of positions that any two copies of a string
share: boundaries set by the content (a hash of ``GRAM`` bytes). Between boundaries lie
phrases.

1. Phrases get a rank by sorting their hashes.
2. Prefix doubling: the rank over 2h phrases from a position follows from the pair of
   ranks at the position and h phrases further on. Spark sorts these pairs and reranks
   (``ranks.rerank``). Positions leave once they are unique, or once h phrases reach
   past the threshold.
3. Any run of phrases is named by a pair of ranks, of its first and last 2^k phrases.
   One more sort tells which runs repeat.
4. A window of ``length`` bytes has an inner run of whole phrases and an outer run that
   covers it. If the outer run repeats, so does the window; if the inner one is unique,
   the window is. Only where the inner run repeats and the outer does not, at the ends of
   repeats, the bytes beside the inner run decide: the places of a run meet, and a window
   repeats as far as another place has the same bytes to the left and to the right.
   Windows without an inner phrase, and those of runs with more than ``CROWD`` places, are
   sorted by a 128-bit hash of their bytes, so the result is exact for any text.

Equal texts are one text with a count: what is found for one holds for all copies.
Phrases are told apart by 64-bit hashes; a wrong answer needs two runs of which all other
phrases are equal and these collide.

Null texts are empty. Texts shorter than ``length`` have no such string. Repeated rows
are copies of each other. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from spoorlens.llm.common import Staging, text_of
from spoorlens.llm.ranks import rerank
from spoorlens.operators.skew import keyed_join

LENGTH = 400
GRAM = 8
# One boundary in about so many bytes.
DENSITY = 48
NEED_BITS = 16
# Runs with more places than this are told by hashes of single windows.
CROWD = 500
# Up to so many different places are compared two by two.
PAIRWISE = 8
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Layout:
    """Boundaries of a text and the phrase runs inside and around its windows."""

    def __init__(self, data: bytes, length: int):
        n = len(data)
        # Eight bytes from each position on.
        x = np.ndarray((max(0, n - GRAM + 1),), "<u8", data, strides=(1,)) * _A
        x ^= x >> np.uint64(32)
        x *= _B
        anchors = np.flatnonzero(x < np.uint64((1 << 64) // DENSITY))
        self.length, self.n, self.anchors = length, n, anchors
        # Both ends of a text are boundaries too, but not ones that its copies share.
        first = [] if len(anchors) and anchors[0] == 0 else [0]
        self.bounds = np.concatenate((first, anchors, [n] if n else [])).astype(np.int64)
        self.count = len(self.bounds) - 1

    def needs(self) -> np.ndarray:
        """Phrases in the longest run from each position that a window can ask for."""
        ends = np.searchsorted(self.bounds, np.minimum(self.bounds[1:] - 1 + self.length, self.n), "left")
        return np.minimum(ends - np.arange(self.count), 32_000)

    def least_inner(self) -> tuple[np.ndarray, bool]:
        """For each phrase the whole phrases in the shortest inner run that begins with it
        (0 where none begins), and whether a window has no inner phrase at all."""
        last_window = self.n - self.length
        at = np.append(0, self.anchors[:-1] + 1)[:len(self.anchors)]  # first window of each
        least = np.searchsorted(self.anchors, at + (self.length - GRAM), "right") - 1 - np.arange(len(self.anchors))
        asked = at <= last_window
        bare = bool((least[asked] < 1).any()) or len(self.anchors) == 0 or bool(self.anchors[-1] < last_window)
        out = np.zeros(self.count, np.int64)
        # Where the first window has no inner phrase, later ones of that anchor have one.
        out[np.arange(len(self.anchors))[asked] + self.extra] = np.maximum(least[asked], 1)
        return out, bare

    @property
    def extra(self) -> int:
        """Boundaries before the first anchor: the start of the text, unless it is one."""
        return 0 if len(self.anchors) and self.anchors[0] == 0 else 1

    def windows(self) -> tuple[np.ndarray, ...]:
        """Stretches of windows with the same runs: first window, end, inner run (first
        boundary and last), outer run."""
        last_window, inside = self.n - self.length, self.length - GRAM
        turns = np.concatenate(([0], self.anchors + 1, self.anchors - inside, self.bounds, self.bounds - self.length + 1))
        at = _distinct(turns[(turns >= 0) & (turns <= last_window)])
        i = np.searchsorted(self.anchors, at, "left") + self.extra
        j = np.searchsorted(self.anchors, at + inside, "right") - 1 + self.extra
        o = np.searchsorted(self.bounds, at, "right") - 1
        e = np.searchsorted(self.bounds, at + self.length, "left")
        # An empty run where there is no inner phrase.
        return at, np.append(at[1:], last_window + 1), i, np.maximum(i, j), o, e


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def keep_outside(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def whole_characters(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a span of UTF-8 bytes that holds whole characters."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def _arrow(work, rows: DataFrame, schema: str) -> DataFrame:
    """``work`` maps a row's values to output rows."""
    names = [part.strip().split(" ")[0] for part in schema.replace("array<struct<a:int,b:int>>", "spans").split(",")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
             "spans": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))}
    types = [kinds[part.strip().split(" ")[1]] for part in schema.replace("array<struct<a:int,b:int>>", "spans").split(",")]
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [[] for _ in names], 0
            for i in range(len(batch)):
                made = work(*[batch.column(c)[i] for c in columns])
                if made is None:
                    continue
                if len(made[0]) == 0:
                    continue
                for held, values in zip(out, made):
                    held.append(values)
                size += len(made[0])
                if size > 200_000:
                    yield _joined(out, types, names)
                    out, size = [[] for _ in names], 0
            if out[0]:
                yield _joined(out, types, names)

    return rows.mapInArrow(run, schema)


def _joined(out: list[list], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    arrays = []
    for parts, kind in zip(out, types):
        if isinstance(parts[0], np.ndarray):
            arrays.append(pa.array(np.concatenate(parts), kind))
        else:
            arrays.append(pa.array([v for part in parts for v in part], kind))
    return pa.RecordBatch.from_arrays(arrays, names)


def _parse(docs: DataFrame, length: int) -> DataFrame:
    """Per row: an id, what names its text, digests, and the phrase hashes with needs."""
    schema = (
        "uid long, key long, t1 long, t2 long, n_bytes long, whole string, bare boolean, "
        "phrases array<struct<k1:long,need:int>>"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, sizes, digests, bare, counts = [], [], [], [], [0]
            hashes, needs = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for text in batch.column("text").to_pylist():
                data = text.encode()
                ids.append(uid)
                uid += 1
                sizes.append(len(data))
                digests.append(hashlib.sha256(data).hexdigest())
                if len(data) < length:
                    bare.append(False)
                    counts.append(0)
                    continue
                layout = Layout(data, length)
                b = layout.bounds.tolist()
                view, digest = memoryview(data), xxhash.xxh3_64_intdigest
                hashes.append(np.array([digest(view[x:y]) for x, y in zip(b, b[1:])], np.uint64).view(np.int64))
                counts.append(layout.count)
                least, has_bare = layout.least_inner()
                bare.append(has_bare)
                # The level at which the shortest inner run is ranked goes with the need.
                level = np.where(least > 0, np.frexp(np.maximum(least, 1))[1] - 1, 31)
                needs.append((layout.needs() + (level << NEED_BITS)).astype(np.int32))
            found = pa.StructArray.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(needs))], ["k1", "need"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[batch.column(c) for c in ("key", "t1", "t2")], pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(bare, pa.bool_()), pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), found)],
                ["uid", "key", "t1", "t2", "n_bytes", "whole", "bare", "phrases"],
            )

    return _named(docs).mapInArrow(work, schema)


def _named(docs: DataFrame) -> DataFrame:
    """Key, text, and a 128-bit name of the text."""
    return docs.select("key", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def _doubling(parsed: DataFrame, stage: Staging) -> list[DataFrame]:
    """Ranks of repeated runs of 1, 2, 4, ... phrases: uid, i, need, rank per level."""
    phrases = parsed.select("uid", F.posexplode("phrases").alias("i", "p")).select("p.k1", "uid", "i", "p.need")
    levels = [rerank(phrases, ["k1"], ["uid", "i"], stage, ["need"])]
    longest = F.col("need").bitwiseAND(F.lit((1 << NEED_BITS) - 1))
    h = 1
    while True:
        live = levels[-1]
        ahead = F.first("rank").over(Window.partitionBy("uid").orderBy("i").rangeBetween(h, h))
        paired = live.select(F.col("rank").alias("k1"), ahead.alias("k2"), "uid", "i", "need")
        pairs = stage.put(paired.filter(longest >= 2 * h).filter("k2 IS NOT NULL"), "pairs")
        if pairs.isEmpty():
            return levels
        levels.append(rerank(pairs, ["k1", "k2"], ["uid", "i"], stage, ["need"]))
        stage.drop(pairs)
        h *= 2


def _named_runs(layout: Layout, level: np.ndarray, i: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Inner and outer runs of the windows that may repeat, as rows of first phrase,
    phrases, and the ranks of their first and last 2^k phrases."""
    _, _, a, b, o, e = layout.windows()
    width = layout.count + 1
    runs = _distinct(np.concatenate((a * width + b, o * width + e)))
    first, phrases = runs // width, runs % width - runs // width
    first, phrases = first[phrases > 0], phrases[phrases > 0]
    k = np.frexp(phrases)[1] - 1
    order = np.argsort(level * width + i)
    places = (level * width + i)[order]

    def rank_at(at: np.ndarray) -> np.ndarray:
        found = np.minimum(np.searchsorted(places, k * width + at), len(places) - 1)
        return np.where(places[found] == k * width + at, rank[order][found], -1)

    head, tail = rank_at(first), rank_at(first + phrases - (1 << k))
    both = (head >= 0) & (tail >= 0)
    return np.stack((first[both], phrases[both], head[both], tail[both]), axis=1)


class Verdicts:
    """Stretches of windows of a text, with what is known of their runs."""

    def __init__(self, layout: Layout, copied: bool, runs: pa.Scalar):
        self.starts, self.ends, a, b, o, e = layout.windows()
        width = layout.count + 1
        fields = runs.values if runs.is_valid else None
        if fields is None or len(fields) == 0:
            known, rank, leads = np.array([-1]), np.array([-1]), np.array([False])
        else:
            known = _ints(fields, "i") * width + _ints(fields, "m")
            order = np.argsort(known)
            known, rank = known[order], _ints(fields, "rank")[order]
            leads = fields.field("leads").to_numpy(zero_copy_only=False)[order]

        def look(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            wanted = first * width + last - first
            found = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            return np.where(known[found] == wanted, rank[found], -1), leads[found]

        outer, outer_leads = look(o, e)
        self.group, _ = look(a, b)
        bare = b <= a
        self.group = np.where(bare, -1, self.group)
        self.sure, self.copied = (outer >= 0) | copied, copied
        # Sure windows are needed only for others to be compared with. Those of one outer
        # run are equal, so the text that leads its group stands for all.
        stands = ~self.sure | (outer < 0) | outer_leads
        self.told_by_bytes = (bare | (self.group >= 0)) & stands
        self.bare, self.length = bare, layout.length
        self.inner, self.inner_end = layout.bounds[a], layout.bounds[b]

    def places(self) -> tuple[np.ndarray, ...]:
        """Windows to be told by their bytes: first, end, group (-1 if bare), where their
        inner run starts and ends (at the first window if bare), and whether one of them
        may or may not repeat."""
        chosen = np.flatnonzero(self.told_by_bytes)
        a, b = self.inner[chosen], self.inner_end[chosen]
        # Stretches that follow each other and differ by their outer runs only are one.
        bare = self.bare[chosen]
        follows = np.zeros(len(chosen), bool)
        follows[1:] = (np.diff(chosen) == 1) & ((bare[1:] & bare[:-1]) | (~bare[1:] & ~bare[:-1] & (np.diff(a) == 0) & (np.diff(b) == 0)))
        new = np.flatnonzero(~follows)
        start, end = self.starts[chosen][new], self.ends[chosen][np.append(new[1:], len(chosen)) - 1] if len(new) else new
        bare = bare[new]
        open_ = np.logical_or.reduceat(~self.sure[chosen], new) if len(new) else np.zeros(0, bool)
        return (
            start, end, np.where(bare, -1, self.group[chosen][new]), np.where(bare, start, a[new]),
            np.where(bare, start, b[new]), open_,
        )

    def settled(self) -> tuple[np.ndarray, np.ndarray]:
        """Sure windows, first and end; none of a text that goes whole."""
        sure = np.flatnonzero(self.sure & (not self.copied))
        new = np.flatnonzero(np.append(True, np.diff(sure) > 1)) if len(sure) else sure
        return self.starts[sure[new]], self.ends[sure[np.append(new[1:], len(sure)) - 1]] if len(new) else new


def _spans(first: np.ndarray, end: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged spans of the windows from ``first`` up to ``end``."""
    if len(first) == 0:
        return []
    order = np.argsort(first)
    starts, ends = first[order], np.maximum.accumulate(end[order] - 1 + length)
    new = np.append(True, starts[1:] > ends[:-1])
    return list(zip(starts[new].tolist(), ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)].tolist()))


def _ints(fields: pa.StructArray, name: str) -> np.ndarray:
    return fields.field(name).to_numpy().astype(np.int64)


class Place:
    """Windows with one inner run at a place of a text: the bytes beside the run, from the
    first window's start to the last one's end. Windows go by ``d``, their bytes left of it."""

    __slots__ = ("d", "least", "need", "side", "found")

    def __init__(self, d: int, n: int, side: bytes):
        self.d, self.least, self.need, self.side = d, d - n + 1, len(side) - n + 1, side
        self.found: list[tuple[int, int]] = []  # lowest and highest d of windows that repeat

    def meet(self, other: Place) -> None:
        low, high = max(self.least, other.least), min(self.d, other.d)
        if low > high or self.need != other.need:
            return
        x, y = self.side, other.side
        high = min(high, _same_end(x[self.d - high:self.d], y[other.d - high:other.d]))
        if low > high:
            return
        right = self.need - low
        low = max(low, self.need - _same_start(x[self.d:self.d + right], y[other.d:other.d + right]))
        if low <= high:
            self.found.append((low, high))
            other.found.append((low, high))


def _same_start(x: bytes, y: bytes) -> int:
    """Equal bytes at the start of two strings of one length."""
    if x == y:
        return len(x)
    return len(x) - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def _same_end(x: bytes, y: bytes) -> int:
    if x == y:
        return len(x)
    return len(x) - ((int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_length() + 7) // 8


def _meet_all(places: list[Place]) -> None:
    """Fills ``found`` of all places of one inner run."""
    if len(places) <= PAIRWISE:
        for i, x in enumerate(places):
            for y in places[:i]:
                x.meet(y)
        return
    windows: dict[tuple[int, bytes], int] = {}
    for x in places:
        for t in range(x.d - x.least + 1):
            window = (x.d - t, x.side[t:t + x.need])
            windows[window] = windows.get(window, 0) + 1
    for x in places:
        x.found += [(x.d - t, x.d - t) for t in range(x.d - x.least + 1) if windows[x.d - t, x.side[t:t + x.need]] > 1]


def _repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sides`` sorted by ``g`` and ``h``: stretches of windows that occur more than once."""
    names = ["uid", "a", "b"]
    out: list[tuple[int, int, int]] = []

    def settle(rows: list[tuple]) -> None:
        # Where no window is open, all are known to repeat.
        if len(rows) < 2 or not any(r[0] for r in rows):
            return
        alike: dict[tuple, list[tuple]] = {}
        for _, *r in rows:
            alike.setdefault(tuple(r[2:]), []).append(r)
        places = {k: Place(*k) for k in alike}
        if len(places) > 1:
            _meet_all(list(places.values()))
        for k, place in places.items():
            if len(alike[k]) > 1:
                place.found = [(place.least, place.d)]
            for uid, p, *_ in alike[k]:
                out.extend((uid, p + place.d - high, p + place.d - low + 1) for low, high in place.found)

    def packed() -> pa.RecordBatch:
        columns = np.array(out, np.int64).reshape(-1, 3).T
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0]), *[pa.array(c, pa.int32()) for c in columns[1:]]], names)

    group, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("g", "h", "open", "uid", "p", "d", "n", "side")]
        for g, h, *row in zip(*columns):
            if (g, h) != group:
                settle(held)
                group, held = (g, h), []
            held.append(tuple(row))
        if len(out) > 100_000:
            yield packed()
    settle(held)
    if out:
        yield packed()


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: key, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans
    (byte offsets, ``a`` to ``b``), with the 128-bit name of the text in t1 and t2."""
    stage = Staging(docs.sparkSession)
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(text).alias("text"))
    parsed = stage.put(_parse(plain, length), "parsed")
    # One row stands for all rows of a text.
    texts = stage.put(
        parsed.filter(F.col("n_bytes") >= length).groupBy("t1", "t2").agg(
            F.min("uid").alias("uid"), F.min_by("key", "uid").alias("key"), (F.count("*") > 1).alias("copied"),
            F.max("bare").alias("bare"),
        ), "texts",
    )
    copies = stage.put(
        parsed.join(texts.filter("copied").select("t1", "t2", F.col("uid").alias("first")), ["t1", "t2"])
        .filter(F.col("uid") != F.col("first")).select(F.col("uid").alias("copy")), "copies",
    )
    once = keyed_join(parsed.select("uid", "phrases"), copies, [("uid", "copy")]).filter("copy IS NULL")
    levels = _doubling(once, stage)
    rows = stage.put(parsed.drop("phrases"), "rows")
    stage.drop(parsed, copies)
    found = None
    for level, ranked in enumerate(levels):
        part = ranked.select(
            "uid", F.struct(F.lit(level).alias("level"), "i", "rank").alias("r"), F.shiftright("need", NEED_BITS).alias("low")
        )
        found = part if found is None else found.unionByName(part)
    # Short phrases repeat in most texts. A text is of interest if a position has a rank
    # for its shortest inner run, and then from the lowest level on at which one has.
    serves = F.when(F.col("r.level") >= F.col("low"), F.col("low"))
    lowest = stage.put(found.groupBy("uid").agg(F.min(serves).alias("lowest")).filter("lowest IS NOT NULL"), "lowest")
    gathered = (
        found.join(lowest, "uid").filter(F.col("r.level") >= F.col("lowest"))
        .groupBy("uid").agg(F.collect_list("r").alias("ranks"))
    )
    asked = stage.put(
        texts.join(gathered, "uid", "left").filter("bare OR ranks IS NOT NULL"), "asked"
    )
    stage.drop(*levels, lowest)
    # The one exchange of whole texts; from here on only texts that may hold a repeat.
    same = ["t1", "t2"]
    # Equal rows give one: the keys of the join are plain columns, so that its exchange
    # serves this as well.
    apart = {"id": F.coalesce("key", F.lit(0)), "no_id": F.col("key").isNull()}
    live = _named(plain).filter(F.octet_length("text") >= length).withColumns(apart).drop("key").join(
        asked.withColumns(apart).drop("key"), [*same, *apart]
    ).dropDuplicates([*same, *apart]).select("uid", *same, "copied", "ranks", "text")
    live = stage.put(live, "live")
    stage.drop(asked)

    def name_runs(uid, ranks, text):
        if not ranks.is_valid:
            return None
        r = ranks.values
        runs = _named_runs(Layout(text.as_py().encode(), length), _ints(r, "level"), _ints(r, "i"), _ints(r, "rank"))
        return np.full(len(runs), uid.as_py()), runs[:, 0].astype(np.int32), runs[:, 1].astype(np.int32), runs[:, 2], runs[:, 3]

    named = stage.put(
        _arrow(name_runs, live.select("uid", "ranks", "text"), "uid long, i int, m int, k1 long, k2 long"), "runs"
    )
    repeated = rerank(named, ["m", "k1", "k2"], ["uid", "i"], stage, ["m"])
    stage.drop(named)
    runs = stage.put(
        repeated.select("uid", F.struct("m", "i", "rank", "leads").alias("r")).groupBy("uid").agg(F.collect_set("r").alias("runs")), "runs"
    )
    stage.drop(repeated)

    def beside(uid, copied, runs, text):
        data = text.as_py().encode()
        verdicts = Verdicts(Layout(data, length), copied.as_py(), runs)
        start, end, group, a, b, open_ = verdicts.places()
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        at = list(zip(start.tolist(), end.tolist(), a.tolist(), b.tolist()))
        inner = np.array([digest(view[y:z]) for _, _, y, z in at], np.uint64).view(np.int64)
        sides = [data[x:y] + data[z:w - 1 + length] for x, w, y, z in at]
        first, last = verdicts.settled()
        zeros = np.zeros(len(first), np.int64)
        return (
            np.full(len(at) + len(first), uid.as_py()), np.append(group, zeros), np.append(inner, zeros), np.append(a - start, zeros),
            np.append(start, first), np.append(end - start, last - first), np.append(open_, zeros > 0), sides + [None] * len(first),
        )

    # Windows to be told by their bytes, and without bytes those that are known to repeat.
    told = stage.put(
        _arrow(
            beside, live.drop("ranks").join(runs, "uid", "left").select("uid", "copied", "runs", "text"),
            "uid long, g long, h long, d int, p int, n int, open boolean, side binary",
        ), "sides",
    )
    stage.drop(runs)
    sides = told.filter("side IS NOT NULL")
    sure = told.filter("side IS NULL").select("uid", F.col("p").alias("a"), (F.col("p") + F.col("n")).alias("b"))
    run = ["g", "h"]
    crowds = stage.put(
        sides.filter("g >= 0").groupBy(*run).agg(F.count("*").alias("c"), F.max("open").alias("asked"))
        .filter(F.col("c") > CROWD).select(*run, "asked"), "crowds"
    )
    few, single = sides.filter("g >= 0"), sides.filter("g < 0")
    if not crowds.isEmpty():
        few, single = few.join(crowds, run, "left_anti"), single.unionByName(few.join(crowds.filter("asked"), run, "left_semi"))
    met = few.repartition(*run).sortWithinPartitions(*run).mapInArrow(_repeated_windows, "uid long, a int, b int")

    def hash_windows(uid, g, h, d, p, n, side):
        g, h, d, p, n, side = (x.as_py() for x in (g, h, d, p, n, side))
        view, digest, need = memoryview(side), xxhash.xxh3_128_digest, len(side) - n + 1
        if g < 0:
            made = b"".join([digest(view[t:t + need]) for t in range(n)])
        else:
            made = b"".join([digest(side[t:t + need] + struct.pack("<qqi", g, h, d - t)) for t in range(n)])
        made = np.frombuffer(made, np.int64).reshape(-1, 2)
        # Of equal windows in a stretch, as in a word said over and over, one goes on.
        order = np.lexsort((made[:, 1], made[:, 0]))
        same = (made[order[1:]] == made[order[:-1]]).all(axis=1)
        one, equal = order[np.append(True, ~same)], np.sort(order[np.append(False, same) | np.append(same, False)])
        new = np.append(True, np.diff(equal) > 1) if len(equal) else np.zeros(0, bool)
        first, last = equal[new], equal[np.append(np.flatnonzero(new)[1:], len(equal)) - 1] if len(equal) else equal
        zeros = np.zeros(len(first), np.int64)
        return (
            np.append(made[one, 0], zeros), np.append(made[one, 1], zeros), np.full(len(one) + len(first), uid),
            p + np.append(one, first), np.append(np.zeros(len(one), np.int64), last - first + 1),
        )

    # Windows to be sorted, and with n above 0 those that are known to repeat.
    hashed = stage.put(
        _arrow(hash_windows, single.select("uid", "g", "h", "d", "p", "n", "side"), "k1 long, k2 long, uid long, p int, n int"), "windows"
    )
    again = rerank(hashed.filter("n = 0"), ["k1", "k2"], ["uid", "p"], stage, [])
    within = hashed.filter("n > 0").select("uid", F.col("p").alias("a"), (F.col("p") + F.col("n")).alias("b"))
    alone = again.select("uid", F.col("p").alias("a"), (F.col("p") + 1).alias("b"))
    places = sure.unionByName(met).unionByName(within).unionByName(alone).groupBy("uid").agg(
        F.collect_list(F.struct("a", "b")).alias("places")
    )

    def verdict(t1, t2, places, text):
        data, fields = text.as_py().encode(), places.values
        spans = _spans(_ints(fields, "a"), _ints(fields, "b"), length)
        kept = keep_outside(data, spans)
        return ([t1.as_py()], [t2.as_py()], [len(data) - len(kept)], [len(spans)], [hashlib.sha256(kept).hexdigest()],
                [[{"a": a, "b": b} for a, b in spans]])

    # Texts of which something goes; one with a copy goes whole. ``live`` has a text once.
    final = stage.put(
        _arrow(
            verdict, live.filter("NOT copied").join(places, "uid").select("t1", "t2", "places", "text"),
            "t1 long, t2 long, n_removed long, n_spans long, kept string, spans array<struct<a:int,b:int>>",
        ), "verdicts",
    )
    stage.drop(live, told, hashed, again, crowds)
    known = texts.select(*same, "copied").join(final, same, "left")
    copied = F.coalesce("copied", F.lit(False))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n_bytes").cast("int").alias("b")))
    return rows.select("key", *same, "n_bytes", "whole").join(known, same, "left").select(
        F.col("key").alias(key), "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        F.when(copied, whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>"))).alias("spans"),
        *same,
    )
