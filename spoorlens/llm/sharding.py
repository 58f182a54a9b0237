"""Shards of near equal bytes by a histogram sort.

Rows get a key in which every row has its place: hash of the text, doc_id, and a number
of the staged row, so that equal texts stand together and yet no key is too large to be
cut. Splitters between shards are found by counting: probe keys cut the interval of each
splitter, the exact bytes below each probe are summed over all partitions, and the
interval around the wanted share is probed again until the bytes are close enough. Then
rows are exchanged once. DataFrame functions only; the driver sees sums per probe.

Null texts count as no bytes. Null doc_ids come before all others. Repeated rows are
rows like any others. Further columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from spoorlens.llm.common import Staging, text_of

PROBES = 1024
CELL_ROWS = 1_000_000
LEAST_CELLS = 32
# The parts of a key, each a long without sign trouble, compared from left to right.
KEY = ["_k0", "_k1", "_k2", "_k3"]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    size = F.octet_length(text_of(text)).cast("long") + 1
    number = F.col(key).cast("long")
    return docs.withColumns({
        "size": size,
        "_k0": F.shiftrightunsigned(F.xxhash64(text_of(text)), 1),
        # Shifted by one bit so that differences stay within a long; null is lowest.
        "_k1": F.coalesce(F.shiftright(number, 32), F.lit(-(1 << 31) - 1)).cast("long"),
        "_k2": F.coalesce(number.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)).cast("long"),
        "_k3": F.monotonically_increasing_id(),
    })


def _below(cut: list[int]) -> Column:
    """Rows whose key comes before ``cut``, which may hold the first parts only."""
    tests = []
    for i, value in enumerate(cut):
        same = [F.col(KEY[j]) == F.lit(cut[j]) for j in range(i)]
        tests.append(reduce(lambda a, b: a & b, [*same, F.col(KEY[i]) < F.lit(value)]))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def splitters(keyed: DataFrame, shards: int, tolerance: float = 0.001) -> list[list[int]]:
    """Keys at which the shards 1, 2, ... begin.

    Each splitter has an interval of one key part, with the parts before it fixed. A
    round divides it by ``PROBES``, sums the bytes per slice in one aggregation for all
    splitters, and goes on between the lowest and highest value of the slice that holds
    the wanted share. A slice of a single value goes on in the next key part.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    wanted = [total * k / shards for k in range(1, shards)]
    near = tolerance * total / shards
    # For each splitter: fixed parts, bytes below the interval, and its bounds if known.
    open_: dict[int, tuple[list[int], int, tuple[int, int] | None]] = {k: ([], 0, None) for k in range(shards - 1)}
    cuts: dict[int, list[int]] = {}
    if total == 0:
        return [[0] for _ in range(shards - 1)]
    while open_:
        # Bounds of the next key part where a prefix was just fixed.
        fresh = {tuple(p) for p, _, bounds in open_.values() if bounds is None}
        ranges: dict[tuple, tuple[int, int]] = {}
        for prefix in sorted(fresh):
            part = KEY[len(prefix)]
            inside = reduce(lambda a, b: a & b, [F.col(KEY[i]) == v for i, v in enumerate(prefix)], F.lit(True))
            low, high = keyed.filter(inside).agg(F.min(part), F.max(part)).first()
            ranges[prefix] = (low, high + 1)
        open_ = {k: (p, b, bounds or ranges[tuple(p)]) for k, (p, b, bounds) in open_.items()}
        jobs = sorted({(tuple(p), bounds) for p, _, bounds in open_.values()})
        slices = []
        for n, (prefix, (low, high)) in enumerate(jobs):
            step = max(1, -(-(high - low) // PROBES))
            part = F.col(KEY[len(prefix)])
            inside = reduce(
                lambda a, b: a & b,
                [*[F.col(KEY[i]) == v for i, v in enumerate(prefix)], part >= low, part <= high - 1],
            )
            inside_slice = F.expr(f"({KEY[len(prefix)]} - {low}L) div {step}L")
            slices.append((inside, inside_slice + n * PROBES))
        place = reduce(lambda acc, s: acc.when(*s), slices[1:], F.when(*slices[0]))
        parts = [(inside, F.col(KEY[len(jobs[n][0])])) for n, (inside, _) in enumerate(slices)]
        value = reduce(lambda acc, s: acc.when(*s), parts[1:], F.when(*parts[0]))
        found = {
            r[0]: tuple(r)[1:] for r in keyed.select(place.cast("long").alias("slice"), value.alias("v"), "size")
            .filter("slice IS NOT NULL").groupBy("slice")
            .agg(F.sum("size"), F.count("*"), F.min("v"), F.max("v")).collect()
        }  # at most shards * PROBES rows
        after: dict[int, tuple[list[int], int, tuple[int, int] | None]] = {}
        for k, (prefix, below, (low, high)) in open_.items():
            n = jobs.index((tuple(prefix), (low, high)))
            step = max(1, -(-(high - low) // PROBES))
            at = below
            for i in range(PROBES):
                more, rows, least, most = found.get(n * PROBES + i, (0, 0, 0, 0))
                if at + more > wanted[k] or abs(at + more - wanted[k]) <= near or low + (i + 1) * step >= high:
                    break
                at += more
            start, end = low + i * step, min(low + (i + 1) * step, high)
            if abs(at - wanted[k]) <= near:
                cuts[k] = [*prefix, start]
            elif abs(at + more - wanted[k]) <= near:
                cuts[k] = [*prefix, end]
            elif rows <= 1:  # the row goes where it leaves the smaller error
                cuts[k] = [*prefix, start if wanted[k] - at <= at + more - wanted[k] else end]
            elif least < most:
                after[k] = (prefix, at, (least, most + 1))
            else:  # one value of this part: on with the next part, which differs at the latest in the last
                after[k] = ([*prefix, least], at, None)
        open_ = after
    return [cuts[k] for k in range(shards - 1)]


def shard_documents(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", tolerance: float = 0.001,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with size, shard and slot.

    Slots count the rows of a shard without gaps. Within a shard, rows are dealt into
    cells of about ``CELL_ROWS`` by hash; a cell's rows are numbered by key after those
    of the cells before it, so no task gets a whole shard. Columns named size, shard or
    slot in the input are replaced.
    """
    spark = docs.sparkSession
    stage = Staging(spark)
    own = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    keyed = _keyed(docs.select(*[F.col(f"`{c}`") for c in own]), key, text)
    if not with_text:
        own = [c for c in own if c != text]
        keyed = keyed.drop(text)
    keyed = stage.put(keyed, "keyed")
    cuts = splitters(keyed, shards, tolerance)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + F.when(_below(cut), 0).otherwise(1)
    placed = keyed.withColumn("shard", shard.cast("int"))
    cells = max(LEAST_CELLS, -(-keyed.count() // (shards * CELL_ROWS)))
    placed = placed.withColumn("_cell", F.pmod(F.xxhash64(*KEY), F.lit(cells)).cast("int"))
    counts = {(r[0], r[1]): r[2] for r in placed.groupBy("shard", "_cell").count().collect()}
    starts, rows = {}, []
    for s in range(shards):
        at = 0
        for c in range(cells):
            starts[s, c] = at
            at += counts.get((s, c), 0)
        rows += [(s, c, starts[s, c]) for c in range(cells)]
    begin = F.broadcast(spark.createDataFrame(rows, "shard int, _cell int, _start long"))
    by_key = Window.partitionBy("shard", "_cell").orderBy(*KEY)
    numbered = placed.withColumn("_n", F.row_number().over(by_key)).join(begin, ["shard", "_cell"])
    return numbered.select(*[F.col(f"`{c}`") for c in own], "size", "shard", (F.col("_start") + F.col("_n") - 1).alias("slot"))

