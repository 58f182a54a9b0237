"""Ranks of sorted keys over a whole table, for prefix doubling.

Rows are range-partitioned and sorted by their keys and place. A row's rank is the
place, in that order, of the first row with the same keys. Rows of one key may lie in
several partitions, as their places differ, so a key with very many rows is no burden
for one task; partitions are stitched by their first and last rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spoorlens.llm.common import Staging

PARTITION_SHIFT = 40


def rerank(rows: DataFrame, keys: Sequence[str], place: Sequence[str], stage: Staging, carry: Sequence[str] = ()) -> DataFrame:
    """Rows whose keys occur more than once: place, carried columns, ``rank`` and, for at
    least one row of each rank and one per partition at most, ``leads``; staged.

    ``keys`` and ``place`` are integers; ``place`` is different for each row. Unique
    rows are left out while sorting, so only repeats are written.
    """
    keep = [*place, *carry]
    kinds = dict(rows.dtypes)
    names = [*keep, "rank", "leads", "again", *[f"edge_{k}" for k in keys]]
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in keep], "rank long", "leads boolean", "again boolean", *[f"edge_{k} {kinds[k]}" for k in keys]])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << PARTITION_SHIFT
        held: pa.Table | None = None  # the last row, as the next may equal it
        count, start, same_as_before = 0, 0, False

        def emit(table: pa.Table, starts: np.ndarray, again: np.ndarray, at: int, final: bool) -> pa.RecordBatch:
            """Repeats, and the first and last row of the partition with their keys."""
            edge = np.zeros(len(again), bool)
            if at == 0 and len(edge):
                edge[0] = True
            if final:
                edge[-1] = True
            chosen = np.flatnonzero(again | edge)
            small = table.take(pa.array(chosen))
            hidden = pa.array(~edge[chosen])
            edges = [pa.compute.if_else(hidden, pa.scalar(None, table.schema.field(k).type), small.column(k)) for k in keys]
            arrays = [small.column(c) for c in keep] + [
                pa.array(base + starts[chosen]), pa.array(starts[chosen] == at + chosen), pa.array(again[chosen])
            ] + edges
            return pa.Table.from_arrays(arrays, names).combine_chunks()

        for batch in batches:
            if len(batch) == 0:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            n = len(table)
            differs = np.zeros(n - 1, bool)
            for k in keys:
                values = table.column(k).to_numpy()
                differs |= values[1:] != values[:-1]
            first = np.concatenate(([held is None or not same_as_before], differs))
            at = count - (held is not None)
            # Start of each row's group, counted over the partition.
            marks = np.where(first, np.arange(at, at + n), -1)
            if not first[0]:
                marks[0] = start
            starts = np.maximum.accumulate(marks)
            follows = np.concatenate((~differs, [False]))
            again = ~first | follows
            if n > 1:
                out = emit(table.slice(0, n - 1), starts[:-1], again[:-1], at, False)
                if len(out):
                    yield from out.to_batches()
            held = table.slice(n - 1)
            start, same_as_before = int(starts[-1]), not first[-1]
            count = at + n
        if held is not None:
            out = emit(held, np.array([start]), np.array([same_as_before]), count - 1, True)
            yield from out.to_batches()

    order = [*keys, *place]
    marked = stage.put(
        rows.select(*dict.fromkeys([*keys, *keep])).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(mark, schema), "ranked"
    )
    # At most two rows per partition.
    edges = marked.filter(F.col(f"edge_{keys[0]}").isNotNull()).select("rank", *[f"edge_{k}" for k in keys]).collect()
    by_part: dict[int, list] = {}
    for r in edges:
        by_part.setdefault(r[0] >> PARTITION_SHIFT, []).append((r[0], tuple(r)[1:]))
    stitched: dict[int, int] = {}
    last = None
    for part in sorted(by_part):
        ends = sorted(by_part[part])
        if last is not None and last[1] == ends[0][1]:
            root = stitched.setdefault(last[0], last[0])
            stitched[ends[0][0]] = root
        last = ends[-1]
    result = [*keep, "rank", "leads"]
    if not stitched:
        return stage.derived(marked, marked.filter("again").select(*result))
    pairs = pa.table({"rank": pa.array(list(stitched), pa.int64()), "_root": pa.array(list(stitched.values()), pa.int64())})
    fix = F.broadcast(rows.sparkSession.createDataFrame(pairs))
    joined = marked.join(fix, "rank", "left")
    whole = joined.filter("again OR _root IS NOT NULL").select(*keep, F.coalesce("_root", "rank").alias("rank"), "leads")
    return stage.derived(marked, whole)
