"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spoorlens.functions.values import month_key
from spoorlens.session import setting, short_times

OPEN_FOLDERS = 8


def write_parquet(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    compression: str | None = None,
    only_given_partitions: bool = False,
    together: bool = True,
) -> None:
    """Overwrite ``path``.

    With partition columns the rows are first brought together by them, so that each
    folder gets few files. ``rebalance`` lets Spark merge small months and split a month
    that is larger than the advisory partition size over several tasks.
    ``only_given_partitions`` replaces just the folders that ``df`` has rows for.

    Without ``together`` each task writes the rows it has, and a folder gets a file per
    task: for a table whose last join makes many rows of one, which are then neither
    exchanged nor, up to ``OPEN_FOLDERS`` in a task, sorted.
    """
    if partitions and together:
        df = df.hint("rebalance", *[F.col(c) for c in partitions])
    writer = df.write.mode("overwrite")
    if partitions:
        mode = "dynamic" if only_given_partitions else "static"
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", mode)
    if compression:
        writer = writer.option("compression", compression)
    with short_times(df.sparkSession):
        if together:
            writer.parquet(path)
        else:
            with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS)):
                writer.parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Overwrite ``path`` with CSV and header.

    The caller decides on the layout, whatever the number of rows: ``single`` gives one
    file, written by one task, and is meant for results that are known to be small.
    ``repartition(1)`` leaves the work above it parallel, where ``coalesce(1)`` would
    pull it into the writing task.
    """
    if single:
        df = df.repartition(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_monthly(df: DataFrame, path: str, time: str = "time") -> None:
    """One folder per month of each row's own time."""
    write_parquet(df.withColumn("month", month_key(time)), path, partitions=["month"])
