"""Joins that hold up when one key has a large part of all rows.

The small side is broadcast only after its size was counted. Beyond the bound both
sides are shuffled, and keys with very many rows are spread over several tasks: each row
of such a key gets a salt, and the rows of the other side are repeated once per salt. A
key may be hot on either side or on both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.session import staged

SMALL_ROWS = 1_000_000
SMALL_BYTES = 128 * 1024 * 1024
HOT_ROWS = 2_000_000
GLANCE_ROWS = 10_000


def fits_in_memory(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether ``df`` is small enough to broadcast, by its rows and bytes.

    A glance at the widths of the first rows settles it for most dimension tables. A
    larger table is counted, which reads no column of a file, and only one within the
    row bound is read for its bytes.
    """
    if max_rows <= 0:
        return False
    width = F.lit(16 * len(df.columns)).cast("long")
    for column, kind in df.dtypes:
        if kind in ("string", "binary") or "<" in kind:  # text, or a nested type as text
            width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    glance = min(max_rows, GLANCE_ROWS)
    seen = df.select(width).take(glance + 1)
    if len(seen) <= glance:
        return sum(r[0] for r in seen) <= max_bytes
    if glance == max_rows or df.count() > max_rows:
        return False
    return df.agg(F.sum(width)).first()[0] <= max_bytes


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``hot_rows`` rows and the number of tasks each should get.

    There is at most one such key per ``hot_rows`` rows of ``df``. Keys of several columns
    are counted only where the first column alone has that many rows, which most tables
    show by a small exchange.
    """
    if len(keys) > 1:
        first = df.groupBy(F.col(keys[0]).alias("_first")).agg(F.count("*").alias("_n"))
        many = staged(first.filter(F.col("_n") > hot_rows).select("_first"), "hot-firsts")
        few = F.broadcast(many) if fits_in_memory(many) else many
        df = df.join(few, F.col(keys[0]).eqNullSafe(F.col("_first")), "left_semi")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .withColumn("_fan", F.ceil(F.col("_n") / hot_rows).cast("int"))
        .drop("_n")
    )


def _conjunction(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _with_fan(df: DataFrame, keys: Sequence[str], fans: DataFrame, name: str) -> DataFrame:
    """``df`` with the fan of its key, 1 for keys that are not hot; nulls equal nulls.

    The hot keys are broadcast where they are few; beyond that they are joined by a
    shuffle, in which Spark itself splits what is uneven.
    """
    helpers = [f"_h{i}" for i in range(len(keys))]
    named = fans.select(*[F.col(k).alias(h) for k, h in zip(fans.columns, helpers)], F.col("_fan").alias(name))
    same = _conjunction([F.col(k).eqNullSafe(F.col(h)) for k, h in zip(keys, helpers)])
    found = df.join(F.broadcast(named) if fits_in_memory(named) else named, same, "left").drop(*helpers)
    return found.withColumn(name, F.coalesce(name, F.lit(1)))


def _salt(df: DataFrame, fan: str) -> Column:
    """A salt below the fan that follows from the row and its input partition, so that a
    lost task that runs again gives the same, and exact copies spread as well."""
    own = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns if c != fan])
    return F.when(F.col(fan) > 1, F.pmod(own, F.col(fan))).otherwise(0).cast("int")


def _each_salt(fan: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(fan) - 1))


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    condition: Column | None = None,
    small: bool | None = None,
    small_rows: int = SMALL_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left or inner join on pairs of (left column, right column).

    All column names must differ between the sides. ``small`` skips the count when the
    caller already knows the size of the right side.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    twice = set(left.columns) & set(right.columns)
    if twice:
        raise ValueError(f"columns on both sides: {sorted(twice)}")

    equal = [F.col(a) == F.col(b) for a, b in on]
    extra = [] if condition is None else [condition]
    if small is None:
        small = fits_in_memory(right, small_rows)
    if small:
        return left.join(F.broadcast(right), _conjunction(equal + extra), how)

    left_keys = [a for a, _ in on]
    right_keys = [b for _, b in on]
    known = right.dropna(subset=right_keys)
    # Staged, as several steps ask for them and each would count all rows again.
    left_fans = staged(hot_keys(left, left_keys, hot_rows), "hot-keys")
    right_fans = staged(hot_keys(known, right_keys, hot_rows), "hot-keys")
    fanned = _with_fan(left, left_keys, left_fans, "_fan_l")
    other = _with_fan(known, right_keys, left_fans, "_fan_l")
    if right_fans.isEmpty():
        own = fanned.withColumn("_salt_l", _salt(fanned, "_fan_l")).drop("_fan_l")
        each = other.withColumn("_salt_r", _each_salt("_fan_l")).drop("_fan_l")
        match = _conjunction(equal + [F.col("_salt_l") == F.col("_salt_r")] + extra)
        return own.join(each, match, how).drop("_salt_l", "_salt_r")

    # A grid for keys that are hot on the right: each right row in one of its columns,
    # each left row in all of them. A left row without a match would come out once per
    # column, so the grid is an inner join, and such rows are added by their number.
    fanned = staged(_with_fan(fanned, left_keys, right_fans, "_fan_r").withColumn("_row", F.monotonically_increasing_id()), "left-rows")
    other = _with_fan(other, right_keys, right_fans, "_fan_r")
    own = fanned.withColumn("_salt_l", _salt(fanned, "_fan_l")).withColumn("_side_l", _each_salt("_fan_r")).drop("_fan_l", "_fan_r")
    each = other.withColumn("_side_r", _salt(other, "_fan_r")).withColumn("_salt_r", _each_salt("_fan_l")).drop("_fan_l", "_fan_r")
    match = _conjunction(
        equal + [F.col("_salt_l") == F.col("_salt_r"), F.col("_side_l") == F.col("_side_r")] + extra
    )
    met = own.join(each, match, "inner").drop("_salt_l", "_salt_r", "_side_l", "_side_r")
    if how == "left":
        met = staged(met, "met-rows")
        lost = fanned.drop("_fan_l", "_fan_r").join(met.select("_row").distinct(), "_row", "left_anti")
        met = met.unionByName(lost, allowMissingColumns=True)
    return met.drop("_row")
