"""Tables laid out by the keys of a join, so that later joins on them move no rows.

Rows are written in buckets by the hash of the keys, one file per bucket, and registered
in the session's catalog. Two tables with equal keys and bucket counts are joined bucket
by bucket without an exchange; the shuffle is paid once, when a table is written.

The keys should name small groups, such as station, day and hour: all rows of a key lie in
one bucket. Rows without a key can match nothing and would all fall into one bucket, so
they are kept apart as plain files and added to the result of a left join.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from spoorlens.functions.values import all_present
from spoorlens.session import size_of

BUCKET_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table: rows with all keys, and rows that lack one."""

    keyed: DataFrame
    rest: DataFrame
    keys: tuple[str, ...]
    buckets: int


def buckets_for(spark: SparkSession, paths: Sequence[str], least: int = 8) -> int:
    """Buckets for tables made from these files: a power of two, ``BUCKET_BYTES`` each."""
    wanted = max(least, -(-size_of(spark, paths) // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> Bucketed:
    """Write ``df`` below ``path`` in buckets by ``keys`` and open it."""
    whole = all_present(*keys)
    name = f"bucketed_{uuid.uuid4().hex}"
    # The exchange hashes as buckets do, so a task writes one bucket.
    dealt = df.filter(whole).repartition(buckets, *[F.col(k) for k in keys])
    (
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", f"{path}/keyed").saveAsTable(name)
    )
    df.filter(~whole).write.parquet(f"{path}/rest")
    spark = df.sparkSession
    return Bucketed(spark.table(name), spark.read.schema(df.schema).parquet(f"{path}/rest"), tuple(keys), buckets)


def open_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> Bucketed:
    """A table that an earlier session has written with these keys and buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{path}/keyed").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/keyed'"
    )
    return Bucketed(spark.table(name), spark.read.schema(schema).parquet(f"{path}/rest"), tuple(keys), buckets)


def join_in_place(left: Bucketed, right: Bucketed, how: str = "left") -> DataFrame:
    """Left or inner join on the keys, in the order of both. All column names must differ."""
    if left.buckets != right.buckets or len(left.keys) != len(right.keys):
        raise ValueError("both tables need the same number of buckets and of keys")
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    kinds = [dict(t.keyed.dtypes) for t in (left, right)]
    for a, b in zip(left.keys, right.keys):
        if kinds[0][a] != kinds[1][b]:  # hashes of different types differ
            raise ValueError(f"{a} and {b} differ in type: {kinds[0][a]}, {kinds[1][b]}")
    same = reduce(lambda x, y: x & y, [F.col(a) == F.col(b) for a, b in zip(left.keys, right.keys)])
    joined = left.keyed.join(right.keyed.hint("merge"), same, how)
    if how == "inner":
        return joined
    return joined.unionByName(left.rest, allowMissingColumns=True)
