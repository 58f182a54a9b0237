"""Stored partial results that reports merge, so that stops are not read again.

``hour_states`` holds, per day and hour, sums from which every count and mean of the
report follows; states of several hours are added up. ``service_sets`` holds, per day,
the set of its services as bitmaps; sets of several days are united, so the number of
different services of a month or year is exact. Both are kept in folders by day, and
``refresh_days`` replaces the days whose stops have changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spoorlens.operators import rollup
from spoorlens.operators.skew import keyed_join
from spoorlens.session import staged
from spoorlens.sources import writers

SUMS = ["services_in_hour", *rollup.SHARES.values(), "mean_sum", "mean_n", "late_mean_sum", "late_mean_n"]


def hour_states(per_service: DataFrame) -> DataFrame:
    """Sums per day and hour of ``rollup.service_hours``."""
    mean = rollup.mean_delay()
    counts = rollup.delay_counts()
    named = {name: c for name, c in zip(["services_in_hour", *rollup.SHARES.values()], counts)}
    return per_service.groupBy("day", "hour").agg(
        *[c.alias(name) for name, c in named.items()],
        F.sum(mean).alias("mean_sum"), F.count(mean).alias("mean_n"),
        F.sum(F.when(mean > 0, mean)).alias("late_mean_sum"), F.count_if(mean > 0).alias("late_mean_n"),
    )


def merged(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Counts, shares and means of all hours of a group; ``by`` names the groups, such as
    a year or a season, from the columns of the states."""
    sums = states.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])
    kept = [c for c in sums.columns if c not in SUMS]
    return sums.select(
        *kept, *SUMS[:-4], *rollup.delay_shares(),
        F.try_divide("mean_sum", "mean_n").alias("avg_avg_delay_all_services"),
        F.try_divide("late_mean_sum", "late_mean_n").alias("avg_avg_delay_delays_only"),
    )


def numbered(ids: DataFrame, name: str) -> DataFrame:
    """Distinct values of a column with dense numbers from 0, in sorted order: a row per
    value, in ``value`` and ``number``. Nulls have no number."""
    values = ids.select(F.col(name).alias("value")).filter(F.col("value").isNotNull()).distinct()
    parts = staged(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "values")
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    offsets = sizes.select(
        F.col("part").alias("_part"),
        F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return parts.withColumn("_place", place).join(F.broadcast(offsets), F.col("part") == F.col("_part")).select(
        "value", (F.col("_offset") + F.col("_place") - 1).alias("number")
    )


def service_sets(stops: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Per day the set of its services: a bitmap per block of 32,768 numbers.

    A service that is a whole number stands for itself. Others need ``numbers`` (value,
    number), as of ``numbered``, which must give a service the same number on every day.
    """
    seen = stops.select("day", "service").filter(F.col("service").isNotNull())
    if numbers is not None:
        seen = keyed_join(seen, numbers, [("service", "value")], how="inner").select("day", F.col("number").alias("service"))
    elif not isinstance(stops.schema["service"].dataType, T.IntegralType):
        raise ValueError("services that are not whole numbers need numbers")
    whole = F.col("service").cast("long")
    return seen.groupBy("day", F.bitmap_bucket_number(whole).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(whole)).alias("services")
    )


def different_services(sets: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Number of different services of the united days of each group."""
    united = sets.groupBy(*by, "block").agg(F.bitmap_or_agg("services").alias("services"))
    kept = [c for c in united.columns if c not in ("block", "services")]
    return united.groupBy(*kept).agg(F.sum(F.bitmap_count("services")).alias("different_services"))


def write_states(states: DataFrame, path: str) -> None:
    writers.write_parquet(states, path, partitions=["day"])


def refresh_days(states: DataFrame, path: str, days: DataFrame) -> None:
    """Replace the stored states of ``days`` (a column ``day``, a row per day) by those of
    ``states``; a day without any left loses its folder. ``states`` is computed for these
    days alone, as the filter goes below its aggregation."""
    spark = states.sparkSession
    wanted = [r[0] for r in days.select(F.col("day").cast("date")).distinct().collect()]  # calendar days
    if not wanted:
        return
    fresh = staged(states.filter(F.col("day").isin(*wanted)), "states")
    writers.write_parquet(fresh, path, partitions=["day"], only_given_partitions=True)
    left = {r[0] for r in fresh.select("day").distinct().collect()}
    conf = spark._jsc.hadoopConfiguration()
    for day in set(wanted) - left:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={day}")
        folder.getFileSystem(conf).delete(folder, True)
