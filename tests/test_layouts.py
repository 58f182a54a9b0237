"""Bucketed tables and month folders: what their joins read and move."""

import datetime
import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from spoorlens.operators import weather
from spoorlens.session import staged
from spoorlens.sources import bucketed, readers, writers
from spoorlens.workload import files


def sides(spark):
    left = spark.createDataFrame([(n, n % 7 if n % 5 else None, "x") for n in range(200)], "id int, k int, v string")
    right = spark.createDataFrame([(k, h, f"r{k}{h}") for k in range(0, 6) for h in range(2)], "rk int, h int, w string")
    return left, right


def test_join_in_place_moves_nothing(spark, folder):
    left, right = sides(spark)
    a = bucketed.write_bucketed(left, f"{folder}/a", ["k"], 8)
    b = bucketed.write_bucketed(right, f"{folder}/b", ["rk"], 8)
    joined = bucketed.join_in_place(a, b)
    text = plan(joined)
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
    want = left.join(right, F.col("k") == F.col("rk"), "left")
    assert rows(joined, "id", "k", "v", "rk", "h", "w") == rows(want, "id", "k", "v", "rk", "h", "w")
    inner = bucketed.join_in_place(a, b, "inner")
    assert rows(inner, "id", "w") == rows(left.join(right, F.col("k") == F.col("rk")), "id", "w")
    # A later session opens the files again.
    again = bucketed.join_in_place(bucketed.open_bucketed(spark, f"{folder}/a", ["k"], 8), b)
    assert "Exchange" not in plan(again) and rows(again, "id", "w") == rows(want, "id", "w")


def test_layouts_that_do_not_fit_are_refused(spark, folder):
    left, right = sides(spark)
    a = bucketed.write_bucketed(left, f"{folder}/a", ["k"], 8)
    with pytest.raises(ValueError, match="number of buckets"):
        bucketed.join_in_place(a, bucketed.write_bucketed(right, f"{folder}/b", ["rk"], 4))
    other = right.withColumn("rk", F.col("rk").cast("long"))
    with pytest.raises(ValueError, match="type"):
        bucketed.join_in_place(a, bucketed.write_bucketed(other, f"{folder}/c", ["rk"], 8))
    with pytest.raises(ValueError, match="how"):
        bucketed.join_in_place(a, a, "outer")


def test_only_months_of_the_stops_are_read(spark, folder):
    at = datetime.datetime
    readings = spark.createDataFrame([(s, at(2020 + y, m, 3, 4), float(m)) for s in range(3) for y in range(2) for m in range(1, 13)], "station int, time timestamp, T double")
    writers.write_monthly(readings, folder)
    stops = spark.createDataFrame([(at(2020, 5, 1),), (at(2021, 2, 9),), (None,), (at(2030, 1, 1),)], "ts timestamp")
    kept = weather.of_months(readers.read_parquet(spark, folder), stops, "ts")
    text = plan(kept)
    assert re.search("PartitionFilters: .*dynamicpruning", text)
    assert rows(kept.select("time").distinct()) == [(at(2020, 5, 3, 4),), (at(2021, 2, 3, 4),)]
    # Other months may be unreadable.
    for name in glob.glob(f"{folder}/month=*/*.parquet"):
        if "month=2020-05" not in name and "month=2021-02" not in name:
            with open(name, "wb") as file:
                file.write(b"no table")
    assert kept.count() == 6


@pytest.mark.parametrize("given, kind", [(None, "INT64"), ("INT96", "INT96")])
def test_times_are_written_in_eight_bytes(spark, folder, given, kind):
    """As the jobs' own session has it, also in any other session; what the user set stays."""
    name = "spark.sql.parquet.outputTimestampType"
    df = spark.range(5).select(F.timestamp_micros(F.col("id") * 86_400_123_457 - 10**15).alias("t"), F.col("id").alias("k"))
    assert spark.conf.get(name, None) is None
    if given:
        spark.conf.set(name, given)
    try:
        writers.write_parquet(df, f"{folder}/plain")
        writers.write_parquet(df, f"{folder}/folders", partitions=["k"], together=False)
        kept = staged(df, "times")
        assert spark.conf.get(name, None) == given
    finally:
        spark.conf.unset(name)
    for path in (f"{folder}/plain", f"{folder}/folders", kept.inputFiles()[0].removeprefix("file:")):
        found = glob.glob(f"{path}/**/*.parquet", recursive=True) or [path]
        assert {pq.ParquetFile(f).schema.column(0).physical_type for f in found} == {kind}
    for got in (kept, readers.read_parquet(spark, f"{folder}/plain"), readers.read_parquet(spark, f"{folder}/folders")):
        assert got.select("t").dtypes == df.select("t").dtypes and rows(got, "t") == rows(df, "t")


def test_stop_files_are_dealt_evenly_over_the_cores(spark, folder, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    spark.range(3 * cores).selectExpr(
        "id event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' ts", "id user_id", "'view' event_type", "1.5 value", "'p' props"
    ).write.parquet(f"{folder}/events.parquet")
    for a_file, want in ((1, 3 * cores), (2, 2 * cores), (3, cores), (100, cores)):
        monkeypatch.setattr(files, "ROWS_A_FILE", a_file)
        assert files._raw_services(spark, folder, spread=True).rdd.getNumPartitions() == want
