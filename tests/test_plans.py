"""Properties of the physical plans that matter at scale."""

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as contract
from conftest import plan
from spoorlens.operators import keep_one, rollup, skew
from spoorlens.plans import jobs
from spoorlens.workload import roles

FOLDER = "/root/testdata/sf0.001"


def test_first_row_per_key_is_taken_before_the_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet")
    text = plan(keep_one.keep_one(df.select("user_id", "value"), ["user_id"]))
    assert text.count("WindowGroupLimit") >= 2


def test_small_side_is_broadcast_and_large_side_is_salted(spark):
    e = spark.read.parquet(f"{FOLDER}/events.parquet")
    c = spark.read.parquet(f"{FOLDER}/customer.parquet")
    assert "BroadcastHashJoin" in plan(skew.keyed_join(e, c, [("user_id", "c_custkey")]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(skew.keyed_join(e, c, [("user_id", "c_custkey")], small_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftOuter" in text and "_salt_l" in text


def test_report_aggregates_before_it_shuffles_and_reads_few_columns(spark):
    text = plan(rollup.hourly_report(rollup.service_hours(rollup.timed_stops(roles.stops(spark, FOLDER)))))
    assert "partial_max" in text and "partial_avg" in text
    assert "props" not in text and "ReadSchema: struct<event_id" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(contract.queries()["exclude_month"](spark, FOLDER))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    df = spark.read.parquet(f"{FOLDER}/events.parquet").filter(F.col("event_type") == "view")
    assert "EqualTo(event_type,view)" in plan(df)


def test_whole_keys_are_counted_only_among_hot_first_columns(spark):
    """Keys of several columns, of which no first column is hot: nothing is exchanged by whole keys."""
    df = spark.range(600).select((F.col("id") % 40).alias("a"), F.col("id").alias("b"))
    found = skew.hot_keys(df, ["a", "b"], 20)
    assert found.count() == 0 and "LeftSemi" in plan(found)
    more = df.unionByName(spark.range(90).select(F.lit(None).cast("long").alias("a"), (F.col("id") % 3).alias("b")))
    assert sorted((r["a"], r["b"], r["_fan"]) for r in skew.hot_keys(more, ["a", "b"], 20).collect()) == [(None, b, 2) for b in range(3)]


def test_nothing_is_exchanged_after_the_weather_join(spark, folder, monkeypatch):
    """Each stop becomes a row per reading, which go straight to their folders, unsorted."""
    given = spark.range(60).select(
        F.col("id").alias("stop_rdt_id"), F.lit("A").alias("stop_station_code"), F.timestamp_seconds(F.col("id") * 60).alias("stop_event_ts"),
        F.lit(1970).alias("year"), (F.col("id") % 2 + 1).cast("int").alias("month"))
    given.write.partitionBy("year", "month").parquet(f"{folder}/master")
    spark.createDataFrame([("A", "52.0", "5.0")], "code string, geo_lat string, geo_lng string").write.parquet(f"{folder}/stations")
    spark.createDataFrame([(1, f"1970-01-01 00:{m:02d}:00", 52.0, 5.0, float(m)) for m in range(30)], "station int, time string, lat double, lon double, T double") \
        .write.parquet(f"{folder}/readings")
    seen, write = [], DataFrameWriter.parquet

    def watched(self, path, *args, **kwargs):
        if path.endswith("/out"):
            seen.append((plan(self._df), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    got = jobs.attach_weather(spark, f"{folder}/master", f"{folder}/stations", f"{folder}/readings", f"{folder}/out", f"{folder}/mapping")
    table = got["services_with_weather"]
    assert table.count() == 60 * 30 and table.select("year", "month").distinct().count() == 2
    (text, folders), = seen
    assert "REBALANCE" not in text and int(folders) > 0
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 0
