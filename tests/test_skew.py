import pytest
from pyspark.sql import functions as F

from conftest import rows
from spoorlens.operators import skew


def _sides(spark):
    # Key 1 has a third of all rows, a quarter has no key, and many rows are exact copies.
    left = spark.range(1200).select(
        F.when(F.col("id") < 400, 1).when(F.col("id") < 700, None).otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.lit(-1)).alias("v"),
    )
    right = spark.createDataFrame([(i, f"r{i}") for i in range(0, 40)] + [(1, "again"), (None, "none")], "rk int, w string")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("options", [{}, {"small_rows": 0}, {"small_rows": 0, "hot_rows": 20}, {"small_rows": 0, "hot_rows": 1}])
def test_equals_plain_join(spark, how, options):
    left, right = _sides(spark)
    want = rows(left.join(right, left.k == right.rk, how))
    assert rows(skew.keyed_join(left, right, [("k", "rk")], how=how, **options)) == want


def test_hot_key_and_missing_key_are_spread(spark):
    left, right = _sides(spark)
    fans = {r.k: r._fan for r in skew.hot_keys(left, ["k"], 100).collect()}
    assert fans == {1: 5, None: 3}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.keyed_join(left, right, [("k", "rk")], small_rows=0, hot_rows=100)
        parts = joined.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("p").alias("n"))
        spread = {r.k: r.n for r in parts.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert spread[1] > 1 and spread[None] > 1


def test_size_check(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert skew.fits_in_memory(df, 10)
    assert not skew.fits_in_memory(df, 9)
    assert not skew.fits_in_memory(df, 10, max_bytes=500)
    assert not skew.fits_in_memory(df, 0)
    many = spark.range(skew.GLANCE_ROWS + 5).select("id", F.lit("x").alias("s"))
    assert skew.fits_in_memory(many)
    assert not skew.fits_in_memory(many, skew.GLANCE_ROWS)
    assert not skew.fits_in_memory(many, skew.GLANCE_ROWS + 4)
    assert skew.fits_in_memory(many, skew.GLANCE_ROWS + 5)
    assert not skew.fits_in_memory(many, max_bytes=33 * skew.GLANCE_ROWS)


def test_bad_arguments(spark):
    left, right = _sides(spark)
    with pytest.raises(ValueError):
        skew.keyed_join(left, right, [("k", "rk")], how="outer")
    with pytest.raises(ValueError):
        skew.keyed_join(left, left, [("k", "k")])


def _right_hot(spark):
    left = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 100), (None, 101), (9, 102)], "k int, v int")
    right = spark.createDataFrame([(1, i) for i in range(60)] + [(2, 5), (3, 6)], "rk int, w int")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [10, 20, 1000])
def test_keys_hot_on_the_right(spark, how, hot_rows):
    left, right = _right_hot(spark)
    near = F.col("w") >= F.col("v") + 40
    want = rows(left.join(right, (left.k == right.rk) & near, how))
    got = skew.keyed_join(left, right, [("k", "rk")], how=how, condition=near, small_rows=0, hot_rows=hot_rows)
    assert got.columns == ["k", "v", "rk", "w"] and rows(got) == want


def test_every_hot_key_is_split(spark):
    many = spark.range(36_000).select((F.col("id") % 12_000).alias("k"))
    assert skew.hot_keys(many, ["k"], 2).count() == 12_000
