"""Readers for the raw and derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spoorlens.functions.values import to_day
from spoorlens.operators.calendar import events_in_text


def read_csv(spark: SparkSession, path: str | list[str], spread: bool = False) -> DataFrame:
    """CSV with a header, plain or gzipped, every column as text.

    Files whose header differs from the first one's raise an error instead of shifting
    values into other columns. A gzipped file is read by one task; ``spread`` deals
    its rows over tasks of even size where no join follows that shuffles them anyway.
    """
    df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return df.hint("rebalance") if spread else df


def read_parquet(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Parquet; ``merge`` unites the columns of files that differ in them."""
    return spark.read.option("mergeSchema", merge).parquet(path)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).select(to_day("event_date").alias("event_date"), "name", "category")


def read_ical(spark: SparkSession, path: str) -> DataFrame:
    """Events of iCalendar files.

    The beginning of an event separates the records, so that a large file is split over
    tasks at events and never held whole. What precedes the first event has no end line
    and yields nothing.
    """
    chunks = spark.read.option("lineSep", "BEGIN:VEVENT").text(path)
    numbered = chunks.select(
        F.concat(F.lit("BEGIN:VEVENT"), F.col("value")).alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.format_string("%020d", F.col("_metadata.file_block_start")).alias("block"),
        F.format_string("%020d", F.monotonically_increasing_id()).alias("line"),
    )
    return events_in_text(numbered, "text", [F.col("file"), F.col("block"), F.col("line")])
