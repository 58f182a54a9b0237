"""Query registry and what all queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Rounded doubles differ between engines on exact halves, so both sides add this first.
NUDGE = 1.2345e-9


def r6(c: str | Column) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(NUDGE), 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that every engine prints them alike."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss"}
    return df.withColumns({c: F.date_format(c, formats[t]) for c, t in df.dtypes if t in formats})
