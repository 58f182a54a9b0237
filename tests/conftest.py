import io
import os
import sys
import tempfile
from contextlib import redirect_stdout

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def zone(spark):
    """Set the session zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def rows(df, *columns):
    """Rows as sorted tuples; nulls last."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
