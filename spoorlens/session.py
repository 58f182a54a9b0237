"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Parquet files written by other tools: no calendar rebase, microsecond output,
# and nanosecond columns (which Spark has no type for) read as plain long.
PARQUET_CONF = {
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}

# Shuffles start with about this many bytes of input per partition. Adaptive execution
# merges what turns out small, but does not divide more finely than the initial number.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024

REPORT_TIME_ZONE = "Europe/Amsterdam"


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input of that size, 200 at least."""
    return max(200, -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION))


def size_of(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files that the paths and patterns name, from the file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def get_session(
    app: str, time_zone: str = REPORT_TIME_ZONE, input_paths: Sequence[str] = (), **extra: str
) -> SparkSession:
    """A session with the time zone pinned, since hours and dates depend on it.

    The shuffle width follows from the size of the inputs. What the user has set, as
    with ``spark-submit --conf``, stays; ``extra`` comes before both.
    """
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    wanted = {**RUNTIME_CONF, **PARQUET_CONF, "spark.sql.session.timeZone": time_zone}
    if "spark.sql.shuffle.partitions" not in given:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions(size_of(spark, input_paths)))
    for key, value in {**{k: v for k, v in wanted.items() if k not in given}, **extra}.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the jobs that run inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def short_times(spark: SparkSession):
    """Times written inside the block take eight bytes, unless the user has set otherwise.

    Spark's default of twelve bytes has no statistics, and each value is looked up in a hash
    table of all others of its file, which costs the most where many rows are written.
    """
    name = "spark.sql.parquet.outputTimestampType"
    with setting(spark, name, spark.conf.get(name, None) or PARQUET_CONF[name]):
        yield


SPREAD_BYTES = 64 * 1024 * 1024


def spread_if_small(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores where it is small enough that this costs little.

    A small file is one split, so that one task would do all of a costly step above it.
    Larger inputs have splits enough and are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= cores * SPREAD_BYTES else df


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Executors on other machines must see it. Where the setting is absent, as in tests,
    it is set to a folder in the warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Folders staged by this process and not dropped yet.
_staged: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back.

    For a table that several steps read: it is computed once, each step reads only the
    columns it needs, and a lost executor costs a read instead of the work above.
    ``drop_staged`` deletes what a job has staged.
    """
    path = scratch_dir(df.sparkSession, name)
    with short_times(df.sparkSession):
        df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside, also after an error. The results of a
    job must be written by then."""
    mark = len(_staged)
    try:
        yield
    finally:
        while len(_staged) > mark:
            path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
