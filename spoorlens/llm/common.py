"""What the operators of this subpackage share: words, staging, row order."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spoorlens.session import scratch_dir, setting  # noqa: F401

# A word is a longest run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order, without regular expressions per word."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def held_together(df: DataFrame, filter_by: str) -> DataFrame:
    """The rows for which the column ``filter_by`` is true, found after the columns are made.

    Spark moves a filter below the projections that make its columns and computes them in
    both places. A row number in the condition keeps it above.
    """
    at = "_held_at"
    return df.withColumn(at, F.monotonically_increasing_id()).filter(F.col(filter_by) & (F.col(at) >= 0)).drop(at)


class Staging:
    """Tables written to the shared scratch folder, each read back at once.

    Writing cuts the lineage: a lost executor costs a read of shared files. ``drop``
    deletes a table that nothing will read again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.held: list[DataFrame] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        return self._keep(out, path)

    def derived(self, table: DataFrame, view: DataFrame) -> DataFrame:
        """``view``, by which ``table`` can be dropped."""
        return self._keep(view, self.paths.pop(id(table)))

    def _keep(self, table: DataFrame, path: str) -> DataFrame:
        self.paths[id(table)] = path
        self.held.append(table)  # an id stands for one object only while that lives
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, which may not have it on their path.

    Spark copies the archive to the executors. Once per application.
    """
    import spoorlens

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.abspath(spoorlens.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "spoorlens.zip")  # on the driver, for its file server
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def squeezed(docs: DataFrame) -> DataFrame:
    """Key, 128-bit name of the text and the text itself as zstd, for an exchange of texts.

    ``docs`` has ``key`` and ``text`` without nulls.
    """
    import pyarrow as pa
    import zstandard

    def work(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [packer.compress(t.as_py().encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "t1", "t2")] + [pa.array(packed, pa.binary())], ["key", "t1", "t2", "z"]
            )

    return named_texts(docs).mapInArrow(work, "key long, t1 long, t2 long, z binary")


def unsqueezed(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)


def named_texts(docs: DataFrame) -> DataFrame:
    """Key, text, and a 128-bit name of the text."""
    return docs.select("key", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def slices_by_size(batch, column: int, most: int):
    """Slices of an Arrow batch with about ``most`` bytes in a text column, one row at
    least; with each, the bytes of its texts one after another, and their borders."""
    import numpy as np
    import pyarrow as pa

    texts = batch.column(column).cast(pa.large_binary())
    borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(borders, borders[start] + most, "right")) - 1)
        ends = borders[start:stop + 1]
        yield batch.slice(start, stop - start), data[ends[0]:ends[-1]], ends - ends[0]
        start = stop
