"""Jobs that read only the input files that are new, changed or gone.

A ledger beside the output holds path, size and time of every input file, and the months
of its rows. A run lists the files, compares them with the ledger, and rewrites the months
that a changed file has rows in, or had before; for these it reads the changed files and
the unchanged ones with rows in the same months, and no other. Where nothing has changed
no file is opened. A change of an input that all rows depend on rewrites everything.

The ledger is written after the months. A run that dies in between is repeated by the
next one, which rewrites the same months with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spoorlens.functions.values import month_key
from spoorlens.operators import stops, weather
from spoorlens.session import staged
from spoorlens.sources import readers, writers

Month = tuple[str, ...]  # values of the partition columns as in folder names
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class File:
    size: int
    modified: int
    months: frozenset[Month] = field(default=frozenset(), compare=False)


@dataclass(frozen=True)
class Refreshed:
    """What a run did: input files that it opened, and months that it wrote or deleted."""

    read: list[str]
    months: list[Month]


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, pattern: str) -> dict[str, File]:
    """Files that a path or pattern names, in folders below it as well; names that begin
    with a dot or an underscore are left out, as Spark does."""
    fs = _file_system(spark, pattern)
    found: dict[str, File] = {}

    def visit(status) -> None:
        path = status.getPath()
        if path.getName()[:1] in "._":
            return
        if status.isDirectory():
            for inner in fs.listStatus(path):
                visit(inner)
        else:
            found[path.toString()] = File(status.getLen(), status.getModificationTime())

    for status in fs.globStatus(_path(spark, pattern)) or []:
        visit(status)
    return found


LEDGER_SCHEMA = "input string, path string, size long, modified long, months array<array<string>>"


class Ledger:
    """Versions in folders; the highest complete one counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        fs = _file_system(self.spark, self.folder)
        done = fs.globStatus(_path(self.spark, f"{self.folder}/version=*/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)

    def load(self) -> dict[str, dict[str, File]]:
        out: dict[str, dict[str, File]] = {}
        versions = self.versions()
        if versions:
            table = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.folder}/version={versions[-1]}")
            for r in table.collect():  # a row per input file
                months = frozenset(tuple(m) for m in r["months"] or [])
                out.setdefault(r["input"], {})[r["path"]] = File(r["size"], r["modified"], months)
        return out

    def save(self, inputs: dict[str, dict[str, File]]) -> None:
        old = self.versions()
        rows = [
            (name, path, f.size, f.modified, [list(m) for m in sorted(f.months)])
            for name, files in inputs.items() for path, f in files.items()
        ]
        number = (old[-1] + 1) if old else 1
        table = self.spark.createDataFrame(rows, LEDGER_SCHEMA)
        table.write.mode("overwrite").parquet(f"{self.folder}/version={number}")
        for n in old[:-1]:  # the one before stays
            _file_system(self.spark, self.folder).delete(_path(self.spark, f"{self.folder}/version={n}"), True)


def _in_folder(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_FOLDER))


def _month_of(columns: Sequence[str]) -> Column:
    return F.array(*[_in_folder(c) for c in columns])


def refresh(
    spark: SparkSession, inputs: dict[str, str], main: str, out: str, ledger: str, by: Sequence[str],
    parse: Callable[[list[str]], DataFrame], finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    compression: str | None = None,
) -> Refreshed:
    """Bring the table ``out``, in folders by the columns ``by``, up to its input files.

    ``parse`` reads files of the input ``main`` and keeps the name of each row's file in
    ``_file``; ``finish`` makes rows of the table from them. All rows depend on the other
    inputs.
    """
    book = Ledger(spark, ledger)
    before = book.load()
    now = {name: list_files(spark, pattern) for name, pattern in inputs.items()}
    known = before.get(main, {})
    whole = not before or any(now[name] != before.get(name, {}) for name in inputs if name != main)
    changed = [p for p, f in now[main].items() if whole or known.get(p) != f]
    gone = [p for p in known if p not in now[main]]
    if not changed and not gone and not whole:
        return Refreshed([], [])

    months: dict[str, frozenset[Month]] = {p: f.months for p, f in known.items() if p in now[main]}
    fresh = None
    if changed:
        fresh = staged(parse(changed), "fresh-rows")
        seen = fresh.select("_file", _month_of(by).alias("month")).distinct().collect()  # files times their months
        found: dict[str, set[Month]] = {}
        for r in seen:
            uri = spark._jvm.java.net.URI(r["_file"])
            found.setdefault(spark._jvm.org.apache.hadoop.fs.Path(uri).toString(), set()).add(tuple(r["month"]))
        months.update({p: frozenset(found.get(p, ())) for p in changed})
    touched = {m for p in changed for m in months[p]}
    touched |= {m for p in [*changed, *gone] if p in known for m in known[p].months}
    again = [p for p in now[main] if p not in set(changed) and months[p] & touched]
    rows = fresh
    if again:
        held = parse(again)
        rows = held if rows is None else rows.unionByName(held, allowMissingColumns=True)
    if rows is not None and (whole or touched):
        if not whole:
            names = [F.array(*[F.lit(v) for v in m]) for m in sorted(touched)]
            rows = rows.filter(_month_of(by).isin(*names))
        writers.write_parquet(
            finish(rows.drop("_file")), out, partitions=by, compression=compression, only_given_partitions=not whole
        )
    left = {m for p in now[main] for m in months[p]}
    for month in touched - left:
        folder = "/".join(f"{c}={v}" for c, v in zip(by, month))
        _file_system(spark, out).delete(_path(spark, f"{out}/{folder}"), True)
    now[main] = {p: File(f.size, f.modified, months[p]) for p, f in now[main].items()}
    book.save(now)
    return Refreshed(sorted([*changed, *again]), sorted(touched))


def refresh_master(
    spark: SparkSession, services_csv: str, stations_csv: str, disruptions_csv: str, out: str, ledger: str
) -> Refreshed:
    """``jobs.build_master`` for changed stop files only."""

    def parse(paths: list[str]) -> DataFrame:
        raw = readers.read_csv(spark, paths)
        return stops.clean_services(raw.select("*", F.col("_metadata.file_path").alias("_file")))

    def finish(rows: DataFrame) -> DataFrame:
        return stops.master_table(
            rows, stops.clean_stations(readers.read_csv(spark, stations_csv)),
            staged(stops.clean_disruptions(readers.read_csv(spark, disruptions_csv)), "disruptions"),
        )

    inputs = {"services": services_csv, "stations": stations_csv, "disruptions": disruptions_csv}
    return refresh(spark, inputs, "services", out, ledger, ["year", "month"], parse, finish, "snappy")


def refresh_months(spark: SparkSession, readings: str, out: str, ledger: str, time: str = "time") -> Refreshed:
    """``jobs.compact_weather`` for changed files only."""

    def parse(paths: list[str]) -> DataFrame:
        raw = spark.read.option("mergeSchema", True).parquet(*paths)
        timed = weather.parse_time(raw.select("*", F.col("_metadata.file_path").alias("_file")), time, time)
        return timed.withColumn("month", month_key(time))

    return refresh(spark, {"readings": readings}, "readings", out, ledger, ["month"], parse)
