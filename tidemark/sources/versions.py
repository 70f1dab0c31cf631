"""Versions of a warehouse's tables: build beside the old ones, check, then switch.

A run writes into folders of its own, ``<layer>/<table>/run=<run>/``, and leaves those that
readers use alone. A version tells for every table and day which run's folder holds it and
what it was built from. It is a small table that counts once its write is complete, so
ending that write switches all tables at once; a run that fails before changes nothing.
The tables that a version names have an entry for each calendar day, so versions are
small however large the tables are.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import delete, side_by_side
from tidemark.sources import tables

_ENTRY = "layer string, name string, day string, run string, source string"

#: The day of a table without days, and what tells of a day without rows.
WHOLE, EMPTY = "", "none"

Table = tuple[str, str]


@dataclass
class Version:
    """By table and day the run that holds it (None: it has no row) and what it was built from."""

    number: int = 0
    entries: dict[Table, dict[str, tuple[str | None, str]]] = field(default_factory=dict)

    def tokens(self, layer: str, name: str) -> dict[str, str]:
        """What tells the days of a table apart from any other build of them."""
        return {day: run or EMPTY for day, (run, _) in self.entries.get((layer, name), {}).items()}


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The complete versions, oldest first."""
    store, path = _folder(spark, f"{root.rstrip('/')}/versions")
    if not store.exists(path):
        return []
    done = []
    for status in store.listStatus(path):
        own = status.getPath()
        if store.exists(_folder(spark, f"{own.toString()}/_SUCCESS")[1]):
            done.append(int(own.getName().removeprefix("v=")))
    return sorted(done)


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or the one with a number; an empty one where there is none."""
    known = numbers(spark, root)
    if number is None and not known:
        return Version()
    version = Version(known[-1] if number is None else number)
    rows = spark.read.schema(_ENTRY).parquet(f"{root.rstrip('/')}/versions/v={version.number:08d}").collect()
    for r in rows:  # one for each table and calendar day
        version.entries.setdefault((r.layer, r.name), {})[r.day] = (r.run, r.source)
    return version


def read(spark: SparkSession, root: str, layer: str, name: str, version: Version | None = None,
         days: Iterable[str] | None = None) -> DataFrame:
    """A table as a version has it, or some days of it; a table that no version names is read as it lies there."""
    entries = (version or current(spark, root)).entries.get((layer, name))
    path = tables.table_path(root, layer, name)
    if entries is None:
        return spark.read.parquet(path)
    if WHOLE in entries:
        return spark.read.parquet(f"{path}/run={entries[WHOLE][0]}")
    asked = entries if days is None else set(days) & set(entries)
    column = tables.DAY_COLUMNS[layer, name]
    folders = [f"{path}/run={run}/{column}={day}" for day in sorted(asked) if (run := entries[day][0])]
    if not folders:
        filled = [f"{path}/run={run}" for run, _ in entries.values() if run]
        return spark.read.parquet(filled[0] if filled else f"{path}/none").limit(0)
    return spark.read.option("basePath", path).parquet(*folders).drop("run")


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A stored table, as the newest version has it."""
    return read(spark, root, layer, name)


class Draft:
    """The next version of a warehouse, seen by nobody until it is committed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version = current(spark, root)
        self.run = f"r{self.version.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        self.written: set[Table] = set()
        self.changed = False

    def read(self, layer: str, name: str, days: Iterable[str] | None = None) -> DataFrame:
        return read(self.spark, self.root, layer, name, self.version, days)

    def stale(self, layer: str, name: str, sources: Mapping[str, str], everything: bool = False) -> list[str]:
        """The days of ``sources`` that were built from something else, or never; days that it lacks leave the table."""
        entries = self.version.entries.setdefault((layer, name), {})
        for day in set(entries) - set(sources):
            del entries[day]
            self.changed = True
        return sorted(day for day, source in sources.items()
                      if everything or day not in entries or entries[day][1] != source)

    def write_days(self, layer: str, name: str, rows: DataFrame | None, sources: Mapping[str, str]) -> None:
        """Makes ``rows`` the days of ``sources``; None, and days without a row: they are empty."""
        folder, column = f"{tables.table_path(self.root, layer, name)}/run={self.run}", tables.DAY_COLUMNS[layer, name]
        found: set[str] = set()
        if rows is not None:
            self.written.add((layer, name))
            tables.write_days(rows, folder, column)
            listed = tables.stored_partitions(self.spark, folder, column)
            found = set() if listed is None else {str(r[0]) for r in listed.collect()}
        entries = self.version.entries.setdefault((layer, name), {})
        entries.update({day: (self.run if day in found else None, source) for day, source in sources.items()})
        self.changed = True

    def write(self, layer: str, name: str, rows: DataFrame, source: str) -> None:
        self.written.add((layer, name))
        tables.write_table(rows, f"{tables.table_path(self.root, layer, name)}/run={self.run}")
        self.version.entries[layer, name] = {WHOLE: (self.run, source)}
        self.changed = True

    def source(self, layer: str, name: str) -> str | None:
        """What a table without days was built from."""
        return self.version.entries.get((layer, name), {}).get(WHOLE, (None, None))[1]

    def commit(self) -> int:
        """Switches to this version, which fails where another run has done so meanwhile; the version's number."""
        if self.changed:
            rows = [(layer, name, day, run, source) for (layer, name), days in sorted(self.version.entries.items())
                    for day, (run, source) in sorted(days.items())]
            number = self.version.number + 1
            self.spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(f"{self.root}/versions/v={number:08d}")
            self.version.number = number
        return self.version.number

    def abandon(self) -> None:
        """Deletes what was written; the version in use stays."""
        for layer, name in self.written:
            delete(self.spark, f"{tables.table_path(self.root, layer, name)}/run={self.run}")


def digest(tokens: Mapping[str, str]) -> str:
    """One token for all days of a table."""
    return hashlib.sha256(repr(sorted(tokens.items())).encode()).hexdigest()


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes all but the newest ``keep`` versions and the days that none of these names; the number of days deleted.

    Readers of an older version lose it.
    """
    root, known = root.rstrip("/"), numbers(spark, root)
    kept = [current(spark, root, n) for n in known[-keep:]]
    used = {(table, day, run) for v in kept for table, days in v.entries.items() for day, (run, _) in days.items() if run}
    gone = 0
    for layer, name in sorted({table for v in kept for table in v.entries}):
        path, column = tables.table_path(root, layer, name), tables.DAY_COLUMNS.get((layer, name))
        files = tables.stored_files(spark, path)
        if files is None:
            continue
        columns = ["run", *([column] if column else [])]
        for r in files.select(columns).distinct().collect():  # a folder for each calendar day and run
            day = str(r[1]) if column else WHOLE
            if ((layer, name), day, r.run) not in used:
                delete(spark, f"{path}/run={r.run}" + (f"/{column}={day}" if column else ""))
                gone += 1
    for n in known[:-keep]:
        delete(spark, f"{root}/versions/v={n:08d}")
    return gone


def listing(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """(layer, name, days, empty_days): what the version names."""
    entries = (version or current(spark, root)).entries
    rows = [(layer, name, sum(run is not None for run, _ in days.values()), sum(run is None for run, _ in days.values()))
            for (layer, name), days in sorted(entries.items())]
    return spark.createDataFrame(rows, "layer string, name string, days long, empty_days long").orderBy("layer", "name")


def register_views(spark: SparkSession, root: str, layout: list[tuple[str, str]] = tables.LAYOUT) -> DataFrame:
    """A view per readable table, over the files, and ``(layer, table, rows, status)`` for all of them.

    Each table is counted by itself; one that cannot be read loses its view and is
    told as ``unreadable``, one that is not there as ``missing``.
    """
    version = current(spark, root)

    def state(layer: str, name: str) -> tuple[str, str, int | None, str]:
        try:
            table = read(spark, root, layer, name, version)
            rows = table.count()
            table.createOrReplaceTempView(tables.view_name(layer, name))
            return layer, name, rows, "ready"
        except (PySparkException, Py4JJavaError) as error:
            absent = isinstance(error, AnalysisException) and error.getCondition() in tables.ABSENT
            spark.catalog.dropTempView(tables.view_name(layer, name))
            return layer, name, None, "missing" if absent else "unreadable"

    states = side_by_side(spark, [partial(state, *table) for table in layout])
    return spark.createDataFrame(states, "layer string, table string, rows long, status string")
