"""Tables whose state is a commit record: a batch is seen as a whole, or not at all.

A batch is written to a folder of its own, ``batch=<id>``, in partition folders below. Then one
small record, ``_commits/<version>.json``, names the folders that are the table. It is written
aside and appears by rename, and the newest one is the table. So readers see the table before a
batch or after it, over however many days, and a run that breaks off anywhere leaves a folder
that nobody reads and nothing to undo. A record also keeps

* the newest stamp of the table, so an increment reads no column of it to find its mark, and
* which batches have a list of the landed files they took, so a file is loaded once.

There is one writer at a time; a second one fails at its record and changes nothing. The driver
handles one name for each partition folder and batch in use, never rows or files of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tramline.operators.filters import filter_hwm, high_water_mark
from tramline.session import place_of
from tramline.sinks.conform import schema_guard
from tramline.sinks.tables import only_days

_BATCH = "batch"
_FILE = ["path", "length", "modificationTime"]


class Conflict(Exception):
    """Another run has changed the table meanwhile."""


@dataclass(frozen=True)
class Commit:
    """One state of a table: ``live`` maps a partition folder ('' without any) to its batches."""

    version: int
    schema: str
    live: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)
    loads: list[str] = field(default_factory=list)


class CommittedTable:
    """A Parquet table under ``path`` that is read and changed through its commit records."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by

    # State.

    def _versions(self) -> list[int]:
        folder, fs = place_of(self.spark, f"{self.path}/_commits")
        if not fs.exists(folder):
            return []
        names = [found.getPath().getName() for found in fs.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != "_")

    def _record(self, version: int) -> str:
        return f"{self.path}/_commits/{version:012d}.json"

    def state(self, version: int | None = None) -> Commit | None:
        """The newest commit, or that of a version; None before the first."""
        known = self._versions()
        if not known:
            return None
        place, fs = place_of(self.spark, self._record(known[-1] if version is None else version))
        source = fs.open(place)
        try:
            return Commit(**json.loads(bytes(source.readAllBytes()).decode("utf-8")))
        finally:
            source.close()

    def exists(self) -> bool:
        return bool(self._versions())

    def _publish(self, commit: Commit) -> None:
        """The record appears complete, and only if no other of its version is there."""
        aside, fs = place_of(self.spark, f"{self.path}/_commits/_{uuid.uuid4().hex}")
        place, _ = place_of(self.spark, self._record(commit.version))
        sink = fs.create(aside, False)
        try:
            sink.write(bytearray(json.dumps(asdict(commit), sort_keys=True).encode("utf-8")))
        finally:
            sink.close()
        if fs.exists(place) or not fs.rename(aside, place):
            fs.delete(aside, False)
            raise Conflict(f"version {commit.version} of {self.path} is there already")

    # Reading.

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest state, or of an earlier version that was not expired."""
        commit = self.state(version)
        if commit is None:
            raise FileNotFoundError(f"no table at {self.path}")
        folders = [f"{self.path}/{_BATCH}={batch}/{name}".rstrip("/") for name, batches in commit.live.items() for batch in batches]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        held = self.spark.read.schema(StructType([*self.schema.fields]).add(_BATCH, "string"))
        return held.option("basePath", self.path).parquet(*folders).select(*(f"`{name}`" for name in self.schema.names))

    # Writing.

    def _write(self, rows: DataFrame, stamp: str | None, gather: bool, before: Commit) -> tuple[str, list[str], dict[str, str]]:
        """(batch, its partition folders, marks) of rows written to a folder that nobody reads yet."""
        batch = uuid.uuid4().hex
        rows = schema_guard(rows, self.schema)
        if gather and self.partition_by:
            rows = rows.hint("rebalance", self.partition_by)
        seen = None
        if stamp is not None:
            seen = Observation()
            rows = rows.observe(seen, F.max(stamp).cast("string").alias("newest"))
        target = f"{self.path}/{_BATCH}={batch}"
        writer = rows.write
        (writer.partitionBy(self.partition_by) if self.partition_by else writer).parquet(target)
        marks = dict(before.marks)
        if seen is not None and (newest := seen.get["newest"]) is not None:
            marks[stamp] = newest
        place, fs = place_of(self.spark, target)
        folders = [""]
        if self.partition_by:
            folders = sorted(found.getPath().getName() for found in fs.listStatus(place) if found.isDirectory())
        return batch, folders, marks

    def _before(self) -> Commit:
        return self.state() or Commit(0, self.schema.json())

    def _added(self, before: Commit, batch: str, folders: Sequence[str]) -> dict[str, list[str]]:
        live = {name: list(batches) for name, batches in before.live.items()}
        for name in folders:
            live.setdefault(name, []).append(batch)
        return live

    def append(self, rows: DataFrame, gather: bool = False) -> None:
        """Add all rows as one batch, without any check for repeats."""
        before = self._before()
        batch, folders, _ = self._write(rows, None, gather, before)
        self._publish(replace(before, version=before.version + 1, live=self._added(before, batch, folders), marks={}))

    def replace_days(self, rows: DataFrame, days: Sequence[date]) -> None:
        """Make ``rows`` the whole content of the given days, all of them at one moment.

        A row of any other day stops the job. A day without rows becomes empty.
        """
        before = self._before()
        batch, folders, _ = self._write(only_days(rows, days, self.partition_by), None, False, before)
        gone = {f"{self.partition_by}={day.isoformat()}" for day in days}
        live = {name: batches for name, batches in before.live.items() if name not in gone}
        live |= {name: [batch] for name in folders}
        self._publish(replace(before, version=before.version + 1, live=live, marks={}))

    def append_above_mark(self, rows: DataFrame, stamp: str = "_loaded_at") -> str | None:
        """Append the rows stamped later than anything in the table; return the mark used.

        The mark comes from the record; only a table last changed in another way is asked for
        its newest stamp. Rows stamped at or below the mark are skipped by design.
        """
        before = self._before()
        mark = before.marks.get(stamp)
        if mark is None and before.live:
            mark = high_water_mark(self.read(), stamp)
        kept = replace(before, marks={stamp: mark} if mark is not None else {})
        batch, folders, marks = self._write(filter_hwm(rows, stamp, mark), stamp, mark is None, kept)
        self._publish(replace(before, version=before.version + 1, live=self._added(before, batch, folders), marks=marks))
        return mark

    def _landed(self, landing: str, pattern: str) -> DataFrame:
        """(path, length, modificationTime) of the landed files; their content is not read."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        return files.load(landing).select(*_FILE)

    def new_files(self, landing: str, pattern: str = "*.parquet") -> DataFrame:
        """The landed files, by path, length and time of change, that no load has taken."""
        commit, landed = self.state(), self._landed(landing, pattern)
        if commit is None or not commit.loads:
            return landed
        taken = self.spark.read.schema(landed.schema).parquet(*(f"{self.path}/_loads/{batch}" for batch in commit.loads))
        return landed.join(taken, _FILE, "left_anti")

    def load_files(
        self, landing: str, read: Callable[[list[str]], DataFrame], pattern: str = "*.parquet", gather: bool = True
    ) -> list[str]:
        """Append what ``read`` makes of the landed files that no earlier load has taken; return them.

        A repeated run adds nothing. A file that was changed since counts as new. Rows and the
        list of files become valid with one record.
        """
        before = self._before()
        files = [tuple(row) for row in self.new_files(landing, pattern).collect()]
        if not files:
            return []
        paths = sorted(path for path, _, _ in files)
        batch, folders, _ = self._write(read(paths), None, gather, before)
        taken = self.spark.createDataFrame(files, "path string, length long, modificationTime timestamp")
        taken.coalesce(1).write.parquet(f"{self.path}/_loads/{batch}")
        live, loads = self._added(before, batch, folders), [*before.loads, batch]
        self._publish(replace(before, version=before.version + 1, live=live, loads=loads, marks={}))
        return paths

    def expire(self, keep: int = 1) -> list[str]:
        """Delete the batches that none of the last ``keep`` states uses, and older records; return the batches.

        Batches of broken-off runs go too, so no run may be writing, and no reader may be on an
        older state.
        """
        known = self._versions()
        kept = [self.state(version) for version in known[-max(keep, 1) :]]
        used = {batch for commit in kept for batches in commit.live.values() for batch in batches}
        root, fs = place_of(self.spark, self.path)
        gone = []
        for found in fs.listStatus(root) if fs.exists(root) else []:
            name = found.getPath().getName()
            if name.startswith(f"{_BATCH}=") and name.removeprefix(f"{_BATCH}=") not in used:
                fs.delete(found.getPath(), True)
                gone.append(name.removeprefix(f"{_BATCH}="))
        for version in known[: -max(keep, 1)]:
            fs.delete(place_of(self.spark, self._record(version))[0], False)
        return sorted(gone)
