"""The target as versions of tables: written aside, published as a whole, read back by the next run.

A run writes its tables under ``versions/<run>/<table>/<segment>`` and, when all are there, one small file
``published/<number>.json`` that says which folders make up each table. Readers take the newest such file that is
complete, so a run that breaks off leaves the version before it readable and is never seen itself. A table may be
kept in segments, one per job that loads it: a job replaces its own segments, and those it does not touch are
taken over by naming their folder again, without being read or written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from . import files


@dataclass(frozen=True)
class Snapshot:
    """A published version: table -> segment -> folder, and what each output was made from."""

    spark: SparkSession
    number: int
    tables: dict[str, dict[str, str]]
    made_from: dict[str, str]

    def table(self, name: str, without: tuple[str, ...] = ()) -> DataFrame | None:
        """All rows of a table (or of its segments but those in ``without``); None when the version has none."""
        parts = [self.spark.read.parquet(p) for s, p in self.tables.get(name, {}).items() if s not in without]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


@dataclass
class Run:
    """A version being written. Nothing of it is visible before ``publish``."""

    target: "Target"
    previous: Snapshot | None
    folder: str
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    made_from: dict[str, str] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, segment: str = "all") -> str:
        path = f"{self.folder}/{name}/{segment}"
        df.write.parquet(path)
        self.tables.setdefault(name, {})[segment] = path
        return path

    def keep(self, name: str, segment: str | None = None) -> None:
        """Take over a segment (or all) of a table from the version before."""
        old = self.previous.tables[name]
        self.tables.setdefault(name, {}).update(old if segment is None else {segment: old[segment]})

    def publish(self) -> Snapshot:
        """Make this version the current one. Tables that the run did not write stay as they were."""
        tables = {**(self.previous.tables if self.previous else {}), **self.tables}
        made = {**(self.previous.made_from if self.previous else {}), **self.made_from}
        number = self.target.numbers()[-1] + 1 if self.target.numbers() else 1
        text = json.dumps({"tables": tables, "made_from": made, "complete": True}, sort_keys=True)
        files.write_text(self.target.spark, self.target.pointer(number), text)
        return Snapshot(self.target.spark, number, tables, made)


@dataclass
class Target:
    spark: SparkSession
    root: str

    def pointer(self, number: int) -> str:
        return f"{self.root.rstrip('/')}/published/{number:08}.json"

    def numbers(self) -> list[int]:
        found = files.names(self.spark, f"{self.root.rstrip('/')}/published")
        return [int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit()]

    def current(self) -> Snapshot | None:
        """The newest complete version; a pointer that was cut short is passed over."""
        for number in reversed(self.numbers()):
            try:
                said = json.loads(files.read_text(self.spark, self.pointer(number)))
            except ValueError:
                continue
            if said.get("complete"):
                return Snapshot(self.spark, number, said["tables"], said["made_from"])
        return None

    def begin(self) -> Run:
        return Run(self, self.current(), f"{self.root.rstrip('/')}/versions/{uuid.uuid4().hex}")
