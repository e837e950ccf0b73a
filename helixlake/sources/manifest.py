"""A folder of tables under a manifest: what readers see changes all at once, or not at all.

Tables are written to folders of their own that are never changed. A manifest is one file that names the folder of every
table; manifests are numbered, and the one of the largest number is current. To publish is to bring the next number into being:
the file is written under another name and renamed, which fails if someone else has taken the number, and is then done again on top of
theirs. Readers resolve the manifest once and keep the folders that it names, which stay until they are swept.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"manifest-(\d{20})\.json$")


class Conflict(RuntimeError):
    """Another publisher has replaced a table that this one was made from."""


class Catalogue:
    """Tables of one folder; every call looks at the folder anew."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def numbers(self) -> list[int]:
        """Of the manifests there are, ascending."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        found = (_NAME.search(f.getPath().getName()) for f in self._fs.listStatus(self._path(self.folder)))
        return sorted(int(m[1]) for m in found if m)

    def manifest(self, number: int | None = None) -> dict[str, dict]:
        """table -> {"path", "facts"} of a manifest, of the current one by default; empty if there is none."""
        numbers = self.numbers()
        if not numbers:
            return {}
        stream = self._fs.open(self._path(self._file(numbers[-1] if number is None else number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["tables"]
        finally:
            stream.close()

    def _file(self, number: int) -> str:
        return f"{self.folder}/manifest-{number:020d}.json"

    def read(self, table: str, number: int | None = None) -> DataFrame:
        entry = self.manifest(number)[table]
        return self.spark.read.schema(entry["facts"]["schema"]).parquet(entry["path"])

    def write(self, df: DataFrame, table: str, partition: str | None = None, order: tuple[str, ...] = ()) -> dict:
        """Write a table to a folder of its own; nobody sees it until it is published. Rows are dealt by all of `order`: by its first column, few values would be few tasks."""
        path = f"{self.folder}/tables/{table}/{uuid.uuid4().hex}"
        if partition:
            df.repartition(partition, *order).sortWithinPartitions(partition, *order).write.partitionBy(partition).parquet(path)
        else:
            df.write.parquet(path)
        return {"path": path, "facts": {"schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)}}

    def publish(self, entries: dict[str, dict], expected: dict[str, str | None] | None = None) -> int:
        """Make entries current, with all other tables as they are, and return the manifest's number.

        expected: paths that tables must still have (None: no such table); Conflict, if one has been replaced meanwhile.
        """
        while True:
            number = (self.numbers() or [0])[-1]
            tables = self.manifest(number) if number else {}
            for table, path in (expected or {}).items():
                if tables.get(table, {}).get("path") != path:
                    raise Conflict(table)
            scratch = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
            out = self._fs.create(scratch, False)
            try:
                out.write(bytearray(json.dumps({"tables": tables | entries}, sort_keys=True).encode()))
            finally:
                out.close()
            target = self._path(self._file(number + 1))
            if not self._fs.exists(target) and self._fs.rename(scratch, target):
                return number + 1
            self._fs.delete(scratch, False)

    def refresh(self, views: list[tuple[str, Callable[[Catalogue], DataFrame]]], partition: str | None = None, order: tuple[str, ...] = ()) -> int:
        """Make views in the order given and publish them together. A view may read those before it by `pending`.

        If one fails, nothing is published and what was written is deleted: readers go on with what they have.
        """
        entries: dict[str, dict] = {}
        self.pending = lambda name: self.spark.read.schema(entries[name]["facts"]["schema"]).parquet(entries[name]["path"])
        try:
            for name, make in views:
                entries[name] = self.write(make(self), name, partition, order)
            return self.publish(entries)
        except BaseException:
            for entry in entries.values():
                self._fs.delete(self._path(entry["path"]), True)
            raise

    def rebuild(self, table: str, make: Callable[[DataFrame], DataFrame], partition: str | None = None, order: tuple[str, ...] = ()) -> int:
        """Replace a table by what `make` makes of its present rows: another grain, fewer columns, no rows. Returns the manifest's number.

        Conflict, if someone has replaced it meanwhile; then, as if publishing fails, what was written is deleted and nothing changes.
        Readers of the old version keep it until it is swept.
        """
        number = (self.numbers() or [0])[-1]
        tables = self.manifest(number) if number else {}
        if table not in tables:
            raise KeyError(table)
        entry = self.write(make(self.read(table, number)), table, partition, order)
        try:
            return self.publish({table: entry}, {table: tables[table]["path"]})
        except BaseException:
            self._fs.delete(self._path(entry["path"]), True)
            raise

    def sweep(self, keep: int = 2) -> list[str]:
        """Delete all manifests but the last `keep`, and the folders that none of these names; those being written are left alone only if
        nothing is: to be called when no refresh runs. Returns the folders deleted.
        """
        numbers = self.numbers()
        used = {e["path"] for n in numbers[-keep:] for e in self.manifest(n).values()}
        for n in numbers[:-keep]:
            self._fs.delete(self._path(self._file(n)), False)
        gone, top = [], self._path(f"{self.folder}/tables")
        for table in self._fs.listStatus(top) if self._fs.exists(top) else ():
            for version in self._fs.listStatus(table.getPath()):
                path = f"{self.folder}/tables/{table.getPath().getName()}/{version.getPath().getName()}"
                if path not in used:
                    self._fs.delete(version.getPath(), True)
                    gone.append(path)
        return gone
