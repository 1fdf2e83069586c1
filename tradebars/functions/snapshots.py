"""Numbered manifests of a folder: one small file names all data that belongs together, so that readers see all of a change or
none of it. Data files are never replaced, only named by a later manifest or no more."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tradebars.functions.tables import delete

#: Manifests, with their data, that stay for readers which began before the last ones were written.
KEPT = 3


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._top = self._path(f"{folder}/_snapshots")
        self._fs = self._top.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._top):
            return []
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in self._fs.listStatus(self._top) if s.getPath().getName().endswith(".json"))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/_snapshots/{number:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict:
        """What the last manifest says, or nothing."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else {}

    def new_path(self, table: str) -> str:
        """A place, relative to the folder, that no manifest names yet."""
        return f"{table}/{uuid.uuid4().hex}"

    def commit(self, content: dict) -> int:
        """Make this the current state. The file appears whole, by a rename; where another writer was first that is an error."""
        number = max(self.numbers(), default=-1) + 1
        hidden, final = self._path(f"{self.folder}/_snapshots/.{uuid.uuid4().hex}"), self._path(f"{self.folder}/_snapshots/{number:010d}.json")
        out = self._fs.create(hidden, False)
        out.write(json.dumps(content).encode())
        out.close()
        if self._fs.exists(final) or not self._fs.rename(hidden, final):
            self._fs.delete(hidden, False)
            raise RuntimeError(f"another writer has committed {number} in {self.folder}")
        return number

    def vacuum(self, tables: list[str], kept: int = KEPT) -> None:
        """Delete manifests but the last ones, and data that none of those names."""
        numbers = self.numbers()
        for n in numbers[:-kept]:
            self._fs.delete(self._path(f"{self.folder}/_snapshots/{n:010d}.json"), False)
        named = "\n".join(json.dumps(self.read(n)) for n in numbers[-kept:])
        for table in tables:
            top = self._path(f"{self.folder}/{table}")
            for s in self._fs.listStatus(top) if self._fs.exists(top) else []:
                if f"{table}/{s.getPath().getName()}" not in named:
                    delete(self.spark, s.getPath().toString())
