"""Zip archives as a data source: lines are read in place, by the tasks, from the archives' first entries.

    archives.read(spark, "in/*.zip")

Spark lists the paths, so patterns and folders work as in its own sources; only names and sizes reach the plan. A partition
is a few archives, as many as fit into the session's partition size, or a single larger one: what is inside a zip archive
cannot be split. A task holds a block of lines at a time, whatever an archive's size. Archives that lie elsewhere than in
local folders are opened by pyarrow's file systems; `read_zipped_lines` has another way for stores that only Spark reads.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "line string, path string"
#: Bytes of lines that a batch holds about.
BLOCK = 1 << 22
#: Bytes of archives that are read at once.
SMALL = 1 << 16
#: Schemes that pyarrow opens.
OPENED = ("", "file", "hdfs", "s3", "s3a", "gs")


@dataclass
class Archives(InputPartition):
    paths: list[str]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    place = urlparse(path)
    if place.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(place.path)
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def lines_of(file, path: str) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(file) as archive:
        names = archive.namelist()
        if not names:
            return
        with archive.open(names[0]) as entry:
            text = io.TextIOWrapper(entry, "utf-8", errors="replace", newline="\n")
            while lines := text.readlines(BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\r\n") for x in lines], pa.string()), pa.array([path] * len(lines), pa.string())], names=["line", "path"])


class _Reader(DataSourceReader):
    def __init__(self, groups: list[list[str]]):
        self.groups = groups

    def partitions(self) -> list[Archives]:
        return [Archives(g) for g in self.groups]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            system, inner = file_system(path)
            with system.open_input_file(inner) as file:
                small = file.size() <= SMALL
                yield from lines_of(io.BytesIO(file.read()) if small else file, path)


class ZippedLines(DataSource):
    """(line, path) of the archives in option `groups`, a JSON list of lists of paths, one for each partition."""

    @classmethod
    def name(cls) -> str:
        return "zipped_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["groups"]))


def listed(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The archives under the paths, in groups of about the session's partition size; no contents are read."""
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = sorted((r.length, r.path) for r in spark.read.format("binaryFile").load(paths).select("path", "length").collect())
    groups: list[list[str]] = []
    size = most + 1
    for length, path in files:
        if size + length > most:
            groups.append([])
            size = 0
        groups[-1].append(path)
        size += length
    return groups


def read(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(line, path) of the first entry of each archive."""
    groups = listed(spark, [paths] if isinstance(paths, str) else paths)
    if not groups:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(ZippedLines)
    return spark.read.format("zipped_lines").option("groups", json.dumps(groups)).load()


def opened(paths: str | list[str]) -> bool:
    """Whether tasks can open such paths themselves."""
    return all(urlparse(p).scheme in OPENED for p in ([paths] if isinstance(paths, str) else paths))
