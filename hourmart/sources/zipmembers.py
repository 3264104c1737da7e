"""Members of zip objects as partitions of a data source.

An object is opened where it lies and read by seeking, so its size is not limited and no task holds
it: the driver reads the list of members at the end of each object, and every member is a task,
which sends it on in blocks of whole lines. Only for stores that Python opens by itself.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from hourmart.schemas import LOAD_HOUR

BLOCK_SCHEMA = f"{LOAD_HOUR} TIMESTAMP_NTZ, member STRING, block STRING"
BLOCK_BYTES = 4 << 20
# How Hadoop's names of stores are called where Python opens them.
_SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "gs": "gs"}


def can_open(path: str) -> bool:
    return urlparse(path).scheme in _SCHEMES


def open_object(path: str) -> pa.NativeFile:
    """A path as Spark lists it, opened for reading at any place."""
    parts = urlparse(path)
    scheme = _SCHEMES[parts.scheme]
    if scheme == "file":
        return pa.fs.LocalFileSystem().open_input_file(unquote(parts.path))
    store, key = pa.fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{parts.path}")
    return store.open_input_file(unquote(key))


def blocks(archive: zipfile.ZipFile, member: str) -> Iterator[bytes]:
    """A member in blocks of whole lines; a line longer than a block is one block."""
    rest: list[bytes] = []
    with archive.open(member) as text:
        while chunk := text.read(BLOCK_BYTES):
            head, newline, tail = chunk.rpartition(b"\n")
            if newline:
                yield b"".join([*rest, head])
                rest = []
            rest.append(tail)
    yield b"".join(rest)


def block_rows(archive: zipfile.ZipFile, member: str, hour: datetime) -> Iterator[pa.RecordBatch]:
    for block in blocks(archive, member):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hour], pa.timestamp("us")),
                pa.array([member], pa.string()),
                pa.array([block.decode("utf-8")], pa.string()),
            ],
            names=[LOAD_HOUR, "member", "block"],
        )


def members(archive: zipfile.ZipFile) -> list[str]:
    return [entry.filename for entry in archive.infolist() if not entry.is_dir()]


@dataclass
class Member(InputPartition):
    path: str
    hour: str
    name: str


class _MemberReader(DataSourceReader):
    def __init__(self, objects: list[list[str]]) -> None:
        self._objects = objects

    def partitions(self) -> list[Member]:
        found = []
        for hour, path in self._objects:
            with open_object(path) as file, zipfile.ZipFile(file) as archive:
                found += [Member(path, hour, name) for name in members(archive)]
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        with open_object(partition.path) as file, zipfile.ZipFile(file) as archive:
            hour = datetime.fromisoformat(partition.hour)
            yield from block_rows(archive, partition.name, hour)


class ZipMembers(DataSource):
    """Option ``objects``: JSON list of [load hour, path]."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema) -> _MemberReader:
        return _MemberReader(json.loads(self.options["objects"]))


def read_members(spark: SparkSession, objects: list[tuple[datetime, str]]) -> DataFrame:
    """Blocks of all members of some objects, given as (load hour, path)."""
    spark.dataSource.register(ZipMembers)
    named = json.dumps([[hour.isoformat(), path] for hour, path in objects])
    return spark.read.format(ZipMembers.name()).option("objects", named).load()
